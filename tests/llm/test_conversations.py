"""Conversation repair against a search over whole edit strings."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import LONG

from vellum.llm import conversations, queries

TURNS = "conv_id long, turn long, role string, text string"
GO = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FULL = {"u": "user", "a": "assistant"}


def damage(rows):
    for i, turn, role, text in rows:
        some = lambda x: " " if x is None else str(x)
        deal = zlib.crc32(f"{some(i)}:{some(turn)}".encode()) % 20
        role, text = some(role), some(text)
        if deal:
            text = "" if deal == 1 else re.sub("[.!?]", "", text) if deal == 2 else text
            yield from [(i, turn, "user" if deal == 4 else role, text)] * (2 if deal == 3 else 1)


def cheapest(rows):
    """(cost, audit, lines) for (role, text, fault) rows: of all edit strings the
    cheapest, then the least, by the strings themselves."""
    inf = (10**9, "", ())
    after = [(0, "", ()) if s in (0, 3) else inf for s in range(4)]

    def with_insertions(best):
        for _ in range(3):
            for s in range(4):
                for c, t in GO[s].items():
                    if c != "s":
                        cost, audit, lines = best[t]
                        best[s] = min(best[s], (cost + 3, "I" + audit, (f"{FULL[c]}:", *lines)))
        return best

    after = with_insertions(after)
    for role, text, fault in reversed(rows):
        here, late = [], 3 * (fault == "truncated")
        for s in range(4):
            cost, audit, lines = after[s]
            options = [(cost + 4, "D" + audit, lines)]
            if fault not in ("blank", "duplicate"):
                for c, t in GO[s].items():
                    cost, audit, lines = after[t]
                    if c == role[:1]:
                        options.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
                    if c != "s":
                        options.append((cost + 3 + late, "R" + audit, (f"{FULL[c]}:{text}", *lines)))
            here.append(min(options))
        after = with_insertions(here)
    return after[0]


def expected(rows):
    damaged = list(damage(rows))
    for i in dict.fromkeys(r[0] for r in rows):
        own = [r for r in damaged if r[0] == i]
        order = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest())
        own.sort(key=order)
        judged, seen = [], set()
        for _, _, role, text in own:
            cut = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = cheapest(judged)
        faults = [sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")]
        yield (i, gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def some_rows(r, ids, longest):
    for i in ids:
        kind = r.choice(["any", "plain", "users", "others"])
        for turn in range(r.randrange(longest)):
            role = {"users": "user", "others": "tool", "plain": ["user", "assistant"][turn % 2]}.get(kind) or r.choice(["system", "user", "assistant", "tool", "", "User"])
            text = r.choice(["", " \n", "Yes.", "No", f"Text {r.random()}.", f"text {turn}!", f"cut {turn} ,  "])
            yield i, turn if r.random() > 0.05 else None, role, text


def query(spark, rows, path, clash=False):
    d = spark.createDataFrame(rows, TURNS)
    d = d.withColumns({c: F.lit("clash") for c in ("pos", "part", "same", "kind", "fault", "first", "edit", "before", "deal", "copy")}) if clash else d
    d.repartition(3).write.parquet(f"{path}/conversations.parquet")
    return sorted((tuple(x) for x in queries.op12_conversation_repair(spark, str(path)).collect()), key=str)


@pytest.mark.parametrize("ranges", [1, 13])
def test_query_equals_the_search(spark, tmp_path, ranges):
    r = random.Random(5)
    rows = list(some_rows(r, range(60), 9)) + list(some_rows(r, [1000, 1001, 1002], 70))
    # one conversation over many ranges whose ranks never converge: users only
    rows += [(2000, t, "user", f"line {t}.") for t in range(150)]
    rows += [(None, t, "assistant", "alone.") for t in (1, 2, None)] + [(3000, 5, None, None), (3000, None, "user", None), (3001, 1, "user", LONG + ".")]
    rows += [(4000, 3, "user", "same row.")] * 40 + [(4001, -7, "user", "below none."), (4001, 10**12, "assistant", "Far.")]
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = query(spark, rows, tmp_path, clash=True)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted(expected(rows), key=str)
    assert [g for g in got if g not in want] == [] and got == want


def test_chunks_of_one_conversation_meet(monkeypatch):
    """Vectors run chunk by chunk from speculative ends equal one run, and are few."""
    r = random.Random(6)
    kinds = [r.choice([2, 2, 2, 4, 6, 3, 8, 0]) for _ in range(3000)]
    whole = conversations.vectors(kinds, conversations.END)
    v, found = conversations.END, []
    for at in range(2900, -1, -100):
        part = conversations.vectors(kinds[at : at + 100], v)
        assert part == whole[at : at + 101]
        v = part[0]
    seen, new = {conversations.END}, [conversations.END]
    while new:
        new = list({conversations.before(x, k) for x in new for k in range(8)} - seen)
        seen.update(new)
    assert len(seen) < 200


def test_no_rows(spark, tmp_path):
    dropped = [(i, 0, "user", "one.") for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    assert dropped
    empty = hashlib.sha256(b"").hexdigest()
    assert query(spark, dropped, tmp_path / "a") == sorted(((i, 0, 0, 0, 0, 0, 0, "", empty) for i, *_ in dropped), key=str)
    assert query(spark, [], tmp_path / "b") == []


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Ask!"), (1, 4, "user", " ")]
    got = conversations.repair(spark.createDataFrame(rows, TURNS)).orderBy("pos").collect()
    judged = [("system", "Be kind.", None), ("assistant", "Hi.", None), ("assistant", "Hi.", "duplicate"), ("assistant", "Ask!", None), ("user", " ", "blank")]
    cost, audit, lines = cheapest(judged)
    assert [(x.turn, x.fault) for x in got] == [(t, f) for t, (_, _, f) in enumerate(judged)]
    assert "".join("I" * len(x.before) + x.edit + "I" * len(x.after) for x in got) == audit
    assert sum({"K": 0, "R": 3, "D": 4}[x.edit] + 3 * len(x.before + x.after) for x in got) == cost
    kept = [f"{x.role}:{x.text}" for x in got if x.edit != "D"]
    assert kept == [x for x in lines if not x.endswith(":")] and all(x.role is None and x.text is None for x in got if x.edit == "D")
