import hashlib
import random

import numpy as np
import pytest
from tests.llm.conftest import MESSY

from vellum.llm import line_dedup, suffix_dedup


def slow_repeats(rows, length=50):
    first, out = {}, {}
    rows = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in rows:
        if i is not None:
            for k in range(len(b) - length + 1):
                first[b[k : k + length]] = min(first.get(b[k : k + length], i), i)
    for i, b in rows:
        cover = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if i is not None and first[b[k : k + length]] < i:
                cover[k : k + length] = b"\1" * length
        spans = sum(c and not p for p, c in zip(b"\0" + cover, cover))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[(i, b)] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((str(i), *out[(i, b)]) for i, b in rows))


def check(frame, rows):
    got = suffix_dedup.remove_repeats(frame(rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_repeats(rows)
    assert all(r.kept is None or hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_messy_rows(frame):
    check(frame, [r for r in MESSY if r[1] is None or len(r[1]) < 1000] + [(20, MESSY[6][1][:30_000]), (21, "x" + MESSY[6][1][200:20_000] + "é" * 60)])


def test_low_entropy_texts_and_overlaps(frame):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randrange(200))) + "ab" * r.randrange(60) + "a" * r.randrange(120)) for i in range(60)]
    check(frame, rows + [(3, "a" * 200), (100, rows[7][1]), (101, rows[7][1]), (None, rows[7][1])])


@pytest.mark.parametrize("hot", [64, 1])
def test_common_passage_between_different_texts(frame, monkeypatch, hot):
    """With ``HOT`` = 1 every parted bucket goes the way of very common ones."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(20)
    check(frame, [(i, text(r.randrange(12)) + passage[r.randrange(30) :] + text(r.randrange(12))) for i in range(120)])


def test_long_texts_are_cut_without_loss(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    r = random.Random(7)
    base = "".join(r.choice("abcdefgh") for _ in range(900))
    import pyarrow as pa

    whole = suffix_dedup._all_anchors(pa.array([base.encode(), base[100:700].encode()], pa.binary()))
    windows = {0: set(), 1: set()}
    for row, first, more in zip(whole[0], whole[3], whole[4]):
        windows[int(row)] |= set(range(int(first), int(first + more) + 1))
    assert windows == {0: set(range(851)), 1: set(range(551))}


def test_window_ranks_are_equal_for_equal_strings_only():
    r = random.Random(8)
    data = bytes(r.choice(b"ab") for _ in range(400)) + b"x" + b"ab" * 60 + b"y" + b"ab" * 40
    starts = np.arange(len(data) - 49)
    ranks = suffix_dedup.window_ranks(np.frombuffer(data, np.uint8), starts)
    by_rank, by_string = {}, {}
    for s, k in zip(starts.tolist(), ranks.tolist()):
        by_rank.setdefault(k, set()).add(data[s : s + 50])
        by_string.setdefault(data[s : s + 50], set()).add(k)
    assert all(len(x) == 1 for x in by_rank.values()) and all(len(x) == 1 for x in by_string.values())


def test_empty_table(frame):
    assert suffix_dedup.remove_repeats(frame([])).count() == 0
    assert line_dedup.drop_repeated_runs(frame([])).count() == 0


def slow_lines(rows, run=3):
    rows = sorted({(i is not None, i or 0, t) for i, t, *_ in rows if t is not None})
    first, lines = {}, {}
    for n, (has, i, t) in enumerate(rows):
        all_lines = t.split("\n")
        lines[(has, i, t)] = all_lines
        full = [k for k, x in enumerate(all_lines) if x.strip(" \t\r\x0b\x0c")]
        for p in range(len(full) - run + 1):
            first.setdefault(tuple(all_lines[k].strip(" \t\r\x0b\x0c") for k in full[p : p + run]), []).append((has, i, p, n))
    out = {}
    for n, row in enumerate(rows):
        all_lines = lines[row]
        full = [k for k, x in enumerate(all_lines) if x.strip(" \t\r\x0b\x0c")]
        gone, starts = set(), []
        for p in range(len(full) - run + 1):
            places = first[tuple(all_lines[k].strip(" \t\r\x0b\x0c") for k in full[p : p + run])]
            if (row[0], row[1], p, n) != min(places):
                gone |= set(full[p : p + run])
                starts.append(p)
        runs = sum(k == 0 or starts[k] - starts[k - 1] > run for k in range(len(starts)))
        out[row] = (len(all_lines), len(gone), runs, "\n".join(x for k, x in enumerate(all_lines) if k not in gone))
    return out


def test_runs_of_lines(frame):
    r = random.Random(8)
    rows = [(i, "\n".join(r.choice(["a", " a", "b ", "c", "", "d", "common line"]) for _ in range(r.randrange(14)))) for i in range(80)]
    rows += [(200, None), (201, ""), (None, "p\nq\nr"), (202, "p\nq\nr\n\ns"), (203, "p\nq\nr\n\ns"), (203, "p\nq\nr\n\ns"), (204, "z\n" * 5000)]
    want = slow_lines(rows)
    for g in line_dedup.drop_repeated_runs(frame(rows)).collect():
        if g.doc_id == 200:
            assert (g.n_lines, g.n_removed, g.n_runs, g.text) == (0, 0, 0, None)
        else:
            found = [v for k, v in want.items() if (k[1] if k[0] else None) == g.doc_id]
            assert (g.n_lines, g.n_removed, g.n_runs, g.text) in found, (g.doc_id, found)
