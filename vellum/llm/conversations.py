"""Conversation repair by rank-convergence parallel Viterbi.

Each conversation is edited at the least cost into one whose role initials read
``(s?(ua)+)?``: rows are kept, given another role or deleted, and turns without
text are inserted.  Blank and duplicate rows must go, so only the other rows
stand for stages of the search; four states (nothing yet, after s, after u,
after a) hold what has been put out.

Rows are sorted once into ranges by conversation and turn, so a conversation of
any length is cut into chunks, one a range, and a task holds one range of thin
rows (no texts).  Costs run backwards: a chunk's vector of costs to the end
follows from the vector of the chunk after it.  All chunks start at once, the
last one of a conversation from the true end, the others from a speculative
vector (as though the conversation ended there).  A fix-up pass reruns the
chunks that have not yet started from a vector that the chunk after them gave;
vectors that differ only by a constant count as one, as a constant changes no
choice.  Costs of states differ by a few edits at most, so there are few vectors
and the passes end soon, however long a conversation and whether or not its
ranks converge.

The stitched vectors drive the trace: at each row the edit with the least letter
that still ends at the least cost.  A chunk's exit state for each entry state
comes with its runs, so chunks are traced at once.  The driver holds a few
vectors for two chunks a range at most, which grows with the number of ranges,
not of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
SPACE = " \t\n\x0b\x0c\r"
INITIALS = "sua"  # 3: any other
#: next state by initial (rows) and state (columns: nothing yet, after s, after u, after a)
AFTER = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None))
FILL = (2, 2, 3, 2)  # the state after an inserted or re-roled turn
FILLED = "uuau"  # and its initial
FORCED = 8  # kind of rows that must go; others: 2 * initial + truncated

Vector = tuple[int, int, int, int]
END: Vector = (0, 2 * INSERT, INSERT, 0)
FINISH = ("", "ua", "a", "")  # inserted at the end, by state


def _closed(r: list[int]) -> Vector:
    """Least costs where turns can be inserted first."""
    u, a = min(r[2], INSERT + r[3]), min(r[3], INSERT + r[2])
    return min(r[0], INSERT + u), min(r[1], INSERT + u), u, a


def _choices(v: Vector, kind: int) -> tuple[list[int], list[int | None]]:
    """Least cost of giving the row another role or deleting it, by state, and
    of keeping it where that can be."""
    extra = TRUNCATED * (kind & 1)
    kept = AFTER[kind >> 1] if kind >> 1 < 3 else (None,) * 4
    keep = [None if t is None else KEEP + extra + v[t] for t in kept]
    return [min(c for c in (DELETE + v[s], REROLE + extra + v[FILL[s]], keep[s]) if c is not None) for s in range(4)], keep


@lru_cache(maxsize=1 << 16)
def before(v: Vector, kind: int) -> Vector:
    """The vector before a row, from the one after it, less a constant."""
    b = _closed(_choices(v, kind)[0])
    least = min(b)
    return tuple(c - least for c in b)


@lru_cache(maxsize=1 << 16)
def edit(state: int, v: Vector, kind: int) -> tuple[str, str, str, int]:
    """Least edits at a row in front of vector ``v``: initials inserted, letter of
    the row's edit, its new initial where it gets one, and the state after it."""
    r, keep = _choices(v, kind)
    b = _closed(r)
    inserted = ""
    while True:
        if DELETE + v[state] == b[state]:
            return inserted, "D", "", state
        if INSERT + b[FILL[state]] == b[state]:
            inserted, state = inserted + FILLED[state], FILL[state]
        elif keep[state] == b[state]:
            return inserted, "K", "", AFTER[kind >> 1][state]
        else:
            return inserted, "R", FILLED[state], FILL[state]


def vectors(kinds: list[int], end: Vector) -> list[Vector]:
    """The vector in front of each row, and ``end``."""
    out, v = [end], end
    for kind in reversed(kinds):
        if kind != FORCED:
            v = before(v, kind)
        out.append(v)
    return out[::-1]


def trace(kinds: list[int], costs: list[Vector], state: int) -> tuple[list[tuple[str, str, str]], int]:
    """(inserted initials, letter, new initial) of every row, and the state after them."""
    out = []
    for kind, v in zip(kinds, costs[1:]):
        if kind == FORCED:
            out.append(("", "D", ""))
        else:
            inserted, letter, role, state = edit(state, v, kind)
            out.append((inserted, letter, role))
    return out, state


def _exits(kinds: list[int], costs: list[Vector]) -> list[int]:
    return [trace(kinds, costs, s)[1] for s in range(4)]


def ordered(rows: DataFrame) -> DataFrame:
    """Thin rows of all conversations in one order: ``pos`` rises by conv_id and
    turn (nulls first; ties by hash of role and text), ``part`` is its range."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    thin = rows.select(
        "conv_id", "turn", same("role", "text").alias("same"), initial.alias("initial"),
        F.when(last == "", F.lit("blank")).when(~F.right(last, F.lit(1)).isin(".", "!", "?"), F.lit("truncated")).alias("fault"),
        F.monotonically_increasing_id().alias("place"),
    )
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "same", "place"]
    thin = thin.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("place")
    thin = written(thin.withColumns({"pos": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), "turns")
    # the first of equal rows, found by its position: no join on a conversation or a text
    firsts = thin.groupBy("conv_id", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    thin = thin.join(firsts, "pos", "left")
    fault = F.when(F.col("fault") == "blank", F.col("fault")).when(F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))
    kind = F.coalesce(*[F.when(F.col("initial") == c, 2 * i) for i, c in enumerate(INITIALS)], F.lit(6))
    kind = F.when(F.col("fault").isin("blank", "duplicate"), FORCED).otherwise(kind + F.when(F.col("fault") == "truncated", 1).otherwise(0))
    return written(thin.withColumn("fault", fault).withColumn("kind", kind).drop("first"), "judged")


def same(role: str, text: str) -> Column:
    """Equal for equal role and text."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text)))


def _chunks(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """(part, conversation, first of its part, last of its part, kinds, other columns) of
    every chunk, from rows (part, conv_id, kind, ...) sorted by part and position."""
    part, rows = None, []

    def cut():
        starts = [0, *(i for i in range(1, len(rows)) if rows[i][1] != rows[i - 1][1]), len(rows)]
        for a, b in zip(starts, starts[1:]):
            yield part, rows[a][1], a == 0, b == len(rows), [r[2] for r in rows[a:b]], [r[3:] for r in rows[a:b]]

    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(columns))):
            if r[0] != part:
                if rows:
                    yield from cut()
                part, rows = r[0], []
            rows.append(r)
    if rows:
        yield from cut()


def _by_part(rows: DataFrame) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "part").sortWithinPartitions("part", "pos")


def _stitch(judged: DataFrame) -> tuple[dict, dict]:
    """For conversations that lie in several ranges: the entry state of each
    range's first chunk and the vector after each range's last chunk, by range,
    where that chunk has a part before or after it."""
    ends = judged.groupBy("part").agg(F.min_by("conv_id", "pos").alias("first"), F.max_by("conv_id", "pos").alias("last"))
    ends = sorted((tuple(r) for r in ends.collect()), key=lambda r: r[0])  # a row a range
    # chunks of one conversation, in order: (range, whether it is the range's first chunk, its last chunk)
    spans, joined = [], False
    for i, (part, first, last) in enumerate(ends):
        follows = i + 1 < len(ends) and ends[i + 1][1] == last
        if joined:
            spans[-1].append(part)
        if follows and not (joined and first == last):
            spans.append([part])
        joined = follows
    if not spans:
        return {}, {}
    first_of, last_of = {p for s in spans for p in s[1:]}, {p for s in spans for p in s[:-1]}

    def run(wanted: dict[tuple[int, bool], list[Vector]]) -> dict:
        """Vector in front and exit states of chunks (range, whether another follows) for vectors behind them."""

        def chunk_runs(batches):
            for part, _, first, last, kinds, _ in _chunks(batches, 3):
                follows = last and part in last_of
                if not follows and not (first and part in first_of):
                    continue
                got = []
                for v in wanted.get((part, follows), ()):
                    costs = vectors(kinds, v)
                    got.append((part, follows, v, costs[0], _exits(kinds, costs)))
                if got:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*got), types)], ["part", "follows", "behind", "front", "exits"])

        types = [pa.int32(), pa.bool_(), *[pa.list_(pa.int32())] * 3]
        some = judged.where(F.col("part").isin(sorted({p for p, _ in wanted}))).select("part", "conv_id", "kind", "pos")
        got = _by_part(some).select("part", "conv_id", "kind").mapInArrow(chunk_runs, "part int, follows boolean, behind array<int>, front array<int>, exits array<int>")
        return {(r.part, r.follows, tuple(r.behind)): (tuple(r.front), r.exits) for r in got.collect()}

    chunks = [[(p, k + 1 < len(s)) for k, p in enumerate(s)] for s in spans]
    # speculation: every chunk as though the conversation ended behind it
    known, wanted = {}, {c: [END] for s in chunks for c in s}
    while wanted:
        known.update(run(wanted))
        tried: dict = {}
        for p, f, v in known:
            tried.setdefault((p, f), set()).add(v)
        wanted = {}
        for s in chunks:
            for c, after in zip(s, s[1:]):
                missing = {known[*after, v][0] for v in tried[after]} - tried[c]
                if missing:
                    wanted[c] = sorted(missing)
    entry, behind = {}, {}
    for s in chunks:
        v, true = END, []
        for c in reversed(s):
            true.append(v)
            v = known[*c, v][0]
        state = 0
        for c, v in zip(s, reversed(true)):
            if c != s[0]:
                entry[c[0]] = state
            if c[1]:
                behind[c[0]] = v
            state = known[*c, v][1][state]
    return entry, behind


def edits(judged: DataFrame) -> DataFrame:
    """``judged`` rows with ``before`` (initials of turns inserted before the row),
    ``edit`` (K, R or D), ``to`` (a new role's initial) and ``after`` (inserted
    after the conversation's last row)."""
    entry, behind = _stitch(judged)

    def run(batches):
        for part, _, first, last, kinds, rest in _chunks(batches, 4):
            more = last and part in behind
            costs = vectors(kinds, behind[part] if more else END)
            rows, state = trace(kinds, costs, entry.get(part, 0) if first else 0)
            done = [(pos, *e, "") for (pos,), e in zip(rest, rows)]
            if not more:
                done[-1] = (*done[-1][:-1], FINISH[state])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), [pa.int64(), *[pa.string()] * 4])], ["pos", "before", "edit", "to", "after"])

    found = _by_part(judged.select("part", "conv_id", "kind", "pos")).mapInArrow(run, "pos long, before string, edit string, to string, after string")
    return judged.join(found, "pos")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations``: ``conv_id``, ``pos`` (rises in the
    order of the conversation), ``turn``, ``initial`` of its role, ``fault``
    (blank, duplicate, truncated or null), ``edit`` (K kept, R given another role,
    D deleted), ``before`` and ``after`` (initials of the turns inserted around it)
    and the repaired ``role`` and ``text`` (null where deleted).

    Rows go by turn, null first; rows of one turn by a hash of role and text.  Null
    roles and texts are one space.  Blank rows have only white space (ASCII) in
    their text; duplicates have a role and text that stand earlier in the
    conversation; truncated ones don't end in ``. ! ?``; a row's first fault in this
    order counts.  A null conv_id is a conversation; equal rows are told apart by
    nothing, so it is no matter which of them stays; an empty table gives no rows;
    other columns are not looked at.  Edits are the cheapest, and of those the
    first by their letters in order (I for an insertion).

    Texts are moved once, by conversation, turn and hash, for the rows that stay.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    e = written(edits(ordered(rows)), "edits").select("conv_id", "pos", "turn", "same", "initial", "fault", "edit", "before", "after", "to")
    texts = rows.select("conv_id", "turn", same("role", "text").alias("same"), "role", "text").groupBy("conv_id", "turn", "same").agg(
        F.first("role").alias("role"), F.first("text").alias("text")
    )
    texts = texts.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "same")], "role", "text")
    equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "turn", "same")]
    stay = e.where("edit <> 'D'").join(texts, equal[0] & equal[1] & equal[2])
    role = F.when(F.col("to") == "u", "user").when(F.col("to") == "a", "assistant").otherwise(F.col("role"))
    columns = ["conv_id", "pos", "turn", "initial", "fault", "edit", "before", "after"]
    gone = e.where("edit = 'D'").select(*columns, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return stay.select(*columns, role.alias("role"), "text").unionByName(gone)


REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Told:
    """One conversation's report, told row by row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.faults = conv_id, {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.turn = self.initial = None
        self.turns = self.illegal = self.cost = self.lines = 0
        self.audit, self.sha = [], hashlib.sha256()

    def line(self, role: str, text: str):
        self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self, initials: str):
        for c in initials:
            self.line("user" if c == "u" else "assistant", "")
            self.audit.append("I")
            self.cost += INSERT

    def row(self, turn, initial, fault, letter, inserted, after, role, text):
        if turn is not None and turn != self.turn:
            self.first, self.turn, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        if fault:
            self.faults[fault] += 1
        self.insert(inserted)
        self.audit.append(letter)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE}[letter]
        if letter != "D":
            self.cost += TRUNCATED * (fault == "truncated")
            self.line(role, text)
        self.insert(after)

    def out(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.turns
        return self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


def report(repaired: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """One row per conv_id of ``conv_ids`` (distinct, the column ``conv_id``):
    the columns ``REPORT`` of its ``repair`` rows; zeros, an empty audit and the hash
    of nothing where it has none.

    A digest of a whole conversation can only be taken in order, so its rows are
    streamed through one task, which holds no more than a batch and the audit.
    """
    columns = ["turn", "initial", "fault", "edit", "before", "after", "role", "text"]
    marks = conv_ids.select("conv_id", F.lit(-1).cast("long").alias("pos"))
    rows = repaired.unionByName(marks, allowMissingColumns=True)
    n = int(repaired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("conv_id").asc_nulls_first(), "pos"]

    def run(batches):
        told, done = None, []

        def out():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

        for b in batches:
            for conv_id, pos, *row in zip(*(c.to_pylist() for c in b.columns)):
                if pos < 0:
                    if told:
                        done.append(told.out())
                    told = _Told(conv_id)
                else:
                    told.row(*row)
            if len(done) > 1000:
                yield out()
                done = []
        if told:
            done.append(told.out())
            yield out()

    names = [c.split()[0] for c in REPORT.split(", ")]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    return rows.select("conv_id", "pos", *columns).repartition(n, "conv_id").sortWithinPartitions(*by).mapInArrow(run, REPORT)
