"""Repeated byte strings, found by refining buckets of suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id.  Suffixes are told apart only as deep as that
needs, by bucket-pointer refinement:

* Initial buckets are q-grams (``GRAM`` bytes).  A bucket's identifier is a hash
  of its string, doubled up from shorter ones: the identifier at depth 2h is
  made of those at offsets 0 and h, so no rank has to be looked up elsewhere.
  Of the suffixes, each window of ``LENGTH`` bytes keeps the one whose
  identifier is smallest (its anchor): equal windows keep equal anchors, and
  one suffix in about sixteen remains.
* Tasks count the buckets.  One that lies in a single document is finished.
  The others are refined by the identifier of the anchor's whole context (all
  windows that keep this anchor): in a bucket of equal contexts the first
  document keeps the string and all others lose it as a whole.
* Only buckets that fell into several contexts have windows that may still
  agree.  The bytes of those contexts are fetched, one place each, and refined
  in earnest: ranks of 8 bytes, then of 16, 32 and 50, each by sorting on the
  ranks before at a later offset.

Places of one batch with one context are merged before anything is sent, and
what they lose is known at once.  A bucket with more than ``HOT`` contexts in a
batch (the edge of a passage of very many documents) is not gathered at all:
its windows go, one by one, through a sum by string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import written

LENGTH, GRAM = 50, 20
PIECE = 1 << 18  # bytes worked on at once, about
ROWS = 4096  # documents of a batch
BUCKET = 16 << 20  # bytes of text a bucket task stands for
U = np.uint64
_rng = np.random.default_rng(20)
LETTER = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
STEP = {h: U(int(_rng.integers(1 << 62, 1 << 63)) * 2 + 1) for h in (1, 2, 4, 8, 16, 20)}
HOT = 64  # contexts of a bucket in one batch
CHUNK = 1 << 21  # context bytes refined at once, unless one bucket has more
WEIGHTS = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * U(2) + U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _identifiers(data: np.ndarray) -> dict[int, np.ndarray]:
    """Bucket identifiers of every suffix at depths 1, 2, 4, ... (doubling)."""
    at = {1: LETTER[data]}
    h = 1
    while 2 * h <= LENGTH:
        x = at[h]
        at[2 * h] = x[: max(0, len(x) - h)] * STEP[h] + x[h:]
        h *= 2
    return at


def _deepened(at: dict[int, np.ndarray], depth: int, where: np.ndarray | None = None) -> np.ndarray:
    """Identifiers at another depth, of all suffixes or of some: those of its
    powers of two, put together at their offsets."""
    n = len(at[1]) - depth + 1
    out, done = None, 0
    while done < depth:
        h = 1 << ((depth - done).bit_length() - 1)
        x = at[h][done : done + n] if where is None else at[h][where + done]
        out = x if out is None else out * STEP[20] + x
        done += h
    return _mixed(out)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    h = 1
    while 2 * h <= width:
        x = np.minimum(x[: len(x) - h], x[h:])
        h *= 2
    rest = width - h
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Of texts that lie one after another in ``data``: for each anchor its
    text, bucket identifier, context identifier, first window (from ``start``)
    and last minus first."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none.astype(U), none.astype(U), none, none
    at = _identifiers(data)
    ids = _deepened(at, GRAM)
    ranked = (ids & U(0xFFFFFFFF00000000)) | np.arange(len(ids), dtype=U)
    own = (_smallest(ranked, LENGTH - GRAM + 1) & U(0xFFFFFFFF)).astype(np.int64)[:n]
    text = np.repeat(np.arange(len(start)), end - start)[:n]
    valid = np.flatnonzero(np.arange(n) + LENGTH <= end[text])
    own, text = own[valid], text[valid]
    new = np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1])] if len(valid) else np.zeros(0, bool)
    i = np.flatnonzero(new)
    j = np.r_[i[1:], len(valid)] - 1 if len(i) else i
    more = valid[j] - valid[i]
    # two overlapping windows and their distance say what the whole context is
    context = _mixed(_deepened(at, LENGTH, valid[i]) * STEP[1] + _deepened(at, LENGTH, valid[j]) * STEP[2] + more.astype(U))
    return text[i], ids[own[i]], context, valid[i] - start[text[i]], more


def _pieces(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes in pieces of bounded size: rows, data, start and end of each text
    part in it, and the part's offset in its text.  Long texts are cut so that
    every window lies in one part."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    rows, froms, ends = [], [], []
    for i in range(len(texts)):
        for a in range(int(offsets[i]), max(int(offsets[i]) + 1, int(offsets[i + 1]) - LENGTH + 1), PIECE):
            rows.append(i)
            froms.append(a)
            ends.append(min(int(offsets[i + 1]), a + PIECE + LENGTH - 1))
    rows, froms, ends = np.array(rows, np.int64), np.array(froms, np.int64), np.array(ends, np.int64)
    lens = np.maximum(0, ends - froms)
    k = 0
    while k < len(rows):
        m = k + max(1, int(np.searchsorted(np.cumsum(lens[k:]), 2 * PIECE, "right")))
        data = np.concatenate([raw[a : a + n] for a, n in zip(froms[k:m], lens[k:m])])
        e = np.cumsum(lens[k:m])
        yield rows[k:m], data, e - lens[k:m], e, froms[k:m] - offsets[rows[k:m]]
        k = m


def _all_anchors(texts: pa.Array):
    parts = []
    for rows, data, start, end, off in _pieces(texts):
        t, ids, context, first, more = anchors(data, start, end)
        parts.append((rows[t], ids, context, first + off[t], more))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none.astype(U), none.astype(U), none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def _packed(x: np.ndarray, kind: str) -> bytes:
    """Numbers byte plane by byte plane: the high ones compress."""
    return np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _new(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before in some key."""
    out = np.zeros(len(keys[0]), bool)
    if len(out):
        out[0] = True
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def _spread(values: np.ndarray, new: np.ndarray, how) -> np.ndarray:
    """``how`` (a ufunc) of each group of sorted rows, at every row."""
    start = np.flatnonzero(new)
    return how.reduceat(values, start)[np.cumsum(new) - 1] if len(values) else values


#: places of a bucket task (``doc`` points into ``doc_ids``) and what is known of places
SENT = pa.schema([("part", pa.int64()), ("known", pa.bool_()), ("doc_ids", pa.binary()), ("hs", pa.binary()), ("low", pa.binary()), ("mid", pa.binary()),
                  ("context", pa.binary()), ("doc", pa.binary()), ("at", pa.binary()), ("more", pa.binary())])
SENT_DDL = "part long, known boolean, doc_ids binary, hs binary, low binary, mid binary, context binary, doc binary, at binary, more binary"
FOUND = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("kind", pa.int32()), ("at", pa.binary()), ("more", pa.binary()), ("gram", pa.binary())])
FOUND_DDL = "doc_id long, h long, kind int, at binary, more binary, gram binary"
LOST, OPEN, OPEN_HOT = 0, 1, 2
SHARED, VERY = 0x80, 0x40  # flags beside a span of at most LENGTH - GRAM


def _table(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _results(doc, kind, at, more, gram, doc_ids, hs) -> list[tuple]:
    """One FOUND row for each document and kind."""
    order = np.lexsort((at, kind, doc))
    doc, kind, at, more, gram = (x[order] for x in (doc, kind, at, more, gram))
    start = np.flatnonzero(_new(doc, kind))
    out = []
    for s, e in zip(start.tolist(), [*start[1:].tolist(), len(doc)]):
        d = doc[s]
        out.append((int(doc_ids[d]), int(hs[d]), int(kind[s]), at[s:e].astype(np.int32).tobytes(), more[s:e].astype(np.uint8).tobytes(),
                    gram[s:e].tobytes() if kind[s] == OPEN else b""))
    return out


def refined_anchors(texts: DataFrame, buckets: int) -> DataFrame:
    """``doc_id``, ``h``, ``kind``, ``at``, ``more``, ``gram``: the anchors' contexts
    that a document loses as a whole (LOST) and those of which single windows may
    still be lost (OPEN: first place of a context in a bucket with several)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(0, batch.num_rows, ROWS):
                out = sent(batch.slice(n, ROWS))
                for i in range(0, len(out), 256):
                    yield _table(out[i : i + 256], SENT)

    def sent(batch: pa.RecordBatch) -> list[tuple]:
        doc_ids, hs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        row, ids, context, at, more = _all_anchors(batch.column(2))
        if not len(ids):
            return []
        order = np.lexsort((doc_ids[row], context, ids))
        row, ids, context, at, more = (x[order] for x in (row, ids, context, at, more))
        i = doc_ids[row]
        bucket, parted = _new(ids), _new(ids, context)
        shared = _spread(i, bucket, np.minimum) != _spread(i, bucket, np.maximum)
        very = _spread(parted.astype(np.int64), bucket, np.add) > HOT
        lost = i > _spread(i, parted, np.minimum)
        out = []
        kind = np.where(lost, LOST, OPEN_HOT)
        k = np.flatnonzero(lost | very)
        for r in _results(row[k], kind[k], at[k], more[k], ids[k], doc_ids, hs):
            part = buckets + abs(r[1]) % buckets
            out.append((part, True, np.int64(r[0]).tobytes(), np.int64(r[1]).tobytes(), np.int64(r[2]).tobytes(), b"", b"", b"", r[3], r[4]))
        # one place of a very common bucket tells the others about it
        k = np.flatnonzero(~lost & (~very | bucket))
        flag = np.where(shared[k], SHARED, 0) | np.where(very[k], VERY, 0)
        part = (ids[k] >> U(40)).astype(np.int64) % buckets
        by = np.lexsort((ids[k] & U((1 << 40) - 1), part))
        begin = np.flatnonzero(_new(part[by]))
        for s, e in zip(begin.tolist(), [*begin[1:].tolist(), len(by)]):
            j = by[s:e]
            x = ids[k[j]] & U((1 << 40) - 1)
            step = np.diff(x, prepend=U(0))  # rising: small steps
            used, doc = np.unique(row[k[j]], return_inverse=True)
            out.append((int(part[j[0]]), False, _packed(doc_ids[used], "<i8"), _packed(hs[used], "<i8"), _packed(step & U(0xFFFFFFFF), "<u4"),
                        _packed(step >> U(32), "<u1"), context[k[j]].tobytes(), _packed(doc, "<u4"), _packed(at[k[j]], "<i4"), _packed(more[k[j]] | flag[j], "<u1")))
        return out

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                if x["known"]:
                    one = lambda c: int(np.frombuffer(x[c], np.int64)[0])  # noqa: B023, E731
                    rows.append((one("doc_ids"), one("hs"), one("low"), x["at"], x["more"], b""))
                else:
                    step = _unpacked(x["low"], "<u4").astype(U) | (_unpacked(x["mid"], "<u1").astype(U) << U(32))
                    held.setdefault(x["part"], []).append((
                        np.cumsum(step, dtype=U), np.frombuffer(x["context"], U), _unpacked(x["doc"], "<u4"), _unpacked(x["at"], "<i4"),
                        _unpacked(x["more"], "<u1"), _unpacked(x["doc_ids"], "<i8"), _unpacked(x["hs"], "<i8"),
                    ))
            if rows:
                yield _table(rows, FOUND)
        for part, pieces in held.items():
            sizes = np.cumsum([0, *(len(p[5]) for p in pieces)])
            ids, context, at, flags, doc_ids, hs = (np.concatenate([p[c] for p in pieces]) for c in (0, 1, 3, 4, 5, 6))
            doc = np.concatenate([p[2] + np.uint32(s) for p, s in zip(pieces, sizes)])
            pieces.clear()
            order = np.lexsort((context, ids))
            ids, context, at, flags, doc = (x[order] for x in (ids, context, at, flags, doc))
            i = doc_ids[doc]
            bucket, parted = _new(ids), _new(ids, context)
            shared = (_spread(i, bucket, np.minimum) != _spread(i, bucket, np.maximum)) | (_spread(flags & SHARED, bucket, np.maximum) > 0)
            very = _spread(flags & VERY, bucket, np.maximum) > 0
            several = (_spread(parted.astype(np.int64), bucket, np.add) > 1) | very
            lost = i > _spread(i, parted, np.minimum)
            told = (flags & VERY) > 0  # went ahead from its own batch
            k = np.flatnonzero(~told & (lost | (shared & several)))
            kind = np.where(lost, LOST, np.where(very, OPEN_HOT, OPEN))
            gram = ids | (U(part) << U(40))
            rows = _results(doc[k], kind[k], at[k], flags[k] & 0x3F, gram[k], doc_ids, hs)
            for n in range(0, len(rows), 4096):
                yield _table(rows[n : n + 4096], FOUND)

    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    return texts.mapInArrow(send, SENT_DDL).repartition(n, "part").mapInArrow(refine, FOUND_DDL)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed texts with FOUND lists -> the bytes of each open context."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for doc_id, h, packed, found in zip(*(c.to_pylist() for c in batch.columns[:4])):
            raw = unpack(packed)
            for f in found:
                at, more = np.frombuffer(f["at"], np.int32).tolist(), np.frombuffer(f["more"], np.uint8).tolist()
                gram = np.frombuffer(f["gram"], np.int64).tolist() if f["kind"] == OPEN else [None] * len(at)
                for c, v in zip(rows, ([doc_id] * len(at), [h] * len(at), at, gram, [raw[a : a + m + LENGTH] for a, m in zip(at, more)])):
                    c += v
            if len(rows[0]) > 20_000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, OPENED)], ["doc_id", "h", "at", "gram", "context"])
                rows = ([], [], [], [], [])
        yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, OPENED)], ["doc_id", "h", "at", "gram", "context"])


OPENED = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
OPENED_DDL = "doc_id long, h long, at long, gram long, context binary"


def _ranked(keys: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Bucket numbers of pairs of bucket numbers."""
    return np.unique(keys * (int(later.max(initial=0)) + 1) + later, return_inverse=True)[1].astype(np.int64)


def window_ranks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers of the LENGTH-byte strings at the starts, equal for equal
    strings: buckets of 8 bytes, refined to 16, 32 and LENGTH by sorting on the
    bucket numbers at later offsets."""
    n = len(data) - 7
    eights = np.zeros(max(0, n), U)
    for i in range(8):
        eights |= data[i : i + n].astype(U) << U(8 * i)
    rank, depth = np.unique(eights, return_inverse=True)[1].astype(np.int64), 8
    while 2 * depth <= LENGTH:
        rank, depth = _ranked(rank[: len(rank) - depth], rank[depth:]), 2 * depth
    return _ranked(rank[starts], rank[starts + LENGTH - depth])


def _contexts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all contexts, and row, offset in the row and place of each window."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    n = np.diff(offsets) - LENGTH + 1
    row = np.repeat(np.arange(len(column)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return data, row, k, offsets[row] + k


def _refine_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open contexts, sorted by bucket -> windows that stand in an earlier document."""
    held: list[pa.RecordBatch] = []

    def done(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        doc, gram = t.column("doc_id").to_numpy(), t.column("gram").to_numpy()
        data, row, k, place = _contexts(t.column("context").combine_chunks() if t.column("context").num_chunks != 1 else t.column("context").chunk(0))
        rank = window_ranks(data, place)
        order = np.lexsort((rank, gram[row]))
        rank, g, i = rank[order], gram[row][order], doc[row][order]
        lost = np.sort(order[i > _spread(i, _new(rank, g), np.minimum)])
        at = t.column("at").to_numpy()[row[lost]] + k[lost]
        return pa.record_batch([pa.array(doc[row[lost]]), pa.array(t.column("h").to_numpy()[row[lost]]), pa.array(at)], ["doc_id", "h", "at"])

    for batch in batches:
        held.append(batch)
        if sum(b.column(4).nbytes for b in held) > CHUNK:
            t = pa.Table.from_batches(held)
            g = t.column("gram").to_numpy()
            whole = int(np.searchsorted(g, g[-1]))
            if whole:
                yield done(t.slice(0, whole))
                held = t.slice(whole).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield done(pa.Table.from_batches(held))


def _hash_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open contexts -> 128-bit identifiers of their windows."""
    for batch in batches:
        for n in range(0, batch.num_rows, 2048):
            b = batch.slice(n, 2048)
            data, row, k, place = _contexts(b.column(4))
            strings = data[place[:, None] + np.arange(LENGTH)].astype(U) + U(1)
            one, two = (_mixed((strings * w[:LENGTH]).sum(1, dtype=U)).view(np.int64) for w in WEIGHTS)
            cols = [pa.array(one), pa.array(two), *(pa.array(b.column(c).to_numpy()[row]) for c in (0, 1)), pa.array(b.column(2).to_numpy()[row] + k)]
            yield pa.record_batch(cols, ["one", "two", "doc_id", "h", "at"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, for the way to where they are joined."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for n in range(0, batch.num_rows, 1024):
            b = batch.slice(n, 1024)
            yield pa.record_batch([b.column(0), b.column(1), pa.array([pack(t.as_buffer()) for t in b.column(2)], pa.binary())], ["doc_id", "h", "text"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed texts with lost ranges -> what is left."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        out = []
        for doc_id, h, packed, found in zip(*(c.to_pylist() for c in batch.columns[:4])):
            data = memoryview(unpack(packed))
            lo = np.concatenate([np.frombuffer(f["at"], np.int32) for f in found]).astype(np.int64)
            hi = lo + np.concatenate([np.frombuffer(f["more"], np.uint8) for f in found]) + LENGTH
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
            a, z = lo[new], hi[np.r_[new[1:], len(lo)] - 1]
            kept = b"".join(data[x:y] for x, y in zip([0, *z.tolist()], [*a.tolist(), len(data)]))
            out.append((doc_id, h, int((z - a).sum()), len(new), hashlib.sha256(kept).hexdigest(), kept))
            if len(out) >= 512:
                yield _table(out, CUT)
                out = []
        if out:
            yield _table(out, CUT)


CUT = pa.schema([("id", pa.int64()), ("g", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and ``kept`` (the bytes
    left, null where nothing was removed).

    Null texts are empty; a row whose doc_id is null neither loses bytes nor
    makes others lose any; rows of one doc_id don't make each other lose bytes;
    an empty table gives no rows; other columns are not looked at.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    long = d.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select("doc_id", "h", "text")
    total = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = written(refined_anchors(long, 1 + total // BUCKET), "refined")

    def with_texts(lists: DataFrame) -> DataFrame:
        """Packed texts of the documents in ``lists`` and their FOUND rows."""
        per_doc = lists.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("g")).agg(F.collect_list(F.struct("kind", "at", "more", "gram")).alias("found"))
        packed = long.mapInArrow(_pack, "doc_id long, h long, text binary")
        both = packed.join(per_doc, (F.col("doc_id") == F.col("id")) & (F.col("h") == F.col("g")))
        return both.select("doc_id", "h", "text", "found").dropDuplicates(["doc_id", "h"])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    opened = written(with_texts(found.where(F.col("kind") != LOST)).mapInArrow(_opened, OPENED_DDL), "open-contexts")
    refined = opened.where("gram is not null").repartition(n, "gram").sortWithinPartitions("gram").mapInArrow(_refine_open, "doc_id long, h long, at long")
    windows = written(opened.where("gram is null").mapInArrow(_hash_open, "one long, two long, doc_id long, h long, at long"), "common-windows")
    least = written(windows.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high"), "common-firsts")
    common = windows.join(least, ["one", "two"]).where("low < doc_id").select("doc_id", "h", "at")
    # windows as FOUND rows: places as 32-bit numbers (little-endian), spans 0
    singles = refined.union(common).groupBy("doc_id", "h").agg(F.collect_set("at").alias("at"))
    little = lambda i: F.lpad(F.hex(i), 8, "0")
    digits = F.transform("at", lambda i: F.concat(*[F.substring(little(i), 2 * b + 1, 2) for b in (3, 2, 1, 0)]))
    singles = singles.select(
        "doc_id", "h", F.lit(LOST).alias("kind"), F.unhex(F.array_join(digits, "")).alias("at"), F.unhex(F.repeat(F.lit("00"), F.size("at"))).alias("more"), F.lit(b"").alias("gram")
    )
    cut = with_texts(found.where(F.col("kind") == LOST).unionByName(singles))
    cut = cut.mapInArrow(_cut, "id long, g long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    heads = d.select("doc_id", "h", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    out = heads.join(cut, (F.col("doc_id") == F.col("id")) & (F.col("h") == F.col("g")), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                      F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")
