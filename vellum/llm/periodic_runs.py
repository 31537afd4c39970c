"""Periodic runs of words, found by multi-scale minimizers.

A run is a maximal stretch of consecutive words whose smallest period q is so
short that the stretch is at least ``times`` periods and ``least`` words long.

Periods are taken in scales lo..hi with hi < 1.5 lo.  At a scale every word
begins a ``hi``-gram, and of every (times - 1) lo - hi + 1 consecutive grams the
smallest hash is kept.  Inside a run of a period of that scale some such window
lies in the run together with its copy one period on, so a kept gram stands at
both places; and no equal gram stands between them, as a gram as long as the
period that also repeats at a shorter distance would make that distance a
period.  So neighbouring equal minimizers at a distance of the scale are seeds,
and each seed is extended both ways by comparing words at its distance.
Periods below ``SHORT`` are too short for windows: the lags are scanned as they
are.  A stretch found at a multiple of its smallest period has the same ends as
the run of that period and is left out.

Extensions compare the words themselves, so no run is made up; one could be
missed only if two different grams of one document had an equal 64-bit hash.

Documents are looked at where they lie, with no shuffle: a task joins the texts of
``SLICE`` bytes (or one longer text), parted by separators that equal nothing,
and works on them as one array.  Memory grows with a slice or the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 24, 3  # words, periods
SHORT = 8  # the first period that is looked for by minimizers
SLICE = 4 << 20  # bytes of text worked on at once
EXTEND = 64  # words compared at first when a seed is extended

RUN = "struct<start: long, length: long, period: long>"


def _mix(a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit hash of pairs (multiplications with odd numbers and shifts)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (np.minimum, np.maximum) over every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = of(x[:-done], x[done:])
        done *= 2
    return x if done == width else of(x[: len(x) - (width - done)], x[width - done :])


def _stretches(x: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of ``least`` or more places
    that equal the place ``lag`` on."""
    breaks = np.flatnonzero(np.r_[True, x[:-lag] != x[lag:], True])
    n = np.diff(breaks) - 1
    long = n >= least
    return breaks[:-1][long], n[long]


def _extend(x: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` of places that equal the place ``lag`` on."""
    end, step = at, EXTEND
    while True:
        b = x[end + lag : end + lag + step]
        differs = np.flatnonzero(x[end : end + len(b)] != b)
        if len(differs) or len(b) < step:
            end += int(differs[0]) if len(differs) else len(b)
            break
        end, step = end + step, step * 2
    start, step = at, EXTEND
    while start:
        n = min(step, start)
        differs = np.flatnonzero(x[start - n : start] != x[start - n + lag : start + lag])
        if len(differs):
            return start - n + int(differs[-1]) + 1, end
        start, step = start - n, step * 2
    return start, end


def _seeds(grams: np.ndarray, lo: int, hi: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of neighbouring equal minimizers lo..hi apart, by
    distance and place."""
    minima = _sliding(grams, window, np.minimum)
    # a gram is a window's minimum if the largest minimum of its windows is its own hash
    edge = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, minima, edge]), window, np.maximum) == grams)
    at = at[np.argsort(grams[at], kind="stable")]
    apart = np.diff(at)
    found = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (apart >= lo) & (apart <= hi))
    place, lag = at[found], apart[found]
    order = np.lexsort((place, lag))
    return place[order], lag[order]


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period) by document, start, period.

    ``ids``: word numbers (0 or more) of all documents, one after the other, of
    ``sizes`` words each.
    """
    if times < 3:
        raise ValueError("runs of fewer than 3 periods have no window of minimizers")
    found = []

    def note(start, matched, lag):
        document = np.searchsorted(first, start, "right") - 1
        found.append(np.stack([docs[document], start - first[document], matched + lag, np.broadcast_to(lag, start.shape)], axis=1))

    docs = np.flatnonzero(sizes >= max(least, times))
    # every document followed by a separator that equals nothing
    x = np.full(len(ids) + len(sizes), -1, np.int64)
    word = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
    x[word] = ids
    x[np.cumsum(sizes + 1) - 1] = -1 - np.arange(len(sizes))
    wide = sizes + 1
    x = x[np.repeat(sizes >= max(least, times), wide)]
    first = np.cumsum(wide[docs]) - wide[docs]
    for lag in range(1, SHORT):
        if len(x) > lag:
            note(*_stretches(x, lag, max(least - lag, (times - 1) * lag)), lag)

    lo, width, grams = SHORT, 1, _mix(x.view(np.uint64))
    while True:
        hi = max(lo, (3 * lo - 1) // 2)
        enough = sizes[docs] >= max(least, times * lo)
        if not enough.all():
            kept = np.repeat(enough, wide[docs])
            x, grams, docs = x[kept], grams[kept], docs[enough]
            first = np.cumsum(wide[docs]) - wide[docs]
        if not len(docs):
            break
        tail = np.arange(len(x), dtype=np.uint64) + np.uint64(1 << 63)  # grams over the end: all different
        while 2 * width <= hi:
            grams = np.concatenate([_mix(grams[:-width], grams[width:]), _mix(tail[:width])])
            width *= 2
        window = (times - 1) * lo - hi + 1
        place, lag = _seeds(_mix(grams[: len(x) - hi + 1], grams[hi - width : len(x) - width + 1]), lo, hi, window)
        stretches, seen, of = [], -1, 0
        for p, q in zip(place.tolist(), lag.tolist()):
            if q == of and p < seen:
                continue
            start, end = _extend(x, p, q)
            of, seen = q, max(end, p + 1)
            if end - start >= max(least - q, (times - 1) * q):
                stretches.append((start, end - start, q))
        if stretches:
            note(*np.array(stretches).T)
        lo = hi + 1
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort(runs.T[::-1])]  # by document, start, length, period
    runs = runs[np.r_[True, (runs[1:, :3] != runs[:-1, :3]).any(1)]] if len(runs) else runs
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _report(ids: list, texts: list[list[bytes]], least: int, times: int) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in texts], np.int64)
    every = [w for words in texts for w in words]
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    numbers = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    runs = find_runs(numbers, sizes, least, times)
    edges = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    collapsed = []
    for words, a, b in zip(texts, edges.tolist(), edges[1:].tolist()):
        if a < b:
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, runs[a:b, 1] + runs[a:b, 3], 1)
            np.add.at(gone, runs[a:b, 1] + runs[a:b, 2], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(words))
    spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
    spans = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes), spans, pa.array(collapsed, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (array of
    ``start``, ``length``, ``period`` in words, by start and period) and
    ``collapsed`` (the words, joined by one space, without those that a run
    contains after its first period).

    Words are what stands between ASCII white space and are equal by their bytes.
    ``change`` may put other words in the place of a document's.  Null and empty
    texts have no words, no runs and an empty ``collapsed``; repeated rows and ids
    stay, each judged for itself; a null doc_id stays null; an empty table gives no
    rows; other columns are not looked at.  Overlapping runs are all reported.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py() or b""
                words = t.split()
                ids.append(i)
                texts.append(change(i, words) if change else words)
                held += len(t)
                if held >= SLICE:
                    yield _report(ids, texts, least, times)
                    ids, texts, held = [], [], 0
        if ids:
            yield _report(ids, texts, least, times)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = d.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the most periods (exact fractions; ties: smallest start, then
    period); null where there is none.  ``runs``: by start and period."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))
