"""Periodic runs against a scan of every lag, and the query against its rule."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.conftest import LONG, MESSY

from vellum.llm import periodic_runs, queries


def every_lag(w, least=24, times=3):
    """(start, length, period) of all runs, by start and period."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= max(least - q, (times - 1) * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(r):
    n, k = r.choice([0, 1, 5, 23, 24, 30, 60, 120, 300, 700]), r.choice([1, 2, 3, 10, 1000])
    w = [r.randrange(k) for _ in range(n)]
    for _ in range(r.choice([0, 1, 2, 4]) if n > 9 else 0):
        p, a = r.randrange(1, n // r.choice([3, 4, 9]) + 1), r.randrange(n)
        for i in range(a + p, r.randrange(a, n + 1)):
            w[i] = w[i - p]
    return w


def test_runs_equal_a_scan_of_every_lag():
    r = random.Random(1)
    for _ in range(30):
        docs = [random_words(r) for _ in range(20)]
        got = periodic_runs.find_runs(np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs]))
        assert [tuple(x) for x in got.tolist()] == [(i, *x) for i, d in enumerate(docs) for x in every_lag(d)]


@pytest.mark.parametrize("rule", [("a", "ab", "abaab"), ("a", "ab", "ba")])
def test_words_built_to_repeat(rule):
    """Fibonacci and Thue-Morse words: equal stretches at every scale."""
    _, a, b = rule[0], rule[1], rule[2]
    w = "a"
    while len(w) < 1500:
        w = "".join(a if c == "a" else b for c in w)
    got = periodic_runs.find_runs(np.array([ord(c) for c in w], np.int64), np.array([len(w)]))
    assert [tuple(x) for x in got.tolist()] == [(0, *x) for x in every_lag(w)]


def test_other_bounds():
    w = [1, 2, 3] * 4 + list(range(10, 60)) * 5
    one = lambda **k: [tuple(x[1:]) for x in periodic_runs.find_runs(np.array(w, np.int64), np.array([len(w)]), **k).tolist()]
    assert one(least=10, times=4) == every_lag(w, 10, 4) == [(0, 12, 3), (12, 250, 50)]
    assert one(least=10, times=6) == []
    with pytest.raises(ValueError):
        one(times=2)


def expected(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if i is not None and n and zlib.crc32(str(i).encode()) % 10 == 0:
        g = zlib.crc32(str(i).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
    runs = every_lag(words)
    gone = {j for s, m, q in runs for j in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for j, x in enumerate(words) if j not in gone)))


def test_query_on_messy_rows(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE", 2000)
    r = random.Random(2)
    rows = [m for m in MESSY if not (m[1] or "").startswith(LONG)]
    rows += [(i, " ".join(f"w{x}" for x in random_words(r))) for i in range(100, 180)]
    rows += [(200, "again " * 3000), (None, "x y\tz\n" * 30), (201, "one two three four " * 50), (201, "one two three four " * 50)]
    rows += [(300 + i, " ".join(f"u{r.randrange(50)}" for _ in range(200))) for i in range(60)]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(x) for x in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(*x[:2]) for x in rows), key=str)
    assert sum(zlib.crc32(str(x[0]).encode()) % 10 == 0 for x in rows) > 5


def test_long_texts_and_empty_table(spark, frame):
    block = " ".join(f"b{i}" for i in range(3000))
    got = periodic_runs.periodic_runs(frame([(1, LONG), (2, " ".join([block] * 7)), (3, None)])).collect()
    got = {x.doc_id: x for x in got}
    assert [tuple(x) for x in got[1].runs] == [(0, 40_000, 10_007)] and got[1].n_words == 40_000 and got[3].collapsed == ""
    assert [tuple(x) for x in got[2].runs] == [(0, 21_000, 3000)] and got[2].collapsed == block
    assert periodic_runs.periodic_runs(frame([])).count() == 0
