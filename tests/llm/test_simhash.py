import random

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import MESSY

from vellum.llm import simhash


def slow_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps, distance):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]


def test_messy_rows_against_brute_force(frame):
    got = simhash.simhash_groups(frame(MESSY)).collect()
    ids, fps = [r[0] for r in MESSY], [slow_fingerprint(r[1]) for r in MESSY]
    want = zip(ids, fps, slow_components(ids, fps, 2))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(want, key=key)


def test_native_hash_is_the_same(spark, frame):
    text = "Some Words hère"
    assert frame([(1, text)]).select(F.xxhash64(F.lit("some words hère"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest("some words hère", 42)
    assert simhash.fingerprint(text, 3) == xxhash.xxh64_intdigest("some words hère", 42)


def test_every_near_pair_meets_at_an_anchor(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    fps = {0, -1}
    for c in centres.tolist():
        fps.add(c)
        for _ in range(6):
            x = c
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    fps = [int(np.array([x % (1 << 64)], np.uint64).view(np.int64)[0]) for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long"), 2).collect()
    assert all(bin((a ^ b) % (1 << 64)).count("1") > 0 for a, b in links)
    u = [x % (1 << 64) for x in fps]
    want = slow_components(u, u, 2)
    root = {x: x for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a % (1 << 64)), find(b % (1 << 64))
        root[max(a, b)] = min(a, b)
    assert [find(x) for x in u] == want


def test_large_anchors_look_up_neighbours(monkeypatch):
    rng = np.random.default_rng(2)
    base = int(rng.integers(0, 1 << 62))
    fp = np.unique(np.array([base ^ (1 << int(i)) ^ (1 << int(j)) for i, j in rng.integers(46, 62, (200, 2))], np.int64))
    anchor, home = np.zeros(len(fp), np.int64), np.ones(len(fp), bool)
    plain = simhash._compare(anchor, fp, home, 2)
    monkeypatch.setattr(simhash, "DENSE", 1)
    dense = simhash._compare(anchor, fp, home, 2)
    assert [x.tolist() for x in plain] == [x.tolist() for x in dense] and len(plain[0])


def test_one_of_each_group_stays_and_empty_table(frame):
    docs = frame(MESSY)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    roots = slow_components([r[0] for r in MESSY], [slow_fingerprint(r[1]) for r in MESSY], 2)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, set(roots)))
    assert simhash.simhash_groups(frame([])).count() == 0
    assert simhash.keep_one(frame([])).count() == 0


def test_components_with_hubs(spark, monkeypatch):
    """Stars whose centre is small, large or in between, chained to one another."""
    from vellum.llm import graph

    monkeypatch.setattr(graph, "DEGREE", 5)
    r = random.Random(9)
    edges = [(0, i) for i in range(1, 200)] + [(1000, i) for i in range(300, 400)] + [(450, i) for i in range(400, 500)]
    edges += [(399, 400), (2000, 2001), (2001, 2002), (2000, 2000)] + [(3000 + i, 3001 + i) for i in range(60)]
    r.shuffle(edges)
    got = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "p long, q long"), "p", "q").collect()}
    want = {i: 0 for i in range(200)} | {i: 300 for i in [*range(300, 500), 1000]} | {i: 2000 for i in (2000, 2001, 2002)} | {3000 + i: 3000 for i in range(61)}
    assert got == want


def test_of_equal_rows_the_same_one_stays(spark):
    rows = [(1, "a text of five words", s) for s in "cab"]
    for _ in range(3):
        random.shuffle(rows)
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
        assert [tuple(x) for x in kept] == [(1, "a text of five words", "a")]
