import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import MESSY

from vellum.llm import embedding_dedup, mixing
from vellum.llm.graph import components


def slow_links(rows, least=0.98):
    usable = {}
    for n, (_, e, label) in enumerate(rows):
        if label is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            usable[n] = np.array(e, np.float64)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in usable:
        for j in usable:
            if j < i and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]):
                a, b = usable[i], usable[j]
                if (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    return [(rows[i][0], links[i], min(rows[j][0] for j in range(len(rows)) if find(j) == find(i))) for i in range(len(rows))]


def vectors(seed=3, dim=32):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(30):
        x = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), (x + rng.standard_normal(dim) * 0.08).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows) + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies
    n = len(rows)
    rows += [(n, rows[0][1], None), (n + 1, None, 1), (n + 2, [], 1), (n + 3, [0.0] * dim, 1), (n + 4, [float("nan")] + [1.0] * (dim - 1), 1),
             (n + 5, [None] + [1.0] * (dim - 1), 1), (n + 6, [float("inf")] * dim, 1), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1), (n + 9, [1e-30] * dim, 2), (n + 10, [3e30] * dim, 2)]
    return rows


def test_vector_links(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in ("rep", "vector", "filter", "n", "dim", "usable")})
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect())
    want = slow_links([(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], y) for i, e, y in rows])
    assert got == sorted((i, n, c, i == c) for i, n, c in want)
    monkeypatch.setattr(embedding_dedup, "PIECE", 3)  # filters cut into pieces
    pieces = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect())
    assert pieces == got
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_recall_near_the_threshold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((4000, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * y
    codes = embedding_dedup.directions(64, 71)
    sets = []
    for v in (x, y):
        found = embedding_dedup.decode(v, codes, embedding_dedup.CAPS)
        sets.append([set(r) for r in found.tolist()])
        # list decoding finds the best of all filters
        full = np.stack([np.add.outer(a, b).ravel() for a, b in zip(v[:50, :32] @ codes[0].T, v[:50, 32:] @ codes[1].T)])
        assert [set(r) for r in np.argsort(-full, axis=1)[:, : embedding_dedup.CAPS].tolist()] == sets[-1][:50]
    assert sum(bool(a & b) for a, b in zip(*sets)) / len(x) > 0.999


def test_components_of_long_paths_and_stars(spark):
    r = random.Random(2)
    path = list(range(1000, 1200))
    r.shuffle(path)
    edges = [*zip(path, path[1:]), *((5, i) for i in range(6, 60)), (3, 3), (7, 5), (2000, 2001)]
    got = dict(tuple(x) for x in components(spark.createDataFrame(edges, "p long, q long"), "p", "q").collect())
    want = {**{i: 1000 for i in path}, **{i: 5 for i in range(5, 60)}, 2000: 2000, 2001: 2000}
    assert got == want
    assert components(spark.createDataFrame([], "p long, q long"), "p", "q").count() == 0


def highest_quotients(ideal, seats):
    won = [0] * len(ideal)
    for _ in range(seats):
        won[max(range(len(ideal)), key=lambda i: (ideal[i] / (won[i] + 0.5), -i))] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1001])
def test_seats_go_to_the_highest_quotients(spark, seats):
    r = random.Random(seats)
    share = [r.random() ** 3 + 1e-4 for _ in range(23)]
    ideal = [x / sum(share) * seats for x in share]
    df = spark.createDataFrame([("p", i, x, seats) for i, x in enumerate(ideal)] + [("q", 0, 5.0, 5)], "p string, i int, ideal double, seats long")
    won = {(x.p, x.i): x.won for x in mixing.sainte_lague(df, ["p"], "i").collect()}
    assert won.pop(("q", 0)) == 5
    assert [won["p", i] for i in range(23)] == highest_quotients(ideal, seats)


def test_mix_of_messy_and_skewed_sources(frame):
    r = random.Random(1)
    rows = MESSY + [(100 + i, " ".join(["w"] * r.randrange(200)), "big" if i % 3 else f"s{i % 7}") for i in range(400)]
    docs = frame(rows)
    got = mixing.allocate(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({x[2] for x in rows}, key=lambda s: (s is None, (s or "").encode()))
    words = {s: sum(size(x[1]) for x in rows if x[2] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    full = set()
    while True:
        level = (sum(words.values()) - sum(3 * words[s] for s in full)) / max(1, sum(w for s, w in weight.items() if s not in full))
        more = {s for s in sources if s not in full and weight[s] * level >= 3 * words[s]}
        if not more:
            break
        full |= more
    for s in sources:
        mine = [g for g in got if g.source == s]
        target = 3 * words[s] if s in full else weight[s] * level
        assert all(g.source_size == words[s] and abs(g.target - target) < 1e-6 * max(1, target) and g.taken <= 3 * g["size"] for g in mine)
        assert abs(sum(g.taken for g in mine) - target) <= max(8, 0.01 * target)
    again = mixing.allocate(docs.repartition(5)).collect()
    key = lambda g: (str(g.doc_id), g["size"], g.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    by_id = {}
    for m in mixed.collect():
        by_id[m.doc_id] = by_id.get(m.doc_id, 0) + size(m.text)
        source_text = next(x[1] for x in rows if x[0] == m.doc_id and size(x[1]) >= size(m.text))
        assert set(m.text.split()) <= set(source_text.split())
    taken = {}
    for g in got:
        taken[g.doc_id] = taken.get(g.doc_id, 0) + g.taken
    assert by_id == {i: n for i, n in taken.items() if n}
    assert mixing.allocate(frame([])).count() == 0 and mixing.mix(frame([])).count() == 0
    assert [g.taken for g in mixing.allocate(frame([(1, None), (2, "")])).collect()] == [0, 0]
