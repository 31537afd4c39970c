import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vellum.operators import ann, search
from vellum.functions import vectors


def pts(spark, rows):
    return spark.createDataFrame(rows, "point_id bigint, vector array<float>, filename string")


def qs(spark, rows):
    return spark.createDataFrame(rows, "query_id bigint, vector array<float>")


def hits(df):
    return [(r["query_id"], r["rank"], r["point_id"]) for r in df.orderBy("query_id", "rank").collect()]


def test_tie_threshold_filter_and_short(spark):
    p = pts(spark, [(5, [1.0, 0.0], "a"), (3, [1.0, 0.0], "b"), (7, [0.6, 0.8], "a"), (9, [0.0, 1.0], "b")])
    q = qs(spark, [(1, [1.0, 0.0])])
    # tie between 3 and 5 -> lower id first
    assert hits(search.topk(p, q, 2)) == [(1, 1, 3), (1, 2, 5)]
    # score equal to the threshold is kept (0.6), below is not
    h = search.topk(p, q, 5, threshold=0.6)
    assert hits(h) == [(1, 1, 3), (1, 2, 5), (1, 3, 7)]
    # filter before top-k
    qf = q.withColumn("f", F.lit("a"))
    h = search.topk(p, qf, 2, query_filter="f", point_filter="filename", payload=["filename"])
    assert [(r["point_id"], r["filename"]) for r in h.orderBy("rank").collect()] == [(5, "a"), (7, "a")]
    # fewer than k rows
    assert len(hits(search.topk(p, q, 10))) == 4


def test_empty_queries(spark):
    p = pts(spark, [(1, [1.0, 0.0], "a")])
    q = qs(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    h = search.topk(p, q, 3, threshold=0.5)
    assert [r["query_id"] for r in search.empty_queries(q, h).collect()] == [2]


def test_broadcast_and_block_paths_agree(spark):
    rnd = np.random.default_rng(1)
    v = rnd.normal(size=(300, 8)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[10] = v[20]  # exact duplicate vectors -> exact ties
    p = pts(spark, [(int(i), v[i].tolist(), "f%d" % (i % 3)) for i in range(300)])
    q = qs(spark, [(int(i), v[i].tolist()) for i in range(0, 300, 7)])
    a = search.topk(p, q, 4, threshold=0.1).collect()
    b = search.topk(p, q, 4, threshold=0.1, broadcast_limit_bytes=500, points_per_bucket=17).collect()
    key = lambda r: (r["query_id"], r["rank"], r["point_id"], round(r["score"], 9))
    assert sorted(map(key, a)) == sorted(map(key, b))
    # brute force in numpy
    s = v[::7] @ v.T
    for qi, row in zip(range(0, 300, 7), s):
        order = sorted(range(300), key=lambda j: (-row[j], j))[:4]
        got = [r["point_id"] for r in sorted((r for r in a if r["query_id"] == qi), key=lambda r: r["rank"])]
        assert got == [j for j in order if row[j] >= 0.1]


def test_ivf_full_probe_is_exact(spark):
    rnd = np.random.default_rng(2)
    v = rnd.normal(size=(200, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    p = pts(spark, [(int(i), v[i].tolist(), "f") for i in range(200)])
    q = qs(spark, [(int(i), v[i].tolist()) for i in range(0, 200, 9)])
    exact = search.topk(p, q, 5)
    idx = ann.build_ivf(p, 4)
    full = ann.ann_topk(idx, q, 5, nprobe=4)
    assert ann.recall_at_k(full, exact).first()["recall"] == 1.0
    part = ann.ann_topk(idx, q, 5, nprobe=1, points_per_bucket=7)
    r = ann.recall_at_k(part, exact).first()["recall"]
    assert 0.0 < r <= 1.0


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    out = vectors.l2_normalize(df, "a", "u").select("u", vectors.cosine_score("a", "b").alias("c"),
                                                   vectors.dot("a", "b").alias("d")).collect()
    assert [round(x, 6) for x in out[0]["u"]] == [0.6, 0.8] and out[1]["u"] == [0.0, 0.0]
    assert round(out[0]["c"], 6) == 0.6 and out[1]["c"] == 0.0 and out[0]["d"] == 3.0


def test_result_views(spark):
    h = spark.createDataFrame(
        [(1, 1, 0.123456, "f.pdf", 0, 3, 2, 5, "x\n" * 200, 401, "Intro")],
        "query_id bigint, rank int, score double, filename string, chunk_id int, total_chunks int, page int, "
        "total_pages int, text string, char_count int, section string")
    r = search.result_view_g2(h).first()
    assert (r["score"], r["filename"], r["page_info"], r["chunk_info"], r["char_count"]) == (0.1235, "f.pdf", "2/5", "0/3", 401)
    assert r["preview"] == "x " * 150 + "..."
    g1 = search.result_view_g1(h.withColumnRenamed("filename", "source").withColumnRenamed("chunk_id", "chunk")).first()
    assert g1["preview"] == ("x\n" * 200)[:600] + "..." if len("x\n" * 200) > 600 else g1["preview"] == "x\n" * 200


def test_ivf_probes_given_centres_and_filters(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(120, 6)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    p = pts(spark, [(int(i), v[i].tolist(), "f%d" % (i % 2)) for i in range(120)])
    q = qs(spark, [(int(i), v[i].tolist()) for i in range(0, 120, 5)])
    centres = v[[3, 50, 77, 90, 110]].astype(float).tolist()
    idx = ann.build_ivf(p, centres=centres)
    products = v.astype(float) @ np.array(centres).T
    near = {i: np.argsort(-products[i], kind="stable")[:2].tolist() for i in range(120)}
    got = sorted(map(tuple, ann.probe_cells(q, centres, 2).select("query_id", "cell").collect()))
    assert got == sorted((i, c) for i in range(0, 120, 5) for c in near[i])
    full = ann.ann_topk(idx, q, 3, nprobe=5)
    assert ann.recall_at_k(full, search.topk(p, q, 3)).first()["recall"] == 1.0
    hits_ = ann.ann_topk(idx, q.withColumn("f", F.lit("f1")), 4, nprobe=2, query_filter="f", point_filter="filename").collect()
    for i in range(0, 120, 5):
        allowed = [j for j in range(1, 120, 2) if near[j][0] in near[i]]
        want = sorted(allowed, key=lambda j: (-float(v[i].astype(float) @ v[j].astype(float)), j))[:4]
        assert [r["point_id"] for r in sorted(hits_, key=lambda r: r["rank"]) if r["query_id"] == i] == want
    one = ann.ann_topk(idx, q.limit(1), 1, nprobe=1)
    plan = one._jdf.queryExecution().toString()
    assert "cell" in plan and one.count() == 1


def test_rank_does_not_depend_on_layout(spark):
    """Copies of every vector tie: whatever the partitions and the path, the
    smaller id comes first and the scores have the same bits."""
    rnd = np.random.default_rng(4)
    v = rnd.normal(size=(40, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(i + 1000 * c, v[i].tolist(), "f") for i in range(40) for c in (0, 1, 2)]
    p = pts(spark, rows)
    q = qs(spark, [(i, v[i].tolist()) for i in range(40)])
    seen = set()
    for n in (1, 7, 131):
        for kw in ({}, {"broadcast_limit_bytes": 4000, "points_per_bucket": 23}):
            got = search.topk(p.repartition(n), q, 2, **kw).orderBy("query_id", "rank").collect()
            assert [(r["point_id"] - r["query_id"]) for r in got] == [0, 1000] * 40
            seen.add(tuple(tuple(r) for r in got))
    assert len(seen) == 1


def test_null_vectors_string_ids_and_empty_queries(spark):
    p = spark.createDataFrame([("b", [1.0, 0.0], 1), ("a", [1.0, 0.0], 2), ("c", None, 3), (None, [1.0, 0.0], 4)], "point_id string, vector array<float>, label int")
    q = qs(spark, [(1, [1.0, 0.0]), (2, None)])
    got = search.topk(p, q, 5, payload=["label"]).orderBy("rank").collect()
    assert [(r["query_id"], r["point_id"], r["label"]) for r in got] == [(1, "a", 2), (1, "b", 1)]
    none = search.topk(p, q.limit(0), 5, payload=["label"])
    assert none.columns == ["query_id", "rank", "score", "point_id", "label"] and none.count() == 0
    with pytest.raises(Exception, match="one size"):
        search.topk(p, qs(spark, [(1, [1.0, 0.0, 0.0])]), 5).collect()


def clustered(n, centres, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, 16))
    x = c[rng.integers(0, centres, n)] / np.sqrt((c**2).sum(1)).mean() + rng.normal(size=(n, 16)) * spread
    return x / np.sqrt((x**2).sum(1))[:, None]


def brute(x, q, k, allowed=None, threshold=-np.inf):
    s = np.cumsum(q[:, None, :] * x[None, :, :], axis=2)[:, :, -1]
    out = set()
    for i, row in enumerate(s):
        ids = [j for j in range(len(x)) if (allowed is None or allowed(i, j)) and row[j] >= threshold]
        out |= {(i, r + 1, j) for r, j in enumerate(sorted(ids, key=lambda j: (-row[j], j))[:k])}
    return out


def frames(spark, x, q, **columns):
    p = pd.DataFrame({"point_id": range(len(x)), "vector": list(x), **{c: v for c, v in columns.items() if len(v) == len(x) and c[0] == "p"}})
    t = pd.DataFrame({"query_id": range(len(q)), "vector": list(q), **{c: v for c, v in columns.items() if len(v) == len(q) and c[0] == "q"}})
    return spark.createDataFrame(p).repartitionByRange(3, "point_id"), spark.createDataFrame(t)


def test_bounds_leave_cells_out_and_keep_the_rows(spark):
    x = clustered(6000, 30, 1)
    x[100:110] = x[5]  # copies: equal scores
    q = np.concatenate([x[::20], clustered(50, 5, 2, spread=1.0)])
    scored = spark.sparkContext.accumulator(0)
    points, queries = frames(spark, x, q)
    got = {(r.query_id, r.rank, r.point_id) for r in search.topk(points, queries, 5, scored=scored).collect()}
    assert got == brute(x, q, 5)
    assert scored.value < 0.4 * len(x) * len(q)
    # vectors without clusters: no harm but the first batch
    y = np.random.default_rng(3).normal(size=(2000, 16))
    points, queries = frames(spark, y, y[:200])
    assert {(r.query_id, r.rank, r.point_id) for r in search.topk(points, queries, 5).collect()} == brute(y, y[:200], 5)


@pytest.mark.parametrize("limit", [1 << 28, 20_000])
def test_filtered_queries_meet_their_points_only(spark, limit):
    """A third of all points and queries in one value, some values that nobody
    asks for or that no point has, null filters beside them."""
    rng = np.random.default_rng(4)
    x, q = clustered(3000, 10, 5), clustered(400, 10, 6)
    of = np.where(rng.random(3000) < 0.33, 0, rng.integers(1, 120, 3000))
    ask = np.where(rng.random(400) < 0.33, 0, rng.integers(1, 140, 400))
    points, queries = frames(spark, x, q, p_of=[None if i % 50 == 7 else f"f{v}" for i, v in enumerate(of)], q_ask=[None if i % 20 == 3 else f"f{v}" for i, v in enumerate(ask)])
    scored = spark.sparkContext.accumulator(0)
    hits = search.topk(points, queries, 4, threshold=0.1, query_filter="q_ask", point_filter="p_of", broadcast_limit_bytes=limit, points_per_bucket=500, scored=scored)
    allowed = lambda i, j: i % 20 == 3 or (j % 50 != 7 and ask[i] == of[j])
    got = {(r.query_id, r.rank, r.point_id) for r in hits.collect()}
    assert got == brute(x, q, 4, allowed, 0.1)
    own = sum(int((of == ask[i]).sum()) for i in range(400) if i % 20 != 3)
    assert scored.value <= own + 20 * len(x)


def block_of(x, k=5):
    return search._QueryBlock(pd.DataFrame({"__qid": range(len(x)), "__qvec": list(x), "__k": k, "__thr": np.nan}), k)


def batch_of(x):
    return pd.DataFrame({"__pid": range(len(x)), "__pvec": list(x)})


def found(qb, best):
    return [tuple(r) for r in search._emit(qb, best)[["query_id", "point_id"]].to_numpy().tolist()]


def test_memory_of_a_task_does_not_follow_the_batch():
    import tracemalloc

    x = np.random.default_rng(7).normal(size=(40_000, 8)).astype(np.float32)
    qb, b = block_of(x[:2000]), batch_of(x)
    tracemalloc.start()
    search._score_partition(qb, [b])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


@pytest.mark.parametrize("kind, scale", [(np.float32, 1.0), (np.float32, 1e25), (np.float32, 1e-25), (np.float64, 1.0), (np.float64, 1e60)])
def test_narrow_products_keep_the_rows(kind, scale):
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(3000, 8)) * scale).astype(kind)
    x[700:720] = x[3]
    y = x.copy()
    y[50, 2] = np.nan  # links with nothing and harms no other
    qb = block_of(x[:90])
    s = np.cumsum(x[:90, None, :].astype(float) * y[None].astype(float), axis=2)[:, :, -1]
    want = [(i, j) for i in range(90) for j in sorted((j for j in range(3000) if j != 50), key=lambda j: (-s[i, j], j))[:5]]
    for cuts in (1, 3):
        parts = np.array_split(np.arange(3000), cuts)
        assert found(qb, search._score_partition(qb, [batch_of(y).iloc[p] for p in parts])) == want


def test_regions_and_copies_of_queries(spark, monkeypatch):
    """Buckets of two points don't send a query to hundreds of groups."""
    assert ann._regions({0: 10, 1: 25, 2: 100, 3: 1, 5: 40}, 40) == {0: (0, 1), 1: (0, 1), 2: (1, 3), 3: (4, 1), 5: (5, 1)}
    rng = np.random.default_rng(9)
    v = rng.normal(size=(900, 6)).astype(np.float32)
    p, q = frames(spark, v, v[:40])
    sent = []
    plain = search._score_pairs
    monkeypatch.setattr(search, "_score_pairs", lambda qx, px, *a: sent.append(qx.count()) or plain(qx, px, *a))
    monkeypatch.setattr(ann, "FLAT_CELLS", 4)  # centres that start from points
    idx = ann.build_ivf(p, 9)
    got = ann.ann_topk(idx, q, 3, nprobe=9, points_per_bucket=2)
    assert {(r.query_id, r.rank, r.point_id) for r in got.collect()} == brute(v.astype(float), v[:40].astype(float), 3)
    assert sent[0] <= 40 * (ann.REGIONS + 9)
