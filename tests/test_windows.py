import random

from pyspark.sql import functions as F

from vellum.operators import blocks, chunking
from vellum.operators.windows import running_agg


def test_running_agg_matches_python(spark):
    rnd = random.Random(3)
    rows = [(k, p, rnd.randint(-5, 9)) for k in range(4) for p in range(rnd.randint(1, 40))]
    df = spark.createDataFrame(rows, "k int, p int, v int")
    got = running_agg(df, ["k"], "p", "v", "s", "sum", total="t", block=3).collect()
    got_max = running_agg(df, ["k"], "p", F.when(F.col("v") > 4, F.col("p")), "m", "max", block=5).collect()
    want_s, want_m, tot = {}, {}, {}
    for k in range(4):
        acc, best = 0, None
        for (kk, p, v) in rows:
            if kk != k:
                continue
            acc += v
            if v > 4:
                best = p if best is None else max(best, p)
            want_s[(k, p)] = acc
            want_m[(k, p)] = best
        tot[k] = acc
    assert {(r["k"], r["p"]): r["s"] for r in got} == want_s
    assert all(r["t"] == tot[r["k"]] for r in got)
    assert {(r["k"], r["p"]): r["m"] for r in got_max} == want_m


def test_small_ranges_do_not_change_results(spark):
    # sections and chunk numbers with range size 2 equal those with the default
    rows = [(1, i, i % 3 == 0, ("h%d" % i) if i % 3 == 0 else "b" * (40 + i)) for i in range(30)]
    el = spark.createDataFrame(rows, "doc int, pos int, is_heading boolean, text string")
    base = sorted(tuple(r) for r in blocks.section_blocks(el).collect())
    small = sorted(tuple(r) for r in _sections_with_block(el, 2))
    assert base == small


def _sections_with_block(el, block):
    import vellum.operators.windows as W

    orig = W.running_agg

    def patched(*a, **kw):
        kw["block"] = block
        return orig(*a, **kw)

    blocks.running_agg = patched
    try:
        return blocks.section_blocks(el).collect()
    finally:
        blocks.running_agg = orig


def test_number_chunks_ranges(spark):
    rows = [("f", b, p, "x") for b in range(7) for p in range(3)] + [("g", 0, 0, "y")]
    df = spark.createDataFrame(rows, "path string, block_no int, piece_no int, text string")
    import vellum.operators.windows as W

    out = W.running_agg(df, ["path"], "block_no", F.lit(1), "n", "sum", order=["block_no", "piece_no"], total="t", block=2)
    got = sorted((r["path"], r["block_no"], r["piece_no"], r["n"], r["t"]) for r in out.collect())
    want = sorted([("f", b, p, b * 3 + p + 1, 21) for b in range(7) for p in range(3)] + [("g", 0, 0, 1, 1)])
    assert got == want
    assert chunking.number_chunks(df).count() == 22
