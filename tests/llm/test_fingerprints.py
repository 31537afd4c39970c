"""One-permutation MinHash against exact Jaccard likeness and plain Python."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import LONG, MESSY

from vellum.llm import fingerprints as fp
from vellum.llm import queries


def shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(text, bins=fp.BINS, bits=fp.BITS):
    """The fingerprint bin by bin."""
    if not text.split():
        return b""
    best = {}
    for h in sorted(set(fp.Signer().hashes(text.encode()).tolist()), reverse=True):
        best[h >> (64 - bins.bit_length() + 1)] = h
    orders, out, mask = fp._orders(bins), [], 2**64 - 1
    for i in range(bins):
        x = best[i] if i in best else best[min(best, key=lambda j: orders[i, j])]
        x = (x + (i + 1) * 0x9E3779B97F4A7C15) & mask
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        out.append((x ^ x >> 31) & ((1 << bits) - 1))
    return bytes(a | b << 4 for a, b in zip(out[::2], out[1::2]))


def test_fingerprint_equals_plain_python():
    r, sign = random.Random(1), fp.Signer()
    for n in (0, 1, 4, 5, 6, 40, 600, 3000):
        text = " ".join(f"w{r.randrange(5000)}" for _ in range(n))
        assert sign(text.encode()) == plain(text)
    assert sign(b"A b\tC") == sign(b"a  B c\n") != sign(b"a b d")


@pytest.mark.parametrize("words", [3, 12, 60, 400, 2000])
def test_likeness_is_unbiased(words):
    """Mean error over many pairs near 0 at every length and likeness."""
    r, sign = random.Random(words), fp.Signer()
    for share in (0.0, 0.25, 0.5, 1.0):
        errors = []
        for _ in range(150):
            a = [f"x{r.random()}" for _ in range(words)]
            keep = int(words * share)
            b = a[:keep] + [f"y{r.random()}" for _ in range(words - keep)]
            a, b = " ".join(a), " ".join(b)
            errors.append(fp.likeness(sign(a.encode()), sign(b.encode())) - jaccard(a, b))
        assert abs(statistics.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.25
        if share == 1.0:
            assert set(errors) == {0.0}


def test_likeness_without_words(spark):
    assert fp.likeness(b"", b"") == 1 and fp.likeness(b"", plain("one")) == 0
    d = spark.createDataFrame([(plain("one two"), plain("one two")), (b"", b""), (None, b"")], "a binary, b binary")
    assert [r[0] for r in d.select(fp.likeness_of(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0, None]
    with pytest.raises(ValueError):
        fp.Signer(bins=100)


def test_fingerprints_of_messy_rows(frame):
    got = fp.document_fingerprints(frame(MESSY)).collect()
    assert sorted((str(r.doc_id), bytes(r.fingerprint)) for r in got) == sorted((str(i), plain(t or "")) for i, t, _ in MESSY)
    assert fp.document_fingerprints(frame([])).count() == 0


def edited(rows):
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        own = plain(text)
        yield (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), plain(changed).hex(),
               fp.likeness(own, plain(changed)), fp.likeness(own, plain(after)))


@pytest.mark.parametrize("ranges", [1, 7])
def test_query_on_messy_rows(spark, frame, tmp_path, ranges):
    r = random.Random(3)
    rows = [(i, t or "") for i, t, _ in MESSY if i not in (5, None)] + [(20 + i, " ".join(f"é{r.randrange(40)}" for _ in range(r.randrange(60)))) for i in range(40)]
    rows += [(None, "the one without an id"), (-4, "below none"), (10**12, "")]
    r.shuffle(rows)
    frame(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = [tuple(x) for x in queries.op13_fingerprints(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(got, key=str) == sorted(edited(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))), key=str)


def test_few_rows_and_repeats(frame):
    assert fp.edited_likeness(frame([])).count() == 0
    one = fp.edited_likeness(frame([(7, "abcd efgh")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(7, hashlib.sha256(b"abcd efab").hexdigest())]
    many = fp.edited_likeness(frame([(None, "same text here")] * 300 + [(1, LONG)] * 2 + [(2, None)])).collect()
    assert len(many) == 303 and sum(r.near_next == 1 for r in many) == 300
    assert len({bytes(r.fingerprint) for r in many}) == 3
