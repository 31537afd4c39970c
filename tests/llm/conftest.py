import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that operators use inside
CLASHING = ["fp", "h", "id", "g", "size", "target", "taken", "passes", "a", "b", "c", "d", "w", "k", "node", "component", "rep", "at", "t", "s",
            "words", "share", "label_", "toxic", "severity", "x", "n", "one", "two", "first", "gram", "context", "known", "shard", "block", "kept"]


@pytest.fixture
def frame(spark):
    """A documents table of (doc_id, text[, source]) rows with clashing extra columns."""

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        d = spark.createDataFrame(full, DOCS)
        return d.withColumns({c: F.lit("clash") for c in CLASHING}) if clash else d

    return make


LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(40_000))
MESSY = [
    (1, None, "b"), (2, "", "b"), (3, " \n\t ", None), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"), (6, LONG, "a"), (7, LONG + " end", None),
    (8, "Ünïcode wörds, ÉCOLE é ßİ 　 done.", "b"), (9, "x\x00y \x0b z", ""), (None, "no id here at all", "b"), (10, "one", None),
]
