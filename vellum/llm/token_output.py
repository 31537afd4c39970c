"""Token-id output: texts are tokenized, and their ids written as range-coded
blocks that decode independently and carry checksums.

The files are Parquet with one row a block, so they can lie on any store that
Spark reaches and a block's documents are found without decoding it: ``shard``
and ``block`` (ascending doc_id within and across shards), ``n_ids``,
``doc_ids``, ``counts`` (ids of each document) and ``data`` (see
``range_coder``).  Documents are range-partitioned by doc_id, so shards are
written and read in parallel; a document is never split over blocks.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain
from string import ascii_letters
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm import range_coder
from vellum.llm.common import written

BLOCK = 1 << 21  # ids of a block, unless one document has more
END = 1  # the id after each document
HELD_WORDS = 800_000  # words whose ids a Python worker remembers
#: What a word tokenizer must do to texts for the short ways below to be right ...
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CUTTER = [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
SPACE, LETTER, DIGIT, OTHER, FOREIGN = range(5)  # kinds of bytes
PIECE = 8 << 20  # bytes of texts whose words are cut at once, unless one text has more


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 stands for itself, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, FOREIGN, np.uint8)
    for kind, letters in ((OTHER, range(0x20, 0x7F)), (SPACE, [*range(9, 14), 0x20]), (DIGIT, b"0123456789"), (LETTER, ascii_letters.encode())):
        kinds[list(letters)] = kind
    return kinds


def _pairs() -> tuple[np.ndarray, np.ndarray]:
    """Of the letters U+00C0 to U+017F, two bytes each: kind of the second byte
    (the signs among them and the letter that gets longer are cut elsewhere),
    and both bytes in lower case."""
    letters = [chr(c) for c in range(0xC0, 0x180)]
    kept = [x.isalpha() and len(x.lower()) == 1 for x in letters]
    low = [(x.lower() if k else x).encode() for x, k in zip(letters, kept)]
    return np.where(kept, LETTER, FOREIGN).astype(np.uint8), np.frombuffer(b"".join(low), np.uint8).reshape(-1, 2)


BYTE_LETTERS = _byte_letters()
KINDS = _byte_kinds()
LOWERED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
PAIR_KINDS, PAIR_LOWERED = _pairs()


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes in lower case, and their kinds."""
    raw = bytearray(data)
    low, kind = (np.frombuffer(raw.translate(t.tobytes()), np.uint8) for t in (LOWERED, KINDS))
    p = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    p = p[p + 1 < len(data)]
    pair = (data[p].astype(np.int64) - 0xC3) * 64 + (data[p + 1] & 0x3F)
    kind[p], kind[p + 1] = LETTER, PAIR_KINDS[pair]
    low[p], low[p + 1] = PAIR_LOWERED[pair].T
    return low, kind


def latin_pieces(data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """Pre-tokens of lower-case texts that lie one after another in ``data``,
    and their number for each text."""
    n = len(data)
    first = np.zeros(n + 3, bool)  # a text starts, or all texts have ended
    first[offsets] = first[n:] = True
    new = np.ones(n, bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    new |= first[:n]
    # an apostrophe that starts a pre-token takes s, t, m, d, re, ve or ll along
    p = np.flatnonzero((data == ord("'")) & new)
    p = p[~first[p + 1]]
    one = data[p + 1]
    two = np.where(first[p + 2], 0, data[np.minimum(p + 2, n - 1)])
    short = np.isin(one, list(b"stmd"))
    long = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    new[p[short | long] + 1] = False
    after = np.r_[p[short] + 2, p[long] + 3]
    after = after[~first[after]]
    new[after[kind[after] == LETTER]] = True
    inside = kind != SPACE
    starts = np.flatnonzero(new & inside)
    lens = np.add.reduceat(inside.view(np.uint8), starts, dtype=np.int32) if len(starts) else np.zeros(0, np.int32)
    ends = np.r_[np.int32(0), np.cumsum(lens, dtype=np.int32)]
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return pieces, np.diff(np.searchsorted(starts, offsets))


BLOCKS = "shard int, block int, n_ids long, doc_ids array<long>, counts array<int>, data binary"


class _Numbers(dict):
    """A number for every word; ``fresh`` gets those seen for the first time."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        self.fresh.append(word)
        return n


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts (second column) have about PIECE bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        yield batch.slice(at, upto - at)
        at = upto


class WordIds:
    """Ids of texts under a tokenizer that drops white space and never joins
    characters across it: the ids of a text are those of its words, so each
    word is encoded once.  Texts of ASCII and Latin letters are cut into pre-tokens
    here, of which there are fewer.  All this is done where the
    tokenizer has the normalizer and pre-tokenizer known above; under any
    other one each text is encoded as a whole."""

    _loaded: ClassVar[dict[str, WordIds]] = {}

    @classmethod
    def shared(cls, path: str) -> WordIds:
        """One for all tasks of a Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        parts = json.loads(self.tokenizer.to_str())
        steps = lambda part, name: (parts[part] or {}).get(name, [parts[part]])
        self.known = (
            steps("normalizer", "normalizers") == NORMAL and steps("pre_tokenizer", "pretokenizers") == CUTTER
            and parts["model"]["type"] == "BPE" and not parts["model"]["dropout"] and parts["post_processor"] is None
            and all(t["content"].startswith("<|") and not (t["normalized"] or t["lstrip"] or t["rstrip"]) for t in parts["added_tokens"])
        )
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        self.ids, self.lens, self.starts = np.array([END], np.int32), np.array([1], np.int32), np.array([0], np.int32)

    def _encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _by_text(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _by_model(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens, past the steps that have been taken already."""
        letters = (w if w.isascii() else "".join(BYTE_LETTERS[c] for c in w.encode()) for w in words)
        return [[t.id for t in self.model.tokenize(w)] for w in letters]

    def _learn(self, how) -> None:
        """Ids of the words that got the last numbers."""
        found, self.number.fresh = how(self.number.fresh), []
        lens = np.fromiter(map(len, found), np.int32, len(found))
        self.starts = np.r_[self.starts, (len(self.ids) + np.cumsum(lens) - lens).astype(np.int32)]
        self.lens = np.r_[self.lens, lens]
        self.ids = np.r_[self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(lens.sum()))]

    def _numbers(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, 0 after each text, and their number for each."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets -= offsets[0]
        data, kind = _letters(data)
        foreign = np.zeros(len(texts), bool)
        foreign[np.searchsorted(offsets, np.flatnonzero(kind == FOREIGN), "right") - 1] = True
        foreign |= pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if foreign.any():
            mine = np.repeat(~foreign, np.diff(offsets))
            data, kind, offsets = data[mine], kind[mine], np.r_[0, np.cumsum(np.diff(offsets)[~foreign])]
        pieces, plain = latin_pieces(data, kind, offsets)
        coded = pieces.dictionary_encode()
        number = self.number.__getitem__
        table = np.fromiter(map(number, coded.dictionary.to_numpy(zero_copy_only=False)), np.int32, len(coded.dictionary))
        self._learn(self._by_model)
        # at ASCII white space, which every tokenizer of this kind drops
        others = [[w.decode() for w in texts[i].as_py().encode().split()] for i in np.flatnonzero(foreign).tolist()]
        words = [np.fromiter(map(number, x), np.int32, len(x)) for x in others]
        self._learn(self._by_text)
        known, rest = iter(np.split(table[coded.indices.to_numpy()], np.cumsum(plain)[:-1])), iter(words)
        parts = [next(rest if f else known) for f in foreign.tolist()]
        zero = np.zeros(1, np.int32)
        return np.concatenate([x for part in parts for x in (part, zero)]), np.array([len(x) + 1 for x in parts], np.int64)

    def __call__(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by END, and their number for each text."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if not self.known:
            each = [[*self._encoded(t.as_py()), END] for t in texts]
            return np.fromiter(chain.from_iterable(each), np.int32), np.array([len(x) for x in each], np.int64)
        if len(self.number) > HELD_WORDS:
            self.forget()
        w, counts = self._numbers(texts)
        lens = self.lens[w]
        total = np.cumsum(lens, dtype=np.int32)  # no more ids than an Arrow array has bytes
        ids = self.ids[np.repeat(self.starts[w] - (total - lens), lens) + np.arange(total[-1], dtype=np.int32)]
        return ids, np.diff(total[np.cumsum(counts) - 1].astype(np.int64), prepend=0)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, block: int = BLOCK) -> None:
    """Writes the ids of every text (null: none) and an end id, in ascending
    doc_id order (null doc_ids first, by a hash of their text, over as many tasks
    as they need; rows of another doc_id by their text).  Repeated rows are written
    each, an empty table gives files without rows, other columns are not looked at."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        encoder = WordIds.shared(tokenizer)
        held: list = []

        def out(ids, doc_ids, counts):
            nonlocal number
            row = [[shard], [number], [len(ids)], [doc_ids], [counts.tolist()], [range_coder.encode(ids, encoder.vocabulary)]]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, SCHEMA)], schema=SCHEMA)

        for batch in batches:
            for b in _slices(batch):
                ids, counts = encoder(b.column(1))
                held.append((ids, b.column(0).to_pylist(), counts))
                ends = np.cumsum(np.concatenate([h[2] for h in held]))
                while len(ends) and ends[-1] >= block:
                    ids, doc_ids, counts = np.concatenate([h[0] for h in held]), sum((h[1] for h in held), []), np.concatenate([h[2] for h in held])
                    k = int(np.searchsorted(ends, block)) + 1
                    yield out(ids[: ends[k - 1]], doc_ids[:k], counts[:k])
                    held = [(ids[ends[k - 1] :], doc_ids[k:], counts[k:])]
                    ends = np.cumsum(counts[k:])
        if held and sum(len(h[1]) for h in held):
            yield out(np.concatenate([h[0] for h in held]), sum((h[1] for h in held), []), np.concatenate([h[2] for h in held]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "h", "place").sortWithinPartitions("doc_id", "h", "text")
    rows.select("doc_id", "text").mapInArrow(blocks, BLOCKS).write.parquet(path)


SCHEMA = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("data", pa.binary())])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``shard``, ``block``,
    ``at`` (first id within the block) and ``ids`` (array of int)."""

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, number, ids, counts, ends = _block(batch.slice(i, 1))
                offsets = pa.array(np.r_[0, ends].astype(np.int32))
                yield pa.record_batch(
                    [batch.column(3)[i].values, pa.array(np.full(len(ends), shard, np.int32)), pa.array(np.full(len(ends), number, np.int32)),
                     pa.array(ends - counts), pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))],
                    ["doc_id", "shard", "block", "at", "ids"],
                )

    return spark.read.schema(BLOCKS).parquet(path).mapInArrow(docs, "doc_id long, shard int, block int, at long, ids array<int>")


def _block(row: pa.RecordBatch):
    counts = row.column(4)[0].values.to_numpy().astype(np.int64)
    ids = range_coder.decode(row.column(5)[0].as_py())
    if len(ids) != row.column(2)[0].as_py() or counts.sum() != len(ids):
        raise ValueError("token block is damaged: counts differ")
    return row.column(0)[0].as_py(), row.column(1)[0].as_py(), ids, counts, np.cumsum(counts)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold of each document: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens`` and ``ids_crc32``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, number, ids, counts, ends = _block(batch.slice(i, 1))
                raw, last = memoryview(ids.astype("<u4").tobytes()), ends.tolist()
                crc = [zlib.crc32(raw[4 * (e - c) : 4 * e]) for e, c in zip(last, counts.tolist())]
                yield pa.record_batch(
                    [batch.column(3)[i].values, pa.array(np.full(len(last), shard, np.int32)), pa.array(np.full(len(last), number, np.int32)),
                     pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                    ["doc_id", "shard", "block", "at", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(BLOCKS).parquet(path)
    found = files.mapInArrow(sums, "doc_id long, shard int, block int, at long, n_tokens long, ids_crc32 long")
    heads = files.select("shard", "block", "n_ids")
    shards = heads.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = lambda c, *by: F.sum(c).over(Window.partitionBy(*by[:-1]).orderBy(by[-1])) - F.col(c)
    shards = shards.withColumn("one", F.lit(0)).select("shard", before("ids", "one", "shard").alias("shard_at"))
    heads = heads.join(shards, "shard").select("shard", "block", (F.col("shard_at") + before("n_ids", "shard", "block")).alias("base"))
    heads = written(heads, "token-bases")
    return found.join(heads, ["shard", "block"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
