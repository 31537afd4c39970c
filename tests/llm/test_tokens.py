import json
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import MESSY

from vellum.llm import range_coder, token_output
from vellum.llm.queries import word_tokenizer


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(1, 3))
def test_ids_round_trip(ids, repeat):
    x = np.array(ids * repeat, np.int64)
    assert (range_coder.decode(range_coder.encode(x, 256)) == x).all()


def test_repeating_ids_shrink_and_damage_is_found():
    x = np.tile(np.random.default_rng(0).integers(0, 49_000, 500), 200)
    data = range_coder.encode(x, 49_408)
    assert (range_coder.decode(data) == x).all()
    assert len(data) < len(x)  # under a byte an id
    for at in (2, 40, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises(ValueError, match="damaged"):
            range_coder.decode(bytes(bad))


def test_words_have_the_ids_of_the_whole_text():
    from tokenizers import Tokenizer

    plain, fast = Tokenizer.from_file(word_tokenizer()), token_output.WordIds(word_tokenizer())
    texts = [r[1] for r in MESSY] + [
        "it's WE'LL don't naïve's l’été ŒUVRE ÿŉ x́ 12 3!!?? a|b | |c", "<|endoftext|>x <|startoftext|>", "a b\x85c\x1cd   ÷×", "日本 語 ΣΑΣ 𝒳",
    ]
    ids, counts = fast(texts)
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == sum(want, [])
    again, _ = fast(texts)
    assert again.tolist() == ids.tolist()


LATIN = st.text(st.sampled_from("''stmdrevelXSTMDREVEL ae09.,!\t\n-ÀàØøŸÿŒœſŉ×÷İı|<é"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(LATIN, st.text(max_size=12), st.none()), max_size=8))
def test_any_texts_have_the_ids_of_whole_texts(texts):
    fast = token_output.WordIds.shared(word_tokenizer())
    ids, counts = fast(texts)
    want = [[*fast.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])


def test_tokenizers_of_another_form_encode_whole_texts(tmp_path):
    for part in ("normalizer", "pre_tokenizer"):
        form = json.loads(Path(word_tokenizer()).read_text())
        form[part] = {"normalizer": {"type": "NFC"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}[part]
        (tmp_path / "other.json").write_text(json.dumps(form))
        other = token_output.WordIds(str(tmp_path / "other.json"))
        assert not other.known
        ids, counts = other(["Two Words, it's", None])
        assert ids.tolist() == [*other.tokenizer.encode("Two Words, it's", add_special_tokens=False).ids, 1, 1] and counts.tolist() == [len(ids) - 1, 1]


def test_files_give_back_every_document(spark, frame, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(word_tokenizer())
    rows = [r for r in MESSY if r[0] is not None] + [(i, f"text number {i} " * (i % 50)) for i in range(100, 400)]
    path = str(tmp_path / "tokens")
    token_output.write_tokens(frame(rows).repartition(7), path, word_tokenizer(), block=1000)
    got = sorted(tuple(r) for r in token_output.digest(spark, path).collect())
    want, start = [], 0
    for i, text in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: r[0]):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)
    assert token_output.read_tokens(spark, path).where("doc_id = 4").first().ids[-1] == 1
    assert spark.read.parquet(path).count() > 5


def test_empty_table_and_null_id(spark, frame, tmp_path):
    token_output.write_tokens(frame([]), str(tmp_path / "none"), word_tokenizer())
    assert token_output.digest(spark, str(tmp_path / "none")).count() == 0
    token_output.write_tokens(frame([(None, "x"), (1, None)]), str(tmp_path / "null"), word_tokenizer())
    assert [(r.doc_id, r.start, r.n_tokens) for r in token_output.digest(spark, str(tmp_path / "null")).orderBy("start").collect()] == [(None, 0, 2), (1, 2, 1)]
