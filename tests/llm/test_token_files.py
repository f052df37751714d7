"""Token files: an exact round trip, and single documents read by the index."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_helpers import EDGES, documents, edges, nothing, prepared  # noqa: F401
from pyspark.errors import PythonException
from tokenizers import Tokenizer, normalizers

from jobmetrics.llm import token_files as tf
from jobmetrics.llm.queries import PATTERN, VOCABULARY
from jobmetrics.llm.word_encoder import WordEncoder
from jobmetrics.session import scratch_path


def ids_by_library(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, out = 0, []
    for (doc, _), ids in zip(rows, ids_by_library([t or "" for _, t in rows])):
        data = np.array([*ids, 2], "<u4").tobytes()
        out.append((doc, start, len(ids) + 1, zlib.crc32(data)))
        start += len(ids) + 1
    return out


def round_trip(docs, shards=None):
    path = scratch_path(docs.sparkSession, "test-files")
    tf.write_token_files(docs, path, VOCABULARY, PATTERN, 2, shards)
    return path, [tuple(r) for r in tf.read_token_files(docs.sparkSession, path).collect()]


def test_words_have_the_librarys_ids():
    texts = [t or "" for _, t in EDGES] + ["<|endoftext|> a", "end <|endoftext|> start", "<|endoftext|><|endoftext|>", "é <|endoftext|>", "<|endoftext|", "é́  x\u0085y\x1c z", "½²ªº ǅ ʰ", "a's 're  'll  \n\n b ",
                                            "кот 中文", "İstanbul ſ K", "don't  STOP\t\t\tnow"]
    for kept in (0, 5, 10_000):
        encoder = WordEncoder(VOCABULARY, PATTERN, kept)
        for _ in range(2):
            got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
            assert got == ids_by_library(texts)
        assert len(encoder.known) <= max(kept, 0)


class OnlyModel:
    """A tokenizer that can only encode what is parted already."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model


def test_words_of_common_characters_are_not_parted_again():
    texts = ["Some common words, 12 of them:  don't  STOP\n\n b", "naïve Ünïcödé – €5", "new new words new"]
    for kept in (0, 10_000):
        encoder = WordEncoder(VOCABULARY, PATTERN, kept)
        encoder.tokenizer = OnlyModel(encoder.tokenizer)
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == ids_by_library(texts)


def test_each_common_character_has_the_librarys_ids():
    is_plain = WordEncoder(VOCABULARY, PATTERN).is_plain
    characters = [c for c in map(chr, range(0x2100)) if is_plain(c)]
    assert len(characters) > 500
    texts = [f"{c} {c}{c}  a{c}1 {c}\n{c}a's {c}re" for c in characters]
    for more in ([], ["кот 中文 \x00\x85", "ÿ\x00ÿ"]):
        got = [np.frombuffer(b, "<u4").tolist() for b in WordEncoder(VOCABULARY, PATTERN).encode(texts + more)]
        assert got == ids_by_library(texts + more)


def test_a_vocabulary_with_a_normalizer_goes_through_the_whole_library(tmp_path):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.normalizer = normalizers.Lowercase()
    tokenizer.save(str(tmp_path / "lower.json"))
    texts = ["Some WORDS, and more"]
    got = WordEncoder(str(tmp_path / "lower.json"), PATTERN).encode(texts)
    assert np.frombuffer(got[0], "<u4").tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids


@pytest.mark.parametrize("shards", [1, 3, 100])
def test_whole_table(prepared, sf_dir, shards):
    docs = prepared.read.parquet(f"{sf_dir}/documents.parquet")
    _, got = round_trip(docs, shards)
    assert sorted(got) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(edges):
    _, got = round_trip(edges)
    # Rows with one id lie beside each other, by size; so do the two without an id.
    order = sorted(EDGES, key=lambda r: len(ids_by_library([r[1] or ""])[0]))
    assert sorted(got, key=lambda r: r[1]) == expected(order)


def test_one_document_at_a_time(prepared, edges):
    path, _ = round_trip(edges, 1)
    dictionary = tf.load_dictionary(prepared, path)
    segments = prepared.read.parquet(f"{path}/segments").orderBy("segment").collect()
    one = segments[0]
    for number, (doc, ids) in enumerate(tf.read_segment(one["index"], one["frames"], dictionary)):
        assert (tf.read_document(one["index"], one["frames"], number, dictionary) == ids).all()
    assert sum(s["n_documents"] for s in segments) == len(EDGES)


def test_another_dictionary_is_refused(prepared, edges):
    path, _ = round_trip(edges, 1)
    other, _ = round_trip(documents(prepared, [(1, "some other words " * 50)]), 1)
    swapped = scratch_path(prepared, "swapped")
    prepared.read.parquet(f"{path}/segments").write.parquet(f"{swapped}/segments")
    prepared.read.parquet(f"{other}/dictionary").write.parquet(f"{swapped}/dictionary")
    with pytest.raises(PythonException, match="another dictionary"):
        tf.read_token_files(prepared, swapped).collect()


def test_wide_ids_and_empty_table(nothing):
    wide = np.array([1, 70_000, 2], "<u4").tobytes()
    assert tf.deserialize(tf.serialize(wide)).tobytes() == wide
    assert round_trip(nothing)[1] == []
