"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from gridseries.llm import pieces, queries
from tests.llm import rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocab():
    return pieces.load(MODEL)


def texts():
    rng = random.Random(5)
    kinds = ["ab ", "abcde  \n\t", "aaaa", "  ", "▁ a", "etainorshld", "etain orshld", "漢字の 門", "\x00é🙂 ", "ABCXYZabc019+/="]
    some = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([0, 1, 2, 5, 20, 90, 400]))) for _ in range(600)]
    some += ["".join(rng.choice(k) for _ in range(700)) for k in kinds]
    return some + [" " * n + "x" for n in range(70)] + ["a" * n for n in range(70)] + [" " * 3000, "<s> hi </s> <0x41> <unk>"]


def test_encoding_is_the_library_s(vocab, library):
    run = pieces._encoder(vocab, True, True)
    for text, found in zip(texts(), run(texts()), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text[:60])


def test_full_rounds_and_the_heap_agree(vocab, monkeypatch):
    expected = pieces._encoder(vocab, False, False)(texts())
    for rounds in (0, 5, 10_000):
        monkeypatch.setattr(pieces, "FULL_ROUNDS", rounds)
        assert pieces._encoder(vocab, False, False)(texts()) == expected


def test_memory_of_words_changes_nothing(vocab, monkeypatch):
    expected = pieces._encoder(vocab, True, False)(texts())
    monkeypatch.setattr(pieces, "MEMO_WORDS", 5)
    monkeypatch.setattr(pieces, "MEMO_CHARS", 2)
    run = pieces._encoder(vocab, True, False)
    assert [run([t])[0] for t in texts()] == expected


def test_decoding_any_ids_is_the_library_s(vocab, library):
    rng = random.Random(1)
    for _ in range(5000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), 28705, 259, rng.randrange(259, 32000)])
               for _ in range(rng.randrange(9))]
        assert pieces.decode_ids(vocab, np.array(ids, np.int64)) == library.decode(ids), ids
    with pytest.raises(ValueError, match="outside"):
        pieces.decode_ids(vocab, np.array([32_000]))


def test_awkward_rows_and_both_forms(spark, library):
    docs = rows.documents(spark).withColumns({"row": F.lit(1), "value": F.lit(2), "result": F.lit(3), "IDS": F.lit(4)})
    found = pieces.decode(pieces.encode(docs, MODEL), MODEL).toPandas()
    assert set(found.columns) == (set(docs.columns) - {"IDS"}) | {"ids", "decoded"}
    assert len(found) == len(rows.ROWS) and set(found["row"]) == {1}
    for text, ids, back in zip(found["text"], found["ids"], found["decoded"], strict=True):
        expected = library.encode(text or "", add_bos=True, add_eos=True)
        assert list(ids) == expected and back == library.decode(expected)
    packed = pieces.encode(docs, MODEL, begin=False, end=False, packed=True).toPandas()
    for text, ids in zip(packed["text"], packed["ids"], strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "")
    assert pieces.decode(pieces.encode(rows.nothing(spark), MODEL), MODEL).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(null, MODEL).first()["decoded"] == ""


def test_query_digests(spark, small, library):
    found = queries.op11_pieces(spark, small).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{small}/documents.parquet").toPandas().sort_values("doc_id")
    assert found["doc_id"].tolist() == docs["doc_id"].tolist()
    for text, (_, row) in zip(docs["text"], found.iterrows(), strict=True):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
