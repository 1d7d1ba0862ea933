"""Piece ids are those of the model's own encoding."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from lendscape.llm import arrow as A
from lendscape.llm import pieces_codec

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces_codec.MODEL))


@pytest.fixture(scope="module")
def codec():
    return pieces_codec.codec(kind=pieces_codec.MergeCodec)


def same(codec, library, texts):
    for text, ids in zip(texts, codec.encode(A.texts(pa.array(texts, pa.string())))):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text), text
        assert codec.encode_one(text) == ids
        assert codec.decode(ids) == text


def test_ids_of_the_test_table(spark, codec, library):
    same(codec, library, [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_ids_of_odd_and_random_texts(codec, library, rng):
    odd = ["", " ", "the international brown fox", "  a  b ", "a\n b", "a\n\nb\n", "\n", "日本 x\x01 \x01\x01\n\x00",
           "é" * 50, "a" * 3001, " " * 100 + "x" + " " * 37, "<0x41> <s>", "\t\r\x0b", "😀the😀"]
    kinds = ["ab", "aehinorst", "abcdefghijklmnopqrstuvwxyz", " a\n", "-=_.0 1", "éèßлогия日本の 𝔘", "TheINg "]
    random = ["".join(rng.choices(k, k=rng.randint(1, 60))) for k in kinds for _ in range(300)]
    same(codec, library, odd + random)


def test_digest_counts_the_models_pieces(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pieces_codec.digest(docs).collect():
        assert r.n_pieces == len(library.encode(texts[r.doc_id])) and r.restored
