import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """NULLs everywhere, empty, long, tied and repeated texts."""
    long_text = " ".join(f"word{i % 997}" for i in range(30_000))
    texts = [
        None, "", " ", "\n\n", "a", "the end.", "the end.", long_text, long_text + " x", "é" * 400,
        "日本語 テスト", "▁ mark ▁x", "x  y\n \n z", "\x01\x00 odd", "<|endoftext|> in text",
        "password = 'abc123xyz' and more words follow it here today", "licensed under the mit license",
    ]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("src1", "src2", None)[i % 3], 1) for i, t in enumerate(texts)]
    return rows + rows[3:8] + [(None, "no id here at all today", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns named like the operators' own."""
    names = (
        "score kept n_tokens n_words component_id _text _id _doc doc lang_pred _lang domain copies "
        "_key ids spans labels part segment _hash _n"
    ).split()
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in names])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture
def rng():
    return random.Random(7)
