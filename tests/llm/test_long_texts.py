"""Texts of many megabytes are handled in time and memory that follow their length."""

import time

import pyarrow as pa
import pytest

from lendscape.llm import arrow as A
from lendscape.llm import licenses, secrets, token_counts, wordbpe

MB = 1_000_000


def seconds(fn, *args):
    began = time.process_time()
    fn(*args)
    return time.process_time() - began


@pytest.mark.parametrize("unit", ["password=hunter22/é ", "kJ8s9Qz2LmX4vB7nR1tYz 9f86d081884c7d659a2feaa0/x "])
def test_spans_of_a_long_text(unit):
    n = 5 * MB // len(unit)
    text = A.texts(pa.array([unit * n]))
    assert seconds(secrets.redact, text) < 30
    one, found = secrets.find(A.texts(pa.array([unit])))[0], secrets.find(text)[0]
    assert found == [(s + i * len(unit), k, e + i * len(unit)) for i in range(n) for s, k, e in one]


def test_phrases_and_notices_of_a_long_text():
    n = 5 * MB // 12
    text = "mit license " * n
    assert seconds(licenses.scan, text) < 30
    assert licenses.scan(text)[:4] == (2 * n, n, 0, 2 * n - 2)


def test_a_long_window_is_searched_in_stretches():
    notice = "releqqed under the mit license"
    text = " ".join([notice] * 2000)
    assert seconds(licenses.scan, text) < 10
    found = licenses.scanner().find(text)
    # Every copy, whatever stretch it begins in, and none twice.
    starts = {x.start for x in found if x.edits == 2}
    assert starts >= {i * (len(notice) + 1) for i in range(2000)}
    assert len(found) == len(set(found))


@pytest.fixture(scope="module")
def machine():
    return token_counts.machine(token_counts.TOKENIZER)


def test_long_pieces_and_words_equal_the_library(machine, monkeypatch, rng):
    library = wordbpe.encoder(token_counts.TOKENIZER).library
    monkeypatch.setattr(wordbpe, "WINDOW", 64)
    odd = ["abc", "don't", "'s", "'", "<|endoftext|>", "<|", "|>", "9", "é", "é", "日本", "。", "，", "中文", "+/=",
           "İ", "Σ", "̸", "ll", "~", "|", "<", ">", "ﬁ", "　"]
    texts = ["".join(rng.choices(k, k=rng.randint(40, 900))) for k in ("ab", "acgt", "etaoin", "éa", "Ab1/+", odd) for _ in range(150)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert machine.counts(A.texts(pa.array(texts))).tolist() == want
    assert machine.counts(A.texts(pa.array(texts)), block=37).tolist() == want
    for text in texts:
        assert "".join(wordbpe.word_parts(text)) == text


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"])
def test_tokens_of_a_long_text_without_blanks(machine, rng, letters):
    text = A.texts(pa.array(["".join(rng.choices(letters, k=4 * MB))]))
    assert seconds(machine.counts, text) < 40


def test_open_words_are_not_copied_by_every_block(machine):
    maps = machine.state_maps([b"a" * 1000] * 1000)
    whole = machine.total(maps)
    assert whole.tail is None and sum(map(len, whole.head)) == 1_000_000
    assert all(part is maps[i].head[0] for i, part in enumerate(whole.head))
