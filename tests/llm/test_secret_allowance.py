"""The allow list spares names and paths, and hardly any random key."""

import string

import pyarrow as pa
import pytest

from lendscape.llm import arrow as A
from lendscape.llm import secrets

BASE64 = string.ascii_letters + string.digits + "+/"


def kinds(text):
    return [k for _, k, _ in secrets.find(A.texts(pa.array([text])))[0]]


@pytest.mark.parametrize("size", [40, 64, 86])
def test_random_keys_are_not_allowed(rng, size):
    keys = ["".join(rng.choices(BASE64, k=size)) for _ in range(5000)]
    assert sum(map(bool, map(secrets._ALLOWED.fullmatch, keys))) <= 15
    assert sum(map(secrets.is_secret, keys)) >= 4970


@pytest.mark.parametrize(
    "text",
    [
        "kJ8s9Qz2LmX4vB7nR1tYz0Wq/word",
        "kJ8s9Qz2Lm//X4vB7nR1tYz0Wq",
        "kJ8s9Qz0000LmX4vB7nR1tYz0Wq",
        "words-before-kJ8s9Qz2LmX",
    ],
)
def test_chance_parts_do_not_excuse_a_key(text):
    assert kinds(f"see {text} there") == ["entropy"]


@pytest.mark.parametrize(
    "text",
    [
        "usr/share/Licenses/common_Text-v2/utf8",
        "//cdn/static/Images/2024-05-12/header_logo",
        "Backup_of_Quarterly-Report_2024",
        "00000000kJ8s9Qz2LmX4vB7nR1",
    ],
)
def test_names_paths_and_fillers_are_spared(text):
    assert kinds(f"see {text} there") == []
