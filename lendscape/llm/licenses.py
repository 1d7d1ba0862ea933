"""License scans: known phrases, and short notices found in spite of small edits.

Texts are brought to lower-case words joined by single blanks. Phrases are looked up as they
stand. For the notices, pigeonhole: a notice allowed k edits is split into k + 1 pieces, one of
which must occur unchanged; an Aho-Corasick automaton over all pieces reads each text once and
gives candidate places, and the regex library's bounded-error matching verifies a window around
each, reporting span and edits. What lies left and right of a match is searched again, so that a
worse copy beside a better one is found as well.

* NULL or empty text: no words, no labels, score 0, first and last word NULL.
* Overlapping phrase places all count. Texts are scanned whole, whatever their length.
* Repeated rows and ids: one result row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices as words, with the label they stand for.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the gnu general public license version": "gpl",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license version": "mpl",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc": "cc-by-nc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved worldwide": "proprietary",
}
# Edits allowed per this many characters of a notice.
CHARS_PER_EDIT = 12
# Characters of a window in which starts of matches are looked for at once.
STRETCH = 1024

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


class Notice(NamedTuple):
    start: int
    end: int
    label: str
    edits: int
    score: float


def normal(text: str) -> str:
    """Words joined by blanks."""
    return b" ".join(text.encode().translate(_WORDS).split()).decode()


def edits_allowed(notice: str) -> int:
    return len(notice) // CHARS_PER_EDIT


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """k + 1 consecutive pieces with their offsets."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices: Mapping[str, str]):
        self.notices = list(notices.items())
        self.verify = [
            regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={edits_allowed(n)}}}") for n, _ in self.notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _) in enumerate(self.notices):
            for at, piece in pieces(notice, edits_allowed(notice)):
                seeds.setdefault(piece, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.seeds.add_word(piece, (len(piece), owners))
        self.seeds.make_automaton()

    def candidates(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Windows per notice that may hold it, merged where they overlap."""
        out: dict[int, list[tuple[int, int]]] = {}
        for last, (length, owners) in self.seeds.iter(text):
            for i, at in owners:
                k = edits_allowed(self.notices[i][0])
                begin = last + 1 - length - at
                a, b = max(0, begin - k), begin + len(self.notices[i][0]) + k
                windows = out.setdefault(i, [])
                if windows and a <= windows[-1][1]:
                    a, b = min(a, windows[-1][0]), max(b, windows[-1][1])
                    windows.pop()
                windows.append((a, b))
        return out

    def matches(self, i: int, text: str, a: int, b: int) -> Iterator[regex.Match]:
        """Matches of a notice in a window, which is searched by stretches of its starts.

        The work of a best match grows with the range, hence of all of them with its square.
        """
        most = len(self.notices[i][0]) + edits_allowed(self.notices[i][0])
        while a < b:
            stop = a + STRETCH
            found = [m for m in self.best(i, text, a, min(b, stop + most)) if m.start() < stop]
            yield from found
            a = max([stop, *(m.end() for m in found)])

    def best(self, i: int, text: str, a: int, b: int) -> Iterator[regex.Match]:
        """The best matches of a notice in a range, then those of what is left of them."""
        least = len(self.notices[i][0]) - edits_allowed(self.notices[i][0])
        ranges = [(a, b)]
        while ranges:
            a, b = ranges.pop()
            for m in self.verify[i].finditer(text, a, b):
                if m.start() - a >= least:
                    ranges.append((a, m.start()))
                a = m.end()
                yield m

    def find(self, text: str) -> list[Notice]:
        """Verified notices of a normalised text, as spans of it."""
        found = []
        for i, windows in self.candidates(text).items():
            notice, label = self.notices[i]
            for a, b in windows:
                for m in self.matches(i, text, a, b):
                    edits = sum(m.fuzzy_counts)
                    found.append(Notice(m.start(), m.end(), label, edits, 1 - edits / len(notice)))
        return sorted(found)


@cache
def scanner() -> Scanner:
    return Scanner(NOTICES)


def phrase_places(padded: str) -> dict[str, list[int]]:
    """Word numbers at which each phrase's words stand consecutively; ``padded`` has a blank at
    both ends."""
    out = {}
    for phrase, label in PHRASES.items():
        at, places = padded.find(f" {phrase} "), []
        counted = word = 0
        while at >= 0:
            word += padded.count(" ", counted, at)
            counted = at
            places.append(word)
            at = padded.find(f" {phrase} ", at + 1)
        if places:
            out[label] = places
    return out


def scan(text: str) -> tuple:
    """One result row without the id, then the notices found."""
    text = normal(text)
    found = scanner().find(text)
    places = phrase_places(f" {text} ")
    words = [w for x in places.values() for w in x]
    labels = sorted(set(places) | {x.label for x in found})
    score = 1.0 if places else max((x.score for x in found), default=0.0)
    return (
        text.count(" ") + 1 if text else 0,
        len(words),
        min(words, default=None),
        max(words, default=None),
        ",".join(sorted(places)),
        ",".join(labels),
        score,
        ",".join(f"{x.label}:{x.start}:{x.end}:{x.edits}" for x in found),
    )


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, notices string"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Phrases and notices of every document; ``notices`` holds label:start:end:edits in the
    normalised text. No shuffle."""

    def run(table: pa.Table) -> pa.Table:
        rows = [scan(x) for x in A.texts(table["_text"]).to_pylist()]
        out = {id_col: table[id_col]}
        for field, values in zip(FIELDS.split(", "), zip(*rows)):
            name, kind = field.split()
            out[name] = pa.array(values, {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[kind])
        return pa.table(out) if rows else None

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, F.col(text).cast("string").alias("_text"))
    return A.map_tables(needed, run, f"`{id_col}` {kind}, {FIELDS}")
