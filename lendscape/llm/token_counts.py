"""Token counts by a finite-state transducer compiled from the tokenizer.

The machine reads a text once. It is between words or inside a piece of one (letters, a digit,
signs, or a word with odd characters), and white space always leads back to the first state; the
transition that closes a piece is annotated with the number of tokens the piece emits.
Annotations are compiled from the tokenizer's merges when a piece is first met and kept per
worker.

A long text is cut into blocks of fixed size, wherever the cuts fall. A block's state map tells
what it does from any state: the characters that still belong to the word open at its start, the
tokens emitted inside, and the word left open at its end. Maps compose associatively. A prefix
scan of logarithmic depth over a text's blocks gives the count up to each; of a text's own count
only its up-sweep is needed, in which every border between blocks is met once. Open words are kept
as the blocks' parts and joined when they are closed, so time and memory follow the text's length.

* NULL or empty text: 0 bytes, 0 tokens.
* Special strings inside texts count as the library counts them by default.
* Repeated rows and ids: one result row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A
from lendscape.llm.wordbpe import CUT_BYTES, cut_pieces, encoder, word_parts

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
BLOCK_BYTES = 1 << 16

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class StateMap(NamedTuple):
    """What a block does: text before its first white space, then, if it has any white space,
    the inner text's tokens and the word left open at the end. Words are in parts."""

    head: tuple[bytes, ...]
    emitted: int
    tail: tuple[bytes, ...] | None


class CountTransducer:
    def __init__(self, tokenizer: str):
        self.tokenizer = tokenizer

    def emits(self, pieces: list[str]) -> np.ndarray:
        """Tokens that closing each of the pieces emits."""
        return np.fromiter(map(len, encoder(self.tokenizer).encode(pieces)), np.int64, len(pieces)) // 4

    def emitted(self, array: pa.Array) -> np.ndarray:
        """Tokens of texts that each begin and end between words."""
        out = np.zeros(len(array), np.int64)
        for a, b in A.slices(array, CUT_BYTES):
            codes, first, pieces = cut_pieces(array.slice(a, b - a))
            out[a:b] = A.per_text(self.emits(pieces)[codes], first)
        return out

    def state_maps(self, blocks: list[bytes]) -> list[StateMap]:
        cuts = []
        for block in blocks:
            head = _SPACE.search(block)
            tail = re.search(rb"[^\x20\x09-\x0D]*\Z", block)
            cuts.append(None if head is None else (head.start(), tail.start()))
        inner = [b"" if c is None else b[c[0] : c[1]] for b, c in zip(blocks, cuts)]
        emitted = self.emitted(pa.array([x.decode() for x in inner], pa.large_string()))
        return [
            StateMap((b,), 0, None) if c is None else StateMap((b[: c[0]],), int(n), (b[c[1] :],))
            for b, c, n in zip(blocks, cuts, emitted)
        ]

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        if a.tail is None:
            return StateMap(a.head + b.head, b.emitted, b.tail)
        if b.tail is None:
            return StateMap(a.head, a.emitted, a.tail + b.head)
        closed = self.count_words([a.tail + b.head])
        return StateMap(a.head, a.emitted + closed + b.emitted, b.tail)

    def prefix_scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Composition of the first 1, 2, ... maps, in logarithmically many rounds."""
        step = 1
        while step < len(maps):
            maps = [
                self.compose(maps[i - step], m) if i >= step else m for i, m in enumerate(maps)
            ]
            step *= 2
        return maps

    def total(self, maps: list[StateMap]) -> StateMap:
        """Composition of all maps, by the up-sweep of a prefix scan."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def count_long(self, text: str, block: int = BLOCK_BYTES) -> int:
        raw = text.encode()
        last = self.total(self.state_maps([raw[i : i + block] for i in range(0, len(raw), block)]))
        edges = [last.head] if last.tail is None else [last.head, last.tail]
        return last.emitted + self.count_words(edges)

    def count_words(self, words: list[tuple[bytes, ...]]) -> int:
        """Tokens of words that cuts have left in parts."""
        parts = [x for word in words for x in word_parts(b"".join(word).decode())]
        return int(self.emitted(pa.array(parts, pa.large_string())).sum())

    def counts(self, array: pa.Array, block: int = BLOCK_BYTES) -> np.ndarray:
        """Tokens of every text."""
        sizes = np.diff(A.offsets_of(array))
        out = np.zeros(len(array), np.int64)
        short = np.flatnonzero(sizes <= block)
        short_texts = array if len(short) == len(array) else array.take(pa.array(short))
        out[short] = self.emitted(short_texts)
        for i in np.flatnonzero(sizes > block):
            out[i] = self.count_long(array[int(i)].as_py(), block)
        return out


_MACHINES: dict[str, CountTransducer] = {}


def machine(tokenizer: str) -> CountTransducer:
    return _MACHINES.setdefault(tokenizer, CountTransducer(tokenizer))


def count_tokens(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Id, UTF-8 bytes, tokens, and whether a document exceeds the limit. No shuffle."""

    def run(table: pa.Table) -> pa.Table:
        array = A.texts(table["_text"])
        n = machine(tokenizer).counts(array)
        return pa.table(
            {
                id_col: table[id_col],
                "n_bytes": pa.array(np.diff(A.offsets_of(array)), pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array(n > limit),
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, F.col(text).cast("string").alias("_text"))
    return A.map_tables(
        needed, run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
