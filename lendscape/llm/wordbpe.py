"""Exact token ids of texts under a word-level byte-pair tokenizer file.

White space never joins words of such a tokenizer, so a text's tokens are its words' tokens one
after the other. Words of printable ASCII and Latin letters are cut into the tokenizer's pieces
(runs of letters, single digits, runs of signs) in arrays over the whole batch, and each distinct
piece is merged once per worker. A word holding an apostrophe, a possible special token or any
other character stays whole and goes through the tokenizer's own pattern or the library.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from lendscape.llm import arrow as A

# Fixed by the tokenizer file: its split pattern, here for the characters of _PLAIN only.
_SPLIT = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+"
)
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PATTERN_IN_FILE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")

# Distinct pieces kept per worker; beyond it the memory is emptied and refilled.
MEMORY = 600_000
# Bytes of text cut at once.
CUT_BYTES = 4 << 20
# Longer words are cut where pieces meet, longer pieces are merged by windows of this many letters.
WINDOW = 1 << 14
# Two neighbours that are in different pieces whatever stands around them: no apostrophe of a
# contraction, no sign inside a special token, nothing that composes with the character before.
_BORDER = re.compile(
    r"(?<=[0-9])(?=[!-~])|(?<=\S)(?=[0-9])|(?<=[。，、！？；：])(?=[一-鿿])"
    r"|(?<=[A-Za-z])(?=[!-&(-/:-@\[-`{}~])|(?<=[!-&(-/:-@\[-`{}~])(?=[A-Za-z])"
)

_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _kind(b: int) -> int:
    c = chr(b)
    if b == 0x20 or 0x09 <= b <= 0x0D:
        return _SPACE
    if b >= 0x7F or b < 0x20 or c in "'<":
        return _OTHER
    return _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN


_KIND = np.array([_kind(b) for b in range(256)], np.uint8)


def cut_pieces(array: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Pieces of all texts: a code for each, where each text begins, and the distinct ones."""
    data, offsets = A.buffer_of(array)
    kind, low = _KIND[data], A.LOWER[data]
    # Two-byte letters from U+00C0 to U+00FF; capitals stand 32 before their small letters.
    lead = np.flatnonzero(data == 0xC3)
    after = data[lead + 1]
    letter = (after != 0x97) & (after != 0xB7)
    kind[lead[letter]] = kind[lead[letter] + 1] = _LETTER
    capital = letter & (after <= 0x9E)
    low[lead[capital] + 1] += 0x20

    full = kind != _SPACE
    starts, ends, _ = A.spans(data, offsets, A.NOT_SPACE)
    others = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kind == _OTHER, out=others[1:])
    odd = others[ends] > others[starts]
    for a, b in zip(starts[odd].tolist(), ends[odd].tolist()):
        kind[a:b], low[a:b] = _OTHER, data[a:b]
    begins = np.zeros(len(data), bool)
    begins[1:] = kind[1:] != kind[:-1]
    begins |= kind == _DIGIT
    begins[starts] = True
    begins &= full
    at = np.flatnonzero(begins)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(full, out=before[1:])
    bounds = np.append(before[at], before[-1])
    pieces = pa.Array.from_buffers(
        pa.large_string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(low[full])]
    ).dictionary_encode()
    return np.asarray(pieces.indices), np.searchsorted(at, offsets), pieces.dictionary.to_pylist()


def word_parts(word: str) -> list[str]:
    """A word in parts whose tokens, one after the other, are the word's; the parts of a very long
    one are about a window, or as long as it has no border."""
    parts, at = [], 0
    while len(word) - at > WINDOW and (border := _BORDER.search(word, at + WINDOW)):
        parts.append(word[at : border.start()])
        at = border.start()
    return [*parts, word[at:]]


def byte_letters() -> dict[int, str]:
    """Byte to letter rule of byte-level vocabularies: printable bytes stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of words and pieces; pieces are remembered per worker."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        if _PATTERN_IN_FILE not in self.library.to_str().replace("\\\\", "\\"):
            raise ValueError(f"{path} does not split texts at white space as expected")
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.pieces: dict[str, bytes] = {}

    def _merged(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join(map(self.letters.get, piece.encode()))
        if len(text) > WINDOW:
            return self._long(text)
        return _packed([t.id for t in self.model.tokenize(text)])

    def _long(self, text: str) -> bytes:
        """Ids of a long piece, window by window.

        A chain of tokens is the encoding if each two neighbours stand side by side in some encoding.
        So a window may be left at any token with which another window begins.
        """
        out, at, size = [], 0, WINDOW
        tokens = self.model.tokenize(text[:size])
        while at + size < len(text):
            # The last token closes the piece, which the text does not do here.
            for k in range(len(tokens) - 2, len(tokens) // 2, -(len(tokens) // 16 + 1)):
                start = at + sum(len(t.value) for t in tokens[:k])
                after = self.model.tokenize(text[start : start + WINDOW])
                if len(after) > 1 and after[0].id == tokens[k].id:
                    out.append(_packed([t.id for t in tokens[:k]]))
                    at, size, tokens = start, WINDOW, after
                    break
            else:
                size *= 2
                tokens = self.model.tokenize(text[at : at + size])
        return b"".join([*out, _packed([t.id for t in tokens])])

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word) or any(s in word for s in self.special):
            return _packed(self.library.encode(word, add_special_tokens=False).ids)
        return b"".join(map(self._merged, _SPLIT.findall(word.lower())))

    def encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of every piece or odd word as little-endian unsigned 32-bit numbers."""
        memory = self.pieces
        if len(memory) + len(pieces) > MEMORY:
            memory.clear()
        out = list(map(memory.get, pieces))
        for i, ids in enumerate(out):
            if ids is None:
                piece = pieces[i]
                ids = self._merged(piece) if _PIECE.fullmatch(piece) else self._word(piece)
                out[i] = ids
                if len(piece) <= WINDOW:
                    memory[piece] = ids
        return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """The worker's encoder of a tokenizer, by public name or path; loaded once per worker."""
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(name if "/" in name else public_tokenizers.path(name))
    return _ENCODERS[name]
