"""Piece encoding and decoding: an Aho-Corasick automaton drives a single pass.

The automaton over all pieces of a public vocabulary reads a chunk once. At each position its
output links name every piece that ends there. The queries encode as the vocabulary's model does
(``MergeCodec``): its scores are ranks of merges, and of the pieces that end at a position exactly
one is compatible with the piece before it, that is, no merge across their border would have come
before their own merges. As every part of such a chain is the encoding of its own characters, one
pass with a link back per position suffices.

``PieceCodec`` is the single-pass Viterbi for vocabularies whose scores are log-probabilities:
``best[end] = max(best[end - len] + score)``, bytes at a fixed low score, of equal scores the longer
last piece. Over ranks of merges its sums are not the model's encoding.

Characters no piece covers become one byte piece per byte.

A blank is written as the mark ``▁`` and one more stands before the text. No piece holds a mark
after another character, nor a line feed, so chunks beginning with their marks or at a line feed
are segmented independently, and each distinct chunk once per worker. A mark that stands in the
text itself is encoded by its bytes, so decoding restores every text exactly.

* NULL text: no pieces, decodes to NULL. Empty text: no pieces.
* Repeated rows and ids: one result row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

MODEL = "piece_bpe_32k.model"
MARK = "▁"
# Pieces the vocabulary scores lower (bare marks) count as this; a byte piece as the other.
SCORE_FLOOR = -1e5
BYTE_PENALTY = -1e6
UNREACHED = float("-inf")
MEMORY = 500_000
# Rank of a character, which no merge makes, and the bound behind all merges.
UNMERGED, LAST = float("-inf"), float("inf")
# Stands for a line feed that ends a chunk; texts holding it are cut one by one.
_FEED = "\x01"
_CHUNK = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*|[^{MARK}\n]+")
_ODD = f"^ | $|  |\n | \n|\n$|{_FEED}|{MARK}"


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceCodec:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes_id, self.surface, self.scores = {}, [b""] * n, {}
        self.automaton = ahocorasick.Automaton()
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_id[int(piece[3:-1], 16)] = i
                self.surface[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if piece and MARK not in piece.lstrip(MARK) and "\n" not in piece and _FEED not in piece:
                    score = max(model.get_score(i), SCORE_FLOOR)
                    self.automaton.add_word(piece, (len(piece), score, i))
                    self.surface[i] = piece.replace(MARK, " ").encode()
        self.automaton.make_automaton()
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.memory: dict[str, bytes] = {}

    def viterbi(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of a chunk, its blanks already written as marks."""
        n = len(chunk)
        best = [0.0] + [UNREACHED] * n
        back: list[tuple | None] = [None] * (n + 1)
        # At each position the output links yield the longest piece first, so it wins ties.
        for last, found in self.automaton.iter(chunk):
            total = best[last + 1 - found[0]] + found[1]
            if total > best[last + 1]:
                best[last + 1], back[last + 1] = total, found
        if UNREACHED in best:
            back = self._with_bytes(chunk)
        out: list[int] = []
        while n:
            length, _, i = back[n]
            out += [i] if i >= 0 else [self.bytes_id[b] for b in reversed(chunk[n - 1].encode())]
            n -= length
        out.reverse()
        return out

    def _with_bytes(self, chunk: str) -> list[tuple | None]:
        """The same pass where some character may need its bytes."""
        ending: list[list[tuple]] = [[] for _ in range(len(chunk) + 1)]
        for last, found in self.automaton.iter(chunk):
            ending[last + 1].append(found)
        best, back = [0.0], [None]
        for end in range(1, len(chunk) + 1):
            choices = [*ending[end], (1, len(chunk[end - 1].encode()) * BYTE_PENALTY, -1)]
            scores = [best[end - length] + score for length, score, _ in choices]
            best.append(max(scores))
            back.append(choices[scores.index(best[-1])])
        return back

    segment = viterbi

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian 32-bit numbers, remembered."""
        found = self.memory.get(chunk)
        if found is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            found = self.memory[chunk] = _packed(self.segment(chunk))
        return found

    def encode_one(self, text: str) -> bytes:
        """Ids of one text, of any content."""
        if not text:
            return b""
        out = []
        for k, part in enumerate(text.split(MARK)):
            if k:  # a mark that is part of the text
                out.append(_packed([self.bytes_id[b] for b in MARK.encode()]))
            part = part.replace(" ", MARK)
            out += map(self.chunk_ids, _CHUNK.findall(part if k else MARK + part))
        return b"".join(out)

    def encode(self, array: pa.Array) -> list[bytes]:
        """Ids of every text of a large-string array."""
        odd = pc.or_(pc.match_substring_regex(array, _ODD), pc.equal(pc.binary_length(array), 0))
        odd = np.asarray(odd)
        out: list[bytes] = [b""] * len(array)
        for i in np.flatnonzero(odd):
            out[i] = self.encode_one(array[int(i)].as_py())
        plain = np.flatnonzero(~odd)
        chosen = array if len(plain) == len(array) else array.take(pa.array(plain))
        for a, b in A.slices(chosen, A.WORD_BYTES):
            for i, ids in zip(plain[a:b], self._encode_plain(chosen.slice(a, b - a))):
                out[i] = ids
        return out

    def _encode_plain(self, array: pa.Array) -> list[bytes]:
        cut = pc.split_pattern(pc.replace_substring(array, "\n", f" {_FEED}"), " ")
        flat = cut.flatten()
        coded = (flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat).dictionary_encode()
        ids = [
            self.chunk_ids("\n" + w[1:] if w[:1] == _FEED else MARK + w)
            for w in coded.dictionary.to_pylist()
        ]
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        starts = np.cumsum(lengths) - lengths
        codes = np.asarray(coded.indices)
        flat_ids = A.gather(lengths[codes], starts[codes], np.frombuffer(b"".join(ids), "<u4"))
        words = np.asarray(cut.offsets)
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(lengths[codes], out=ends[1:])
        bounds = ends[words - words[0]]
        return [flat_ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def decode(self, ids: bytes) -> str:
        """Text of one document's ids."""
        if not ids:
            return ""
        i = np.frombuffer(ids, "<u4")
        raw = A.gather(self.lengths[i], self.starts[i], self.flat).tobytes()
        return raw[1:].decode()


class MergeCodec(PieceCodec):
    """The encoding of a model whose scores are ranks of merges, the earliest the highest."""

    def __init__(self, path: str):
        super().__init__(path)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, float] = {}
        for i in range(model.get_piece_size()):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self.ids[piece], self.ranks[piece] = i, -model.get_score(i)
                self.surface[i] = piece.replace(MARK, " ").encode()
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.halves: dict[str, tuple[str, str, float] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.pieces = ahocorasick.Automaton()
        for piece in self.ids:
            # Characters are tried in any case, whether the vocabulary has them or not.
            if len(piece) > 1 and self.made_of(piece):
                self.pieces.add_word(piece, piece)
        self.pieces.make_automaton()

    def made_of(self, piece: str) -> tuple[str, str, float] | None:
        """The two parts whose merge makes a piece, and its rank; None if merges do not make it."""
        if piece not in self.halves:
            parts, last = list(piece), None
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, LAST), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == LAST:
                    last = None
                    break
                last = (parts[at], parts[at + 1], rank)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[piece] = last
        return self.halves[piece]

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge across the border comes before those that make the two pieces.

        The merges are undone from the latest; of equal ranks the left one was made first.
        """
        limit, strict = LAST, True
        while True:
            across = self.ranks.get(left + right, LAST)
            if across < limit or (not strict and across == limit):
                return False
            a = self.made_of(left) if len(left) > 1 else None
            b = self.made_of(right) if len(right) > 1 else None
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[2] > b[2]):
                left, limit, strict = a[1], a[2], True
            else:
                right, limit, strict = b[0], b[2], False

    def segment(self, chunk: str) -> list[int]:
        """Ids of the model's segmentation of a chunk, its blanks already written as marks."""
        pairs, compatible = self.pairs, self.compatible
        if len(pairs) >= MEMORY:
            pairs.clear()
        # The last piece of every prefix. The longest pieces come first from the output links.
        ends: list[str] = [""] + list(chunk)
        done = 1
        for last, piece in self.pieces.iter(chunk):
            end = last + 1
            if end < done:
                continue
            before = ends[end - len(piece)]
            if before:
                key = (before, piece)
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = compatible(before, piece)
                if not fits:
                    continue
            ends[end], done = piece, end + 1
        out: list[int] = []
        at = len(chunk)
        while at:
            piece = ends[at]
            i = self.ids.get(piece)
            out += [i] if i is not None else [self.bytes_id[b] for b in reversed(piece.encode())]
            at -= len(piece)
        out.reverse()
        return out


_CODECS: dict[tuple[type, str], PieceCodec] = {}


def codec(name: str = MODEL, kind: type[PieceCodec] = PieceCodec) -> PieceCodec:
    """The worker's codec of a vocabulary, by public name or path; loaded once per worker."""
    if (kind, name) not in _CODECS:
        _CODECS[kind, name] = kind(name if "/" in name else public_tokenizers.path(name))
    return _CODECS[kind, name]


def encode_pieces(
    docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Id and piece ids (little-endian unsigned 32-bit numbers) of every text. No shuffle."""

    def run(table: pa.Table) -> pa.Table:
        array = A.texts(table["_text"])
        ids = pa.array(codec(model, MergeCodec).encode(array), pa.binary())
        null = table["_text"].combine_chunks().is_null() if len(array) else None
        return pa.table({id_col: table[id_col], "ids": pc.if_else(null, None, ids) if len(array) else ids})

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, F.col(text).cast("string").alias("_text"))
    return A.map_tables(needed, run, f"`{id_col}` {kind}, ids binary")


def decode_pieces(encoded: DataFrame, model: str = MODEL, id_col: str = "doc_id") -> DataFrame:
    """Id and text of every document's piece ids."""

    def run(table: pa.Table) -> pa.Table:
        out = [None if x is None else codec(model, MergeCodec).decode(x) for x in table["ids"].to_pylist()]
        return pa.table({id_col: table[id_col], "text": pa.array(out, pa.string())})

    kind = encoded.schema[id_col].dataType.simpleString()
    return A.map_tables(encoded.select(id_col, "ids"), run, f"`{id_col}` {kind}, text string")


def digest(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: pieces, byte pieces, checksum of the ids, and whether decoding restores it."""

    def run(table: pa.Table) -> pa.Table:
        from zlib import crc32

        c = codec(model, MergeCodec)
        array = A.texts(table["_text"])
        low = np.zeros(len(c.surface), bool)
        low[list(c.bytes_id.values())] = True
        pieces, fallback, sums, same = [], [], [], []
        for a, b in A.slices(array):
            part = array.slice(a, b - a)
            for ids, value in zip(c.encode(part), part.to_pylist()):
                numbers = np.frombuffer(ids, "<u4")
                pieces.append(len(numbers))
                fallback.append(int(low[numbers].sum()))
                sums.append(crc32(ids))
                same.append(c.decode(ids) == value)
        return pa.table(
            {
                id_col: table[id_col],
                "n_pieces": pa.array(pieces, pa.int64()),
                "n_byte_pieces": pa.array(fallback, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
                "restored": pa.array(same, pa.bool_()),
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, F.col(text).cast("string").alias("_text"))
    schema = f"`{id_col}` {kind}, n_pieces long, n_byte_pieces long, ids_crc32 long, restored boolean"
    return A.map_tables(needed, run, schema)
