"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability under a language is the sum over all its segmentations into pieces, by a forward
pass; a text's log-probability is the sum over its words. Words are runs of ASCII letters and
bytes above 127, lower-cased; digits and signs say nothing about the language.

Learning counts the pieces of all segmentations, too: a first model gives each piece the same
probability, a forward-backward pass turns it into expected counts, and smoothing gives the
model. Counts cover a documented sample: per language about ``SAMPLE_DOCS`` documents (all, if
there are fewer), whose ids' hashes fall into the share of the hash range that gives as many. The
model has (languages x pieces) numbers.

* NULL text or no letter: language ``und``, score 0.
* NULL id: not held out, but not learned from either. NULL language: not learned from.
* Without any labelled document every text is ``und``.
* Whole texts count. Runs of more than ``WORD_BYTES`` bytes are scored in pieces of that length.
* Repeated rows and ids: one result row per input row. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscape.llm import arrow as A

VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
SAMPLE_DOCS = 2_000
SMOOTHING = 0.5
WORD_BYTES = 32
MEMORY = 400_000
FOLDS = 5
MARK = "▁"

_LETTER = A.byte_class(lambda b: b >= 0x80 or chr(b).isalpha())


class Pieces:
    """The vocabulary as a byte trie: a transition table and the piece that ends at each node.

    Only pieces of lower-case letters are kept; single bytes make every word reachable. A piece
    that begins a word and one that stands inside are different pieces.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {bytes([b]) for b in range(256) if _LETTER[b]}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            raw = piece.removeprefix(MARK).encode()
            if raw and len(raw) <= WORD_BYTES and all(_LETTER[b] for b in raw) and piece == piece.lower():
                names.add(b"\x00" * piece.startswith(MARK) + raw)
        self.names = sorted(names)
        nodes: list[dict[int, int]] = [{}]
        ends = {0: -1}
        for i, name in enumerate(self.names):
            at = 0
            for b in name:
                if b not in nodes[at]:
                    nodes[at][b] = len(nodes)
                    nodes.append({})
                at = nodes[at][b]
            ends[at] = i
        self.next = np.zeros((len(nodes), 256), np.int32)
        for at, steps in enumerate(nodes):
            for b, to in steps.items():
                self.next[at, b] = to
        self.ends = np.full(len(nodes), -1, np.int32)
        self.ends[list(ends)] = list(ends.values())
        self.begin = int(self.next[0, 0])  # where pieces that begin a word start

    def matches(self, words: np.ndarray, lengths: np.ndarray):
        """(start, stop, rows, pieces) of every piece found in a matrix of padded words."""
        for start in range(words.shape[1]):
            rows = np.flatnonzero(lengths > start)
            if not len(rows):
                return
            for root in (self.begin, 0) if start == 0 else (0,):
                live, at = rows, np.full(len(rows), root, np.int32)
                for stop in range(start + 1, words.shape[1] + 1):
                    at = self.next[at, words[live, stop - 1]]
                    going = (at > 0) & (lengths[live] >= stop)
                    live, at = live[going], at[going]
                    if not len(live):
                        break
                    piece = self.ends[at]
                    hit = piece >= 0
                    if hit.any():
                        yield start, stop, live[hit], piece[hit]


@cache
def pieces(name: str) -> Pieces:
    return Pieces(name if "/" in name else public_tokenizers.path(name))


def forward(vocabulary: Pieces, words: np.ndarray, lengths: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Log-probability of each word (rows) under each language (columns of ``p``)."""
    alpha = np.zeros((words.shape[1] + 1, len(words), p.shape[1]))
    alpha[0] = 1.0
    for start, stop, rows, found in vocabulary.matches(words, lengths):
        alpha[stop, rows] += alpha[start, rows] * p[found]
    return np.log(np.maximum(alpha[lengths, np.arange(len(words))], 1e-300))


def expected_counts(
    vocabulary: Pieces, words: np.ndarray, lengths: np.ndarray, weights: np.ndarray, p: np.ndarray
) -> np.ndarray:
    """Expected piece counts (pieces x languages) over all segmentations of weighted words.

    ``p`` has one column; ``weights`` has a column per language.
    """
    steps = list(vocabulary.matches(words, lengths))
    n = len(words)
    alpha, beta = np.zeros((words.shape[1] + 1, n)), np.zeros((words.shape[1] + 1, n))
    alpha[0] = 1.0
    for start, stop, rows, found in steps:
        alpha[stop, rows] += alpha[start, rows] * p[found]
    beta[lengths, np.arange(n)] = 1.0
    for start, stop, rows, found in reversed(steps):
        beta[start, rows] += beta[stop, rows] * p[found]
    total = alpha[lengths, np.arange(n)]
    out = np.zeros((len(vocabulary.names), weights.shape[1]))
    for start, stop, rows, found in steps:
        share = alpha[start, rows] * p[found] * beta[stop, rows] / total[rows]
        for k in range(weights.shape[1]):
            out[:, k] += np.bincount(found, share * weights[rows, k], len(out))
    return out


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as a matrix of bytes, zero beyond their ends."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=1))
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    return flat.reshape(len(words), width), lengths


def letter_words(array: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word codes of all texts, where each text begins, and the distinct words."""
    lowered = pc.utf8_lower(array)
    data, offsets = A.buffer_of(lowered)
    blank = np.where(_LETTER[data], data, np.uint8(0x20))
    spaced = pa.Array.from_buffers(
        pa.large_binary(), len(array), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(blank.tobytes())]
    ).view(pa.large_string())
    codes, first, words = A.coded_words(spaced)
    return codes, first, [w.encode() for w in words]


def cut(word: bytes) -> list[bytes]:
    return [word[i : i + WORD_BYTES] for i in range(0, len(word), WORD_BYTES)]


class Model:
    """Piece probabilities per language."""

    def __init__(self, languages: list[str], p: np.ndarray, vocabulary: str):
        self.languages, self.p, self.vocabulary = languages, p, vocabulary
        self.memory: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(languages)))

    def __getstate__(self):
        return self.languages, self.p, self.vocabulary

    def __setstate__(self, state):
        self.__init__(*state)

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """Log-probability of each word (rows) under each language, remembered per worker."""
        if len(self.memory) + len(words) > MEMORY:
            self.memory, self.scores = {}, self.scores[:0]
        new = [w for w in words if w not in self.memory and w]
        parts = [(w, x) for w in new for x in cut(w)]
        if parts:
            order = sorted(range(len(parts)), key=lambda i: len(parts[i][1]))
            scored = np.empty((len(parts), len(self.languages)))
            for a in range(0, len(order), 8192):
                some = order[a : a + 8192]
                matrix, lengths = padded([parts[i][1] for i in some])
                scored[some] = forward(pieces(self.vocabulary), matrix, lengths, self.p)
            counts = np.array([-(-len(w) // WORD_BYTES) for w in new])
            at = np.cumsum(counts) - counts
            fresh = np.add.reduceat(scored, at)
            base = len(self.scores)
            self.memory.update((w, base + i) for i, w in enumerate(new))
            self.scores = np.concatenate([self.scores, fresh])
        index = np.fromiter((self.memory.get(w, -1) for w in words), np.int64, len(words))
        out = np.zeros((len(words), len(self.languages)))
        out[index >= 0] = self.scores[index[index >= 0]]
        return out

    def predict(self, array: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.

        The score is the best language's posterior for the text's average word, under equal
        priors, so it does not saturate with length.
        """
        if not self.languages:
            return [UNDETERMINED] * len(array), np.zeros(len(array))
        names, scores = [], []
        for a, b in A.slices(array, A.SLICE_BYTES // 2):
            part = array.slice(a, b - a)
            codes, first, words = letter_words(part)
            per_word = self.word_scores(words)[codes]
            filled = np.array([len(w) > 0 for w in words] or [False])[codes] if len(codes) else np.zeros(0, bool)
            sums = np.zeros((len(codes) + 1, len(self.languages)))
            np.cumsum(per_word, axis=0, out=sums[1:])
            total = sums[first[1:]] - sums[first[:-1]]
            n = A.per_text(filled, first)
            best = total.argmax(axis=1)
            mean = total / np.maximum(n, 1)[:, None]
            score = 1 / np.exp(mean - mean.max(axis=1, keepdims=True)).sum(axis=1)
            letters = has_letter(part)
            names += [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters)]
            scores.append(np.where(letters, score, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def has_letter(array: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    data, offsets = A.buffer_of(array)
    plain = A.per_text(A.byte_class(lambda b: b < 0x80 and chr(b).isalpha())[data], offsets) > 0
    for i in np.flatnonzero(~plain):
        plain[i] = any(map(str.isalpha, array[int(i)].as_py()))
    return plain


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether a document is kept from learning: crc32 of its id leaves no rest."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    sample: int = SAMPLE_DOCS,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Fit piece probabilities on the labelled documents that are not held out."""
    key = F.xxhash64(F.col(id_col), F.lit(7))
    labelled = docs.filter(
        F.col(lang).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)
    )
    # A share of the hash range per language: a count per language is all that is gathered, and
    # no language's documents meet in one task.
    sizes = {r[lang]: r["count"] for r in labelled.groupBy(lang).count().collect()}
    last = (1 << 63) - 1
    limits = {k: min((sample << 64) // n - (1 << 63), last) for k, n in sizes.items()}
    languages = sorted(limits)
    if not languages:
        return Model([], np.zeros((0, 0)), vocabulary)
    chosen = F.lit(False)
    for name, most in limits.items():
        chosen = chosen | ((F.col(lang) == name) & (F.col("_key") <= F.lit(most)))
    needed = (
        labelled.withColumn("_key", key)
        .filter(chosen)
        .select(F.col(lang).alias("_lang"), F.col(text).cast("string").alias("_text"))
    )
    n_pieces = len(pieces(vocabulary).names)

    def run(table: pa.Table) -> pa.Table:
        v = pieces(vocabulary)
        uniform = np.full(len(v.names), 1 / len(v.names))
        column = np.array([languages.index(x) for x in table["_lang"].to_pylist()])
        array = A.texts(table["_text"])
        total = np.zeros((len(v.names), len(languages)))
        for a, b in A.slices(array):
            codes, first, words = letter_words(array.slice(a, b - a))
            owner = np.repeat(column[a:b], np.diff(first))
            weights = np.zeros((len(words), len(languages)))
            np.add.at(weights, (codes, owner), 1)
            parts = [(i, x) for i, w in enumerate(words) for x in cut(w)]
            for at in range(0, len(parts), 8192):
                some = parts[at : at + 8192]
                matrix, lengths = padded([x for _, x in some])
                total += expected_counts(v, matrix, lengths, weights[[i for i, _ in some]], uniform)
        rows, columns = np.nonzero(total)
        return pa.table({"piece": rows, "language": columns, "n": total[rows, columns]})

    counted = A.map_tables(needed, run, "piece long, language long, n double")
    summed = counted.groupBy("piece", "language").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((n_pieces, len(languages)))
    # Rounded so that the order of adding partial counts cannot show.
    counts[summed["piece"], summed["language"]] = summed["n"].round(6)
    return Model(languages, (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=0), vocabulary)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Id, fold, predicted language and score of every document. No shuffle; only the text is
    an input of the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        names, scores = shared.value.predict(A.texts(table["_text"]))
        return pa.table(
            {id_col: table[id_col], "held_out": table["_held_out"], "lang_pred": pa.array(names, pa.string()), "score": scores}
        )

    kind = docs.schema[id_col].dataType.simpleString()
    needed = docs.select(id_col, held_out(id_col).alias("_held_out"), F.col(text).cast("string").alias("_text"))
    return A.map_tables(needed, run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents' own columns, whatever their names, as struct ``doc``, then ``lang_pred``
    and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))

    def run(table: pa.Table) -> pa.Table:
        names, scores = shared.value.predict(A.texts(pc.struct_field(table["doc"], text)))
        out = table.append_column("lang_pred", pa.array(names, pa.string()))
        return out.append_column("score", pa.array(scores, pa.float64()))

    schema = T.StructType([whole.schema["doc"]]).add("lang_pred", "string").add("score", "double")
    return A.map_tables(whole, run, schema)
