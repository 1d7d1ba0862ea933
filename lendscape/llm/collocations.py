"""Phrase collocations per language by Toivonen's sampling method, with exact counts.

A phrase is frequent with ``MIN_COUNT`` occurrences, which all its parts then have, too. A sample
of the documents, mined at a lowered count, proposes words and pairs. One full pass counts, over
all documents, every phrase whose parts are proposed: the proposed phrases themselves and their
negative border, the phrases just beyond them (all words; pairs of proposed words; triples of
two proposed pairs). A phrase of the border that turns out frequent is a failure of the sample:
what it is a part of was not counted. Failures are added to the proposal, and a further pass
counts what the larger proposal covers and the smaller one did not, until no failure is left.
Every frequent phrase has then been counted, each in one pass and over all documents. Sample size
and lowered count decide how much is counted in which pass, never the result.

* Tasks hold the proposal as Bloom filters of at most ``FILTER_BITS``, whatever the vocabulary. A
  false positive adds a phrase to those counted. Nothing is missed, and as the bits of a proposal
  only grow, no phrase is counted in two passes.
* Phrases are added up within a slice of text before they leave Python, then within the task,
  then shuffled as strings, so that equal hashes cannot merge them. Only frequent ones are stored.
* Texts beyond a slice are cut at separators of pieces: a task holds a slice, or a piece.
* The filters are put together by Spark's bitmap aggregation and reach the driver with that size;
  besides them it sees whether there are failures.
* Frequent words stand in many phrases: both inputs of the joins that look up parts are stored, so
  that adaptive execution splits them. The first ranks of a language come from ranks of many
  hashed shares.

* NULL text counts as empty, NULL language as ``und``.
* Repeated rows and ids count as often as they occur; ids are not read.
* Phrases of equal score and count rank by their UTF-8 bytes.
* A table without a candidate, such as an empty one, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
DROP_PERCENT = 50
SCALE = 1_000_000
NO_LANG = "und"
# One document in so many is in the sample; phrases with so many occurrences there are proposed.
SAMPLE_SHARE = 8
SAMPLE_COUNT = 2
# A filter has a power of two of bits, at least so many per phrase the sample proposed, and at most
# ``FILTER_BITS``. Two are set per phrase.
BITS_PER_PHRASE = 16
FILTER_BITS = 1 << 28
# Text handled at once: arrays of it and of its words take about thirty times as much.
SLICE = 1 << 20
# Shares of a language ranked on their own before its first ranks are taken.
SHARES = 256

_BITMAP = 1 << 15
_SENT_ROWS = 1 << 14
SEPARATOR = A.byte_class(lambda b: b in b".,;:!?" or 0x0A <= b <= 0x0D)
MEMBER = A.byte_class(lambda b: b not in b" \t") & ~SEPARATOR
COUNTS = "lang string, phrase string, n int, count long"


class Proposal:
    """Filters of proposed words and pairs; without filters, everything is proposed."""

    def __init__(self, words: np.ndarray | None = None, pairs: np.ndarray | None = None):
        self.words, self.pairs = words, pairs

    @staticmethod
    def _has(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in filter_places(hashes, len(bits) * 8) if bits is not None else ():
            out &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def has_words(self, hashes: np.ndarray) -> np.ndarray:
        return self._has(self.words, hashes)

    def has_pairs(self, hashes: np.ndarray) -> np.ndarray:
        return self._has(self.pairs, hashes)


def filter_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes % np.uint64(bits), A.mix(hashes) % np.uint64(bits)


def string_hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = A.buffer_of(strings.cast(pa.large_string()))
    return A.hash_spans(data, offsets[:-1], offsets[1:])


def joined(parts: list, by: str) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(by, pa.large_string()))


def word_hashes(langs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of a word of a language, from hashes of both."""
    return A.mix(words ^ (langs * np.uint64(A.MIX[0])))


def lang_hashes(langs: pa.Array) -> np.ndarray:
    return string_hashes(joined([langs.cast(pa.large_string()), pa.scalar("", pa.large_string())], "\t"))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return A.mix(first * np.uint64(A.BASE) + second)


def text_slices(table: pa.Table, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(bytes, offsets of texts in them, language per text); longer texts in parts that end at a
    separator."""
    texts, langs = A.texts(table["text"]), table["lang"].combine_chunks()
    for start, stop in A.slices(texts, most):
        data, offsets = A.buffer_of(texts.slice(start, stop - start))
        if len(data) <= 2 * most:
            yield data, offsets, langs.slice(start, stop - start)
            continue
        at = 0
        while at < len(data):  # a single text
            end = min(at + most, len(data))
            while end < len(data) and not SEPARATOR[data[end - 1]]:
                found = np.flatnonzero(SEPARATOR[data[end : end + (1 << 16)]])
                end = end + int(found[0]) + 1 if len(found) else min(end + (1 << 16), len(data))
            yield data[at:end], np.array([0, end - at]), langs.slice(start, 1)
            at = end


class Words:
    """Words of a slice: numbers of (language, word), and which stand before the next one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        low = A.LOWER[data]
        starts, ends, first = A.spans(low, offsets, MEMBER)
        apart = np.zeros(len(low) + 1, np.int32)
        np.cumsum(SEPARATOR[low], out=apart[1:])
        self.joined = apart[starts[1:]] == apart[ends[:-1]]
        borders = first[1:-1]
        self.joined[borders[(borders > 0) & (borders < len(starts))] - 1] = False
        # Member bytes one after the other are the words, since words are their maximal runs.
        lengths = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=lengths[1:])
        words = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(low[MEMBER[low]])]
        ).dictionary_encode()
        self.strings, codes = words.dictionary, np.asarray(words.indices).astype(np.int64)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        lang = np.repeat(np.asarray(coded.indices).astype(np.int64), np.diff(first))
        d = max(1, len(self.strings))
        numbers, self.ids, self.counts = np.unique(lang * d + codes, return_inverse=True, return_counts=True)
        self.lang_of, self.string_of = numbers // d, numbers % d

    def hashes(self) -> np.ndarray:
        return word_hashes(lang_hashes(self.langs)[self.lang_of], string_hashes(self.strings)[self.string_of])

    def table(self, parts: list[np.ndarray], counts: np.ndarray) -> pa.Table:
        """Counted phrases, given by the numbers of their words."""
        strings = [self.strings.take(pa.array(self.string_of[p])) for p in parts]
        phrase = joined(strings, " ")
        return counted(self.langs.take(pa.array(self.lang_of[parts[0]])), phrase, len(parts), counts)


def counted(langs: pa.Array, phrases: pa.Array, n: int, counts: np.ndarray) -> pa.Table:
    columns = [langs.cast(pa.string()), phrases.cast(pa.string()), pa.array(np.full(len(counts), n, np.int32)), pa.array(counts)]
    return pa.Table.from_arrays(columns, ["lang", "phrase", "n", "count"])


def count_slice(words: Words, now: Proposal, before: Proposal | None, longest: int) -> Iterator[pa.Table]:
    """Phrases that ``now`` covers and ``before`` does not; words and their total in a first pass.

    The total of a language is the count of its phrase without words.
    """
    ids, h = words.ids, words.hashes()
    if before is None:
        totals = np.bincount(words.lang_of, words.counts, len(words.langs)).astype(np.int64)
        yield counted(words.langs, pa.array([""] * len(words.langs)), 0, totals)
        yield words.table([np.arange(len(words.counts))], words.counts)
    known = now.has_words(h)
    at = np.flatnonzero(words.joined & known[ids[:-1]] & known[ids[1:]])
    a, b, w = ids[at], ids[at + 1], len(words.counts)
    old = np.zeros(len(at), bool)
    if before is not None:
        was = before.has_words(h)
        old = was[a] & was[b]
    keys, counts = np.unique(a[~old] * w + b[~old], return_counts=True)
    yield words.table([keys // w, keys % w], counts)
    if longest < 3 or len(at) < 2:
        return
    hashes = pair_hashes(h[a], h[b])
    proposed = now.has_pairs(hashes)
    chosen = (np.diff(at) == 1) & proposed[:-1] & proposed[1:]
    if before is not None:
        counted_before = old & before.has_pairs(hashes)
        chosen &= ~(counted_before[:-1] & counted_before[1:])
    i = np.flatnonzero(chosen)
    pairs, pair_of = np.unique(a[i] * w + b[i], return_inverse=True)
    keys, counts = np.unique(pair_of * w + b[i + 1], return_counts=True)
    first = pairs[keys // w]
    yield words.table([first // w, first % w, keys % w], counts)


def count_phrases(docs: DataFrame, now, before=None, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, n, count) over all documents; proposals are broadcast, ``now`` may be None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, earlier = now.value if now else Proposal(), before.value if before else None
        for batch in batches:
            for data, offsets, langs in text_slices(pa.Table.from_batches([batch]), SLICE):
                for part in count_slice(Words(data, offsets, langs), whole, earlier, longest):
                    yield from part.to_batches(max_chunksize=_SENT_ROWS)
            pa.default_memory_pool().release_unused()

    found = A.reachable(docs).mapInArrow(run, COUNTS)
    return found.groupBy("lang", "phrase", "n").agg(F.sum("count").alias("count"))


def phrase_hashes(table: pa.Table, n: int) -> np.ndarray:
    """Hashes of words (n = 1) or pairs (n = 2) as the counting pass computes them."""
    langs = lang_hashes(table["lang"].combine_chunks())
    words = pc.split_pattern(table["phrase"].combine_chunks().cast(pa.large_string()), " ").flatten()
    hashes = string_hashes(words)
    if n == 1:
        return word_hashes(langs, hashes)
    return pair_hashes(word_hashes(langs, hashes[::2]), word_hashes(langs, hashes[1::2]))


def filter_bits(phrases: int, most: int) -> int:
    """Size of a filter: a whole number of bitmaps, in the end ``most``."""
    return max(_BITMAP, min(most, 1 << (BITS_PER_PHRASE * phrases).bit_length()))


def filter_of(phrases: DataFrame, n: int, bits: int) -> np.ndarray:
    """Bits of the phrases of n words; set in tasks, brought together as bitmaps."""

    def places(table: pa.Table) -> pa.Table:
        at = np.concatenate(filter_places(phrase_hashes(table, n), bits)).astype(np.int64)
        return pa.table({"part": pa.array((at // _BITMAP).astype(np.int32)), "place": pa.array(at % _BITMAP)})

    chosen = phrases.filter(F.col("n") == n).select("lang", "phrase")
    rows = A.map_tables(chosen, places, "part int, place long").groupBy("part")
    out = np.zeros((bits // _BITMAP, _BITMAP // 8), np.uint8)
    for part, bitmap in rows.agg(F.bitmap_construct_agg("place")).collect():
        out[part] = np.frombuffer(bitmap, np.uint8)
    return out.ravel()


def failures(frequent: DataFrame, proposal, longest: int) -> DataFrame:
    """Frequent words and pairs that were not proposed though longer phrases rest on them."""

    def missed(n: int) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            hashes = phrase_hashes(table, n)
            has = proposal.value.has_words(hashes) if n == 1 else proposal.value.has_pairs(hashes)
            return table.filter(pa.array(~has))

        return run

    out = None
    for n in range(1, longest):
        level = frequent.filter(F.col("n") == n).select("lang", "phrase", "n")
        missing = A.map_tables(level, missed(n), level.schema)
        out = missing if out is None else out.unionByName(missing)
    return out


def frequent_phrases(
    texts: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    share: int = SAMPLE_SHARE,
    sample_count: int = SAMPLE_COUNT,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, phrase, n, count) of all frequent phrases of (lang, text) rows; exact.

    The phrase without words holds the total of its language.
    """
    if not 2 <= longest <= 3:
        raise ValueError("phrases have two or three words")
    sc = texts.sparkSession.sparkContext
    sampled = texts.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(share)) == 0)
    proposed = count_phrases(sampled, None, longest=2).filter((F.col("n") > 0) & (F.col("count") >= sample_count))
    proposed = A.staged(proposed, "proposed")
    sizes = {n: filter_bits(m, bits) for n, m in proposed.groupBy("n").count().collect()}
    sizes = {n: sizes.get(n, _BITMAP) for n in (1, 2)}
    now = sc.broadcast(Proposal(*(filter_of(proposed, n, sizes[n]) for n in (1, 2))))
    before, frequent = None, None
    while True:
        found = count_phrases(texts, now, before, longest)
        found = A.staged(found.filter((F.col("n") == 0) | (F.col("count") >= min_count)), "frequent")
        frequent = found if frequent is None else frequent.unionByName(found)
        missed = A.staged(failures(frequent, now, longest), "failures")
        if missed.isEmpty():
            return frequent
        words, pairs = (filter_of(missed, n, sizes[n]) for n in (1, 2))
        before, now = now, sc.broadcast(Proposal(now.value.words | words, now.value.pairs | pairs))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a^2 / (l r)) in decimals; at most SCALE, since a exceeds neither part."""
    exact = lambda c: c.cast("decimal(14,0)")
    top = F.lit(SCALE).cast("decimal(7,0)") * (exact(a) * exact(a))
    return F.call_function("div", top, exact(left) * exact(right)).cast("long")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    top: int = TOP,
    drop_percent: int = DROP_PERCENT,
    shares: int = SHARES,
    **options,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language."""
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    frequent = frequent_phrases(texts, **options)
    candidates = frequent.filter("n >= 2").select("lang", "phrase", "n", F.col("count").alias("a"))
    counts = frequent.filter("n >= 1").select("lang", "phrase", "count")

    first = lambda k: F.substring_index("phrase", " ", k)
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - n)"),
        }
    )
    looked_up = A.staged(
        cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l")), ["lang", "left"]),
        "left",
    ).join(counts.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r")), ["lang", "right"])
    scored = (
        looked_up.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = candidates.filter("n = 3").select(
        "lang", F.explode(F.array(first(2), first(-2))).alias("phrase"), F.col("a").alias("longer")
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (
        scored.join(inner, ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("longer") < drop_percent * F.col("a"), F.lit(True)))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    best = (
        kept.withColumn("_share", share)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
        .filter(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
    )
    totals = frequent.filter("n = 0").select("lang", F.col("count").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql() -> str:
    """The same ranks in plain SQL, every phrase counted."""
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)),
    lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM lists, (VALUES (1), (2), (3)) AS lengths(k)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS c FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND c >= {MIN_COUNT}),
cuts AS (
  SELECT *, array_to_string(w[1 : cut], ' ') AS front, array_to_string(w[cut + 1 :], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) AS places(cut) WHERE cut < k),
scored AS (
  SELECT lang, cuts.phrase, a, x.c AS l, y.c AS r, ({SCALE}::HUGEINT * a * a) // (x.c * y.c) AS score,
    row_number() OVER (PARTITION BY lang, cuts.phrase ORDER BY ({SCALE}::HUGEINT * a * a) // (x.c * y.c), cut) AS place
  FROM cuts JOIN f x USING (lang) JOIN f y USING (lang) WHERE x.phrase = front AND y.phrase = rest),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, array_to_string(w[1 : 2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2 : 3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE place = 1 AND NOT coalesce(100 * most >= {DROP_PERCENT} * a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
  CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
