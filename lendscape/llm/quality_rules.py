"""Quality rules: thresholds per language and source from mergeable quantile sketches.

Each text is measured once, in vectorised passes over the Arrow buffer. The measures of every
(language, source) group enter sketches of relative error ``ACCURACY``: counts of logarithmic
bins, which merge by addition, so the result does not depend on how rows are dealt out. A
document is dropped when a measure lies beyond its group's fence, the upper quartile plus ``REACH``
times the spread, or the mirrored lower one. The spread is the distance between the quartiles, but
at least a tenth of the median and at least ``LEAST_SPREAD``, which decides where most documents
have a rate of zero. Above the upper fence a document has ``SLACK`` more symbols, lines or words
free, so that a few of them in a short text are no outlier.

A group of fewer than ``MIN_GROUP`` documents is judged by the next larger one: the sketches of a
language's sources are added, then those of all languages. The sketch of all documents decides
whatever their number, so that every document is judged.

* NULL or empty text: no words, hence below the base rule, not kept.
* NULL language or source: a group of its own.
* Repeated rows and ids: each row is judged by itself.
* An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
ACCURACY = 0.01
REACH = 8.0
# Spread of a rate that counts at least, and the count in a document that decides nothing. One
# repeated passage of WINDOW words covers 2 * WINDOW words.
LEAST_SPREAD = {"symbol_rate": 0.01, "dup_line_rate": 0.001, "repeat_rate": 0.005}
SLACK = {"symbol_rate": 3, "dup_line_rate": 2, "repeat_rate": 2 * WINDOW}
# Documents a group needs before its own quartiles decide.
MIN_GROUP = 30

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"

_SYMBOL = A.byte_class(lambda b: chr(b) in SYMBOLS)
_LEADING = A.byte_class(lambda b: not 0x80 <= b <= 0xBF)
_NOT_NEWLINE = A.byte_class(lambda b: b != 0x0A)
_MULTIPLIERS = A.mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def measure(array: pa.Array) -> list[np.ndarray]:
    """The five base measures of each text, in the order of ``MEASURES``."""
    parts = [_measure(array.slice(a, b - a)) for a, b in A.slices(array)]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5


def _measure(array: pa.Array) -> list[np.ndarray]:
    data, offsets = A.buffer_of(array)
    starts, ends, first = A.spans(data, offsets, A.NOT_SPACE)
    words = np.diff(first)
    chars = A.per_text(_LEADING[data] & A.NOT_SPACE[data], offsets)
    symbols = A.per_text(_SYMBOL[data], offsets)
    return [words, chars, symbols, _dup_lines(data, offsets, starts), _repeats(data, starts, ends, first)]


def _dup_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    starts, ends, first = A.spans(data, offsets, _NOT_NEWLINE)
    full = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[full]
    earlier = _seen_before(owner, A.hash_spans(data, starts, ends)[full])
    return np.bincount(owner[earlier], minlength=len(first) - 1)


def _seen_before(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Marks entries whose (owner, key) stands earlier."""
    order = np.argsort(A.mix(keys + A.mix(owner.astype(np.uint64))), kind="stable")
    same = np.zeros(len(order), bool)
    o, k = owner[order], keys[order]
    same[1:] = (o[1:] == o[:-1]) & (k[1:] == k[:-1])
    out = np.zeros(len(order), bool)
    out[order] = same
    return out


def _repeats(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = len(starts)
    if n < WINDOW:
        return np.zeros(len(first) - 1, np.int64)
    h = A.hash_spans(data, starts, ends)
    key = sum(h[i : n - WINDOW + 1 + i] * _MULTIPLIERS[i] for i in range(WINDOW))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1 :])
    key = A.mix(key[whole] + A.mix(owner[whole].astype(np.uint64)))
    order = np.argsort(key)
    k = key[order]
    same = np.zeros(len(k), bool)
    equal = k[1:] == k[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    at = whole[order[same]]
    covered = np.zeros(n, bool)
    for i in range(WINDOW):
        covered[at + i] = True
    return A.per_text(covered, first)


def measured(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The carried columns and the base measures of each document."""

    def run(table: pa.Table) -> pa.Table:
        out = table.drop_columns(["_text"])
        for field, values in zip(MEASURES.split(", "), measure(A.texts(table["_text"]))):
            out = out.append_column(field.split()[0], pa.array(values, pa.int64()))
        return out

    needed = docs.select(*carry, F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in needed.drop("_text").schema)
    return A.map_tables(needed, run, f"{kinds}, {MEASURES}")


def default_rates() -> Mapping[str, Column]:
    """What the adaptive rules look at; each is non-negative."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "word_length": F.col("word_chars") / n,
        "symbol_rate": F.col("n_symbols") / n,
        "dup_line_rate": F.col("n_dup_lines") / n,
        "repeat_rate": F.col("n_repeat_words") / n,
    }


def sketch(stats: DataFrame, rates: Mapping[str, Column], groups: tuple[str, ...]) -> DataFrame:
    """Bin counts per group and measure. Sketches of parts of the rows merge by adding counts."""
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    value = F.col("_pair.value")
    bin_of = F.when(value <= 1e-9, F.lit(None)).otherwise(F.ceil(F.log(value) / math.log(gamma)))
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in rates.items()])
    return (
        stats.select(*groups, F.explode(pairs).alias("_pair"))
        .groupBy(*groups, F.col("_pair.name").alias("measure"), bin_of.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(bins: DataFrame, at: Mapping[str, float], groups: tuple[str, ...]) -> DataFrame:
    """Quantiles of each group and measure. A group has a few thousand bins at most."""
    gamma = (1 + ACCURACY) / (1 - ACCURACY)
    keys = [*groups, "measure"]
    upto = Window.partitionBy(*keys).orderBy(F.col("bin").asc_nulls_first())
    middle = F.coalesce(2 * F.pow(F.lit(gamma), F.col("bin")) / (gamma + 1), F.lit(0.0))
    ranked = bins.withColumns(
        {"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(Window.partitionBy(*keys)), "_value": middle}
    )
    return ranked.groupBy(*keys).agg(
        F.max("_all").alias("n_docs"),
        *[F.min(F.when(F.col("_upto") >= q * F.col("_all"), F.col("_value"))).alias(k) for k, q in at.items()],
    )


def fences(bins: DataFrame, groups: tuple[str, ...], level: int | None = None) -> DataFrame:
    """One row per group: documents, lowest and highest accepted value of every measure.

    With a level, the sketches are added up over all but the first ``level`` columns of the group.
    """
    if level is not None and level < len(groups):
        groups = groups[:level]
        bins = bins.groupBy(*groups, "measure", "bin").agg(F.sum("n").alias("n"))
    q = quantiles(bins, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, groups)
    least = F.lit(0.0)
    for name, value in LEAST_SPREAD.items():
        least = F.when(F.col("measure") == name, value).otherwise(least)
    spread = F.greatest(F.col("q3") - F.col("q1"), 0.1 * F.col("q2"), least)
    q = q.select(
        *groups,
        "measure",
        "n_docs",
        (F.col("q1") - REACH * spread).alias("lo"),
        (F.col("q3") + REACH * spread).alias("hi"),
    )
    return q.groupBy(*groups).agg(
        F.max("n_docs").alias("_n_docs"),
        F.map_from_entries(F.collect_list(F.struct("measure", F.struct("lo", "hi")))).alias("_fences"),
    )


def nearest_fences(bins: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """One row per group: fences of the smallest level that has ``MIN_GROUP`` documents."""
    out = fences(bins, groups)
    chosen = F.when(F.col("_n_docs") >= MIN_GROUP, F.col("_fences"))
    for level in range(len(groups) - 1, -1, -1):
        wider = fences(bins, groups, level).select(
            *[F.col(g).alias(f"_w_{g}") for g in groups[:level]],
            F.col("_n_docs").alias(f"_n_{level}"),
            F.col("_fences").alias(f"_fences_{level}"),
        )
        same = [F.col(g).eqNullSafe(F.col(f"_w_{g}")) for g in groups[:level]]
        out = out.join(wider, same, "left") if same else out.crossJoin(wider)
        usable = F.lit(True) if level == 0 else F.col(f"_n_{level}") >= MIN_GROUP
        chosen = F.coalesce(chosen, F.when(usable, F.col(f"_fences_{level}")))
    return out.select(*groups, chosen.alias("_fences"))


def judge(
    stats: DataFrame,
    groups: tuple[str, ...] = ("lang", "source"),
    rates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Base rule and adaptive verdict for measured documents: adds ``base_failed``, ``kept``.

    The fences have one row per group; they are joined NULL-safely on the group, a join whose
    larger side adaptive execution can split.
    """
    rates = rates or default_rates()
    limits = nearest_fences(A.staged(sketch(stats, rates, groups), "bins"), groups)
    marked = limits.select(*[F.col(g).alias(f"_g_{g}") for g in groups], "_fences")
    same = [F.coalesce(F.col(g), F.lit("")) == F.coalesce(F.col(f"_g_{g}"), F.lit("")) for g in groups]
    same += [F.col(g).isNull() == F.col(f"_g_{g}").isNull() for g in groups]
    joined = stats.join(marked, same, "left")
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    outlier = F.lit(False)
    for name, value in rates.items():
        lo, hi = F.col("_fences")[name]["lo"], F.col("_fences")[name]["hi"]
        free = SLACK.get(name, 0) / F.greatest(F.col("n_words"), F.lit(1))
        outlier = outlier | F.coalesce((value < lo) | (value > hi + free), F.lit(False))
    return joined.withColumns({"base_failed": base, "kept": ~base & ~outlier}).select(
        *stats.columns, "base_failed", "kept"
    )


def filter_quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every document; the text is read once."""
    return judge(A.staged(measured(docs), "measures"))
