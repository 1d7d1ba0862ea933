"""A training corpus from documents in five stages; each stage's rows are written and reread.

1. language identification: documents without a determined language go;
2. n-gram Jaccard join: of each group of near duplicates the smallest id stays;
3. secret scan: secrets are replaced by a mark, the documents stay;
4. mixing: documents are repeated or left out to meet the weights of domains, languages, sources;
5. piece encoding: the last stage returns ids and counts of the pieces of what is left.

``run`` writes every stage below the shared checkpoint folder, so a lost executor never costs
more than the stage at hand. Stages keep further columns as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscape.llm import arrow as A
from lendscape.llm import language_id, mixing, ngram_join, pieces_codec, secrets

# Under four languages chance gives a quarter; a single short word of a language gives about half.
LEAST_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is determined; learned from the labelled documents."""
    model = language_id.learn(docs)
    told = language_id.with_language(docs, model)
    return told.filter(F.col("score") >= LEAST_SCORE).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: of the rows with its smallest id the first by a hash of all
    columns. NULL ids are in no group."""
    groups = ngram_join.similar_sets(docs)
    first = groups.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(A.staged(first, "kept"), "doc_id", "left_semi").select(*docs.columns)
    order = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(order))
    chosen = kept.withColumn("_place_in_id", rank).filter("_place_in_id = 1").select(*docs.columns)
    return chosen.unionByName(docs.filter(F.col("doc_id").isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the text and count its characters anew."""

    def run(table: pa.Table) -> pa.Table:
        at, null = table.column_names.index("text"), table["text"].combine_chunks().is_null()
        masked = [
            None if gone else x
            for gone, x in zip(null.to_pylist(), secrets.redact(A.texts(table["text"])))
        ]
        return table.set_column(at, table.schema.field(at), pa.array(masked, table.schema.field(at).type))

    masked = A.map_tables(docs, run, docs.schema)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the copies that the target weights give them."""
    return mixing.resample(docs, mixing.domain_of(F.col("source")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every row, and whether they decode to its text."""
    return pieces_codec.digest(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("piece_codec", encode),
]

# SQL cannot express the first and last stages; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = A.staged(stage(spark, docs, sf_dir), name)
    return docs
