"""The registered queries of the text operators, on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscape.llm import (
    block_naming,
    collocations,
    graph_index,
    language_id,
    licenses,
    mixing,
    ngram_join,
    pieces_codec,
    quality_rules,
    secrets,
    token_counts,
    token_files,
    whitening,
)
from lendscape.sources.store import scratch


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return language_id.identify(docs, language_id.learn(docs))


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf), mixing.domain_of(F.col("source")))


def op3_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similar_sets(documents(spark, sf))


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf))


def op5_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf), f"{scratch(spark)}/token_files")


def op6_graph_index(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return graph_index.nearest(vectors, F.col("vec_id") % 20 == 0)


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf))


def op8_piece_codec(spark: SparkSession, sf: str) -> DataFrame:
    return pieces_codec.digest(documents(spark, sf))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.filter_quality(documents(spark, sf)).drop("lang", "source")


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf))


def op11_block_naming(spark: SparkSession, sf: str) -> DataFrame:
    return block_naming.same_texts(documents(spark, sf))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_mixing,
        op3_ngram_join,
        op4_license_scan,
        op5_token_files,
        op6_graph_index,
        op7_secret_scan,
        op8_piece_codec,
        op9_quality_rules,
        op10_token_counts,
        op11_block_naming,
        op12_whitening,
        op13_collocations,
    )
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.oracle_sql(),
    "op11_block_naming": block_naming.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
