"""Equal-sized brackets over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscape.sources.store import settle


def ntile(df: DataFrame, tiles: int, value: str, tiebreak: str, alias: str = "tile") -> DataFrame:
    """Adds the row's bracket 1..tiles, as SQL ``ntile`` over (value, tiebreak) does.

    ``value`` and ``tiebreak`` together should be unique, else rows that tie may lie on either
    side of a border. Rows without a value get none.

    No task sorts all rows: they are dealt out by ranges of (value, tiebreak), so that a value
    held by very many rows is spread as well, and stored; rows are numbered within their range,
    and one row per range carries the count of those before it.
    """
    placed = (
        df.filter(F.col(value).isNotNull())
        .repartitionByRange(F.col(value), F.col(tiebreak))
        .withColumn("_range", F.spark_partition_id())
    )
    placed = settle(placed)
    # One row per range: the shuffle's partitions, not the data, bound it.
    every = Window.partitionBy(F.lit(0))
    sizes = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_range",
            (F.sum("_n").over(every.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
            F.sum("_n").over(every).alias("_total"),
        )
    )
    inner = F.row_number().over(Window.partitionBy("_range").orderBy(value, tiebreak)) - 1
    ranked = placed.withColumn("_inner", inner).join(F.broadcast(sizes), "_range")
    tiled = ranked.withColumn(alias, tile_of(F.col("_before") + F.col("_inner"), F.col("_total"), tiles))
    without = df.filter(F.col(value).isNull()).withColumn(alias, F.lit(None).cast("long"))
    return tiled.select(*df.columns, alias).unionByName(without)


def tile_of(rank: Column, total: Column, tiles: int) -> Column:
    """Bracket of a rank from 0: the first ``total % tiles`` brackets hold one row more."""
    n = F.lit(tiles).cast("long")
    div = lambda a, b: F.call_function("div", a, b)
    size, larger = div(total, n), total % n
    in_larger = rank < larger * (size + 1)
    return (
        F.when(in_larger, div(rank, size + 1))
        .otherwise(larger + div(rank - larger * (size + 1), F.nullif(size, F.lit(0).cast("long"))))
        .cast("long")
        + 1
    )
