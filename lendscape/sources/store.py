"""Layer storage as plain parquet in dated partitions.

A run is one partition, ``<root>/<column>=<label>``, written by Spark's dynamic partition
overwrite: a repeated run replaces its own partition when its job commits, a failed one leaves
everything as it was, other partitions are not touched. Any parquet reader sees the same rows.

Keyed tables are merged on read. A day is stored as a delta partition, and the state is the
latest row per key over the deltas, so back-dated and repeated days need no replay. ``fold``
stores the state as of a day; reads then take that base, but for the keys of later deltas.
``merge_buckets`` keeps the state alone, in partitions by key hash, and rewrites those a day falls into.

A history is a log of versions: a run stores the versions it opened and those it closed.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscape.operators.history import VALID_FROM, VALID_TO, open_versions, scd2_step
from lendscape.operators.latest import latest_per_key
from lendscape.operators.upsert import any_null, upsert

LABEL = "label"
RUN = "run"
DELTA, BASE = "delta", "base"
BUCKET = "bucket_of_"
# Deltas beyond the newest base after which a day's merge stores a new one.
FOLD_AFTER = 7


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system its scheme names."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _folder(root: str, column: str, label: str) -> str:
    """Folder of a partition, its label escaped as Spark does."""
    safe = re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", label)
    return f"{root}/{column}={safe}"


def run_labels(spark: SparkSession, root: str, column: str) -> list[str]:
    """Labels of stored runs, ascending. Lists names only."""
    literal = re.sub(r"([{}\[\]*?\\])", r"\\\1", root)
    fs, target = _file_system(spark, f"{literal}/{column}=*")
    names = [status.getPath().getName() for status in fs.globStatus(target) or []]
    return sorted(unquote(name.split("=", 1)[1]) for name in names)


def latest_run(
    spark: SparkSession, root: str, column: str, before: str | None = None
) -> str | None:
    """Greatest label, optionally below another one."""
    labels = [x for x in run_labels(spark, root, column) if before is None or x < before]
    return labels[-1] if labels else None


def has_run(spark: SparkSession, root: str, column: str, label: str) -> bool:
    return exists(spark, _folder(root, column, label))


def write_run(
    df: DataFrame, root: str, column: str, label: str, split: tuple[str, Sequence[str]] | None = None
) -> dict[str | None, int]:
    """Write a run, replacing an earlier one of the label, and return its row count.

    ``split`` names a further partition column and the values it takes; counts are then per
    value. Dynamic overwrite leaves a partition alone that gets no row, so such a one is
    overwritten with no rows: a repeated run that has become empty leaves nothing behind.
    """
    name, values = split or (None, (None,))
    seen = Observation(f"write_{uuid.uuid4().hex}")
    counted = [
        (F.count(F.lit(1)) if name is None else F.count_if(F.col(name) == v)).alias(f"n{i}")
        for i, v in enumerate(values)
    ]
    (
        df.observe(seen, *counted)
        .withColumn(column, F.lit(label))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column, *([name] if name else []))
        .parquet(root)
    )
    counts = {v: seen.get[f"n{i}"] or 0 for i, v in enumerate(values)}
    folder = _folder(root, column, label)
    for value, n in counts.items():
        place = folder if value is None else _folder(folder, name, value)
        if n == 0 and (value is None or exists(df.sparkSession, place)):
            none = df.sparkSession.createDataFrame([], df.drop(name).schema if name else df.schema)
            none.write.mode("overwrite").parquet(place)
    return counts


def read_run(
    spark: SparkSession, root: str, column: str, label: str, schema: T.StructType | None = None
) -> DataFrame:
    """One run's rows, without the run column."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_folder(root, column, label))


def read_runs(
    spark: SparkSession,
    root: str,
    column: str,
    labels: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Several runs' rows with the run column; other runs' files are not even listed."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", root).parquet(*[_folder(root, column, x) for x in labels])


def _rows(spark: SparkSession, root: str, column: str, labels: Sequence[str]) -> DataFrame:
    """Rows of runs with the label as text, in the columns of the last of them."""
    schema = read_run(spark, root, column, labels[-1]).schema
    return read_runs(spark, root, column, labels, schema.add(column, T.StringType()))


def publish_upsert(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    keys: Sequence[str],
    label: str,
    fold_after: int = FOLD_AFTER,
) -> None:
    """Store a day's rows as the delta of its label; a key it repeats fails the job.

    Only the day's rows are read and written. Bases holding the label's day or a later one are
    dropped beforehand, since they were made without these rows. After ``fold_after`` deltas a
    new base is stored.
    """
    for base in run_labels(spark, f"{root}/{BASE}", LABEL):
        if base >= label:
            fs, target = _file_system(spark, _folder(f"{root}/{BASE}", LABEL, base))
            fs.delete(target, True)
    write_run(upsert(None, source, keys), f"{root}/{DELTA}", LABEL, label)
    base, deltas = _layers(spark, root)
    if len(deltas) >= fold_after:
        fold(spark, root, keys, deltas[-1])


def _layers(spark: SparkSession, root: str, as_of: str | None = None) -> tuple[str | None, list[str]]:
    """Newest base and the deltas after it, as of a label."""
    seen = lambda kind: [x for x in run_labels(spark, f"{root}/{kind}", LABEL) if as_of is None or x <= as_of]
    base = max(seen(BASE), default=None)
    return base, [x for x in seen(DELTA) if base is None or x > base]


def read_keyed(
    spark: SparkSession, root: str, keys: Sequence[str], as_of: str | None = None
) -> DataFrame | None:
    """State of a keyed table, by default the newest; ``None`` when there is none.

    The latest row per key over the deltas, and rows of the base whose key is in none of them:
    the base is not shuffled where the deltas' keys are few enough to be broadcast. Rows with
    NULL keys match nothing and are all part of the state.
    """
    base, deltas = _layers(spark, root, as_of)
    if base is None and not deltas:
        return None
    held = None if base is None else read_run(spark, f"{root}/{BASE}", LABEL, base)
    if not deltas:
        return held
    rows = _rows(spark, f"{root}/{DELTA}", LABEL, deltas)
    unkeyed = any_null(keys)
    fresh = rows.drop(LABEL) if len(deltas) == 1 else (
        latest_per_key(rows.filter(~unkeyed), keys, LABEL, []).unionByName(rows.filter(unkeyed)).drop(LABEL)
    )
    if held is None:
        return fresh
    changed = rows.filter(~unkeyed).select(*keys).distinct()
    kept = held.join(changed, list(keys), "left_anti").select(*held.columns)
    return kept.unionByName(fresh, allowMissingColumns=True).select(*fresh.columns)


def fold(spark: SparkSession, root: str, keys: Sequence[str], upto: str) -> None:
    """Store the state as of a label as the base of later reads. Deltas stay."""
    state = read_keyed(spark, root, keys, upto)
    if state is not None:
        write_run(state, f"{root}/{BASE}", LABEL, upto)


def merge_buckets(
    spark: SparkSession, root: str, source: DataFrame, keys: Sequence[str], buckets: int
) -> None:
    """Merge rows into a keyed table partitioned by key hash; a key they repeat fails the job.

    Only buckets that the rows fall into are read, and replaced by dynamic partition overwrite
    when the job commits; other buckets keep their files. A bucket is one task and one file, so
    choose their number by the table's size; a table keeps the number it was first written with.
    NULL keys match nothing: their rows are spread by all columns, and a repeated merge adds them again.
    A commit puts buckets in place one by one, and nothing else holds their rows: where a driver may
    be lost in the middle of it, use ``publish_upsert``, which keeps the deltas.
    """
    column = f"{BUCKET}{buckets}"
    if run_labels(spark, root, f"{BUCKET}*") and not run_labels(spark, root, column):
        raise ValueError(f"{root} is not kept in {buckets} buckets")
    place = F.when(any_null(keys), F.xxhash64(*source.columns)).otherwise(F.xxhash64(*keys))
    rows = settle(source.withColumn(column, F.pmod(place, F.lit(buckets)).cast("int")))
    touched = {str(b) for (b,) in rows.select(column).distinct().collect()}
    held = [x for x in run_labels(spark, root, column) if x in touched]
    target = read_runs(spark, root, column, held) if held else None
    (
        upsert(target, rows, keys, [column], buckets)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(root)
    )


def read_buckets(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """State of a table that ``merge_buckets`` keeps, in the columns of a schema."""
    return spark.read.schema(schema).parquet(root).select(*schema.names)


def run_label(run_ts: datetime) -> str:
    """Sortable label that partition discovery keeps as a string."""
    return run_ts.strftime("r%Y%m%dT%H%M%S%f")


def publish_history(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
    close_deleted: bool = False,
) -> None:
    """Fold one snapshot into the stored history.

    A run stores the versions it opens, and those it closes with their end: bytes follow the
    changes, not the table. Versions open before it are derived from the log.
    """
    label = run_label(run_ts)
    labels = run_labels(spark, root, RUN)
    if labels and labels[-1] > label:
        raise ValueError(f"history already holds a later run ({labels[-1]}) than {label}")
    earlier = [x for x in labels if x < label]
    if earlier:
        current = _open(_rows(spark, root, RUN, earlier), key).drop(RUN)
        versions = scd2_step(current, source, key, check_cols, run_ts, close_deleted)
        opened = F.col(VALID_FROM) == F.lit(run_ts).cast(current.schema[VALID_FROM].dataType)
        rows = versions.filter(F.col(VALID_TO).isNotNull() | opened)
    else:
        rows = open_versions(source, run_ts, key)
    write_run(rows, root, RUN, label)


def _open(log: DataFrame, key: str) -> DataFrame:
    """Versions opened and not closed by any run of the log."""
    closed = log.filter(F.col(VALID_TO).isNotNull()).select(key, VALID_FROM)
    return log.filter(F.col(VALID_TO).isNull()).join(closed, [key, VALID_FROM], "left_anti").select(*log.columns)


def read_history(
    spark: SparkSession, root: str, key: str, as_of: datetime | None = None
) -> DataFrame | None:
    """All versions as of a run (default: the latest); partitions not needed are not listed."""
    labels = [
        x for x in run_labels(spark, root, RUN) if as_of is None or x <= run_label(as_of)
    ]
    if not labels:
        return None
    log = _rows(spark, root, RUN, labels)
    return log.filter(F.col(VALID_TO).isNotNull()).unionByName(_open(log, key)).drop(RUN)


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's checkpoint folder, which is on shared storage.

    Only a local session, as in tests, may do without one.
    """
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared}/scratch-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder on shared storage")
    return tempfile.mkdtemp(prefix="scratch-")


def settle(df: DataFrame) -> DataFrame:
    """Store a frame with several consumers once, as parquet below the scratch folder.

    That folder is on shared storage, so the rows outlive any executor; consumers read only the
    columns they need.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(
    df: DataFrame,
    name: str,
    kind: str = "view",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> DataFrame:
    """Expose a frame as a temporary view (staging) or a stored catalog table (marts).

    A table bucketed by its key joins on that key later without being shuffled.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return spark.table(name)


__all__ = [
    "VALID_FROM",
    "VALID_TO",
    "exists",
    "fold",
    "has_run",
    "latest_run",
    "materialise",
    "merge_buckets",
    "publish_history",
    "publish_upsert",
    "read_buckets",
    "read_history",
    "read_keyed",
    "read_run",
    "read_runs",
    "run_label",
    "run_labels",
    "scratch",
    "settle",
    "write_run",
]
