from lendscape.sources import store
from lendscape.streaming.upserts import batch_label, upsert_files

SCHEMA = "k long, at long, v string"


def test_batches_are_merged_once(spark, tmp_path):
    folder, root, checkpoint = (str(tmp_path / x) for x in ("in", "t", "c"))

    def arrive(*rows):
        df = spark.createDataFrame(list(rows), SCHEMA)
        df.coalesce(1).write.mode("append").parquet(folder)
        upsert_files(spark, folder, df.schema, root, ["k"], "at", checkpoint)
        return sorted(map(tuple, store.read_keyed(spark, root, ["k"]).collect()))

    assert arrive((1, 1, "a"), (1, 2, "b"), (2, 1, "a")) == [(1, 2, "b"), (2, 1, "a")]
    assert arrive((2, 5, "c"), (3, 5, "c")) == [(1, 2, "b"), (2, 5, "c"), (3, 5, "c")]
    # A call without new files changes nothing; a batch repeated after a failure replaces itself.
    upsert_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, root, ["k"], "at", checkpoint)
    again = spark.createDataFrame([(2, 5, "c"), (3, 5, "c")], SCHEMA)
    store.publish_upsert(spark, root, again, ["k"], batch_label(1))
    assert sorted(map(tuple, store.read_keyed(spark, root, ["k"]).collect())) == [(1, 2, "b"), (2, 5, "c"), (3, 5, "c")]
