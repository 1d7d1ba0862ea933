"""Every adaptive rule rejects an outlier planted for it."""

import pytest
from pyspark.sql import functions as F

from lendscape.llm import quality_rules

COUNTS = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
SCHEMA = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
PLAIN = (100, 500, 0, 0, 0)


def dropped(spark, rows):
    judged = quality_rules.judge(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return {r.doc_id for r in judged.filter("not kept and not base_failed").collect()}


def plain(n, lang="en", source="s", first=0):
    return [(first + i, lang, source, 100, 480 + i % 40, 0, 0, 0) for i in range(n)]


@pytest.mark.parametrize(
    "counts, out",
    [
        ((100, 1500, 0, 0, 0), True),
        ((100, 500, 40, 0, 0), True),
        ((100, 500, 0, 8, 0), True),
        ((100, 500, 0, 0, 18), True),
        ((100, 500, 3, 2, 10), False),
        ((12, 60, 2, 1, 0), False),
    ],
)
def test_each_rule_rejects_its_outlier(spark, counts, out):
    assert dropped(spark, [*plain(60), (99, "en", "s", *counts)]) == ({99} if out else set())


def test_small_groups_are_judged_by_the_next_larger(spark):
    loud = (100, 500, 40, 0, 0)
    few = plain(5, "fr", "t", 100)
    # Own group too small: its language decides, and for a rare or unknown language all documents.
    language = [*plain(60, "en", "s"), *plain(3, "en", "u", 200), (99, "en", "u", *loud)]
    assert dropped(spark, [*language, *few]) == {99}
    everything = [*plain(60), *few, (98, "fr", "t", *loud), (99, None, None, *loud)]
    assert dropped(spark, everything) == {98, 99}
    # A language with enough loud documents of its own keeps them.
    at_home = [(300 + i, "xx", f"s{i % 4}", *loud) for i in range(40)]
    assert dropped(spark, [*plain(100), *at_home, (99, "yy", "s", *loud)]) == set()
    assert dropped(spark, [*plain(300), *at_home, (99, "yy", "s", *loud)]) == {99}
    # Fewer documents than a group needs in all.
    assert dropped(spark, [*plain(20), (99, "en", "s", *loud)]) == {99}
