"""Hot keys: one publisher, genre and promotion each hold a third of all
titles. Results must not change when the dimension joins are forced to
sort-merge, and AQE must split the skewed join partition."""

import re

import pytest
from pyspark.sql import functions as F

from stocktake.operators import joins

from stocktake.plans import analytics
from stocktake.plans.listing import listing
from stocktake.plans.normalize import Catalog
from stocktake.session import scratch_path
from tests.conftest import SF_CHECK

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed(spark):
    raw = listing(spark, SF_CHECK)
    hot = F.col("id") % 3 == 0
    return (raw.withColumn("publisher", F.when(hot, F.lit("Hot Publisher"))
                           .otherwise(F.col("publisher")))
               .withColumn("genres", F.when(hot, F.lit("['hot', 'other']"))
                           .otherwise(F.col("genres")))
               .withColumn("promoid", F.when(hot, F.lit("HOTPROMO")).otherwise(F.col("promoid"))))


def _snapshot(cat):
    return {name: sorted((tuple(r) for r in report(cat).collect()), key=repr)
            for name, report in analytics.REPORTS.items()}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    yield SKEW_CONF
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture
def no_skew_split(spark, skew_conf):
    """Sort-merge joins only, and nothing at run time that would mend a skewed one."""
    for k, v in {**skew_conf, "spark.sql.adaptive.skewJoin.enabled": "false"}.items():
        spark.conf.set(k, v)


def test_hot_and_missing_names_same_results_with_sort_merge(spark, no_skew_split, monkeypatch):
    raw = _skewed(spark).repartition(8, "id").cache()
    expected = _snapshot(Catalog(raw))
    monkeypatch.setattr(joins, "SMALL_DIMENSION", 0)
    cat = Catalog(raw)
    assert _snapshot(cat) == expected
    raw.unpersist()


def _named(spark, n=24_000):
    """A third of the rows share a name, a third have none."""
    path = scratch_path(spark, "named")
    spark.range(0, n, numPartitions=6).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('n', id % 700) END AS name",
        "CASE WHEN id % 4 = 0 THEN 'orphan' ELSE 'n7' END AS other").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_and_missing_names_are_not_shuffled(spark, no_skew_split, monkeypatch, how):
    monkeypatch.setattr(joins, "SMALL_DIMENSION", 10)
    dim = spark.range(0, 700).selectExpr("concat('n', id) AS label", "id AS key").unionByName(
        spark.sql("SELECT 'hot' AS label, 7000L AS key"))
    rows = _named(spark)
    out = joins.spread_lookup(rows, dim, "name", "label", "key", "found", how)
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffled = re.search(r"Exchange hashpartitioning\(name#.*\n(?:.*Project.*\n)?.*Filter (.*)", plan)
    assert shuffled and "hot" in shuffled[1] and "isnotnull" in shuffled[1], plan
    got = out.collect()
    want = {"left": 24_000, "inner": 16_000}[how]
    assert len(got) == want and all(
        r.found == (None if r.name is None else 7000 if r.name == "hot" else int(r.name[1:])) for r in got)
    most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 6000  # in one task there would be 8,000 at least
    # A frequent name that the dimension lacks.
    lost = joins.spread_lookup(rows, dim, "other", "label", "key", "found", how)
    assert lost.where("other = 'orphan'").count() == (6000 if how == "left" else 0) and lost.where("found = 7").count() == 18_000


def test_small_dimension_is_joined_in_place(spark, no_skew_split):
    dim = spark.range(0, 700).selectExpr("concat('n', id) AS label", "id AS key")
    out = joins.spread_lookup(_named(spark), dim, "name", "label", "key", "found")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_frequent_values(spark):
    df = spark.range(0, 60_000, numPartitions=7).selectExpr(
        "CASE WHEN id % 10 < 3 THEN NULL WHEN id % 10 < 5 THEN 'a' WHEN id % 100 = 77 THEN 'b' ELSE concat('x', id) END AS v")
    assert sorted(joins.frequent_values(df, "v")) == ["a", "b"]
    assert joins.frequent_values(df.limit(0), "v") == [] and joins.frequent_values(df.where("v IS NULL"), "v") == []


def test_hot_keys_same_results_with_sort_merge_and_skew_split(spark, skew_conf):
    # Several map tasks: AQE splits a skewed reducer by ranges of map outputs.
    raw = _skewed(spark).repartition(8, "id").cache()
    expected = _snapshot(Catalog(raw))
    for k, v in skew_conf.items():
        spark.conf.set(k, v)
    assert _snapshot(Catalog(raw)) == expected
    # A plain lookup relies on the split of skewed partitions.
    inv = joins.lookup_key(raw.select("id", "publisher"), Catalog(raw)["party"], "publisher", "name", "party_id", "publisher_id")
    inv.collect()
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    raw.unpersist()
