"""Invariants: results do not depend on partitioning or input order; one
staging row in gives one inventory / pricing / rating row out."""

from pyspark.sql import functions as F

from stocktake.plans import analytics
from stocktake.plans.listing import listing
from stocktake.plans.normalize import Catalog
from tests.conftest import SF_SMALL


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _snapshot(cat):
    out = {}
    for name, df in cat.items():
        out[name] = _sorted(df)
    for name, report in analytics.REPORTS.items():
        out["report:" + name] = _sorted(report(cat))
    return out


def test_same_result_for_one_and_many_partitions(spark):
    raw = listing(spark, SF_SMALL).cache()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = _snapshot(Catalog(raw.coalesce(1)))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = _snapshot(Catalog(raw.repartition(9, F.rand(5))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        raw.unpersist()
    assert one == many


def test_one_row_in_one_row_out(spark):
    raw = listing(spark, SF_SMALL)
    cat = Catalog(raw)
    n = raw.where(F.col("id").isNotNull()).count()
    assert cat["inventory"].count() == n
    assert cat["pricing"].count() == n
    assert cat["rating"].count() == n
    assert cat["inventory"].select("title_id").distinct().count() == n


def test_keys_and_references_clean_after_normalise(spark):
    from stocktake.operators import quality
    raw = listing(spark, SF_SMALL)
    cat = Catalog(raw)
    report = quality.load_report({"raw": raw, **dict(cat.items())})
    quality.assert_clean(report)
    assert report.where("row_count = 0").count() == 0
