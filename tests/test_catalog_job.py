"""The end-to-end job on CSVs written from the hand-made rows: tables, counts, quarantine and publication."""

import os

import pytest

from stocktake.plans import analytics, catalog_job
from stocktake.plans.catalog_job import run
from stocktake.session import scratch_path
from stocktake.sources import tables, versions
from tests.fixtures import ROWS
from tests.test_streaming import _csv, _local


def _listing(spark, name, rows):
    src = _local(scratch_path(spark, name))
    os.makedirs(src)
    with open(os.path.join(src, "listing.csv"), "w") as fh:
        fh.write(_csv(rows))
    return src


def _seen(spark, out, name="inventory"):
    return sorted(map(str, versions.read_published(spark, out, [name])[name].collect()))


def test_job_end_to_end(spark):
    out = scratch_path(spark, "job-out")
    written = run(spark, _listing(spark, "job-src", ROWS), out, multiline=True)
    assert len(written) == 13
    report = {r.table_name: r for r in spark.read.parquet(f"{out}/load_report.parquet").collect()}
    assert report["raw"].row_count == 7 and report["title_os"].row_count == 4
    top = spark.read.parquet(written["support_skeleton"]).collect()
    assert sorted(r.game_count for r in top) == [2, 3]
    found = versions.read_published(spark, out)
    assert set(found) == {"raw", "conversion_report", *catalog_job.Catalog.names, *(f"reports/{n}" for n in written)}
    assert found["reports/support_skeleton"].collect() == top


def test_bad_input_leaves_the_published_tables(spark):
    good, bad = _listing(spark, "job-good", ROWS), _listing(spark, "job-bad", ROWS + [dict(ROWS[0], title="same id")])
    out = scratch_path(spark, "job-kept")
    run(spark, good, out, multiline=True)
    before = _seen(spark, out)
    with pytest.raises(ValueError, match="duplicate_key_rows"):
        run(spark, bad, out, multiline=True)
    assert _seen(spark, out) == before
    assert len(os.listdir(f"{_local(out)}/_versions")) == 1
    report = {r.table_name: r for r in spark.read.parquet(f"{out}/load_report.parquet").collect()}
    assert report["raw"].duplicate_key_rows == 2


class Killed(BaseException):
    """Ends a run as a lost driver does: nothing is tidied up."""


def test_a_run_killed_midway_leaves_readers_on_the_old_set(spark, monkeypatch):
    out, src = scratch_path(spark, "job-killed"), _listing(spark, "job-second", ROWS)
    run(spark, _listing(spark, "job-first", ROWS[:4]), out, multiline=True)
    before = {n: _seen(spark, out, n) for n in catalog_job.Catalog.names}
    real = tables.write_tables

    def some(built, folder, **kw):
        real(dict(list(built.items())[:3]), folder)
        raise Killed

    def die(*a, **kw):
        raise Killed

    for module, name, instead in ((tables, "write_tables", some), (analytics, "title_groups", die), (versions, "publish", die)):
        with monkeypatch.context() as m:
            m.setattr(catalog_job, "remove_path", lambda *a: None)
            m.setattr(module, name, instead)
            with pytest.raises(Killed):
                run(spark, src, out, multiline=True)
        assert {n: _seen(spark, out, n) for n in before} == before
    assert len(os.listdir(f"{_local(out)}/_versions")) == 4  # what the killed runs left
    run(spark, src, out, multiline=True)
    assert len(_seen(spark, out)) == 7 and versions.versions(spark, out) == [1, 2]


def test_versions_stay_readable_until_they_expire(spark):
    out = scratch_path(spark, "job-versions")
    for n in (2, 3, 4):
        folder = versions.new_version(out)
        spark.range(n).write.parquet(f"{folder}/raw.parquet")
        versions.publish(spark, out, folder, {"raw": f"{folder}/raw.parquet"})
        versions.expire(spark, out, keep=2)
    assert versions.versions(spark, out) == [2, 3]
    sizes = [versions.read_published(spark, out, ["raw"], v)["raw"].count() for v in (2, 3)]
    assert sizes == [3, 4] and len(os.listdir(f"{_local(out)}/_versions")) == 2
    with pytest.raises(FileNotFoundError):
        versions.manifest(spark, out, 1)
    assert not [n for n in os.listdir(f"{_local(out)}/_manifests") if not n.endswith(".json") and not n.endswith(".crc")]


def test_two_writers_never_take_one_number(spark, monkeypatch):
    out = scratch_path(spark, "job-two")
    folder = versions.new_version(out)
    first = versions.publish(spark, out, folder, {})
    stale = iter([[], versions.versions(spark, out)])
    with monkeypatch.context() as m:  # the second writer lists the folder before the first is there
        m.setattr(versions, "versions", lambda *a: next(stale))
        second = versions.publish(spark, out, folder, {}, note="late")
    assert (first, second) == (1, 2) and versions.manifest(spark, out)["note"] == "late"


BAD = [dict(ROWS[1], id=21, agelimit="old", baseamount="free", overallavgrating="4.333333333333333"),
       dict(ROWS[2], id=22, globalreleasedate="soon", supportedoperatingsystems="['a'] b", reviewscount="1.5", amount="1e-20"),
       dict(ROWS[3], id=23, discountpercentage="much", promoid="", discountdifference="?", supportedoperatingsystems="['linux', null]"),
       dict(ROWS[4], id=24, discountpercentage="much", promoid="p", discountdifference="false", finalamount="1" * 30)]


def test_bad_values_end_the_job_or_are_listed(spark):
    src, out = _listing(spark, "job-values", ROWS + BAD), scratch_path(spark, "job-null")
    with pytest.raises(ValueError, match="6 values cannot be converted"):
        run(spark, src, out, multiline=True)
    assert versions.versions(spark, out) == []
    run(spark, src, out, multiline=True, on_error="null")
    got = versions.read_published(spark, out)
    listed = sorted((r.id, r.column_name, r.text, r.reason) for r in got["quarantine"].collect())
    assert listed == sorted([
        (21, "agelimit", "old", "not an integer"), (21, "baseamount", "free", "not a number"),
        (22, "globalreleasedate", "soon", "not an epoch in seconds"), (22, "reviewscount", "1.5", "not an integer"),
        (22, "supportedoperatingsystems", "['a'] b", "not one list"), (24, "discountpercentage", "much", "not a number")])
    counts = {r.column_name: (r.lost_digits, r.rejected, r.null_items) for r in got["conversion_report"].collect()}
    assert sum(c[1] for c in counts.values()) == len(listed)
    assert counts["supportedoperatingsystems"] == (0, 1, 1) and counts["amount"] == (1, 0, 0) and counts["finalamount"] == (1, 0, 0)
    titles = {r.title_id: r for r in got["inventory"].collect()}
    assert len(titles) == 11 and titles[21].age_limit is None and titles[22].release_date is None
    prices = {r.title_id: r for r in got["pricing"].collect()}
    assert prices[21].base_amount is None and prices[22].amount > 0 and prices[22].amount_exact == "0." + "0" * 19 + "1"
    assert prices[24].final_amount_exact == "1" * 30 and prices[1].base_amount_exact is None
    assert {r.title_id: str(r.overall_avg_rating) for r in got["rating"].collect()}[21] == "4.333333333333333000"
    assert {r.title_id: (r.discount_percentage, r.is_discounted) for r in got["discount_status"].collect()}[24] == (None, False)


def test_staging_is_read_once_for_the_counts(spark):
    """The counts are taken by the pass that stages the file."""
    from pyspark.sql import functions as F

    from stocktake.operators import quality
    from stocktake.plans.normalize import CONVERSIONS, conversion_text
    from stocktake.sources.csv_stage import read_csv
    counted = quality.ObservedConversions(CONVERSIONS, conversion_text, only=F.col("id").isNotNull())
    rows = counted.watch(read_csv(spark, _listing(spark, "job-once", ROWS + BAD), multiline=True))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    rows.write.format("noop").mode("overwrite").save()
    assert counted.total("rejected") == 6 and counted.total("null_items") == 1


def test_database_tables_are_written_once_per_version(spark):
    out = scratch_path(spark, "job-db")
    run(spark, _listing(spark, "job-db1", ROWS[:3]), out, multiline=True, database="stock_job", num_buckets=2)
    run(spark, _listing(spark, "job-db2", ROWS), out, multiline=True, database="stock_job", num_buckets=2, keep=1)
    assert spark.table("stock_job.inventory").count() == 7 == versions.read_published(spark, out, ["inventory"])["inventory"].count()
    names = [r.tableName for r in spark.sql("SHOW TABLES IN stock_job").collect()]
    assert len(names) == 2 * len(catalog_job.Catalog.names)  # the tables of one version and their views


def test_empty_listing(spark):
    out = scratch_path(spark, "job-empty")
    run(spark, _listing(spark, "job-none", []), out, multiline=True, profiled=True, on_error="null", keys="dense", key_maps=f"{out}/keys")
    got = versions.read_published(spark, out)
    assert got["inventory"].count() == got["quarantine"].count() == 0 and got["reports/support_skeleton"].count() == 2
    assert {(r.lost_digits, r.rejected, r.null_items) for r in got["conversion_report"].collect()} == {(0, 0, 0)}
