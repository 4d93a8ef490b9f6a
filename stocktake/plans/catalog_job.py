"""End-to-end batch job: stage the listing CSV, normalise, check, report, publish.

    spark-submit --py-files stocktake.zip submit_catalog_job.py --csv s3://.../listing/ --out s3://.../catalog

Steps (nothing is visible before it is checked, and no table is written twice):

1. the CSV folder is staged under the 51-column schema in a folder of this run,
   ``<out>/_versions/<token>``; the same pass counts amounts whose digits exceed
   the decimal, rejected text and dropped NULL items (``conversion_report``);
2. with ``--on-error null``, text that no conversion takes makes its value NULL, and is
   listed in ``quarantine`` with its row's id, column and reason; the counts say beforehand
   whether there is any. By default such text ends the job;
3. the eleven normalised tables are written beside (or as catalog tables, bucketed
   on ``title_id``, with ``--database``), and checked by the load report. With any
   key, NULL or reference violation the job ends here (``--no-strict`` goes on);
4. the thirteen reports are written from the checked tables;
5. one manifest publishes all of it (:mod:`stocktake.sources.versions`). A run that
   ends before leaves readers on the last published set. The views of a
   ``--database`` follow one by one, so a reader that needs one set takes the manifest.

``<out>/load_report.parquet`` is the report of the last run, published or not.
"""

from __future__ import annotations

import argparse
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession, functions as F

from ..operators import profile, quality
from ..session import build_session, remove_path
from ..sources import csv_stage, tables, versions
from . import analytics
from .normalize import CONVERSIONS, Catalog, conversion_text, normalize, rejected_values


def run(spark: SparkSession, csv_path: str, out_dir: str, strict: bool = True,
        database: str | None = None, num_buckets: int = 0, *, multiline: bool,
        keys: str = "hash", on_error: str = "fail", keep: int = 2, profiled: bool = False,
        key_maps: str | None = None, parallelism: int = 4) -> dict:
    """Returns the paths of the reports by name."""
    out_dir = out_dir.rstrip("/")
    folder = versions.new_version(out_dir)
    at = lambda name: tables.table_path(folder, name)
    suffix, saved, published = f"__{os.path.basename(folder)}", {}, False
    try:
        counted = quality.ObservedConversions(CONVERSIONS, conversion_text, only=F.col("id").isNotNull())
        raw = csv_stage.stage_to_parquet(spark, csv_path, at("raw"), multiline=multiline, watch=counted.watch)
        counted.report(spark).coalesce(1).write.parquet(at("conversion_report"))
        if profiled:
            profile.column_profile(raw).coalesce(1).write.parquet(at("load_profile"))
        refused = rejected_values(raw) if counted.total("rejected") else rejected_values(raw.limit(0))
        if on_error == "null":
            refused.write.parquet(at("quarantine"))
        elif counted.total("rejected"):
            raise ValueError(f"{counted.total('rejected')} values cannot be converted, as {refused.first()}; "
                             "on_error='null' lists them and goes on")
        repeated = not quality.duplicate_keys(raw, ["id"]).isEmpty()
        built = normalize(raw, ids_unique=not repeated, keys=keys, on_error=on_error, key_maps=key_maps)
        if database:
            saved = {n: f"{database}.{n}{suffix}" for n in Catalog.names}
            tables.save_tables(built, database, num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), suffix=suffix)
            stored = tables.load_saved_tables(spark, database, Catalog.names, suffix)
        else:
            tables.write_tables(built, folder)
            stored = tables.read_tables(spark, folder, Catalog.names)
        report = f"{out_dir}/load_report.parquet"
        quality.load_report({"raw": raw, **stored}).write.mode("overwrite").parquet(report)
        if strict:
            quality.assert_clean(spark.read.parquet(report))
        written = {name: f"{folder}/reports/{name}.parquet" for name in analytics.REPORTS}
        write_reports(stored, written, strict, parallelism)
        paths = {n: at(n) for n in ("raw", "conversion_report", *(["quarantine"] if on_error == "null" else []),
                                    *(["load_profile"] if profiled else []),
                                    *([] if database else Catalog.names))}
        versions.publish(spark, out_dir, folder, {**paths, **{f"reports/{n}": p for n, p in written.items()}}, saved)
        published = True
    finally:
        if not published:
            for name in saved.values():
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(spark, folder)
    for name, table in saved.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {table}")
    versions.expire(spark, out_dir, keep)
    return written


def write_reports(stored: dict, paths: dict[str, str], checked: bool, parallelism: int = 4) -> None:
    """Write all reports, several at once. Of ``checked`` tables, whose titles are unique,
    seven come from one pass over the titles."""
    builders = {name: lambda report=report: report(stored) for name, report in analytics.REPORTS.items()}

    def write(names):
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(lambda name: builders[name]().write.parquet(paths[name]), names))

    if not checked:
        write(paths)
        return
    spark = stored["inventory"].sparkSession
    kept = f"{os.path.dirname(paths['era_quality'])}/title_groups.parquet"
    builders["title_groups"], paths = lambda: analytics.title_groups(stored), {**paths, "title_groups": kept}
    write(["title_groups", *[n for n in builders if n not in analytics.BY_TITLE and n != "title_groups"]])
    shared = analytics.reports_by_title(spark.read.parquet(kept))
    builders |= {name: lambda report=report: report.coalesce(1) for name, report in shared.items()}
    write(analytics.BY_TITLE)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--csv", required=True, help="CSV file or folder of listing files")
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--database", help="save tables to this catalog database, bucketed")
    ap.add_argument("--buckets", type=int, default=0, help="bucket count for title tables")
    ap.add_argument("--no-strict", action="store_true", help="report violations, do not fail")
    ap.add_argument("--keys", choices=["dense", "hash"], default="hash",
                    help="hash keys (no dimension joins; collisions fail the report) or dense surrogate keys")
    ap.add_argument("--on-error", choices=["fail", "null"], default="fail",
                    help="text that cannot be converted ends the job, or becomes NULL and is listed in quarantine")
    ap.add_argument("--key-maps", help="folder that keeps dense keys from run to run")
    ap.add_argument("--profile", action="store_true", help="publish a profile of the staged columns too")
    ap.add_argument("--keep", type=int, default=2, help="published versions that stay readable")
    ap.add_argument("--single-line", action="store_true",
                    help="no field holds a newline: files are split across tasks")
    args = ap.parse_args(argv)
    spark = build_session()
    run(spark, args.csv, args.out, strict=not args.no_strict, database=args.database,
        num_buckets=args.buckets, multiline=not args.single_line, keys=args.keys, on_error=args.on_error, keep=args.keep, profiled=args.profile, key_maps=args.key_maps)


if __name__ == "__main__":
    main()
