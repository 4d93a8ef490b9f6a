"""Table sets that are published as a whole.

A set is written once, into a folder of its own under ``<out>/_versions``, and
becomes visible by one manifest, ``<out>/_manifests/<number>.json``, which is
written aside and renamed into place. A rename either happens or not, and never
replaces a file, so readers see one whole set or another, whatever happens to a
writer between two tables, and of two writers with one number the second takes the
next. The manifest of the largest number is the current one; earlier ones stay
readable until :func:`expire` removes them with their tables.

A table is a Parquet folder, given relative to ``<out>``, or a table of the session
catalog.
"""

from __future__ import annotations

import json
import os
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..session import hadoop_path, remove_path

_MANIFEST = re.compile(r"(\d{12})\.json")


def new_version(out_dir: str) -> str:
    """A folder for a set that nobody sees yet."""
    return f"{out_dir.rstrip('/')}/_versions/{os.urandom(8).hex()}"


def versions(spark: SparkSession, out_dir: str) -> list[int]:
    """Published versions, ascending."""
    files, at = hadoop_path(spark, f"{out_dir.rstrip('/')}/_manifests")
    if not files.exists(at):
        return []
    found = (_MANIFEST.fullmatch(f.getPath().getName()) for f in files.listStatus(at))
    return sorted(int(m[1]) for m in found if m)


def _manifest_path(out_dir: str, version: int) -> str:
    return f"{out_dir.rstrip('/')}/_manifests/{version:012d}.json"


def manifest(spark: SparkSession, out_dir: str, version: int | None = None) -> dict:
    """The manifest of a version, by default of the current one."""
    known = versions(spark, out_dir)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{out_dir} has no published version{'' if version is None else f' {version}'}")
    version = known[-1] if version is None else version
    text = spark.read.text(_manifest_path(out_dir, version), wholetext=True).first()[0]  # one small file
    return {"version": version, **json.loads(text)}


def publish(spark: SparkSession, out_dir: str, folder: str, tables: dict[str, str], saved: dict[str, str] | None = None,
            **more) -> int:
    """Make a written set the current one; returns its number.

    ``tables`` gives Parquet paths by name, below ``out_dir``, ``saved`` tables of the
    catalog; ``folder`` is the set's own folder, and ``more`` is kept with it.
    """
    base = out_dir.rstrip("/")
    inside = {name: os.path.relpath(path, base) for name, path in tables.items()}
    body = json.dumps({"folder": os.path.relpath(folder, base), "tables": inside, "saved": saved or {}, **more}, indent=1)
    jvm = spark._jvm
    aside = f"{base}/_manifests/.{os.urandom(8).hex()}"
    files, at = hadoop_path(spark, aside)
    out = files.create(at, False)
    out.write(bytearray(body.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(at).toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        while True:
            version = max(versions(spark, out_dir), default=0) + 1
            try:
                context.rename(files.makeQualified(at), files.makeQualified(hadoop_path(spark, _manifest_path(base, version))[1]), how)
                return version
            except Py4JJavaError as failed:
                if "FileAlreadyExistsException" not in str(failed.java_exception):
                    raise
    finally:
        files.delete(at, False)


def read_published(spark: SparkSession, out_dir: str, names=None, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of one version: all of them stem from one run, whatever is published meanwhile."""
    found = manifest(spark, out_dir, version)
    base = out_dir.rstrip("/")
    read = {n: lambda p=p: spark.read.parquet(f"{base}/{p}") for n, p in found["tables"].items()}
    read |= {n: lambda t=t: spark.table(t) for n, t in found["saved"].items()}
    return {n: read[n]() for n in (names or read)}


def expire(spark: SparkSession, out_dir: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions, manifests first; a reader of those kept is not disturbed."""
    if keep < 1:
        raise ValueError("the current version is always kept")
    known = versions(spark, out_dir)
    kept = {manifest(spark, out_dir, v)["folder"] for v in known[-keep:]}
    gone = known[:-keep]
    for version in gone:
        old = manifest(spark, out_dir, version)
        remove_path(spark, _manifest_path(out_dir, version))
        for name in old["saved"].values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if old["folder"] not in kept:
            remove_path(spark, f"{out_dir.rstrip('/')}/{old['folder']}")
    return gone
