"""CSV staging: quoting, NULL vs empty, padding, embedded newlines, positional schema."""

import os

import pytest
from pyspark.sql import types as T

from stocktake.session import scratch_path
from stocktake.sources import csv_stage

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()),
                       T.StructField("a", T.StringType()),
                       T.StructField("b", T.StringType()),
                       T.StructField("type", T.IntegerType())])


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write(text)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_read_edge_cases(spark):
    path = scratch_path(spark, "csv-edge")
    _write(_local(path), 'x,y,z,w\n1,,"",3\n2,"a ""b"" c"," pad ",\n3,"line1\nline2",plain,7\n')
    rows = {r.id: r for r in csv_stage.read_csv(spark, path, SCHEMA, multiline=True).collect()}
    assert (rows[1].a, rows[1].b, rows[1].type) == (None, "", 3)
    assert (rows[2].a, rows[2].b, rows[2].type) == ('a "b" c', " pad ", None)
    assert rows[3].a == "line1\nline2"


def test_short_row_fails(spark):
    path = scratch_path(spark, "csv-short")
    _write(_local(path), "x,y,z,w\n1,a\n")
    with pytest.raises(Exception):
        csv_stage.read_csv(spark, path, SCHEMA, multiline=True).collect()


def test_round_trip_keeps_null_vs_empty(spark):
    df = spark.createDataFrame([(1, "", None, 2), (2, 'q "x"', " p ", None),
                                (3, "n\nl", "c,d", 4)], SCHEMA)
    path = scratch_path(spark, "csv-rt")
    csv_stage.write_csv(df, path)
    back = sorted(tuple(r) for r in csv_stage.read_csv(spark, path, SCHEMA, multiline=True).collect())
    assert back == sorted(tuple(r) for r in df.collect())


def test_single_line_mode_reads_plain_files_and_fails_on_quoted_newlines(spark):
    path = scratch_path(spark, "csv-plain")
    _write(_local(path), 'x,y,z,w\n1,,"",3\n2,"a ""b"" c"," pad ",\n')
    rows = sorted(tuple(r) for r in csv_stage.read_csv(spark, path, SCHEMA, multiline=False).collect())
    assert rows == [(1, None, "", 3), (2, 'a "b" c', " pad ", None)]
    path = scratch_path(spark, "csv-newline")
    _write(_local(path), 'x,y,z,w\n3,"line1\nline2",plain,7\n')
    with pytest.raises(Exception):
        csv_stage.read_csv(spark, path, SCHEMA, multiline=False).collect()


def test_newline_mode_must_be_stated(spark):
    with pytest.raises(TypeError):
        csv_stage.read_csv(spark, "unused", SCHEMA)
