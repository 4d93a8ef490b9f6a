"""Column profiles: exact measures, sketches within their error, and merging."""

from pyspark.sql import functions as F

from stocktake.operators import profile


def _table(spark, n=20_000):
    return spark.range(0, n, numPartitions=5).selectExpr(
        "id", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN ' ' ELSE concat('v', id % 3000) END AS name",
        "CASE WHEN id % 4 = 0 THEN 'none' ELSE cast(id / 2 AS string) END AS amount", "cast(id % 3 AS int) AS part")


def test_measures_and_sketches(spark):
    got = {r.column_name: r for r in profile.read_profile(profile.column_profile(_table(spark))).collect()}
    assert set(got) == {"id", "name", "amount", "part"}
    name, amount = got["name"], got["amount"]
    assert (name.rows, name.nulls, name.blanks, name.min_length, name.max_length, name.numbers) == (20_000, 2000, 2000, 1, 5, 0)
    assert (name.smallest, name.largest, name.quantiles) == (" ", "v999", None)
    assert abs(name.distinct_values - 2401) < 0.06 * 2401 and got["part"].distinct_values == 3
    assert amount.numbers == 15_000 and abs(amount.distinct_values - 15_001) < 0.06 * 15_001
    for q, value in zip(profile.QUANTILES, amount.quantiles):
        assert abs(value - q * 10_000) < 300


def test_profiles_of_parts_merge_into_that_of_the_whole(spark):
    df = _table(spark)
    parts = profile.column_profile(df, by=("part",))
    assert parts.count() == 9
    merged = {r.column_name: r for r in profile.read_profile(profile.merge_profiles(parts)).collect()}
    whole = {r.column_name: r for r in profile.read_profile(profile.column_profile(df, ["id", "name", "amount"])).collect()}
    for c, r in whole.items():
        assert [merged[c][m] for m in profile.EXACT] == [r[m] for m in profile.EXACT]
        assert abs(merged[c].distinct_values - r.distinct_values) <= 0.05 * r.distinct_values
    by_part = profile.merge_profiles(parts, by=("part",))
    assert sorted(map(str, by_part.drop("distinct_sketch", "number_sketch").collect())) == sorted(
        map(str, parts.select(*by_part.drop("distinct_sketch", "number_sketch").columns).collect()))


def test_one_pass_and_no_rows_shuffled(spark, tmp_path):
    _table(spark).write.parquet(str(tmp_path / "t"))
    plan = profile.column_profile(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert plan.count("FileScan") == 1
    assert all("partial_" in lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line)


def test_empty_table(spark):
    got = profile.read_profile(profile.column_profile(_table(spark).limit(0))).collect()
    assert [(r.rows, r.nulls, r.smallest, r.distinct_values, r.quantiles) for r in got] == [(0, 0, None, 0, None)] * 4
    assert profile.column_profile(_table(spark).limit(0), by=("part",)).collect() == []
