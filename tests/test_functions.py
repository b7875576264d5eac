"""Column functions on hand-made literals (FIXTURES FX6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdeck.functions import (
    canonical_label,
    freshness_status,
    hours_between,
    ratio_or_null,
    ratio_or_zero,
    safe_double,
    split_pair,
    status_band,
    surrogate_key,
    week_sunday,
)


def one_col(spark, values, ddl="v string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_safe_double(spark):
    vals = ["12.5", " 12 ", "1e3", "abc", "", None, "NaN", "inf", "1.0d", "1_000"]
    got = [r[0] for r in one_col(spark, vals).select(safe_double("v")).collect()]
    assert got == [12.5, 12.0, 1000.0, None, None, None, None, None, None, None]


def test_split_pair(spark):
    vals = ["SOL-USDC", "-USDC", "SOL-", "A-B-C", "SOL", "", None]
    b, q = split_pair("v")
    got = [tuple(r) for r in one_col(spark, vals).select(b, q).collect()]
    assert got == [("SOL", "USDC"), ("UNKNOWN", "USDC"), ("SOL", None), ("A", "B-C"), (None, None), (None, None), (None, None)]


def test_mints_get_past_end(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b"],), (None,)], "m array<string>")
    got = [tuple(r) for r in df.select(F.get("m", 0), F.get("m", 1)).collect()]
    assert got == [(None, None), ("a", None), ("a", "b"), (None, None)]


def test_canonical_label_first_match_wins(spark):
    got = [r[0] for r in one_col(spark, ["Raydium Orca", "ORCA dex", "Phoenix"]).select(canonical_label("v", ["raydium", "orca", "meteora"])).collect()]
    assert got == ["raydium", "orca", "phoenix"]


def test_ratio_rules(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (None, 5.0), (5.0, -1.0)], "n double, d double")
    z = [r[0] for r in df.select(ratio_or_zero("n", "d")).collect()]
    n = [r[0] for r in df.select(ratio_or_null("n", "d")).collect()]
    assert z == [0.0, 0.0, None, 0.0]
    assert n == [None, None, None, -5.0]


def test_week_sunday(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 1),), (dt.date(2026, 1, 4),), (dt.date(2023, 1, 1),)], "d date")
    assert [r[0] for r in df.select(week_sunday("d")).collect()] == [0, 1, 1]


def test_week_sunday_matches_strftime_u(spark):
    import duckdb

    days = spark.range(0, 2557).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    ours = {r[0]: r[1] for r in days.select("d", week_sunday("d")).collect()}
    ref = dict(duckdb.sql("select d::date, cast(strftime(d, '%U') as int) from range(date '2024-01-01', date '2031-01-01', interval 1 day) t(d)").fetchall())
    assert ours == ref


@pytest.mark.parametrize("age,status", [(26 * 3600, "pass"), (26 * 3600 + 1, "warn"), (48 * 3600, "warn"), (48 * 3600 + 1, "error"), (None, "error")])
def test_freshness_status(spark, age, status):
    df = spark.createDataFrame([(age,)], "a long")
    assert df.select(freshness_status("a")).first()[0] == status


def test_status_band(spark):
    df = spark.createDataFrame([(25,), (26,), (47,), (48,)], "h int")
    assert [r[0] for r in df.select(status_band("h")).collect()] == ["green", "yellow", "yellow", "red"]


def test_hours_between_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 0, 59), dt.datetime(2026, 1, 1, 1, 1))], "a timestamp, b timestamp")
    assert df.select(hours_between("b", "a")).first()[0] == 0


def test_surrogate_key_null_safe_and_stable(spark):
    import duckdb

    from snapdeck.plans.oracle import key

    df = spark.createDataFrame([("x", None), (None, None)], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert all(k is not None and len(k) == 32 for k in keys) and keys[0] != keys[1]
    ref = duckdb.sql(f"select {key('a', 'b')} from (values ('x', null::varchar), (null::varchar, null::varchar)) t(a, b)").fetchall()
    assert keys == [r[0] for r in ref]


def test_uri_parts(spark):
    from snapdeck.functions import uri_parts

    vals = ["gs://b/a/c.json", "S3A://b", "s3://b/", "file:///x/y", "/x/y", "x/y", "hdfs://h:8020//x", "", None]
    got = [tuple(r) for r in one_col(spark, vals).select(uri_parts("v").alias("p")).select("p.*").collect()]
    assert got == [("gs", "b", "a/c.json"), ("s3a", "b", ""), ("s3", "b", ""), ("file", None, "x/y"), (None, None, "x/y"),
                   (None, None, "x/y"), ("hdfs", "h:8020", "x"), (None, None, ""), (None, None, None)]
