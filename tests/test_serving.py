"""Serving queries on small hand-made inputs."""

import datetime as dt

from pyspark.sql import functions as F

from snapdeck.functions import canonical_label, contains_any
from snapdeck.plans import serving as sv
from snapdeck.sources import fixtures as fx

from conftest import SF_SMALL

AS_OF = dt.datetime(2026, 6, 10, 12, tzinfo=dt.timezone.utc)


def pools(spark, rows):
    return spark.createDataFrame(rows, "snapshot_date date, snapshot_at timestamp, pool_address string, fees double")


def test_hours_since_last_snapshot_and_band(spark):
    df = pools(spark, [(dt.date(2026, 6, 8), dt.datetime(2026, 6, 9, 2, tzinfo=dt.timezone.utc), "a", 1.0)])
    r = sv.hours_since_last_snapshot(df, F.lit(AS_OF)).first()
    assert (r.hours_since_last_snapshot, r.status) == (34, "yellow")


def test_rows_vs_7d(spark):
    rows = []
    for i, n in enumerate([10, 10, 10, 10, 10, 10, 10, 3]):  # 8 days, the last has 3 rows
        d = dt.date(2026, 6, 1) + dt.timedelta(days=i)
        rows += [(d, None, f"p{j}", 1.0) for j in range(n)]
    r = sv.rows_vs_7d(pools(spark, rows)).first()
    assert r.rows_today == 3 and r.rows_7d_avg == round((6 * 10 + 3) / 7)


def test_top_latest_ties_break_on_address(spark):
    d0, d1 = dt.date(2026, 6, 1), dt.date(2026, 6, 2)
    rows = [(d0, None, "z", 99.0), (d1, None, "b", 5.0), (d1, None, "a", 5.0), (d1, None, "c", None), (d1, None, "d", 1.0)]
    top = sv.top_latest(pools(spark, rows), "fees", 3, ["pool_address", "fees"], "rank").orderBy("rank").collect()
    assert [(r.pool_address, r.rank) for r in top] == [("a", 1), ("b", 2), ("d", 3)]


def test_share_change_trend(spark):
    rows = [(dt.date(2026, 6, 2), "orca", 40.0, 30.0), (dt.date(2026, 6, 2), "raydium", 30.0, 40.0), (dt.date(2026, 6, 2), "meteora", 30.0, 30.0), (dt.date(2026, 6, 1), "orca", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "snapshot_date date, dex_name string, dex_market_share_pct double, share_7d_avg double")
    df = df.withColumn("share_change_vs_7d_avg_pct", F.col("dex_market_share_pct") - F.col("share_7d_avg"))
    got = {r.dex_name: r.trend for r in sv.share_change(df).collect()}
    assert got == {"orca": "gaining", "raydium": "losing", "meteora": "flat"}


def test_text_predicates_with_nulls(spark):
    df = spark.createDataFrame([(None,), ("Orca Whirlpools",), ("x",)], "n string")
    got = [tuple(r) for r in df.select(contains_any("n", ["orca"]), canonical_label("n", ["orca"])).collect()]
    assert got == [(False, None), (True, "orca"), (False, "x")]


def test_stored_status_reads_footers_only(spark, scratch):
    """Counts and newest days without a row group, of plain and DAY-partitioned tables."""
    from snapdeck.sources import lake, schemas

    raw = fx.fx1_pools(spark, SF_SMALL).filter("snapshot_date >= DATE'2001-08-01'")
    plain, days = scratch("plain"), scratch("days")
    lake.conform(raw, schemas.RAW_POOLS).write.parquet(plain)
    lake.load_slices(raw, days, schema=schemas.RAW_POOLS)
    want = raw.agg(F.max("snapshot_date"), F.count("*")).first()
    got = {r.tbl: (r.last_snapshot, r.rows_total) for r in sv.stored_status(spark, {"a": plain, "b": days}).collect()}
    assert got == {"a": tuple(want), "b": tuple(want)}
    plan = sv.footer_aggregate(spark, plain)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(snapshot_date), COUNT(*)]" in plan
