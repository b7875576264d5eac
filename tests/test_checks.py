"""Each check fires on one broken input and passes on the clean one (FIXTURES section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapdeck import config as C
from snapdeck.operators import checks as ck
from snapdeck.operators.joins import materialize
from snapdeck.plans import models
from snapdeck.sources import fixtures as fx

from conftest import SF_SMALL

AS_OF = dt.datetime(2001, 11, 6, 12, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def stg(spark):
    return materialize(models.stg_pools(fx.fx1_pools(spark, SF_SMALL), fx.fixture_config()))


def suite(df):
    tests = ck.not_null(["snapshot_date", "snapshot_at", "dex_name", "pool_address", "trailing_24h_volume_usd"]) + [
        ck.accepted_values("dex_name", C.POOL_VENUES),
        ck.no_future("snapshot_date", F.to_date(F.lit(AS_OF))),
        ck.no_negative("trailing_24h_volume_usd"),
    ]
    return {(r.test, r.column_name): r.failures for r in ck.row_level_suite(df, "stg", tests).collect()}


def first_row_with(df, **changes):
    one = df.limit(1)
    for k, v in changes.items():
        one = one.withColumn(k, v)
    return df.unionByName(one)


def test_clean_passes(spark, stg):
    assert all(v == 0 for v in suite(stg).values())
    assert ck.unique_combination(stg, "stg", ["snapshot_date", "dex_name", "pool_address"]).first().failures == 0


def test_null_pool_address(spark, stg):
    broken = first_row_with(stg, pool_address=F.lit(None).cast("string"))
    assert suite(broken)[("not_null", "pool_address")] == 1


def test_repeated_slice_row(spark, stg):
    broken = stg.unionByName(stg.limit(1))
    assert ck.unique_combination(broken, "stg", ["snapshot_date", "dex_name", "pool_address"]).first().failures == 1


def test_same_pool_two_venues_passes_staging_fails_fact(spark, stg):
    other = stg.limit(1).withColumn("dex_name", F.when(F.col("dex_name") == "orca", "raydium").otherwise("orca"))
    broken = stg.unionByName(other)
    assert ck.unique_combination(broken, "stg", ["snapshot_date", "dex_name", "pool_address"]).first().failures == 0
    fct = models.fct_pool(models.pool_metrics(broken, fx.fixture_config()))
    assert ck.unique_combination(fct, "fct", ["pool_snapshot_key"]).first().failures == 1


def test_unknown_venue(spark, stg):
    assert suite(first_row_with(stg, dex_name=F.lit("other")))[("accepted_values", "dex_name")] == 1


def test_future_date(spark, stg):
    assert suite(first_row_with(stg, snapshot_date=F.lit(dt.date(2001, 11, 7))))[("no_future", "snapshot_date")] == 1


def test_negative_volume(spark, stg):
    assert suite(first_row_with(stg, trailing_24h_volume_usd=F.lit(-1).cast("decimal(38,9)")))[("no_negative", "trailing_24h_volume_usd")] == 1


def test_latest_checks(spark, stg):
    last = stg.agg(F.max("snapshot_date")).first()[0]
    later = last + dt.timedelta(days=1)
    # latest date with two venues and 49 rows
    extra = stg.filter(F.col("dex_name") != "meteora").limit(49).withColumn("snapshot_date", F.lit(later))
    extra = extra.withColumn("pool_address", F.concat(F.lit("X"), F.monotonically_increasing_id().cast("string")))
    broken = stg.unionByName(extra)
    assert ck.latest_min_distinct(broken, "dex_name", 3).first().dex_count == 2
    assert ck.latest_min_rows(broken, 50).first().row_count == 49
    assert ck.latest_min_rows(broken, 49).count() == 0


def test_empty_table_fails_latest_checks_only(spark, stg):
    empty = stg.limit(0)
    assert all(v == 0 for v in suite(empty).values())
    assert ck.latest_min_distinct(empty, "dex_name", 3).first().dex_count == 0
    assert ck.latest_min_rows(empty, 50).first().row_count == 0


def test_freshness_levels(spark):
    def status(hours_ago):
        t = AS_OF - dt.timedelta(hours=hours_ago)
        df = spark.createDataFrame([(t,)], "snapshot_at timestamp")
        return ck.freshness({"t": df}, F.lit(AS_OF), 26, 48).first().status

    assert status(25) == "pass" and status(27) == "warn" and status(49) == "error"
