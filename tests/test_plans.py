"""Plan shapes the scale design relies on (checked on the physical plan)."""

import re

from pyspark.sql import functions as F

from snapdeck.operators.checks import latest_slice
from snapdeck.operators.joins import materialize
from snapdeck.plans import dims, models, star
from snapdeck.sources import fixtures as fx

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|SinglePartition)", text)


def staged(spark):
    return materialize(models.stg_pools(fx.fx1_pools(spark, SF_SMALL), fx.fixture_config()))


def test_pool_metrics_one_shuffle_by_pool(spark):
    p = plan(models.pool_metrics(staged(spark), fx.fixture_config()))
    ex = exchanges(p)
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(pool_address")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_dim_pool_single_exchange(spark):
    ex = exchanges(plan(dims.dim_pool(staged(spark))))
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(pool_address")


def test_dim_token_partial_aggregate_before_exchange(spark):
    p = plan(dims.dim_token(staged(spark)))
    # by (address, symbol), then by address over the few symbols; combined before each
    assert [len(e.split(",")) for e in exchanges(p)] == [2, 3] and "Generate explode" in p
    assert p.count("partial_min") >= 2


def test_star_is_all_broadcast(spark):
    stg = staged(spark)
    cfg = fx.fixture_config()
    fact = models.fct_pool(models.pool_metrics(stg, cfg))
    s = star.star(fact, dims.dim_pool(stg), dims.dim_token(stg), dims.date_dim_for(fx.fx1_pools(spark, SF_SMALL), cfg), cfg)
    p = plan(s)
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") >= 5


def test_latest_slice_is_a_scalar_subquery_pushed_to_the_scan(spark, scratch):
    path = scratch("t")
    fx.fx1_pools(spark, SF_SMALL).select("snapshot_date", "pool_address").write.parquet(path)
    p = plan(latest_slice(spark.read.parquet(path)))
    assert "Subquery" in p and re.search(r"PushedFilters: \[[^\]]*ScalarSubquery", p)


def test_totals_never_shuffle_rows_by_date(spark):
    p = plan(models.pool_metrics(staged(spark), fx.fixture_config()))
    assert not any(e.startswith("hashpartitioning(snapshot_date") for e in exchanges(p))


def test_star_beyond_the_bound_keeps_the_buckets(spark, scratch):
    """Pools over the broadcast bound: fact and pools are saved in buckets of
    the pool key, and their join has no exchange."""
    stg, cfg = staged(spark), fx.fixture_config()
    fact = models.fct_pool(models.pool_metrics(stg, cfg))
    pools, tokens, dates = dims.dim_pool(stg), materialize(dims.dim_token(stg)), materialize(dims.date_dim_for(fx.fx1_pools(spark, SF_SMALL), cfg))
    want = star.star(fact, pools, tokens, dates, cfg)
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS t_star LOCATION '{scratch('ns')}'")
    f = star.save_bucketed(fact, "t_star.fct", scratch("fct"), "pool_key", 4)
    p = star.save_bucketed(pools, "t_star.pools", scratch("pools"), "pool_key", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = star.join_dimension(f, p.select("pool_key", "pool_address"), "pool_key", "pool_key", "inner", 1, stored=True)
        text = plan(joined)
        assert "SortMergeJoin" in text and exchanges(text) == []
        got = star.star(f, p, tokens, dates, cfg, stored=True)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
