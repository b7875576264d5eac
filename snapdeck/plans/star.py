"""Star joins: pool fact to its pool, token (role-playing) and date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdeck.config import DEFAULT, Config
from snapdeck.operators.joins import bounded_broadcast, materialize, row_bytes
from snapdeck.plans import dims, models


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str, max_bytes: int, stored: bool = False) -> DataFrame:
    """Broadcast the dimension when its checked size allows; otherwise a shuffle
    join (AQE splits a hot key's partition on the fact side). A ``stored``
    dimension is measured where it lies and keeps its buckets: beyond the
    bound, a fact bucketed alike is joined without an exchange."""
    if stored:
        n = dim.agg(F.sum(row_bytes(dim.schema)).alias("n")).first()["n"] or 0
        side = F.broadcast(dim) if n <= max_bytes else dim
    else:
        side, _ = bounded_broadcast(dim, max_bytes)
    return fact.join(side, fact[fact_key] == side[dim_key], how)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Save a table below ``path`` under the catalog name ``name``, in so many
    buckets of ``key``, each one sorted file, and return it. Tables that are
    joined on the key get the same number."""
    laid = df.repartition(buckets, key).sortWithinPartitions(key)
    laid.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def star(
    fact: DataFrame, dim_pool: DataFrame, dim_token: DataFrame, dim_date: DataFrame, cfg: Config = DEFAULT, stored: bool = False
) -> DataFrame:
    """J5-J7. Token joins are LEFT: a NULL token address still hashes to a key
    no token row has. ``stored``: the inputs are tables (see ``join_dimension``)."""
    p = dim_pool.select("pool_key", "pool_address", F.col("dex_name").alias("pool_dex_name"))
    bt = dim_token.select(F.col("token_key").alias("bt_key"), F.col("token_symbol").alias("base_token_latest_symbol"))
    qt = dim_token.select(F.col("token_key").alias("qt_key"), F.col("token_symbol").alias("quote_token_latest_symbol"))
    d = dim_date.select("calendar_date", "week_number", "is_weekend", "month_number")
    f = fact.select(
        "pool_snapshot_key",
        "pool_key",
        "base_token_key",
        "quote_token_key",
        "snapshot_date",
        "trailing_24h_volume_usd",
        "fee_rate_pct",
        "pool_share_of_market_pct",
    )
    m = cfg.broadcast_max_bytes
    # the pool first: its join can use the fact's buckets
    j = join_dimension(f, p, "pool_key", "pool_key", "inner", m, stored).drop(p["pool_key"])
    j = join_dimension(j, bt, "base_token_key", "bt_key", "left", m, stored)
    j = join_dimension(j, qt, "quote_token_key", "qt_key", "left", m, stored)
    j = join_dimension(j, d, "snapshot_date", "calendar_date", "inner", m, stored)
    return j.select(
        "pool_snapshot_key",
        "snapshot_date",
        "pool_address",
        "pool_dex_name",
        "base_token_latest_symbol",
        "quote_token_latest_symbol",
        "week_number",
        "is_weekend",
        "month_number",
        "trailing_24h_volume_usd",
        "fee_rate_pct",
        "pool_share_of_market_pct",
    )


def star_pool_token_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    from snapdeck.sources import fixtures as fx

    cfg = fx.fixture_config()
    raw = fx.fx1_pools(spark, sf_dir)
    # staging feeds the fact and both entity dimensions: materialize it once
    stg = materialize(models.stg_pools(raw, cfg))
    fact = models.fct_pool(models.pool_metrics(stg, cfg))
    return star(fact, dims.dim_pool(stg), dims.dim_token(stg), dims.date_dim_for(raw, cfg), cfg)
