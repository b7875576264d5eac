"""Tables by name (S12, S13): a namespace for each layer, bound to settings.

Raw, staging (with the intermediate tables) and marts each have a namespace
from ``Config``. The tables are external: the data stays below ``Paths``, and
a name is bound to its folder, so a session finds them by name wherever the
session's catalog is shared (a metastore, or the sessions of one context).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapdeck.config import DEFAULT, Config
from snapdeck.sources import lake

# Which tables each layer holds.
RAW = ("raw_dex_pools", "raw_dex_market_share")
STAGING = ("stg_dex_pools", "stg_dex_market_share", "int_pool_metrics", "int_market_share_metrics")
MARTS = ("fct_pool_trailing_24h", "fct_dex_market_share_daily", "dim_pool", "dim_token", "dim_date")


def _quoted(namespace: str) -> str:
    return ".".join(f"`{p}`" for p in namespace.split("."))


def names(cfg: Config = DEFAULT) -> dict[str, str]:
    """Table name -> namespace.table."""
    layers = ((cfg.raw_namespace, RAW), (cfg.staging_namespace, STAGING), (cfg.marts_namespace, MARTS))
    return {t: f"{ns}.{t}" for ns, tables in layers for t in tables}


def table(spark: SparkSession, name: str, cfg: Config = DEFAULT) -> DataFrame:
    """A table of any layer by its logical name."""
    return spark.table(names(cfg)[name])


def bind(spark: SparkSession, paths, cfg: Config = DEFAULT) -> list[str]:
    """Bind every table that is there to its name, and return the names. A
    name that led elsewhere leads here from then on; no data is touched."""
    for ns in dict.fromkeys((cfg.raw_namespace, cfg.staging_namespace, cfg.marts_namespace)):
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(ns)} LOCATION '{paths.models}/_namespaces/{ns}'")
    bound = []
    for name, full in names(cfg).items():
        path = paths.raw_table(name) if name in RAW else paths.model_table(name)
        if not lake.has_rows_on_disk(spark, path):
            continue
        ns = _quoted(full.rsplit(".", 1)[0])
        spark.sql(f"DROP TABLE IF EXISTS {ns}.`{name}`")  # external: the folder stays
        spark.sql(f"CREATE TABLE {ns}.`{name}` USING parquet LOCATION '{path}'")
        if any(c.isPartition for c in spark.catalog.listColumns(full)):
            spark.catalog.recoverPartitions(full)
        bound.append(full)
    return bound
