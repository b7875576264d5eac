"""Row frames over ranges equal the window form, and spread a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from snapdeck.operators import by_range
from snapdeck.operators.joins import materialize
from snapdeck.plans import models
from snapdeck.sources import fixtures as fx

from conftest import SF_SMALL

MADE = {
    "avg_7": lambda w: F.avg("v").over(w.rowsBetween(-6, Window.currentRow)),
    "ago_7": lambda w: F.lag("v", 7).over(w),
    "ago_1": lambda w: F.lag("v", 1).over(w),
}


def windowed(df):
    w = Window.partitionBy("k").orderBy("t")
    return df.withColumns({n: make(w) for n, make in MADE.items()})


def same(a, b):
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 16, 60])
def test_equals_the_window_form(spark, parts):
    """One key with a third of all rows, null keys, keys of one row; with many
    partitions a frame reaches over several of them."""
    rng = random.Random(parts)
    keys = ["hot"] * 100 + [None] * 20 + [rng.choice("abcdef") for _ in range(150)] + [f"x{i}" for i in range(30)]
    rows = [(k, i, float(rng.randrange(100))) for i, k in enumerate(rng.sample(keys, len(keys)))]
    df = spark.createDataFrame(rows, "k string, t long, v double").repartition(7)
    same(by_range.row_frames(df, ["k"], ["t"], 7, MADE, num_partitions=parts), windowed(df))
    assert by_range.row_frames(df.filter("false"), ["k"], ["t"], 7, MADE, num_partitions=parts).count() == 0


def test_a_hot_key_spreads(spark):
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                               F.col("id").alias("t"), (F.col("id") % 97).cast("double").alias("v"))
    df = materialize(df)
    near = materialize(by_range.with_halo(df, ["k"], ["t"], 7, num_partitions=24))
    sizes = sorted(r["count"] for r in near.filter("k = 'hot'").groupBy("_part").count().collect())
    assert len(sizes) >= 7 and sizes[-1] < 2 * n / 24  # a third of 24 partitions or more, none much larger than its share
    assert near.filter("_halo").count() <= 7 * 24 and near.filter("NOT _halo").count() == n
    same(by_range.row_frames(df, ["k"], ["t"], 7, MADE, num_partitions=24), windowed(df))


def test_pool_metrics_by_ranges(spark):
    cfg = fx.fixture_config()
    stg = materialize(models.stg_pools(fx.fx1_pools(spark, SF_SMALL), cfg))
    a, b = models.pool_metrics(stg, cfg, frames="range"), models.pool_metrics(stg, cfg)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 < a.count()
