"""The skew-safe row numbering equals a window row_number, hot key included."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapdeck.operators.ranking import row_number_within


def test_matches_window_on_skewed_keys(spark):
    # key 0 holds a third of all rows
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        (F.col("id") * 7919 % 10007).alias("v"),
        "id",
    )
    order = [F.desc("v"), F.asc("id")]
    ours = row_number_within(df, ["k"], order, num_partitions=8)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    j = ours.join(ref, ["k", "v", "id"])
    assert j.count() == 30000
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0
