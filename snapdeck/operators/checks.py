"""Data-quality checks. Each returns a small DataFrame; non-zero ``failures``
(or, for the latest-snapshot checks, any row at all) fails the build.

Row-level tests of one table run in ONE aggregate pass (``row_level_suite``);
all keys of a table (unique, unique combination) share one shuffle of hashes,
which is partially aggregated, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdeck.functions import freshness_status, seconds_between
from snapdeck.operators.joins import BROADCAST_BYTES, join_small, materialize

@dataclass(frozen=True)
class RowTest:
    """A test decided row by row: ``bad`` is true on a violating row."""

    test: str
    column_name: str
    bad: Column


def not_null(cols: Iterable[str]) -> list[RowTest]:
    return [RowTest("not_null", c, F.col(c).isNull()) for c in cols]


def accepted_values(c: str, values: Sequence[str]) -> RowTest:
    # NULL passes (a NULL is the not_null test's business)
    return RowTest("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(*values))


def no_negative(c: str) -> RowTest:
    return RowTest("no_negative", c, F.col(c) < 0)


def no_future(c: str, as_of: Column) -> RowTest:
    return RowTest("no_future", c, F.col(c) > as_of)


def row_level_suite(df: DataFrame, model: str, tests: Sequence[RowTest]) -> DataFrame:
    """Evaluate every row-level test in a single scan + global aggregate."""
    counts = df.agg(*[F.count_if(t.bad).alias(f"_t{i}") for i, t in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.lit(t.test).alias("test"),
                F.lit(t.column_name).alias("column_name"),
                F.col(f"_t{i}").cast("long").alias("failures"),
            )
            for i, t in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows))


def unique_combination(df: DataFrame, model: str, cols: Sequence[str], test: str | None = None) -> DataFrame:
    """Number of key values (combinations) that occur more than once.

    For a single column, NULL keys are ignored, as a unique test does.
    """
    keyed = df
    if len(cols) == 1:
        keyed = df.filter(F.col(cols[0]).isNotNull())
    dup = keyed.groupBy(*cols).count().filter(F.col("count") > 1)
    name = test or ("unique" if len(cols) == 1 else "unique_combination_of_columns")
    return dup.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(name).alias("test"), F.lit(",".join(cols)).alias("column_name"), "failures"
    )


def _key_name(cols: Sequence[str]) -> str:
    return "unique" if len(cols) == 1 else "unique_combination_of_columns"


def _key_hashes(cols: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a key in two lanes. Spark's hash passes over nulls, so which
    columns are null is hashed too."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit(1), nulls, *cols)


def repeated_key_hashes(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """(key, a, b) of the key hashes that more than one row has, for all
    ``keys`` of a table in ONE exchange of 20 bytes a row and key. A repeated
    value combines map-side, however often it is there."""
    each = []
    for i, cols in enumerate(keys):
        a, b = _key_hashes(cols)
        # a null in a single column is no key
        counted = F.col(cols[0]).isNotNull() if len(cols) == 1 else F.lit(True)
        each.append(F.struct(F.when(counted, F.lit(i)).alias("key"), a.alias("a"), b.alias("b")))
    one = F.explode(F.array(*each)) if len(each) > 1 else each[0]
    hashed = df.select(one.alias("k")).select("k.*").filter(F.col("key").isNotNull())
    return hashed.groupBy("key", "a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).drop("n")


def unique_suite(df: DataFrame, model: str, keys: Sequence[Sequence[str]], max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """C2/C4 for all ``keys`` of a table: how many values of each occur more
    than once. Rows are read again, and compared by value, only for hashes
    that repeat; a table without any takes one pass."""
    hits = materialize(repeated_key_hashes(df, keys))
    found = {r["key"] for r in hits.select("key").distinct().collect()}  # at most the number of keys
    counts = dict.fromkeys(range(len(keys)), 0)
    for i in sorted(found):
        cols = list(keys[i])
        a, b = _key_hashes(cols)
        rows = df.select(*cols, a.alias("_a"), b.alias("_b"))
        mine = hits.filter(F.col("key") == i).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
        same = join_small(rows, mine, ["_a", "_b"], "left_semi", max_bytes)
        counts[i] = same.groupBy(*cols).count().filter(F.col("count") > 1).count()
    rows = [(model, _key_name(cols), ",".join(cols), counts[i]) for i, cols in enumerate(keys)]
    return df.sparkSession.createDataFrame(rows, "model string, test string, column_name string, failures long")


def latest_slice(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of the latest date, via a scalar subquery (no driver round trip)."""
    return df.filter(F.col(date_col) == df.select(F.max(date_col)).scalar())


def latest_min_distinct(df: DataFrame, col: str, minimum: int, date_col: str = "snapshot_date", alias: str = "dex_count") -> DataFrame:
    """One row ``(alias)`` when the latest snapshot has fewer than ``minimum``
    distinct ``col`` values; empty when it passes. An empty table fails."""
    n = latest_slice(df, date_col).agg(F.count_distinct(col).cast("long").alias(alias))
    return n.filter(F.col(alias) < minimum)


def latest_min_rows(df: DataFrame, minimum: int, date_col: str = "snapshot_date") -> DataFrame:
    """One row ``(row_count)`` when the latest snapshot has fewer than ``minimum`` rows."""
    n = latest_slice(df, date_col).agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    return n.filter(F.col("row_count") < minimum)


def freshness(tables: dict[str, DataFrame], as_of: Column, warn_hours: int, error_hours: int, ts_col: str = "snapshot_at") -> DataFrame:
    """Age of each table's newest ``snapshot_at`` and its status."""
    parts = []
    for name, df in tables.items():
        last = df.agg(F.max(ts_col).alias("last_snapshot_at"))
        parts.append(
            last.select(
                F.lit(name).alias("table_name"),
                "last_snapshot_at",
                seconds_between(as_of, F.col("last_snapshot_at")).alias("age_seconds"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", freshness_status("age_seconds", warn_hours, error_hours))
