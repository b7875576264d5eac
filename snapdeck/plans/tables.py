"""Publishing of model tables, and the versions of the build's own state.

A table is written beside, checked, and only then published: a whole table by
renaming folders, days of a DAY-partitioned table by a dynamic overwrite at
job commit. Readers see the old rows until then, and a failing check leaves
them in place.

The state of a build (fingerprints, dimension states, last rows) is a set of
tables that belong together. They are written below a new version folder,
which counts once its marker file exists; a build that ends before that is as
if it had not been.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from snapdeck.sources import lake

MARKER = "_COMMITTED"


# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------


def write_beside(df: DataFrame, path: str, cluster: Sequence[str], partition: str | None = None) -> DataFrame:
    """Write a whole table next to ``path`` and return it as read back."""
    beside = f"{path}__next"
    keys = [partition] if partition else []
    writer = lake.clustered(df, keys, cluster).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(beside)
    return df.sparkSession.read.schema(df.schema).parquet(beside).select(*df.columns)


def swap_in(spark: SparkSession, path: str) -> None:
    """Publish what was written beside: two renames, the old table goes last."""
    beside, fs = lake._fs(spark, f"{path}__next")
    there, _ = lake._fs(spark, path)
    old, _ = lake._fs(spark, f"{path}__old")
    fs.delete(old, True)
    if fs.exists(there):
        fs.rename(there, old)
    if not fs.rename(beside, there):
        fs.rename(old, there)
        raise OSError(f"can't publish {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def publish_days(rows: DataFrame, path: str, days: DataFrame, cluster: Sequence[str], day: str = "snapshot_date") -> None:
    """Replace ``days`` of a DAY-partitioned table by ``rows`` (written and
    checked already): each day's folder at job commit; days without a row any
    more lose theirs."""
    spark = rows.sparkSession
    lake.clustered(rows, [day], cluster).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    left = days.select(day).distinct().join(rows.select(day).distinct(), day, "left_anti")
    for r in left.collect():  # days, of which a table has one folder each
        lake.delete_path(spark, f"{path}/{day}={r[0].isoformat()}")
    spark.catalog.refreshByPath(path)


def read_days(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


# ---------------------------------------------------------------------------
# State versions
# ---------------------------------------------------------------------------


def _versions(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers of the committed folders ``<root>/<prefix><number>``, rising."""
    p, fs = lake._fs(spark, root)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(prefix) and name[len(prefix) :].isdigit():
            marker, _ = lake._fs(spark, f"{root}/{name}/{MARKER}")
            if fs.exists(marker):
                found.append(int(name[len(prefix) :]))
    return sorted(found)


def _commit(spark: SparkSession, folder: str) -> None:
    marker, fs = lake._fs(spark, f"{folder}/{MARKER}")
    fs.create(marker, True).close()


class StateStore:
    """Versions of a build's state below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def current(self) -> str | None:
        """The folder of the newest committed version."""
        found = _versions(self.spark, self.root, "v")
        return f"{self.root}/v{found[-1]}" if found else None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.current()}/{name}")

    def commit(self, tables: dict[str, DataFrame]) -> None:
        """Write the next version and make it the current one; older ones go."""
        found = _versions(self.spark, self.root, "v")
        folder = f"{self.root}/v{found[-1] + 1 if found else 1}"
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
        _commit(self.spark, folder)
        for n in found:
            lake.delete_path(self.spark, f"{self.root}/v{n}")

    # The journal: rows that a build took out of staging before its state was
    # committed. The next build takes them for the old rows of those days.

    def _journals(self) -> list[int]:
        return _versions(self.spark, self.current(), "journal") if self.current() else []

    def journal(self) -> tuple[DataFrame, DataFrame] | None:
        """(days, rows) that an unfinished build left behind."""
        found = self._journals()
        if not found:
            return None
        folder = f"{self.current()}/journal{found[-1]}"
        return self.spark.read.parquet(f"{folder}/days"), self.spark.read.parquet(f"{folder}/rows")

    def write_journal(self, days: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Keep the old rows of ``days``, all of the earlier journal included."""
        found = self._journals()
        folder = f"{self.current()}/journal{found[-1] + 1 if found else 1}"
        days.write.mode("overwrite").parquet(f"{folder}/days")
        rows.write.mode("overwrite").parquet(f"{folder}/rows")
        _commit(self.spark, folder)
        return self.spark.read.parquet(f"{folder}/days"), self.spark.read.parquet(f"{folder}/rows")


def drop_state(spark: SparkSession, root: str) -> None:
    """Forget a state (before a full build replaces what it describes). The
    folder is renamed first, so that no version is left half deleted."""
    p, fs = lake._fs(spark, root)
    if fs.exists(p):
        away, _ = lake._fs(spark, f"{root}__{uuid.uuid4().hex[:8]}")
        fs.rename(p, away)
        fs.delete(away, True)


