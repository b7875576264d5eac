"""What several operators share: staged tables, Arrow row mapping, bounded caches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapdeck.operators.joins import row_bytes
from snapdeck.session import scratch_path

#: Rows that a Python worker turns into output at once. Documents can be long,
#: so an incoming Arrow batch is worked through in small slices.
SLICE_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage in a place that survives lost executors, and lets later
    reads prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_bytes: int) -> bool:
    """Whether a staged table is proven small: its rows times their width.

    Strings and arrays are measured, not assumed.
    """
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 16
        elif isinstance(f.dataType, T.ArrayType):
            width = width + F.greatest(F.size(F.col(f.name)), F.lit(0)) * 16 + 24
        else:
            width = width + 16
    total = df.agg(F.sum(width).alias("b")).first()["b"]
    return (total or 0) <= max_bytes


#: Bytes of a row in a broadcast relation besides its values.
ROW_OVERHEAD = 80


def join_measured(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", max_bytes: int = 64 << 20
) -> DataFrame:
    """``big`` joined to the staged ``small``, which is broadcast if its rows
    (values and overhead) were measured to fit; else both are shuffled, and
    AQE splits hot keys. Null keys meet each other."""
    measure = F.sum(row_bytes(small.schema) + ROW_OVERHEAD).alias("b")
    fits = (small.agg(measure).first()["b"] or 0) <= max_bytes
    side = small.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    on = None
    for k in keys:
        same = big[k].eqNullSafe(side[f"__k_{k}"])
        on = same if on is None else on & same
    return big.join(F.broadcast(side) if fits else side, on, how).drop(*[f"__k_{k}" for k in keys])


def importable(df: DataFrame) -> DataFrame:
    """``df``, after telling the session's Python workers where this package
    lies: a driver that found it by ``sys.path`` alone has workers that don't.
    (On a cluster the package comes with --py-files or the image.)"""
    root = str(Path(__file__).resolve().parents[2])
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


class _Holder:
    """The one large object that a worker keeps between tasks."""

    def __init__(self) -> None:
        self.key: Any = None
        self.value: Any = None
        self.asked = False

    def get(self, key: Any, build: Callable[[], Any]) -> Any:
        self.asked = True
        if self.key != key:
            self.key = self.value = None  # before the next one is built
            self.key, self.value = key, build()
        return self.value

    def starting(self, make: Callable[[], Any]) -> Any:
        """What ``make`` returns for a task. A task that doesn't ask for the
        object, one of another operator, lets it go."""
        self.asked = False
        fn = make()
        if not self.asked:
            self.key = self.value = None
        return fn


_holder = _Holder()


def held(key: Any, build: Callable[[], Any]) -> Any:
    """A vocabulary with its caches: built once a worker, kept between the
    tasks of its operator, and given up when another one's tasks come."""
    return _holder.get(key, build)


def starting(make: Callable[[], Any]) -> Any:
    return _holder.starting(make)


def map_rows(
    df: DataFrame,
    columns: Sequence[str],
    schema: T.StructType,
    make: Callable[[], Callable[..., Iterable[tuple]]],
) -> DataFrame:
    """Run Python over rows in Arrow batches.

    ``make`` is called once per task and returns a function from the values
    of ``columns`` to the output rows of that input row.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = starting(make)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                rows = [out for row in zip(*(c.to_pylist() for c in part.columns)) for out in fn(*row)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow
                    )

    return importable(df).select(*columns).mapInArrow(run, schema)


class TwoAgeCache:
    """A dict of bounded size: when the young half is full it becomes the old
    half, and the former old half is forgotten. Entries in use move back.
    Keys longer than ``longest`` are computed each time."""

    def __init__(self, compute: Callable[[Any], Any], entries: int, longest: int):
        self.compute, self.half, self.longest = compute, max(1, entries // 2), longest
        self.young: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        got = self.young.get(key)
        return self.miss(key) if got is None else got

    def miss(self, key):
        """What a look-up in ``young`` (bound by a caller's loop) didn't find."""
        got = self.old.get(key)
        if got is None:
            got = self.compute(key)
            if len(key) > self.longest:
                return got
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = got
        return got
