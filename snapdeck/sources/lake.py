"""The raw lake and the raw tables: layout, landing, manifest, slice loads.

Storage is plain partitioned files (parquet for tables, JSON lines for
landed pages) under a root folder. A slice is one (date, venue) partition.
Loads are idempotent per slice: present and not overwriting -> skipped;
present and overwriting -> replaced by dynamic partition overwrite (the old
slice stays until the write job commits); absent -> appended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.config import DEFAULT, Config
from snapdeck.operators.joins import bounded_broadcast, join_small, materialize

# ---------------------------------------------------------------------------
# The lake layout.
#   pools:  <root>/dex_pools/dex=<venue>/date=<YYYY-MM-DD>/<venue>_<YYYYMMDD>.json
#   market: <root>/dex_market_share/date=<YYYY-MM-DD>/defillama_<YYYYMMDD>.json
# ---------------------------------------------------------------------------
POOLS_DIR = "dex_pools"
MARKET_DIR = "dex_market_share"
MARKET_FILE_PREFIX = "defillama"

# Raw tables are DAY-partitioned on snapshot_date; rows inside a day are
# clustered by (dex_name, pool_address). A slice is one (date, venue).
PARTITION_COL = "snapshot_date"
SLICE_KEYS = ("snapshot_date", "dex_name")


def pool_slice_path(root: Column, dex: Column, date: Column) -> Column:
    """Landing path of one venue's document for one day."""
    return F.concat(
        root, F.lit(f"/{POOLS_DIR}/dex="), dex, F.lit("/date="), date.cast("string"), F.lit("/"), dex, F.lit("_"), F.date_format(date, "yyyyMMdd"), F.lit(".json")
    )


def market_slice_path(root: Column, date: Column) -> Column:
    """Landing path of the market document for one day."""
    return F.concat(
        root, F.lit(f"/{MARKET_DIR}/date="), date.cast("string"), F.lit(f"/{MARKET_FILE_PREFIX}_"), F.date_format(date, "yyyyMMdd"), F.lit(".json")
    )


def pool_slice_path_str(root: str, dex: str, date: dt.date) -> str:
    return f"{root}/{POOLS_DIR}/dex={dex}/date={date.isoformat()}/{dex}_{date.strftime('%Y%m%d')}.json"


# ---------------------------------------------------------------------------
# Landing (S2, S3, S4, S6)
# ---------------------------------------------------------------------------


def landed_slices(spark: SparkSession, lake_root: str) -> DataFrame:
    """(source, snapshot_date) of the slices that the lake holds a file of, by
    a listing of its folders: no file is read."""
    found = []
    for folder, source in ((POOLS_DIR, None), (MARKET_DIR, MARKET_FILE_PREFIX)):
        if not has_rows_on_disk(spark, f"{lake_root}/{folder}"):
            continue
        files = spark.read.format("binaryFile").option("basePath", f"{lake_root}/{folder}").load(f"{lake_root}/{folder}")
        dex = F.col("dex").cast("string") if source is None else F.lit(source)
        found.append(files.select(dex.alias("source"), F.col("date").cast("date").alias("snapshot_date")).distinct())
    if not found:
        return spark.createDataFrame([], "source string, snapshot_date date")
    return found[0].unionByName(found[1]) if len(found) > 1 else found[0]


def land_pages(pages: DataFrame, lake_root: str, overwrite: bool = False) -> None:
    """S3: write landed pages as JSON lines under dex=/date= partitions.

    One page per line, so a day's feed is split across files and tasks.
    Without ``overwrite``, slices that the lake already holds are left as they
    are (write-once), whether or not a manifest lists them. With ``overwrite`` only the slices present in
    ``pages`` are replaced.
    """
    if not overwrite:
        there = landed_slices(pages.sparkSession, lake_root)
        pages = join_small(pages, there, ["source", "snapshot_date"], "left_anti")
    out = pages.select(F.col("source").alias("dex"), F.col("snapshot_date").alias("date"), "page_no", "body")
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # page bodies are JSON in JSON and repeat their field names: gzip leaves a
    # tenth of them, and any reader of the folder still takes them as they are
    w = out.repartitionByRange(n, "dex", "date", "page_no").sortWithinPartitions("dex", "date", "page_no").write.option("compression", "gzip")
    if overwrite:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dex", "date").json(f"{lake_root}/{POOLS_DIR}")
    else:
        w.mode("append").partitionBy("dex", "date").json(f"{lake_root}/{POOLS_DIR}")


def read_landed_pages(spark: SparkSession, lake_root: str) -> DataFrame:
    """Read landed pages back; partition columns become ``source``/``snapshot_date``,
    and each row keeps its file as ``source_file``."""
    schema = T.StructType([T.StructField("page_no", T.LongType()), T.StructField("body", T.StringType())])
    df = spark.read.schema(schema).option("basePath", f"{lake_root}/{POOLS_DIR}").json(f"{lake_root}/{POOLS_DIR}")
    return df.select(
        F.col("dex").alias("source"),
        F.col("date").cast("date").alias("snapshot_date"),
        "page_no",
        "body",
        F.col("_metadata.file_path").alias("source_file"),
    )


def land_market_documents(docs: DataFrame, lake_root: str, overwrite: bool = False) -> None:
    """Land market documents, one file for each, under date= folders. Without
    ``overwrite``, dates that the lake already holds are left as they are."""
    if not overwrite:
        there = landed_slices(docs.sparkSession, lake_root).filter(F.col("source") == MARKET_FILE_PREFIX).select("snapshot_date")
        docs = join_small(docs, there, ["snapshot_date"], "left_anti")
    out = docs.select(F.col("snapshot_date").alias("date"), F.col("body").alias("value"))
    w = out.write.option("maxRecordsPerFile", 1).partitionBy("date")
    if overwrite:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(f"{lake_root}/{MARKET_DIR}")
    else:
        w.mode("append").text(f"{lake_root}/{MARKET_DIR}")


# One JSON object: text other than quotes and closing braces, strings, and
# closing braces that no new object and no end follows; then the one that ends
# it. Inside valid JSON a comma or bracket stands between two objects, so a
# brace that closes right before one that opens is where a document ends.
# Possessive throughout: linear, without a stack.
_DOCUMENT = r'(?s)(?:[^"}]++|"(?:[^"\\]++|\\.)*+"|\}(?!\s*+(?:\{|\z)))*+\}'


def json_documents(text: Column) -> Column:
    """The JSON objects that follow each other in a text, as an array of texts,
    on one line or several. A blank text is one blank document; a text that
    ends within an object, or has anything besides objects, fails the job."""
    body = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n\ufeff"))
    parts = F.regexp_extract_all(body, F.lit(_DOCUMENT), F.lit(0))
    covered = F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p)) == F.length(body)
    cut = F.raise_error(F.lit("market file is cut, or holds text besides documents")).cast("array<string>")
    return F.when(body == "", F.array(body)).when(covered, parts).otherwise(cut)


def read_market_documents(spark: SparkSession, lake_root: str, snapshot_at: Column | None = None) -> DataFrame:
    """S2 for the market feed: a row for each document of each file (a file may
    hold several, one after the other). ``snapshot_at`` is the run's stamp when
    given, else the current time."""
    # declared schema (the text plus the date partition): an empty landing
    # reads as an empty frame instead of failing partition discovery
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("date", T.StringType())])
    df = spark.read.schema(schema).option("basePath", f"{lake_root}/{MARKET_DIR}").text(f"{lake_root}/{MARKET_DIR}", wholetext=True)
    return df.select(
        (snapshot_at if snapshot_at is not None else F.current_timestamp()).alias("snapshot_at"),
        F.col("date").cast("date").alias("snapshot_date"),
        F.col("_metadata.file_path").alias("source_file"),
        F.explode(json_documents(F.col("value"))).alias("body"),
    )


def page_record_count(source: Column, body: Column) -> Column:
    """Pool records in one landed page body (Raydium nests them one level deeper)."""
    raydium = F.json_array_length(F.get_json_object(body, "$.data.data"))
    others = F.json_array_length(F.get_json_object(body, "$.data"))
    return F.when(source == "raydium", raydium).otherwise(others)


# ---------------------------------------------------------------------------
# Manifest: a log of landings and drops
# ---------------------------------------------------------------------------

MANIFEST = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("pages", T.LongType()),
        T.StructField("raw_record_count", T.LongType()),
        T.StructField("snapshot_at", T.TimestampType()),
        T.StructField("event", T.StringType()),  # landed or dropped; null (older manifests): landed
        T.StructField("recorded_at", T.TimestampType()),  # null: when it landed
    ]
)
SLICE_COLS = ["source", "snapshot_date"]


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The log as written; an absent one is empty."""
    if not has_rows_on_disk(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(path)


def log_manifest(rows: DataFrame, path: str, event: str, recorded_at: Column | None = None) -> None:
    """Append records; nothing in the log is changed."""
    at = recorded_at if recorded_at is not None else F.current_timestamp()
    rows = rows.withColumns({"event": F.lit(event), "recorded_at": at.cast("timestamp")})
    have = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in MANIFEST.fields}
    rows.select(*[have[f.name].cast(f.dataType).alias(f.name) for f in MANIFEST.fields]).write.mode("append").parquet(path)


def manifest_current(log: DataFrame) -> DataFrame:
    """The newest record of each slice, slices that were dropped left out. One
    partial aggregate: a slice landed many times is one row a task."""
    rest = [f.name for f in MANIFEST.fields if f.name not in SLICE_COLS]
    at = F.coalesce("recorded_at", "snapshot_at")
    newest = F.max_by(F.struct(*rest), F.struct(at, "snapshot_at", F.coalesce("event", F.lit("landed"))))
    live = log.groupBy(*SLICE_COLS).agg(newest.alias("_n")).filter(F.coalesce("_n.event", F.lit("landed")) == "landed")
    return live.select(*SLICE_COLS, *[F.col(f"_n.{c}").alias(c) for c in rest])


def missing_slices(requested: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("source", "snapshot_date"), max_bytes: int = DEFAULT.broadcast_max_bytes) -> DataFrame:
    """Requested slices that are not landed yet (anti join on the small manifest)."""
    return join_small(requested, manifest.select(*keys).distinct(), list(keys), "left_anti", max_bytes=max_bytes)


# ---------------------------------------------------------------------------
# Raw tables
# ---------------------------------------------------------------------------


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared schema (column order, types)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def enforce_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the job on a NULL in a REQUIRED field, in the same pass as the
    write (a failed write job publishes nothing)."""
    req = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not req:
        return df
    ok = F.lit(True)
    for c in req:
        ok = ok & F.col(c).isNotNull()
    return df.filter(F.assert_true(ok, F.lit(f"NULL in a required field of {','.join(req)}")).isNull())


def clustered(df: DataFrame, partitions: Sequence[str], cluster: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Lay rows out by (partition, cluster) ranges so each file holds a
    sorted run (parquet min/max skipping); a hot slice spans several tasks.

    The writer count is explicit (``spark.sql.shuffle.partitions`` by
    default) so AQE does not fold a many-slice write into one task."""
    keys = [*partitions, *cluster]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def ensure_table(spark: SparkSession, table_path: str, schema: T.StructType, partition_col: str = PARTITION_COL) -> bool:
    """Create an empty DAY-partitioned table with ``schema`` if absent.
    Returns True when it was created (safe to call on every run)."""
    if path_exists(spark, table_path):
        return False
    # an empty partitioned write leaves no data file to carry the schema:
    # create the folder; readers pass the declared schema (read_table)
    p, fs = _fs(spark, table_path)
    fs.mkdirs(p)
    return True


def read_table(spark: SparkSession, table_path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a raw table; with ``schema`` an empty (just created) table reads as empty."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(table_path)


def is_partitioned_by(spark: SparkSession, table_path: str, col: str) -> bool:
    """Whether the table's folder holds partition folders of ``col``."""
    p, fs = _fs(spark, table_path)
    return any(st.isDirectory() and st.getPath().getName().startswith(f"{col}=") for st in fs.listStatus(p))


def has_rows_on_disk(spark: SparkSession, table_path: str) -> bool:
    """The table folder exists and holds at least one data file."""
    if not path_exists(spark, table_path):
        return False
    p, fs = _fs(spark, table_path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def day_signatures(spark: SparkSession, table_path: str, partition_col: str = PARTITION_COL) -> DataFrame:
    """(snapshot_date, n_files, signature): which data files each day of a
    DAY-partitioned table has, by name, length and time. A listing done by
    tasks; no file is opened."""
    if not has_rows_on_disk(spark, table_path):
        return spark.createDataFrame([], f"{partition_col} date, n_files long, signature decimal(38,0)")
    files = spark.read.format("binaryFile").option("basePath", table_path).load(table_path)
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    found = files.groupBy(F.col(partition_col).cast("date").alias(partition_col))
    return found.agg(F.count(F.lit(1)).alias("n_files"), F.sum(one).cast("decimal(38,0)").alias("signature"))


def load_slices(
    rows: DataFrame,
    table_path: str,
    overwrite: bool = False,
    slice_keys: Sequence[str] = SLICE_KEYS,
    partition_col: str = PARTITION_COL,
    cluster: Sequence[str] = ("dex_name", "pool_address"),
    schema: T.StructType | None = None,
    cfg: Config = DEFAULT,
    stored: bool = False,
) -> dict[str, int]:
    """S11 for every (date, venue) slice in ``rows``.

    - slice present, no overwrite: skipped (its rows are not written);
    - slice present, overwrite: replaced. The table is DAY-partitioned, so
      the affected date partitions are rewritten with the other venues'
      existing rows kept; dynamic partition overwrite swaps each date folder
      when the job commits (the old data stays readable until then);
    - slice absent: appended.

    Only the date partitions named by ``rows`` are read (partition pruning).
    ``stored``: the rows are a projection of stored files other than the
    table's, cheap to read again, and aren't written once more in between.
    Returns ``{"rows_loaded", "slices_skipped"}`` (R5), counted with an
    Observation during the write.
    """
    spark = rows.sparkSession
    if schema is not None:
        rows = enforce_required(conform(rows, schema), schema)
    # read for the slice keys, the range sample and the write: computed once
    rows = rows if stored else materialize(rows)
    keys = list(slice_keys)
    skipped = 0
    keep: DataFrame | None = None
    if has_rows_on_disk(spark, table_path):
        incoming, small = bounded_broadcast(rows.select(*keys).distinct(), cfg.broadcast_max_bytes)
        table = spark.read.parquet(table_path)
        dates = incoming.select(partition_col).distinct()
        # the dates are no more than the slices just counted: broadcast them,
        # so only the named date partitions are read (no shuffle of the table)
        affected = table.join(F.broadcast(dates) if small else dates, partition_col, "left_semi")
        if not overwrite:
            # read from the table once, for the count and for the rows
            present, _ = bounded_broadcast(affected.select(*keys).distinct(), cfg.broadcast_max_bytes)
            skipped = incoming.join(present, keys, "left_semi").count()
            if skipped:
                rows = rows.join(present, keys, "left_anti").select(*rows.columns)
        else:
            # rows of the affected dates that belong to other slices; written
            # out first because the job then overwrites the folders it read
            keep = materialize(affected.join(incoming, keys, "left_anti").select(*rows.columns))
    cl = [c for c in cluster if c in rows.columns]
    obs = Observation("load")
    # observed above the range exchange: the boundary-sampling job does not count
    laid_out = clustered(rows, [partition_col], cl).observe(obs, F.count(F.lit(1)).alias("rows_loaded"))
    if keep is not None:
        laid_out = laid_out.unionByName(clustered(keep, [partition_col], cl))
    writer = laid_out.write.partitionBy(partition_col)
    if overwrite:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(table_path)
    else:
        writer.mode("append").parquet(table_path)
    try:
        loaded = int(obs.get.get("rows_loaded", 0) or 0)
    except Exception:  # noqa: BLE001 - an empty write may report no metrics
        loaded = 0
    return {"rows_loaded": loaded, "slices_skipped": int(skipped)}


def slice_exists(spark: SparkSession, table_path: str, snapshot_date: dt.date, dex_name: str | None = None) -> bool:
    """Does the table hold rows for (date[, venue])? Partition-pruned probe."""
    if not has_rows_on_disk(spark, table_path):
        return False
    df = spark.read.parquet(table_path).filter(F.col(PARTITION_COL) == F.lit(snapshot_date))
    if dex_name is not None:
        df = df.filter(F.col("dex_name") == dex_name)
    return len(df.limit(1).collect()) > 0


def delete_slice(spark: SparkSession, table_path: str, snapshot_date: dt.date, dex_name: str | None = None) -> int:
    """Remove a slice; returns the rows it held.

    A whole date is dropped with its folder. A (date, venue) slice is removed
    by rewriting that date's folder without the venue (dynamic overwrite),
    or dropping the folder when nothing else remains."""
    if not has_rows_on_disk(spark, table_path):
        return 0
    day = spark.read.parquet(table_path).filter(F.col(PARTITION_COL) == F.lit(snapshot_date))
    gone = day if dex_name is None else day.filter(F.col("dex_name") == dex_name)
    n = gone.count()
    folder = f"{table_path}/{PARTITION_COL}={snapshot_date.isoformat()}"
    if n == 0:
        return 0
    rest = None if dex_name is None else materialize(day.filter(~F.col("dex_name").eqNullSafe(F.lit(dex_name))))
    if rest is None or rest.count() == 0:
        delete_path(spark, folder)
    else:
        rest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(table_path)
    return n


# ---------------------------------------------------------------------------
# Retention
# ---------------------------------------------------------------------------


def expired_slices(manifest: DataFrame, as_of: Column, retention_days: int = DEFAULT.retention_days) -> DataFrame:
    """Slices whose age at ``as_of`` has reached the retention (age >= days).
    A slice ages from the run that landed it (``snapshot_at``); a manifest
    without that column falls back on the day after the snapshot date."""
    created = F.to_date("snapshot_at") if "snapshot_at" in manifest.columns else F.date_add("snapshot_date", 1)
    return manifest.filter(created <= F.date_sub(F.to_date(as_of), retention_days))


def slice_folder(lake_root: Column) -> Column:
    """The folder of a slice (source, snapshot_date) in the lake."""
    day = F.concat(F.lit("/date="), F.col("snapshot_date").cast("string"))
    pools = F.concat(lake_root, F.lit(f"/{POOLS_DIR}/dex="), F.col("source"), day)
    return F.when(F.col("source") == MARKET_FILE_PREFIX, F.concat(lake_root, F.lit(f"/{MARKET_DIR}"), day)).otherwise(pools)


def _delete_folders(batches):
    """Deletes the folders of a batch where this store's client is at hand. A
    folder that isn't there counts as deleted, so a task may run twice."""
    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        done = []
        for uri in batch.column(0).to_pylist():
            try:
                store, path = fs.FileSystem.from_uri(uri)
                if store.get_file_info(path).type != fs.FileType.NotFound:
                    store.delete_dir(path)
                done.append(True)
            except (pa.ArrowException, OSError, ValueError):
                done.append(False)
        yield pa.RecordBatch.from_pydict({"folder": batch.column(0), "deleted": pa.array(done, pa.bool_())})


def delete_folders(folders: DataFrame, tasks: int = 64) -> int:
    """Delete ``folders(folder)``, by tasks; what a task's file-system client
    can't reach is deleted through the session's. Returns how many."""
    spark = folders.sparkSession
    local = F.regexp_replace("folder", "^file:/+|^/", "file:///")
    asked = folders.select(local.alias("folder")).distinct()
    n = asked.count()
    if n:
        done = materialize(asked.repartition(min(tasks, n)).mapInArrow(_delete_folders, "folder string, deleted boolean"))
        for r in done.filter("NOT deleted").toLocalIterator():
            delete_path(spark, r["folder"])
    return n


# ---------------------------------------------------------------------------
# File-system helpers (Hadoop FS through the session, so any shared store works)
# ---------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.delete(p, True))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its store's scheme."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")
