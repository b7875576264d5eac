"""Substring deduplication by relative Lempel-Ziv parsing (operator 11).

Every document is parsed into factors: runs of words copied from a reference,
which are all documents with a smaller id. A factor of at least ``window``
words is a duplicate span, and its words go.

1. Reference blocks. Of the k-grams in a window of ``window`` words, the one
   with the smallest hash is its anchor. Neighbouring windows share anchors, so
   a document falls into blocks: an anchor, and all words of the windows that
   have it. Equal windows have equal anchors wherever they stand. So the anchor
   is the index under which every block lies that could hold a window, and a
   block meets all reference blocks that matter, not all that there are.
2. Whole blocks. Blocks of the same words are one reference block, told by
   128 bits (64 of the anchor's words, 64 of all), with the smallest document
   that has it. A block
   found in a smaller document is copied whole; that's where nearly all of a
   factor comes from, and hot passages cost one row a task.
3. Factor boundaries. A factor ends inside a block that differs from the other
   blocks of its anchor. There the windows are compared one by one, each with
   the smallest document that has it. Only the first document of each reference
   block takes part; the others copy from it whole. A window across the
   boundary of two factors is among those compared, so none is missed.
4. Parse. From left to right, a factor takes in the next window while its
   pointer leads on in the same reference, else the next factor begins.

Windows are judged on the input, not on what is left. All is linear in the
words: no document meets another one as a pair.

Defined results: a null or empty text, or one of white space, has no words.
Rows that share an id are one document: they don't copy from each other, nor
does a document from itself. A row with a null id counts as larger than all
others: it copies from rows with ids, nothing copies from it. Repeated rows
each get an output row. Texts shorter than a window stay whole. An empty table
gives no rows. Columns other than the id and text columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapdeck.llm._common import importable, join_measured, map_rows, stage

WINDOW = 50  # words of a window
K = 10  # words of an anchor
#: Windows whose hashes are worked on at once; blocks end there.
WINDOWS_AT_ONCE = 1 << 17
_POSITION = np.uint64(WINDOWS_AT_ONCE * 2 - 1)  # low bits that hold a place
#: Output rows of a batch.
BATCH_ROWS = 16_384

# Odd multipliers of the two lanes' polynomials (any odd numbers do).
_LANES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def split_words(raw: bytes | None) -> list[bytes]:
    """Runs of bytes other than x20 and x09-x0D."""
    return (raw or b"").split()


class _Powers:
    """Powers of a lane's multiplier and of its inverse, modulo 2^64."""

    def __init__(self, m: int):
        self.m, self.inverse, self.up, self.down = m, pow(m, -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.m), ("down", self.inverse)):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


class Rolling:
    """Hashes of any run of words in two lanes of 64 bits, from prefix sums of
    the words' own 128-bit hashes."""

    powers = tuple(_Powers(m) for m in _LANES)

    def __init__(self, words: list[bytes]):
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2)
        self.sums = []
        for lane, p in enumerate(self.powers):
            p.grow(len(words) + 1)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(digests[:, lane] * p.up[: len(words)], out=sums[1:])
            self.sums.append(sums)

    def of(self, lane: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        sums = self.sums[lane]
        return (sums[stops] - sums[starts]) * self.powers[lane].down[starts]


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a polynomial's value over all bits (its low bits are weak)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def _sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        a = np.minimum(a[: len(a) - step], a[step:])
        have += step
    return a


def blocks_of(words: list[bytes], window: int = WINDOW, k: int = K) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (start, n_windows, anchor, content), in pieces: the blocks of a text."""
    total = len(words) - window + 1
    for first in range(0, total, WINDOWS_AT_ONCE):
        n = min(WINDOWS_AT_ONCE, total - first)
        rolling = Rolling(words[first : first + n + window - 1])
        at = np.arange(n + window - k)
        grams = _mixed(rolling.of(0, at, at + k))
        # the smallest hash, of equal ones the leftmost: its place in the low bits
        least = _sliding_min((grams & ~_POSITION) | at.astype(np.uint64), window - k + 1)
        anchors = (least & _POSITION).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        counts = np.diff(np.r_[starts, n])
        stops = starts + counts + window - 1
        # the anchor's hash is of the first lane, the content's of the second
        yield starts + first, counts, grams[anchors[starts]], _mixed(rolling.of(1, starts, stops))


def windows_of(words: list[bytes], start: int, count: int, window: int = WINDOW) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (start, c1, c2): ``count`` windows from ``start``, in pieces."""
    for first in range(start, start + count, WINDOWS_AT_ONCE):
        n = min(WINDOWS_AT_ONCE, start + count - first)
        rolling, at = Rolling(words[first : first + n + window - 1]), np.arange(n)
        yield at + first, *(rolling.of(lane, at, at + window) for lane in (0, 1))


# -- documents to rows ------------------------------------------------------


class _Batches:
    """Collects arrays by column and yields Arrow batches of enough rows."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.ids, self.columns = schema, 0, [], []

    def add(self, ident, *arrays) -> Iterator[pa.RecordBatch]:
        """Adds rows: the id and single numbers stand in each of them."""
        n = len(arrays[-1])
        self.ids.extend([ident] * n)
        self.columns.append([np.full(n, a) if np.isscalar(a) else a for a in arrays])
        self.rows += n
        if self.rows >= BATCH_ROWS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            arrays = [np.concatenate(c) for c in zip(*self.columns)]
            typed = [
                pa.array(a.view(np.int64) if a.dtype == np.uint64 else a, type=f.type)
                for a, f in zip(arrays, list(self.schema)[1:])
            ]
            ids = pa.array(self.ids, type=self.schema.field(0).type)
            self.rows, self.ids, self.columns = 0, [], []
            yield pa.RecordBatch.from_arrays([ids, *typed], schema=self.schema)


def _emit_blocks(schema: pa.Schema, window: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(schema)
    for batch in batches:
        for row, raw in zip(zip(*(batch.column(c).to_pylist() for c in range(3))), batch.column(3)):
            words = split_words(raw.as_py())
            for found in blocks_of(words, window, k):
                yield from out.add(*row, *found)
    yield from out.flush()


def _emit_windows(schema: pa.Schema, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Batches(schema)
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
        for row, raw, spans in zip(keys, batch.column(3), batch.column(4)):
            words = split_words(raw.as_py())
            runs: list[list[int]] = []  # neighbouring blocks are hashed at once
            flat = spans.as_py()
            for start, count in zip(flat[::2], flat[1::2]):
                if runs and runs[-1][0] + runs[-1][1] == start:
                    runs[-1][1] += count
                else:
                    runs.append([start, count])
            for start, count in runs:
                for found in windows_of(words, start, count, window):
                    yield from out.add(*row, *found)
    yield from out.flush()


def parse(spans: list[dict], window: int = WINDOW) -> list[tuple]:
    """Copied windows (start, count, ref (id, start)) to factors (start,
    n_words, ref_id, ref_start), from left to right, as long as they lead on."""
    factors: list[list] = []
    for s in sorted({(s["start"], s["count"], s["ref"]["id"], s["ref"]["start"]) for s in spans}, key=lambda s: s[0]):
        start, count, ref, ref_start = s
        if factors:
            last = factors[-1]
            if last[2] == ref and last[0] + last[1] == start and last[3] - last[0] == ref_start - start:
                last[1] += count
                continue
        factors.append([start, count, ref, ref_start])
    return [(start, count + window - 1, ref, ref_start) for start, count, ref, ref_start in factors]


def covered(factors: list[tuple]) -> list[int]:
    """The words that factors cover, as merged start, end, start, end, ..."""
    out: list[int] = []
    for start, n, *_ in factors:
        if out and start <= out[-1]:
            out[-1] = max(out[-1], start + n)
        else:
            out += [start, start + n]
    return out


def _parsed(window: int, ident, t1: int, t2: int, spans: list[dict]) -> tuple[tuple]:
    names, factors = ("start", "n_words", "ref_id", "ref_start"), parse(spans, window)
    return ((ident, t1, t2, covered(factors), [dict(zip(names, f)) for f in factors]),)


def _cut(ident, raw: bytes, cuts: list[int] | None) -> tuple[tuple]:
    words, cuts = split_words(raw), cuts or []
    kept, at = [], 0
    for start, end in zip(cuts[::2], cuts[1::2]):
        kept.extend(words[at:start])
        at = end
    kept.extend(words[at:])
    return ((ident, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8"), cuts),)


def _cutter():
    return _cut


# -- Spark ------------------------------------------------------------------

#: What names a row's content: rows that have these in common have one result.
ROW = ["id", "t1", "t2"]


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t1, t2, raw): t1 and t2 are 128 bits of the text."""
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return df.select(F.col(id_col).alias("id"), raw.alias("raw")).select(
        "id", F.xxhash64("raw").alias("t1"), F.xxhash64(F.lit(1), "raw").alias("t2"), "raw"
    )


def _pointer() -> Column:
    """The smallest (id, start); null ids are no reference."""
    return F.min(F.when(F.col("id").isNotNull(), F.struct("id", "start"))).alias("ref")


def _smaller() -> Column:
    """Whether ``ref`` is a document that comes before ``id``."""
    return F.coalesce(F.col("ref.id") < F.col("id"), F.col("ref").isNotNull())


#: Bytes up to which an index is broadcast. Small: indexes grow with the texts,
#: and a plan that changes with the size can't be measured on less.
INDEX_BYTES = 4 << 20


def _joined(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    return join_measured(rows, index, keys, max_bytes=INDEX_BYTES)


def copied_windows(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(id, t1, t2, spans): for each row of ``_documents`` with windows that a
    smaller document has, these windows as runs (start, count, ref)."""
    kept = [f for f in docs.schema if f.name in ROW]
    of = lambda kind, *names: [T.StructField(n, kind) for n in names]
    schema = T.StructType([*kept, *of(T.IntegerType(), "start", "count"), *of(T.LongType(), "anchor", "content")])
    blocks = importable(docs).mapInArrow(partial(_emit_blocks, to_arrow_schema(schema), window, k), schema)
    blocks = stage(blocks, "relative-lz-blocks")

    # the index: under each anchor, the smallest document and whether the blocks differ
    index = blocks.groupBy("anchor").agg(
        _pointer(), F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")
    )
    index = index.filter("n > 1 AND ref IS NOT NULL").select("anchor", "ref", (F.col("least") != F.col("most")).alias("differ"))
    met = stage(_joined(blocks, stage(index, "relative-lz-index"), ["anchor"]), "relative-lz-met")
    copied = met.filter(~F.col("differ") & _smaller()).select(*ROW, "start", "count", "ref")

    # anchors with several reference blocks
    several = met.filter("differ").drop("ref", "differ")
    classes = stage(several.groupBy("anchor", "content").agg(_pointer()), "relative-lz-classes")
    several = stage(_joined(several, classes, ["anchor", "content"]), "relative-lz-several")
    copied = copied.unionByName(several.filter(_smaller()).select(*ROW, "start", "count", "ref"))

    # factor boundaries: the windows of each reference block's first document
    first = several.filter(~_smaller()).groupBy(*ROW).agg(F.array_sort(F.collect_set(F.struct("start", "count"))).alias("spans"))
    first = first.withColumn("spans", F.flatten(F.transform("spans", lambda s: F.array(s["start"], s["count"]))))
    texts = join_measured(docs, stage(first, "relative-lz-first"), ROW).select(*ROW, "raw", "spans")
    schema = T.StructType([*kept, *of(T.IntegerType(), "start"), *of(T.LongType(), "c1", "c2")])
    windows = importable(texts).mapInArrow(partial(_emit_windows, to_arrow_schema(schema), window), schema)
    windows = stage(windows, "relative-lz-windows")
    least = windows.groupBy("c1", "c2").agg(_pointer(), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = _joined(windows, stage(least, "relative-lz-least"), ["c1", "c2"]).filter(_smaller())
    copied = copied.unionByName(again.select(*ROW, "start", F.lit(1).alias("count"), "ref"))
    return copied.groupBy(*ROW).agg(F.collect_set(F.struct("start", "count", "ref")).alias("spans"))


def _parses(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(id, t1, t2, cuts, factors): the parse of each row that has a factor."""
    copied = copied_windows(docs, window, k)
    ident = copied.schema["id"].dataType
    factor = T.StructType(
        [T.StructField(n, ident if n == "ref_id" else T.IntegerType()) for n in ("start", "n_words", "ref_id", "ref_start")]
    )
    schema = T.StructType(
        [
            *[f for f in copied.schema if f.name in ROW],
            T.StructField("cuts", T.ArrayType(T.IntegerType())),
            T.StructField("factors", T.ArrayType(factor)),
        ]
    )
    return map_rows(copied, [*ROW, "spans"], schema, partial(partial, _parsed, window))


def factors(
    df: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, start, n_words, ref_id, ref_start): the factors of the documents, in
    words from 0. Rows of one id and text are given once."""
    parses = _parses(_documents(df, id_col, text_col), window, k)
    return parses.select(F.col("id").alias(id_col), F.inline("factors"))


def deduplicate(
    df: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept, cuts) for every row: ``kept`` are the
    words outside of factors, joined by spaces; ``cuts`` are the words that
    went, as start, end, start, end, ... from 0."""
    docs = _documents(df, id_col, text_col)
    cuts = stage(_parses(docs, window, k).select(*ROW, "cuts"), "relative-lz-cuts")
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
            T.StructField("cuts", T.ArrayType(T.IntegerType())),
        ]
    )
    return map_rows(join_measured(docs, cuts, ROW, "left"), ["id", "raw", "cuts"], schema, _cutter)
