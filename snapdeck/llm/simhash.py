"""SimHash near-duplicates by a binary-trie self-join (operator 9).

1. Each text becomes a 64-bit fingerprint of its word shingles.
2. Equal fingerprints are one node from then on, so copies never meet.
3. Two fingerprints within ``max_bits`` agree on at least one of
   ``max_bits + 1`` bit blocks. Fingerprints are dealt by (block, value), and
   a cell that holds too many of them is split into parts that meet in pairs.
4. In each cell the fingerprints form a binary trie (a sorted array; a node is
   a range). Node pairs are walked together from the roots. A pair carries the
   bits in which its paths differ and is dropped once that is over the budget,
   or once all that lies below is known to be in one component.
5. A cell returns, for each fingerprint that it linked, one link to the first
   of its component in the cell. Contraction over those links gives the
   components.

Links are complete: two documents are in one component exactly if a chain of
fingerprints with at most ``max_bits`` differing bits joins them.

Defined results: a null or empty text, or one of white space, has fingerprint
zero and is linked like any other. Fewer words than a shingle: the whole
sequence is the one shingle. Repeated rows each get an output row (of
``keep_representatives``: one). A null id takes part; a component's id is its
smallest id that isn't null. Columns other
than the id and text columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.llm._common import fits_broadcast, importable, map_rows, stage

SEED = 42
#: Shingles whose bits are counted at once.
COUNT_AT_ONCE = 65_536
#: Most fingerprints of one part of a cell; beyond it the cell is split.
CELL_ROWS = 8_192
#: Rows that a task joins at once (many small cells together).
JOIN_ROWS = 60_000
#: Node pairs that are expanded at once.
PAIRS_AT_ONCE = 100_000
#: Bytes up to which a table of labels is broadcast.
BROADCAST_BYTES = 64 << 20


# -- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as an unsigned number."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes: ASCII only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    counts, m = np.zeros(64, np.int64), n - shingle + 1
    for at in range(0, m, COUNT_AT_ONCE):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + COUNT_AT_ONCE], stops[at : at + COUNT_AT_ONCE])]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > m, bitorder="little")
    return int(set_bits.view("<u8")[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprinter(shingle: int):
    return lambda key, text: ((key, _signed(fingerprint(text, shingle))),)


def fingerprints(df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): every row's fingerprint as a signed long."""
    schema = T.StructType([df.schema[id_col], T.StructField("fp", T.LongType())])
    return map_rows(df, [id_col, text_col], schema, partial(_fingerprinter, shingle))


# -- the join inside a cell -------------------------------------------------


class _Labels:
    """Components over positions 0..n-1; a label is the smallest position."""

    def __init__(self, n: int):
        self.of = np.arange(n, dtype=np.int32)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.of[a], self.of[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.of, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.of[self.of]
                if np.array_equal(up, self.of):
                    break
                self.of = up


def join_cells(cell: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For rows sorted by (cell, fp), with fp unsigned and distinct in a cell:
    the position of the first row of each row's component within its cell."""
    n = len(fps)
    labels = _Labels(n)
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]).astype(np.int32)
    stops = np.r_[starts[1:], n].astype(np.int32)
    roots = stops - starts > 1
    a0, a1 = starts[roots], stops[roots]
    # a frontier: depth, and node pairs (two ranges and the bits that differ so far)
    todo = [(0, a0, a1, a0, a1, np.zeros(len(a0), np.int8))]
    ones_before: dict[int, np.ndarray] = {}
    while todo:
        depth, a0, a1, b0, b1, bits = todo.pop()
        if len(a0) > PAIRS_AT_ONCE:
            half = len(a0) // 2
            todo.append((depth, a0[half:], a1[half:], b0[half:], b1[half:], bits[half:]))
            a0, a1, b0, b1, bits = a0[:half], a1[:half], b0[:half], b1[:half], bits[:half]
            todo.append((depth, a0, a1, b0, b1, bits))
            continue
        # drop what lies in one component already
        changes = np.cumsum(np.r_[False, labels.of[1:] != labels.of[:-1]])
        known = (changes[a0] == changes[a1 - 1]) & (changes[b0] == changes[b1 - 1]) & (labels.of[a0] == labels.of[b0])
        # two single fingerprints: their last bits at once
        single = ~known & (a1 - a0 == 1) & (b1 - b0 == 1)
        x, y = a0[single], b0[single]
        near = np.bitwise_count(fps[x] ^ fps[y]) <= max_bits
        labels.link(x[near], y[near])
        on = ~known & ~single
        if depth == 64 or not on.any():
            continue
        a0, a1, b0, b1, bits = a0[on], a1[on], b0[on], b1[on], bits[on]
        if depth not in ones_before:
            bit = (fps >> np.uint64(63 - depth)) & np.uint64(1)
            ones_before[depth] = np.r_[0, np.cumsum(bit)].astype(np.int32)
        ones = ones_before[depth]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = (a0 == b0) & (a1 == b1)
        step = [
            (a0, am, b0, bm, bits, None),
            (am, a1, bm, b1, bits, None),
            (a0, am, bm, b1, bits + 1, None),
            (am, a1, b0, bm, bits + 1, ~same),  # of a node with itself: the same as the one before
        ]
        parts = []
        for p0, p1, q0, q1, d, only in step:
            ok = (p1 > p0) & (q1 > q0) & (d <= max_bits)
            ok &= ~((p0 == q0) & (p1 == q1) & (p1 - p0 == 1))  # one fingerprint with itself
            if only is not None:
                ok &= only
            parts.append((p0[ok], p1[ok], q0[ok], q1[ok], d[ok].astype(np.int8)))
        todo.append((depth + 1, *(np.concatenate(c) for c in zip(*parts))))
    return labels.of


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _join_partition(max_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, fp) of whole cells, sorted by both, to links (a, b)."""

    def links(cell: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        first = join_cells(cell, fps.view(np.uint64), max_bits)
        linked = np.flatnonzero(first != np.arange(len(first)))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[first[linked]])], schema=_LINKS)

    cell, fps = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        cell = np.r_[cell, batch.column(0).to_numpy(zero_copy_only=False)]
        fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False)]
        if len(cell) >= JOIN_ROWS and cell[0] != cell[-1]:
            whole = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            yield links(cell[:whole], fps[:whole])
            cell, fps = cell[whole:], fps[whole:]
    if len(cell):
        yield links(cell, fps)


# -- Spark ------------------------------------------------------------------


def near_links(nodes: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes(fp)`` that span all
    components of the graph of pairs within ``max_bits``."""
    blocks = max_bits + 1
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    values = [
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned(F.shiftleft(F.col("fp"), lo), 64 - (hi - lo)).alias("value"),
        )
        for k, (lo, hi) in enumerate(zip(edges, edges[1:]))
    ]
    dealt = nodes.select("fp", F.explode(F.array(*values)).alias("at")).select("fp", "at.block", "at.value")
    # cells with more rows than one part takes, and the number of their parts
    large = stage(
        dealt.groupBy("block", "value")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > cell_rows)
        .select("block", "value", F.ceil(F.col("n") / cell_rows).cast("int").alias("parts")),
        "simhash-large-cells",
    )
    if fits_broadcast(large, BROADCAST_BYTES):
        large = F.broadcast(large)
    split = (
        dealt.join(large, ["block", "value"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        # part p meets every part q once, in the cell (min, max)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.xxhash64("block", "value", F.least("part", "other"), F.greatest("part", "other")).alias("cell"),
            "fp",
        )
    )
    # sorted as unsigned numbers: the sign bit turned over
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    ordered = split.repartition("cell").sortWithinPartitions("cell", unsigned)
    return importable(ordered).mapInArrow(partial(_join_partition, max_bits), "a long, b long")


def _joined(big: DataFrame, small: DataFrame, on: str, how: str = "inner") -> DataFrame:
    return big.join(F.broadcast(small) if fits_broadcast(small, BROADCAST_BYTES) else small, on, how)


def components(links: DataFrame) -> DataFrame:
    """(fp, root) for every fingerprint in ``links(a, b)``, by contraction.

    Each round maps every node to its smallest neighbour (or itself) and keeps
    the links between different images. Nodes without a link left are done. A
    round at least halves the nodes of each component; every table is written
    to the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    live = stage(both.filter("a <> b").distinct(), "simhash-links")
    roots = stage(live.select(F.col("a").alias("fp"), F.col("a").alias("root")).distinct(), "simhash-roots")
    while not live.isEmpty():
        up = stage(live.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "simhash-up")
        left = _joined(live, up, "a").select(F.col("up").alias("x"), F.col("b").alias("a"))
        live = _joined(left, up, "a").select(F.col("x").alias("a"), F.col("up").alias("b"))
        live = stage(live.filter("a <> b").distinct(), "simhash-links")
        moved = _joined(roots.select("fp", F.col("root").alias("a")), up, "a", "left")
        roots = stage(moved.select("fp", F.coalesce("up", "a").alias("root")), "simhash-roots")
    return roots


def _grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``fps(id, fp)``."""
    nodes = stage(fps.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-nodes")
    roots = components(near_links(nodes.select("fp"), max_bits))
    linked = stage(_joined(nodes, roots, "fp"), "simhash-linked")  # of linked fingerprints only
    least = stage(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-least")
    moved = _joined(linked, least, "root").select("fp", "root", "component_id")
    return nodes.join(moved, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least_id").alias("component_id")
    )


def near_duplicates(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) for every row."""
    fps = stage(fingerprints(df, shingle, id_col, text_col).withColumnRenamed(id_col, "id"), "simhash-fingerprints")
    of_node = stage(_grouped(fps, max_bits).select("fp", "component_id"), "simhash-components")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _joined(fps, of_node, "fp").select(F.col("id").alias(id_col), hexed, "component_id")


def keep_representatives(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component: the one with its smallest id, null ids last.

    Rows are told apart by id and text, not by id: rows that share an id, or
    have none, go only with those whose text is near. Of rows that have both
    in common one stays, whichever their other columns are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    content = df.select(
        F.struct(
            F.col(id_col).isNull().alias("without"),
            F.col(id_col).alias("id"),
            F.xxhash64(text).alias("t1"),
            F.xxhash64(F.lit(1), text).alias("t2"),
        ).alias("id"),
        F.col(text_col).alias("text"),
    )
    fps = stage(fingerprints(content, shingle, "id", "text"), "simhash-fingerprints")
    roots = stage(_grouped(fps, max_bits).select("fp", "root"), "simhash-components")
    rows = _joined(fps, roots, "fp").groupBy("root", "id").agg(F.count("*").alias("n"))
    win = rows.groupBy("root").agg(F.min(F.struct("id", "n")).alias("w")).select("w.id.id", "w.id.t1", "w.id.t2", "w.n")
    names = {"id": "__w_id", "t1": "__w_t1", "t2": "__w_t2"}
    win = stage(win.withColumnsRenamed(names | {"n": "__w_n"}), "simhash-kept")
    side = F.broadcast(win) if fits_broadcast(win, BROADCAST_BYTES) else win
    here = F.coalesce(df[text_col], F.lit(""))
    met = df.join(
        side,
        df[id_col].eqNullSafe(side["__w_id"])
        & (F.xxhash64(here) == side["__w_t1"])
        & (F.xxhash64(F.lit(1), here) == side["__w_t2"]),
    )
    own = [df[c] for c in df.columns]
    once = met.filter(F.col("__w_n") == 1).select(*own)
    if win.filter("__w_n > 1").isEmpty():
        return once
    return once.unionByName(met.filter(F.col("__w_n") > 1).dropDuplicates(list(names.values())).select(*own))
