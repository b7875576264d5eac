"""Spelling variants by a dictionary of trie-node pairs (operator 12).

1. Words are counted over all texts: each task counts in a table of bounded
   size, then counts are added in a shuffle.
2. Trie nodes. The words are sorted, and the nodes of their trie are numbered
   as they first occur in that order: a word shares the nodes of what it has in
   common with the word before it, and the rest are new. Each sorted partition
   numbers its own nodes; one row a partition (its first and last word) then
   tells which nodes it shares with the partitions before it, and where its
   numbers begin. The same over the reversed words numbers their ends.
3. Pairs. A word w with position i left out is the pair (node of w[:i], node of
   reversed w[i+1:]); with nothing left out, (node of w[:i], node of reversed
   w[i:]). Two words differ by one replaced code point exactly if they have a
   pair with the same position left out in common, and by an inserted or
   deleted one exactly if a pair of the shorter with nothing left out is one of
   the longer. In a run of equal letters only the first is left out for that,
   so a pair of words meets once.
4. All words under one node pair differ in one letter, so there are at most as
   many as the alphabet has, plus one. They are read sorted, group by group.

Counts of near words and the best one are added up per word. A form has at
least ``ratio`` times the occurrences, so chains of forms are short: pointer
doubling ends after a few joins.

Defined results: null and empty texts have no words. Repeated rows count each.
A null id stands as an empty string before the colon. A table without words
gives no rows. Ties: the smallest word in code-point order. Words of any
length are taken whole; a word's numbers are linear in its length. Columns
other than the id and text columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.llm._common import importable, join_measured, stage

#: Words: after A-Z became a-z.
WORD = re.compile("[a-zÀ-ÿ]+")
#: Words that a task counts before it hands on its counts.
COUNT_AT_ONCE = 200_000
#: Words of a sorted partition.
PART_WORDS = 65_536
#: Nodes of an output batch.
NODES_AT_ONCE = 65_536

Alter = Callable[[object], Callable[[str], str]]


# -- counting ---------------------------------------------------------------


def crc_deletion(ident) -> Callable[[str], str]:
    """For a document: takes one code point out of some of its words, chosen by
    the crc32 of ``<id>:<word>``."""
    start = zlib.crc32(b"%s:" % ("" if ident is None else str(ident)).encode())

    def alter(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        if h % 31:
            return word
        k = h % len(word)
        return word[:k] + word[k + 1 :]

    return alter


def _count(alter: Alter | None, min_length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
        total.clear()
        return out

    for batch in batches:
        for ident, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = (raw.as_py() or b"").lower().decode()  # of bytes: ASCII only
            change = alter(ident) if alter else None
            for word, n in Counter(WORD.findall(text)).items():
                if len(word) >= min_length:
                    if change is not None:
                        word = change(word)
                        if len(word) < min_length:
                            continue
                    total[word] += n
            if len(total) >= COUNT_AT_ONCE:
                yield flush()
    if total:
        yield flush()


def count_words(
    df: DataFrame,
    alter: Alter | None = None,
    min_length: int = 7,
    min_count: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points (after
    ``alter``) with at least ``min_count`` occurrences in all texts."""
    docs = importable(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    counted = docs.mapInArrow(partial(_count, alter, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# -- numbering trie nodes ---------------------------------------------------

_NUMBERED = pa.schema([("part", pa.int32()), ("key", pa.string()), ("nodes", pa.list_(pa.int64()))])


def common_prefix(a: str, b: str) -> int:
    """How many code points two words have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct keys of a partition, each with its nodes from the root
    (0) on, numbered from 1 as they first occur in the partition."""
    part, before, nodes, made = TaskContext.get().partitionId(), "", [0], 0
    keys, listed, held = [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(keys), pa.int32()), pa.array(keys, pa.string()), pa.array(listed, _NUMBERED.field(2).type)],
            schema=_NUMBERED,
        )

    for batch in batches:
        for key in batch.column(0).to_pylist():
            shared = common_prefix(before, key)
            new = len(key) - shared
            nodes = nodes[: shared + 1] + list(range(made + 1, made + new + 1))
            made, before = made + new, key
            keys.append(key)
            listed.append(nodes)
            held += len(nodes)
            if held >= NODES_AT_ONCE:
                yield flush()
                keys, listed, held = [], [], 0
    if keys:
        yield flush()


def number_nodes(keys: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """(key, nodes) for distinct ``keys(key)``: the numbers of the trie nodes of
    each prefix, from the empty one (0) to the whole key. A later key in
    code-point order has a larger last number."""
    parts = max(1, -(-keys.count() // part_words))
    laid = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    local = stage(importable(laid).mapInArrow(_number, "part int, key string, nodes array<long>"), "spelling-nodes")
    ends = (
        local.groupBy("part")
        .agg(F.min("key").alias("first"), F.max(F.struct("key", "nodes")).alias("last"))
        .orderBy("part")
        .collect()
    )  # one row a partition, that is, for 65,536 words
    base, before, carried, offsets = 0, "", [0], []
    for r in ends:
        shared = carried[: common_prefix(before, r["first"]) + 1]
        offsets.append((r["part"], base, shared))
        # the partition's first key made nodes 1, 2, ... for its own prefixes
        carried = [shared[n] if n < len(shared) else base + n for n in r["last"]["nodes"]]
        base, before = base + r["last"]["nodes"][-1], r["last"]["key"]
    table = keys.sparkSession.createDataFrame(offsets, "part int, base long, shared array<long>")
    moved = F.transform(
        "nodes",
        lambda n: F.when(n < F.size("shared"), F.get("shared", n.cast("int"))).otherwise(F.col("base") + n),
    )
    return local.join(F.broadcast(table), "part").select("key", moved.alias("nodes"))


# -- pairs ------------------------------------------------------------------

FULL, SKIP, FIRST_SKIP = 0, 1, 2  # nothing left out; one left out; and the first of its run


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, id, n) of ``words(word, n, id, heads, tails)``."""
    size = F.size("heads") - 1
    letters = F.split("word", "")
    skip = lambda i: F.struct(
        F.get("heads", i).alias("p"),
        F.get("tails", size - i - 1).alias("s"),
        F.when((i > 0) & (F.get(letters, i) == F.get(letters, i - 1)), SKIP).otherwise(FIRST_SKIP).alias("kind"),
    )
    full = lambda i: F.struct(F.get("heads", i).alias("p"), F.get("tails", size - i).alias("s"), F.lit(FULL).alias("kind"))
    pairs = F.concat(
        F.transform(F.sequence(F.lit(0), size - 1), skip), F.transform(F.sequence(F.lit(0), size), full)
    )
    return words.select(F.explode(pairs).alias("pair"), "id", "n").select("pair.p", "pair.s", "pair.kind", "id", "n")


_NEAR = pa.schema([("id", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best_id", pa.int64())])


def _near_of_group(kind: list, ids: list, ns: list, out: list[tuple]) -> None:
    """The words of one node pair (at most the alphabet's size plus one): adds
    (id, near words, the best one's n and id) for each that has any."""
    # most frequent first, of equal ones the smallest
    order = sorted(range(len(ids)), key=lambda i: (-ns[i], ids[i]))
    for i in order:
        mine = kind[i]
        near = [j for j in order if j != i and (mine != FULL or kind[j] == FIRST_SKIP) and (kind[j] != FULL or mine == FIRST_SKIP)]
        if near:
            out.append((ids[i], len(near), ns[near[0]], ids[near[0]]))


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (p, s, kind, id, n) of whole groups, sorted by (p, s), to partial
    results per word."""

    def results(p, s, kind, ids, ns):
        edges = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (s[1:] != s[:-1]), True])
        out: list[tuple] = []
        for a, b in zip(edges[:-1][np.diff(edges) > 1].tolist(), edges[1:][np.diff(edges) > 1].tolist()):
            _near_of_group(kind[a:b].tolist(), ids[a:b].tolist(), ns[a:b].tolist(), out)
        columns = zip(*out) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_NEAR)

    held = [np.empty(0, np.int64)] * 5
    for batch in batches:
        held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
        p, s = held[:2]
        open_ = np.flatnonzero((p != p[-1]) | (s != s[-1])) if len(p) else []
        if len(open_):  # the last group may go on
            whole = int(open_[-1]) + 1
            yield results(*(h[:whole] for h in held))
            held = [h[whole:] for h in held]
    if len(held[0]):
        yield results(*held)


def group_variants(vocabulary: DataFrame, ratio: int = 10, part_words: int = PART_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct ``vocabulary(word, n)``."""
    counts = stage(vocabulary.select("word", "n"), "spelling-vocabulary")
    heads = number_nodes(counts.select(F.col("word").alias("key")), part_words)
    tails = number_nodes(counts.select(F.reverse("word").alias("key")), part_words)
    words = (
        counts.join(heads.select(F.col("key").alias("word"), F.col("nodes").alias("heads")), "word")
        .join(tails.select(F.reverse("key").alias("word"), F.col("nodes").alias("tails")), "word")
        .withColumn("id", F.element_at("heads", -1))  # in the order of the words
    )
    words = stage(words, "spelling-words")
    laid = node_pairs(words).repartition("p", "s").sortWithinPartitions("p", "s")
    partial_ = importable(laid).mapInArrow(_near, T._parse_datatype_string("id long, n_near long, best_n long, best_id long"))
    near = partial_.groupBy("id").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best_id")).alias("best")
    )
    near = near.select("id", "n_near", (-F.col("best.less")).alias("best_n"), "best.best_id")
    names = words.select("id", "word", "n")
    joined = stage(names.join(near, "id", "left"), "spelling-near")
    has_form = F.col("best_n") >= ratio * F.col("n")
    links = stage(joined.filter(has_form).select("id", F.col("best_id").alias("root")), "spelling-links")

    # each round doubles the steps taken; a step multiplies the occurrences by ``ratio``
    roots = links
    while True:
        onward = stage(roots.select(F.col("id").alias("root"), F.col("root").alias("next")), "spelling-onward")
        ahead = stage(join_measured(roots, onward, ["root"], "left"), "spelling-ahead")
        moved = not ahead.filter("next IS NOT NULL").isEmpty()
        roots = ahead.select("id", F.coalesce("next", "root").alias("root"))
        if not moved:
            break
    out = joined.withColumn("form_id", F.when(has_form, F.col("best_id")))
    out = join_measured(out, stage(roots, "spelling-roots"), ["id"], "left")
    for of, name in (("form_id", "form"), ("root", "root_word")):
        used = stage(out.select(F.col(of).alias("id")).filter("id IS NOT NULL").distinct().join(names, "id").select(F.col("id").alias(of), F.col("word").alias(name)), "spelling-names")
        out = join_measured(out, used, [of], "left")
    return out.select(
        "word",
        "form",
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"),
    )
