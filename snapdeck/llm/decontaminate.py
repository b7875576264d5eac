"""Benchmark decontamination by winnowing (operator 5), in SQL functions only.

Both sides become sequences of word k-gram hashes. In every sliding window of
``window - k + 1`` of them the smallest is a fingerprint (on ties, each). Two
texts that share ``window`` consecutive words share all hashes of such a
window, hence a fingerprint at the same place of it. So a join on fingerprints
finds every shared span, and each hit is extended by comparing the windows
that contain it, ``window - k + 1`` offsets, on both sides.

An item shorter than a window is one window of its own length, for which no
fingerprint is sure; those few lengths are compared at every document
position, in the same pass.

A window is told by 128 bits of hashes of its words. Items that have the same
windows are told apart only after documents and windows have met: a window
stands for a class of items, and documents meet classes.

Defined results: null texts, empty ones and texts without words have no words
and no windows; such items occur nowhere. Repeated documents each get an
output row. Items that share an id count once. Null item ids are not counted.
With an empty benchmark nothing is contaminated. Columns other than the id and
text columns are not read by ``find``; ``drop_contaminated`` keeps all
columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdeck.llm._common import fits_broadcast, stage

# What parts words, after A-Z became a-z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

K = 5  # words of a k-gram
WINDOW = 10  # consecutive words that count as an occurrence
#: Bytes up to which the benchmark's fingerprints are broadcast.
BROADCAST_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    """Hashes of the n words from each position."""
    at = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)])
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(0), F.size(words) - n), at)).otherwise(
        F.array().cast("array<bigint>")
    )


def _with_fingerprints(df: DataFrame, k: int, window: int, lengths: list[int]) -> DataFrame:
    """Adds ``marks``: an array of (len, key, pos, at, around).

    Of a long window (len = ``window``): key is the fingerprint, pos its place,
    ``around`` the k-gram hashes near it, with the fingerprint at index ``at``.
    Of a short one: key and ``around`` are two hashes of its words from pos.
    """
    reach = window - k
    h = df.withColumn("grams", _grams(F.col("words"), k))
    low = lambda i: F.least(*[F.get("grams", i + j) for j in range(reach + 1)])
    n_windows = F.size("grams") - reach
    h = h.withColumn(
        "lows",
        F.when(n_windows >= 1, F.transform(F.sequence(F.lit(0), n_windows - 1), low)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    # the smallest of some window: equal to the largest of the minima around it
    top = lambda i: F.greatest(*[F.get("lows", i - j) for j in range(reach + 1)])
    h = h.withColumn(
        "places",
        F.when(
            F.size("lows") > 0,
            F.filter(F.sequence(F.lit(0), F.size("grams") - 1), lambda i: F.get("grams", i) == top(i)),
        ).otherwise(F.array().cast("array<int>")),
    )
    mark = lambda n, key, pos, at, around: F.struct(
        F.lit(n).alias("len"), key.alias("key"), pos.alias("pos"), at.alias("at"), around.alias("around")
    )
    first = lambda i: F.greatest(i - reach, F.lit(0))
    long = F.transform(
        "places",
        lambda i: mark(
            window, F.get("grams", i), i, i - first(i), F.slice("grams", first(i) + 1, i - first(i) + window - k + k + 1)
        ),
    )
    marks_type = "array<struct<len:int,key:bigint,pos:int,at:int,around:array<bigint>>>"
    short = []
    for n in lengths:
        none = F.array().cast(marks_type)
        short.append(F.coalesce(_short_marks(n, mark), none))
    return h.withColumn("marks", F.concat(long, *short))


def _short_marks(n: int, mark) -> Column:
    """Two hashes of the n words from each position, as marks."""
    at = lambda i, *salt: F.xxhash64(*salt, *[F.get(F.col("words"), i + j) for j in range(n)])
    return F.when(
        F.size("words") >= n,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - n),
            lambda i: mark(n, at(i), i, F.lit(0), F.array(at(i, F.lit("2")))),
        ),
    )


def _windows_around(at: Column, around: Column, k: int, window: int) -> Column:
    """For each offset o: the two hashes of the window that starts o words
    before the fingerprint; null where it would leave the text."""
    return F.array(
        *[
            F.when(
                F.get(around, at - o).isNotNull() & F.get(around, at - o + window - k).isNotNull(),
                F.struct(F.get(around, at - o).alias("a"), F.get(around, at - o + window - k).alias("b")),
            )
            for o in range(window - k + 1)
        ]
    )


def _benchmark(items: DataFrame, k: int, window: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """(marks, members, lengths): marks to join documents with, the items of
    each window class, and the lengths of short items."""
    words = items.select("item_id", words_of(F.col("text")).alias("words"))
    sized = words.filter(F.size("words") > 0)
    lengths = sorted(
        r["n"] for r in sized.filter(F.size("words") < window).select(F.size("words").alias("n")).distinct().collect()
    )  # at most window - 1 numbers
    long = _with_fingerprints(sized.filter(F.size("words") >= window), k, window, [])
    # outer: an inner explode would bring a filter that computes the hashes again
    around = long.select("item_id", F.explode_outer("marks").alias("m")).select(
        "item_id", "m.len", "m.key", _windows_around(F.col("m.at"), F.col("m.around"), k, window).alias("windows")
    )
    around = stage(around, "winnowing-items")
    marks = around
    for n in lengths:
        gram = lambda salt, n=n: F.xxhash64(*salt, *[F.get("words", j) for j in range(n)])
        one = sized.filter(F.size("words") == n).select(
            "item_id",
            F.lit(n).alias("len"),
            gram([]).alias("key"),
            F.array(F.struct(gram([F.lit("2")]).alias("a"), F.lit(n).cast("long").alias("b"))).alias("windows"),
        )
        marks = marks.unionByName(one)
    marks = stage(marks, "winnowing-marks")
    each = marks.select("item_id", "len", F.explode("windows").alias("w")).filter("w IS NOT NULL").distinct()
    # the class of a window: which items have it, told by their number and hashes
    known = each.filter("item_id IS NOT NULL")
    signed = known.groupBy("len", "w").agg(
        F.xxhash64(
            F.count("*"), F.bit_xor(F.xxhash64("item_id")), F.bit_xor(F.xxhash64("item_id", F.lit("2")))
        ).alias("class")
    )
    signed = stage(
        each.select("len", "w").distinct().join(signed, ["len", "w"], "left"), "winnowing-classes"
    )
    members = stage(
        known.join(signed, ["len", "w"]).select("class", "item_id").distinct(), "winnowing-members"
    )
    # one row for each distinct surrounding of a fingerprint
    distinct = marks.select("len", "key", F.posexplode("windows").alias("o", "w"), "windows").filter("w IS NOT NULL")
    distinct = distinct.select("len", "key", "o", "w").distinct().join(signed, ["len", "w"])
    return stage(distinct.select("len", "key", "o", "w", "class"), "winnowing-windows"), members, lengths


def occurrences(
    docs: DataFrame, windows: DataFrame, lengths: list[int], k: int = K, window: int = WINDOW
) -> DataFrame:
    """Rows ``docs(row, words)`` against the benchmark's windows: one row
    (row, n_words, start, len, class) for each occurrence, and one with a null
    start for each document."""
    marked = _with_fingerprints(docs, k, window, lengths)
    none = F.struct(
        F.lit(0).alias("len"),
        F.lit(None).cast("long").alias("key"),
        F.lit(None).cast("int").alias("pos"),
        F.lit(0).alias("at"),
        F.array().cast("array<bigint>").alias("around"),
    )
    rows = marked.select(
        "row", F.size("words").cast("long").alias("n_words"), F.explode_outer(F.concat("marks", F.array(none))).alias("m")
    ).select("row", "n_words", "m.*")
    side = windows.select(
        F.col("len").alias("w_len"), F.col("key").alias("w_key"), "o", F.col("w.a").alias("a"), F.col("w.b").alias("b"), "class"
    )
    small = fits_broadcast(windows.select("len", "key", "o", "class"), BROADCAST_BYTES // 2)
    met = rows.join(
        F.broadcast(side) if small else side,
        (rows["key"] == side["w_key"]) & (rows["len"] == side["w_len"]),
        "left",
    )
    is_long = F.col("len") == window
    found = F.when(
        is_long,
        (F.get("around", F.col("at") - F.col("o")) == F.col("a"))
        & (F.get("around", F.col("at") - F.col("o") + window - k) == F.col("b")),
    ).otherwise((F.get("around", F.lit(0)) == F.col("a")) & (F.col("len") == F.col("b")))
    return met.filter((F.col("len") == 0) | F.coalesce(found, F.lit(False))).select(
        "row", "n_words", (F.col("pos") - F.coalesce("o", F.lit(0))).alias("start"), "len", "class"
    )


def _covered(spans: Column) -> Column:
    """Words in the union of sorted (start, len) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, s: Column) -> Column:
        start, end = s["start"].cast("long"), (s["start"] + s["len"]).cast("long")
        fresh = F.greatest(F.lit(0).cast("long"), end - F.greatest(start, acc["end"]))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def find(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) for every row."""
    bench = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    windows, members, lengths = _benchmark(bench, k, window)
    rows = docs.select(
        F.struct(F.monotonically_increasing_id().alias("at"), F.col(id_col).alias("id")).alias("row"),
        words_of(F.col(text_col)).alias("words"),
    )
    by_doc = (
        occurrences(rows, windows, lengths, k, window)
        .groupBy("row", "n_words")
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "len")))).alias("spans"),
            F.collect_set("class").alias("classes"),
        )
        .select("row", "n_words", _covered(F.col("spans")).alias("n_hit"), "classes")
    )
    by_doc = stage(by_doc, "winnowing-documents")
    hit = by_doc.filter(F.size("classes") > 0).select("row", F.explode("classes").alias("class"))
    small = fits_broadcast(members, BROADCAST_BYTES)
    listed = (
        hit.join(F.broadcast(members) if small else members, "class")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return by_doc.join(listed, "row", "left").select(
        F.col("row.id").alias(id_col),
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **parameters) -> DataFrame:
    """The rows without any occurrence, with all their columns. Texts decide,
    not ids: a row goes exactly if its own text holds an occurrence."""
    text = lambda c: F.coalesce(c, F.lit(""))
    hashes = lambda c: F.struct(F.xxhash64(text(c)).alias("t1"), F.xxhash64(F.lit(1), text(c)).alias("t2"))
    texts = docs.select(hashes(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    found = find(texts, items, id_col="key", text_col="text", **parameters)
    bad = stage(found.filter("contaminated").select(F.col("key.t1").alias("__t1"), F.col("key.t2").alias("__t2")).distinct(), "winnowing-dropped")
    side = F.broadcast(bad) if fits_broadcast(bad, BROADCAST_BYTES) else bad
    mine = hashes(docs[text_col])
    return docs.join(side, (mine["t1"] == side["__t1"]) & (mine["t2"] == side["__t2"]), "left_anti")
