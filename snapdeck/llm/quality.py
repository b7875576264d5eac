"""Quality rules with distribution divergence (operator 6), in SQL functions only.

Two histograms of a document are held against references of its possible
languages: shares of character classes, and shares of common words (with one
bin for other words and one for signs that stand as words). The distance is
the square root of the Jensen-Shannon divergence to base 2, from 0 to 1. A
document of a language with a word list is held against the nearest of these
languages; one of another language against these and its own language's
reference. It is rejected if either distance is over its limit, or if the base
rules fail. Documents with few words are left to the
base rules: their histograms say little.

References are averages over all documents of a language that are long
enough, each document with the same weight.

Defined results: a null text counts as empty; it has no words, so the base
rules reject it. Repeated rows each get an output row, or stay. An empty table
has no references and no rows. A language with a word list has a reference if
it has a long enough document, another one if it has ``reference_docs`` of
them; of a language without a reference, or unknown (null), only the base rules
decide. Working
columns begin with ``__q_``; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The twelve most common function words of each language, and
# signs that stand as words.
COMMON_WORDS = {
    "en": "the of and to a in that is was for it with".split(),
    "de": "der die und in den von zu das mit sich des ist".split(),
    "fr": "de la le et les des en un du une que est".split(),
    "es": "de la que el en y a los del se las por".split(),
}
WORD_BINS = tuple(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
SIGN_WORDS = tuple("| - – — * # & + = / \\ % $ < > • · ~ ^ _ @ || -- ** ## == // << >> &&".split())

# Patterns of the base rules and of the character classes.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = r"#*$%&|<>"
PUNCTUATION = r"\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E"
#: Character classes in the order in which they are taken out of the text.
CLASSES = ("a-z", SPACE, "A-Z", "0-9", SYMBOLS, PUNCTUATION)

#: Shares are summed as whole billionths, so that their order doesn't matter.
SCALE = 1_000_000_000


@dataclass(frozen=True)
class Limits:
    min_words: int = 50  # base rule
    repeat_percent: int = 50  # base rule: most words in repeated 3-word windows
    guard_words: int = 50  # histograms of fewer words aren't compared
    char_distance: float = 0.30
    word_distance: float = 0.42
    reference_docs: int = 1  # least long enough documents of a language without a word list


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def _repeated_words(windows: Column) -> Column:
    """Words in windows (hashes by position) that occur twice or more: the
    windows are sorted by hash, equal neighbours give the positions, and the
    union of three words from each position is counted."""
    size = F.size(windows)
    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def positions(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"])),
        )
        return F.sort_array(F.transform(again, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return F.when(F.size(F.array_distinct(windows)) == size, F.lit(0).cast("long")).otherwise(
        _let(_let(by_hash, positions), covered)
    )


def with_counts(df: DataFrame, text_col: str) -> DataFrame:
    """All columns, and the base counts and histograms as ``__q_`` columns.

    Each character class is counted by what its removal takes from the text,
    one class after the other, so that most passes are over short rests.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    common = F.filter(F.split(F.lower(text), f"[{SPACE}.,;:!?]+"), lambda w: w.isin(*WORD_BINS, *SIGN_WORDS))
    a = df.withColumns(
        {
            "__q_words": _words(text),
            "__q_lines": F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""),
            "__q_common": common,
            "__q_n_chars": F.length(text).cast("long"),
            "__q_rest_0": F.regexp_replace(text, f"[{CLASSES[0]}]+", ""),
        }
    )
    n = F.size("__q_words")
    word = lambda i: F.get(F.col("__q_words"), i)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))
    b = a.withColumns(
        {
            "__q_n_words": n.cast("long"),
            "__q_word_chars": F.length(F.array_join("__q_words", "")).cast("long"),
            "__q_n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
            "__q_windows": F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")),
        }
    )
    for k, chars in enumerate(CLASSES[1:], 1):
        b = b.withColumn(f"__q_rest_{k}", F.regexp_replace(f"__q_rest_{k - 1}", f"[{chars}]+", ""))
    sizes = [F.col("__q_n_chars"), *[F.length(f"__q_rest_{k}").cast("long") for k in range(len(CLASSES))]]
    taken = [a - b for a, b in zip(sizes, sizes[1:])]
    n_common = F.size("__q_common").cast("long")
    bins = [n_common - F.size(F.array_remove("__q_common", w)) for w in WORD_BINS]
    counted = b.withColumns(
        {
            "__q_n_symbols": taken[CLASSES.index(SYMBOLS)],
            "__q_n_repeat_words": _repeated_words(F.col("__q_windows")),
            "__q_char_bins": F.array(*taken),
            "__q_word_bins": F.array(*bins),
            "__q_n_common": n_common,
        }
    ).withColumn(
        "__q_word_bins",
        F.concat(
            "__q_word_bins",
            F.array(F.col("__q_n_common") - F.aggregate("__q_word_bins", F.lit(0).cast("long"), lambda x, y: x + y)),
        ),
    )
    rests = [f"__q_rest_{k}" for k in range(len(CLASSES))]
    return counted.drop("__q_words", "__q_lines", "__q_common", "__q_windows", "__q_n_common", *rests)


def _shares(bins: Column, total: Column) -> Column:
    """Shares of the bins and, last, of what is in none."""
    rest = F.greatest(F.lit(0).cast("long"), total - F.aggregate(bins, F.lit(0).cast("long"), lambda a, x: a + x))
    whole = F.greatest(total, F.lit(1))
    return F.transform(F.concat(bins, F.array(rest)), lambda x: x / whole)


def with_shares(counted: DataFrame) -> DataFrame:
    return counted.withColumns(
        {
            "__q_word_shares": _shares(F.col("__q_word_bins"), F.col("__q_n_words")),
            "__q_char_shares": _shares(F.col("__q_char_bins"), F.col("__q_n_chars")),
        }
    )


#: (character shares, word shares) by language.
References = dict[str, tuple[list[float], list[float]]]
#: References of languages without a word list are broadcast up to so many.
BROADCAST_LANGUAGES = 100_000


def references(counted: DataFrame, lang_col: str, limits: Limits) -> References:
    """The references of all languages with enough documents that are long
    enough: one row a language."""
    shares = with_shares(counted.filter(F.col("__q_n_words") >= limits.guard_words)).filter(F.col(lang_col).isNotNull())
    sums = lambda col, n: [
        F.sum(F.round(F.get(F.col(col), F.lit(i)) * SCALE).cast("long")).alias(f"{col}_{i}") for i in range(n)
    ]
    n_chars, n_words = len(CLASSES) + 1, len(WORD_BINS) + 2
    rows = (
        shares.groupBy(lang_col)
        .agg(F.count("*").alias("n"), *sums("__q_char_shares", n_chars), *sums("__q_word_shares", n_words))
        .filter(F.col(lang_col).isin(*COMMON_WORDS) | (F.col("n") >= limits.reference_docs))
        .orderBy(lang_col)
        .collect()
    )
    return {
        r[lang_col]: (
            [r[f"__q_char_shares_{i}"] / (r["n"] * SCALE) for i in range(n_chars)],
            [r[f"__q_word_shares_{i}"] / (r["n"] * SCALE) for i in range(n_words)],
        )
        for r in rows
    }


def _distance(shares: Column, reference: Column) -> Column:
    half = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    terms = F.zip_with(shares, reference, lambda p, q: (half(p, q) + half(q, p)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def with_verdict(counted: DataFrame, refs: References, lang_col: str, limits: Limits) -> DataFrame:
    """``__q_base_failed``, the two distances and ``__q_kept`` beside the counts."""
    listed = [r for lang, r in refs.items() if lang in COMMON_WORDS]
    others = [(lang, *r) for lang, r in refs.items() if lang not in COMMON_WORDS]
    none = F.lit(None).cast("double")
    n, kinds = F.col("__q_n_words"), (("char", limits.char_distance), ("word", limits.word_distance))
    shared, own = with_shares(counted), F.lit(False)
    if others:
        side = counted.sparkSession.createDataFrame(
            others, "__q_ref_lang string, __q_char_ref array<double>, __q_word_ref array<double>"
        )
        side = F.broadcast(side) if len(others) <= BROADCAST_LANGUAGES else side
        shared = shared.join(side, F.col(lang_col) == F.col("__q_ref_lang"), "left")
        own = F.col("__q_ref_lang").isNotNull()
    compared = F.coalesce(F.col(lang_col).isin(*COMMON_WORDS), F.lit(False)) | own

    def near(k: int, kind: str) -> Column:
        found = F.array_min(F.array(*[_distance(F.col(f"__q_{kind}_shares"), F.array(*map(F.lit, r[k]))) for r in listed]))
        return F.when(compared, found) if listed else none

    distances = {f"__q_{kind}_listed": near(k, kind) for k, (kind, _) in enumerate(kinds)}
    if others:
        distances |= {
            f"__q_{kind}_own": F.when(own, _distance(F.col(f"__q_{kind}_shares"), F.col(f"__q_{kind}_ref"))) for kind, _ in kinds
        }

    def within(which: str) -> Column:
        ok = [F.coalesce(F.col(f"__q_{kind}_{which}") <= limit, F.lit(False)) for kind, limit in kinds]
        return ok[0] & ok[1]

    least = lambda kind: F.least(f"__q_{kind}_listed", f"__q_{kind}_own") if others else F.col(f"__q_{kind}_listed")
    unknown = F.col("__q_char_distance").isNull()
    return (
        shared.withColumns(distances)
        .withColumns(
            {
                "__q_base_failed": (n < limits.min_words)
                | (100 * F.col("__q_n_repeat_words") > limits.repeat_percent * n),
                "__q_char_distance": least("char"),
                "__q_word_distance": least("word"),
            }
        )
        .withColumn(
            "__q_kept",
            ~F.col("__q_base_failed")
            & ((n < limits.guard_words) | unknown | within("listed") | (within("own") if others else F.lit(False))),
        )
    )


_OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
_FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "word_bins", "char_bins")


def score(
    df: DataFrame,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, char_distance, word_distance) for every row.

    ``stage`` writes the narrow counts, which two passes read.
    """
    from snapdeck.llm._common import stage as to_shared_folder

    narrow = df.select(F.col(id_col).alias("__q_id"), F.col(lang_col).alias("__q_lang"), F.col(text_col).alias("__q_text"))
    counted = (stage or to_shared_folder)(
        with_counts(narrow, "__q_text").select("__q_id", "__q_lang", *[f"__q_{c}" for c in _FEATURES]), "quality-counts"
    )
    judged = with_verdict(counted, references(counted, "__q_lang", limits), "__q_lang", limits)
    return judged.select(
        F.col("__q_id").alias(id_col),
        *[F.col(f"__q_{c}").alias(c) for c in (*_OUT, "char_distance", "word_distance")],
    )


def keep(
    df: DataFrame, limits: Limits = Limits(), text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows that the rules keep, with all their columns.

    Counts are taken once, staged by text and language; the references and
    the verdict come from them, and rows whose text and language were rejected
    go. (A verdict depends on nothing else, so repeated rows share it.)
    """
    from snapdeck.llm._common import join_measured, stage

    text = F.coalesce(F.col(text_col), F.lit(""))
    key = {"__q_t1": F.xxhash64(text), "__q_t2": F.xxhash64(F.lit(1), text)}
    narrow = df.select(F.col(lang_col).alias("__q_lang"), F.col(text_col).alias("__q_text")).withColumns(
        {k: F.xxhash64(*salt, F.coalesce("__q_text", F.lit(""))) for k, salt in (("__q_t1", ()), ("__q_t2", (F.lit(1),)))}
    )
    counted = stage(
        with_counts(narrow, "__q_text").select("__q_lang", *key, *[f"__q_{c}" for c in _FEATURES]), "quality-counts"
    )
    judged = with_verdict(counted, references(counted, "__q_lang", limits), "__q_lang", limits)
    rejected = stage(judged.filter("NOT __q_kept").select("__q_lang", *key).distinct(), "quality-rejected")
    keyed = df.withColumns(key | {"__q_lang": F.col(lang_col)})
    return join_measured(keyed, rejected, ["__q_lang", *key], "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
