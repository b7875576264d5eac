import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from snapdeck.llm import queries, spelling


def brute_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    near = {w: [] for w in counts}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    for w in counts:
        for n in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [v for v in by_length.get(n, ()) if distance_one(w, v)]
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_brute_force(spark, documents):
    counts = brute_counts([(r.doc_id, r.text) for r in documents.collect()])
    frequent = spelling.count_words(documents, alter=spelling.crc_deletion)
    assert {r.word: r.n for r in frequent.collect()} == counts
    got = rows_of(queries.QUERIES["op12_spelling_variants"](spark, "/root/testdata/sf0.001"))
    assert got == brute(counts)
    assert any(r[1] for r in got)


def test_odd_rows(spark, odd, none):
    more = odd.select("doc_id", "text").union(
        spark.createDataFrame([(None, "Zwölfte zwölfte ZWÖLFTE zwolfte zwolfte"), (9, "aaaaaaaa aaaaaaa aaaaaaa aaaaaaaa")], "doc_id long, text string")
    )
    counts = brute_counts([(r.doc_id, r.text) for r in more.collect()])
    got = spelling.group_variants(spelling.count_words(more.withColumn("word", F.lit("clash")), alter=spelling.crc_deletion))
    assert rows_of(got) == brute(counts) and len(counts) > 2
    assert rows_of(spelling.group_variants(spelling.count_words(none))) == []


def test_runs_ties_chains_and_long_words(spark):
    rng = random.Random(1)
    counts = {"".join(rng.choice("aabé") for _ in range(rng.randrange(5, 9))): 10 ** rng.randrange(5) for _ in range(700)}
    counts |= {"x" * 3000: 5, "x" * 2999: 500, "x" * 2998 + "y": 50_000, "x" * 1500 + "y" + "x" * 1499: 50_000}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = brute(counts)
    assert rows_of(spelling.group_variants(df)) == want
    assert rows_of(spelling.group_variants(df, part_words=9)) == want  # many sorted partitions
    assert any(r[1] and r[2] != r[1] for r in want)  # roots two steps away


def test_nodes_are_those_of_the_trie(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in words], "key string")
    for part_words in (7, 10_000):
        got = {r.key: r.nodes for r in spelling.number_nodes(df, part_words).collect()}
        number = {}
        for w in words:
            for k in range(len(w) + 1):
                assert number.setdefault(w[:k], got[w][k]) == got[w][k]
        assert len(set(number.values())) == len(number) and number[""] == 0
        assert [got[w][-1] for w in words] == sorted(got[w][-1] for w in words)
