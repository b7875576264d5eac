import hashlib
import random
import re

import pytest

from snapdeck.llm import queries, relative_lz


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def brute(rows, window=50):
    """[(id, n_words, n_removed, kept)] by a table of all windows."""
    least = {}
    split = [(i, words_of(t)) for i, t in rows]
    for i, w in split:
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if i is not None and (key not in least or i < least[key]):
                least[key] = i
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - window + 1):
            first = least.get(tuple(w[a : a + window]))
            if first is not None and (i is None or first < i):
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def same(data, rows, **parameters):
    window = parameters.get("window", 50)
    got = relative_lz.deduplicate(data, **parameters).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((*r[:4],) for r in got), key=key) == sorted(brute(rows, window), key=key)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(words_of(t))
    assert all(r.n_removed == sum(r.cuts[1::2]) - sum(r.cuts[::2]) for r in got)
    found = relative_lz.factors(data, **parameters).collect()
    assert {f.doc_id for f in found} == {r[0] for r in got if r.n_removed}
    for f in found:  # factors are copies, and long enough
        assert f.n_words >= window and f.ref_id is not None and (f.doc_id is None or f.ref_id < f.doc_id)
        there = [w[f.ref_start : f.ref_start + f.n_words] for w in texts[f.ref_id]]
        assert any(w[f.start : f.start + f.n_words] in there for w in texts[f.doc_id])


def test_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = queries.QUERIES["op11_substring_dedup"](spark, "/root/testdata/sf0.001").collect()
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r.n_removed for r in got) > 0


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same(odd, rows)
    assert relative_lz.deduplicate(none).collect() == []


@pytest.mark.parametrize("letters", [2, 5, 4000])
def test_shared_passages(spark, letters):
    """Copies, edits, passages of 49, 50 and 51 words, repeats in a document,
    ids that are repeated or null, few different words."""
    rng = random.Random(letters)
    word = lambda: f"w{rng.randrange(letters)}"
    text = lambda n: [word() for _ in range(n)]
    passages = [text(n) for n in (49, 50, 51, 75, 300)]
    rows = []
    for i in range(60):
        w = text(rng.choice([0, 3, 30, 80, 200]))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(passages)
        if rows and rng.random() < 0.3:  # a near copy
            w = words_of(rng.choice(rows)[1])
            for _ in range(rng.randrange(4)):
                if w:
                    w[rng.randrange(len(w))] = word()
        rows.append((rng.choice([None, i, i, i, i // 2, -i]), rng.choice([" ", "\n", "\t "]).join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(df, rows)
    same(df, rows, window=12, k=4)


def test_blocks_end_where_pieces_end(monkeypatch):
    rng = random.Random(5)
    words = [b"%d" % rng.randrange(300) for _ in range(1000)]
    whole = [list(map(int, x)) for f in relative_lz.blocks_of(words) for x in zip(*f[:2])]
    assert [s for s, _ in whole] == [0, *(s + n for s, n in whole[:-1])] and sum(n for _, n in whole) == 951
    monkeypatch.setattr(relative_lz, "WINDOWS_AT_ONCE", 64)
    pieces = [list(map(int, x)) for f in relative_lz.blocks_of(words) for x in zip(*f[:2])]
    assert sum(n for _, n in pieces) == 951 and {s for s, _ in whole} <= {s for s, _ in pieces}
    assert [int(x) for f in relative_lz.windows_of(words, 3, 200) for x in f[0]] == list(range(3, 203))


def test_text_of_several_pieces(spark, monkeypatch):
    rng = random.Random(6)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(150_000))
    rows = [(1, long), (2, "x " + long), (3, long[:2000])]
    same(spark.createDataFrame(rows, "doc_id long, text string"), rows)
