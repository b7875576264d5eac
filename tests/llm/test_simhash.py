import re
from collections import defaultdict

import numpy as np
import xxhash

from snapdeck.llm import simhash


def brute_fingerprint(text, n=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=4):
    """rows (id, fp) -> [(id, fp, smallest id reachable)]"""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                up[root(a)] = root(b)
    least = defaultdict(list)
    for d, f in rows:
        if d is not None:
            least[root(f)].append(d)
    return [(d, f, min(least[root(f)], default=None)) for d, f in rows]


def test_cells_against_all_pairs():
    rng = np.random.default_rng(1)
    for trial in range(12):
        base = rng.integers(0, 2**63, 5)
        near = [int(b) ^ sum(1 << int(x) for x in set(rng.integers(0, 64, trial % 6))) for b in base for _ in range(20)]
        fps = np.unique(np.array(near, dtype=np.uint64))
        first = simhash.join_cells(np.zeros(len(fps), np.int64), fps, 4)
        want = brute_components([(i, int(f)) for i, f in enumerate(fps)])
        assert first.tolist() == [w[2] for w in want]


def run(df, **kw):
    return [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(df, **kw).collect()]


def same(got, want):
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_documents_against_brute_force(documents):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in documents.collect()]
    same(run(documents), brute_components(rows))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd.collect()]
    same(run(odd), brute_components(rows))
    assert run(none) == []
    kept = simhash.keep_representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})


def test_unrelated_rows_without_or_with_the_same_id_stay(spark):
    """Five unrelated texts under ids null, null, null, 7, 7; copies of two."""
    say = lambda k: " ".join(f"w{k}x{i * i}" for i in range(80))
    rows = [(None, say(1), "a"), (None, say(2), "b"), (None, say(3), "c"), (7, say(4), "d"), (7, say(5), "e")]
    df = spark.createDataFrame([*rows, (None, say(1), "z"), (9, say(4), "z"), (3, say(5), "z")], "doc_id long, text string, x string")
    kept = simhash.keep_representatives(df)
    assert sorted(r.text for r in kept.collect()) == sorted(r[1] for r in rows)
    assert {r.doc_id for r in kept.collect() if r.text == say(5)} == {3} and {r.doc_id for r in kept.collect() if r.text == say(1)} == {None}


def test_empty_table(none):
    assert simhash.keep_representatives(none).count() == 0


def test_chains_and_split_cells(spark, monkeypatch):
    """A chain links ends that are far apart; cells of 8 rows are split."""
    chain = [sum(1 << (63 - b) for b in range(k)) for k in range(0, 60, 3)]
    rng = np.random.default_rng(2)
    cloud = [0x0F0F0F0F ^ sum(1 << int(x) for x in set(rng.integers(0, 64, 3))) for _ in range(150)]
    fps = sorted(set(chain + cloud))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.near_links(df, 4, cell_rows=8)
    roots = {r.fp % (1 << 64): r.root % (1 << 64) for r in simhash.components(links).collect()}
    want = brute_components(list(zip(fps, fps)))
    groups = lambda pairs: {frozenset(x) for x in pairs.values()}
    got, exp = defaultdict(set), defaultdict(set)
    for f, _, c in want:
        got[roots.get(f, f)].add(f)
        exp[c].add(f)
    assert groups(got) == groups(exp)
