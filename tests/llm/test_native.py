"""Operators 1, 5 and 6 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from snapdeck.llm import chat_collapse, decontaminate, quality

key = lambda r: tuple(map(str, r))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(docs, items, window=10):
    index = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1)) if w else ():
            index[tuple(w[a : a + window])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in index}:
            for a in range(len(w) - n + 1):
                if (g := tuple(w[a : a + n])) in index:
                    hit |= set(range(a, a + n))
                    found |= index[g]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def hits(docs, items):
    return sorted((tuple(r) for r in decontaminate.find(docs, items).collect()), key=key)


def test_winnowing_on_the_benchmark(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute_hits([(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert hits(documents, items) == sorted(want, key=key)


def test_winnowing_small_alphabet(spark, odd, none):
    r = random.Random(5)
    v = [f"w{i}" for i in range(6)]
    say = lambda n: " ".join(r.choices(v, k=n))
    items = [(1, say(25)), (2, say(12)), (3, "w1 w2 w3"), (4, None), (5, "..."), (7, say(9)), (3, say(11)), (None, "w5 w5 w4 w4"), (8, "w1 " * 16), (9, "one two three")]
    docs = [(1, items[0][1] + " X " + items[1][1]), (2, None), (3, ""), (3, "w1, w2 W3!"), (3, "w1, w2 W3!"), (None, say(300)), (9, "w1 " * 40)]
    docs += [(20 + i, say(r.randint(1, 200)) + " " + items[i % 2][1][r.randint(0, 20) :]) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert hits(df, bench) == sorted(brute_hits(docs, items), key=key)
    plain = [(x.doc_id, x.text) for x in odd.collect()]
    assert hits(odd, bench) == sorted(brute_hits(plain, items), key=key)
    kept = decontaminate.drop_contaminated(odd, bench)
    clean = [row for row, x in zip(plain, brute_hits(plain, items)) if not x[5]]
    assert kept.columns == odd.columns and sorted(map(str, ((x.doc_id, x.text) for x in kept.collect()))) == sorted(map(str, clean))
    mixed = [(None, "w1 w2 w3"), (None, "clean"), (None, None), (4, "w1 w2 w3 x"), (4, "fine")]
    left = decontaminate.drop_contaminated(spark.createDataFrame(mixed, "doc_id long, text string"), bench).collect()
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, (mixed[1], mixed[2], mixed[4])))
    assert hits(none, bench) == [] and decontaminate.drop_contaminated(none, bench).count() == 0
    assert not any(x[5] for x in hits(df, bench.filter("false")))


def brute_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:]))
    n, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_counts(odd, none, documents):
    for df in (odd, documents):
        got = quality.score(df).collect()
        want = [(r.doc_id, *brute_quality(r.text)) for r in df.collect()]
        assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
        assert not any(r.kept and r.base_failed for r in got)
    assert quality.score(none).count() == 0 and quality.keep(none).count() == 0


def test_quality_keeps_clean_and_drops_junk(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = quality.score(docs).collect()
    clean = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r for r in got if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in clean) == len(clean) and sum(r.kept for r in junk) <= 0.02 * len(junk)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)


def test_quality_of_other_languages(spark, documents):
    r = random.Random(4)
    say = lambda abc, n: " ".join("".join(r.choices(abc, k=r.randint(2, 9))) for _ in range(n))
    cyrillic, greek = "абвгдежзиклмнопрст", "αβγδεζηθικλμνξοπρστ"
    rows = [(i, say(cyrillic, 80), "ru") for i in range(30)] + [(100 + i, say(greek, 80), "el") for i in range(3)]
    rows += [(200, say(cyrillic, 80), None), (300, say("#$%|<>09", 80), "ru"), (301, say("#$%|<>09", 80), "en"), (302, say(cyrillic, 80), "en")]
    df = documents.select("doc_id", "text", "lang").union(spark.createDataFrame([(10**9 + i, t, lang) for i, t, lang in rows], "doc_id long, text string, lang string"))
    wrong = {10**9 + i for i in (300, 301, 302)}
    new = {10**9 + i for i, _, _ in rows}
    assert {x.doc_id for x in quality.score(df).collect() if x.kept} & new == new - wrong
    kept = quality.keep(df)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} & new == new - wrong


def brute_chats(rows, block=256):
    chats = defaultdict(list)
    for c, t, role, text in rows:
        chats[c].append((t, role, text))
    whole = defaultdict(list)
    proper = set()
    for c, turns in chats.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        seq = tuple((r, t) for _, r, t in turns)
        whole[seq].append(c)
        proper |= {seq[:k] for k in range(1, len(seq))}
    out = []
    for seq, ids in whole.items():
        if seq not in proper:
            first = min(ids, key=lambda x: (x is not None, x or 0))
            parts = defaultdict(str)
            for t, role, text in chats[first]:
                parts[-1 if t is None else t // block] += f"<|im_start|>{'unknown' if role is None else role}\n{text or ''}<|im_end|>\n"
            out += [(first, len(seq), len(ids), p, parts[b]) for p, b in enumerate(sorted(parts))]
    return out


def test_chats(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"hi {t}") for c, n in ((1, 3), (2, 5), (3, 5), (4, 1)) for t in range(n)]
    rows += [(5, 0, "user", "hi 0"), (5, 1, "bot", "other"), (6, None, None, None), (6, 1, "user", ""), (7, None, None, None)]
    rows += [(None, 0, "user", "null id")] + [(8, 10 * t, "user", f"hi {t}") for t in range(300)] + [(9, t - 2, "user", f"hi {t}") for t in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS key", "2 AS block", "3 AS pos")
    got = chat_collapse.collapse_and_render(df)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_chats(rows), key=key)
    assert chat_collapse.collapse_and_render(df.filter("false")).count() == 0
    small = chat_collapse.collapse_and_render(df, block=4)
    assert sorted(map(tuple, small.collect()), key=key) == sorted(brute_chats(rows, 4), key=key)


def test_chats_with_null_and_repeated_numbers(spark):
    rows = [(None, i % 8, "user", f"t{i}") for i in range(3000)] + [(1, None, "user", "same")] * 600 + [(2, None, "user", "same")] * 300
    rows += [(3, 5, "bot", f"m{i % 4}") for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(chat_collapse.collapse_and_render(df).collect(), key=lambda r: (r.conv_id or 0, r.part))
    assert {(r.conv_id, r.n_turns) for r in got} == {(None, 3000), (1, 600), (3, 700)}
    assert all(r.text.count("<|im_start|>") <= 256 for r in got)
    for c in (None, 1, 3):
        parts = [r for r in got if r.conv_id == c]
        assert [r.part for r in parts] == list(range(len(parts)))
        shown = "".join(r.text for r in parts).split("<|im_end|>\n")[:-1]
        assert Counter(shown) == Counter(f"<|im_start|>{r}\n{x}" for i, _, r, x in rows if i == c)
    null = [int(n) % 8 for r in got if r.conv_id is None for n in re.findall(r"\nt(\d+)", r.text)]
    assert null == sorted(null)


def test_chat_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    want = brute_chats([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert sorted(map(tuple, chat_collapse.collapse_and_render(df).collect()), key=key) == sorted(want, key=key)
