import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapdeck.llm import bpe, token_counts

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
SOME = ["", "don't 'RE we'll  x", "a　 \nb", "x\x1cy \x1c z", "  \n ", "aaaaaaa" * 200, "é́ İ ΑΣ\x85b", "a<|endoftext|>b"]


@pytest.fixture(scope="module")
def byte_bpe():
    b = bpe.load(RANKS, P.PATTERN)
    return b, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return token_counts.load(WORDS), Tokenizer.from_file(WORDS)


def n_words(tk, text):
    return len(tk.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_bytes_as_the_library(byte_bpe, text):
    b, enc = byte_bpe
    ids = b.encode(text)
    assert ids == enc.encode_ordinary(text)
    assert b.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(text=st.text(alphabet=" \n'aeltrsvmd!.<|>éßİ9½", max_size=60))
def test_counts_of_every_prefix(counter, text):
    c, tk = counter
    assert c.count(text) == n_words(tk, text)
    norm = c.normalize(text)
    counts = c.prefix_counts(text)
    assert counts == [n_words(tk, norm[:k]) for k in range(len(norm) + 1)]
    for budget in (0, 1, 3, 8):
        assert c.fitting(text, budget) == max(k for k, n in enumerate(counts) if n <= budget)


def test_corpus(byte_bpe, counter, documents):
    (b, enc), (c, tk) = byte_bpe, counter
    for r in documents.collect()[:60]:
        assert b.encode(r.text) == enc.encode_ordinary(r.text)
        assert c.count(r.text) == n_words(tk, r.text)
    for t in SOME:
        assert b.encode(t) == enc.encode_ordinary(t)
        assert c.count(t) == n_words(tk, t)


def test_small_caches_change_nothing(byte_bpe, documents):
    b, enc = byte_bpe
    small = bpe.ByteBpe(b.ranks, P.PATTERN)
    small.cached = bpe.TwoAgeCache(small._piece, 8, 4)
    for r in documents.limit(5).collect():
        assert small.encode(r.text) == enc.encode_ordinary(r.text)


def test_queries_on_odd_rows(odd, none, byte_bpe, counter):
    b, enc = byte_bpe
    rows = bpe.round_trip_digests(odd, RANKS, P.PATTERN).collect()
    want = []
    for r in odd.collect():
        t = r.text or ""
        ids = enc.encode_ordinary(t)
        want.append(
            (r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        )
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    counts = token_counts.count_tokens(odd, WORDS, budget=100).collect()
    _, tk = counter
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counts) == sorted(
        (str(r.doc_id), len((r.text or "").encode()), n := n_words(tk, r.text or ""), n > 100) for r in odd.collect()
    )
    assert bpe.round_trip_digests(none, RANKS, P.PATTERN).count() == 0
    assert token_counts.count_tokens(none, WORDS).count() == 0


def test_decode_frame(odd, byte_bpe):
    ids = bpe.encode(odd, RANKS, P.PATTERN)
    back = bpe.decode(ids, RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r.text or "").encode() for r in odd.collect())


def test_every_code_point_counts_as_the_library_counts():
    """Letters and digits that are newer than the library's tables included:
    each code point between letters, a digit and a sign."""
    path = P.path("word_bpe_49k.json")
    library, mine = Tokenizer.from_file(path), token_counts.load(path)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 1 << 16):
        part = every[at : at + (1 << 16)]
        texts = [f"x{c}y 1{c}!" for c in part]
        want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
        got = [mine.count(t) for t in texts]
        wrong = [(hex(ord(c)), g, w) for c, g, w in zip(part, got, want) if g != w]
        assert not wrong, wrong[:20]
