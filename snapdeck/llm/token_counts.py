"""Token counts by prefix dynamic programming (operator 3).

For a BPE with word ends, the encoding of a word prefix ends in exactly one
token, and what stands before that token is the encoding of a shorter prefix.
So one left-to-right pass keeps, for each prefix, its last token and its
count: a vocabulary entry that ends here is the last token if the seam to the
shorter prefix's last token holds, that is, if BPE would not merge across it.
The closed count (the prefix as a whole word, its last symbol with the word
end) comes from the same table. Counts at every prefix answer how much of a
text fits a budget, without encoding anything again.

Counts equal those of the tokenizers library with the same file, special
strings as by its default (a special token in the text is one token).

Defined results: a null or empty text has 0 bytes and 0 tokens. Repeated rows
each get their own output row. Columns other than the id and text columns are
not read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import partial

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from snapdeck.llm._common import TwoAgeCache, held, map_rows

PIECE_ENTRIES, WORD_ENTRIES = 1_500_000, 1_000_000
CACHE_CHARS = 48
SEAM_ENTRIES = 400_000
END = "</w>"
OPEN, CLOSED = 1, 2
_CONTRACTIONS = ("'re", "'ve", "'ll", "'s", "'t", "'m", "'d")

# Lower case of letters that the library's Unicode version has
# and Python's may not have yet.
_NEW_CASES = {0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable Latin-1, else the next one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(free)
            free += 1
    return [out[b] for b in range(256)]


def newer_letters(spec: dict) -> str:
    """Characters that this pattern engine takes for letters or digits and the
    library doesn't (its Unicode tables are older), as ranges of a character
    class. Only those that Python's own tables don't know are asked about."""
    every = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]))
    asked = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    plain = Tokenizer.from_str(json.dumps(spec)).pre_tokenizer
    out: list[list[int]] = []
    for c in asked:
        alone = len(plain.pre_tokenize_str("!" + c)) == 1  # goes with signs, so it is neither
        if alone and out and out[-1][1] == ord(c) - 1:
            out[-1][1] += 1
        elif alone:
            out.append([ord(c), ord(c)])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class PrefixCounter:
    """Counts for one tokenizer file (lower-cased, word-end BPE)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str, int]] = {}
        for r, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[a, b] = r
            self.parts.setdefault(a + b, (a, b, r))
        # every vocabulary entry by its symbols: can it be open, can it end a word;
        # and every proper prefix of one, which can still become one
        self.entry: dict[str, int] = {}
        for t in self.vocab:
            if t.endswith(END) and len(t) > len(END):
                s, kind = t[: -len(END)], CLOSED
            else:
                s, kind = t, OPEN
            if len(s) > 1 and t not in self.parts:
                continue  # no merge makes it: it never arises
            for k in range(1, len(s)):
                self.entry.setdefault(s[:k], 0)
            self.entry[s] = self.entry.get(s, 0) | kind
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        # letters and digits that the library doesn't know as such yet
        self.unknown = regex.compile(f"[{newer}]") if (newer := newer_letters(spec)) else None
        if self.unknown:
            self.least_unknown = min(regex.findall(self.unknown.pattern, "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))))
            known = pattern
            for name in (r"\p{L}", r"\p{N}"):
                known = known.replace(name, f"[{name}--[{newer}]]")
            self.known_words = regex.compile(f"(?V1){known}")
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.symbols = byte_symbols()
        self.last_spine: dict[str, list[tuple[str, float]]] = {}
        self.first_spine: dict[str, list[tuple[str, float]]] = {}
        self.seams: dict[tuple[str, str], bool] = {}
        self.word = TwoAgeCache(self._word_count, WORD_ENTRIES, CACHE_CHARS)
        self.piece = TwoAgeCache(self._piece_count, PIECE_ENTRIES, CACHE_CHARS)

    # -- the seam test ------------------------------------------------------

    def _spine(self, token: str, side: int, memo: dict) -> list[tuple[str, float]]:
        """The outermost symbols of a token from its base symbol up to itself,
        each with the rank of the merge that takes it up."""
        got = memo.get(token)
        if got is None:
            chain, at, up = [], token, float("inf")
            while True:
                chain.append((at, up))
                if at not in self.parts:
                    break
                *pair, up = self.parts[at]
                at = pair[side]
            got = memo[token] = chain[::-1]
        return got

    def _seam(self, pair: tuple[str, str]) -> bool:
        """Whether two adjacent tokens stay apart: no merge across their seam
        comes before the merges that build them (the leftmost first on ties)."""
        left, right = self._spine(pair[0], 1, self.last_spine), self._spine(pair[1], 0, self.first_spine)
        i = j = 0
        while True:
            (x, up_x), (y, up_y) = left[i], right[j]
            across = self.rank.get((x, y))
            if across is not None and across < up_x and across <= up_y:
                return False
            if up_x == up_y == float("inf"):
                return True
            if up_x <= up_y:
                i += 1
            else:
                j += 1

    # -- prefix tables ------------------------------------------------------

    def _holds(self, pair: tuple[str, str]) -> bool:
        got = self.seams.get(pair)
        if got is None:
            if len(self.seams) >= SEAM_ENTRIES:
                self.seams.clear()
            got = self.seams[pair] = self._seam(pair)
        return got

    def _table(self, word: str, every: bool) -> list[int]:
        """For each character prefix of a pre-token, its tokens as a whole word;
        without ``every``, for the last one (the pre-token itself) only."""
        symbols, ends = self.symbols, []
        if word.isascii():
            text = "".join([symbols[b] for b in word.encode("ascii")])
            ends = range(1, len(word) + 1)
        else:
            text = "".join([symbols[b] for b in word.encode("utf-8")])
            at = 0
            for ch in word:
                at += len(ch.encode("utf-8"))
                ends.append(at)
        n = len(text)
        last: list[str | None] = [None] * (n + 1)
        count, closed = [0] * (n + 1), [0] * (n + 1)
        entry, seams, holds = self.entry, self.seams, self._holds
        for j in range(n):
            before = last[j]
            if j and before is None:
                continue
            tokens = count[j] + 1
            for i in range(j + 1, n + 1):
                t = text[j:i]
                kind = entry.get(t)
                if kind is None:
                    break
                if kind & OPEN and last[i] is None:
                    if not j or (seams.get((before, t)) if (before, t) in seams else holds((before, t))):
                        last[i], count[i] = t, tokens
                if kind & CLOSED and (every or i == n) and not closed[i]:
                    if not j or holds((before, t + END)):
                        closed[i] = tokens
        return [closed[i] for i in ends] if every else [closed[n]]

    def _word_count(self, word: str) -> int:
        return self._table(word, every=False)[-1]

    def _piece_count(self, piece: str) -> int:
        return sum(map(self.word, self._splitter(piece).findall(piece)))

    def _splitter(self, text: str) -> regex.Pattern:
        """The pattern of pre-tokens, with the library's letters."""
        if self.unknown is None or text.isascii() or max(text) < self.least_unknown:
            return self.words
        return self.known_words if self.unknown.search(text) else self.words

    def word_counts(self, word: str) -> list[int]:
        """For each character prefix of a pre-token, its tokens; a contraction
        that is cut short is a quote and letters."""
        counts = self._table(word, every=True)
        if word in _CONTRACTIONS:
            quote = self._word_count("'")
            for k in range(1, len(word)):
                counts[k - 1] = quote + (self._word_count(word[1:k]) if k > 1 else 0)
        return counts

    # -- texts --------------------------------------------------------------

    def normalize(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").translate(_NEW_CASES)  # no final-sigma rule
        return text.lower()

    def segments(self, text: str):
        """(special token?, text) in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            if m.start() > at:
                yield False, text[at : m.start()]
            yield True, m.group()
            at = m.end()
        if at < len(text):
            yield False, text[at:]

    def count(self, text: str | None) -> int:
        total = 0
        for special, part in self.segments(text or ""):
            if special:
                total += 1
                continue
            # pre-tokens never hold white space: a text may be cut at any of it
            young = self.piece.young
            for p in self.normalize(part).replace("\n", " ").split(" "):
                got = young.get(p)
                if got is None:
                    got = self.piece.miss(p)
                    young = self.piece.young
                total += got
        return total

    def prefix_counts(self, text: str | None) -> list[int]:
        """Tokens of every prefix of the normalized text, 0 for the empty one
        first. A special token counts once it is complete; before that, its
        characters count as ordinary text."""
        out, base = [0], 0
        for special, part in self.segments(text or ""):
            norm = self.normalize(part)
            at, total = 0, base
            for m in self._splitter(norm).finditer(norm):
                out += [total] * (m.start() - at)
                counts = self.word_counts(m.group())
                out += [total + c for c in counts]
                total += counts[-1]
                at = m.end()
            out += [total] * (len(norm) - at)
            if special:
                total = out[-1] = base + 1
            base = total
        return out

    def fitting(self, text: str | None, budget: int) -> int:
        """Characters of the longest prefix of the normalized text within a
        budget of tokens. Reads up to the word that goes over it; the prefix
        table of that word says where."""
        total, length = 0, 0
        for special, part in self.segments(text or ""):
            norm = self.normalize(part)
            if special:
                if total + 1 > budget:
                    counts = self.prefix_counts(part)
                    return length + max(k for k, c in enumerate(counts[:-1]) if total + c <= budget)
                total += 1
            else:
                for m in self._splitter(norm).finditer(norm):
                    n = self.word(m.group())
                    if total + n > budget:
                        fits = [k for k, c in enumerate([0, *self.word_counts(m.group())]) if total + c <= budget]
                        return length + m.start() + fits[-1]
                    total += n
            length += len(norm)
        return length


def load(path: str) -> PrefixCounter:
    """The counter of a tokenizer file; kept by a worker between its tasks."""

    def build() -> PrefixCounter:
        with open(path, encoding="utf-8") as f:
            return PrefixCounter(json.load(f))

    return held(("token_counts", path), build)


def _counter(path: str, budget: int):
    c = load(path)

    def one(key, text):
        text = text or ""
        n = c.count(text)
        fit = c.fitting(text, budget) if n > budget else None
        return ((key, len(text.encode("utf-8")), n, n > budget, fit),)

    return one


def count_tokens(
    df: DataFrame, path: str, budget: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) for every whole text.

    ``fit_chars``: where a text is over the budget, the characters of the
    longest prefix of its normalized form that is within it; else null.
    """
    schema = T.StructType(
        [
            df.schema[id_col],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
            T.StructField("fit_chars", T.LongType()),
        ]
    )
    return map_rows(df, [id_col, text_col], schema, partial(_counter, path, budget))
