"""Secret scans (operator 8).

Three rules of fixed form (assignments, access keys, hexadecimal runs), and
strings that look random: over each candidate string a window slides, its
character counts kept up to date by one character in and one out, and its
Shannon entropy is held against the limit of the window's character class.
Windows over the limit merge into spans of kind ``entropy``. An allow-list
suppresses candidates that match it whole, and takes stretches of known form
(UUIDs, published digests) out of them; a span that a rule's span covers is not
reported twice.

Offsets are code points, the end exclusive.

Defined results: a null text counts as empty; an empty text has no spans.
Repeated rows each get an output row. A text of any length is scanned whole.
Columns other than the id and text columns are not read by ``scan``; ``redact``
keeps all columns and leaves a null text null.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.llm._common import importable, map_rows

# The rules' forms and least lengths.
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # whole runs of 16 and more
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

Span = tuple[str, int, int]


@dataclass(frozen=True)
class EntropyRule:
    """Parameters of the entropy scan."""

    window: int = 20
    #: bits a character that a window of the class must reach
    hex_bits: float = 2.9
    base36_bits: float = 3.6
    base64_bits: float = 3.8
    #: a candidate, or a span, that one of these matches whole is no secret
    allow: tuple[str, ...] = (
        r"[A-Za-z]+([-_/.][A-Za-z]+)*",  # words
        r"[0-9]+([-_/.+][0-9]+)*",  # numbers, dates, telephone numbers
        r"(.)\1*",  # rules of one character
    )
    #: stretches of a candidate that are no secrets; what stands beside them is
    #: scanned on its own. Each is of a fixed length, so nothing hides behind it.
    allow_parts: tuple[str, ...] = (
        r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])",  # a UUID
        # published digests, by their lengths in hexadecimal and base 64
        r"sha1[-=_](?:[0-9a-f]{40}(?![0-9a-zA-Z])|[A-Za-z0-9+/]{27}=)",
        r"sha256[-=_](?:[0-9a-f]{64}(?![0-9a-zA-Z])|[A-Za-z0-9+/]{43}=)",
        r"sha512[-=_](?:[0-9a-f]{128}(?![0-9a-zA-Z])|[A-Za-z0-9+/]{86}==)",
        r"AKIA[A-Z0-9]{9}EXAMPLE(?![A-Za-z0-9])",  # keys of documentation
        r"[A-Za-z0-9/+]{30}EXAMPLEKEY(?![A-Za-z0-9/+])",
    )
    _allow: re.Pattern = field(init=False, repr=False, compare=False)
    _parts: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        for name, patterns in (("_allow", self.allow), ("_parts", self.allow_parts)):
            object.__setattr__(self, name, re.compile("|".join(f"(?:{x})" for x in patterns) or r"(?!)"))

    def allowed(self, text: str) -> bool:
        return self._allow.fullmatch(text) is not None

    def pieces(self, text: str) -> list[tuple[int, str]]:
        """(offset, piece): the candidate without its allowed stretches."""
        out, at = [], 0
        for m in self._parts.finditer(text):
            out.append((at, text[at : m.start()]))
            at = m.end()
        return [(a, p) for a, p in (*out, (at, text[at:])) if len(p) >= self.window]


_CANDIDATE = "[A-Za-z0-9+/_=.-]"
_LOWER, _UPPER, _DIGIT, _OTHER, _NOT_HEX = range(5)


def _classes(ch: str) -> tuple[int, ...]:
    kind = _DIGIT if ch.isdigit() else _LOWER if ch.islower() else _UPPER if ch.isupper() else _OTHER
    return (kind,) if ch in "0123456789abcdefABCDEF" else (kind, _NOT_HEX)


_CLASS_OF = {chr(c): _classes(chr(c)) for c in range(128)}


def entropy_windows(text: str, rule: EntropyRule) -> list[tuple[int, int]]:
    """Merged spans of the windows of a candidate string that reach the limit
    of their class. The sum of c * log2(c) over the counts c changes with the
    one character that comes in and the one that goes."""
    w = rule.window
    weight = [0.0] + [c * math.log2(c) for c in range(1, w + 1)]
    counts: dict[str, int] = {}
    kinds = [0] * 5
    total, spans = 0.0, []
    for i, ch in enumerate(text):
        if i >= w:
            old = text[i - w]
            c = counts[old]
            total += weight[c - 1] - weight[c]
            counts[old] = c - 1
            for k in _CLASS_OF[old]:
                kinds[k] -= 1
        c = counts.get(ch, 0)
        total += weight[c + 1] - weight[c]
        counts[ch] = c + 1
        for k in _CLASS_OF[ch]:
            kinds[k] += 1
        if i + 1 < w or not kinds[_DIGIT] or kinds[_LOWER] + kinds[_UPPER] == 0:
            continue  # words and numbers alone are no secrets
        if not kinds[_NOT_HEX] and not (kinds[_LOWER] and kinds[_UPPER]):
            limit = rule.hex_bits
        elif not kinds[_OTHER] and not (kinds[_LOWER] and kinds[_UPPER]):
            limit = rule.base36_bits
        else:
            limit = rule.base64_bits
        if math.log2(w) - total / w >= limit:
            start = i + 1 - w
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> list[Span]:
    """The three rules' spans by start, then by kind as listed."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_CHARS]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= ACCESS_CHARS]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy_spans(text: str, base: Iterable[Span], rule: EntropyRule) -> list[Span]:
    spans = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def covered(a: int, b: int) -> bool:
        """Whether a rule's span that starts at or before a ends at or after b."""
        k = bisect_right(starts, a)
        return k > 0 and ends[k - 1] >= b

    out = []
    for m in re.finditer(rf"(?<!{_CANDIDATE}){_CANDIDATE}{{{rule.window},}}", text):
        for at, piece in rule.pieces(m.group()):
            if rule.allowed(piece):
                continue
            for a, b in entropy_windows(piece, rule):
                a, b = a + at + m.start(), b + at + m.start()
                if not covered(a, b) and not rule.allowed(text[a:b]):
                    out.append(("entropy", a, b))
    return out


def find_spans(text: str | None, rule: EntropyRule) -> tuple[list[Span], list[Span]]:
    """(spans of the rules, all spans), each in order."""
    base = base_spans(text or "")
    more = entropy_spans(text or "", base, rule)
    return base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scanner(rule: EntropyRule):
    def one(key, text):
        base, every = find_spans(text, rule)
        n = {k: 0 for k in KINDS}
        for k, _, _ in base:
            n[k] += 1
        digest = hashlib.sha256(joined(base).encode("ascii")).hexdigest()
        return ((key, n["assign"], n["access"], n["hex"], digest, joined(every)),)

    return one


def scan(df: DataFrame, rule: EntropyRule = EntropyRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) for every whole text."""
    schema = T.StructType(
        [
            df.schema[id_col],
            *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]),
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )
    return map_rows(df, [id_col, text_col], schema, partial(_scanner, rule))


def redacted(text: str | None, rule: EntropyRule, mark: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced by a mark."""
    if not text:
        return text
    out, at, end = [], 0, -1
    for _, a, b in find_spans(text, rule)[1]:
        if a >= end:
            out += [text[at:a], mark]
        at = end = max(end, b)
    return "".join(out) + text[at:] if out else text


def redact(
    df: DataFrame, rule: EntropyRule = EntropyRule(), mark: str = "[SECRET]", text_col: str = "text"
) -> DataFrame:
    """All rows and columns, the secrets in the text column replaced."""

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redacted(t, rule, mark), na_action="ignore")

    return importable(df).withColumn(text_col, clean(F.col(text_col)))
