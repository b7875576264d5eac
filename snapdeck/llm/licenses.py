"""License scans by fuzzy search for short notices (operator 10).

Texts and notices are compared as lower-case words joined by one space. A
notice that occurs with at most k edits contains one of its k + 1 parts
unchanged (pigeonhole), so exact searches for the parts locate the candidates;
the regex library's bounded-error matching then verifies a small stretch
around each and counts its edits. The words that tell licenses apart (a name,
a version, nc or sa) must stand in the match as they are. Besides that, fixed
phrases are found as they stand.

Defined results: a null text counts as empty; a text without words has no
places, null first and last words, empty labels and score 0. Repeated rows
each get an output row. Texts are searched whole. Columns other than the id
and text columns are not read.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapdeck.llm._common import map_rows

# The phrases found as they stand, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Notice:
    text: str  # lower-case words joined by one space
    label: str
    edits: int  # most insertions, deletions and substitutions
    #: words that tell this license from others: they stand in the match as
    #: they are, in this order; edits only fall on the words around them
    exact: str
    #: a match followed by one of these words is another license
    not_before: str = ""


_MORE_CC = "nc nd sa noncommercial noderivatives noderivs sharealike"

#: Notices that are found with a few edits.
NOTICES = (
    Notice("released under the mit license", "mit", 3, "mit"),
    Notice("licensed under the mit license", "mit", 3, "mit"),
    Notice("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 6, "free of charge"),
    Notice("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc", 6, "with or without fee"),
    Notice("released under the isc license", "isc", 3, "isc"),
    Notice("licensed under the apache license version 2", "apache-2", 4, "2"),
    Notice("licensed under the apache license version 1 1", "apache-1.1", 4, "1 1"),
    Notice("licensed under cc by 4 0", "cc-by", 2, "cc by 4", _MORE_CC),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 2, "cc by sa"),
    Notice("licensed under cc by nd 4 0", "cc-by-nd", 2, "cc by nd"),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 2, "cc by nc 4", _MORE_CC),
    Notice("licensed under cc by nc sa 4 0", "cc-by-nc-sa", 2, "cc by nc sa"),
    Notice("licensed under cc by nc nd 4 0", "cc-by-nc-nd", 2, "cc by nc nd"),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 4, "noncommercial", _MORE_CC),
    Notice("creative commons attribution noncommercial sharealike", "cc-by-nc-sa", 4, "noncommercial sharealike"),
    Notice("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", 4, "noncommercial noderivatives"),
    Notice("creative commons attribution sharealike", "cc-by-sa", 4, "attribution sharealike"),
    Notice("creative commons attribution noderivatives", "cc-by-nd", 4, "attribution noderivatives"),
    Notice("licensed under the gnu general public license version 3", "gpl-3", 4, "gnu 3"),
    Notice("licensed under the gnu general public license version 2", "gpl-2", 4, "gnu 2"),
    Notice("gnu affero general public license", "agpl", 3, "affero"),
    Notice("gnu lesser general public license", "lgpl", 3, "lesser"),
    Notice("subject to the terms of the mozilla public license", "mpl", 4, "mozilla"),
    Notice("redistribution and use in source and binary forms with or without modification", "bsd", 6, "source binary"),
    Notice("distributed under the boost software license", "boost", 4, "boost"),
    Notice("this is free and unencumbered software released into the public domain", "unlicense", 4, "unencumbered"),
    Notice("the eclipse public license", "epl", 2, "eclipse"),
)

# [^0-9A-Za-z\x80-] parts words; one table lower-cases A-Z on the way
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of a text, in UTF-8."""
    return (text or "").encode("utf-8").translate(_TO_WORDS).split()


def parts_of(notice: Notice) -> list[tuple[int, str]]:
    """(offset, part): edits + 1 parts of nearly equal length."""
    n, k = len(notice.text), notice.edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.phrases = phrases
        self.notices = [
            (n, parts_of(n), regex.compile(f"(?e)(?:{regex.escape(n.text)}){{e<={n.edits}}}")) for n in notices
        ]

    @staticmethod
    def _places(hay: str, needle: str) -> Iterator[int]:
        at = hay.find(needle)
        while at >= 0:
            yield at
            at = hay.find(needle, at + 1)

    def exact(self, padded: str) -> list[tuple[int, str]]:
        """(character, label) of every phrase; words stand between spaces."""
        return [(at, label) for phrase, label in self.phrases for at in self._places(padded, f" {phrase} ")]

    def fuzzy(self, flat: str) -> list[tuple[int, int, str, float]]:
        """(start, end, label, score) of the notices, in characters. Where
        notices of different labels overlap, the one with the best score, then
        the longest, stands."""
        out = []
        for notice, parts, pattern in self.notices:
            k, n = notice.edits, len(notice.text)
            stretches: list[list[int]] = []
            for a, b in sorted(
                (at - off - k, at - off + n + k) for off, part in parts for at in self._places(flat, part)
            ):
                if stretches and a <= stretches[-1][1]:
                    stretches[-1][1] = max(stretches[-1][1], b)
                else:
                    stretches.append([a, b])
            for a, b in stretches:
                for m in pattern.finditer(flat, max(0, a), min(len(flat), b)):
                    if m.end() > m.start() and self._decided(notice, flat, m.start(), m.end()):
                        out.append((m.start(), m.end(), notice.label, 1 - sum(m.fuzzy_counts) / n))
        out.sort(key=lambda f: (-f[3], f[0] - f[1], f))
        kept: list[tuple[int, int, str, float]] = []
        number = {label: k for k, label in enumerate(sorted({f[2] for f in out}), 1)}
        taken = array("H", bytes(2 * len(flat))) if out else array("H")  # the label that stands at each character
        for f in out:
            a, b, own = f[0], f[1], number[f[2]]
            if set(taken[a:b]) <= {0, own}:
                taken[a:b] = array("H", [own]) * (b - a)
                kept.append(f)
        return kept

    @staticmethod
    def _decided(notice: Notice, flat: str, start: int, end: int) -> bool:
        """Whether the words that tell licenses apart stand in the match (in
        whole words, in order), and none follows that makes it another one."""
        first = flat.rfind(" ", 0, start + 1) + 1
        last = flat.find(" ", end)
        last = len(flat) if last < 0 else last
        here = iter(flat[first:last].split(" "))
        if not all(word in here for word in notice.exact.split()):
            return False
        after = flat[last + 1 : last + 41].split(" ", 1)[0]
        return after not in notice.not_before.split()

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        flat = b" ".join(words).decode("utf-8")
        padded = f" {flat} "
        base = self.exact(padded)
        near = self.fuzzy(flat)
        if not base and not near:
            return len(words), 0, None, None, "", "", "", 0.0
        starts = [0]  # where each word begins
        for w in flat.split(" "):
            starts.append(starts[-1] + len(w) + 1)
        word_at = lambda c: bisect_right(starts, c) - 1
        firsts = [word_at(at) for at, _ in base]  # padded by one: the phrase begins at the same number
        base_labels = {label for _, label in base}
        labels = base_labels | {label for _, _, label, _ in near}
        spans = sorted({(word_at(a), word_at(b - 1) + 1, label) for a, b, label, _ in near})
        return (
            len(words),
            len(base),
            min(firsts, default=None),
            max(firsts, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            ",".join(f"{label}:{a}:{b}" for a, b, label in spans),
            1.0 if base else max(s for *_, s in near),
        )


def _scanner(phrases, notices):
    scanner = Scanner(phrases, notices)
    return lambda key, text: ((key, *scanner.scan(text)),)


def scan(
    df: DataFrame,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    notices: tuple[Notice, ...] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, spans,
    score) for every whole text.

    ``spans``: label:first:end in words of the notices found with edits;
    ``score``: 1 with a phrase, else the best notice's share of characters
    left as they are.
    """
    schema = T.StructType(
        [
            df.schema[id_col],
            *(T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")),
            *(T.StructField(c, T.StringType()) for c in ("base_labels", "labels", "spans")),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return map_rows(df, [id_col, text_col], schema, partial(_scanner, phrases, notices))
