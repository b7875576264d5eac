"""HTML extraction by wrappers inferred from pages of the same host (operator 7).

A wrapper is a union-free regular expression over tokens: elements in order,
each with its own expression inside, marked once, optional (?), repeated (+)
or both (*), and text that is either the same on all pages or a slot. It is
inferred by aligning one page after another with the wrapper so far: runs of
equal neighbours become a repeated group, what only one side has becomes
optional, texts that differ become a slot. The alignment of two wrappers works
the same, so tasks infer wrappers of their own pages and those are aligned
again, per host and salt first, then per host. Elements of one tag whose names
differ from page to page become one element with the names they share, and a
wrapper is bounded (MAX_NODES, MAX_CHILDREN), whatever the number of pages.

Slots know how much text the pages had in them. The host's main region is the
article or main element, the element of a telling name, or else the smallest
container, that holds a large share of the slot text outside of elements that
are never main text (menus, headers, footers, sidebars, notices, adverts,
forms, comments): by their tag, containers by a part of their name that is
sure (comments, ads), or by a whole name that more than one page of the host
has (of a host with one page, any). Every page is then read by its host's region: all of it but
blocks that the wrapper has on every page with the same text, at the region's
start or end (never headings, lists, tables, quotations or code, and nothing
between slots). That needs three
different pages of the host; with two, text that is the same on both doesn't
choose the region, but is read, and if slots have less than a tenth of the
text, the two are copies and all text counts. A page without the host's region
is read by a wrapper of its own, by all its text. Pages without any token say
nothing of their host's wrapper.

Defined results: a null or empty page, and one without main text, gives an
empty text. A null or unusable URL: such pages share one nameless host.
Repeated rows each get an output row. Other columns are not read.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.llm._common import fits_broadcast, importable, map_rows, stage

#: Nodes of wrappers that a task holds at once; beyond them it gives them out early.
NODES_AT_ONCE = 200_000
#: Wrappers of a host are aligned over so many partitions, then over so many,
#: and last over all: a group stays small up to hundreds of thousands of them.
LEVELS = (64, 4_096)
BROADCAST_BYTES = 64 << 20
#: Elements nested deeper have their content beside them.
MAX_DEPTH = 200

# A tag ends at the next angle bracket outside of quotes, and no part of the
# pattern is tried again from inside: the work is linear in the page, whatever
# it holds.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template|noscript|textarea)\b[^<>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^<>\"']++)*+)(?:>|(?=<)|\Z)|<|[^<]+",
    re.S | re.I,
)
_ATTR = re.compile(r"(?i)(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
#: What an opening tag closes when it stands open: the tag, up to the limits.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
_ENDS_P = _BLOCKS - {"br", "body", "html", "head", "td", "th", "tr", "li", "dd", "dt", "option", "tbody", "thead", "tfoot", "caption", "title"} | {"li"}
_NEVER_TAGS = frozenset(
    "head title nav header footer aside form button select option input label menu dialog iframe object svg canvas "
    "audio video map script style template noscript textarea".split()
)
#: Elements whose names can say that they are no main text, by whole names (a
#: section by class and role only: its id is often made of its heading).
_NAMED_TAGS = frozenset("div section center table ul ol dl details fieldset".split())
_NEVER_NAME = re.compile(
    r"(?i)(?:(?:site|page|main|top|bottom|left|right|global|primary|secondary|cookie|user|reader)[-_])*"
    r"(?:ads?|advert(?:s|isements?|ising)?|banner|sponsor(?:s|ed)?|promos?|nav|nav-?bar|navi|navigation|menu|header|footer|"
    r"masthead|side-?bar|aside|breadcrumbs?|cookies?|consent|notices?|popup|modal|newsletter|subscribe|signup|login|search|"
    r"share|sharing|social|comments?|disqus|replies|respond|related|recommend(?:ed|ations?)|widget|toolbar|pagination|pager|"
    r"copyright|legal|complementary|contentinfo)"
    r"(?:[-_](?:bar|box|list|links?|buttons?|posts|items?|wrap|wrapper|container|area|block|panel|inner|form|0))*"
)
#: Parts of a name that alone say so, wherever they stand in it ("ad-slot",
#: "user-comments-section"); but not before the words of the second pattern.
_NEVER_PART = re.compile(
    r"(?i)(?:^|[-_#])(?:ads?|adverts?|advertisements?|advertising|sponsored|sponsors?|promos?|comments?|disqus|breadcrumbs?|"
    r"side-?bar|nav-?bar|newsletter|cookies?|pagination|masthead|sharing)(?=$|[-_])"
)
_PART_OF_TEXT = re.compile(r"(?i)(?:^|[-_#])(?:ad[-_](?:hoc|lib)|(?:with|has|no|without)[-_]\w+)(?=$|[-_])")
#: Blocks that belong to the article also where they are the same on every page.
_TEXT_TAGS = frozenset("h1 h2 h3 h4 h5 h6 pre code ul ol li dl dt dd table tr td th figure figcaption blockquote summary".split())
#: What can be a main region.
_CONTAINERS = frozenset("html body article main section div center table".split())
_MAIN_NAMES = re.compile(r"(?i)(?:^|[\s_#.-])(?:article|articlebody|post|entry|content|main|story|text|body)(?=$|[\s_.-])")

ONCE, OPTIONAL, REPEATED, ANY = "", "?", "+", "*"

# A node is [key, mark, children, None, 0, seen] for an element, [None, mark, [], text,
# chars, seen] for text; text None is a slot. ``seen`` has the least digests, SEEN at
# most, of the different pages that have the node.
SEEN = 3
#: Bounds of a wrapper: children of an element, all its nodes, characters of a
#: name and of a text (longer ones end with a digest). What goes over them is
#: joined in the wrapper; pages are read whole all the same.
MAX_CHILDREN, MAX_NODES, MAX_NAME, MAX_TEXT = 100, 2_000, 60, 120
#: At the end of a key, that further names differ between pages; and that each
#: page's names are likely ones of main text.
VARY, MAIN = "*", "~main"


# -- pages to trees of tokens --------------------------------------------------


def _short(text: str, most: int) -> str:
    return text if len(text) <= most else text[:most] + "…" + blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()


def _key(tag: str, attrs: str) -> str:
    """The tag, and the names of class and role, and of id with a # before each;
    html and body by their tag alone."""
    names: list[str] = []
    if "=" in attrs and tag not in ("html", "body"):
        for kind, a, b, c in _ATTR.findall(attrs):
            mark = "#" if kind.lower() == "id" else ""
            names += [mark + _short(n, MAX_NAME) for n in re.sub(r"\d+", "0", a or b or c).split()]
    return " ".join([tag, *[n for n in names if n not in (VARY, MAIN)]])


@lru_cache(maxsize=100_000)
def _fits(pattern: str | None, key: str | None) -> bool:
    """Whether an element's key, or a pattern, is one of a pattern (or the same key)."""
    if pattern == key:
        return True
    if pattern is None or key is None or not pattern.endswith(" " + VARY):
        return False
    tag, *names = pattern.split(" ")
    its_tag, *its = key.split(" ")
    if tag != its_tag or not its or _named(key):
        return False
    return {n for n in names if n not in (VARY, MAIN)} <= set(its) and _likely(key) == _likely(pattern)


def _same(a: str | None, b: str | None) -> bool:
    return a == b or _fits(a, b) or _fits(b, a)


@lru_cache(maxsize=100_000)
def _pattern(a: str | None, b: str | None) -> str | None:
    """The key of both, or None for elements that don't go together: of
    different tags, without names, or where the names tell them apart."""
    if a is None or b is None:
        return None
    (tag, *names), (tag_b, *names_b) = a.split(" "), b.split(" ")
    if tag != tag_b or not names or not names_b or _named(a) or _named(b) or _likely(a) != _likely(b):
        return None
    joint = " ".join([tag, *[n for n in dict.fromkeys(names) if n in names_b and n not in (VARY, MAIN)]])
    if _likely(joint) != _likely(a):
        joint += " " + MAIN
    return f"{joint} {VARY}"


def parse(page: str) -> list:
    """The page as a list of nodes. Elements left open end with their parent;
    an end tag without its start is passed over."""
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]

    def close(tags: set[str], limits: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in limits:
                return

    for m in _TOKEN.finditer(page):
        tag = m["tag"]
        if tag is None:
            s = m.group()
            if s[0] == "<" and len(s) > 1:
                continue  # comments, scripts, declarations
            children = stack[-1][1]
            if children and children[-1][0] is None:
                children[-1][3] += s
                children[-1][4] = len(children[-1][3].strip())
            else:
                children.append([None, ONCE, [], s, len(s.strip()), []])
            continue
        tag = tag.lower()
        if m["end"]:
            if any(t == tag for t, _ in stack):
                close({tag}, set())
            continue
        if tag in _ENDS_P:
            close({"p"}, {"table", "td", "div", "li", "article", "section", "body", "blockquote", "button"} - {tag})
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        node = [_key(tag, m["attrs"]), ONCE, [], None, 0, []]
        stack[-1][1].append(node)
        if tag not in _VOID and not m["attrs"].endswith("/") and len(stack) < MAX_DEPTH:
            stack.append((tag, node[2]))
    return root


# -- wrappers ------------------------------------------------------------------


def _both(a: str, b: str) -> str:
    optional, repeated = {a, b} & {OPTIONAL, ANY}, {a, b} & {REPEATED, ANY}
    return ANY if optional and repeated else OPTIONAL if optional else REPEATED if repeated else ONCE


def _again(mark: str) -> str:
    return ANY if mark in (OPTIONAL, ANY) else REPEATED


def _maybe(node: list) -> list:
    return [node[0], ANY if node[1] in (REPEATED, ANY) else OPTIONAL, *node[2:]]


def _one(a: list, b: list) -> list:
    """Two nodes of the same key as one."""
    seen = a[5] if a[5] == b[5] else sorted({*a[5], *b[5]})[:SEEN]
    if a[0] is None:
        return [None, _both(a[1], b[1]), [], a[3] if a[3] == b[3] else None, a[4] + b[4], seen]
    key = a[0] if _fits(a[0], b[0]) else b[0] if _fits(b[0], a[0]) else _pattern(a[0], b[0])
    return [key, _both(a[1], b[1]), align(a[2], b[2]), None, 0, seen]


def _fold(nodes: list) -> list:
    """Neighbours of the same key become one repeated group; so do runs that
    repeat with one node between them (a b a b)."""
    out: list = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            joint = _one(out[-1], node)
            joint[1] = _again(_both(out[-1][1], node[1])) if node[0] is not None else joint[1]
            out[-1] = joint
        elif len(out) >= 3 and out[-2][0] == node[0] and out[-3][0] == out[-1][0]:
            # a b a + b: the second pair joins the first
            second = out.pop()
            out[-2], out[-1] = _one(out[-2], second), _one(out[-1], node)
            for i in (-2, -1):
                out[i][1] = _again(out[i][1])
        else:
            out.append(node)
    return out


def generalize(nodes: list, digest: int | None = None) -> list:
    """A page's tree as a wrapper: folded from the inside out. Blank text is no token."""
    digest = zlib.crc32(repr(nodes).encode("utf-8", "replace")) if digest is None else digest
    out = []
    for key, mark, children, text, chars, _ in nodes:
        if key is None:
            if chars:
                out.append([None, mark, [], _short(" ".join(text.split()), MAX_TEXT), chars, [digest]])
        else:
            out.append([key, mark, generalize(children, digest), None, 0, [digest]])
    return _few(_fold(out))


def _chars(nodes: list) -> int:
    return sum(n[4] if n[0] is None else 0 if _never(n[0]) else _chars(n[2]) for n in nodes)


def _any_text(nodes: list) -> list:
    """Nodes as one slot of their main text."""
    return [None, ANY, [], None, _chars(nodes), sorted({d for n in nodes for d in n[5]})[:SEEN]]


def _few(nodes: list) -> list:
    """At most MAX_CHILDREN nodes: of more, those of a key become one that may
    come at any place, and keys that few pages have become a slot."""
    if len(nodes) <= MAX_CHILDREN:
        return nodes
    by_key: dict[str | None, list] = {}
    for node in nodes:
        if node[0] in by_key:
            node = _one(by_key[node[0]], node)
        by_key[node[0]] = [node[0], ANY if node[0] is not None else node[1], *node[2:]]
    out = sorted(by_key.values(), key=lambda n: -len(n[5]))
    half = MAX_CHILDREN // 2
    return out if len(out) <= half else [*out[:half], _any_text(out[half:])]


def trim(wrapper: list) -> list:
    """At most MAX_NODES elements, those that more pages have and, of these,
    the outer ones; others become slots of their text."""
    ranks: list[tuple[int, int]] = []

    def count(nodes: list, depth: int) -> None:
        for node in nodes:
            if node[0] is not None:
                ranks.append((-len(node[5]), depth))
                count(node[2], depth + 1)

    count(wrapper, 0)
    if len(ranks) <= MAX_NODES:
        return wrapper
    last, left = sorted(ranks)[MAX_NODES // 2], MAX_NODES // 2

    def cut(nodes: list, depth: int) -> list:
        nonlocal left
        out = []
        for node in nodes:
            if node[0] is None:
                out.append(node)
            elif (-len(node[5]), depth) <= last and left > 0:
                left -= 1
                out.append([*node[:2], cut(node[2], depth + 1), *node[3:]])
            else:
                out.append(_any_text([node]) if _chars([node]) else [node[0], node[1], [], None, 0, node[5]])
        return _few(_fold([n for n in out if n[0] is not None or n[4]]))

    return cut(wrapper, 0)


def align(a: list, b: list) -> list:
    """The wrapper of what either wrapper matches: the longest common
    subsequence of keys stays; of what is between, elements whose names vary
    with the page go together, the rest becomes optional."""
    if [x[0] for x in a] == [y[0] for y in b]:
        return [_one(x, y) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    vary = any(x[0] is not None and x[0].endswith(" " + VARY) for x in (*a, *b))
    equal = [[_same(x[0], y[0]) if vary else x[0] == y[0] for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if equal[i][j] else max(best[i + 1][j], best[i][j + 1])
    out: list = []
    gap: list[tuple[list, bool]] = []  # nodes of neither or one side, in order

    def close_gap() -> None:
        for at, (x, of_a) in enumerate(gap):
            if x is None:
                continue
            other = next((k for k in range(at + 1, len(gap)) if gap[k][0] and gap[k][1] != of_a and _pattern(x[0], gap[k][0][0])), None)
            if other is None:
                out.append(_maybe(x))
            else:
                out.append(_one(x, gap[other][0]))
                gap[other] = (None, of_a)
        gap.clear()

    i = j = 0
    while i < n or j < m:
        if i < n and j < m and equal[i][j]:
            close_gap()
            out.append(_one(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            gap.append((a[i], True))
            i += 1
        else:
            gap.append((b[j], False))
            j += 1
    close_gap()
    return _few(_fold(out))


def expression(wrapper: list) -> str:
    """The wrapper in regular-expression notation."""
    out = []
    for key, mark, children, text, *_ in wrapper:
        one = ("#" if text is None else json.dumps(text)) if key is None else f"<{key}>{expression(children)}</>"
        out.append(f"({one}){mark}" if mark else one)
    return "".join(out)


# -- reading pages -------------------------------------------------------------


@lru_cache(maxsize=100_000)
def _named(key: str) -> bool:
    """Whether the names of a container say that it is no main text."""
    tag, *names = key.split(" ")
    if tag not in _NAMED_TAGS:
        return False
    return any(_NEVER_NAME.fullmatch(n.lstrip("#")) or _told_apart(n) for n in names if not (tag == "section" and n[0] == "#"))


def _told_apart(name: str) -> bool:
    """Whether a part of the name says that the block is no main text."""
    return bool(_NEVER_PART.search(name)) and not _PART_OF_TEXT.search(name)


@lru_cache(maxsize=100_000)
def _surely(key: str) -> bool:
    """Whether a name's part says so: then the block goes on every host."""
    tag, *names = key.split(" ")
    return _named(key) and any(_told_apart(n) for n in names if not (tag == "section" and n[0] == "#"))


def _never(key: str, own: frozenset[str] = frozenset()) -> bool:
    """Whether an element is never main text; ``own`` are keys that only one
    of the host's pages has: such a block belongs to its page."""
    return key.split(" ", 1)[0] in _NEVER_TAGS or _named(key) and key not in own


@lru_cache(maxsize=100_000)
def _likely(key: str) -> int:
    tag, _, names = key.partition(" ")
    if tag in ("article", "main"):
        return 2
    if names.endswith(f"{MAIN} {VARY}") or names.endswith(MAIN):
        return 1
    return 1 if tag in _CONTAINERS and tag not in ("body", "html") and names and _MAIN_NAMES.search(names) else 0


def _n_seen(wrapper: list) -> int:
    """How many different pages the wrapper is of, SEEN at most."""
    return len({d for node in wrapper for d in node[5]})


def own_blocks(wrapper: list) -> frozenset[str]:
    """Keys of named blocks that only one of the host's several pages has. With
    a page alone its names decide, and so do names that are sure."""
    seen: dict[str, set[int]] = {}

    def walk(nodes: list) -> None:
        for node in nodes:
            if node[0] is not None and node[0].split(" ", 1)[0] not in _NEVER_TAGS:
                if _named(node[0]) and not _surely(node[0]):
                    seen.setdefault(node[0], set()).update(node[5])
                walk(node[2])

    walk(wrapper)
    return frozenset(k for k, pages in seen.items() if len(pages) < 2) if _n_seen(wrapper) > 1 else frozenset()


def _by_slots(wrapper: list) -> bool:
    """Whether slots tell main text from the host's own: not on a host of one
    page, of pages without any slot, or of two that are nearly copies."""
    n = _n_seen(wrapper)
    if n < 2:
        return False
    own = own_blocks(wrapper)
    slots, total = _amount(wrapper, True, own), _amount(wrapper, False, own)
    return slots > 0 and (n > 2 or 10 * slots >= total)


def _is_text(text: str | None, optional: bool, slots: bool) -> bool:
    """Whether a text node counts: with ``slots``, one that is the same on every page doesn't."""
    return not slots or text is None or optional


def _amount(nodes: list, slots: bool, own: frozenset[str], optional: bool = False) -> int:
    total = 0
    for key, mark, children, text, chars, _ in nodes:
        maybe = optional or mark in (OPTIONAL, ANY)
        if key is None:
            total += chars if _is_text(text, maybe, slots) else 0
        elif not _never(key, own):
            total += _amount(children, slots, own, maybe)
    return total


def region(wrapper: list) -> tuple[str, ...] | None:
    """The path of keys of the main region: the article or main element with
    most text if it has more than half of it, else the element of a telling name
    with most text if it has two thirds, else the smallest container that has
    nine tenths and every h1 (the outermost of equals with a name). Text that
    is the same on every page of the host doesn't count."""
    found: list[tuple[int, int, int, tuple[str, ...]]] = []
    slots, own = _by_slots(wrapper), own_blocks(wrapper)

    def walk(nodes: list, path: tuple[str, ...], optional: bool) -> tuple[int, int]:
        total = titles = 0
        for key, mark, children, text, chars, _ in nodes:
            maybe = optional or mark in (OPTIONAL, ANY)
            if key is None:
                total += chars if _is_text(text, maybe, slots) else 0
            elif not _never(key, own):
                here = (*path, key)
                inside, titles_inside = walk(children, here, maybe)
                tag = key.split(" ")[0]
                if tag == "h1":
                    titles_inside = inside
                if inside and tag in _CONTAINERS:
                    found.append((_likely(key), inside, titles_inside, here))
                total, titles = total + inside, titles + titles_inside
        return total, titles

    total, titles = walk(wrapper, (), False)
    for level, share in ((2, 1 / 2), (1, 2 / 3)):
        likely = [f for f in found if f[0] == level and f[1] > share * total]
        if likely:
            return max(likely, key=lambda f: (f[1], -len(f[3])))[3]
    whole = [f for f in found if f[1] >= 0.9 * total and f[2] == titles]
    return max(whole, key=lambda f: len(f[3]), default=(0, 0, 0, None))[3]


def _texts(nodes: list) -> set[str]:
    out: set[str] = set()
    for key, _, children, text, chars, _ in nodes:
        if key is None:
            if chars:
                out.add(" ".join(text.split()))
        elif not _never(key):
            out |= _texts(children)
    return out


def constants(wrapper: list, path: tuple[str, ...] | None) -> list[list]:
    """[tag, texts] of the outermost blocks below ``path`` that are on every page
    of the host with the same text, known of hosts with SEEN different pages or
    more. Only blocks before the first slot or after the last one count, and
    none that holds a heading, a list, a table, a quotation or code: between
    slots, and in those, equal text is the article's."""
    found: list[tuple[int, list]] = []  # with the number of slots before
    slots = 0

    def walk(nodes: list, optional: bool, rest: tuple[str, ...]) -> tuple[bool, bool]:
        """Whether all is the same on every page, and whether it can go."""
        nonlocal slots
        same = loose = True
        for key, mark, children, text, *_ in nodes:
            if rest and key != rest[0] or key is not None and _never(key):
                continue
            maybe, at = optional or mark in (OPTIONAL, ANY), len(found)
            if key is None:
                here, free = text is not None, True
                slots += not here
            else:
                here, free = walk(children, maybe, rest[1:])
                tag = key.split(" ")[0]
                free = free and tag not in _TEXT_TAGS
                if not rest and here and free and not maybe and tag in _BLOCKS and (texts := _texts(children)):
                    found[at:] = [(slots, [tag, sorted(texts)])]
            same, loose = same and here and mark in (ONCE, REPEATED), loose and free
        return same, loose

    if path and _n_seen(wrapper) >= SEEN and _by_slots(wrapper):
        walk(wrapper, False, path)
    return [block for before, block in found if before in (0, slots)]


def plan(wrapper: list) -> dict:
    """What reading a page needs of its host's wrapper."""
    path = region(wrapper)
    return {"path": path, "constant": constants(wrapper, path), "own": sorted(own_blocks(wrapper))}


def _collect(nodes: list, out: list[str], constant: dict[str, list[set]], own: frozenset[str]) -> None:
    for key, _, children, text, *_ in nodes:
        if key is None:
            out.append(text)
        elif not _never(key, own):
            tag = key.split(" ", 1)[0]
            if tag in constant and _texts(children) in constant[tag]:
                continue
            gap = tag in _BLOCKS
            if gap:
                out.append("\n")
            _collect(children, out, constant, own)
            if gap:
                out.append("\n")


def _in_region(nodes: list, path: tuple[str, ...], out: list[str], constant: dict[str, list[set]], own: frozenset[str]) -> None:
    for node in nodes:
        if node[0] is None or not _fits(path[0], node[0]):
            continue
        if len(path) == 1:
            _collect([node], out, constant, own)
        else:
            _in_region(node[2], path[1:], out, constant, own)


def read(
    page: str | None, path: tuple[str, ...] | None, constant: list[list] = (), own: frozenset[str] = frozenset()
) -> str:
    """The main text of a page: its host's region without the blocks that are
    the same on every page of the host, or with them where nothing else is
    there; lacking the region, the page's own."""
    if not page:
        return ""
    tree, out = parse(page), []
    if path:
        by_tag: dict[str, list[set]] = {}
        for tag, texts in constant:
            by_tag.setdefault(tag, []).append(set(texts))
        _in_region(tree, path, out, by_tag, own)
        if by_tag and not "".join(out).strip():
            out = []
            _in_region(tree, path, out, {}, own)
    if not "".join(out).strip():
        mine = region(generalize(tree))
        out = []
        if mine:
            _in_region(tree, mine, out, {}, frozenset())
        else:
            _collect(tree, out, {}, frozenset())
    return " ".join(html.unescape("".join(out)).split())


# -- Spark ---------------------------------------------------------------------


def _size(nodes: list) -> int:
    return len(nodes) + sum(_size(n[2]) for n in nodes if n[2])


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to a wrapper for each host of the task."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}
    total = 0

    def give() -> pa.RecordBatch:
        texts = [json.dumps(w, ensure_ascii=False) for w in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"])

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = generalize(parse(page or ""), zlib.crc32((page or "").encode("utf-8", "replace")))
            held[host] = trim(align(held[host], w) if w and held.get(host) else w or held.get(host, []))
            n = 1 + _size(held[host])
            total, sizes[host] = total + n - sizes.get(host, 0), n
            if total > NODES_AT_ONCE:
                yield give()
                held, sizes, total = {}, {}, 0
    if held:
        yield give()


def _align_group(pdf: pd.DataFrame) -> pd.DataFrame:
    texts = sorted(set(pdf["wrapper"]))
    out = json.loads(texts[0])
    for t in texts[1:]:
        w = json.loads(t)
        out = trim(align(out, w)) if out and w else out or w
    first = pdf.iloc[:1].copy()
    first["wrapper"] = json.dumps(out, ensure_ascii=False)
    return first


def host_of(url_col: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): the wrapper of each host, as JSON nodes."""
    partial_ones = importable(pages).select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        _infer, "host string, wrapper string"
    )
    made = partial_ones.withColumn("part", F.spark_partition_id())
    for span in LEVELS:
        group = F.floor(F.col("part") / span).alias("group")
        made = made.groupBy("host", group).applyInPandas(_align_group, "host string, wrapper string, part int")
    return made.select("host", "wrapper").groupBy("host").applyInPandas(_align_group, "host string, wrapper string")


def _regions(host, wrapper):
    w = json.loads(wrapper)
    return ((host, json.dumps(plan(w), ensure_ascii=False), expression(w)),)


@lru_cache(maxsize=1_000)
def _plan(text: str) -> tuple[tuple[str, ...], list[list], frozenset[str]]:
    read_by = json.loads(text)
    return tuple(read_by["path"] or ()), read_by["constant"], frozenset(read_by["own"])


def _reader(key, url, page, path):
    text = read(page, *(_plan(path) if path else (None,)))
    return ((key, url, text, len(text)),)


def _make(fn):
    return fn


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for every page."""
    regions = stage(
        map_rows(
            wrappers(pages, url_col, html_col),
            ["host", "wrapper"],
            T.StructType([T.StructField(c, T.StringType()) for c in ("host", "region", "expression")]),
            partial(_make, _regions),
        ),
        "html-wrappers",
    )
    paths = regions.select("host", F.col("region").alias("__region"))
    side = F.broadcast(paths) if fits_broadcast(paths, BROADCAST_BYTES) else paths
    narrow = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host")
    )
    schema = T.StructType(
        [
            T.StructField(id_col, pages.schema[id_col].dataType),
            T.StructField("url", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    return map_rows(narrow.join(side, "host", "left"), ["id", "url", "html", "__region"], schema, partial(_make, _reader))
