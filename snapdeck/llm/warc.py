"""WARC derivatives (operator 4).

Each response becomes two linked records: a metadata record (title, language,
character set, out-links, and the source's HTTP headers) and a conversion
record (the page as plain text). Both refer to the response by its record id,
target URI and date and carry its payload digest. Record ids are derived from
the response's id, so that a task that runs again makes the same records.

A record is given with its full WARC bytes; with ``compress``, each is a gzip
member of its own. Records of one file may simply be joined.

Defined results: a null page counts as empty; its conversion has an empty
block. A null URL gives an empty target URI. Repeated responses give repeated
records with the same ids. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapdeck.llm._common import map_rows

VERSION = "WARC/1.1"
#: Date of responses that have none.
NO_DATE = "1970-01-01T00:00:00Z"

_HIDE = re.compile(r"(?i)<!--|<(script|style|template|noscript)\b")
_ENDS = {tag: re.compile(rf"(?i)</{tag}\s*+>") for tag in ("script", "style", "template", "noscript")}
_BLOCK = re.compile(
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|"
    r"hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_OPEN_TITLE = re.compile(r"(?i)<title\b[^>]*>")
_CLOSE_TITLE = re.compile(r"(?i)</title")
_OPEN_TAG = re.compile(r"(?i)<(a|html|meta)\b([^>]*)>")
_LANG = re.compile(r"(?i)\blang\s*+=\s*+[\"']?([A-Za-z0-9-]+)")
_CHARSET = re.compile(r"(?i)\bcharset\s*+=\s*+[\"']?([A-Za-z0-9_-]+)")
_HREF = re.compile(r"(?i)\bhref\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")


def _tagged(page: str) -> tuple[str, str]:
    """The page up to its last closing bracket, and the rest. In the first part
    each search for a tag's end finds one, so patterns of tags are linear."""
    at = page.rfind(">") + 1
    return page[:at], page[at:]


def _visible(page: str) -> str:
    """The page without comments, scripts and styles; one left open hides what
    follows. An opening tag's end is looked for once."""
    out, at = [], 0
    while m := _HIDE.search(page, at):
        out.append(page[at : m.start()])
        if m[1] is None:
            end = page.find("-->", m.end())
            at = len(page) if end < 0 else end + 3
        else:
            end = _ENDS[m[1].lower()].search(page, m.end())
            at = end.end() if end else len(page)
        out.append(" ")
    return "".join(out) + page[at:]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {source}')}>"


def plain_text(page: str) -> str:
    """What a reader sees, a line for each block."""
    tagged, rest = _tagged(_visible(page))
    text = html.unescape(_TAG.sub("", _BLOCK.sub("\n", tagged)) + rest)
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def _title(page: str) -> str | None:
    start = _OPEN_TITLE.search(_tagged(page)[0])
    end = start and _CLOSE_TITLE.search(page, start.end())
    return " ".join(html.unescape(page[start.end() : end.start()]).split()) if end else None


def metadata_fields(page: str, http_headers: str) -> str:
    title = _title(page)
    fields = [] if title is None else [("title", title)]
    tags = [(m[1].lower(), m[2]) for m in _OPEN_TAG.finditer(_tagged(page)[0])]
    for name, tag, pattern in (("language", "html", _LANG), ("charset", "meta", _CHARSET)):
        values = (m.group(1) for t, attrs in tags if t == tag and (m := pattern.search(attrs)))
        fields += [(name, v) for v in [next(values, None)] if v]
    for line in http_headers.split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.append((f"http-{name.strip().lower()}", value.strip()))
    links = (m[2] for m in _OPEN_TAG.finditer(_tagged(_visible(page))[0]) if m[1].lower() == "a")
    targets = (m for attrs in links if (m := _HREF.search(attrs)))
    seen = dict.fromkeys(html.unescape(m[1] or m[2] or m[3] or "").strip() for m in targets)
    fields += [("outlink", f"{re.sub(r'\s', '%20', x)} L a/@href") for x in seen if x]
    return "".join(f"{k}: {v}\r\n" for k, v in fields)


def warc_record(headers: list[tuple[str, str]], block: bytes, compress: bool) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    data = f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(data, mtime=0) if compress else data


def derive(source_id, uri, date, http_headers, page, compress: bool) -> list[tuple]:
    """The metadata and the conversion record of a response."""
    uri, date, page = re.sub(r"[\r\n]", "", uri or ""), date or NO_DATE, page or ""
    http_headers = http_headers or ""
    payload = page.encode("utf-8")
    source = digest(payload)
    out = []
    ids = {kind: record_id(kind, source_id) for kind in ("metadata", "conversion")}
    blocks = {
        "metadata": ("application/warc-fields", metadata_fields(page, http_headers)),
        "conversion": ("text/plain; charset=utf-8", plain_text(page)),
    }
    for kind, (content_type, text) in blocks.items():
        block = text.encode("utf-8")
        other = ids["conversion" if kind == "metadata" else "metadata"]
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", ids[kind]),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Refers-To", source_id),
            ("WARC-Refers-To-Target-URI", uri),
            ("WARC-Refers-To-Date", date),
            ("WARC-Concurrent-To", other),
            ("WARC-Source-Payload-Digest", source),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", content_type),
        ]
        out.append(
            (kind, ids[kind], source_id, uri, source, headers[-2][1], len(block), warc_record(headers, block, compress))
        )
    return out


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The records (headers, block) of joined WARC bytes, plain or gzip members."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines)
        n = int(headers["Content-Length"])
        out.append((headers, data[end + 4 : end + 4 + n]))
        at = end + 4 + n + 4
    return out


def _deriver(compress: bool):
    def one(key, source_id, uri, date, http_headers, page):
        return [(key, *r) for r in derive(source_id, uri, date, http_headers, page, compress)]

    return one


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as responses: (id, source_id, uri, date, http_headers, page)."""
    page = F.coalesce(F.col(html_col), F.lit(""))
    seed = F.md5(F.concat_ws(" ", F.lit("response"), F.col(id_col).cast("string"), F.col(url_col)))
    part = lambda a, n: F.substring(seed, a, n)
    return pages.select(
        F.col(id_col).alias("id"),
        F.concat(
            F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">")
        ).alias("source_id"),
        F.col(url_col).alias("uri"),
        F.lit(None).cast("string").alias("date"),
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(page)
        ).alias("http_headers"),
        page.alias("page"),
    )


def derivatives(rows: DataFrame, compress: bool = True) -> DataFrame:
    """Two records for each response: (id, record_type, record_id, refers_to,
    target_uri, source_digest, block_digest, n_bytes, warc)."""
    schema = T.StructType(
        [
            rows.schema["id"],
            *(
                T.StructField(c, T.StringType())
                for c in ("record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest")
            ),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("warc", T.BinaryType()),
        ]
    )
    return map_rows(
        rows, ["id", "source_id", "uri", "date", "http_headers", "page"], schema, partial(_deriver, compress)
    )
