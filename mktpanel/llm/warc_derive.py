"""Derivative records of a web archive: metadata and plain text of response records.

``responses`` turns pages into response records (HTTP head and payload with
their digests); ``derive`` gives two records for each of them: a *metadata*
record, JSON with the source record's WARC and HTTP headers, digests, title,
metas and links; and a *conversion* record, the visible text.  Both refer to
the response by WARC-Refers-To, carry its target and date, name each other
by WARC-Concurrent-To, and have digests of their own block.

Record ids are name-based UUIDs of the source id, so reruns agree.  Rows are
independent: nothing is shuffled.

Cases: a null payload counts as empty (no links, empty text); a null target
gives an empty one and links stay relative; a null HTTP head has no fields;
lines of a head without a colon are none; a field that is repeated has the list
of its values in order; folded lines are joined; an optional column
``warc_headers`` has the source record's own header lines, which are all passed
through, those of the other columns first; repeated rows give repeated records; tags, scripts and comments
left open run to the end of the page; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, names that are URLs
FIRST_CAPTURE = 1_700_000_000
VERSION = "WARC/1.0"

# Fixed values of HTML: elements that begin a new line of text.
BLOCKS = ("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure "
          "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table "
          "tbody td tfoot th thead title tr ul").split()
_BLOCK_NAMES = frozenset(BLOCKS)
_INVISIBLE = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_STOPS = re.compile(r"[>'\"]")
# What follows the name of a plain tag.  Every run ends at the next tag or quote, so broken markup takes linear time.
_REST = r"(?:((?:[^<>'\"]++|\"[^\"]*+\"|'[^']*+'){0,8}+)>)?+"
_ANY = re.compile(r"</?([a-z]\w*+)" + _REST, re.I)
_LINKS = re.compile(r"<(a|area|link|img|iframe|script|form)\b" + _REST, re.I)
_META = re.compile(r"<(meta)\b" + _REST, re.I)
_TITLE = re.compile(r"<(title)\b" + _REST, re.I)
_TITLE_END = re.compile(r"</title", re.I)
# All runs of white space within a line but the single blank, which stays as it is.
_GAPS = re.compile(r"(?: [^\S\n]|[^\S\n ])[^\S\n]*+")
_LINES = re.compile(r" ?\n[ \n]*")
_FIELD = re.compile(r"(?<![a-z-])([a-z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ENDS = re.compile(r"\r?\n")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
_TARGETS = {"a": "href", "area": "href", "link": "href", "img": "src", "iframe": "src", "script": "src", "form": "action"}


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(map(str, parts)))}>"


class _Ends:
    """Where tags of a page end, in time linear in the page however its markup is broken.

    A tag ends at the first ``>`` outside quotes.  From the back, each ``>``
    and quote learns which ``>`` a tag that meets it next would end at; this is
    done once a tag asks for it that is not plain.
    """

    def __init__(self, page: str):
        self.page, self.at = page, None

    def _read(self) -> None:
        page = self.page
        self.at = [m.start() for m in _STOPS.finditer(page)]
        self.end = [-1] * (len(self.at) + 1)
        partner = {"'": -1, '"': -1}
        for i in range(len(self.at) - 1, -1, -1):
            stop = page[self.at[i]]
            if stop == ">":
                self.end[i] = self.at[i]
            else:
                closing, partner[stop] = partner[stop], i
                self.end[i] = self.end[closing + 1] if closing >= 0 else -1

    def after(self, start: int) -> int:
        """The position of the ``>`` that ends a tag open at ``start``; -1 if it is never closed."""
        if self.at is None:
            self._read()
        return self.end[bisect_left(self.at, start)]


def _tags(page: str, names: re.Pattern, ends: _Ends) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, lower-case name, what follows the name) of closed tags, left to right."""
    m = names.search(page)
    while m:
        name, rest = m.groups()
        free = m.end()
        if rest is None:
            end = ends.after(free)
            if end >= 0:
                rest, free = page[free:end], end + 1
        if rest is not None:
            yield m.start(), free, name.lower(), rest
        m = names.search(page, free)


def visible_text(page: str) -> str:
    """The text of a page, one line per block; a tag that is never closed is text."""
    page = _INVISIBLE.sub(" ", page)
    parts, at = [], 0
    for start, end, name, _ in _tags(page, _ANY, _Ends(page)):
        if start > at:
            parts.append(page[at:start])
        if name in _BLOCK_NAMES:
            parts.append("\n")
        at = end
    parts.append(page[at:])
    return _LINES.sub("\n", _GAPS.sub(" ", html.unescape("".join(parts)))).strip()


def _fields(tag: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _FIELD.finditer(tag)}


def page_metadata(page: str, base: str) -> dict:
    """Title, metas and links of a page."""
    ends = _Ends(page)
    title = None
    for _, end, _, _ in _tags(page, _TITLE, ends):
        close = _TITLE_END.search(page, end)
        title = page[end:close.start()] if close else None
        break
    links = []
    for _, _, kind, rest in _tags(page, _LINKS, ends):
        url = _fields(rest).get(_TARGETS[kind])
        if url:
            try:
                url = urljoin(base, url.strip())
            except ValueError:
                pass
            links.append({"path": f"{kind.upper()}@/{_TARGETS[kind]}", "url": url})
    return {"Title": html.unescape(title).strip() if title is not None else None,
            "Metas": [_fields(rest) for _, _, _, rest in _tags(page, _META, ends)], "Links": links}


def header_fields(head: str | None) -> list[tuple[str, str]]:
    """The (name, value) fields of header lines, in order; folded lines are joined with a blank."""
    out: list[tuple[str, str]] = []
    for x in _ENDS.split(head or ""):
        if not x.strip():
            continue
        if x[0] in " \t":
            if out:
                out[-1] = (out[-1][0], f"{out[-1][1]} {x.strip()}".strip())
            continue
        name, colon, value = x.partition(":")
        if colon and name.strip():
            out.append((name.strip(), value.strip()))
    return out


def http_head(head: str | None) -> tuple[str, list[tuple[str, str]]]:
    """Status line and fields of an HTTP head."""
    status, *rest = _ENDS.split(head or "", maxsplit=1)
    return status, header_fields("".join(rest))


def as_json(fields: list[tuple[str, str]]) -> dict[str, str | list[str]]:
    """Fields by name in order of first use; one that is repeated, in whatever case, has the list of its values."""
    names: dict[str, str] = {}
    values: dict[str, list[str]] = {}
    for name, value in fields:
        values.setdefault(names.setdefault(name.lower(), name), []).append(value)
    return {name: x[0] if len(x) == 1 else x for name, x in values.items()}


def header_value(value: object) -> str:
    """A value as one header line: control characters, line breaks above all, are percent-encoded."""
    value = str(value)
    return value if value.isprintable() else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _record(kind: str, own: str, other: str, source: dict, content: str, block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Target-URI": source["target_uri"], "WARC-Date": source["date"],
            "WARC-Record-ID": own, "WARC-Refers-To": source["record_id"], "WARC-Concurrent-To": other,
            "WARC-Block-Digest": digest(block), "Content-Type": content, "Content-Length": len(block)}
    return "".join([VERSION, "\r\n", *(f"{k}: {header_value(v)}\r\n" for k, v in head.items()), "\r\n"]).encode() + block + b"\r\n\r\n"


def derived(source: dict) -> list[tuple[str, str, str, bytes, bytes]]:
    """(type, id, block digest, block, record) of the two records of one response."""
    page, base = source["payload"] or "", source["target_uri"]
    meta_id, text_id = record_id(source["record_id"], "metadata"), record_id(source["record_id"], "conversion")
    status, fields = http_head(source["http_head"])
    headers = {"WARC-Type": "response", "WARC-Record-ID": source["record_id"], "WARC-Target-URI": base,
               "WARC-Date": source["date"], "WARC-Refers-To": source["refers_to"],
               "WARC-Block-Digest": source["block_digest"], "WARC-Payload-Digest": source["payload_digest"]}
    known = {name.lower(): name for name in headers}
    for name, value in as_json(header_fields(source.get("warc_headers"))).items():
        name = known.get(name.lower(), name)
        headers[name] = headers.get(name) or value
    envelope = {"Envelope": {
        "WARC-Header-Metadata": headers,
        "Payload-Metadata": {"HTTP-Response-Metadata": {
            "Response-Message": status, "Headers": as_json(fields), "Entity-Length": len(page.encode()),
            "Entity-Digest": source["payload_digest"], "HTML-Metadata": page_metadata(page, base)}}}}
    out = []
    for kind, own, other, content, block in (
            ("metadata", meta_id, text_id, "application/json", json.dumps(envelope, ensure_ascii=False).encode()),
            ("conversion", text_id, meta_id, "text/plain", visible_text(page).encode())):
        out.append((kind, own, digest(block), block, _record(kind, own, other, source, content, block)))
    return out


def responses(pages: DataFrame, first_capture: int = FIRST_CAPTURE) -> DataFrame:
    """Response records of pages (page_id, url, html): one a second from ``first_capture`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, stamp, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = (page or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}"
                rows.append((page_id, record_id(url, page_id, digest(body)), url or "", stamp, None, head,
                             digest(head.encode() + b"\r\n\r\n" + body), digest(body), page))
            kinds = [pa.int64()] + [pa.string()] * 8
            names = ["page_id", "record_id", "target_uri", "date", "refers_to", "http_head", "block_digest",
                     "payload_digest", "payload"]
            cols = zip(*rows, strict=True) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    stamp = F.date_format(F.timestamp_seconds(F.lit(first_capture) + F.coalesce(F.col("page_id"), F.lit(0))),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), stamp, F.col("html").cast("string")) \
                .mapInArrow(run, "page_id long, record_id string, target_uri string, date string, refers_to string, "
                                 "http_head string, block_digest string, payload_digest string, payload string")


def derive(sources: DataFrame) -> DataFrame:
    """Two rows per response: page_id, record_type, record_id, refers_to, target_uri, block_digest, content_length, record."""
    wanted = ["page_id", "record_id", "target_uri", "date", "refers_to", "http_head", "block_digest", "payload_digest",
              "payload", *(["warc_headers"] if "warc_headers" in sources.columns else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
        names = ["page_id", "record_type", "record_id", "refers_to", "target_uri", "block_digest", "content_length",
                 "record"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for source in batch.slice(at, 256).to_pylist():
                    source["target_uri"] = source["target_uri"] or ""
                    rows += [(source["page_id"], kind, own, source["record_id"], source["target_uri"], hashed,
                              len(block), record) for kind, own, hashed, block, record in derived(source)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names)

    return sources.select(*wanted).mapInArrow(
        run, "page_id long, record_type string, record_id string, refers_to string, target_uri string, "
             "block_digest string, content_length long, record binary")
