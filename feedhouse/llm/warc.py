"""WARC derivatives: linked metadata and plain-text conversion records from response records.

A record is bytes: the version line, named fields, an empty line, the block, two empty lines. Both derivatives refer
to the response by its id and keep its target and date; the metadata record lists the source's HTTP headers and its
digests, the conversion record holds the text of the page. Ids follow from the response id, so a repeated task makes
the same records.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedhouse.llm.common import arrow_pass

VERSION = b"WARC/1.1"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:feedhouse:warc")

Fields = list[tuple[str, str]]


# --- records ------------------------------------------------------------------------------------------------------


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join(map(str, parts)))}>"


def one_line(value: str) -> str:
    """A field value must not break the header: line ends and other controls become spaces."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def to_bytes(fields: Fields, block: bytes) -> bytes:
    head = "".join(f"{k}: {one_line(v)}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_fields(head: bytes) -> Fields:
    """Named fields in order; a line that starts with white space goes on with the field before it."""
    out: list[tuple[str, list[str]]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1][1].append(line.strip())
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), [value.strip()]))
    return [(name, " ".join(values)) for name, values in out]


def parse(record: bytes) -> tuple[Fields, bytes]:
    """Fields and block; ValueError if it is no whole record."""
    version, _, rest = record.partition(b"\r\n")
    head, gap, tail = rest.partition(b"\r\n\r\n")
    if not version.startswith(b"WARC/") or not gap:
        raise ValueError("no WARC record")
    fields = parse_fields(head)
    size = int(first(fields, "Content-Length") or -1)
    if not 0 <= size <= len(tail):
        raise ValueError("the block is cut off")
    return fields, tail[:size]


def first(fields: Fields, name: str) -> str | None:
    return next((v for k, v in fields if k.lower() == name.lower()), None)


def http_parts(block: bytes) -> tuple[str, Fields, bytes]:
    """Status line, headers and payload of an HTTP response; a block without headers is all payload."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, lines = head.partition(b"\r\n")
    return status.decode("utf-8", "replace"), parse_fields(lines), payload


# --- text of a page -----------------------------------------------------------------------------------------------

_BLOCKS = frozenset(
    "p div br hr h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr table section article header footer nav main aside pre blockquote"
    " form figure title body html".split())
# What these hold is not shown. Tags are looked for in those of the second list only: the first hold other languages.
_RAW, _HIDDEN = ("script", "style"), ("noscript", "template", "head")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)")
_HREF = re.compile(r"(?<![\w:-])href\s*=\s*(\"|'|[^\s>\"']+)", re.I)
_LANG = re.compile(r"(?<![\w:-])lang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)
# Not of the web, and slow or failing on any but short texts.
_NO_CHARSETS = ("idna", "punycode", "undefined")
_ZEROS, _LONG_NUMBER = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{9,};?")


def decoded(payload: bytes, content_type: str) -> str:
    found = _CHARSET.search(content_type)
    try:
        charset = codecs.lookup(found[1]).name if found else "utf-8"
        return payload.decode("utf-8" if charset in _NO_CHARSETS else charset, "replace")
    except (LookupError, UnicodeError):
        return payload.decode("utf-8", "replace")


def unescaped(text: str) -> str:
    """Character references replaced; numbers of any length are none of a character, not an error."""
    return html.unescape(_LONG_NUMBER.sub("\ufffd", _ZEROS.sub("&#", text)) if "&#" in text else text)


class Ahead:
    """The next place of a string or pattern in a page. Places asked for only grow, so a page is searched once for each."""

    def __init__(self, page: str):
        self.page = page
        self.found: dict[str, tuple[int, int]] = {}

    def string(self, what: str, at: int) -> int:
        """Where `what` starts next, or the end of the page."""
        if self.found.get(what, (-1, 0))[0] < at:
            place = self.page.find(what, at)
            self.found[what] = (place if place >= 0 else len(self.page), 0)
        return self.found[what][0]

    def closing(self, name: str, at: int) -> tuple[int, int]:
        """Start and stop of the next closing tag of that name, or the end of the page twice."""
        key = "</" + name
        if self.found.get(key, (-1, 0))[0] < at:
            match = re.compile(rf"</{name}\s*>", re.I | re.A).search(self.page, at)
            self.found[key] = match.span() if match else (len(self.page), len(self.page))
        return self.found[key]


@dataclass
class Page:
    text: str = ""
    title: str | None = None
    language: str | None = None
    links: list[str] = field(default_factory=list)


def read_page(page: str) -> Page:
    """Visible text (a line per block, white space drawn together), title, language and links, in one walk over the tags.

    A tag ends at the next `>`, or with the page. Time grows with the length of the page, whatever is left open in it.
    """
    out, shown = Page(), []
    ahead, links = Ahead(page), {}
    at = hidden = 0
    while at < len(page):
        tag = ahead.string("<", at)
        start = max(at, hidden)
        if tag > start:
            shown.append(page[start:tag])
        if tag == len(page):
            break
        if page.startswith("<!--", tag):
            at = ahead.string("-->", tag + 4) + 3
            shown.append(" ")
            continue
        named = _NAME.match(page, tag)
        if not named and page[tag + 1 : tag + 2] not in ("/", "!", "?"):
            if tag >= hidden:
                shown.append("<")
            at = tag + 1
            continue
        stop = ahead.string(">", tag)
        at = stop + 1
        if not named:
            continue
        name = named[1].lower()
        opening = page[tag + 1] != "/"
        if opening and name == "a":
            href = _HREF.search(page, named.end(), stop)
            if href and href[1] in ("'", '"'):
                # The value may hold a `>`; one that nothing closes ends with the tag.
                end = ahead.string(href[1], href.end())
                link = page[href.end() : end if end < len(page) else stop]
                links[link] = None
            elif href:
                links[href[1]] = None
        elif opening and name == "html" and out.language is None:
            found = _LANG.search(page, named.end(), stop)
            out.language = found[1] if found else None
        elif opening and name == "title" and out.title is None and stop < len(page):
            out.title = unescaped(page[stop + 1 : ahead.closing(name, stop + 1)[0]])
        if opening and name in _RAW:
            at = ahead.closing(name, named.end())[1]
            shown.append(" ")
        elif opening and name in _HIDDEN:
            hidden = max(hidden, ahead.closing(name, named.end())[1])
            shown.append(" ")
        elif name in _BLOCKS and tag >= hidden:
            shown.append("\n")
    lines = (" ".join(x.split()) for x in unescaped("".join(shown)).split("\n"))
    out.text = "\n".join(x for x in lines if x)
    out.links = list(dict.fromkeys(map(unescaped, links)))
    return out


# --- operator -----------------------------------------------------------------------------------------------------

DERIVED = ("page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
           "content_type string, content_length bigint, block_digest string, source_payload_digest string, "
           "source_record_digest string, record binary")


def response_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """page_id, record: a response record for every page (page_id, url, html). Null html is an empty page, a null url an
    empty one; equal rows give equal records, an empty table none. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            records = []
            for page_id, url, page in zip(*[c.to_pylist() for c in batch.columns]):
                payload = (page or "").encode()
                block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                         + str(len(payload)).encode() + b"\r\n\r\n" + payload)
                records.append(to_bytes([
                    ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", page_id, url, digest(payload))),
                    ("WARC-Date", date), ("WARC-Target-URI", url or ""),
                    ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                    ("Content-Type", "application/http; msgtype=response")], block))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], names=["page_id", "record"])

    return arrow_pass(pages.select(F.col("page_id").cast("bigint"), "url", "html"), run, "page_id bigint, record binary")


def derived_records(record: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record; none for other or broken records."""
    try:
        fields, block = parse(record)
    except ValueError:
        return []
    if first(fields, "WARC-Type") != "response":
        return []
    source = first(fields, "WARC-Record-ID") or record_id("source", digest(record))
    target, date = first(fields, "WARC-Target-URI") or "", first(fields, "WARC-Date") or ""
    status, headers, payload = http_parts(block)
    payload_digest = first(fields, "WARC-Payload-Digest") or digest(payload)
    block_digest = first(fields, "WARC-Block-Digest") or digest(block)
    page = read_page(decoded(payload, first(headers, "Content-Type") or ""))
    about: Fields = [("source-status", status), *[(f"source-header-{k.lower()}", v) for k, v in headers],
                     ("source-payload-digest", payload_digest), ("source-block-digest", block_digest)]
    if page.title is not None:
        about.append(("title", page.title))
    if page.language:
        about.append(("language", page.language))
    about += [("outlink", x) for x in page.links]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {one_line(v)}\r\n" for k, v in about).encode("utf-8", "replace")),
        "conversion": ("text/plain; charset=utf-8", page.text.encode("utf-8", "replace")),
    }
    out = []
    for kind, (content_type, own) in blocks.items():
        own_id = record_id(kind, source)
        head = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Refers-To", source), ("WARC-Date", date),
                ("WARC-Target-URI", target), ("WARC-Block-Digest", digest(own)), ("Content-Type", content_type)]
        out.append({
            "warc_type": kind, "record_id": own_id, "refers_to": source, "target_uri": target, "warc_date": date,
            "content_type": content_type, "content_length": len(own), "block_digest": digest(own),
            "source_payload_digest": payload_digest, "source_record_digest": block_digest,
            "record": to_bytes(head, own)})
    return out


def derive(responses: DataFrame) -> DataFrame:
    """DERIVED: two rows for each response record of (page_id, record); null, other and broken records give none.

    Repeated rows give repeated rows, with the same ids. Pages are taken whole, in time that grows with their length.
    Other columns are not read. An empty table gives an empty result.
    """
    names = [c.split()[0] for c in DERIVED.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("page_id", "content_length") else
                         pa.binary() if n == "record" else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [{"page_id": page_id, **row}
                        for page_id, record in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                        for row in derived_records(record or b"")]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return arrow_pass(responses.select(F.col("page_id").cast("bigint"), "record"), run, DERIVED)


def op2_derivative_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(response_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
