"""WARC derivatives: responses to linked metadata and plain-text conversion records.

A response is a row with its identifier, target URI, date and the whole HTTP
block (status line, headers, empty line, body). Each one gives two records:

* ``metadata``: JSON with the source's WARC and HTTP headers, its digests, the
  page's title and its links resolved against the target;
* ``conversion``: the text of the page, in UTF-8.

Both carry ``refers_to``, the response's identifier, the source's target and
date, the source's payload digest, and their own block digest and length. Their
identifiers are derived from the response's, so another run names them alike.
Rows are independent: nothing is shuffled, and work is linear in the page.

Cases: a null block is an empty one (status 0, no text, no links). A null or
empty identifier is derived from target and block. A body that is not text or
HTML by its content type has an empty conversion. Unclosed comments, scripts
and tags run to the end. Repeated rows give repeated records. Columns of the
input other than the named ones are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common

RECORD = ("record_id string, record_type string, refers_to string, target_uri string, date string, content_type string, "
          "content_length bigint, block_digest string, source_digest string, n_links bigint, content binary")
NAMES = [part.split()[0] for part in RECORD.split(", ")]
#: Bytes of content gathered before a batch is handed on.
BATCH_BYTES = 16 << 20

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|head)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|thead|tbody|section|article|aside|nav|header|footer|main|form|"
                    r"figure|figcaption|blockquote|pre|h[1-6]|title|body|html)\b[^>]*(?:>|\Z)", re.I)
_CELL = re.compile(r"</?(?:td|th)\b[^>]*(?:>|\Z)", re.I)
_TAG = re.compile(r"<[a-z/!?][^>]*(?:>|\Z)", re.I)
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
_LINK = re.compile(r"<(a|area|link|img|script|iframe)\b([^>]*)(?:>|\Z)", re.I)
_TARGET = re.compile(r"(?:^|\s)(href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[int, list[list[str]], bytes]:
    """(status, headers, body) of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    parts = lines[0].split(" ", 2)
    if not lines[0].startswith("HTTP/"):
        return 0, [], block
    status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else 0
    return status, [[k.strip(), v.strip()] for k, _, v in (x.partition(":") for x in lines[1:]) if k.strip()], body


def decoded(headers: list[list[str]], body: bytes) -> str | None:
    """The body as text, None if its type is neither text nor HTML."""
    kind = next((v for k, v in headers if k.lower() == "content-type"), "text/html")
    if not re.match(r"\s*(text/|application/xhtml)", kind, re.I):
        return None
    found = _CHARSET.search(kind) or _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        return body.decode(found[1] if found else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(page: str) -> str:
    """Visible text, one line per block, entities resolved."""
    text = _TAG.sub("", _CELL.sub(" ", _BREAK.sub("\n", _HIDDEN.sub(" ", page.replace("\n", " ")))))
    return _LINES.sub("\n", _BLANK.sub(" ", html.unescape(text))).strip(" \n")


def links(page: str, base: str) -> list[dict]:
    out = []
    for tag, attributes in _LINK.findall(re.sub(r"<!--.*?(?:-->|\Z)", "", page, flags=re.S)):
        if found := _TARGET.search(attributes):
            target = html.unescape(found[2] or found[3] or found[4] or "").strip()
            try:
                url = urljoin(base, target)
            except ValueError:
                url = target
            out.append({"path": f"{tag.lower()}@{found[1].lower()}", "url": url})
    return out


def derived(record_id: str, target: str, date: str, block: bytes) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    status, headers, body = split_http(block)
    page = decoded(headers, body)
    title = _TITLE.search(page or "")
    found = links(page or "", target)
    source = digest(body)
    about = {
        "Envelope": {
            "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": record_id, "WARC-Target-URI": target,
                                     "WARC-Date": date, "WARC-Block-Digest": digest(block), "WARC-Payload-Digest": source,
                                     "Content-Length": str(len(block))},
            "Payload-Metadata": {"HTTP-Response-Metadata": {
                "Response-Message": {"Status": status}, "Headers": headers, "Entity-Length": len(body),
                "HTML-Metadata": {"Title": html.unescape(title[1]).strip() if title else None, "Links": found}}}}}
    made = []
    for kind, form, content in (("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode()),
                                ("conversion", "text/plain", (plain_text(page) if page else "").encode("utf-8", "replace"))):
        own = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{kind}').urn}>"
        made.append((own, kind, record_id, target, date, form, len(content), digest(content), source, len(found), content))
    return made


def responses(pages: DataFrame, url: str = "url", body: str = "html", key: str = "page_id", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records for rows that hold a URL and an HTML body; ``key`` goes into the identifier and stays."""
    target, page = F.coalesce(F.col(f"`{url}`"), F.lit("")), F.coalesce(F.col(f"`{body}`"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.length(page).cast("string"), F.lit("\r\n\r\n"))
    name = F.md5(F.concat_ws("|", F.col(f"`{key}`").cast("string"), target).cast("binary"))
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(F.col(f"`{key}`").alias("key"), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
                        target.alias("target_uri"), F.lit(date).alias("date"), F.concat(head.cast("binary"), page).alias("block"))


def derive(records: DataFrame, record_id: str = "record_id", target_uri: str = "target_uri", date: str = "date",
           block: str = "block", key: str | None = None) -> DataFrame:
    """Two records per response; ``key`` names a column to carry along."""
    cols = {"id": record_id, "target": target_uri, "date": date, "block": block} | ({"key": key} if key else {})
    rows = common.narrow(records, **cols)
    schema = RECORD + (f", key {dict(rows.dtypes)['_key']}" if key else "")
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batch):
        made, size, keys = [], 0, []
        for i in range(batch.num_rows):
            name, target, when, data = (batch.column(j)[i].as_py() for j in range(4))
            data, target = bytes(data or b""), target or ""
            name = name or f"<{uuid.uuid5(uuid.NAMESPACE_URL, target + digest(data)).urn}>"
            two = derived(name, target, when or "", data)
            made += two
            keys += [i] * len(two)
            size += sum(len(r[-1]) for r in two)
            if size >= BATCH_BYTES or i == batch.num_rows - 1:
                arrays = [pa.array(list(x), k) for x, k in zip(zip(*made), kinds)]
                if key:
                    arrays.append(batch.column(4).take(pa.array(keys)))
                yield pa.RecordBatch.from_arrays(arrays, NAMES + (["key"] if key else []))
                made, size, keys = [], 0, []

    return common.map_arrow(rows, run, schema)


def serialised(record: dict) -> bytes:
    """One record as a gzip member; members written one after another are a WARC file."""
    head = [("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]),
            ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["date"]), ("WARC-Block-Digest", record["block_digest"]),
            ("X-Source-Payload-Digest", record["source_digest"]), ("Content-Type", record["content_type"]),
            ("Content-Length", str(record["content_length"]))]
    data = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v) + "\r\n"
    return gzip.compress(data.encode() + record["content"] + b"\r\n\r\n", mtime=0)


def members(records: DataFrame) -> DataFrame:
    """``records`` with ``member``, the bytes of each one in a compressed WARC file."""
    rows = records.select(*NAMES)

    def run(batch):
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([serialised(r) for r in part.to_pylist()], pa.binary())],
                                             [*NAMES, "member"])

    return common.map_arrow(rows, run, RECORD + ", member binary")


def digests(pages: DataFrame) -> DataFrame:
    """All records derived from ``pages``, with digests in place of their content."""
    made = derive(responses(pages), key="key")
    return made.select(F.col("key").alias("page_id"), *[n for n in NAMES if n != "content"], _sha(F.col("content")).alias("content_sha256"))


def _sha(content: Column) -> Column:
    return F.sha2(content, 256)
