"""WARC derivatives: metadata and plain-text conversion records of web responses."""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"

# HTML elements that begin a new line of text, and those whose content is no text.
BLOCKS = frozenset("""address article aside blockquote body br caption dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul"""
                   .split())
SILENT = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "select")

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(SILENT) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
                     r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.I | re.S)
_ATTRIBUTE = re.compile(r"([a-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def record_id(*parts: str) -> str:
    """A UUID of the parts, the same whenever a job is run again."""
    h = bytearray(hashlib.sha256("\0".join(parts).encode("utf-8", "surrogatepass")).digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x80, h[8] & 0x3F | 0x80
    x = h.hex()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def converted(page: str) -> tuple[str, dict]:
    """Plain text of a page, and what its markup states: title, language, links, meta tags."""
    out: list[str] = []
    facts: dict = {"title": None, "lang": None, "links": [], "meta": {}}
    at, titled = 0, None
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            out.append(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if name in BLOCKS:
            out.append("\n")
        if not name:
            continue
        if name == "title":
            if m["close"] and titled is not None and facts["title"] is None:
                facts["title"] = " ".join(html.unescape("".join(out[titled:])).split())
            titled = None if m["close"] else len(out)
        if m["close"] or "=" not in m["rest"]:
            continue
        given = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(m["rest"])}
        if name == "html":
            facts["lang"] = facts["lang"] or given.get("lang")
        elif name == "a" and "href" in given:
            facts["links"].append(given["href"])
        elif name == "meta" and "content" in given and (key := given.get("name") or given.get("property")):
            facts["meta"].setdefault(key.lower(), given["content"])
    out.append(page[at:])
    lines = (" ".join(line.split()) for line in html.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line), facts


Pairs = list[tuple[str, str]]


def response_of(url: str | None, page: str | None, key: str, date: str = DATE) -> tuple[Pairs, bytes]:
    """The response record of a fetched page: its headers and the HTTP message as block."""
    payload = (page or "").encode("utf-8", "replace")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END.encode() + payload
    return [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url or "")), ("WARC-Date", date),
            ("WARC-Target-URI", url or ""), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))], block


def header_pairs(head: bytes) -> Pairs:
    """Header lines after the first as pairs in their order, repeated ones too; a line that begins with white space continues the last."""
    try:
        text = head.decode("utf-8")
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    out: Pairs = []
    for line in text.split("\n")[1:]:
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def first_of(pairs: Pairs, name: str, default: str | None = None) -> str | None:
    """Value of the first header of a name, in whatever case it is written."""
    return next((v for k, v in pairs if k.lower() == name.lower()), default)


def split_http(block: bytes) -> tuple[Pairs, bytes]:
    """Headers and payload of an HTTP message; a block without an empty line is all headers."""
    head, _, payload = block.partition(END.encode())
    return header_pairs(head), payload


def unchunked(data: bytes) -> bytes:
    """Payload of a chunked message; what is no chunk from some place on is taken as it is."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n", at)
        try:
            size = int(data[at:end].split(b";")[0].strip(), 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            out.append(data[at:])
            break
        if size == 0:
            break
        out.append(data[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


def content(http: Pairs, payload: bytes) -> bytes:
    """The payload without transfer and content codings; one that does not decode, or a coding not known here, leaves it as it is."""
    if "chunked" in (first_of(http, "transfer-encoding") or "").lower():
        payload = unchunked(payload)
    wbits = {"gzip": 31, "x-gzip": 31, "deflate": 47}.get((first_of(http, "content-encoding") or "").strip().lower())
    if wbits is not None:
        for bits in (wbits, -15):
            try:
                return zlib.decompressobj(bits).decompress(payload)
            except zlib.error:
                pass
    return payload


def is_text(kind: str, payload: bytes) -> bool:
    """Whether a payload is text: by its media type, without one by having no null byte near its start."""
    media = kind.split(";")[0].strip().lower()
    if not media:
        return b"\0" not in payload[:1024]
    return media.startswith("text/") or any(x in media for x in ("html", "xml", "json", "javascript"))


def page_text(kind: str, payload: bytes) -> str:
    """A payload as text: by the stated charset, else by that of its markup, else as UTF-8."""
    stated = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I) or re.search(r"<meta[^>]+charset=[\"']?([\w.:-]+)", payload[:1024].decode("latin-1"), re.I)
    try:
        return payload.decode(stated[1] if stated else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derived(headers: Pairs, block: bytes) -> list[tuple[Pairs, bytes]]:
    """The metadata and the conversion record of a response; both refer to it and carry its source headers.

    The metadata state all headers of the source record and of its HTTP message, in order and with repeats. A payload that is no text gives the metadata record alone.
    Absent digests are computed; a record without an id is told by its digest, and one without date or target has none of them.
    """
    http, payload = split_http(block)
    kind = first_of(http, "content-type", "")
    payload_digest = first_of(headers, "WARC-Payload-Digest") or digest(payload)
    source = first_of(headers, "WARC-Record-ID") or record_id("unnamed", digest(block))
    base, date = first_of(headers, "WARC-Target-URI"), first_of(headers, "WARC-Date")
    body = content(http, payload)
    readable = is_text(kind, body)
    page = page_text(kind, body) if readable else ""
    text, facts = converted(page) if "html" in kind.lower() else (page, {"title": None, "lang": None, "links": [], "meta": {}})

    def absolute(link: str) -> str:
        try:
            return urljoin(base or "", link)
        except ValueError:
            return link

    facts["links"] = [absolute(x) for x in facts["links"]]
    text_block = text.encode("utf-8")
    ids = {t: record_id(t, source) for t in ("metadata", "conversion")}
    facts |= {"http": http, "warc": headers, "source_digest": payload_digest, "text_digest": digest(text_block) if readable else None}
    out = []
    for kind_, content_type, own, other in (
            ("metadata", "application/json", json.dumps(facts, ensure_ascii=False, sort_keys=True).encode("utf-8", "replace"), "conversion"),
            ("conversion", "text/plain; charset=utf-8", text_block, "metadata"))[:2 if readable else 1]:
        pairs = [("WARC-Type", kind_), ("WARC-Record-ID", ids[kind_]), ("WARC-Date", date), ("WARC-Target-URI", base),
                 ("WARC-Refers-To", source), ("WARC-Concurrent-To", ids[other] if readable else None),
                 ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(own)),
                 ("Content-Type", content_type), ("Content-Length", str(len(own)))]
        out.append(([(k, v) for k, v in pairs if v is not None], own))
    return out


RECORDS = """page_id long, record_type string, record_id string, refers_to string, target_uri string, source_digest string,
    block_digest string, content_length long, headers array<struct<name: string, value: string>>, block binary"""
_PAIR = pa.struct([("name", pa.string()), ("value", pa.string())])
_RECORD = pa.schema([
    ("page_id", pa.int64()), *[(c, pa.string()) for c in ("record_type", "record_id", "refers_to", "target_uri", "source_digest",
                                                          "block_digest")],
    ("content_length", pa.int64()), ("headers", pa.list_(_PAIR)), ("block", pa.binary())])


def _row(page_id: int | None, headers: Pairs, block: bytes) -> dict:
    """A record as a row; headers that it lacks are null, digests that it lacks are computed."""
    kind = (first_of(headers, "WARC-Type") or "").lower() or None
    source = first_of(headers, "WARC-Source-Payload-Digest") or first_of(headers, "WARC-Payload-Digest")
    if source is None and kind == "response":
        source = digest(split_http(block)[1])
    return {"page_id": page_id, "record_type": kind, "record_id": first_of(headers, "WARC-Record-ID"),
            "refers_to": first_of(headers, "WARC-Refers-To"), "target_uri": first_of(headers, "WARC-Target-URI"), "source_digest": source,
            "block_digest": first_of(headers, "WARC-Block-Digest") or digest(block), "content_length": len(block),
            "headers": [{"name": k, "value": v} for k, v in headers], "block": block}


ROWS = 256


def _records(pages: DataFrame, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = [row for x in batch.slice(at, ROWS).to_pylist() for row in make(x)]
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return pages.mapInArrow(run, RECORDS)


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of fetched pages (page_id, url, html). Null pages are empty payloads, a null url the empty target.

    ``date`` stands in each record, since the pages do not tell when they were fetched.
    """
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    return _records(plain, lambda x: [_row(x["page_id"], *response_of(x["url"], x["html"], str(x["page_id"]), date))])


def derivatives(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response among the records; records of other types give nothing.

    The work is per record: no exchange, whole blocks, memory for a slice of 256 records. Repeated responses give repeated
    records with the same identifiers; an empty payload gives an empty conversion record; an empty table gives no rows.
    """
    own = records.where(F.col("record_type") == "response").select("page_id", "headers", "block")
    return _records(own, lambda x: [_row(x["page_id"], *r) for r in derived([(h["name"], h["value"]) for h in x["headers"]], bytes(x["block"] or b""))])


def lines_of() -> Column:
    """The record's bytes, without the two line ends that close it; its length is stated as it is."""
    given = F.filter("headers", lambda h: F.lower(h["name"]) != "content-length")
    pairs = F.concat(F.transform(given, lambda h: F.concat_ws(": ", h["name"], h["value"])),
                     F.array(F.concat(F.lit("Content-Length: "), F.coalesce(F.octet_length("block"), F.lit(0)).cast("string"))))
    head = F.concat(F.lit("WARC/1.0\r\n"), F.array_join(pairs, "\r\n"), F.lit(END))
    return F.concat(F.to_binary(head, F.lit("utf-8")), F.coalesce("block", F.to_binary(F.lit(""), F.lit("utf-8"))))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as WARC files, one per task; the line separator of the text writer closes each record."""
    records.select(lines_of().cast("string").alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def parse(data: bytes) -> Iterator[tuple[Pairs, bytes]]:
    """Records of an uncompressed WARC file: headers and block of each, by their stated lengths. A record that states none ends where the next begins."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        head_end = data.find(END.encode(), start)
        if head_end < 0:
            return
        headers = header_pairs(data[start:head_end])
        body = head_end + len(END)
        length = first_of(headers, "Content-Length")
        if length is not None and length.isdigit():
            at = body + int(length)
        else:
            following = data.find(END.encode() + b"WARC/", body)
            at = len(data) if following < 0 else following
        yield headers, data[body:at]


def read_warc(spark, path: str) -> DataFrame:
    """Records of WARC files of any kind and origin, plain or compressed with gzip in one member or many; a file is read by one task, so keep files to about a gigabyte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data  # all members
                rows = []
                for record in parse(data):
                    rows.append(_row(None, *record))
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORDS)
