"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

A response gives two records. Both carry ``refers_to`` (the response's record id), the same target URI
and date, and a block digest of their own; the metadata record's JSON block holds the source's WARC
headers, HTTP status line and headers, its digests (as given, and as recomputed) and the links found;
the conversion record's block is the visible text. Record ids derive from the response's id, so a
rerun or a retried task makes the same records. No shuffle: a projection over the responses.

Responses come as a table (record_id, target_uri, warc_date, warc_headers, payload_digest, block) with
``block`` the HTTP response as bytes, from ``read_warc`` or ``responses_of_pages``. ``write_warc``
writes the derived records as .warc.gz files. A given payload digest goes on as it is, and ``digest_ok``
says whether it is that of the payload, with or without the framing of chunked transfer.

Defined cases: a null block is an empty one (no status line, empty text); HTTP heads without an end
are all head; gzip and deflate bodies are decoded, those of unknown or broken codings have no text
(``decoded`` is false in the metadata); bytes are decoded by the declared charset, else UTF-8, with
replacement; a null record id is derived from URI and block digest; repeated rows give repeated records
with equal ids; pages of any length are read whole, in linear time; an empty table gives no rows; other
columns are ignored, but for the ``key``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustloom.llm.html_main import BLOCK
from trustloom.llm.markup import attributes, tokens

SCHEMA = "record_id string, target_uri string, warc_date string, warc_headers string, payload_digest string, block binary"
DERIVED = (
    "record_id string, record_type string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length bigint, block_digest string, source_payload_digest string, digest_ok boolean, http_status int, source_headers string, n_links int, block string"
)
#: Elements whose content is no text of the page; links are read from the others.
_RAW = frozenset("script style noscript template textarea title".split())
_LINKS = frozenset("a link img area iframe".split())
_SIZE = re.compile(rb"\s*([0-9a-fA-F]{1,16})\s*(?:;.*)?\Z", re.S)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order, body."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            headers.append((k.strip(), v.strip()))
    return lines[0], headers, body


def read_html(html: str, base: str) -> tuple[str, list[dict], str | None]:
    """Visible text with one line a block, links, and the title, in one linear pass."""
    blocks: list[list[str]] = [[]]
    links: list[dict] = []
    title = None
    for token in tokens(html, _RAW):
        if type(token) is str:
            blocks[-1].append(token)
            continue
        closing, name, attrs, raw = token
        if raw is not None:
            if name == "title" and title is None:
                title = unescape(raw).strip()
            elif name != "title":
                blocks[-1].append(" ")
            continue
        if name in BLOCK:
            blocks.append([])
        if name in _LINKS and not closing:
            href = next((unescape(v) for k, v in attributes(attrs) if k in ("href", "src")), None)
            if href is not None:
                try:
                    url = urljoin(base, href)
                except ValueError:
                    url = href
                links.append({"path": name, "url": url})
    lines = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x), links, title


def dechunked(body: bytes) -> bytes | None:
    """The body without the framing of chunked transfer; None if it has no such framing."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at, at + 64)
        m = _SIZE.match(body[at:end]) if end >= 0 else None
        if not m:
            return None
        n = int(m[1], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
        if at > len(body) + 2:
            return None


def decoded(body: bytes, encoding: str) -> tuple[bytes, bool]:
    """The body without its content codings, last one first, and whether all of them are known and sound."""
    for name in reversed([x.strip() for x in encoding.lower().split(",") if x.strip()]):
        if name == "identity":
            continue
        try:
            if name in ("gzip", "x-gzip"):
                body = zlib.decompressobj(31).decompress(body)
            elif name == "deflate":
                try:
                    body = zlib.decompress(body)
                except zlib.error:
                    body = zlib.decompress(body, -15)
            else:
                return body, False
        except zlib.error:
            return body, False
    return body, True


def same_digest(given: str, data: bytes) -> bool:
    """Whether a given digest, as base 32 or hex, is that of the data; unknown algorithms and forms are not."""
    name, _, value = given.partition(":")
    try:
        made = hashlib.new(name.strip().lower().replace("-", ""), data).digest()
    except (ValueError, TypeError):
        return False
    value = value.strip()
    return value.upper().rstrip("=") == base64.b32encode(made).decode().rstrip("=") or value.lower() == made.hex()


def derive(record_id: str | None, uri: str | None, date: str | None, warc_headers: str | None, given: str | None, block: bytes | None) -> list[dict]:
    """The metadata and the conversion record of one response."""
    block = block or b""
    source = record_id or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}|{digest(block)}')}>"
    status, headers, body = split_http(block)
    by_name = {k.lower(): v for k, v in headers}
    payload = body
    if "chunked" in by_name.get("transfer-encoding", "").lower():
        plain = dechunked(body)
        payload = body if plain is None else plain  # many crawlers store it unframed under the old header
    content, known = decoded(payload, by_name.get("content-encoding", ""))
    m = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", by_name.get("content-type", ""), re.I)
    try:
        html = content.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        html = content.decode("utf-8", "replace")
    if not known:
        html = ""
    text, links, title = read_html(html, uri or "")
    code = re.match(r"HTTP/\S+\s+(\d{3})", status)
    made = digest(payload)
    meta = {
        "source": {
            "record_id": source, "warc_headers": json.loads(warc_headers) if warc_headers else {}, "block_digest": digest(block), "payload_digest": made, "given_payload_digest": given,
        },
        "http": {"status_line": status, "headers": headers, "decoded": known},
        "html": {"title": title, "links": links},
    }
    blocks = (("metadata", "application/json", json.dumps(meta, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain", text))
    out = []
    for kind, content_type, block_text in blocks:
        data = block_text.encode("utf-8", "replace")
        out.append(
            {
                "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{source}')}>",
                "record_type": kind,
                "refers_to": source,
                "target_uri": uri,
                "warc_date": date,
                "content_type": content_type,
                "content_length": len(data),
                "block_digest": digest(data),
                "source_payload_digest": given or made,
                "digest_ok": given is None or given == made or same_digest(given, payload) or same_digest(given, body),
                "http_status": int(code[1]) if code else None,
                "source_headers": json.dumps(headers, ensure_ascii=False),
                "n_links": len(links),
                "block": data.decode(),
            }
        )
    return out


_NAMES = [f.split()[0] for f in DERIVED.split(", ")]
_KINDS = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[f.split()[1]] for f in DERIVED.split(", ")]


def derivatives(responses: DataFrame, key: str | None = None) -> DataFrame:
    """Two rows a response, columns of ``DERIVED``; ``key`` is a long column to carry first."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, cols = [], [c.to_pylist() for c in part.columns[-6:]]
                for args in zip(*cols, strict=True):
                    rows += derive(*args)
                arrays = [pa.array([r[n] for r in rows], k) for n, k in zip(_NAMES, _KINDS, strict=True)]
                names = list(_NAMES)
                if key:
                    arrays.insert(0, pa.array([k for k in part.column(0).to_pylist() for _ in range(2)], pa.int64()))
                    names.insert(0, key)
                yield pa.RecordBatch.from_arrays(arrays, names)

    wanted = [f.split()[0] for f in SCHEMA.split(", ")]
    return responses.select(*([F.col(key).cast("long").alias(key)] if key else []), *wanted).mapInArrow(run, (f"{key} bigint, " if key else "") + DERIVED)


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """Response records of a (page_id, url, html) table, with page_id; made by expressions."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    h = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("url").cast("string")).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    record_id = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))
    return pages.select(
        "page_id",
        record_id.alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.to_json(F.struct(F.lit("response").alias("WARC-Type"), F.col("url").alias("WARC-Target-URI"), record_id.alias("WARC-Record-ID"))).alias("warc_headers"),
        F.concat(F.lit("sha1:"), F.sha1(html)).alias("payload_digest"),
        F.concat(head, html).alias("block"),
    )


def parse_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of an open WARC file, gzip members or plain, one record in memory at a time."""
    stream = io.BufferedReader(stream) if not isinstance(stream, io.BufferedReader) else stream
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        last = None
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            text = line.decode("utf-8", "replace")
            if text[:1] in " \t" and last:
                headers[last] += " " + text.strip()
            else:
                last, _, v = text.partition(":")
                last = last.strip()
                headers[last] = v.strip()
        n = int(headers.get("Content-Length") or 0)
        yield headers, stream.read(n)


BATCH_BYTES = 16 << 20


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC files; a task reads its files as streams, as gzip does not split."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.string()] * 5 + [pa.binary()]

    def as_batch(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names)

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, p = pafs.FileSystem.from_uri(file)
                rows, size = [], 0
                with fs.open_input_file(p) as f:
                    for h, block in parse_warc(f):
                        if h.get("WARC-Type") != "response":
                            continue
                        rows.append((h.get("WARC-Record-ID"), h.get("WARC-Target-URI"), h.get("WARC-Date"), json.dumps(h), h.get("WARC-Payload-Digest"), block))
                        size += len(block)
                        if size > BATCH_BYTES:
                            yield as_batch(rows)
                            rows, size = [], 0
                yield as_batch(rows)

    files = spark.read.format("binaryFile").load(path).select("path")  # the content column is never read
    return files.repartition(max(1, len(spark.read.format("binaryFile").load(path).inputFiles())), "path").mapInArrow(run, SCHEMA)


def _field(value: str) -> str:
    """A header's value on one line: line breaks as percent escapes."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def as_warc(row: dict) -> bytes:
    """One derived record as a WARC record; a null URI or date has no header."""
    data = row["block"].encode()
    fields = {
        "WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"], "WARC-Refers-To": row["refers_to"], "WARC-Target-URI": row["target_uri"], "WARC-Date": row["warc_date"],
        "WARC-Block-Digest": row["block_digest"], "Content-Type": row["content_type"], "Content-Length": str(len(data)),
    }
    head = ["WARC/1.0", *(f"{k}: {_field(v)}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + data + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str) -> int:
    """Records as .warc.gz files below ``path`` (a URI all machines reach), a gzip member a record, one file a partition.

    Every attempt of a task writes a file of its own aside. The files of the attempts that ended well are
    named to the driver (one row a partition) and moved; those of lost ones are deleted. Returns the records.
    """
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    aside = f"_writing-{uuid.uuid4().hex}"

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(uri)
        name, n = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:8]}.warc.gz", 0
        fs.create_dir(f"{root}/{aside}")
        with fs.open_output_stream(f"{root}/{aside}/{name}", compression=None) as out:
            for batch in batches:
                for r in batch.to_pylist():
                    out.write(gzip.compress(as_warc(r), mtime=0))
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["name", "n"])

    done = records.select(*_NAMES).mapInArrow(run, "name string, n bigint").collect()
    fs, root = pafs.FileSystem.from_uri(uri)
    for r in done:
        if r["n"]:
            fs.move(f"{root}/{aside}/{r['name']}", f"{root}/{r['name']}")
    fs.delete_dir(f"{root}/{aside}")
    return sum(r["n"] for r in done)
