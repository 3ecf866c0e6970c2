"""WARC archives with a two-level capture index.

Writing: one archive per task (rolled at ``max_archive_bytes``), a gzip member per record,
with the records' places returned as rows. Index: the captures are range-partitioned and
sorted by reversed-host key into shard files of compressed blocks; each shard ends with its
sparse block directory (first key and offset of every block). Lookup: range-partitioned keys
find their shard by bisection over the shards' key ranges, bisect the shard's directory, and
read only the blocks they need; captures found are then read by byte range from the archives.

Files are written by tasks under names that no other attempt uses, and only names that a
committed manifest table holds are ever read, so a retried or speculative task does no harm.
Memory per task: one Arrow batch of pages, or one block; what is made of pages and records is
handled by at most BATCH_BYTES of payload at a time, or by one larger payload.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_and_read
from .common import filesystem, shared_folder, slices, small_batches, tidy
from .graph import small

CAPTURE = "key string, url string, page_id bigint, record_type string, archive string, offset bigint, length bigint"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload binary")
_DATE = "1970-01-01T00:00:00Z"
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, port, ``)``, path and query; scheme, user,
    ``www.`` and fragment are left out. Null is the empty key; what cannot be parsed is kept."""
    if not url:
        return ""
    try:
        u = urlsplit(url)
        host, port = u.hostname or "", u.port
    except ValueError:
        return url
    if not host:
        return url
    host = host.removeprefix("www.")
    port = f":{port}" if port and (u.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return f"{','.join(reversed(host.split('.')))}{port}){u.path or '/'}{'?' + u.query if u.query else ''}"


def _record_id(page_id: int | None, digest: str) -> str:
    """Of a page and its payload: rows of one page_id with different payloads are told apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _target(url: str | None) -> list[str]:
    """Header lines for a URL: the bare URI; where it can't stand in a header as it is, its
    percent-encoded form, and the URL itself as JSON in a line of our own. None for null."""
    if url is None:
        return []
    if re.fullmatch("[!-~]+", url):
        return [f"WARC-Target-URI: {url}"]
    uri = quote(url.encode("utf-8", "surrogatepass"), safe="%/:=&?~#+!$,;'@()*[]")
    return [*([f"WARC-Target-URI: {uri}"] if uri else []), f"X-Target-URI-JSON: {json.dumps(url)}"]


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit (``refers_to`` given) has headers in place of the payload."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {_DATE}",
            *_target(url), f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-Id: {'' if page_id is None else page_id}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record's fields; digest and size of a response come from its payload as read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    told = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    out = {"page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None, "url": json.loads(fields["X-Target-URI-JSON"]) if "X-Target-URI-JSON" in fields else fields.get("WARC-Target-URI"),
           "record_type": fields["WARC-Type"], "payload_bytes": told, "payload_digest": digest, "refers_to": None, "payload": None}
    if out["record_type"] == "revisit":
        return out | {"refers_to": int(fields["X-Refers-To-Page-Id"])}
    if len(payload) != told or hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record of page {out['page_id']}")
    return out | {"payload": payload}


def roles(pages: DataFrame, min_revisit_bytes: int = 1000, broadcast_rows: int = 100_000) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Of equal payloads of at least
    ``min_revisit_bytes``, the rows of the largest page_id are responses (all of them, should
    that id be repeated), rows of other or null ids revisit it; if all ids are null, all are
    responses. The join moves no payload unless the repeated digests outgrow ``broadcast_rows``."""
    base = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    base = base.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    heads = (base.where(F.col("size") >= min_revisit_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n"))
             .where((F.col("n") > 1) & F.col("head").isNotNull()).select("digest", "head"))
    heads = small(write_and_read(heads, "repeated-digests"), broadcast_rows)
    other = ~F.col("page_id").eqNullSafe(F.col("head")) & F.col("head").isNotNull()
    return base.join(heads, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("head")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 1000,
                   max_archive_bytes: int = 1_000_000_000, level: int = 6) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a WARC record below ``folder``;
    returns the committed table of captures (CAPTURE)."""
    small_batches(pages.sparkSession, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        out, name, offset = None, "", 0
        for b in (part for whole in batches for part in slices(whole, 2, BATCH_ROWS, BATCH_BYTES)):
            rows: list[tuple] = []
            for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None or offset >= max_archive_bytes:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip.compress(record(page_id, url, payload, digest, refers), level, mtime=0)
                out.write(member)
                rows.append((url_key(url), url, page_id, "response" if refers is None else "revisit", name, offset, len(member)))
                offset += len(member)
            yield _batch(rows, CAPTURE)
        if out is not None:
            out.close()

    return write_and_read(roles(pages, min_revisit_bytes).mapInArrow(tidy(run), CAPTURE), "captures")


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [x.strip().split(" ") for x in ddl.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def build_index(captures: DataFrame, folder: str, block_lines: int = 3000) -> DataFrame:
    """Sort captures by key into shard files below ``folder``, one per range partition; returns
    the committed shard table (shard, first_key, last_key, n_blocks, n_captures). Captures of
    one key may span several shards."""
    shard_ddl = "shard string, first_key string, last_key string, n_blocks bigint, n_captures bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        name, out, offset, directory, held = f"{uuid.uuid4().hex}.idx", None, 0, [], []
        n, last = 0, ""

        def flush() -> None:
            nonlocal out, offset, held, n, last
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
            out.write(data)
            directory.append([held[0][0], offset, len(data)])
            offset, n, last, held = offset + len(data), n + len(held), held[-1][0], []

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(row)
                if len(held) >= block_lines:
                    flush()
        if held:
            flush()
        if out is not None:
            foot = zlib.compress(json.dumps(directory).encode())
            out.write(foot + len(foot).to_bytes(8, "little"))
            out.close()
            yield _batch([(name, directory[0][0], last, len(directory), n)], shard_ddl)

    order = ["key", "page_id", "archive", "offset"]
    columns = [x.strip().split(" ")[0] for x in CAPTURE.split(",")]
    dealt = captures.select(columns).repartitionByRange(*order).sortWithinPartitions(*order)
    return write_and_read(dealt.mapInArrow(tidy(run), shard_ddl), "index-shards")


class Shard:
    """A shard file: its directory in memory, its blocks read on demand (the last one kept)."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.directory = json.loads(zlib.decompress(self.file.read_at(n, size - 8 - n)))
        self.firsts = [d[0] for d in self.directory]
        self.held: tuple[int, list] = (-1, [])

    def block(self, i: int) -> list:
        if self.held[0] != i:
            _, offset, length = self.directory[i]
            self.held = i, [json.loads(x) for x in zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")]
        return self.held[1]

    def find(self, key: str) -> Iterator[list]:
        for i in range(max(0, bisect.bisect_left(self.firsts, key) - 1), len(self.firsts)):
            if self.firsts[i] > key:
                return
            lines = self.block(i)
            at = bisect.bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                yield lines[at]
                at += 1


def lookup(urls: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """All captures (CAPTURE) of the distinct URLs in column ``url``. Null finds the captures
    without a URL. The shard table (a row per shard file) is small and goes to the tasks."""
    known = sorted((r.first_key, r.last_key, r.shard) for r in shards.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        at, held = "", None
        lasts = [s[1] for s in known]
        for b in batches:
            rows = []
            for url, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for first, _, name in known[bisect.bisect_left(lasts, key) :]:
                    if first > key:
                        break
                    if name != at:
                        at, held = name, Shard(fs, f"{root}/{name}")
                    rows += [tuple(x) for x in held.find(key) if x[1] == url]
                    if len(rows) >= 10_000:
                        yield _batch(rows, CAPTURE)
                        rows = []
            yield _batch(rows, CAPTURE)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(u, url_key(u)) for u in b.column(0).to_pylist()], "url string, key string")

    wanted = urls.select("url").distinct().mapInArrow(tidy(keyed), "url string, key string")
    return wanted.repartitionByRange("key", "url").sortWithinPartitions("key", "url").mapInArrow(tidy(run), CAPTURE)


def read_records(captures: DataFrame, folder: str, gap: int = 0, span: int = 1_000_000, task_bytes: int = 16_000_000) -> DataFrame:
    """The records of captures (RECORD), by range reads; neighbours in an archive at most
    ``gap`` bytes apart share one read of at most ``span`` bytes, unpacked record by record. The captures are written to the
    shared folder and dealt out to a task for about every ``task_bytes`` of records, not of pointers."""
    captures = write_and_read(captures.select("archive", "offset", "length"), "wanted-captures")
    total = captures.agg(F.sum("length")).first()[0] or 0
    tasks = min(100_000, int(total // task_bytes) + 1)
    fields = [f.strip().split(" ")[0] for f in RECORD.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        at, file = "", None
        rows, size = [], 0
        for b in batches:
            names, offsets, lengths = (c.to_pylist() for c in b.columns)
            i = 0
            while i < len(names):
                j, end = i + 1, offsets[i] + lengths[i]
                while j < len(names) and names[j] == names[i] and end <= offsets[j] <= end + gap and offsets[j] + lengths[j] - offsets[i] <= span:
                    end = offsets[j] + lengths[j]
                    j += 1
                if names[i] != at:
                    if file is not None:
                        file.close()
                    at, file = names[i], fs.open_input_file(f"{root}/{names[i]}")
                data = file.read_at(end - offsets[i], offsets[i])
                base = offsets[i]
                for k in range(i, j):
                    x = parse(gzip.decompress(data[offsets[k] - base : offsets[k] - base + lengths[k]]))
                    rows.append(tuple(x[f] for f in fields))
                    size += len(x["payload"] or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield _batch(rows, RECORD)
                        rows, size = [], 0
                i = j
        if rows:
            yield _batch(rows, RECORD)

    order = ["archive", "offset"]
    return captures.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(tidy(run), RECORD)


def round_trip(pages: DataFrame, block_lines: int = 3000, min_revisit_bytes: int = 1000) -> DataFrame:
    """Archive every page, index the archives, look every distinct URL up and read what it finds:
    page_id, payload_bytes, payload_digest, record_type, refers_to, url. One row per row of
    ``pages``, repeated rows included; a null html is the empty payload, a null page_id or url
    stays null, an empty table gives none."""
    spark: SparkSession = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    folder = shared_folder(spark, "warc")
    captures = write_archives(pages, folder, min_revisit_bytes)
    shards = build_index(captures, folder, block_lines)
    found = lookup(pages, shards, folder)
    return read_records(found, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
