"""WARC archives: writing, and reading by boundary-chain verification.

Writing. Payload digests are grouped first, in a narrow table; of records with equal payloads the one with the
smallest key is a response, the others are revisits that carry headers only. Each task writes archives of bounded
size, one gzip member per record or plain.

Reading. Archives are cut into byte ranges. Each task looks for the record magic in its range and, for each
place that parses as a record, reports the offset and the offset behind the record. A place inside a payload can
look like a record; what is truly a record is what can be reached from offset 0. Pointer jumping finds that in as many
rounds as the logarithm of the longest chain: each round marks what the marked offsets point to and lets every
pointer jump twice as far. Only reachable records are read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, open_folder

ARCHIVE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 23
DATE = "2000-01-01T00:00:00Z"
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http; msgtype=response"
_GZIP_MAGIC = b"\x1f\x8b\x08"
_PLAIN_MAGIC = b"WARC/1."
_END = b"\r\n\r\n"

RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload binary, digest_ok boolean"
)


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record, uncompressed. The block of a revisit ends behind the HTTP headers."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=-._~"))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        source = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers_to}:{digest}")
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{source}>", f"Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: {_HTTP}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def parse_record(data: bytes) -> dict:
    """Headers and payload of one whole record."""
    head, _, block = data.partition(_END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    http, _, payload = block[: int(headers["content-length"])].partition(_END)
    said = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
    revisit = headers.get("warc-type") == "revisit"
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    number = lambda k: int(headers[k]) if k in headers else None
    return {
        "page_id": number("page-id"),
        "url": headers.get("warc-target-uri"),
        "record_type": headers.get("warc-type"),
        "payload_digest": digest if revisit else found,
        "refers_to": number("refers-to-page-id"),
        "payload_bytes": int(said[1]) if revisit and said else len(payload),
        "payload": None if revisit else payload,
        "digest_ok": None if revisit else found == digest,
    }


class Source:
    """Random access to one archive; keeps the bytes of one range and reads on behind it when a record asks for more."""

    def __init__(self, handle, size: int, start: int, end: int):
        self.handle, self.size, self.start = handle, size, start
        handle.seek(start)
        self.data = handle.read(min(end + len(_PLAIN_MAGIC), size) - start)

    def read(self, at: int, n: int) -> bytes:
        n = min(n, self.size - at)
        if at >= self.start and at + n <= self.start + len(self.data):
            return self.data[at - self.start : at - self.start + n]
        self.handle.seek(at)
        return self.handle.read(max(0, n))

    def places(self, magic: bytes, end: int) -> Iterator[int]:
        at = self.data.find(magic)
        while 0 <= at < end - self.start:
            yield self.start + at
            at = self.data.find(magic, at + 1)


def member(source: Source, at: int, keep: bool) -> tuple[bytes, int] | None:
    """Inflate the gzip member at an offset: its content (or the first part of it) and the offset behind it."""
    inflate, out, step, here = zlib.decompressobj(31), [], 1 << 16, at
    try:
        while not inflate.eof:
            chunk = source.read(here, step)
            if not chunk:
                return None
            here += len(chunk)
            got = inflate.decompress(chunk)
            if keep or not out:
                out.append(got)
                if len(got) >= len(_PLAIN_MAGIC) and not out[0].startswith(_PLAIN_MAGIC):
                    return None
    except zlib.error:
        return None
    content = b"".join(out)
    return (content, here - len(inflate.unused_data)) if content.startswith(_PLAIN_MAGIC) else None


def plain(source: Source, at: int, keep: bool) -> tuple[bytes, int] | None:
    """The uncompressed record at an offset, judged by its own headers."""
    head, step = b"", 4096
    while _END not in head:
        if len(head) > 1 << 20 or at + len(head) >= source.size:
            return None
        head += source.read(at + len(head), step)
    head = head[: head.index(_END) + len(_END)]
    said = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", head)
    end = at + len(head) + int(said[1]) + len(_END) if said else source.size + 1
    if end > source.size or source.read(end - len(_END), len(_END)) != _END:
        return None
    return (source.read(at, end - at) if keep else head), end


def payload_groups(pages: DataFrame, scratch: Scratch, at_least: int = 0) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages that revisit another; payloads under ``at_least`` bytes never do."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    digests = scratch.save(pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(html).alias("digest"), F.length(html).alias("n")), "digests")
    long_ = digests.where(F.col("n") >= at_least)
    groups = long_.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("k")).where("k > 1")
    groups = scratch.save(groups.select("digest", "refers_to"), "groups")
    revisits = long_.select("page_id", "digest").join(groups, "digest")
    return revisits.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(
    pages: DataFrame, scratch: Scratch, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES, at_least: int = 0, date: str = DATE
) -> DataFrame:
    """Write one record per row of ``page_id, url, html``; returns the manifest ``path, size, records``.

    A null html is an empty payload, a null page_id or url leaves out its header. Rows that repeat page_id and payload are
    equal records, all responses if their page_id is the smallest. Empty tables give an empty manifest. Other
    columns are ignored.
    """
    folder, name = scratch.path("archives"), "page_id long, url string, html string, refers_to long"
    revisits = payload_groups(pages, scratch, at_least)
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    right = revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to")
    on = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    joined = rows.join(right, on, "left").select(*[c.split()[0] for c in name.split(", ")], F.col("r_digest").isNotNull().alias("revisit"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task, made, sink, at, records, path = TaskContext.get(), [], None, 0, 0, ""
        fs, top = open_folder(folder)
        fs.create_dir(top, recursive=True)
        for row in (r for b in batches for i in range(0, b.num_rows, 64) for r in b.slice(i, 64).to_pylist()):
            if sink is not None and at >= archive_bytes:
                sink.close()
                made.append((f"{folder}/{path}", at, records))
                sink = None
            if sink is None:
                path = f"pages-{task.partitionId():06d}-{len(made):04d}-{task.taskAttemptId()}.warc" + ".gz" * compress
                sink, at, records = fs.open_output_stream(f"{top}/{path}", compression=None), 0, 0
            data = record_bytes(row["page_id"], row["url"], row["html"].encode(), row["refers_to"], row["revisit"], date)
            if compress:
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = deflate.compress(data) + deflate.flush()
            sink.write(data)
            at += len(data)
            records += 1
        if sink is not None:
            sink.close()
            made.append((f"{folder}/{path}", at, records))
        if made:
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["path", "size", "records"])

    return scratch.save(joined.mapInArrow(run, "path string, size long, records long"), "manifest")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of the archives of a folder, listed by Spark, contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select("path", F.col("length").alias("size"))


def _ranges(archives: DataFrame, split_bytes: int) -> DataFrame:
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    cut = archives.where("size > 0").select("path", "size", starts.alias("start"))
    return cut.withColumn("end", F.least(F.col("start") + split_bytes, F.col("size")))


def _opened(path: str):
    fs, inner = open_folder(re.sub("^file:/(?!/)", "file:///", path))
    return fs.open_input_file(inner)


def candidates(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, size, at, next`` of every place that parses as a record, payloads included."""
    ranges = _ranges(archives, split_bytes)
    n = max(1, ranges.count())

    def run(batches) -> Iterator:
        import pyarrow as pa

        for r in (r for b in batches for r in b.to_pylist()):
            magic, parse = (_GZIP_MAGIC, member) if r["path"].endswith(".gz") else (_PLAIN_MAGIC, plain)
            found = []
            with _opened(r["path"]) as handle:
                source = Source(handle, r["size"], r["start"], r["end"])
                for at in source.places(magic, r["end"]):
                    got = parse(source, at, False)
                    if got:
                        found.append((r["path"], r["size"], at, got[1]))
            if found:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["path", "size", "at", "next"])

    return ranges.repartition(n).mapInArrow(run, "path string, size long, at long, next long")


def reachable(chain: DataFrame, scratch: Scratch) -> DataFrame:
    """The candidates that a chain of records from offset 0 of their archive leads to, by pointer jumping.

    A chain that breaks off before the end of its archive (cut or damaged files) ends there. The tables of jumps grow with the
    archives and are small on disk only, as paths repeat: they are merged, never broadcast.
    """
    chain = scratch.save(chain, "candidates")
    most = chain.groupBy("path").count().agg(F.max("count")).first()[0] or 0
    state = chain.select("path", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached"))
    rounds = math.ceil(math.log2(most + 1)) if most else 0
    for k in range(rounds):
        hit = state.where("reached").select("path", F.col("jump").alias("at"), F.lit(True).alias("hit"))
        hop = state.select("path", F.col("at").alias("jump"), F.col("jump").alias("far"))
        state = state.join(hop.hint("merge"), ["path", "jump"], "left").join(hit.hint("merge"), ["path", "at"], "left")
        state = state.select("path", "at", F.col("far").alias("jump"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached"))
        state = scratch.save(state, f"jump{k}")
        if k:
            scratch.drop(f"jump{k - 1}")
    return chain.join(state.where("reached").select("path", "at").hint("merge"), ["path", "at"], "left_semi")


def read_records(archives: DataFrame, scratch: Scratch, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the archives, payload included, as ``RECORDS``."""
    good = reachable(candidates(archives, split_bytes), scratch)
    n = max(1, _ranges(archives, split_bytes).count())
    places = good.select("path", "size", "at", "next", F.floor(F.col("at") / split_bytes).alias("range"))
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def run(batches) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        open_: tuple = (None, None)
        rows, held = [], 0
        for r in (r for b in batches for r in b.to_pylist()):
            if open_[0] != r["path"]:
                if open_[1] is not None:
                    open_[1].close()
                open_ = r["path"], _opened(r["path"])
            source = Source(open_[1], r["size"], r["at"], r["next"])
            content, _ = (member if r["path"].endswith(".gz") else plain)(source, r["at"], True)
            rows.append(parse_record(content))
            held += len(content)
            if held > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, k in zip(names, kinds)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, k in zip(names, kinds)], names=names)

    dealt = places.repartition(n, "path", "range").sortWithinPartitions("path", "at").drop("range")
    return dealt.mapInArrow(run, RECORDS)
