"""Operator 10: WARC archives with a two-level capture index.

Writing: every page becomes one WARC/1.1 record; Spark's text writer writes the records of a task
to archive files, the record separator being its line separator, so a failed task's files are never
committed. Pages are written by classes of size (``CLASSES``), each with as many records per file as fit
``PER_FILE`` bytes at the class's largest size, so no file's payloads exceed ``PER_FILE`` bytes unless
it is a single record. Of records with equal payloads of at
least ``least_bytes`` bytes the one with the largest page id is the response, the others are
revisit records without the payload; found by one aggregate over digests.

Index: the archives are scanned; each record's entry (reversed-host URL key, page id, file, offset,
length, type) is range-sorted by key; ``PER_BLOCK`` entries at a time are compressed into a block,
and a sparse directory keeps each block's first and last key. A lookup deals its keys to segments of
the directory (``PER_SEGMENT`` blocks; only the segments' first and last keys pass the driver, a row per
``PER_SEGMENT * PER_BLOCK`` captures), searches each segment binarily in the tasks, decompresses just the blocks it names, searches in them binarily, and reads just the
byte ranges found. (Spark's file readers give Python whole files, so in the bulk read a range is cut
from an archive file, whose size is bounded.)

Defined results: NULL html is the empty payload; a NULL url has the empty key and no target URI;
a NULL page id is kept as NULL and is the response only if no equal payload has an id; rows that
repeat page id and payload are responses or revisits alike, once each; line breaks and other
control characters in a url are percent-encoded in the record; an empty table writes an archive
without records.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm.common import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, cut_lineage, map_batches, map_sorted_groups, pick, table
from voltframe.session import table_path

PER_FILE, PER_BLOCK, SEGMENT_BITS = 4 << 20, 256, 9
PER_SEGMENT = 1 << SEGMENT_BITS
#: Largest payload of each class of size; what is larger has a file of its own.
CLASSES = (4 << 10, 64 << 10, 1 << 20, PER_FILE)
LEAST_BYTES = 0
WARC_DATE = "2024-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: every five hex digits are four base32 letters."""
    hexed, parts = F.sha1(payload), []
    for i in range(8):
        v = F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(_BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest (``com,example,www)/path``)."""
    m = re.match(r"(?s)[^:/?#]*://([^/?#]*)(.*)", url or "")
    if not m:
        return url or ""
    host = m[1].rpartition("@")[2].lower()
    name, _, port = host.partition(":")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port else "") + ")" + (m[2] or "/")


def _key(url: str | None, page_id: int | None) -> str:
    """Index key: the URL's sort key, a tab, and the page id (so that every capture has its own)."""
    return f"{surt(url)}\t{'' if page_id is None else f'{page_id + 2**63:020d}'}"


def _plain(url: Column) -> Column:
    for code in (*range(0x20), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def write(pages: DataFrame, least_bytes: int = LEAST_BYTES, path: str | None = None) -> str:
    """Write ``pages(page_id, url, html)`` as WARC files; the folder's path."""
    path = path or table_path(pages.sparkSession, "warc")
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", _plain(F.col("url")).alias("url"), body.alias("html"), base32_sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    seen = cut_lineage(rows.groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n")), "digests")
    kind = F.lit(0)
    for c in CLASSES:
        kind = kind + (F.col("size") > c).cast("int")
    kinds = sorted(r.kind for r in seen.select(kind.alias("kind")).distinct().collect()) or [0]
    again = broadcast_if_small(cut_lineage(seen.where((F.col("n") > 1) & (F.col("size") >= least_bytes)).select("digest", "size", "first"), "repeated"), BROADCAST_ROWS // 8)
    rows = rows.join(again, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    header = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise(F.lit(""))
    block = F.when(revisit, F.lit(_HTTP)).otherwise(F.concat(F.lit(_HTTP), F.col("html")))
    number = F.sha1(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("digest")).cast("binary"))
    uuid = F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(number, a, n)]], F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.lit(f"\r\nWARC-Date: {WARC_DATE}\r\n"),
        header("WARC-Record-ID", uuid), header("WARC-Target-URI", F.col("url")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("X-Page-Id", F.col("page_id")), header("X-Payload-Length", F.col("size")), header("X-Refers-To-Page-Id", F.when(revisit, F.col("first"))),
        header("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        header("Content-Length", F.octet_length(block)), F.lit("\r\n"), block)
    out = rows.select(kind.alias("kind"), record.alias("value"))
    for k in kinds:
        per_file = PER_FILE // CLASSES[k] if k < len(CLASSES) else 1
        out.where(F.col("kind") == k).select("value").write.mode("append").option("lineSep", _END).option("maxRecordsPerFile", per_file).text(path)
    return path


def records(data: bytes) -> Iterator[tuple[int, int, dict]]:
    """Offset, length and headers of the records of an archive file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8", "surrogatepass").split("\r\n")[1:])
        length = end + 4 - at + int(head["Content-Length"])
        yield at, length, head
        at += length + len(_END)


def payload(record: bytes) -> bytes:
    """The payload of one record: what follows the HTTP header in its block."""
    return record.split(b"\r\n\r\n", 2)[2]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def index(spark: SparkSession, archive: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, directory) of an archive: compressed sorted blocks of entries, and each block's id,
    first key, last key and number of entries."""
    def scan(b: pa.RecordBatch) -> dict:
        out = []
        for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            for at, length, head in records(data):
                page = int(head["X-Page-Id"]) if "X-Page-Id" in head else None
                out.append((_key(head.get("WARC-Target-URI"), page), path, at, length, head["WARC-Type"]))
        return dict(zip(("key", "file", "at", "length", "type"), map(list, zip(*out)))) if out else {c: [] for c in ("key", "file", "at", "length", "type")}

    entries = cut_lineage(map_batches(_files(spark, archive), scan, "key string, file string, at long, length long, type string"), "captures")

    def pack(batches):
        held: list[dict] = []

        def block():
            names = sorted({r["file"] for r in held})
            lines = [[r["key"], names.index(r["file"]), r["at"], r["length"], r["type"]] for r in held]
            return pa.RecordBatch.from_pydict({"first": [held[0]["key"]], "last": [held[-1]["key"]], "n": [len(held)], "data": [zlib.compress(json.dumps([names, lines]).encode())]},
                                              schema=pa.schema([("first", pa.string()), ("last", pa.string()), ("n", pa.int32()), ("data", pa.binary())]))
        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                if len(held) == PER_BLOCK:
                    yield block()
                    held = []
        if held:
            yield block()

    packed = entries.repartitionByRange("key").sortWithinPartitions("key", "file", "at").mapInArrow(pack, "first string, last string, n int, data binary")
    blocks = cut_lineage(packed.withColumn("block", F.monotonically_increasing_id()), "index-blocks")
    return blocks, cut_lineage(blocks.select("block", "first", "last", "n"), "index-directory")


def _searched(wanted: DataFrame, directory: list, exact: bool) -> DataFrame:
    """(segment, key) for the segments of a sorted directory (at most BROADCAST_ROWS rows) that may
    hold each wanted key, or a key that begins with it."""
    first, last, ids = [r["first"] for r in directory], [r["last"] for r in directory], [r["segment"] for r in directory]
    shared = wanted.sparkSession.sparkContext.broadcast((first, last, ids))

    def run(b: pa.RecordBatch) -> dict:
        first, last, ids = shared.value
        key, segment = [], []
        for k in b.column("key").to_pylist():
            for i in range(bisect_left(last, k), bisect_right(first, k if exact else k + "\U0010ffff")):
                key.append(k)
                segment.append(ids[i])
        return {"key": key, "segment": segment}

    return map_batches(wanted, run, "key string, segment long")


def _blocks_of(directory: DataFrame, wanted: DataFrame, exact: bool) -> DataFrame:
    """(block, key) for the blocks that may hold each of ``wanted(key)``, found in two steps: the keys are
    dealt to segments of the directory, then each segment is searched beside its keys."""
    segment = F.shiftright("block", SEGMENT_BITS)    # blocks are numbered within a range of keys, so a segment's follow one another
    tops = cut_lineage(directory.groupBy(segment.alias("segment")).agg(F.min("first").alias("first"), F.max("last").alias("last")), "index-segments")
    wanted, step, parts = wanted.select("key").distinct(), BROADCAST_ROWS // 8, []
    n = tops.count()
    # segments are searched in ranges of a fixed number of rows, so what is sent out is bounded
    cuts = tops.stat.approxQuantile("segment", [i * step / n for i in range(1, -(-n // step))], 0.0) if n > step else []
    for low, high in zip([-1, *cuts], [*cuts, 2**63 - 1]):
        rows = tops.where((F.col("segment") > int(low)) & (F.col("segment") <= int(high))).orderBy("first", "segment").collect()
        parts.append(_searched(wanted, rows, exact))
    dealt = parts[0]
    for p in parts[1:]:
        dealt = dealt.unionByName(p)
    both = directory.select(segment.alias("segment"), "block", "first", "last").unionByName(dealt, allowMissingColumns=True)

    def find(t: pa.Table) -> dict | None:
        rows = t.to_pylist()
        keys = [r["key"] for r in rows if r["block"] is None]
        held = sorted((r["first"], r["block"], r["last"]) for r in rows if r["block"] is not None)
        first, last = [r[0] for r in held], [r[2] for r in held]
        got = [(held[i][1], k) for k in keys for i in range(bisect_left(last, k), bisect_right(first, k if exact else k + "\U0010ffff"))]
        return dict(zip(("block", "key"), map(list, zip(*got)))) if got else None

    return map_sorted_groups(both, ["segment"], find, "block long, key string")


def lookup(spark: SparkSession, archive: str, blocks: DataFrame, directory: DataFrame, wanted: DataFrame, exact: bool = True) -> DataFrame:
    """Records of ``archive`` for ``wanted(key)``: exact index keys, or (``exact=False``) URL sort
    keys. -> key, page_id, url, record_type, refers_to, payload_length, payload, digest (as read)."""
    asked = _blocks_of(directory, wanted, exact)
    # a block travels once, beside the keys asked of it
    asked = blocks.select("block", "data", F.lit(None).cast("string").alias("key")).unionByName(asked.select("block", F.lit(None).cast("binary").alias("data"), "key"))

    def find(t: pa.Table) -> dict | None:
        wanted = t.column("key").drop_null().to_pylist()
        if not wanted:
            return None
        names, lines = json.loads(zlib.decompress(t.column("data").drop_null()[0].as_py()))
        keys, got = [x[0] for x in lines], set()
        for k in wanted:
            got.update(range(bisect_left(keys, k), bisect_right(keys, k if exact else k + "\U0010ffff")))
        at = sorted(got)
        return {"file": [names[lines[i][1]] for i in at], "at": [lines[i][2] for i in at], "length": [lines[i][3] for i in at], "key": [lines[i][0] for i in at]} if at else None

    ranges = map_sorted_groups(asked, ["block"], find, "file string, at long, length long, key string").distinct()
    per_file = cut_lineage(ranges.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "length", "key"))).alias("ranges"), (F.sum(F.octet_length("key") + 32)).alias("bytes")), "ranges")
    small = (per_file.agg(F.sum("bytes")).first()[0] or 0) <= BROADCAST_BYTES
    per_file = per_file.select("file", "ranges")
    files = _files(spark, archive).join(F.broadcast(per_file) if small else per_file, F.col("path") == F.col("file"))

    def read(b: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("key", "page_id", "url", "record_type", "refers_to", "payload_length", "payload", "digest")}
        for data, ranges in zip(b.column("content").to_pylist(), b.column("ranges").to_pylist()):
            for r in ranges:
                _, _, head = next(records(data[r["at"]:r["at"] + r["length"]]))
                number = lambda name: int(head[name]) if name in head else None
                for c, v in zip(out, (r["key"], number("X-Page-Id"), head.get("WARC-Target-URI"), head["WARC-Type"], number("X-Refers-To-Page-Id"), number("X-Payload-Length"),
                                      payload(data[r["at"]:r["at"] + r["length"]]) if head["WARC-Type"] == "response" else None, head["WARC-Payload-Digest"].removeprefix("sha1:"))):
                    out[c].append(v)
        return out

    return map_batches(files.select("content", "ranges"), read, "key string, page_id long, url string, record_type string, refers_to long, payload_length long, payload binary, digest string")


def keys_of(pages: DataFrame) -> DataFrame:
    """The index keys of ``pages(page_id, url)``."""
    def run(b: pa.RecordBatch) -> dict:
        return {"key": [_key(u, p) for u, p in zip(b.column("url").to_pylist(), b.column("page_id").to_pylist())]}
    return map_batches(pages.select("page_id", _plain(F.col("url")).alias("url")), run, "key string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pick(table(spark, sf_dir, "pages"), page_id="long", url="string", html="string")
    archive = write(pages)
    blocks, directory = index(spark, archive)
    read = lookup(spark, archive, blocks, directory, keys_of(pages))
    # a response's size and digest are those of the bytes read back; a revisit has none and states its original's
    return read.select("page_id", F.when(F.col("record_type") == "response", F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
                       F.when(F.col("record_type") == "response", base32_sha1(F.col("payload"))).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM m"""
