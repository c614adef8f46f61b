"""WARC archives with an index: written by task, read back by coalesced byte ranges.

``write`` puts a record per page into gzip-per-record archives and returns the index (archive, offset, length, url,
digest, page_id). Equal payloads of at least ``min_bytes`` bytes are written once: the page with the largest page_id
is a response, the others are revisit records that refer to it and keep its HTTP headers (Content-Length included)
without the payload. ``read`` takes any rows of an index, sorts them by archive and offset, merges ranges that lie
close together and reads each merged range once.

Archives are named by a fresh id and listed only when closed, so a task that runs again leaves an unlisted file and
never a broken index; the index is cut at once for that reason. Archives go to the shared folder.

A null html is an empty payload, a null url leaves the header out. Of rows that repeat the largest page_id with the
same payload each is a response. A null page_id wins only if all are null. An empty table writes nothing. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.llm.common import cut, partitions, redealt, shared_dir
from wickwork.session import remove_at_exit

ARCHIVE_BYTES, GAP, SPAN = 64 << 20, 64 << 10, 8 << 20
#: Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
INDEX = "archive string, offset long, length long, url string, digest string, page_id long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, revisits: int | None, is_response: bool, date: str) -> bytes:
    name = lambda k: f"<urn:x-page:{'' if k is None else k}>"
    block = HTTP.format(len(payload)).encode() + (payload if is_response else b"")
    head = [("WARC-Type", "response" if is_response else "revisit"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if not is_response:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", name(revisits))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """page_id, url, record_type, payload_digest, payload_bytes, refers_to and payload (None for a revisit) of one record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    number = lambda x: int(x) if (x := x.removeprefix("<urn:x-page:").removesuffix(">")) else None
    said = h["WARC-Payload-Digest"].removeprefix("sha1:")
    response = h["WARC-Type"] == "response"
    if response and (len(payload) != size or digest(payload) != said):
        raise ValueError(f"{h['WARC-Record-ID']}: the payload is damaged")
    return {
        "page_id": number(h["WARC-Record-ID"]), "url": h.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": said,
        "record_type": h["WARC-Type"], "refers_to": number(h["WARC-Refers-To"]) if not response else None, "payload": payload if response else None,
    }


def new_folder(spark: SparkSession) -> str:
    """A folder of its own that goes when the program ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    return folder


def write(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes the records; returns the index. page_id must be of an integer type."""
    if pages.schema["page_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("page_id must be an integer")
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumns({"sha": F.sha1(F.encode("html", "UTF-8")), "size": F.octet_length("html")})
    same = p.where(F.col("size") >= min_bytes).groupBy(F.col("sha").alias("_sha"), F.col("size").alias("_size")).agg(F.max("page_id").alias("first"), F.count("*").alias("c")).where("c > 1")
    same = same.withColumn("_size", redealt(F.col("_size").cast("long")))
    p = p.join(same, (F.col("sha") == F.col("_sha")) & (F.col("size").cast("long") == F.col("_size")), "left")
    p = p.select("page_id", "url", "html", F.col("first").alias("revisits"), (F.col("c").isNull() | F.col("page_id").eqNullSafe(F.col("first"))).alias("is_response"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        out = path = None
        rows: list[tuple] = []

        def listed() -> pa.RecordBatch:
            out.close()
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ("archive", "offset", "length", "url", "digest", "page_id")
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return batch

        offset = 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    path, offset = f"{at}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                page_id, url, html, revisits, is_response = r
                payload = html.encode("utf-8", "surrogatepass")
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = z.compress(record(page_id, url, payload, revisits, is_response, date)) + z.flush()
                out.write(raw)
                rows.append((path, offset, len(raw), url, digest(payload), page_id))
                offset += len(raw)
                if offset >= archive_bytes:
                    yield listed()
                    out = None
        if out is not None:
            yield listed()

    return cut(p.mapInArrow(run, INDEX))


def ranges(rows: list[tuple[int, int]], gap: int = GAP, span: int = SPAN) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(offset, length, rows) of byte ranges that cover the sorted (offset, length) rows, merged across gaps of at most gap bytes up to span bytes."""
    out: list = []
    for at, n in rows:
        if out and at - (out[-1][0] + out[-1][1]) <= gap and at + n - out[-1][0] <= span:
            first, size, parts = out[-1]
            out[-1] = (first, max(size, at + n - first), parts)
            parts.append((at, n))
        else:
            out.append((at, n, [(at, n)]))
    return out


def read(index: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records that the index rows name, parsed and checked; payload is null for revisits. With payload=False payloads are checked, but don't leave the reading task."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if payload:
        kinds["payload"] = pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            where = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for archive in dict.fromkeys(x[0] for x in where):
                with store.open_input_file(archive) as f:
                    for at, n, parts in ranges(sorted(x[1:] for x in where if x[0] == archive)):
                        f.seek(at)
                        raw = f.read(n)
                        got = [parse(zlib.decompress(raw[x - at : x - at + k], 31)) for x, k in parts]
                        yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], t) for c, t in kinds.items()], list(kinds))

    n = partitions(index.sparkSession)
    rows = index.select("archive", "offset", "length").repartition(n, "archive", F.floor(F.col("offset") / SPAN)).sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, from the archives."""
    folder = folder or new_folder(pages.sparkSession)
    return read(write(pages, folder, **options), folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB SQL for round_trip(pages) with its defaults.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, octet_length(encode(html)) AS n, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS first, count(*) OVER (PARTITION BY html) AS c FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT >> (15 - 5 * j)) & 31) + 1)::INT, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN c = 1 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN c > 1 AND page_id <> first THEN first END AS refers_to
FROM d
"""
