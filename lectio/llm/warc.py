"""WARC archives of pages, in shards of a fixed order, and their rows read back.

Pages are sorted by page_id and cut into shards where the sum of their payloads passes a multiple of a fixed size, so a shard
holds the same records in every run. Its task writes one gzip member for each record, begins a new file when the next
member would pass the size of a file, and regenerates all headers and digests from the payload. A file is written under a
name of its attempt and renamed when whole; as its bytes do not depend on the run, an attempt that is repeated after a lost
executor gives the same file. Archives exist once the manifest, which lists all files, is renamed to its final name; readers
open nothing that it does not list.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.llm.common import forget, stored, table
from lectio.operators.ordering import sum_before
from lectio.sources.shared import move, shared_dir

WARC_DATE = "2000-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"
FILE_SCHEMA = "shard int, number int, file string, bytes long, records long, sha256 string"
RECORD_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


@dataclass(frozen=True)
class Sizes:
    """file_bytes: compressed, of a file with more than one record. shard_bytes: payload of a shard, as far as there are between
    least_shards and most_shards of them; what most_shards bounds is a list of so many keys that goes to every task."""

    file_bytes: int = 1 << 30
    shard_bytes: int = 256 << 20
    least_shards: int = 200
    most_shards: int = 20_000
    least_bytes: int = 1 << 20

    def shard(self, total: int) -> int:
        return max(min(max(total // self.least_shards, self.least_bytes), self.shard_bytes), -(-total // self.most_shards), 1)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _keys(pages: DataFrame) -> DataFrame:
    """page_id, name (of the payload and its length), url, html, n_bytes."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html.cast("binary"), 256).alias("name"), "url", html.alias("html"), F.octet_length(html).cast("long").alias("n_bytes"))


def _shard_starts(keys: DataFrame, sizes: Sizes) -> list[tuple]:
    """(page_id, name) of the first row of each shard but the first, at most ``most_shards`` of them."""
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    rows = sum_before(keys.select("page_id", "name", "n_bytes"), ["page_id", "name"], "n_bytes", "before")
    first = rows.groupBy(F.floor(F.col("before") / sizes.shard(total)).alias("shard")).agg(F.min(F.struct("page_id", "name")).alias("key"))
    starts = sorted(((r["key"]["page_id"], r["key"]["name"]) for r in first.collect()), key=_place)
    forget(rows)
    return starts[1:]


def _place(key: tuple) -> tuple:
    """The order of (page_id, name), null first."""
    return key[0] is not None, key[0] or 0, key[1]


def _firsts(keys: DataFrame, least: int) -> DataFrame:
    """page_id, name, first: for rows whose payload (of ``least`` bytes or more) occurs more than once, the least page_id with it.

    A payload's rows may be a third of all: the least id is taken per task first, and the join's side of rows can be split.
    """
    several = keys.filter(F.col("n_bytes") >= least).groupBy("name").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("name", "first")
    return keys.select("page_id", "name").join(several, "name").select("page_id", "name", "first")


class _Output:
    """The files of a shard: one is open at a time, and a finished one has its final name."""

    def __init__(self, folder: str, shard: int, most: int):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.most, self.number, self.out, self.done = shard, most, 0, None, []
        self.attempt = uuid.uuid4().hex

    def write(self, member: bytes) -> None:
        if self.out is not None and self.records and self.size + len(member) > self.most:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:05d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary-{self.attempt}-{self.name}"
            self.out, self.size, self.records, self.sum = self.files.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            self._put(_member(_warcinfo(self.name)))
        self._put(member)
        self.records += 1

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.shard, self.number, self.name, self.size, self.records, self.sum.hexdigest()))
            self.out, self.number = None, self.number + 1


def _member(*parts: bytes) -> bytes:
    """A gzip member whose header names neither file nor time."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join([*(z.compress(x) for x in parts), z.flush()])


def _head(fields: list[tuple[str, str | int | None]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def _warcinfo(name: str) -> bytes:
    body = b"software: lectio\r\nformat: WARC File Format 1.1\r\n"
    return _head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("warcinfo", name)), ("WARC-Date", WARC_DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", len(body))]) + body + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, nth: int = 0) -> bytes:
    """The gzip member of a page. A revisit has the HTTP header alone. What a header may not hold in a url is percent-encoded;
    page ids stand in extension fields, and a null one (or url) has no field. ``nth`` tells repeated rows apart."""
    payload_digest = digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = b"" if revisit else payload
    block = hashlib.sha1(http)
    block.update(body)
    target = None if url is None else re.sub(r"[^\x21-\x7e]", lambda m: quote(m[0].encode("utf-8", "surrogatepass")), url)
    head = _head([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, target, payload_digest, nth)), ("WARC-Date", WARC_DATE), ("WARC-Target-URI", target), ("WARC-Page-ID", page_id),
        ("WARC-Profile", IDENTICAL if revisit else None), ("WARC-Refers-To-Page-ID", refers_to if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Block-Digest", f"sha1:{base64.b32encode(block.digest()).decode()}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(http) + len(body)),
    ])
    return _member(head, http, body, b"\r\n\r\n")


def write_archives(pages: DataFrame, folder: str, sizes: Sizes = Sizes(), least_payload: int = 0) -> None:
    """Write pages (page_id, url, html) as WARC files into an empty folder that all executors reach, and commit them.

    A null html is an empty payload. Of equal payloads of at least least_payload bytes the row with the least page_id is the
    response and the others are revisits that refer to it; of repeated rows one is the response; rows without a page_id are
    revisits if any row has one, else all but one of them. Smaller payloads are all responses. A record larger than a file
    has one of its own. Other columns are left out. An empty table gives a manifest of no files. A folder that was committed
    is refused. pyarrow must know the folder's file system (local or shared disks, HDFS, S3, GCS).
    """
    spark = pages.sparkSession
    if _exists(spark, f"{folder}/{MANIFEST}"):
        raise ValueError("these archives were committed before")
    rows = _keys(pages)
    keys = stored(rows.select("page_id", "name", "n_bytes"), "page-keys")
    starts = spark.sparkContext.broadcast(list(map(_place, _shard_starts(keys, sizes))))

    @F.pandas_udf("int")
    def shard(page_id: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(starts.value, _place((None if pd.isna(i) else int(i), x))) for i, x in zip(page_id.astype(object), name)], dtype="int32")

    none = F.lit(None).cast("string")
    known = _firsts(keys, least_payload).select("page_id", "name", F.lit(0).alias("kind"), "first", none.alias("url"), none.alias("html"))
    both = known.unionByName(rows.select("page_id", "name", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("first"), "url", "html"))
    n = len(starts.value) + 1
    dealt = both.withColumn("shard", shard("page_id", "name")).repartitionById(n, F.col("shard")).sortWithinPartitions("shard", "page_id", "name", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = key = None
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "page_id", "name", "kind", "first", "url", "html")]
            for i in range(batch.num_rows):
                number, page_id, name, kind, least, url, html = (c[i].as_py() for c in columns)
                if out is None or out.shard != number:
                    if out is not None:
                        out.close()
                        yield _listed(out.done)
                    out = _Output(folder, number, sizes.file_bytes)
                if key != (page_id, name):
                    key, repeated, first, nth = (page_id, name), False, None, 0
                if kind == 0:
                    repeated, first = True, least
                    continue
                # the rows of a key follow each other, so its first one is the response if it is the one with the least id
                out.write(record(page_id, url, (html or "").encode(), first, repeated and (nth > 0 or page_id != first), nth))
                nth += 1
        if out is not None:
            out.close()
            yield _listed(out.done)

    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1])
    files = dealt.mapInArrow(write, FILE_SCHEMA)
    temporary = f"{folder}/{MANIFEST}-{uuid.uuid4().hex}"
    files.write.json(temporary)
    move(spark, temporary, f"{folder}/{MANIFEST}")
    forget(keys)


def _listed(done: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "number", "file", "bytes", "records", "sha256"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done) if done else [[]] * 6, kinds)], names)


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """shard, number, file, bytes, records, sha256 of the committed files; an error where nothing was committed."""
    return spark.read.schema(FILE_SCHEMA).json(f"{folder}/{MANIFEST}")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one at a time."""
    z, held = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            held.append(z.decompress(data))
            data = z.unused_data if z.eof else b""
            if z.eof:
                yield b"".join(held)
                z, held = zlib.decompressobj(31), []
    if held:
        raise ValueError("a record is cut off")


def parsed(record: bytes) -> dict | None:
    """A record's columns, digests checked; None for those that hold no page."""
    cut = record.index(b"\r\n\r\n") + 4
    fields = dict(x.split(": ", 1) for x in record[: cut - 4].decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    block = memoryview(record)[cut : cut + size]
    if record[cut + size :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    end = record.index(b"\r\n\r\n", cut) + 4 - cut
    http = dict(x.split(": ", 1) for x in bytes(block[: end - 4]).decode().split("\r\n")[1:])
    payload, said = block[end:], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"] or kind == "response" and (digest(payload) != said or len(payload) != int(http["Content-Length"])):
        raise ValueError("a record is not what its header says")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": int(http["Content-Length"]), "payload_digest": said,
        "refers_to": number("WARC-Refers-To-Page-ID"), "payload": bytes(payload) if kind == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row for each page record of the committed files (RECORD_SCHEMA; a revisit's payload is null, others' too unless asked).

    A task reads its files as streams and holds some records at a time. A file that is missing, or whose bytes, records or
    digests are not as listed, is an error.
    """
    files = manifest(spark, folder).select("file", "records", "sha256")
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                total, held, chars, n = hashlib.sha256(), [], 0, 0
                with where.open_input_stream(f"{root}/{row['file']}", compression=None) as stream:
                    for x in members(_Summed(stream, total)):
                        found = parsed(x)
                        if found is None:
                            continue
                        n += 1
                        if not payloads:
                            found["payload"] = None
                        held.append(found)
                        chars += len(found["payload"] or b"")
                        if len(held) >= 5000 or chars >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, kinds)
                            held, chars = [], 0
                if n != row["records"] or total.hexdigest() != row["sha256"]:
                    raise ValueError(f"{row['file']} is not the file that was committed")
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    n = max(1, min(files.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return files.repartition(n, "file").mapInArrow(read, RECORD_SCHEMA)


class _Summed:
    """A stream whose bytes go into a sum as they are read."""

    def __init__(self, stream, total):
        self.stream, self.total = stream, total

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.total.update(data)
        return data


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages, written as archives with their defaults and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html: an empty payload. Rows with null or equal ids: see write_archives(). An empty table gives no rows.
    """
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1) FOR i IN range(32)], '') AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""
