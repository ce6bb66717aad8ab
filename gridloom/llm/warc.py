"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame that holds the dictionary; every record is one frame. Files are
written to the shared folder through a file system that executors and driver see alike, and only files
of finished tasks enter the manifest, so a lost task leaves nothing that is read. Reading is streamed:
one frame is decoded at a time, headers and lengths are checked, and damage raises WarcError.

Defined results for pages: null html is an empty payload; rows without page_id are written without an
id and are responses; every row that carries the smallest id of its payload is a response, so repeated
rows stay what the first one is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

MAGIC_DICT = 0x184D2A5D
MAGIC_ZSTD = b"\x28\xb5\x2f\xfd"
ROLL = 128 << 20  # bytes of payload after which a task opens another archive
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_REPEATABLE = "warc-concurrent-to"


class WarcError(ValueError):
    pass


@dataclass
class Record:
    """Header names are in lower case; the values of the one that may be repeated are joined by spaces."""

    headers: dict[str, str]
    block: bytes


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324  the format's digest


def encode(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def decode(raw: bytes) -> Record:
    """One record, whole: version, headers once each, length and trailer are checked."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("headers do not end")
    version, *lines = head.decode("utf-8", "strict").split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"not a record: {version[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        key = name.lower()
        if not colon or not name or name != name.strip() or (key in headers and key != _REPEATABLE):
            raise WarcError(f"bad header line {line[:80]!r}")
        headers[key] = f"{headers[key]} {value.strip()}" if key in headers else value.strip()
    if missing := [h for h in _REQUIRED if h not in headers]:
        raise WarcError(f"missing headers {missing}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise WarcError("length of the block is not that of its header")
    return Record(headers, rest[:-4])


def dictionary(samples: list[bytes], size: int = 32 << 10) -> bytes:
    """A dictionary trained on a bounded number of samples, raw content where there are too few."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples)[:size] or b"WARC/1.1\r\n").ljust(8, b"\n")


def leading_frame(words: bytes) -> bytes:
    return struct.pack("<II", MAGIC_DICT, len(words)) + words


def read_archive(f, chunk: int = 1 << 16) -> Iterator[Record]:
    """Records of an open binary file in order."""
    head = f.read(8)
    if len(head) < 8:
        raise WarcError("no leading frame")
    magic, size = struct.unpack("<II", head)
    if magic != MAGIC_DICT:
        raise WarcError("the leading frame holds no dictionary")
    words = f.read(size)
    if len(words) != size:
        raise WarcError("the dictionary is cut off")
    if words.startswith(MAGIC_ZSTD):  # the dictionary itself may be compressed
        words = zstandard.ZstdDecompressor().decompressobj().decompress(words)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
    data = f.read(chunk)
    while data:
        frame, parts = unpack.decompressobj(), []
        try:
            while not frame.eof:
                if not data:
                    raise WarcError("the last frame is cut off")
                parts.append(frame.decompress(data))
                data = frame.unused_data if frame.eof else f.read(chunk)
        except zstandard.ZstdError as e:
            raise WarcError(f"damaged frame: {e}") from e
        yield decode(b"".join(parts))
        data = data or f.read(chunk)


def http(payload: bytes, length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + payload


def page_record(page_id, url, payload: bytes, length: int, digest: str, first) -> bytes:
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    headers = {"WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": "2000-01-01T00:00:00Z", "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{digest}"}
    if url:
        headers["WARC-Target-URI"] = " ".join(url.split())
    if first is not None:
        headers |= {"WARC-Refers-To": name(first), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return encode(headers, http(b"" if first is not None else payload, length))


def _digests(it):
    for b in it:
        data = [(h or "").encode() for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array([sha1(d) for d in data]), pa.array([len(d) for d in data], pa.int64())], names=["page_id", "digest", "length"])


def _write(folder: str, samples: int):
    def run(it):
        where, path = fs.FileSystem.from_uri(folder)
        out = pack = target = None
        n = size = 0
        for b in it:
            rows = b.to_pylist()
            for r in rows:
                if out is None:
                    words = dictionary([(x["html"] or "").encode()[: 16 << 10] for x in rows[:samples]])
                    target = f"{uuid.uuid4().hex}.warc.zst"
                    out = where.open_output_stream(f"{path}/{target}")
                    out.write(leading_frame(words))
                    pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
                    n = size = 0
                data = (r["html"] or "").encode()
                out.write(pack.compress(page_record(r["page_id"], r["url"], data, len(data), sha1(data), r["first"])))
                n, size = n + 1, size + len(data)
                if size >= ROLL:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], names=["file", "records"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([n], pa.int64())], names=["file", "records"])

    return run


def write_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, samples: int = 256) -> tuple[str, DataFrame]:
    """Write all rows; returns the folder and the manifest (file, records). Payloads of ``least`` bytes or
    more that repeat become revisits of the smallest page_id. ``samples`` pages at most train each dictionary."""
    spark = pages.sparkSession
    store.batches(spark, 500)
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    seen = store.table(p.select("page_id", "html").mapInArrow(_digests, "page_id long, digest string, length long"), "digests")
    firsts = seen.where((F.col("length") >= least) & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last")
    # a payload may hold a third of all rows: rows are salted, the repeated payloads are few and copied
    salts = 16
    more = firsts.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    again = seen.where(F.col("length") >= least).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int")).join(more, ["digest", "salt"]).where("page_id > first").select("page_id", "digest", "first").distinct()
    own = F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    joined = p.withColumn("hex", own).join(again.mapInArrow(_hexed, "page_id long, first long, hex string"), ["page_id", "hex"], "left").select("page_id", "url", "html", "first")
    folder = store.new_path(spark, "warc")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    folder = files.makeQualified(path).toString().replace("file:/", "file:///", 1) if files.getScheme() == "file" else files.makeQualified(path).toString()
    return folder, store.table(joined.mapInArrow(_write(folder, samples), "file string, records long"), "manifest")


def _hexed(it):
    for b in it:
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("first"), pa.array([base64.b32decode(d).hex() for d in b.column("digest").to_pylist()], pa.string())], names=["page_id", "first", "hex"])


_READ = "record_id string, record_type string, url string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def _read(folder: str, payloads: bool):
    def run(it):
        where, path = fs.FileSystem.from_uri(folder)
        for b in it:
            for name, records in zip(b.column("file").to_pylist(), b.column("records").to_pylist(), strict=True):
                rows, size, n = [], 0, 0
                with where.open_input_stream(f"{path}/{name}") as f:
                    for r in read_archive(f):
                        n += 1
                        kind, digest = r.headers["warc-type"].lower(), r.headers.get("warc-payload-digest", "").removeprefix("sha1:")
                        payload, told = r.block, len(r.block)
                        if r.headers.get("content-type", "").replace(" ", "").lower().startswith("application/http") and kind in ("response", "revisit"):
                            head, _, payload = r.block.partition(b"\r\n\r\n")
                            told = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
                        if kind != "revisit" and (len(payload) != told or (digest and sha1(payload) != digest)):
                            raise WarcError(f"{name}: payload of {r.headers['warc-record-id']} is not that of its headers")
                        rows.append((r.headers["warc-record-id"], kind, r.headers.get("warc-target-uri"), r.headers.get("warc-refers-to"), digest or sha1(payload), told, payload if payloads else None))
                        size += len(payload)
                        if len(rows) >= 2000 or size > 32 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if n != records:
                    raise WarcError(f"{name} has {n} records and not {records}")
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in _READ.split(", ")])


def read_pages(folder: str, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of all archives of the manifest; a revisit has an empty payload and the length of the full one."""
    parts = max(4, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(parts, "file").mapInArrow(_read(folder, payloads), _READ)


def query(spark, sf_dir: str) -> DataFrame:
    r = read_pages(*write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")), payloads=False)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return r.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"))
