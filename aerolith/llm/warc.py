"""WARC archives with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing. Of records with equal payloads of at least `REVISIT_BYTES` the one with the smallest page_id is the response
(among repeated ids the first row; null ids rank last); the others become revisit records, which carry
the digest and length but no payload. Each task writes archives of about `ARCHIVE_BYTES` before compression, under names nobody
else uses, and reports them in a manifest. Only files of the manifest count, so what a lost or repeated
attempt leaves behind is never read.

Reading. A task opens an archive, loads the dictionary if the file starts with the skippable frame that
marks one, decodes frame by frame, and checks each record: version line, required headers, that block
and record have the stated length, and that the payload has the stated digest. Anything else is an error.
No more than one record is held at a time.

Null html counts as an empty payload, a null url leaves the target out. An empty table gives no archive
and no rows. Archives lie in the shared folder of the cluster (local, HDFS or object store paths that
pyarrow can open); a path without scheme lies where Spark would look for it, in the default file system. The columns of
key, url and body are written, others are not. `report` deletes its archives once they are read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import row_bitmaps, ship_package, stored, with_bit
from aerolith.session import scratch_path
from aerolith.sources.files import delete_path, hadoop_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 * 1024 * 1024
DICTIONARY_BYTES = 16 * 1024
DICTIONARY_SAMPLE = 1024 * 1024  # bytes of an archive's first records that train its dictionary
DICTIONARY_MAGIC = 0x184D2A5D  # fixed value: skippable frame with a dictionary
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"  # fixed value: start of a Zstandard frame
LEVEL = 3
READ_BYTES = 1 << 18
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_HEADER = "WARC-X-Page-Id"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
MANIFEST = "path string, records long, bytes long"
RECORD = "record_id string, page_id long, record_type string, refers_to_record string, payload_bytes long, payload_digest string, url string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it. Hadoop's names of S3 are taken for S3."""
    scheme, found, rest = path.partition(":")
    if not found or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with the scheme of the file system in which Spark would look for it."""
    path, file_system = hadoop_path(spark, folder)
    return file_system.makeQualified(path).toString()


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{row}')}>"


def make_record(row: dict, date: str) -> bytes:
    """A response or revisit record, from the header lines to the two empty lines at the end."""
    revisit = row["record_type"] == "revisit"
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http if revisit else http + (row["payload"] or "").encode("utf-8", "surrogatepass")
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(row["page_id"], row["row"]),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if row["url"] is not None:
        headers["WARC-Target-URI"] = quote(row["url"], safe="".join(map(chr, range(33, 127))))
    if row["page_id"] is not None:
        headers[PAGE_HEADER] = str(row["page_id"])
    if revisit:
        headers["WARC-Profile"] = REVISIT_PROFILE
        headers["WARC-Refers-To"] = record_id(row["first_id"], row["first_row"])
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, bytes]:
    """Headers and block of one record; raises ValueError where the record breaks the rules."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version != VERSION:
        raise ValueError("no WARC record")
    headers = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"no header line: {line[:80]!r}")
        headers[name.decode()] = value.strip().decode()
    missing = [name for name in REQUIRED if name not in headers]
    if missing:
        raise ValueError(f"headers missing: {missing}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes instead of {length}")
    return headers, rest[:length]


def unpacked(raw: bytes) -> dict:
    """What a response or revisit record says about its page, `payload` included."""
    headers, block = parse_record(raw)
    http, found, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not found or len(sizes) != 1:
        raise ValueError("no HTTP response in the block")
    kind, size = headers["WARC-Type"], int(sizes[0])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "revisit":
        if payload or "WARC-Refers-To" not in headers:
            raise ValueError("revisit with a payload or without what it refers to")
    elif kind != "response":
        raise ValueError(f"unexpected record type {kind}")
    elif len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload does not match its length or digest")
    page = headers.get(PAGE_HEADER)
    return {
        "record_id": headers["WARC-Record-ID"],
        "page_id": None if page is None else int(page),
        "record_type": kind,
        "refers_to_record": headers.get("WARC-Refers-To"),
        "payload_bytes": size,
        "payload_digest": digest,
        "url": headers.get("WARC-Target-URI"),
        "payload": None if kind == "revisit" else payload.decode("utf-8", "surrogatepass"),
    }


def make_dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on the first records; empty where they are too few or too alike."""
    samples, size = [], 0
    for record in records:
        if size >= DICTIONARY_SAMPLE:
            break
        samples.append(record[: 64 * 1024])
        size += len(samples[-1])
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_archive(path: str, records: list[bytes]) -> int:
    """One archive file; returns its size."""
    system, where = opened(path)
    dictionary = make_dictionary(records)
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    with system.open_output_stream(where, compression=None) as out:
        if dictionary:
            out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        for record in records:
            out.write(packer.compress(record))
        return out.tell()


def read_archive(path: str) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    system, where = opened(path)
    with system.open_input_stream(where, compression=None) as source:
        ahead = source.read(8)
        trained = None
        if len(ahead) == 8 and struct.unpack("<II", ahead)[0] == DICTIONARY_MAGIC:
            size = struct.unpack("<II", ahead)[1]
            dictionary = source.read(size)
            if len(dictionary) != size:
                raise ValueError("dictionary frame is cut short")
            if dictionary.startswith(FRAME_MAGIC):  # dictionaries may be compressed themselves
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
            trained = zstandard.ZstdCompressionDict(dictionary)
            ahead = b""
        unpacker = zstandard.ZstdDecompressor(dict_data=trained)
        while ahead := ahead or source.read(READ_BYTES):
            frame, parts = unpacker.decompressobj(), []
            while not frame.eof:
                if not ahead:
                    raise ValueError("frame is cut short")
                parts.append(frame.decompress(ahead))
                ahead = frame.unused_data if frame.eof else source.read(READ_BYTES)
            yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write a record per row into `folder`; returns the stored manifest: path, records, bytes."""
    ship_package(pages.sparkSession)
    payload = F.coalesce(F.col("payload"), F.lit(""))
    staged = stored(
        pages.select(
            F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(body).alias("payload"),
            F.monotonically_increasing_id().alias("row"),
        ).select(
            "*",
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.sha2(payload, 256).alias("payload_digest"),
        ),
        "pages",
    )
    narrow = staged.drop("payload").filter(F.col("payload_bytes") >= REVISIT_BYTES)
    rank = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("row"))
    firsts = (
        narrow.groupBy("payload_digest", "payload_bytes")
        .agg(F.min(rank).alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    revisits = stored(
        narrow.join(firsts, ["payload_digest", "payload_bytes"])
        .filter(F.col("row") != F.col("first.row"))
        .select(
            "page_id", "url", "row", "payload_bytes", "payload_digest",
            F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"),
        ),
        "revisits",
    )
    marks = stored(row_bitmaps(revisits.select("row")), "marks")
    responses = with_bit(staged, marks).filter("bit = 0").drop("bit")
    none = F.lit(None).cast("long")
    records = responses.select(
        "*", none.alias("first_id"), none.alias("first_row"), F.lit("response").alias("record_type")
    ).unionByName(
        revisits.select("*", F.lit(None).cast("string").alias("payload"), F.lit("revisit").alias("record_type"))
    )
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    folder = qualified(pages.sparkSession, folder)
    system, where = opened(folder)
    system.create_dir(where, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            packed = write_archive(path, held)
            report = pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([len(held)], pa.int64()), pa.array([packed], pa.int64())],
                ["path", "records", "bytes"],
            )
            held.clear()
            return report

        for batch in batches:
            for row in range(batch.num_rows):
                held.append(make_record(batch.slice(row, 1).to_pylist()[0], date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return stored(records.mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives of a manifest, checked; with `payload` if asked for."""
    names = [field.split(" ")[0] for field in RECORD.split(", ")] + ["payload"] * payloads
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64()}
    schema = pa.schema([(name, kinds.get(name, pa.string())) for name in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, count in zip(batch.column("path"), batch.column("records"), strict=True):
                held, size, seen = [], 0, 0
                for raw in read_archive(path.as_py()):
                    held.append(unpacked(raw))
                    size += len(raw) if payloads else 512
                    seen += 1
                    if size >= ARCHIVE_BYTES // 4:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if seen != count.as_py():
                    raise ValueError(f"{path.as_py()}: {seen} records instead of {count.as_py()}")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    # One small task per few archives, whatever number of files the manifest has.
    spread = manifest.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "path")
    return spread.mapInArrow(read, RECORD + ", payload string" * payloads)


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = scratch_path(pages.sparkSession, "archives")
    records = stored(read_archives(write_archives(pages, folder), payloads=False), "records")
    delete_path(pages.sparkSession, folder)
    responses = records.filter("record_type = 'response'")
    common = ("page_id", "payload_bytes", "payload_digest", "record_type")
    revisits = records.filter("record_type = 'revisit'").join(
        responses.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")),
        "refers_to_record",
    )
    return responses.select(*common, F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select(*common, "refers_to")
    )
