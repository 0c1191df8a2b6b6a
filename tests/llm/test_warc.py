import hashlib
import struct

import pytest
import zstandard

from aerolith.llm import warc

DATE = "2024-01-01T00:00:00Z"


def response(payload="x" * 200, page_id=1, url="http://a/b c\r\n"):
    digest = hashlib.sha256(payload.encode()).hexdigest()
    return warc.make_record(
        {"record_type": "response", "page_id": page_id, "row": 0, "url": url, "payload": payload, "payload_bytes": len(payload.encode()), "payload_digest": digest},
        DATE,
    )


def test_records_come_back(tmp_path):
    records = [response(f"<p>page {i} with some text in it</p>" * (i % 50), i) for i in range(300)]
    path = str(tmp_path / "a.warc.zst")
    warc.write_archive(path, records)
    assert list(warc.read_archive(path)) == records
    raw = open(path, "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    # The dictionary in front is all that a plain decoder needs; there is one frame per record.
    trained = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    rest, frames = raw[8 + size :], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        frames.append(one.decompress(rest))
        rest = one.unused_data
    assert frames == records


def test_archives_without_or_with_compressed_dictionary(tmp_path):
    few = [response()]
    assert warc.make_dictionary(few) == b""
    path = str(tmp_path / "few.warc.zst")
    warc.write_archive(path, few)
    assert list(warc.read_archive(path)) == few
    dictionary = warc.make_dictionary([response(f"page {i} and more of the same", i) for i in range(400)])
    packed = zstandard.ZstdCompressor().compress(dictionary)
    body = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(few[0])
    (tmp_path / "c.warc.zst").write_bytes(struct.pack("<II", 0x184D2A5D, len(packed)) + packed + body)
    assert list(warc.read_archive(str(tmp_path / "c.warc.zst"))) == few


def test_damage_is_noticed(tmp_path):
    good = response()
    assert warc.unpacked(good)["payload"] == "x" * 200
    for bad in (b"", good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"xxx", b"xyx", 1), good.replace(b"WARC-Date", b"X-Date"), good.replace(b"WARC-Type: response", b"WARC-Type: odd")):
        with pytest.raises(ValueError):
            warc.unpacked(bad)
    path = tmp_path / "cut.warc.zst"
    warc.write_archive(str(path), [good] * 3)
    path.write_bytes(path.read_bytes()[:-5])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(str(path)))


def test_revisits_nulls_ties_and_long_payloads(spark, monkeypatch):
    long = "é" * 300_000
    rows = [(5, "u", "a" * 100), (3, None, "a" * 100), (9, "u", "a" * 100), (2, "u", "a" * 99), (1, "u", "a" * 99), (None, "u", "a" * 100), (7, "u", None), (6, "u", ""), (8, "u", long), (8, "u", long)]
    pages = spark.createDataFrame([(*r, "w") for r in rows], "page_id long, url string, html string, row string")
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    got = warc.report(pages).collect()
    assert len(got) == len(rows)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=repr)
    assert kinds == sorted(
        [(3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), (2, "response", None), (1, "response", None), (7, "response", None), (6, "response", None), (8, "response", None), (8, "revisit", 8)],
        key=repr,
    )
    sizes = {r.page_id: (r.payload_bytes, r.payload_digest) for r in got}
    assert sizes[8] == (600_000, hashlib.sha256(long.encode()).hexdigest())
    assert sizes[7] == (0, hashlib.sha256(b"").hexdigest())


def test_payloads_can_be_read_and_empty_tables(spark, folder):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>")], "page_id long, url string, html string")
    row = warc.read_archives(warc.write_archives(pages, folder())).first()
    assert (row.page_id, row.url, row.payload) == (1, "u", "<p>é</p>")
    assert warc.report(pages.limit(0)).count() == 0


def test_folders_with_and_without_scheme(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a", "x" * 200, 5)], "page_id long, url string, html string, row int")
    for folder in (f"{tmp_path}/plain", f"file:{tmp_path}/one", f"file://{tmp_path}/three"):
        manifest = warc.write_archives(pages, folder)
        assert manifest.first().path.startswith("file:/")
        assert [r.page_id for r in warc.read_archives(manifest).collect()] == [1]
    asked = []
    monkeypatch.setattr(warc.fs, "FileSystem", type("Asked", (), {"from_uri": staticmethod(asked.append)}))
    for path in ("s3a://bucket/x", "s3n://bucket/x", "s3://bucket/x", "hdfs://name:8020/x"):
        warc.opened(path)
    assert asked == ["s3://bucket/x"] * 3 + ["hdfs://name:8020/x"]
