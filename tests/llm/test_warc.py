"""Archives: round trips, other writers' archives, damage."""

import hashlib
import struct
from collections import Counter

import pytest
import zstandard

from toolgauge.llm import files, warc

PAGES = [
    (page, url, html, "a column of another name")
    for page in (None, 1, 2, 30)
    for url in (None, "http://a b\r\nWARC-Type: x")
    for html in ("", None, "é" * 499, "é" * 500, "x" * 999, "y" * 1000, f"own {page} {url} " * 90)
] + [(7, "u", "y" * 1000, "again")] * 3
SCHEMA = "page_id long, url string, html string, payload string"


def test_round_trip(spark, tmp_path):
    spark.createDataFrame(PAGES, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/pages")
    folder = files.new_folder(spark, "warc")
    warc.write_archives(spark.read.parquet(f"{tmp_path}/pages"), folder)
    got = warc.read_archives(spark, folder).collect()
    payloads = [(page, (html or "").encode()) for page, _, html, _ in PAGES]
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (page, len(p), hashlib.sha1(p).hexdigest()) for page, p in payloads
    )
    shared = [r for r in got if r.payload_bytes >= 1000]
    for digest in {r.payload_digest for r in shared}:
        same = [r for r in shared if r.payload_digest == digest]
        (response,) = [r for r in same if r.record_type == "response"]
        assert response.page_id == max((r.page_id for r in same if r.page_id is not None), default=None)
        assert all(r.refers_to_id == response.record_id for r in same if r.record_type == "revisit")
        assert hashlib.sha1(response.payload).hexdigest() == digest
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 1000)
    assert all("\r" not in r.target_uri and " " not in r.target_uri for r in got)


def test_dictionary_is_used():
    records = [warc.record(i, i, "u", f"<html>{i} {'common text ' * (i % 9)}</html>".encode(), None) for i in range(3000)]
    data = warc.archive(records)
    assert struct.unpack_from("<I", data)[0] == warc.SKIPPABLE
    found = list(warc.frames(data))
    assert [content for _, content in found] == records
    with pytest.raises(zstandard.ZstdError):  # a frame cannot be read without it
        zstandard.ZstdDecompressor().decompress(data[found[5][0] : found[6][0]])


def test_raw_dictionary_and_none():
    records = [warc.record(i, i, "u", b"<p>%d</p>" % i, None) for i in range(2000)]
    trained = zstandard.train_dictionary(4096, records, k=64, d=8)
    compressor = zstandard.ZstdCompressor(dict_data=trained)
    content = trained.as_bytes()
    data = struct.pack("<II", warc.SKIPPABLE, len(content)) + content + b"".join(map(compressor.compress, records))
    assert [c for _, c in warc.frames(data)] == records
    assert [c for _, c in warc.frames(warc.archive(records[:2]))] == records[:2]


@pytest.mark.parametrize("change", [
    lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1"), lambda r: r[:-1], lambda r: r + b"x",
    lambda r: r.replace(b"text</p>", b"tExt</p>"), lambda r: r.replace(b"WARC-Date", b"Date"),
    lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "),
])
def test_damage_is_found(change):
    good = warc.record(1, 1, "u", b"<p>text</p>", None)
    assert warc.parse(good)[1].endswith(b"<p>text</p>")
    with pytest.raises(ValueError):
        warc.parse(change(good))


def test_cut_off():
    data = warc.archive([warc.record(1, 1, "u", b"<p>text</p>", None)])
    with pytest.raises(ValueError):
        list(warc.frames(data[:-3]))


def test_empty(spark):
    folder = files.new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.read_archives(spark, folder).count() == 0
