import hashlib
import io
import random
import struct

import pytest
import zstandard

from gradewell.llm import warc as W
from gradewell.llm.common import shared_folder

BIG = "<p>é</p>" * 50
PAGES = [
    (3, "http://a/", BIG), (1, "http://b/\r\nEvil: x", BIG), (2, None, BIG), (2, "http://c/", BIG), (4, "http://d/", None), (5, "http://e/", ""),
    (6, "http://f/", "short"), (7, "http://g/", "short"), (None, "http://h/", BIG), (None, "http://i/", "y" * 200),
    (8, "http://j/", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 10), (9, "http://k/", "z" * 300_000), (10, "http://l/", "a" * 99),
    (11, "http://m/", "a" * 99), (12, "http://n/", "b" * 100), (13, "http://o/", "b" * 100),
]


def wanted(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        first = min(same) if same and len(data) >= 100 else i
        out.append(str((i, len(data), hashlib.sha256(data).hexdigest(), "response" if first == i else "revisit", None if first == i else first)))
    return sorted(out)


def told(df):
    return sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in df.collect())


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, digest string, first int").repartition(3)


def test_round_trip(spark, pages):
    folder = shared_folder(spark, "warc")
    manifest = W.write_archives(pages, folder)
    made = W.read_archives(manifest)
    assert told(made) == wanted(PAGES)
    assert {r["url"] for r in made.collect()} >= {None, "http://b/%0D%0AEvil:%20x"}
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(PAGES)
    assert told(W.archived(pages.where("false"))) == []


def test_small_archives_hold_the_same(spark, pages):
    made = W.write_archives(pages, shared_folder(spark, "warc"), archive_bytes=1_000)
    assert made.count() > 5 and told(W.read_archives(made)) == wanted(PAGES)


def test_frames():
    random.seed(10)
    words = [f"word{i}" for i in range(300)]
    payloads = [("<html><body>" + " ".join(random.choices(words, k=150)) + "</body></html>").encode() for _ in range(400)]
    records = [W.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    data, size = W.archive(records)
    assert 0 < size <= W.DICTIONARY_BYTES
    magic, n = struct.unpack("<II", data[:8])
    assert magic == W.DICTIONARY_FRAME
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + n]))
    # Each record is a frame of its own: any of them opens without the others.
    rest, opened = data[8 + n:], []
    while rest:
        one = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        opened.append(one.decompress(rest))
        rest = one.unused_data
    assert opened == records
    assert [block.partition(b"\r\n\r\n")[2] for _, block in W.records_of(io.BytesIO(data))] == payloads
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) - 8 - n < 0.8 * plain


def test_damage_is_found(spark, pages):
    manifest = W.write_archives(pages.where("page_id = 9"), shared_folder(spark, "warc"))
    path = manifest.first()["path"].removeprefix("file:")
    data = W.archive([W.record(9, None, b"other" * 30, hashlib.sha256(b"that").hexdigest(), None)])[0]
    with open(path, "wb") as f:
        f.write(data)
    with pytest.raises(Exception) as raised:
        W.read_archives(manifest).collect()
    assert "is damaged" in str(raised.value)


def test_files_are_as_described(spark, pages):
    rows = W.write_archives(pages, shared_folder(spark, "warc")).collect()
    for r in rows:
        with open(r["path"].removeprefix("file:"), "rb") as f:
            data = f.read()
        assert len(data) == r["n_bytes"] and len(list(W.records_of(io.BytesIO(data)))) == r["n_records"]
        if r["dictionary_bytes"]:
            assert struct.unpack("<I", data[:4])[0] == W.DICTIONARY_FRAME
