"""WARC archives compressed by dictionary: one skippable frame with a dictionary, then one frame per record.

Every archive is written by one task. It trains a Zstandard dictionary on records of its own archive, puts it into a
leading skippable frame and compresses each record by itself, so that a reader needs nothing but the file and
can start at any record. Equal payloads are stored once; their other records are revisits.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from gradewell.llm.common import integers, shared_folder, staged

#: The skippable frame that holds a dictionary, and the least payload that is not repeated.
DICTIONARY_FRAME = 0x184D2A5D
LEAST_REVISITED = 100
#: Bytes of records before compression in one archive, of the records that train its dictionary, and of the dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 32 << 20, 2 << 20, 64 << 10
_LEVEL = 3
_DATE = "1970-01-01T00:00:00Z"

_MANIFEST = "path string, n_records long, n_bytes long, dictionary_bytes long"
_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _named(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the response's headers only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_named(page_id)}",
        f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.insert(3, f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [
            f"WARC-Refers-To: {_named(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on records spread evenly over the archive; None where they are too few to train on."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records[::step], k=256, d=8)
    except zstandard.ZstdError:
        return None
    return trained


def archive(records: list[bytes]) -> tuple[bytes, int]:
    """The archive's bytes, and those of its dictionary (0: none)."""
    trained = _dictionary(records)
    packer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=trained, write_checksum=True)
    head = b""
    if trained is not None:
        inner = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        head = struct.pack("<II", DICTIONARY_FRAME, len(inner)) + inner
    return head + b"".join(map(packer.compress, records)), len(trained.as_bytes()) if trained else 0


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, top = _place(folder)
        where.create_dir(top, recursive=True)

        def out(records: list[bytes]) -> pa.RecordBatch:
            # A name of its own for each attempt: what a lost executor leaves is in no manifest.
            path = f"{top}/{uuid.uuid4().hex}.warc.zst"
            data, trained = archive(records)
            with where.open_output_stream(path, compression=None) as f:
                f.write(data)
            return pa.RecordBatch.from_pydict({
                "path": [f"{folder}/{path.rsplit('/', 1)[1]}"], "n_records": [len(records)], "n_bytes": [len(data)],
                "dictionary_bytes": [trained],
            })

        records, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                records.append(record(*row))
                held += len(records[-1])
                if held >= archive_bytes:
                    yield out(records)
                    records, held = [], 0
        if records:
            yield out(records)

    return write


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes every row of `pages` (page_id long, url, html) as a record under `folder`; returns the manifest.

    A null html is an empty payload, a null url has no target line, a null page_id an empty name. Of records with equal
    payloads of at least 100 bytes those with the smallest page_id are responses, others revisits of it; if
    none has an id, all are responses. Ids that are no integers raise ValueError. Other columns are not read. An empty table writes no archive. Only
    ids and digests are grouped; a payload that a third of all pages share is one row there, and the join that brings
    its id back to the pages is one that Spark splits.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    records = pages.select(integers(pages, "page_id").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    records = records.withColumn("digest", F.sha2("payload", 256))
    first = staged(
        records.where(F.length("payload") >= LEAST_REVISITED).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "first",
    )
    told = records.join(first, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"),
    )
    return staged(told.mapInArrow(_writer(folder, archive_bytes), _MANIFEST), "manifest")


def records_of(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of an archive, read from a binary stream."""
    head, trained = data.read(8), None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        inner = data.read(struct.unpack("<I", head[4:])[0])
        trained, head = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(inner)), b""

    class Rest:
        def read(self, n: int = -1, first=[head]) -> bytes:  # noqa: B006
            start, first[0] = first[0], b""
            return start or data.read(n)

    plain = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(Rest(), read_across_frames=True, read_size=1 << 20)
    held = b""

    def upto(n: int) -> bytes:
        nonlocal held
        parts = [held]
        have = len(held)
        while have < n and (more := plain.read(max(1 << 20, n - have))):
            parts.append(more)
            have += len(more)
        held = b"".join(parts)
        return held

    at = 0
    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            held, at, before = held[at:], 0, len(held) - at
            if len(upto(before + 1)) == before:
                if before:
                    raise ValueError("an archive ends within a record")
                return
        lines = held[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start, n = end + 4, int(headers["Content-Length"])
        if len(held) < start + n + 4:
            held, start = held[start:], 0
            if len(upto(n + 4)) < n + 4:
                raise ValueError("an archive ends within a record")
        yield headers, held[start:start + n]
        at = start + n + 4


def _page(name: str | None) -> int | None:
    number = name[len("<urn:page:"):-1] if name else ""
    return int(number) if number else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        columns = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            where, path = _place(uri)
            rows = []
            with where.open_input_stream(path, compression=None) as f:
                for headers, block in records_of(f):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    n = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
                    if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{uri}: the payload of {headers['WARC-Record-ID']} is damaged")
                    rows.append((
                        _page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), n, digest, kind,
                        _page(headers.get("WARC-Refers-To")),
                    ))
                    if len(rows) == 10_000:
                        yield out(rows)
                        rows = []
            yield out(rows)


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives listed; every payload is checked against its digest."""
    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(_read, _READ)


def archived(pages: DataFrame) -> DataFrame:
    """The records of `pages`, written to archives in the shared folder and read back."""
    return read_archives(write_archives(pages, shared_folder(pages.sparkSession, "archives")))
