"""WARC archives compressed record by record with a dictionary of their own.

Each archive begins with a skippable Zstandard frame that holds a dictionary trained on records of that archive; then
every record is a frame by itself, so one record can be read with the dictionary alone. Payloads seen before become
revisit records without a body: of pages with equal payloads of at least `MIN_REVISIT` bytes the least page_id is the
response.

A null html is an empty payload. Pages that share the least page_id are all responses; with null ids only, all of them
are. A null url leaves out the target header. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwright.llm.batches import NewFiles, raw_texts, read_file, slices, spread
from gridwright.session import work_path, written

MIN_REVISIT = 100
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 32 << 20, 64 << 10, 4 << 20, 3
# Fixed values of the formats: skippable frame with a dictionary, record profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages have no time of capture.
DATE = "1970-01-01T00:00:00Z"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, kind: str) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=";/?:@&=+$,#%!~*'()[]")))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _name(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"),
               ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"".join([b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"])


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on records spread over the archive; with too little to train on, their raw bytes."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = [r[:SAMPLE_BYTES // 8] for r in records[::step]]
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_parts(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of one archive: the dictionary's frame, then a frame per record."""
    shared = dictionary(records)
    content = shared.as_bytes()
    yield struct.pack("<II", DICTIONARY_FRAME, len(content)) + content
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
    yield from map(compressor.compress, records)


def read_archive(source: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no leading dictionary")
    content = source.read(size)
    kind = zstandard.DICT_TYPE_AUTO
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind))
    with io.BufferedReader(reader.stream_reader(source, read_across_frames=True), 1 << 20) as text:
        while line := text.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no record where one should begin: {line[:40]!r}")
            fields = {}
            while (line := text.readline()) != b"\r\n":
                key, _, value = line.decode().partition(":")
                fields[key] = value.strip()
            block = text.read(int(fields["Content-Length"]))
            if text.read(4) != b"\r\n\r\n":
                raise ValueError("a record has another length than stated")
            yield fields, block


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to and record_type of every page. Only payloads that come more than once are
    on the joined side, and it has one row for each however many copies there are."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    long = rows.filter(F.octet_length("html") >= MIN_REVISIT)
    repeats = long.groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    repeats = repeats.filter("copies > 1 and least is not null").select("digest", "least")
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    return rows.join(repeats, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("least")).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"))


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages to archives in the shared folder; the written list of them: folder, name, bytes, records."""
    folder = folder or work_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = NewFiles(folder, TaskContext.get().partitionId(), ".warc.zst")
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            _, name, written_bytes = files.write(archive_parts(held))
            row = (folder, name, written_bytes, len(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["folder", "name", "bytes", "records"])

        for batch in slices(batches, "html"):
            others = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to", "record_type")]
            for payload, page_id, url, digest, refers_to, kind in zip(raw_texts(batch, "html"), *others):
                held.append(record(page_id, url, payload, digest, refers_to, kind))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    schema = "folder string, name string, bytes long, records long"
    return written(with_revisits(pages).mapInArrow(write, schema), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Per record, from the archives: page_id, url, payload (null for a revisit), payload_bytes, payload_digest (of a
    response: counted anew from the payload), record_type, refers_to."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                with read_file(file["folder"], file["name"]) as source:
                    rows: list[tuple] = []
                    size = 0
                    for fields, block in read_archive(source):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        whole = fields["WARC-Type"] == "response"
                        stated = int(head.rpartition(b"Content-Length: ")[2])
                        digest = hashlib.sha256(payload).hexdigest() if whole else fields["WARC-Payload-Digest"][7:]
                        if whole and (len(payload), digest) != (stated, fields["WARC-Payload-Digest"][7:]):
                            raise ValueError(f"{file['name']}: payload of {fields['WARC-Record-ID']} was altered")
                        refers = _number(fields["WARC-Refers-To"]) if not whole else None
                        rows.append((_number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"),
                                     payload.decode() if whole else None, stated, digest, fields["WARC-Type"], refers))
                        size += len(block)
                        if size > 8 << 20:
                            yield _as_batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _as_batch(rows)

    return spread(archives).mapInArrow(read, ", ".join(f"{n} {t}" for n, t in _RECORD))


_RECORD = [("page_id", "long"), ("url", "string"), ("payload", "string"), ("payload_bytes", "long"),
           ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "long")]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64() if t == "long" else pa.string() for _, t in _RECORD]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [n for n, _ in _RECORD])
