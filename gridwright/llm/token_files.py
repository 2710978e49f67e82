"""Token ids in files: ranks by frequency, one to four bytes each, lengths apart in control bytes.

A file holds whole documents in ascending order and starts over when it has enough ids. Its header has the ids by falling
frequency; a document is the sequence of their ranks, so common ids take one byte. Two bits per rank, four to a control
byte, tell how many bytes it has. A reader looks up each control byte in tables of lengths and offsets and gathers all
ranks of a file at once.

Order is by doc_id, nulls first; rows that share an id are ordered by a hash of the text. A null text is an empty one,
which gives the end id alone. Repeated rows repeat. An empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridwright.llm.batches import NewFiles, read_file, slices, spread, text_rows, texts
from gridwright.llm.tokens import encoder
from gridwright.session import work_path, written

MAGIC, HEAD = b"RANKVB01", struct.Struct("<QQQQ")
END, FILE_IDS = 0, 4_000_000
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
_TOTALS = _LENGTHS.sum(1)
_OFFSETS = np.cumsum(_LENGTHS, 1) - _LENGTHS


def encode_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes); the last control byte is filled up with one-byte zeros."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, dtype="<u4")
    padded[: len(ranks)] = ranks
    kept = np.ones((len(padded), 4), dtype=bool)
    for byte in range(1, 4):
        np.greater(padded, (1 << 8 * byte) - 1, out=kept[:, byte])
    more = kept[:, 1:].view(np.uint8)
    codes = (more[:, 0] + more[:, 1] + more[:, 2]).reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return control, padded.view(np.uint8).reshape(-1, 4)[kept]


def decode_ranks(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    totals = _TOTALS[control]
    places = ((np.cumsum(totals) - totals)[:, None] + _OFFSETS[control]).ravel()
    lengths = _LENGTHS[control].ravel()
    ranks = data[places].astype(np.uint32)
    for byte in range(1, 4):
        has = lengths > byte
        ranks[has] |= data[places[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks[:count]


def file_parts(doc_ids: list[int | None], documents: list[np.ndarray]) -> list[bytes]:
    """The bytes of one file: head, ids by rank, documents (id, whether it is null, length), control bytes, data."""
    ids = np.concatenate(documents) if documents else np.zeros(0, dtype=np.uint32)
    counts = np.bincount(ids)
    by_rank = np.flatnonzero(counts)
    by_rank = by_rank[np.lexsort([by_rank, -counts[by_rank]])].astype("<u4")
    rank = np.zeros(len(counts), dtype=np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    control, data = encode_ranks(rank[ids])
    keys = np.array([x or 0 for x in doc_ids], dtype="<i8")
    nulls = np.array([x is None for x in doc_ids], dtype=np.uint8)
    lengths = np.array([len(d) for d in documents], dtype="<u8")
    head = MAGIC + HEAD.pack(len(documents), len(ids), len(by_rank), len(data))
    return [head, *(x.tobytes() for x in (by_rank, keys, nulls, lengths, control, data))]


def parse_file(raw: memoryview | bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Document ids and token ids of one file."""
    if bytes(raw[: len(MAGIC)]) != MAGIC:
        raise ValueError("not a token file")
    documents, count, kinds, size = HEAD.unpack_from(raw, len(MAGIC))
    at = len(MAGIC) + HEAD.size
    out = []
    for kind, n in (("<u4", kinds), ("<i8", documents), ("u1", documents), ("<u8", documents), ("u1", -(-count // 4)), ("u1", size)):
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += out[-1].nbytes
    by_rank, keys, nulls, lengths, control, data = out
    ids = by_rank[decode_ranks(control, data, count)]
    parts = np.split(ids, np.cumsum(lengths.astype(np.int64))[:-1]) if documents else []
    return [None if null else key for key, null in zip(keys.tolist(), nulls.tolist())], parts


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encodes all texts, adds the end id, and writes files to the shared folder. Returns the written list of files in
    order: part, number, folder, name, bytes, documents, ids, and start, the ids in all files before."""
    folder = folder or work_path(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = encoder(tokenizer), TaskContext.get().partitionId()
        files = NewFiles(folder, part, ".ranks")
        names = ["part", "number", "folder", "name", "bytes", "documents", "ids"]
        keys: list[int | None] = []
        held: list[np.ndarray] = []
        count = 0

        def flush() -> pa.RecordBatch:
            number, name, size = files.write(file_parts(keys, held))
            row = (part, number, folder, name, size, len(held), count)
            keys.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names)

        for batch in slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                tokens = np.append(known.encode(text).astype(np.uint32), np.uint32(END))
                keys.append(key)
                held.append(tokens)
                count += len(tokens)
                if count >= file_ids:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    rows = text_rows(docs)
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part long, number long, folder string, name string, bytes long, documents long, ids long"
    files = written(ordered.mapInArrow(write, schema), "files")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("ids").alias("total"))  # one row per shuffle partition
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier.orderBy("part")), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("ids").over(earlier.partitionBy("part").orderBy("number")), F.lit(0))
    placed = files.withColumn("within", within).join(parts, "part")
    return written(placed.select(*files.columns, (F.col("before") + F.col("within")).alias("start")), "files")


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document, as decoded from the files: doc_id, start, n_tokens, ids_crc32 (and its ids)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with read_file(row["folder"], row["name"]) as source:
                    keys, documents = parse_file(source.read())
                sizes = np.array([len(d) for d in documents], dtype=np.int64)
                starts = row["start"] + np.cumsum(sizes) - sizes
                checks = [zlib.crc32(d.astype("<u4")) for d in documents]
                columns = [pa.array(x, pa.int64()) for x in (keys, starts, sizes, checks)]
                if with_ids:
                    columns.append(pa.array([d.astype(np.int32) for d in documents], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [*_DOCUMENT, *(["ids"] if with_ids else [])])

    schema = ", ".join(f"{c} long" for c in _DOCUMENT) + (", ids array<int>" if with_ids else "")
    return spread(files).mapInArrow(read, schema)


_DOCUMENT = ["doc_id", "start", "n_tokens", "ids_crc32"]
