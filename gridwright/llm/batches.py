"""Arrow batches of rows with a text: bounded slices, byte views, and columns put back."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, so that no other column can clash with the ones it adds."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about `limit` bytes of the column; a longer value makes a piece of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; a null counts as empty."""
    values = batch.column(column).cast(pa.binary())
    return [x or b"" for x in values.to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def shared_files(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri)


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that no column of the input has, in whatever case."""
    return name if name.lower() not in {c.lower() for c in taken} else f"{name}_{uuid.uuid4().hex[:8]}"


def spread(files: DataFrame) -> DataFrame:
    """The rows of a small written table of files dealt out evenly, so that one task does not read them all."""
    tasks = 4 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(max(1, min(files.count(), tasks)))


class NewFiles:
    """Files that one task adds to a shared folder, under names that no other attempt of the task uses."""

    def __init__(self, folder: str, part: int, ending: str) -> None:
        self.folder, self.stem, self.ending, self.number = folder, f"{part:06d}-{uuid.uuid4().hex[:12]}", ending, 0
        self.system, self.root = shared_files(folder)
        self.system.create_dir(self.root, recursive=True)

    def write(self, parts: Iterable[bytes]) -> tuple[int, str, int]:
        """Writes the next file; (its number in the task, its name, its bytes)."""
        name = f"{self.stem}-{self.number:05d}{self.ending}"
        size = 0
        with self.system.open_output_stream(f"{self.root}/{name}", compression=None) as out:
            for part in parts:
                size += len(part)
                out.write(part)
        self.number += 1
        return self.number - 1, name, size


def read_file(folder: str, name: str) -> pa.NativeFile:
    system, root = shared_files(folder)
    return system.open_input_file(f"{root}/{name}")
