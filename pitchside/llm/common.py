"""What several operators share: row keys, scratch folders, and files that tasks write themselves."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchside.session import scratch_path, stored

#: Bytes of one Arrow batch, so that a run of very long texts doesn't fill a Python worker.
BATCH_BYTES = 4 << 20

#: The words of a text, as the contracts of the operators define them.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, unless the session bounds them already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1)).rstrip("bB") or 0) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def folds(key: str = "doc_id") -> Column:
    """The contract's fold of a row: crc32 of the key as text, modulo 4. A null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4


def held_out(key: str = "doc_id") -> Column:
    return folds(key) == 2


def drop_path(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """The scratch tables of one call; ``clear`` deletes all that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, label: str) -> str:
        self.paths.append(scratch_path(self.spark, label))
        return self.paths[-1]

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        drop_path(self.spark, *self.paths)
        self.paths = []


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``path`` (a URI or a plain path), for use inside tasks."""
    return fs.FileSystem.from_uri(path)


class PartFile:
    """A file that one attempt of a task writes under a name of its own.

    A table that Spark commits names the files that count. What a lost or repeated attempt left is
    never named there, so that every task may run any number of times.
    """

    def __init__(self, folder: str, label: str):
        self.name = f"{label}-{uuid.uuid4().hex}"
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        self.stream = store.open_output_stream(f"{base}/{self.name}")
        self.size = 0

    def append(self, data: bytes) -> int:
        """Write ``data`` and return the offset where it begins."""
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()


class Ranges:
    """Reads byte ranges of the files in a folder; keeps the last file open."""

    def __init__(self, folder: str):
        self.store, self.base = file_system(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.base}/{name}")
        return self.file.read_at(length, offset) if length else b""

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.name, self.file = None, None


def slices(batches: Iterable[pa.RecordBatch], size: int, column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        texts = batch.column(column)
        lengths = pc.binary_length(texts.cast(pa.binary())).fill_null(0).to_pylist()
        begin = total = 0
        for i, length in enumerate(lengths):
            if i > begin and total + length > size:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += length
        if len(lengths) > begin:
            yield batch.slice(begin)


__all__ = [
    "BATCH_BYTES", "SPACE", "WORD", "PartFile", "Ranges", "Scratch", "bound_batches", "drop_path",
    "file_system", "folds", "held_out", "scratch_path", "slices", "stored", "text_or_empty",
]
