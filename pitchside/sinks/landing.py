"""Raw landing of post batches and audit columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchside.functions.columns import row_as_json, utc_now
from pitchside.schemas import RAW_POSTS
from pitchside.session import stored


def _time_parts(time: Column) -> dict[str, Column]:
    """Digits of a timestamp. Taken from its text, which no session zone can shift."""
    text = time.cast("timestamp_ntz").cast("string")
    places = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2), "minute": (15, 2),
              "second": (18, 2)}
    return {name: F.substring(text, at, size) for name, (at, size) in places.items()}


def batch_file(prefix: str, name: str, fetched_at: Column) -> Column:
    """Landing path of a batch: ``prefix/YYYY/MM/DD/HH/name_YYYYmmdd_HHMMSS.json``."""
    part = _time_parts(fetched_at)
    date, clock = ["year", "month", "day"], ["hour", "minute", "second"]
    return F.concat(
        F.concat_ws("/", F.lit(prefix), *[part[p] for p in date], part["hour"], F.lit(f"{name}_")),
        *[part[p] for p in date],
        F.lit("_"),
        *[part[p] for p in clock],
        F.lit(".json"),
    )


def land_batch(df: DataFrame, fetched_at: str, prefix: str, batch_id: int | str) -> str:
    """Write a batch as JSON lines in one folder per hour; a retry overwrites the same folder."""
    path = f"{prefix}/batch={batch_id}"
    parts = _time_parts(F.col(fetched_at))
    hours = ["year", "month", "day", "hour"]
    (
        df.withColumns({name: parts[name] for name in hours})
        .write.mode("overwrite")
        .partitionBy(*hours)
        .option("ignoreNullFields", "false")
        .json(path)
    )
    return path


#: Where rows land that name no file.
UNNAMED = "unnamed.json"


def land_files(df: DataFrame, root: str, file: str, columns: Sequence[str]) -> DataFrame:
    """Write the rows of each ``file`` as one JSON array at ``root/file``; returns ``file, rows``.

    The tasks write: all rows of a file come to one, sorted, and stream through it, so none is held as a
    whole. An attempt writes beside the place under a name of its own and then moves the file there, so
    a repeated one replaces it by the same. Readers that go by Spark's rule skip unfinished names. Rows
    without a file land in one of their own. The result is read from what the tasks report, once.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        name = stream = draft = None
        count, told = 0, []

        def finish() -> None:
            if stream is not None:
                stream.write(b"\n]\n")
                stream.close()
                store.move(draft, f"{base}/{name}")
                told.append((name, count))

        for batch in batches:
            for path, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path != name:
                    finish()
                    name, count = path, 0
                    folder, _, last = f"{base}/{path}".rpartition("/")
                    store.create_dir(folder, recursive=True)
                    draft = f"{folder}/_{uuid.uuid4().hex}-{last}"
                    stream = store.open_output_stream(draft)
                stream.write((b"[\n" if count == 0 else b",\n") + row.encode())
                count += 1
        finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in told], pa.string()), pa.array([n for _, n in told], pa.int64())],
            names=[file, "rows"],
        )

    whole = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    rows = df.select(F.coalesce(file, F.lit(UNNAMED)).alias(file), whole.alias("_row"))
    ordered = rows.repartition(file).sortWithinPartitions(file, "_row")
    return stored(ordered.mapInArrow(write, f"{file} string, rows long"), "landed")


def read_landed(spark: SparkSession, root: str, schema: str, file: str) -> DataFrame:
    """Rows of the files of ``land_files``, with the path below ``root`` that each came from."""
    path = F.col("_metadata.file_path")
    below = F.substring_index(path, f"/{root.rstrip('/').rpartition('/')[2]}/", -1)
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    return rows.json(root).withColumn(file, below)


def with_audit(
    posts: DataFrame, load_id: str | Column, file: str | Column, loaded_at: Column | None = None
) -> DataFrame:
    """Scored posts in the shape of the raw post table: batch id, load time, file, JSON copy."""
    audit = {
        "pipeline_load_id": load_id if isinstance(load_id, Column) else F.lit(load_id),
        "pipeline_loaded_at": utc_now() if loaded_at is None else loaded_at,
        "pipeline_batch_file": file if isinstance(file, Column) else F.lit(file),
        "raw_json": row_as_json(*posts.columns),
    }
    full = posts.withColumns(audit)
    return full.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_POSTS.fields])
