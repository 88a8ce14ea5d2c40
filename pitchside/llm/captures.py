"""WARC archives with a two-level capture index.

An archive folder holds

``archives``  WARC files, a gzip member per record, so that any record is a byte range;
``captures``  a table that names every record: key, page, file, offset, length;
``index``     the captures in the order of their keys, as lines in compressed blocks; beside each
              file of blocks lies its directory: the first key and the place of every block;
``parts``     a table of the index files in order, with their first keys.

A lookup searches the first keys of the files, then those of the file's directory, each by halves,
reads the one block (or the run of blocks) that can hold the key, and from its lines the records'
ranges.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchside.llm.common import PartFile, Ranges, bound_batches, file_system

c = F.col

#: Lines in a block of the index.
BLOCK_LINES = 1_000
#: Bytes of a WARC file after which a task begins another.
ROLL = 256 << 20
LEVEL = 4

#: Fixed values of the format.
VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URI = "urn:page:"

URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^#]*)")


def url_key(url: str | None) -> str:
    """The key of a URL: the host's labels from the right, then path and query.

    ``http://m.Example.org:80/a?b#c`` gives ``org,example,m:80)/a?b``. What is no such URL is its own
    key; null is the empty one. Line ends never occur in a key.
    """
    found = URL.match(url or "")
    if not found:
        return re.sub(r"[\r\n]", "", url or "")
    host, _, port = found[1].lower().partition(":")
    labels = ",".join(reversed(host.split(".")))
    key = labels + (f":{port}" if port else "") + ")" + (found[2] or "/")
    return re.sub(r"[\r\n]", "", key)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


# --- records ----------------------------------------------------------------------------------


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit of the page ``refers_to`` without."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_URI}{'' if page is None else page}>",
        f"WARC-Target-URI: {re.sub(r'[\r\n]', '', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{RECORD_URI}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + "\r\n".join(lines).encode() + END + block + END


def _page(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(RECORD_URI)
    return int(number) if number else None


def parsed(data: bytes) -> dict:
    """What a record says, its payload's length and digest checked where it has the payload."""
    head, _, rest = data.partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(END)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload), digest_of(payload)) != (size, digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To")),
    }


# --- writing ----------------------------------------------------------------------------------

CAPTURES = "key string, page_id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and the index; returns ``captures``.

    Of the rows whose payloads of at least ``least_bytes`` bytes are equal, the one with the largest
    page_id is a response and the others revisit it. A null html is an empty payload, a null url has
    the empty key. Rows that repeat the largest page_id, and equal payloads of which none has a
    page_id, are all responses; other rows without a page_id revisit. An empty table gives an empty
    index. Other columns are ignored.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    html = F.coalesce(c("html"), F.lit(""))
    rows = pages.select(
        c("page_id").cast("long").alias("page_id"), "url", html.alias("html")
    ).withColumn("digest", F.sha1("html"))
    # Only payloads that occur again need to know their response.
    shared = (
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("newest"), F.count("*").alias("times"))
        .where("times > 1")
        .drop("times")
    )
    told = rows.join(shared, "digest", "left").select(
        "page_id", "url", "html",
        F.when(~c("page_id").eqNullSafe(c("newest")), c("newest")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, file = TaskContext.get().partitionId(), None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(x).to_pylist() for x in ("page_id", "url", "refers_to")]
            payloads = batch.column("html").cast(pa.binary())
            for page, url, refers_to, payload in zip(*columns, payloads):
                if file is None:
                    file = PartFile(f"{folder}/archives", f"part-{number:06d}")
                whole = record(page, url, payload.as_py(), refers_to)
                member = gzip.compress(whole, LEVEL, mtime=0)
                out.append((url_key(url), page, file.name, file.append(member), len(member)))
                if file.size > ROLL:
                    file.close()
                    file = None
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            lists = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(lists, kinds)],
                names=["key", "page_id", "file", "offset", "length"],
            )
        if file is not None:
            file.close()

    told.mapInArrow(write, CAPTURES).write.parquet(f"{folder}/captures")
    captures = spark.read.schema(CAPTURES).parquet(f"{folder}/captures")
    _write_index(captures, folder)
    return captures


PARTS = "part int, first_key string, file string, directory string, blocks long"


def _write_index(captures: DataFrame, folder: str) -> None:
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The places of the records keep a key that a third of all rows have from meeting in one task.
    order = ["key", "file", "offset"]
    ordered = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        lines: list[str] = []
        file, directory = None, []
        first = ""

        def flush() -> None:
            nonlocal file, lines
            if lines:
                file = file or PartFile(f"{folder}/index", f"blocks-{number:06d}")
                packed = zlib.compress("".join(lines).encode(), LEVEL)
                directory.append([first, file.append(packed), len(packed)])
                lines = []

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if not lines:
                    first = row[0]
                lines.append(json.dumps(row) + "\n")
                if len(lines) == BLOCK_LINES:
                    flush()
        flush()
        if file is not None:
            file.close()
            beside = PartFile(f"{folder}/index", f"directory-{number:06d}")
            beside.append(json.dumps(directory).encode())
            beside.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([number], pa.int32()),
                    "first_key": [directory[0][0]],
                    "file": [file.name],
                    "directory": [beside.name],
                    "blocks": pa.array([len(directory)], pa.int64()),
                }
            )

    ordered.mapInArrow(write, PARTS).write.parquet(f"{folder}/parts")


# --- reading ----------------------------------------------------------------------------------


def _run(firsts: list[str], key: str) -> range:
    """The places in a list of first keys at which ``key`` may lie: a run, as keys may repeat."""
    return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """The captures of each distinct ``key`` of ``keys`` (see ``url_key``); null finds nothing.

    The driver holds one row per index file, of which there are as many as partitions.
    """
    rows = spark.read.schema(PARTS).parquet(f"{folder}/parts").orderBy("part").collect()
    firsts = [row["first_key"] for row in rows]
    files = [(row["file"], row["directory"]) for row in rows]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(key, at) for key in batch.column(0).to_pylist() for at in _run(firsts, key)]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([x[0] for x in pairs], pa.string()),
                    "at": pa.array([x[1] for x in pairs], pa.int32()),
                }
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(f"{folder}/index")
        store, base = file_system(f"{folder}/index")
        opened, block, lines = None, None, []
        directory: list = []
        begins: list[str] = []
        for batch in batches:
            out: list[list] = []
            for key, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at != opened:
                    opened, block = at, None
                    with store.open_input_file(f"{base}/{files[at][1]}") as f:
                        directory = json.loads(f.read())
                    begins = [x[0] for x in directory]
                for number in _run(begins, key):
                    if number != block:
                        _, offset, length = directory[number]
                        packed = ranges.read(files[at][0], offset, length)
                        found = map(json.loads, zlib.decompress(packed).decode().splitlines())
                        lines, block = list(found), number
                        held = [x[0] for x in lines]
                    out += lines[bisect_left(held, key) : bisect_right(held, key)]
            columns = zip(*out) if out else [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                names=["key", "page_id", "file", "offset", "length"],
            )
        ranges.close()

    if not rows:
        return spark.createDataFrame([], CAPTURES)
    wanted = keys.select(c("key").cast("string").alias("key")).where("key is not null").distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routed = wanted.mapInArrow(route, "key string, at int")
    near = routed.repartitionByRange(parts, "at", "key").sortWithinPartitions("at", "key")
    return near.mapInArrow(search, CAPTURES)


RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at ``file, offset, length``, each by a range read."""
    bound_batches(places.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(f"{folder}/archives")
        for batch in batches:
            out = [
                parsed(gzip.decompress(ranges.read(*place)))
                for place in zip(*(column.to_pylist() for column in batch.columns))
            ]
            schema = pa.schema(
                [
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()),
                ]
            )
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        ranges.close()

    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = places.select("file", "offset", "length").repartitionByRange(parts, "file", "offset")
    return near.sortWithinPartitions("file", "offset").mapInArrow(read, RECORDS)


def archive_report(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write ``pages``, look every page's URL up in the index, and read the records found there."""
    spark = pages.sparkSession
    write_archives(pages, folder, least_bytes)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [url_key(url) for url in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": pa.array(found, pa.string())})

    asked = pages.select("url").mapInArrow(keys, "key string")
    return read_records(lookup(spark, folder, asked), folder)
