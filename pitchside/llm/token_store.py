"""Token shards with keyed access by a minimal perfect hash index.

A store is a folder with

``shards``  raw identifiers, little-endian, two bytes each (four for vocabularies beyond 65,536), in
            ascending key order, one file per partition of keys;
``rows``    a table with a row per document: key, file, offset, number of identifiers, checksum;
``index``   a table with a row per segment of keys: the levels of a minimal perfect hash function
            and, by its slots, fingerprint, file, offset and length.

A lookup hashes the key to its segment, finds the one slot that the function gives, compares the
fingerprint, and reads that byte range of that file: constant work however large the store is.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pitchside.llm.common import PartFile, Ranges, bound_batches, text_or_empty
from pitchside.llm.token_counts import byte_symbols

#: Keys in a segment of the index, on average.
SEGMENT_KEYS = 1_024
#: Bits that a level of the hash function has for each key still to be placed.
BITS_PER_KEY = 2.0
MOST_LEVELS = 48
#: Words of a generation that a worker remembers; of those before, it remembers one generation.
WORDS_KEPT = 150_000
#: A word a worker remembers has at most so many code points; longer ones are encoded each time.
WORD_KEPT_CHARS = 64

ROWS = "doc_id long, shard string, shard_no int, offset long, n_tokens long, ids_crc32 long"


# --- identifiers ------------------------------------------------------------------------------


#: White space for ``str.split`` but not in Unicode's property, which the library goes by.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE_SPACE = regex.compile(r"\p{White_Space}+")


def words_of(text: str) -> list[str]:
    if SEPARATORS.search(text):
        return [word for word in WHITE_SPACE.split(text) if word]
    return text.split()


#: Punctuation that the vocabulary splits from the letters before it.
CLOSING = ".,!?;:"
#: Letters below this code point are never changed by normalization, and but for one (a dotted
#: capital I) become one letter each in lower case.
LATIN_END, DOTTED = "\u0250", "\u0130"


class _Words(dict):
    """The identifiers of words, from the library when a word is new.

    A word of Latin letters is merged by the library's model alone: all that the library does before
    is to put it in lower case and write its bytes as letters. Closing punctuation is looked up apart,
    as the library splits it off. Any other word passes through the whole library.
    """

    def __init__(self, library, kind: str):
        super().__init__()
        self.library, self.model = library, library.model
        self.packs = [struct.Struct(f"<{n}{kind}").pack for n in range(2 * WORD_KEPT_CHARS)]
        self.kind = kind
        self.symbols = byte_symbols()
        #: The words of the generation before; those that come again pass to the present one.
        self.before: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        if len(ids) < len(self.packs):
            return self.packs[len(ids)](*ids)
        return struct.pack(f"<{len(ids)}{self.kind}", *ids)

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def merged(self, word: str) -> bytes:
        """Of a lower-case word of Latin letters; those of ASCII stand for their own bytes."""
        written = word
        if not word.isascii():
            written = "".join(map(self.symbols.__getitem__, word.encode("utf-8")))
        return self.packed([token.id for token in self.model.tokenize(written)])

    def new(self, word: str) -> bytes:
        letters = word.rstrip(CLOSING)
        if not letters.isalpha():
            return self.whole(word)
        if not letters.isascii() and (max(letters) >= LATIN_END or DOTTED in letters):
            return self.whole(word)
        lower = letters.lower()
        if lower == word:
            return self.merged(word)
        return self[lower] + (self[word[len(letters) :]] if len(letters) < len(word) else b"")

    def __missing__(self, word: str) -> bytes:
        value = self.before.get(word)
        if value is None:
            value = self.new(word)
        if len(word) <= WORD_KEPT_CHARS:
            if len(self) >= WORDS_KEPT:
                self.before = dict(self)
                self.clear()
            self[word] = value
        return value


class Encoder:
    """Identifiers of whole texts, as bytes.

    ``by_word`` states that the vocabulary is of a kind: white space is dropped, letters are put in
    lower case, and letters, digits and other signs are split. A text's identifiers are then those of
    its words in turn, so each word goes to the library once and is remembered. Tests hold this
    against the library on whole texts.
    """

    def __init__(self, path: str, end_id: int | None, by_word: bool):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.width = 2 if library.get_vocab_size() <= 1 << 16 else 4
        self.by_word = by_word
        self.words = _Words(library, "H" if self.width == 2 else "I")
        self.end = b"" if end_id is None else self.words.packed([end_id])

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self.words.whole(text) + self.end
        return b"".join(map(self.words.__getitem__, words_of(text))) + self.end


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None, by_word: bool) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    return Encoder(path, end_id, by_word)


def wide_crc(data: bytes, width: int) -> int:
    """crc32 of identifiers as little-endian unsigned 32-bit integers."""
    if width == 4:
        return zlib.crc32(data)
    return zlib.crc32(np.frombuffer(data, "<u2").astype("<u4").tobytes())


# --- minimal perfect hash ---------------------------------------------------------------------


def hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each key, another mix for each seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


FINGERPRINT_SEED = 1_000


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Gives each of n known keys its own number below n.

    In each level the keys that meet no other key at their bit are placed there; the rest go on to
    the next level. The number of a key is the count of bits set before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = [np.concatenate([[0], np.cumsum(x)[:-1]]) for x in levels]
        self.first = np.concatenate([[0], np.cumsum([int(x.sum()) for x in levels])]).astype(int)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        levels, left = [], keys
        while len(left):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys repeat")
            size = max(1, int(np.ceil(len(left) * BITS_PER_KEY)))
            at = (hashed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The numbers; -1 for a key that is surely not among the known ones."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (hashed(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[todo[here]] = self.first[level] + self.before[level][at[here]]
            todo = todo[~here]
        return out

    def packed(self) -> tuple[list[int], list[bytes]]:
        return [len(x) for x in self.levels], [np.packbits(x).tobytes() for x in self.levels]

    @classmethod
    def unpacked(cls, sizes: list[int], packed: list[bytes]) -> PerfectHash:
        return cls(
            [
                np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
                for size, bits in zip(sizes, packed)
            ]
        )


# --- writing ----------------------------------------------------------------------------------


def write_store(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    *,
    end_id: int | None,
    by_word: bool,
    partitions: int | None = None,
) -> DataFrame:
    """Write all texts of ``docs`` (``doc_id`` long, ``text``) as a token store; returns ``rows``.

    A null or empty text is stored as its end identifier alone. Rows of one ``doc_id`` are all
    stored, in the order of a hash of their texts; the index leads to the first of them. Rows
    without a ``doc_id`` are stored first and not indexed. An empty table gives an empty store.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shards = f"{folder}/shards"
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, end_id, by_word)
        number, file = TaskContext.get().partitionId(), None
        for batch in batches:
            found = [encode.encode(text) for text in batch.column("text").to_pylist()]
            if found and file is None:
                file = PartFile(shards, f"part-{number:06d}")
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "shard": pa.array([file.name if file else ""] * len(found)),
                    "shard_no": pa.array([number] * len(found), pa.int32()),
                    "offset": pa.array([file.append(x) for x in found], pa.int64()),
                    "n_tokens": pa.array([len(x) // encode.width for x in found], pa.int64()),
                    "ids_crc32": pa.array([wide_crc(x, encode.width) for x in found], pa.int64()),
                }
            )
        if file is not None:
            file.close()

    # The hash of the text keeps the rows of one repeated key from meeting in one task.
    tie = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
        .repartitionByRange(parts, "doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
    )
    ordered.mapInArrow(write, ROWS).write.parquet(f"{folder}/rows")
    rows = spark.read.schema(ROWS).parquet(f"{folder}/rows")
    _write_index(rows, f"{folder}/index")
    return rows


INDEX = (
    "segment long, segments long, n_keys long, sizes array<long>, levels array<binary>, "
    "fingerprints binary, shards array<string>, shard_at binary, offsets binary, lengths binary"
)


def _segment(key: str, segments: int):
    return F.pmod(F.xxhash64(key), F.lit(segments))


def _write_index(rows: DataFrame, path: str) -> None:
    """One row per segment of keys; each group holds about ``SEGMENT_KEYS`` of them."""
    first = rows.where("doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("shard_no", "offset", "shard", "n_tokens")).alias("at")
    )
    segments = max(1, -(-rows.count() // SEGMENT_KEYS))

    def index(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["doc_id"].to_numpy(np.int64)
        function = PerfectHash.of(keys.view(np.uint64))
        slots = np.argsort(function(keys.view(np.uint64)))
        names, at = np.unique(group["shard"].to_numpy(str), return_inverse=True)
        sizes, levels = function.packed()
        return pd.DataFrame(
            {
                "segment": group["segment"].iloc[:1],
                "segments": [segments],
                "n_keys": [len(keys)],
                "sizes": [sizes],
                "levels": [levels],
                "fingerprints": [fingerprints(keys.view(np.uint64))[slots].tobytes()],
                "shards": [names.tolist()],
                "shard_at": [at[slots].astype("<u4").tobytes()],
                "offsets": [group["offset"].to_numpy("<i8")[slots].tobytes()],
                "lengths": [group["n_tokens"].to_numpy("<i8")[slots].tobytes()],
            }
        )

    entries = first.select(
        _segment("doc_id", segments).alias("segment"), "doc_id", "at.shard", "at.offset",
        "at.n_tokens",
    )
    entries.groupBy("segment").applyInPandas(index, INDEX).write.parquet(path)


# --- reading ----------------------------------------------------------------------------------


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Where the store holds each distinct non-null ``doc_id`` of ``keys``; unknown keys give no row.

    A key that isn't in the store passes the comparison of fingerprints once in 2^32 times.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    total = index.agg(F.max("segments")).first()[0]
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    wanted = wanted.distinct().withColumn("segment", _segment("doc_id", total or 1))

    def find(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(stored):
            kinds = {"doc_id": "int64", "shard": "object", "offset": "int64", "n_tokens": "int64"}
            return pd.DataFrame({name: pd.Series(dtype=kind) for name, kind in kinds.items()})
        row = stored.iloc[0]
        function = PerfectHash.unpacked(row["sizes"], row["levels"])
        ids = asked["doc_id"].to_numpy(np.int64)
        slots = function(ids.view(np.uint64))
        known = np.frombuffer(row["fingerprints"], np.uint32)
        found = (slots >= 0) & (known[slots] == fingerprints(ids.view(np.uint64)))
        slots = slots[found]
        return pd.DataFrame(
            {
                "doc_id": ids[found],
                "shard": np.array(row["shards"], object)[
                    np.frombuffer(row["shard_at"], "<u4")[slots]
                ],
                "offset": np.frombuffer(row["offsets"], "<i8")[slots],
                "n_tokens": np.frombuffer(row["lengths"], "<i8")[slots],
            }
        )

    return (
        wanted.groupBy("segment")
        .cogroup(index.groupBy("segment"))
        .applyInPandas(find, "doc_id long, shard string, offset long, n_tokens long")
    )


def read_ids(places: DataFrame, folder: str, width: int, crc: bool = False) -> DataFrame:
    """Adds ``ids`` (the payload as stored) to rows with shard, offset and n_tokens.

    With ``crc`` their ``ids_crc32`` takes the place of the payload: it is found where the bytes are read,
    so a task needs one Python worker and no payload leaves it.
    """
    bound_batches(places.sparkSession)
    added = T.StructField("ids_crc32", T.LongType()) if crc else T.StructField("ids", T.BinaryType())
    names = [*places.columns, added.name]
    schema = T.StructType([*places.schema.fields, added])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(f"{folder}/shards")
        for batch in batches:
            at = [batch.column(x).to_pylist() for x in ("shard", "offset", "n_tokens")]
            ids = (ranges.read(name, offset, n * width) for name, offset, n in zip(*at))
            if crc:
                found = pa.array((wide_crc(x, width) for x in ids), pa.int64())
            else:
                found = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=names)
        ranges.close()

    # Neighbours in a file are read by one task, and a large file by several.
    parts = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = places.repartitionByRange(parts, "shard", "offset")
    return near.sortWithinPartitions("shard", "offset").mapInArrow(read, schema)


def store_report(spark: SparkSession, folder: str, width: int) -> DataFrame:
    """Per stored row, from the files: doc_id, start, n_tokens, ids_crc32.

    Every indexed key is found by the index; only what the index can't lead to (rows without a key
    or after the first of a repeated key) is taken from ``rows``.
    """
    rows = spark.read.schema(ROWS).parquet(f"{folder}/rows")
    sizes = rows.groupBy("shard", "shard_no").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shard_start")
    )
    keyed = lookup(spark, folder, rows.select("doc_id"))
    others = rows.join(
        keyed.select("shard", "offset"), ["shard", "offset"], "left_anti"
    ).select("doc_id", "shard", "offset", "n_tokens")
    places = keyed.unionByName(others).join(starts, "shard")

    return read_ids(places, folder, width, crc=True).select(
        "doc_id",
        (F.col("shard_start") + (F.col("offset") / width).cast("long")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
