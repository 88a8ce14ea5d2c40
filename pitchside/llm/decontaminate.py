"""Benchmark decontamination by the q-gram lemma.

Benchmark texts are cut into overlapping windows. If a window of length L lies in a document with at
most e edits, both share at least ``L + 1 - q - q * e`` q-grams, all on diagonals no more than e from
each other. So the q-grams that a document shares with a window are counted in overlapping bands of
diagonals; bands below the bound are dropped, and the others are verified by a banded alignment.

The windows lie in the scratch folder in blocks of a fixed size. A task holds the index of one block
and a few megabytes of documents at a time, however many of either there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F

from pitchside.llm.common import bound_batches, file_system, scratch_path, slices

c = F.col

#: Windows in a block, and bytes of text that a task takes at once.
BLOCK = 16_384
SLICE = 2 << 20
#: Bytes of text whose q-grams are hashed at once, and hits of windows that are counted at once; those
#: of one text always are.
PIECE, HITS = 1 << 17, 1 << 17
#: Regions aligned at once.
ALIGNED = 8_192


@dataclass(frozen=True)
class Budget:
    """What counts as a passage of a benchmark text."""

    #: Bytes of a q-gram, of a window, and between the beginnings of windows, in normal form.
    q: int = 12
    window: int = 96
    stride: int = 32
    #: Edits allowed per byte of a window.
    rate: float = 0.07
    #: Texts with fewer bytes in normal form are too short to tell from chance, and not sought.
    least: int = 24

    def edits(self, length: int) -> int:
        """Edits allowed in a window: never so many that the lemma would promise no q-gram."""
        return min(int(self.rate * length), (length - self.q) // self.q)


# --- normal form ------------------------------------------------------------------------------


def _classes() -> np.ndarray:
    """ASCII letters and digits and all bytes of other letters stay; the rest become spaces."""
    out = np.arange(256, dtype=np.uint8)
    kept = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    out[~np.isin(out, kept)] = 0x20
    return out


CLASSES = _classes()


def normal(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts in normal form one after the other, as bytes, and where each begins and ends.

    Lower case, everything but letters and digits a space, and never two spaces running. A null text
    is empty.
    """
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")).cast(pa.large_binary())
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset :][: len(lower) + 1]
    total = int(offsets[-1] - offsets[0]) if len(lower) else 0
    if not total:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = CLASSES[np.frombuffer(lower.buffers()[2], np.uint8, total, int(offsets[0]))]
    offsets = offsets - offsets[0]
    space = raw == 0x20
    keep = np.empty(total, bool)
    keep[0] = True
    np.logical_not(space[1:] & space[:-1], out=keep[1:])
    # A text never begins with a space.
    firsts = offsets[:-1][offsets[:-1] < total]
    keep[firsts] = True
    keep[firsts[space[firsts]]] = False
    cuts = offsets.tolist()
    lengths = [np.count_nonzero(keep[a:b]) for a, b in zip(cuts, cuts[1:])]
    return raw[keep], np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def q_grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q bytes, by doubling."""
    base = 0x9E3779B97F4A7C15
    if len(data) < q:
        return np.zeros(0, np.uint64)
    spans = {1: data.astype(np.uint64) + np.uint64(1)}
    width = 1
    while 2 * width <= q:
        half = spans[width]
        factor = np.uint64(pow(base, width, 1 << 64))
        spans[2 * width] = half[:-width] * factor + half[width:]
        width *= 2
    out, done = spans[width], width
    while done < q:
        part = 1 << ((q - done).bit_length() - 1)
        size = len(data) - done - part + 1
        out = out[:size] * np.uint64(pow(base, part, 1 << 64)) + spans[part][done : done + size]
        done += part
    return (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


# --- windows ----------------------------------------------------------------------------------


def windows(text: bytes, budget: Budget) -> list[bytes]:
    """Overlapping windows of a text in normal form; the last one ends with the text."""
    text = text.rstrip(b" ")
    if len(text) < budget.least:
        return []
    last = max(0, len(text) - budget.window)
    begins = [*range(0, last, budget.stride), last]
    return [text[at : at + budget.window] for at in begins]


def _store_windows(benchmark: DataFrame, budget: Budget) -> tuple[str, int]:
    """Write the windows by block; returns the folder and the number of blocks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE, "text"):
            data, upto = normal(batch.column("text"))
            items, found = [], []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                for window in windows(data[upto[i] : upto[i + 1]].tobytes(), budget):
                    items.append(item)
                    found.append(window)
            yield pa.RecordBatch.from_pydict(
                {"item_id": pa.array(items, pa.int64()), "window": pa.array(found, pa.binary())}
            )

    path = scratch_path(benchmark.sparkSession, "windows")
    asked = benchmark.select(
        F.coalesce(c("item_id").cast("long"), F.lit(-1)).alias("item_id"), "text"
    )
    cuts = asked.mapInArrow(cut, "item_id long, window binary").distinct()
    cuts.write.parquet(f"{path}/all")
    cuts = benchmark.sparkSession.read.parquet(f"{path}/all")
    blocks = -(-cuts.count() // BLOCK)
    block = F.pmod(F.xxhash64("item_id", "window"), F.lit(max(1, blocks))).cast("int")
    cuts.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(
        f"{path}/blocks"
    )
    return f"{path}/blocks", blocks


class Index:
    """The q-grams of a block of windows."""

    def __init__(self, table: pa.Table, budget: Budget):
        self.budget = budget
        self.items = table.column("item_id").to_numpy()
        texts = table.column("window").to_pylist()
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.edits = np.array([budget.edits(len(x)) for x in texts], np.int64)
        self.bounds = self.lengths + 1 - budget.q - budget.q * self.edits
        self.step = self.edits + 1
        self.letters = np.zeros((len(texts), budget.window), np.uint8)
        hashes, owners, places = [], [], []
        for i, text in enumerate(texts):
            data = np.frombuffer(text, np.uint8)
            self.letters[i, : len(data)] = data
            hashes.append(q_grams(data, budget.q))
            owners.append(np.full(len(hashes[-1]), i))
            places.append(np.arange(len(hashes[-1])))
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.owners = np.concatenate([*owners, np.zeros(0, np.int64)])[order].astype(np.int64)
        self.places = np.concatenate([*places, np.zeros(0, np.int64)])[order].astype(np.int64)
        self.known, self.first, self.count = np.unique(
            flat[order], return_index=True, return_counts=True
        )
        self.bits = np.uint64(64 - min(24, max(16, int(64 * len(self.known)).bit_length())))
        self.there = np.zeros(1 << (64 - int(self.bits)), bool)
        self.there[self.known >> self.bits] = True

    def found(self, data: np.ndarray, upto: np.ndarray) -> list[set[int]]:
        """The items of which each text holds a window."""
        out: list[set[int]] = [set() for _ in range(len(upto) - 1)]
        if not len(self.known):
            return out
        at, rank = self._known(data)
        text = np.searchsorted(upto, at, "right") - 1
        inside = at + self.budget.q <= upto[text + 1]
        at, rank, text = at[inside], rank[inside], text[inside]
        hits = np.cumsum(self.count[rank])
        begin = 0
        while begin < len(at):
            before = hits[begin] - self.count[rank[begin]]
            end = int(np.searchsorted(hits, before + HITS, "right"))
            if end < len(at):
                # The hits of a text stay together.
                end = int(np.searchsorted(text, text[end]))
                if end <= begin:
                    end = int(np.searchsorted(text, text[begin], "right"))
            regions = self._hit(at[begin:end], rank[begin:end], text[begin:end])
            for first in range(0, len(regions[0]), ALIGNED):
                some = [x[first : first + ALIGNED] for x in regions]
                for i, window in zip(*self._aligned(data, upto, *some)):
                    out[i].add(int(self.items[window]))
            begin = end
        return out

    def _known(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the q-grams of windows lie in the bytes, and which these are."""
        places, ranks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for begin in range(0, len(data) - self.budget.q + 1, PIECE):
            hashes = q_grams(data[begin : begin + PIECE + self.budget.q - 1], self.budget.q)
            at = np.flatnonzero(self.there[hashes >> self.bits])
            rank = np.searchsorted(self.known, hashes[at])
            rank[rank == len(self.known)] = 0
            real = self.known[rank] == hashes[at]
            places.append(at[real] + begin)
            ranks.append(rank[real])
        return np.concatenate(places), np.concatenate(ranks)

    def _hit(self, at, rank, text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The regions of these q-grams: each is a hit for every window that holds it."""
        times = self.count[rank]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        posting = np.repeat(self.first[rank], times) + nth
        diagonal = np.repeat(at, times) - self.places[posting]
        return self._regions(np.repeat(text, times), self.owners[posting], diagonal)

    def _regions(self, text, owner, diagonal) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, window and first diagonal of the bands with q-grams enough.

        Bands begin every e + 1 diagonals and are 3e + 1 wide, so any 2e + 1 lie in one band.
        """
        step, edits = self.step[owner], self.edits[owner]
        keys = []
        for back in range(int((2 * self.edits // self.step).max(initial=0)) + 1):
            band = diagonal // step - back
            inside = diagonal < band * step + step + 2 * edits
            keys.append(np.stack([text[inside], owner[inside], band[inside]], axis=1))
        bands, counts = np.unique(np.concatenate(keys), axis=0, return_counts=True)
        text, owner, band = bands[counts >= self.bounds[bands[:, 1]]].T
        return text, owner, band * self.step[owner]

    def _aligned(self, data, upto, text, owner, diagonal) -> tuple[np.ndarray, np.ndarray]:
        """Of the regions, those in which the window lies with at most its edits.

        ``cost[:, o]`` is the least number of edits of the window's first i bytes against the
        region's bytes up to i + o, from any beginning.
        """
        if not len(text):
            return text, owner
        edits, lengths = self.edits[owner], self.lengths[owner]
        most = int(edits.max())
        begin = diagonal - edits
        width = int((self.step[owner] + 4 * edits).max()) + 1
        span = np.arange(self.budget.window + width)
        at = begin[:, None] + span
        inside = (at >= upto[text][:, None]) & (at < upto[text + 1][:, None])
        region = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
        far = np.int16(most + 1)
        slots = np.arange(width, dtype=np.int16)
        cost = np.zeros((len(text), width), np.int16)
        best = np.full(len(text), far)
        for i in range(1, int(lengths.max()) + 1):
            letters = self.letters[owner, i - 1][:, None]
            turned = cost + (region[:, i - 1 : i - 1 + width] != letters)
            np.minimum(turned[:, :-1], cost[:, 1:] + 1, out=turned[:, :-1])
            cost = np.minimum(np.minimum.accumulate(turned - slots, axis=1) + slots, far)
            done = lengths == i
            if done.any():
                best[done] = cost[done].min(axis=1)
        good = best <= edits
        return text[good], owner[good]


@lru_cache(maxsize=1)
def _index(path: str, block: int, budget: Budget) -> Index:
    store, base = file_system(f"{path}/block={block}")
    return Index(pq.read_table(base, filesystem=store, columns=["item_id", "window"]), budget)


def with_items(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    name: str = "items",
    budget: Budget = Budget(),
) -> DataFrame:
    """Adds ``items`` (or ``name``): the sorted ids of the benchmark texts of which a document holds a window.

    ``benchmark`` has ``item_id`` and ``text``; null ids count as -1. Null and empty texts hold
    nothing, and benchmark texts shorter than the budget's least are not sought. Whole texts are
    searched, however long. Rows stand alone, so repeated rows and ids get one answer. Other columns
    pass through, but for one of that name, which is replaced. An empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path, blocks = _store_windows(benchmark, budget)
    docs = docs.drop(name)
    names = docs.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in slices(batches, SLICE, text):
                data, upto = normal(batch.column(text))
                found: list[set[int]] = [set() for _ in range(batch.num_rows)]
                for block in range(blocks):
                    for held, more in zip(found, _index(path, block, budget).found(data, upto)):
                        held |= more
                items = pa.array([sorted(x) for x in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, items], names=[*names, name])

    schema = docs.select("*", F.array().cast("array<long>").alias(name)).schema
    return docs.mapInArrow(search, schema)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, items and kept (no benchmark text found) of each document."""
    found = with_items(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.size("items").alias("n_items"), "items", clean())


def clean() -> Column:
    return (F.size("items") == 0).alias("kept")
