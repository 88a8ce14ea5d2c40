"""A quality classifier: a linear model on n-gram indicators scaled by class log-count ratios.

A text's indicators are hashed n-grams of its words and of their shapes, each counted once. Every
indicator is scaled by how much likelier one class has it than the other, rows are brought to length
1, and a model with hinge loss is fitted by dual coordinate descent. The sample stays in Spark: in each
round tasks descend on the rows they hold against a common weight vector, and the driver adds up what
they changed. Its share of held-back rows turns margins to probabilities.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pitchside.llm.common import (
    PartFile, Scratch, bound_batches, drop_path, file_system, held_out, slices,
)

c = F.col

#: Buckets of hashed indicators, as a power of 2. One row has as many indicators at most.
BITS = 18
SIZE = 1 << BITS
SLICE = 4 << 20
#: Words a task remembers, and their length at most. Others are looked at anew each time.
WORDS_KEPT, LENGTH_KEPT = 300_000, 40
#: Words of a text taken in one step.
STEP = 1 << 16
#: Hashes of ids for the sample.
HASHES = 1 << 40
RUN = re.compile(r"(.)\1+", re.DOTALL)
#: Odd numbers that spread hashes.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
BESIDE = np.uint64(0xC2B2AE3D27D4EB4F)
ONCE_MORE = np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Learning:
    """The bounded sample and the fit."""

    #: Ids of each label that teach, by a hash of the id.
    rows: int = 5_000
    #: One of so many sampled rows is held back for the probabilities.
    held_back: int = 5
    #: Added to the counts of the log-count ratios.
    smoothing: float = 1.0
    #: The greatest dual weight of a row, which is the price of its hinge loss.
    cost: float = 1.0
    #: The share of the fitted weights against their mean size.
    fitted: float = 0.25
    #: Passes of a task over its rows in a round, rounds at most, and the gap between primal and dual
    #: objective, over the primal one, that ends them.
    passes: int = 10
    rounds: int = 30
    gap: float = 0.02
    #: Files of the sample, which bound the tasks that descend side by side.
    parts: int = 4
    threshold: float = 0.7


# --- indicators -------------------------------------------------------------------------------


def shape(word: str) -> str:
    """Runs of capitals, other letters and digits as one A, a or 0; runs of any other sign as one."""
    if word.isalpha() and word.islower():
        return "a"
    kinds = ["A" if x.isupper() else "a" if x.isalpha() else "0" if x.isdigit() else x for x in word]
    return RUN.sub(r"\1", "".join(kinds))


class Known(dict):
    """Hashes of words: of the lower-cased word above 32 bits, of its shape below."""

    def __missing__(self, word: str) -> int:
        lowered = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        found = lowered << 32 | zlib.crc32(shape(word).encode("utf-8", "surrogatepass"))
        if len(self) < WORDS_KEPT and len(word) <= LENGTH_KEPT:
            self[word] = found
        return found


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes + np.uint64(kind)) * SPREAD) >> np.uint64(64 - BITS)


def indicators(text: str, known: Known) -> np.ndarray:
    """The distinct buckets of a text, ascending.

    These are its words, pairs of neighbours, one to three neighbouring shapes, and whether a word is
    equal to the one before it.
    """
    words = text.split()
    found = [np.empty(0, np.uint64)]
    for begin in range(0, len(words), STEP):
        # Two words of the step before, so that no neighbours are parted.
        some = words[max(0, begin - 2) : begin + STEP]
        both = np.fromiter(map(known.__getitem__, some), np.uint64, len(some))
        word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        two = form[:-1] * BESIDE + form[1:]
        again = both[:-1] == both[1:]
        found += [
            np.unique(_buckets(x, kind))
            for kind, x in enumerate(
                [
                    word, word[:-1] * BESIDE + word[1:], form, two,
                    two[:-1] * ONCE_MORE + form[2:], form[1:][again],
                ],
                start=1,
            )
        ]
    return np.unique(np.concatenate(found)).astype(np.int32)


# --- the model --------------------------------------------------------------------------------


@dataclass
class Model:
    """``ratios`` scale indicators; ``weights`` are of scaled ones; the margin's logistic is the score."""

    ratios: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    #: Gap between primal and dual objective when the fit ended, over the primal one; and its rounds.
    gap: float = 0.0
    rounds: int = 0

    def __post_init__(self):
        self.scaled, self.squares = self.weights * self.ratios, self.ratios**2

    def __reduce__(self):
        # What follows from the rest is not sent to tasks.
        told = (self.bias, self.slope, self.offset, self.gap, self.rounds)
        return Model, (self.ratios, self.weights, *told)

    def margin(self, at: np.ndarray) -> float:
        norm = float(np.sqrt(self.squares[at].sum()))
        return float(self.scaled[at].sum()) / norm + self.bias if norm else self.bias

    def score(self, at: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(at) + self.offset, -500, 500))))


def log_count_ratios(low: np.ndarray, high: np.ndarray, smoothing: float) -> np.ndarray:
    """How much likelier an indicator is among the texts of label 1, as a logarithm.

    Buckets that no text has are 0, so they say nothing.
    """
    high_share = (high + smoothing) / (high + smoothing).sum()
    low_share = (low + smoothing) / (low + smoothing).sum()
    return np.where(low + high > 0, np.log(high_share / low_share), 0.0)


def descend(
    rows: list[np.ndarray], signs: np.ndarray, alphas: np.ndarray, weights: np.ndarray, bias: float,
    ratios: np.ndarray, learning: Learning, tasks: int, seed: int,
) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Dual coordinate descent on one task's rows; returns alphas, changes of weights and bias, and
    the hinge loss before.

    ``tasks`` descend at once and their changes are added up, so each sees its own change that many
    times (the safe bound when nothing is known of how the tasks' rows overlap).
    """
    own, own_bias, loss = weights.copy(), bias, 0.0
    values = [ratios[at] for at in rows]
    values = [v / max(np.sqrt((v * v).sum()), 1e-12) for v in values]
    alphas = alphas.copy()
    for at, v, sign in zip(rows, values, signs):
        loss += max(0.0, 1 - sign * (float(weights[at] @ v) + bias))
    draw = np.random.default_rng(seed)
    for _ in range(learning.passes):
        for i in draw.permutation(len(rows)).tolist():
            at, v, sign = rows[i], values[i], signs[i]
            length = tasks * (float(v @ v) + 1)
            slack = sign * (float(own[at] @ v) + own_bias) - 1
            new = min(max(alphas[i] - slack / length, 0.0), learning.cost)
            step = (new - alphas[i]) * sign * tasks
            if step:
                alphas[i] = new
                own[at] += step * v
                own_bias += step
    return alphas, (own - weights) / tasks, (own_bias - bias) / tasks, loss


def fit_probabilities(
    margins: np.ndarray, labels: np.ndarray, shares: tuple[float, float]
) -> tuple[float, float]:
    """Slope and offset of a logistic function by Newton's method.

    Rows are weighted so that the labels have their ``shares``; targets are drawn in from 0 and 1 as
    the labels' numbers allow, so that parted classes give finite numbers.
    """
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    targets = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    each = np.where(labels == 1, shares[1] / max(1, ones), shares[0] / max(1, zeros)) * len(labels)
    design = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])

    def cost(b):
        z = design @ b
        return float((each * (np.logaddexp(0, z) - targets * z)).sum() + 1e-6 * b @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -500, 500)))
        slope = design.T @ (each * (p - targets)) + 2e-6 * at
        curve = (design * (each * p * (1 - p))[:, None]).T @ design + 2e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and cost(at - size * step) > cost(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


# --- learning ---------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _known() -> Known:
    return Known()


def sampled(labels: DataFrame, label: str, n: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id`` and ``label`` of the ``n`` ids of each label with the least hashes, and all counts.

    An id that is labelled twice has the lower label. Only a share of the hashes that holds four times
    as many ids is ordered, however many are labelled.
    """
    known = labels.where(c("doc_id").isNotNull() & c(label).isNotNull()).groupBy("doc_id").agg(
        F.min(F.when(c(label) == 1, 1).otherwise(0)).alias("label")
    )
    known = known.withColumn("hash", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value, total in sorted(counts.items()):
        reach = min(HASHES, HASHES * 4 * n // total)
        some = known.where((c("label") == value) & (c("hash") <= reach))
        some = some.orderBy("hash", "doc_id").limit(n).select("doc_id", "label")
        chosen = some if chosen is None else chosen.unionByName(some)
    return chosen, counts


def sample_rows(docs: DataFrame, chosen: DataFrame, learning: Learning, scratch: Scratch) -> DataFrame:
    """Each sampled id's label and indicators, packed; stored in a few files.

    The texts of an id are read in the tasks; of several, the one with the most indicators teaches, of
    these the one with the greatest checksum.
    """
    bound_batches(docs.sparkSession)
    names = ["doc_id", "label", "held", "size", "packed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known()
        for batch in batches:
            for part in slices([batch], SLICE, "text"):
                found = [indicators(x or "", known) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("label"), part.column("held"),
                        pa.array([len(x) for x in found], pa.int32()),
                        pa.array([x.tobytes() for x in found], pa.binary()),
                    ],
                    names=names,
                )

    # Independent of the order of the sample, which is by xxhash.
    held = (F.crc32(F.concat(F.lit("held back "), c("doc_id").cast("string")).cast("binary"))
            % learning.held_back == 0)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "text", "label", held.alias("held"))
    kind = docs.select("doc_id").dtypes[0][1]
    packed = rows.mapInArrow(
        run, f"doc_id {kind}, label int, held boolean, size int, packed binary"
    )
    best = packed.groupBy("doc_id", "label", "held").agg(
        F.max(F.struct("size", F.crc32("packed").alias("crc"), "packed"))["packed"].alias("packed")
    )
    return scratch.store(
        best.repartition(learning.parts, "doc_id").sortWithinPartitions("doc_id")
        .select(F.monotonically_increasing_id().alias("rid"), "label", "held", "packed"),
        "classifier-sample",
    )


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    for batch in batches:
        data = zip(batch.column("rid").to_pylist(), batch.column("label").to_pylist(),
                   batch.column("packed"))
        for rid, label, packed in data:
            yield rid, label, np.frombuffer(packed.as_buffer(), np.int32)


def _counts(rows: DataFrame) -> np.ndarray:
    """Texts of either label that have an indicator; the driver gets a row for each bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE), np.int64)
        for _, label, at in _held(batches):
            total[label, at] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(at.astype(np.int32)), "low": total[0, at], "high": total[1, at]}
        )

    told = rows.mapInArrow(run, "i int, low long, high long").groupBy("i")
    told = told.agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toArrow()
    out = np.zeros((2, SIZE))
    out[:, told["i"].to_numpy()] = [told["low"].to_numpy(), told["high"].to_numpy()]
    return out


def _written(arrays: np.ndarray, folder: str, label: str) -> str:
    """The path of a file with ``arrays`` in a folder that tasks reach."""
    file = PartFile(folder, label)
    file.append(arrays.tobytes())
    file.close()
    return f"{folder}/{file.name}"


def _read(path: str) -> np.ndarray:
    store, at = file_system(path)
    with store.open_input_file(at) as file:
        return np.frombuffer(file.read(), float).reshape(2, SIZE)


def _descended(
    rows: DataFrame, ratios: np.ndarray, learning: Learning, scratch: Scratch
) -> Model:
    """Rounds of descent in tasks. The driver holds weights, one number for each row, and changes.

    Tasks read a round's weights from a file: as a part of the job they would stay, round by round, in
    every executor's store.
    """
    folder = scratch.path("classifier-weights")
    tasks = max(1, rows.rdd.getNumPartitions())
    weights, bias, gap = np.zeros(SIZE), 0.0, 1.0
    rids, alphas = np.empty(0, np.int64), np.empty(0)
    schema = ("rids array<long>, alphas array<double>, i array<int>, v array<double>,"
              " bias double, loss double")
    done = 0
    for done in range(1, learning.rounds + 1):
        path = _written(np.stack([weights, ratios]), folder, f"round-{done}")
        start_bias = bias

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(_held(batches))
            if not held:
                return
            now, scale = _read(path)
            own = np.array([x[0] for x in held])
            signs = np.array([1.0 if x[1] else -1.0 for x in held])
            start = np.zeros(len(own))
            if len(rids):
                start = alphas[np.searchsorted(rids, own)]
            after, change, moved, loss = descend(
                [x[2] for x in held], signs, start, now, start_bias, scale, learning, tasks,
                done * 1_000 + int(own[0]) % 997,
            )
            at = np.flatnonzero(change)
            yield pa.RecordBatch.from_pydict(
                {"rids": [own], "alphas": [after], "i": [at.astype(np.int32)], "v": [change[at]],
                 "bias": [moved], "loss": [loss]}
            )

        # As Arrow's columns: lists of Python numbers would take many times their room.
        found = rows.mapInArrow(run, schema).toArrow()
        drop_path(rows.sparkSession, path)
        told = [
            {name: value.values.to_numpy() if name in ("rids", "alphas", "i", "v") else value.as_py()
             for name, value in ((x, found[x][k]) for x in found.column_names)}
            for k in range(found.num_rows)
        ]
        told.sort(key=lambda r: r["rids"][0])
        loss = sum(r["loss"] for r in told)
        primal = (weights @ weights + bias**2) / 2 + learning.cost * loss
        dual = alphas.sum() - (weights @ weights + bias**2) / 2
        gap = (primal - dual) / max(primal, 1e-12)
        if len(rids) and gap <= learning.gap:
            break
        for r in told:
            weights[r["i"]] += r["v"]
            bias += r["bias"]
        rids = np.concatenate([r["rids"] for r in told])
        order = np.argsort(rids)
        rids, alphas = rids[order], np.concatenate([r["alphas"] for r in told])[order]
    return Model(ratios, weights, bias, gap=float(gap), rounds=done)


def learned(
    docs: DataFrame, labels: DataFrame, label: str = "quality", learning: Learning = Learning()
) -> Model:
    """The model of the labelled rows given, fitted on a sample that ``learning.rows`` bounds.

    ``labels`` has ``doc_id`` and ``label``; rows with a null in either and ids that aren't in ``docs``
    teach nothing. Without both labels the score is a constant: the known label's share, 0.5 without
    any.
    """
    scratch = Scratch(docs.sparkSession)
    chosen, counts = sampled(labels, label, learning.rows)
    if chosen is None:
        return Model()
    chosen = scratch.store(chosen, "classifier-ids")
    rows = sample_rows(docs, chosen, learning, scratch)
    there = {(r["label"], r["held"]) for r in rows.select("label", "held").distinct().collect()}
    found = {x for x, _ in there}
    if len(found) < 2:
        scratch.clear()
        return Model(offset={0: -500.0, 1: 500.0}[found.pop()] if found else 0.0)
    # A small sample may hold back no row of a label, or all; then all rows do both.
    parted = len(there) == 4
    teach, tell = (rows.where("not held"), rows.where("held")) if parted else (rows, rows)
    low, high = _counts(teach)
    ratios = log_count_ratios(low, high, learning.smoothing)
    model = _descended(teach, ratios, learning, scratch)
    # The fitted weights are drawn towards their mean size, at which the ratios alone speak.
    mean = np.abs(model.weights).sum() / max(1, np.count_nonzero(low + high))
    weights = (1 - learning.fitted) * mean + learning.fitted * model.weights
    model = Model(model.ratios, weights, model.bias * learning.fitted, gap=model.gap,
                  rounds=model.rounds)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, known, at in _held(batches):
            yield pa.RecordBatch.from_pydict({"label": [known], "margin": [model.margin(at)]})

    told = tell.mapInArrow(margins, "label long, margin double").toArrow()
    total = sum(counts.values())
    model.slope, model.offset = fit_probabilities(
        told["margin"].to_numpy(), told["label"].to_numpy(),
        (counts.get(0, 0) / total, counts.get(1, 0) / total),
    )
    scratch.clear()
    return model


@lru_cache(maxsize=1)
def _model(key: bytes) -> Model:
    return pickle.loads(key)


def with_scores(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Adds ``score``: the probability of label 1. Only the text is read.

    A null or empty text has no indicators and scores by the model's bias. Rows stand alone, so
    repeated rows get one answer. A column ``score`` is replaced, others pass through.
    """
    bound_batches(docs.sparkSession)
    key = pickle.dumps(model)
    docs = docs.drop("score")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = _model(key), _known()
        for batch in slices(batches, SLICE, text):
            found = [model.score(indicators(x or "", known)) for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], names=[*names, "score"]
            )

    return docs.mapInArrow(run, docs.withColumn("score", F.lit(0.0)).schema)


def quality_report(
    docs: DataFrame, labels: DataFrame, learning: Learning = Learning()
) -> DataFrame:
    """doc_id, held_out, score and predicted; learns from labels that aren't held out."""
    model = learned(docs, labels.where(~held_out()), "quality", learning)
    told = with_scores(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", held_out().alias("held_out"), "score",
        (c("score") >= learning.threshold).cast("int").alias("predicted"),
    )
