"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The distinct vectors are packed into blocks of bytes, once. A pass over the blocks gives XᵀXQ for the
centred X and a narrow Q: each task adds up its blocks, Spark sums the tasks' entries, and the driver
holds matrices of dimensions by columns alone. A polynomial of many such passes damps all directions
whose eigenvalues lie below the wanted ones; QR and a Rayleigh-Ritz step then turn the columns to
eigenvectors. This is repeated until the residuals show that the wanted ones are as good as double
precision allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pitchside.llm.common import Scratch, bound_batches

c = F.col

#: Whole numbers of a vector stay below this; entries beyond it count as not finite.
LARGEST = 1 << 50
#: Vectors of a block, and bytes of its numbers as doubles, at most.
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
INT64 = 1 << 63


@dataclass(frozen=True)
class Search:
    """How the eigenvectors are sought."""

    #: Components wanted.
    wanted: int = 4
    #: Columns of Q besides: the more, the farther the damped eigenvalues lie from the wanted ones.
    guard: int = 28
    #: Degree of the polynomial, which is the number of passes of a round, and rounds at most.
    degree: int = 12
    rounds: int = 40
    #: Steps of the Lanczos process that bounds the spectrum from below.
    probes: int = 8
    #: Residual over the largest eigenvalue at which a component is certified.
    tolerance: float = 1e-13
    #: The residual that must be reached where rounding lets none go down further.
    accepted: float = 1e-10
    #: A component whose eigenvalue is below this share of the trace has no spread to divide by.
    flat: float = 1e-12
    seed: int = 1


@dataclass
class Fit:
    """What whitening needs: ``mean`` is S/n, ``vectors`` has a column for each component."""

    n: int
    sums: list[int]
    mean: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    flat: np.ndarray
    #: Largest entry of the whitened fit list's covariance minus the identity.
    error: float = 0.0
    passes: int = 0


# --- whole numbers ----------------------------------------------------------------------------


def scaled(docs: DataFrame, vector: str, factor: int = 256) -> DataFrame:
    """Rows whose ``vector`` is whole, with ``x``: floor of ``factor`` times each entry, as long.

    Rows with a null vector or a null, infinite or not-a-number entry go, and so do rows with an entry
    that lies beyond 2^50 after scaling, where sums of a block no longer fit a long.
    """
    x = F.transform(c(vector), lambda e: e.cast("double") * factor)
    # A null entry or nan isn't below; `forall` gives null for a null among entries that pass.
    whole = F.forall(x, lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False)))
    return docs.withColumn("x", F.when(whole, x)).where(c("x").isNotNull()).withColumn(
        "x", F.transform("x", lambda e: F.floor(e))
    )


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch, as bounded as a block, each with the matrix of its ``x``."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
    for begin in range(0, batch.num_rows, rows):
        part = batch.slice(begin, rows)
        flat = part.column("x").flatten().to_numpy(zero_copy_only=False)
        yield part, flat.reshape(part.num_rows, width)


def packed(distinct: DataFrame, width: int) -> DataFrame:
    """``distinct`` vectors ``x`` as blocks: ``rows``, and their numbers in as few bytes as hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _parts(batch, width):
                size = next(
                    s for s in ("<i2", "<i4", "<i8") if np.abs(part).max() <= np.iinfo(s).max
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(part)], pa.int32()), pa.array([size]),
                        pa.array([part.astype(size).tobytes()], pa.binary()),
                    ],
                    names=["rows", "kind", "data"],
                )

    bound_batches(distinct.sparkSession)
    return distinct.select("x").mapInArrow(run, "rows int, kind string, data binary")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
            yield np.frombuffer(data.as_buffer(), kind).reshape(-1, width)


# --- passes -----------------------------------------------------------------------------------


def column_sums(blocks: DataFrame, width: int) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * width
        for part in _blocks(batches, width):
            # A block's 4,096 numbers below 2^50 add up to less than 2^63.
            sums = [a + b for a, b in zip(sums, part.astype(np.int64).sum(axis=0).tolist())]
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(width), pa.int32()), "total": pa.array(map(str, sums))}
        )

    found = blocks.mapInArrow(run, "i int, total string").groupBy("i").agg(
        F.sum(c("total").cast("decimal(38,0)")).alias("total")
    )
    told = {r["i"]: int(r["total"]) for r in found.collect()}
    return [told[i] for i in range(width)]


def summed(
    blocks: DataFrame, width: int, mean: np.ndarray, shape: tuple[int, ...],
    part: Callable[[np.ndarray], np.ndarray],
) -> np.ndarray:
    """The sum of ``part`` over the centred blocks.

    A task hands on one matrix as numbered entries, which Spark sums; so neither the tasks' matrices
    nor any rows of data come to the driver.
    """
    size = int(np.prod(shape, dtype=int))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for block in _blocks(batches, width):
            total += part(block - mean)
        entries = {"i": pa.array(np.arange(size, dtype=np.int32)), "v": pa.array(total.ravel())}
        yield pa.RecordBatch.from_pydict(entries)

    rows = blocks.mapInArrow(run, "i int, v double")
    found = rows.groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.empty(size)
    out[found["i"].to_numpy()] = found["v"].to_numpy()
    return out.reshape(shape)


# --- eigenvectors -----------------------------------------------------------------------------


def spectrum_floor(apply: Callable[[np.ndarray], np.ndarray], width: int, search: Search) -> float:
    """A number that the least eigenvalue hardly lies below, by some Lanczos steps.

    It only steers the polynomial. A bound too high would damp less, and the residuals would tell.
    """
    q = np.random.default_rng(search.seed).standard_normal((width, 1))
    q /= np.linalg.norm(q)
    basis, diagonal, beside = [q], [], []
    for _ in range(min(search.probes, width)):
        w = apply(basis[-1])
        diagonal.append((basis[-1].T @ w).item())
        for v in basis + basis:
            w = w - v * (v.T @ w).item()
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        basis.append(w / beside[-1])
    steps = len(diagonal)
    inner = np.diag(diagonal) + np.diag(beside[: steps - 1], 1) + np.diag(beside[: steps - 1], -1)
    values, vectors = np.linalg.eigh(inner)
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0])))


def filtered(
    apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray,
    low: float, high: float, top: float, degree: int,
) -> np.ndarray:
    """The Chebyshev polynomial of the matrix times ``q``, small on [low, high] and 1 at ``top``.

    ``vq`` is the matrix times ``q``, so the first step takes no pass.
    """
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        then = 1 / (2 / first - sigma)
        now, before = (
            (apply(now) - centre * now) * (2 * then / half) - (sigma * then) * before, now,
        )
        sigma = then
    return now


def leading(
    apply: Callable[[np.ndarray], np.ndarray], width: int, search: Search = Search()
) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues and their eigenvectors, ``search.wanted`` at most, certified.

    Components with equal eigenvalues are any basis of their space.
    """
    columns = min(width, search.wanted + search.guard)
    wanted = min(width, search.wanted)
    draw = np.random.default_rng(search.seed)
    q = np.linalg.qr(draw.standard_normal((width, columns)))[0]
    low = spectrum_floor(apply, width, search) if columns < width else 0.0
    best = stalled = None
    for _ in range(search.rounds):
        vq = apply(q)
        inner = q.T @ vq
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = np.linalg.norm(vq - q * values, axis=0)[:wanted].max()
        top = max(values[0], 0.0)
        if residual <= search.tolerance * top or columns == width:
            return values[:wanted], q[:, :wanted]
        # Once within reach of rounding, a round that gains nothing is the last.
        if residual <= search.accepted * top and best is not None and residual >= best / 2:
            stalled = True
        best = residual if best is None else min(best, residual)
        if stalled:
            return values[:wanted], q[:, :wanted]
        # The least of the block bounds what is not in it, as far as is known.
        high = max(values[-1], low + 1e-9 * top)
        q = np.linalg.qr(filtered(apply, q, vq, min(low, high), high, top, search.degree))[0]
    raise ArithmeticError(f"no components after {search.rounds} rounds; residual {residual / top:g}")


def fit(docs: DataFrame, vector: str, scratch: Scratch, search: Search = Search()) -> Fit | None:
    """Components of the distinct whole-number vectors of ``docs``; None if there are none.

    The driver holds the sums, some matrices of dimensions by columns, and no rows.
    """
    rows = docs.select("x")
    size = F.size("x").alias("width")
    # The commonest length, the greater of two equally common.
    widths = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("width")).head(1)
    if not widths or not widths[0]["width"]:
        return None
    width = widths[0]["width"]
    distinct = rows.where(F.size("x") == width).distinct()
    blocks = scratch.store(packed(distinct, width), "whitening-blocks")
    n = int(blocks.agg(F.sum("rows")).first()[0])
    sums = column_sums(blocks, width)
    mean = np.array([s / n for s in sums])
    count = [0]

    def apply(q: np.ndarray) -> np.ndarray:
        count[0] += 1
        return summed(blocks, width, mean, q.shape, lambda x: x.T @ (x @ q)) / n

    spread = summed(blocks, width, mean, (width, 1), lambda x: (x * x).sum(axis=0)[:, None]) / n
    trace = float(spread.sum())
    if trace == 0:
        wanted = min(width, search.wanted)
        vectors, values = np.eye(width)[:, :wanted], np.zeros(wanted)
    else:
        values, vectors = leading(apply, width, search)
    flat = values <= search.flat * trace
    found = Fit(n, sums, mean, vectors, values, trace, flat, passes=count[0])
    turn = found.vectors[:, ~flat] / np.sqrt(values[~flat])
    k = turn.shape[1]
    if k:
        # The first column is the mean of the whitened list, which the covariance is centred by.
        def products(x: np.ndarray) -> np.ndarray:
            white = x @ turn
            return np.hstack([white.sum(axis=0)[:, None], white.T @ white])

        told = summed(blocks, width, mean, (k, k + 1), products) / n
        covariance = told[:, 1:] - told[:, :1] @ told[:, :1].T
        found.error = float(np.abs(covariance - np.eye(k)).max())
    return found


# --- rows -------------------------------------------------------------------------------------


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum of (n * x - S)^2 of each row; None where a long can't hold it."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if reach * reach * x.shape[1] < INT64:
        apart = x * np.int64(n) - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    out = []
    for row in x.tolist():
        total = sum((n * e - s) ** 2 for e, s in zip(row, sums))
        out.append(total if total < INT64 else None)
    return out


TOLD = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def with_components(
    docs: DataFrame, *, key: str = "vec_id", vector: str = "embedding", search: Search = Search()
) -> DataFrame:
    """``key`` and what each component says of the row's vector, a row for each component.

    Vectors of another length than the commonest have no place among the others and go like null ones;
    so do empty ones. A component without spread has a null ``whitened``, and no part in
    ``identity_error``; without any spread ``explained`` is null. A ``deviation`` beyond a long is null.
    Repeated rows and repeated or null keys get rows each. Without vectors there are no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    rows = scaled(docs.select(key, vector), vector).select(key, "x")
    typed = rows.select(key).schema.simpleString()[len("struct<"):-1]
    schema = f"{typed}, {TOLD}"
    found = fit(rows, vector, scratch, search)
    scratch.clear()
    if found is None:
        return spark.createDataFrame([], schema)
    width, k = found.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = np.sqrt(np.where(found.flat, 1, found.values))
        explained = found.values / found.trace if found.trace else np.full(k, np.nan)
        for batch in batches:
            for part, x in _parts(batch, width):
                white = (x - found.mean) @ found.vectors / root
                repeat = np.repeat(np.arange(len(x)), k)
                apart = pa.array(deviations(x, found.n, found.sums), pa.int64())
                every = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(repeat)),
                        pa.array(np.tile(np.arange(1, k + 1), every), pa.int32()),
                        pa.array(np.full(every * k, found.n), pa.int64()),
                        apart.take(pa.array(repeat)),
                        pa.array(white.ravel(), mask=np.tile(found.flat, every)),
                        pa.array(np.tile(explained, every), from_pandas=True),
                        pa.array(np.full(every * k, found.error)),
                    ],
                    names=[key, *[x.split()[0] for x in TOLD.split(", ")]],
                )

    return rows.where(F.size("x") == width).mapInArrow(run, schema)
