"""Toxicity by a linear-chain conditional random field over words.

Documents are labelled as wholes, so tokens get their labels first: the features of words (the word
and its beginnings) that occur in toxic documents of the sample and hardly in others. A chain of two
tags is fitted to windows of these tokens. In a document, forward and backward sums give each token's
probability of being toxic; its spans are the tokens above one half, and the document's score is a
logistic function, fitted on the same sample, of the greatest probability and of their sum.
"""

from __future__ import annotations

import heapq
import pickle
import re
import string
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from pitchside.llm.common import bound_batches, held_out, slices, stored

c = F.col

#: The words that ``str.split`` gives, where their places are wanted.
WORD = re.compile(r"\S+")
#: What is stripped from both ends of a word.
EDGES = string.punctuation + "«»“”„‘’‚…–—¿¡·•"
#: Lengths of a word's beginnings that are features.
BEGINNINGS = range(4, 9)
#: Words of a segment, and of its context on either side. Beyond the context, a chain of two tags
#: has forgotten where it came from.
SEGMENT, CONTEXT = 256, 16
SLICE = 4 << 20
#: Hashes of ids for the sample.
HASHES = 1 << 40
WORDS_KEPT = 500_000
#: Of two texts with this Jaccard of their sets of words or more, one is a copy.
COPY_PERCENT = 80


@dataclass(frozen=True)
class Learning:
    """The bounded sample and the fit."""

    #: Rows of each label, chosen by a hash of their ids. Their whole texts teach.
    toxic_rows: int = 2_500
    other_rows: int = 5_000
    #: A feature marks tokens as toxic if so many toxic texts have it, and for each of those fewer
    #: than this share of others.
    least_texts: int = 5
    most_others: float = 0.12
    #: A toxic text needs so many marking features, if it has them.
    explained: int = 6
    #: Words on either side of a marked token in a training window, and windows of a text: around
    #: marked tokens spread over all of them, and around any.
    around: int = 6
    marked_windows: int = 4
    other_windows: int = 2
    epochs: int = 8
    batch: int = 128
    rate: float = 0.3
    #: Pull of the weights to 0.
    decay: float = 1e-4
    #: Documents with this score or more are called toxic.
    threshold: float = 0.3


# --- features ---------------------------------------------------------------------------------


def core(word: str) -> str:
    return word.lower().strip(EDGES)


def features(word: str) -> list[str]:
    """Of a word without its edges: itself, its beginnings, and its end."""
    found = [f"{word[:n]}-" for n in BEGINNINGS if len(word) > n]
    return [word, *found, f"-{word[-3:]}"] if word else []


def _unlike(kinds: list[list[str]], toxic: list[bool]) -> list[int]:
    """The places of the texts that aren't copies of an earlier one with their label.

    A copy's set of words has a Jaccard of ``COPY_PERCENT`` or more with that of a text that counts.
    Such sets share one of the rarest words of each (prefix), so only texts that do are compared.
    """
    often = Counter(word for words in kinds for word in words)
    ranks = {word: rank for rank, word in enumerate(sorted(often, key=lambda x: (often[x], x)))}
    single = sum(n == 1 for n in often.values())
    sets = [np.sort(np.fromiter(map(ranks.get, words), np.int32, len(words))) for words in kinds]
    del often
    inside = np.zeros(len(ranks), bool)
    posted: dict[bool, dict[int, list[int]]] = {False: {}, True: {}}
    out = []
    for i, (words, label) in enumerate(zip(sets, toxic)):
        size = len(words)
        prefix = words[: size - -(-COPY_PERCENT * size // 100) + 1]
        # Words of a single text, which come first, are shared by none; empty texts share one place.
        shared = prefix[prefix >= single].tolist() if size else [-1]
        near = {j for word in shared for j in posted[label].get(word, ())}
        inside[words] = True
        copy = False
        for j in near:
            both = int(inside[sets[j]].sum())
            copy = copy or 100 * both >= COPY_PERCENT * (size + len(sets[j]) - both)
        inside[words] = False
        if not copy:
            out.append(i)
            for word in shared:
                posted[label].setdefault(word, []).append(i)
    return out


def _marking(kinds: list[list[str]], toxic: list[bool], learning: Learning) -> set[str]:
    """The features that mark toxic tokens, from the distinct words of each text.

    Copies would lend weight to their every word, so of texts with nearly the same words only the
    first counts. Features are taken by how many toxic texts they explain that the taken ones don't,
    until each is explained often enough; so words that merely keep company with toxic ones aren't
    taken.
    """
    held = _unlike(kinds, toxic)

    def found(i: int) -> set[str]:
        return {x for word in kinds[i] for x in features(word)[:-1]}

    own = Counter(x for i in held if toxic[i] for x in found(i))
    own = {x: n for x, n in own.items() if n >= learning.least_texts}
    others = Counter(x for i in held if not toxic[i] for x in found(i) if x in own)
    n_others = max(1, sum(not toxic[i] for i in held))
    n_own = max(1, sum(toxic[i] for i in held))
    good = {
        x for x, n in own.items()
        if others[x] / n_others < learning.most_others * n / n_own
    }
    places: dict[str, list[int]] = {x: [] for x in good}
    open_texts = {}
    for i in held:
        if toxic[i]:
            open_texts[i] = learning.explained
            for x in found(i) & good:
                places[x].append(i)
    # A shorter beginning explains no less than the word; equal ones go to the longer name.
    ranked = sorted(good, key=lambda x: (len(x), x), reverse=True)
    gains = [(-len(places[x]), rank) for rank, x in enumerate(ranked)]
    heapq.heapify(gains)
    taken: set[str] = set()
    while gains:
        told, rank = heapq.heappop(gains)
        best = ranked[rank]
        gain = sum(open_texts[i] > 0 for i in places[best])
        if gain < learning.least_texts:
            continue
        if gain < -told:
            heapq.heappush(gains, (-gain, rank))
            continue
        taken.add(best)
        for i in places[best]:
            if open_texts[i] > 0:
                open_texts[i] -= 1
    return taken


# --- the chain --------------------------------------------------------------------------------


def marginals(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag at each step of each lane; ``scores`` is (steps, lanes).

    ``moves`` holds the scores of going from tag to tag. Messages are kept as the log of the ratio of
    the two tags' sums, so that nothing overflows.
    """
    steps, lanes = scores.shape
    inside = np.arange(steps)[:, None] < lengths[None, :]

    def passed(ratio: np.ndarray, m: np.ndarray) -> np.ndarray:
        return np.logaddexp(m[0, 1], m[1, 1] + ratio) - np.logaddexp(m[0, 0], m[1, 0] + ratio)

    forward = np.zeros((steps, lanes))
    ratio = scores[0].copy() if steps else np.zeros(lanes)
    for t in range(steps):
        if t:
            ratio = passed(ratio, moves) + scores[t]
        forward[t] = ratio
    backward = np.zeros((steps, lanes))
    ratio = np.zeros(lanes)
    for t in range(steps - 2, -1, -1):
        ratio = np.where(inside[t + 1], passed(ratio + scores[t + 1], moves.T), 0.0)
        backward[t] = ratio
    out = 1 / (1 + np.exp(-np.clip(forward + backward, -60, 60)))
    return np.where(inside, out, 0.0)


def _pair_counts(scores, moves, lengths):
    """Expected number of each move over all lanes."""
    steps, lanes = scores.shape
    inside = np.arange(steps)[:, None] < lengths[None, :]
    total = np.zeros((2, 2))
    alpha = np.zeros((steps, 2, lanes))
    alpha[0] = np.stack([np.zeros(lanes), scores[0]])
    for t in range(1, steps):
        reached = alpha[t - 1][:, None, :] + moves[:, :, None]
        alpha[t] = np.logaddexp(reached[0], reached[1]) + np.stack([np.zeros(lanes), scores[t]])
    beta = np.zeros((2, lanes))
    for t in range(steps - 1, 0, -1):
        now = np.stack([np.zeros(lanes), scores[t]]) + beta
        joint = alpha[t - 1][:, None, :] + moves[:, :, None] + now[None, :, :]
        joint -= joint.max(axis=(0, 1))
        weight = np.exp(joint)
        weight /= weight.sum(axis=(0, 1))
        total += (weight * inside[t][None, None, :]).sum(axis=2)
        back = moves[:, :, None] + now[None, :, :]
        beta = np.where(inside[t], np.logaddexp(back[:, 0], back[:, 1]), 0.0)
    return total


class Chain:
    """Weights of the features, scores of the moves, and the function of the document's score."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bias, self.moves = -3.0, np.zeros((2, 2))
        self.logistic = np.array([0.0, 0.0, -10.0])

    def fit(self, windows: list[tuple[list[str], list[int]]], learning: Learning) -> None:
        """Fit the weights and moves to the windows, words and their tags each."""
        draw = np.random.default_rng(1)
        steps = 2 * learning.around + 1
        used: dict[str, int] = {}
        prepared = []
        for words, tags in windows:
            found = [
                (t, used.setdefault(x, len(used)))
                for t, word in enumerate(words)
                for x in features(word)
            ]
            pairs = np.array(list(zip(tags, tags[1:])), int).reshape(-1, 2)
            prepared.append((np.array(found, int).reshape(-1, 2), np.array(tags), pairs))
        weights, squares = np.zeros(len(used)), np.full(len(used), 1e-2)
        moves, move_squares = np.zeros((2, 2)), np.full((2, 2), 1e-2)
        bias, bias_square = self.bias, 1e-2
        for _ in range(learning.epochs):
            order = draw.permutation(len(prepared))
            for at in range(0, len(order), learning.batch):
                some = [prepared[i] for i in order[at : at + learning.batch]]
                lengths = np.array([len(tags) for _, tags, _ in some])
                t, slot = np.concatenate([found for found, _, _ in some]).T
                lane = np.repeat(np.arange(len(some)), [len(found) for found, _, _ in some])
                scores = np.full((steps, len(some)), bias)
                np.add.at(scores, (t, lane), weights[slot])
                truth = np.zeros((steps, len(some)))
                for i, (_, tags, _) in enumerate(some):
                    truth[: len(tags), i] = tags
                seen = np.zeros((2, 2))
                np.add.at(seen, tuple(np.concatenate([pairs for _, _, pairs in some]).T), 1)
                inside = np.arange(steps)[:, None] < lengths[None, :]
                error = (truth - marginals(scores, moves, lengths)) * inside
                slope = np.bincount(slot, error[t, lane], len(weights)) - learning.decay * weights
                squares += slope**2
                weights += learning.rate * slope / np.sqrt(squares)
                slope = seen - _pair_counts(scores, moves, lengths) - learning.decay * moves
                move_squares += slope**2
                moves = moves + learning.rate * slope / np.sqrt(move_squares)
                bias_square += error.sum() ** 2
                bias += learning.rate * error.sum() / np.sqrt(bias_square)
        self.weights = {x: w for x, i in used.items() if abs(w := float(weights[i])) > 1e-3}
        self.bias, self.moves = bias, moves

    def fit_score(self, told: list[tuple[float, float]], toxic: list[bool]) -> None:
        """Newton's steps for the logistic function of the signs, with a small pull to 0."""
        x = np.column_stack([np.array(told).reshape(-1, 2), np.ones(len(told))])
        y = np.array(toxic, float)
        w = np.zeros(3)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            pull = 1e-2 * np.array([1, 1, 0])
            slope = x.T @ (y - p) - pull * w
            bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6)
            w = w + np.linalg.solve(bend, slope)
        self.logistic = w

    def spread(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """The marginals of many documents' tokens, a segment of each moving together."""
        flat = np.concatenate([*scores, np.zeros(0)])
        sizes = np.array([len(x) for x in scores], int)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = upto[:-1][owner] + nth * SEGMENT
        last = np.minimum(first + SEGMENT, upto[1:][owner])
        begin = np.maximum(first - CONTEXT, upto[:-1][owner])
        end = np.minimum(last + CONTEXT, upto[1:][owner])
        out = np.zeros(len(flat))
        order = np.argsort(begin - end, kind="stable")
        for at in range(0, len(order), 2_048):
            lanes = order[at : at + 2_048]
            lengths = (end - begin)[lanes]
            steps = np.arange(int(lengths.max()))[:, None]
            place = np.minimum(begin[lanes][None, :] + steps, len(flat) - 1)
            found = marginals(flat[place], self.moves, lengths)
            own = (place >= first[lanes]) & (place < last[lanes]) & (steps < lengths[None, :])
            out[place[own]] = found[own]
        return np.split(out, upto[1:-1]) if len(scores) else []

    @staticmethod
    def signs(found: np.ndarray) -> tuple[float, float]:
        """What the score depends on: the greatest marginal's log odds, and the log of the sum."""
        if not len(found):
            return -6.0, 0.0
        most = min(max(float(found.max()), 1e-6), 1 - 1e-6)
        odds = max(-6.0, min(6.0, np.log(most / (1 - most))))
        return odds, np.log1p(float(found[found > 0.2].sum()))

    def score(self, found: np.ndarray) -> float:
        sign = np.dot(self.logistic, [*self.signs(found), 1.0])
        return float(1 / (1 + np.exp(-np.clip(sign, -30, 30))))


class Words(dict):
    """Scores of words as they stand in texts, remembered."""

    def __init__(self, chain: Chain):
        super().__init__()
        self.chain = chain

    def __missing__(self, word: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        weight = self.chain.weights.get
        self[word] = value = self.chain.bias + sum(weight(x, 0.0) for x in features(core(word)))
        return value

    def scores(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


# --- operator ---------------------------------------------------------------------------------


def windows_of(
    words: list[str], marking: set[str] | None, seed: int, learning: Learning
) -> list[tuple[list[str], list[int]]]:
    """Words and tags of a text's training windows; without ``marking``, no token is toxic."""
    tags = [int(bool(marking) and any(x in marking for x in features(w))) for w in words]
    spots = np.flatnonzero(tags)
    if len(spots) > learning.marked_windows:
        nth = np.linspace(0, len(spots) - 1, learning.marked_windows)
        spots = spots[nth.astype(int)]
    spots = spots.tolist()
    if words:
        draw = np.random.default_rng(seed)
        spots += draw.integers(0, len(words), learning.other_windows).tolist()
    out = []
    for at in spots:
        part = slice(max(0, at - learning.around), at + learning.around + 1)
        out.append((words[part], tags[part]))
    return out


def _each(
    rows: DataFrame, make: Callable[[bool, str, int], Any], kind: pa.DataType, told: str
) -> Iterator[tuple[bool, Any]]:
    """Each sampled row's label, and what ``make`` gives for its label, text and a seed, by ids.

    Texts of any length are read in the tasks; only this comes to the driver.
    """
    names = ["doc_id", "toxic", "told"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE, "text"):
            ids, toxic = batch.column("doc_id"), batch.column("toxic")
            found = [
                make(label == 1, text or "", zlib.crc32(str(key).encode()))
                for key, label, text in zip(
                    ids.to_pylist(), toxic.to_pylist(), batch.column("text").to_pylist()
                )
            ]
            yield pa.RecordBatch.from_arrays([ids, toxic, pa.array(found, kind)], names=names)

    typed = rows.select("doc_id", "toxic", F.lit(None).cast(told).alias("told"))
    found = rows.mapInArrow(run, typed.schema).toArrow()
    # As Arrow's columns; a row is made to objects only when its turn comes.
    for at in pc.sort_indices(found, [("doc_id", "ascending")]).to_pylist():
        yield found["toxic"][at].as_py() == 1, found["told"][at].as_py()


def learned(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> Chain:
    """The chain, fitted on the driver on a sample of bounded size of the labelled rows given.

    The bound is on rows. Tasks read their whole texts, and give the driver each one's set of words,
    a few windows, and the signs that the document's score is fitted on.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null in either, and ids that aren't in
    ``docs``, teach nothing, and an id that is labelled twice counts as toxic if either label says so.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.when(c("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    # The rows with the least hashes. A share of hashes that holds four times as many is cut out first,
    # so that the order is made of few rows, however many are labelled.
    wanted = {1: learning.toxic_rows, 0: learning.other_rows}
    known = known.withColumn("hash", F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)))
    counts = dict(known.groupBy("toxic").count().collect())
    reach, most = F.lit(HASHES), F.lit(0)
    for label, n in counts.items():
        share = min(HASHES, HASHES * 4 * wanted[label] // n)
        reach = F.when(c("toxic") == label, F.lit(share)).otherwise(reach)
        most = F.when(c("toxic") == label, F.lit(wanted[label])).otherwise(most)
    order = Window.partitionBy("toxic").orderBy("hash", "doc_id")
    chosen = (
        known.where(c("hash") <= reach)
        .withColumn("nth", F.row_number().over(order))
        .where(c("nth") <= most)
    )
    # At most toxic_rows + other_rows ids.
    rows = stored(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
        .dropDuplicates(["doc_id"]),
        "toxicity-sample",
    )
    bound_batches(docs.sparkSession)

    def kinds(label: bool, text: str, seed: int) -> list[str]:
        return sorted({core(x) for x in text.split()} - {""})

    # Words are held once each, however many texts have them.
    held: dict[str, str] = {}
    found, toxic = [], []
    for label, words in _each(rows, kinds, pa.list_(pa.string()), "array<string>"):
        found.append([held.setdefault(x, x) for x in words])
        toxic.append(label)
    chain = Chain()
    if not any(toxic):
        return chain
    marking = _marking(found, toxic, learning)
    del found, held

    def windows(label: bool, text: str, seed: int) -> list[dict]:
        words = [core(x) for x in text.split()]
        some = windows_of(words, marking if label else None, seed, learning)
        return [{"words": part, "tags": tags} for part, tags in some]

    kind = pa.list_(pa.struct([("words", pa.list_(pa.string())), ("tags", pa.list_(pa.int32()))]))
    told = "array<struct<words: array<string>, tags: array<int>>>"
    parts = [(x["words"], x["tags"]) for _, some in _each(rows, windows, kind, told) for x in some]
    chain.fit(parts, learning)
    key = pickle.dumps(chain)

    def signs(label: bool, text: str, seed: int) -> list[float]:
        words = _words(key)
        (found,) = words.chain.spread([words.scores(text.split())])
        return [float(x) for x in words.chain.signs(found)]

    told = _each(rows, signs, pa.list_(pa.float64()), "array<double>")
    chain.fit_score([tuple(x) for _, x in told], toxic)
    return chain


@lru_cache(maxsize=1)
def _words(key: bytes) -> Words:
    return Words(pickle.loads(key))


SPANS = "array<struct<begin: int, end: int, probability: double>>"


def with_toxicity(docs: DataFrame, chain: Chain, *, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``spans``: code points of the tokens more likely toxic than not.

    Only the text is read. A null or empty text scores as one without a token. Rows stand alone, so
    repeated rows get one answer. Columns of those names are replaced, others pass through.
    """
    bound_batches(docs.sparkSession)
    key = pickle.dumps(chain)
    docs = docs.drop("score", "spans")
    names = docs.columns
    span = pa.list_(
        pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(key)
        for batch in slices(batches, SLICE, text):
            texts = [x or "" for x in batch.column(text).to_pylist()]
            found = words.chain.spread([words.scores(x.split()) for x in texts])
            spans = []
            for one, probabilities in zip(texts, found):
                likely = np.flatnonzero(probabilities > 0.5)
                if len(likely):
                    places = [(m.start(), m.end()) for m in WORD.finditer(one)]
                    spans.append(
                        [(*places[i], float(probabilities[i])) for i in likely.tolist()]
                    )
                else:
                    spans.append([])
            spans = [
                [{"begin": a, "end": b, "probability": p} for a, b, p in some] for some in spans
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([words.chain.score(x) for x in found], pa.float64()),
                    pa.array(spans, span),
                ],
                names=[*names, "score", "spans"],
            )

    typed = docs.select("*", F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    return docs.mapInArrow(predict, typed.schema)


def toxicity_report(
    docs: DataFrame, labels: DataFrame, learning: Learning = Learning()
) -> DataFrame:
    """doc_id, held_out, score, predicted and n_spans; learns from labels that aren't held out."""
    chain = learned(docs, labels.where(~held_out()), learning)
    told = with_toxicity(docs.select("doc_id", "text"), chain)
    return told.select(
        "doc_id", held_out().alias("held_out"), "score",
        (c("score") >= learning.threshold).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
