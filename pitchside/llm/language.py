"""Language identification by cross-parsing entropy.

For each language, a suffix automaton holds every substring of a sample of its labelled text. A text is
parsed into phrases, each the longest match from where the last one ended; a language that the text
is written in needs few. Phrases cost the same in every language, the logarithm of the longest sample's
length, so a short sample gains nothing by its shortness: what it lacks takes phrases of one symbol. The
cost per symbol estimates the cross entropy; the language with the least wins.

A worker parses many texts at once: each step moves a segment of every text, in every language, by
one symbol through the automata's tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pitchside.llm.common import bound_batches, held_out, slices

c = F.col

#: Letters told apart; a rarer one, or one that no sample has, is the last class.
LETTERS = 62
GAP, OTHER, PAD = 0, LETTERS + 1, LETTERS + 2
CLASSES = 1 << 6 if PAD < 1 << 6 else 1 << 7
#: Symbols of a segment. Texts are parsed segment by segment; a phrase ends where a segment does.
SEGMENT = 1_024
#: Segments that move together, and bytes of text that a worker takes at once.
LANES = 2_048
SLICE = 2 << 20


@dataclass(frozen=True)
class Sample:
    """What the automata are made of: a bounded sample of labelled rows."""

    #: Rows of a language, chosen by a hash of their ids.
    rows: int = 100
    #: Code points of a row that are learned from: a window anywhere in its text, by a hash of its id.
    window: int = 250
    #: Code points of all languages, which bounds the tables; with many languages each has fewer rows,
    #: and with more than ``total / window`` of them shorter windows.
    total: int = 400_000

    def shared(self, languages: int) -> tuple[int, int]:
        """Rows of a language, and their windows, where there are so many languages."""
        each = self.total // max(1, languages)
        window = max(1, min(self.window, each))
        return max(1, min(self.rows, each // window)), window


# --- symbols ----------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Alphabet:
    """Classes of code points: the most frequent letters, other letters, and everything else."""

    def __init__(self, samples: list[str]):
        counts = np.bincount(_points("".join(samples).lower()), minlength=0x110000)[:0x110000]
        counts = np.where(_is_letter(), counts, 0)
        frequent = np.lexsort((np.arange(len(counts)), -counts))[:LETTERS]
        frequent = frequent[counts[frequent] > 0]
        self.classes = np.where(_is_letter(), OTHER, GAP).astype(np.uint8)
        self.classes[frequent] = np.arange(1, len(frequent) + 1)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' classes one after the other, and where each begins and ends.

        Lower case; what is no letter is a gap, and a gap follows none. A text begins without one.
        """
        lower = [text.lower() for text in texts]
        upto = np.concatenate([[0], np.cumsum([len(text) for text in lower])]).astype(np.int64)
        found = self.classes[_points("".join(lower))]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != GAP) | (found[:-1] != GAP)
        firsts = upto[:-1][upto[:-1] < len(found)]
        keep[firsts] = found[firsts] != GAP
        return found[keep], np.concatenate([[0], np.cumsum(keep)])[upto]


# --- automata ---------------------------------------------------------------------------------


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of the automaton of all substrings; state 0 is the empty one."""
    moves: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for symbol in symbols:
        new = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = links[state]
        if state >= 0:
            target = moves[state][symbol]
            if lengths[target] == lengths[state] + 1:
                links[new] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[state] + 1)
                links.append(links[target])
                while state >= 0 and moves[state].get(symbol) == target:
                    moves[state][symbol] = copy
                    state = links[state]
                links[target] = links[new] = copy
        last = new
    return moves


def _table(symbols: np.ndarray) -> np.ndarray:
    """For each state and class: the next state's row, times four, plus the phrases that end.

    A symbol that doesn't continue a match ends its phrase and begins the next; one that the sample
    doesn't have at all is a phrase of its own.
    """
    moves = suffix_automaton(symbols.tolist())
    table = np.full((len(moves), CLASSES), -1, np.int32)
    for state, found in enumerate(moves):
        for symbol, target in found.items():
            table[state, symbol] = target * CLASSES * 4
    start = table[0].copy()
    fresh = np.where(start >= 0, start + 1, 2).astype(np.int32)
    np.copyto(table, fresh[None, :], where=table < 0)
    table[0] = np.where(start >= 0, start, 1)
    table[:, PAD] = np.arange(len(moves)) * CLASSES * 4
    return table


class Languages:
    """The automata of all languages in one table, and the parsing of texts by them."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.names = [name for name, _ in samples]
        self.alphabet = Alphabet([text for _, texts in samples for text in texts])
        tables, bases, lengths, base = [], [], [], 0
        for _, texts in samples:
            symbols, upto = self.alphabet.symbols(list(texts))
            parts = [symbols[a:b] for a, b in zip(upto[:-1], upto[1:])]
            joined = np.concatenate([x for part in parts for x in (part, [GAP])])
            table = _table(joined)
            # The states of all languages are numbered through.
            wide = np.int32 if base + table.size < 1 << 28 else np.int64
            tables.append((table.astype(wide, copy=False) + wide(base * 4)).ravel())
            bases.append(base)
            lengths.append(len(joined))
            base += table.size
        self.table = np.concatenate([*tables, np.zeros(0, np.int32)])
        self.bases = np.array(bases, np.int64)
        self.bits = float(np.log2(max([2, *lengths])))

    def phrases(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language."""
        out = np.zeros((len(self.names), len(upto) - 1), np.int64)
        sizes = np.diff(upto)
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = upto[:-1][owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, upto[1:][owner] - begin)
        order = np.argsort(-size, kind="stable")
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            steps = np.arange(int(size[lanes[0]]))[:, None]
            place = np.minimum(begin[lanes][None, :] + steps, len(symbols) - 1)
            codes = np.where(steps < size[lanes][None, :], symbols[place], np.uint8(PAD))
            del place
            state = np.repeat(self.bases[:, None], len(lanes), axis=1)
            count = np.zeros(state.shape, np.int64)
            for code in codes:
                told = self.table.take(state + code)
                count += told & 3
                state = (told >> 2).astype(np.int64)
            count += state != self.bases[:, None]
            for language in range(len(self.names)):
                out[language] += np.bincount(owner[lanes], count[language], len(sizes)).astype(int)
        return out

    def told(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` and 0 without a letter."""
        symbols, upto = self.alphabet.symbols([text or "" for text in texts])
        if not self.names or not len(symbols):
            return [("und", 0.0)] * len(texts)
        sizes = np.maximum(1, np.diff(upto))
        entropy = self.phrases(symbols, upto) * self.bits / sizes
        best = entropy.argmin(axis=0)
        least = np.sort(entropy, axis=0)
        # How far the next language lies behind: 0 for none, 1 for infinitely far.
        score = 1 - least[0] / least[1] if len(self.names) > 1 else np.ones(len(texts))
        letters = np.concatenate([[0], np.cumsum(symbols != GAP)])
        some = letters[upto[1:]] > letters[upto[:-1]]
        return [
            (self.names[i], float(x)) if ok else ("und", 0.0)
            for i, x, ok in zip(best.tolist(), score.tolist(), some.tolist())
        ]


_held: dict[tuple, Languages] = {}


def languages(samples: tuple) -> Languages:
    """The automata of these samples, made once by a worker; others are let go before."""
    if samples not in _held:
        _held.clear()
        _held[samples] = Languages(samples)
    return _held[samples]


# --- operator ---------------------------------------------------------------------------------


def learned_sample(
    labelled: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    sample: Sample = Sample(),
) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """The sample's texts by language, on the driver: its size is bounded for all languages together.

    Rows without a language, and those whose window holds no letter, teach nothing. Rows of one id are
    ordered by their text.
    """
    known = labelled.select(c(key).alias("key"), c(lang).alias("lang"), c(text).alias("text"))
    known = known.where("lang is not null and text is not null")
    rows, window = sample.shared(known.select("lang").distinct().count())
    room = F.greatest(F.length("text") - window, F.lit(0)) + 1
    begin = F.pmod(F.xxhash64("key", F.lit("window")), room.cast("long")).cast("int") + 1
    chosen = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key", "text")
    found = (
        known.withColumn("text", F.substr("text", begin, F.lit(window)))
        .where(F.regexp_like("text", F.lit(r"\p{L}")))
        .withColumn("nth", F.row_number().over(chosen))
        .where(c("nth") <= rows)
        .orderBy("lang", "nth")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in found:
        texts.setdefault(row["lang"], []).append(row["text"])
    return tuple((name, tuple(found)) for name, found in sorted(texts.items()))


def with_language(
    docs: DataFrame, samples: tuple, *, text: str = "text"
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1: how far the next language lies behind).

    Only the text is read. A null text, or one without a letter, is ``und`` with score 0, as are all
    where nothing could be learned; equal entropies go to the first name. Rows stand alone. Columns
    of those names are replaced, others pass through.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    names = [name for name in docs.columns if name != text]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = languages(samples)
        for batch in slices(batches, SLICE, text):
            told = model.told(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([x[0] for x in told], pa.string()),
                    pa.array([x[1] for x in told], pa.float64()),
                ],
                names=[*batch.schema.names, "lang_pred", "score"],
            ).select([*names, text, "lang_pred", "score"])

    typed = docs.select(*names, text, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))
    return docs.mapInArrow(predict, typed.schema)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; learns from the rows that aren't held out."""
    samples = learned_sample(docs.where(~held_out()))
    told = with_language(docs.select("doc_id", "text"), samples)
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
