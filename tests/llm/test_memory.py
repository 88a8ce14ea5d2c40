"""Python workers need memory by the piece, not many times their slice of texts."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pitchside.llm import decontaminate, shingles

MB = 1 << 20


def traced(run) -> float:
    """The most MB that a call held at a time."""
    tracemalloc.start()
    try:
        with np.errstate(over="ignore"):
            run()
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def words_of(seed: int, size: int) -> str:
    draw = random.Random(seed)
    text = " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(size // 6))
    return text[:size]


def index(items: list[str]) -> decontaminate.Index:
    data, upto = decontaminate.normal(pa.array(items))
    budget = decontaminate.Budget()
    found = [
        (i, window)
        for i in range(len(items))
        for window in decontaminate.windows(data[upto[i] : upto[i + 1]].tobytes(), budget)
    ]
    return decontaminate.Index(
        pa.table(
            {
                "item_id": pa.array([x[0] for x in found], pa.int64()),
                "window": pa.array([x[1] for x in found], pa.binary()),
            }
        ),
        budget,
    )


def test_words_of_long_texts_need_memory_by_the_piece():
    shingles._powers.cache_clear()
    texts = pa.array([words_of(1, 4 * MB)])
    assert traced(lambda: shingles.word_hashes(texts)) < 70


def test_a_long_word_needs_memory_by_the_piece():
    shingles._powers.cache_clear()
    texts = pa.array(["x" * (8 * MB)])
    assert traced(lambda: shingles.word_hashes(texts)) < 140


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 17])
def test_words_hash_alike_in_any_pieces(monkeypatch, piece):
    texts = ["", None, "Aa bB\tcc", " x", "y ", "é " + "w" * 200 + " aA", words_of(2, 500), "\x00 z"]
    monkeypatch.setattr(shingles, "PIECE", piece, raising=False)
    shingles._powers.cache_clear()
    with np.errstate(over="ignore"):
        found, upto = shingles.word_hashes(pa.array(texts))
        wanted, ends = [], [0]
        for text in texts:
            words = (text or "").encode().split()
            for word in words:
                total = sum((x + 1) * shingles.BASE**k for k, x in enumerate(word.lower()))
                wanted.append(total % (1 << 64))
            ends.append(ends[-1] + len(words))
        assert found.tolist() == shingles.mixed(np.array(wanted, np.uint64)).tolist()
    assert upto.tolist() == ends


def test_sought_texts_need_memory_by_the_piece():
    held = index([words_of(3, 400)])
    text = words_of(4, MB) + " " + words_of(3, 400) + " " + words_of(5, MB)

    def run():
        data, upto = decontaminate.normal(pa.array([text, "short"]))
        assert held.found(data, upto) == [{0}, set()]

    assert traced(run) < 40


def test_hits_of_a_common_passage_need_memory_by_the_text():
    passage = words_of(6, 96)
    held = index([passage + f" {i}" for i in range(40)])
    texts = [passage + " " + words_of(100 + i, 60) for i in range(400)]

    def run():
        data, upto = decontaminate.normal(pa.array(texts))
        assert held.found(data, upto) == [set(range(40))] * len(texts)

    assert traced(run) < 80


@pytest.mark.parametrize("piece, hits", [(5, 1), (64, 300), (1 << 17, 1 << 17)])
def test_benchmark_texts_are_found_in_any_pieces(monkeypatch, piece, hits):
    monkeypatch.setattr(decontaminate, "PIECE", piece, raising=False)
    monkeypatch.setattr(decontaminate, "HITS", hits, raising=False)
    items = [words_of(10 + i, 120) for i in range(3)]
    held = index(items)
    texts = [
        items[0], "", None, words_of(20, 300), items[1][:50] + "#" + items[1][50:],
        words_of(21, 70) + " " + items[2] + ", " + items[0] + " " + words_of(22, 70), items[2][:40], "a",
    ]
    with np.errstate(over="ignore"):
        data, upto = decontaminate.normal(pa.array(texts))
        found = held.found(data, upto)
    assert found == [{0}, set(), set(), set(), {1}, {0, 2}, set(), set()]
