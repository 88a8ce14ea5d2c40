"""The quality classifier against plain versions of its parts, and on held-out labels."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest

from pitchside.llm import classifier, queries
from pitchside.llm.classifier import BITS, SIZE, Learning

SF = "/root/testdata/sf0.01"


def plain_buckets(text: str) -> set[int]:
    words = text.split()
    word = [zlib.crc32(x.lower().encode()) for x in words]
    form = [zlib.crc32(classifier.shape(x).encode()) for x in words]
    beside, more, spread = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x9E3779B97F4A7C15
    grams = [(1, x) for x in word] + [(3, x) for x in form]
    for i in range(1, len(words)):
        grams.append((2, word[i - 1] * beside + word[i]))
        grams.append((4, form[i - 1] * beside + form[i]))
        if (word[i], form[i]) == (word[i - 1], form[i - 1]):
            grams.append((6, form[i]))
        if i > 1:
            grams.append((5, (form[i - 2] * beside + form[i - 1]) * more + form[i]))
    return {((h + kind) * spread & (1 << 64) - 1) >> 64 - BITS for kind, h in grams}


def test_shapes():
    found = [classifier.shape(x) for x in ["word", "Word", "WORDS!!", "a1-22b", "|", "ß§§x", "漢字"]]
    assert found == ["a", "Aa", "A!", "a0-0a", "|", "a§a", "a"]


@pytest.mark.parametrize("step", [3, 1 << 16])
def test_indicators(step, monkeypatch):
    monkeypatch.setattr(classifier, "STEP", step)
    known = classifier.Known()
    for text in ["", " \n", "one", "A a a A  b\tB!! b b b", "x " * 50, "the THE tHe 12 12 | | end."]:
        found = classifier.indicators(text, known).tolist()
        assert found == sorted(plain_buckets(text)), repr(text)
    classifier.indicators("y" * 100, known)
    assert "y" * 100 not in known


def test_log_count_ratios():
    low, high = np.array([3.0, 0, 0, 1]), np.array([1.0, 2, 0, 1])
    found = classifier.log_count_ratios(low, high, 1.0)
    assert found.tolist() == pytest.approx(
        [np.log(2 / 8 / (4 / 8)), np.log(3 / 8 / (1 / 8)), 0.0, 0.0]
    )


@pytest.mark.parametrize("tasks", [1, 3])
def test_descent_reaches_the_optimum(tasks):
    """Primal and dual objective meet, however many tasks share the rows."""
    draw = np.random.default_rng(4)
    rows = [np.unique(draw.integers(0, 30, 8)).astype(np.int32) for _ in range(60)]
    signs = np.where([3 in x or 5 in x for x in rows], 1.0, -1.0)
    signs[:4] *= -1
    ratios, learning = draw.standard_normal(SIZE), Learning(passes=3)
    weights, bias, alphas = np.zeros(SIZE), 0.0, np.zeros(60)
    for turn in range(200):
        changes = []
        for t in range(tasks):
            own = np.arange(t, 60, tasks)
            told = classifier.descend(
                [rows[i] for i in own], signs[own], alphas[own], weights, bias, ratios, learning,
                tasks, turn,
            )
            changes.append((own, told))
        for own, (after, change, moved, _) in changes:
            alphas[own] = after
            weights, bias = weights + change, bias + moved
    unit = [ratios[x] / np.linalg.norm(ratios[x]) for x in rows]
    rebuilt = np.zeros(SIZE)
    for at, v, sign, a in zip(rows, unit, signs, alphas):
        rebuilt[at] += a * sign * v
    assert weights == pytest.approx(rebuilt) and bias == pytest.approx(float(alphas @ signs))
    loss = sum(max(0, 1 - s * (weights[x] @ v + bias)) for x, v, s in zip(rows, unit, signs))
    size = (weights @ weights + bias**2) / 2
    assert size + loss == pytest.approx(alphas.sum() - size, rel=1e-2)
    assert ((0 <= alphas) & (alphas <= 1)).all()


def test_probabilities_keep_the_shares():
    margins, labels = np.array([-2.0, -1, -0.5, 0.4, 0.2, 1, 2, 3]), np.array([0, 0, 1, 0, 1, 1, 1, 1])
    slope, offset = classifier.fit_probabilities(margins, labels, (0.2, 0.8))
    assert slope > 0
    p = 1 / (1 + np.exp(-(slope * margins + offset)))
    each = np.where(labels == 1, 0.8 / 5, 0.2 / 3)
    targets = np.where(labels == 1, 6 / 7, 1 / 5)
    assert (each * p).sum() == pytest.approx((each * targets).sum(), abs=1e-4)


def test_held_out_labels(spark):
    found = queries.op11_quality_classifier(spark, SF).toPandas()
    labels = duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").df()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.7)).all()
    assert len(held) > 60 and (held.predicted == held.quality).mean() > 0.95


def test_small_and_odd_labels(spark):
    docs = spark.createDataFrame(
        [(1, "fine words here"), (2, "BAD!! BAD!!"), (2, "other text of id 2"), (3, None), (4, "")],
        "doc_id long, text string",
    )

    def scores(labels):
        labels = spark.createDataFrame(labels, "doc_id long, quality int")
        model = classifier.learned(docs, labels)
        return [r["score"] for r in classifier.with_scores(docs, model).collect()]

    assert scores([]) == [0.5] * 5
    assert scores([(1, 1), (9, 0)]) == [pytest.approx(1)] * 5
    assert scores([(2, 0), (2, 1), (None, 1), (3, None)]) == [pytest.approx(0)] * 5
    found = scores([(1, 1), (2, 0)])
    assert found[0] > found[1] and found[3] == found[4]
