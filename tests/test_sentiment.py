from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from pitchside.functions import sentiment
from pitchside.functions.sentiment import PUNCTUATION, Rules, score_posts, score_text
from pitchside.sources.tables import read_lexicon

LEXICON = {
    "good": 2.0, "bad": -2.5, "great": 3.0, ":)": 1.5, "awful": -3.0, "no": -1.2, "kind": 2.4,
    "doubt": -1.5,
}


@pytest.fixture(scope="module")
def lexicon(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("lexicon") / "lexicon.txt"
    path.write_text("".join(f"{t}\t{v}\t0.5\t[1, 2]\n" for t, v in LEXICON.items()))
    return read_lexicon(spark, str(path))


def _score(spark, lexicon, texts, rules=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    rows = sorted(score_text(df, "id", "text", lexicon, rules=rules).collect())
    return [tuple(r)[1:] for r in rows]


def _words(text):
    out = []
    for token in text.split():
        bare = token.strip(PUNCTUATION)
        out.append(token if len(bare) <= 2 else bare)
    return out


def _upper(word):
    return word == word.upper() and word != word.lower()


def _walked(words, i, v, mixed, rules):
    """One word's valence after its neighbours, from the nearest outwards."""
    lower = [w.lower() for w in words]

    def near(k):
        return lower[i - k] if i >= k else None

    if lower[i] in (*rules.intensifiers, *rules.dampeners) or lower[i : i + 2] == ["kind", "of"]:
        return 0.0
    if near(1) == "no" or near(2) == "no" or (near(3) == "no" and near(1) in ("or", "nor")):
        v *= rules.negation
    elif lower[i] == "no" and i + 1 < len(words) and lower[i + 1] in LEXICON:
        v = 0.0
    if mixed and _upper(words[i]):
        v += rules.capitals if v > 0 else -rules.capitals
    for k, decay in zip((1, 2, 3), rules.degree_decay):
        if near(k) is None or near(k) in LEXICON:
            continue
        degree = {**dict.fromkeys(rules.intensifiers, 0.293), **dict.fromkeys(rules.dampeners, -0.293)}
        if near(k) in degree:
            amount = degree[near(k)] + (rules.capitals if mixed and _upper(words[i - k]) else 0.0)
            v += math.copysign(1, v) * amount * decay if v else 0.0
        between = [near(j) for j in range(1, k)]
        praised = k > 1 and near(k) == "never" and near(k - 1) in ("so", "this")
        if praised or (k == 3 and near(1) in ("so", "this")):
            v *= 1.25
        elif k > 1 and near(k) == "without" and "doubt" in between:
            pass
        elif near(k) in rules.negations or "n't" in near(k):
            v *= rules.negation
        if k == 3:
            pairs = [(near(3), near(2)), (near(2), near(1))]
            v -= 0.293 * sum(p in rules.pair_dampeners for p in pairs)
    if near(1) == "least" and "least" not in LEXICON and near(2) not in ("at", "very"):
        v *= rules.negation
    return v


def _by_hand(text, rules):
    """The same rules, word by word."""
    words = _words(text)
    if not words:
        return (None, None, None, None, "NEUTRAL")
    uppers = sum(map(_upper, words))
    mixed = 0 < uppers < len(words)
    lower = [w.lower() for w in words]
    turn = lower.index("but") if rules and "but" in lower else -1
    values = []
    for i, word in enumerate(words):
        v = LEXICON.get(word.lower(), 0.0)
        if rules and v:
            v = _walked(words, i, v, mixed, rules)
            if turn >= 0:
                v *= 0.5 if i < turn else 1.5 if i > turn else 1.0
        values.append(v)
    emphasis = 0.0
    if rules:
        asked = text.count("?")
        emphasis = min(text.count("!"), 4) * rules.exclamation
        emphasis += 0 if asked <= 1 else asked * rules.question if asked <= 3 else 0.96
    total = sum(values)
    total += math.copysign(emphasis, total) if total else 0.0
    up = sum(v + 1 for v in values if v > 0)
    down = sum(v - 1 for v in values if v < 0)
    if up + down > 0:
        up += emphasis
    elif up + down < 0:
        down -= emphasis
    flat = sum(v == 0 for v in values)
    mass = up + abs(down) + flat
    compound = total / math.sqrt(total * total + 15)
    label = "POSITIVE" if round(compound, 4) >= 0.05 else (
        "NEGATIVE" if round(compound, 4) <= -0.05 else "NEUTRAL")
    return (compound, up / mass, abs(down) / mass, flat / mass, label)


def _close(got, want):
    assert got[4] == want[4]
    for g, w, digits in zip(got[:4], want[:4], (4, 3, 3, 3)):
        assert (g is None) == (w is None)
        assert g is None or abs(g - w) <= 0.5000001 * 10**-digits


TEXTS = [
    "", "   \n", "good", "GOOD day", "not good", "very good!", "It is not very bad, but great!!!",
    "hardly good ??", "I can't say it was GREAT???? :)", "awful awful good", "!!!", "nothing here",
    "VERY bad", "good but bad", "but",
]


@pytest.mark.parametrize("rules", [None, Rules()])
def test_scores_against_word_by_word(spark, lexicon, rules):
    rng = random.Random(3)
    vocabulary = [*LEXICON, "very", "hardly", "not", "don't", "but", "day", "Team", "GOOD", "so!",
                  "never", "so", "this", "without", "least", "at", "kind of", "sort of", "nor", "VERY"]
    texts = TEXTS + [
        " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))) for _ in range(150)
    ]
    for text, got in zip(texts, _score(spark, lexicon, texts, rules)):
        _close(got, _by_hand(text, rules))


def test_labels_of_the_rules_worked_by_hand(spark, lexicon):
    """value / sqrt(value^2 + 15), with the values as the rules give them one after the other."""
    worked = {
        "never so good": (2.0 + 0.293) * 1.25,  # so: more; never so: praise
        "without doubt good": 2.0 * 1.0 - 1.5 * -0.74,  # doubt is negated, good is not
        "least good": 2.0 * -0.74,
        "at least good": 2.0,
        "it was kind of good": 2.0 - 0.293,
        "no good": 0.0 + 2.0 * -0.74,
        "not very bad": (-2.5 - 0.293 * 1.0) * -0.74,
        "very not bad": -2.5 * -0.74 + 0.293 * 0.95,  # the degree adds to what is turned already
    }
    for text, got in zip(worked, _score(spark, lexicon, list(worked), Rules())):
        total = worked[text]
        assert got[0] == pytest.approx(total / math.sqrt(total * total + 15), abs=1e-4), text
        assert got[4] == ("POSITIVE" if total > 0.2 else "NEGATIVE")


def test_empty_text_has_no_scores_and_is_neutral(spark, lexicon):
    got = _score(spark, lexicon, ["", None, " \t"])
    assert got == [(None, None, None, None, "NEUTRAL")] * 3


def test_thresholds_are_inclusive(spark):
    scores = [0.05, 0.0499, -0.05, -0.0499, None]
    df = spark.createDataFrame([(s,) for s in scores], "s DOUBLE")
    labels = [r[0] for r in df.select(sentiment.sentiment_label(F.col("s"))).collect()]
    assert labels == ["POSITIVE", "NEUTRAL", "NEGATIVE", "NEUTRAL", "NEUTRAL"]


def test_score_ranges(spark, lexicon):
    for compound, up, down, flat, _ in _score(spark, lexicon, TEXTS[2:], Rules()):
        assert -1 <= compound <= 1
        assert all(0 <= s <= 1 for s in (up, down, flat))
        assert abs(up + down + flat - 1) < 0.002


def test_posts_with_equal_text_are_scored_alike(spark, lexicon):
    posts = spark.createDataFrame(
        [("a", "good", None), ("b", "good", ""), ("c", None, None), ("d", "bad", "day")],
        "post_id STRING, post_title STRING, post_body STRING",
    )
    rows = {r.post_id: r for r in score_posts(posts, lexicon).collect()}
    assert rows["a"].sentiment_label == rows["b"].sentiment_label == "POSITIVE"
    assert rows["c"].sentiment_compound is None and rows["c"].sentiment_label == "NEUTRAL"
    assert rows["d"].sentiment_label == "NEGATIVE"
    assert len(rows) == 4


def test_words_meet_the_lexicon_without_a_shuffle(spark, lexicon):
    df = spark.createDataFrame([(1, "good")], "id INT, text STRING")
    plan = score_text(df, "id", "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert len(re.findall(r"\bExchange hashpartitioning", plan)) == 1
