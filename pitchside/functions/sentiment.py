"""Lexicon sentiment as a join of words with a lexicon table.

The lexicon is an input table ``(token, valence)``. Each text is split into words once, every word
carries its neighbours, and the rules of Hutto and Gilbert (ICWSM 2014) work on that row alone. They
are a fold that walks outwards from the word: each neighbour that is no lexicon word itself first adds
its degree, then its negation turns what has come together so far. So the only shuffle is the final sum
per text, which is reduced in each task first.

Words outside the lexicon have no valence, whatever stands around them. With rules they are only counted,
and leave after the first lookup; a text without lexicon words still has its row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from pitchside.functions.columns import joined_text, stripped

SPACE = r"[\s\x0B\p{Z}]+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

SCORE_COLUMNS = [
    "sentiment_compound",
    "sentiment_positive",
    "sentiment_negative",
    "sentiment_neutral",
    "sentiment_label",
]

# Published degree modifiers and negations.
INTENSIFIERS = (
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
    "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously", "fully",
    "greatly", "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly",
    "totally", "tremendously", "unbelievably", "unusually", "utterly", "very",
)
DAMPENERS = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally",
    "partly", "scarcely", "slightly", "somewhat", "sorta",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt", "hasnt",
    "havent", "isnt", "mustnt", "neither", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "rarely", "seldom", "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt",
)


@dataclass(frozen=True)
class Rules:
    """Constants of the published heuristics."""

    degree: float = 0.293
    degree_decay: Sequence[float] = (1.0, 0.95, 0.9)
    capitals: float = 0.733
    negation: float = -0.74
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    exclamation: float = 0.292
    max_exclamations: int = 4
    question: float = 0.18
    max_question: float = 0.96
    intensifiers: Sequence[str] = INTENSIFIERS
    dampeners: Sequence[str] = DAMPENERS
    negations: Sequence[str] = NEGATIONS
    contrast: str = "but"
    #: Pairs that dampen, whatever the sign; the first word of the first pair says nothing in it.
    pair_dampeners: Sequence[tuple[str, str]] = (("kind", "of"), ("sort", "of"), ("just", "enough"))
    #: A negation that one of these words turns to praise ("never so"), and by how much.
    never: str = "never"
    never_with: Sequence[str] = ("so", "this")
    never_factor: float = 1.25
    #: A negation that this word undoes ("without doubt").
    without: str = "without"
    without_with: str = "doubt"
    #: Negates the word behind it, but for one of these before it ("at least").
    least: str = "least"
    least_without: Sequence[str] = ("at", "very")
    #: Negates what it stands before; a lexicon word behind it takes away its own valence. Over one word
    #: between, it reaches only with one of these.
    no: str = "no"
    no_with: Sequence[str] = ("or", "nor")


def sentiment_label(compound: Column, pos: float = 0.05, neg: float = -0.05) -> Column:
    """Label by thresholds, both inclusive; a missing score is neutral."""
    return (
        F.when(compound >= pos, "POSITIVE").when(compound <= neg, "NEGATIVE").otherwise("NEUTRAL")
    )


def _bare(token: Column) -> Column:
    """Token without outer punctuation, or as it is when at most two characters would remain."""
    inner = F.btrim(token, F.lit(PUNCTUATION))
    return F.when(F.length(inner) <= 2, token).otherwise(inner)


def _is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def _one_of(word: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(word).isin(list(words)), F.lit(False))


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _emphasis(text: Column, rules: Rules) -> Column:
    """Weight of exclamation and question marks."""
    marks = F.least(_occurrences(text, "!"), F.lit(rules.max_exclamations)) * rules.exclamation
    asked = _occurrences(text, "?")
    asks = (
        F.when(asked <= 1, 0.0)
        .when(asked <= 3, asked * rules.question)
        .otherwise(rules.max_question)
    )
    return marks + asks


#: Neighbours before a word that the rules look at.
REACH = (1, 2, 3)


def _loud(word: Column) -> Column:
    return F.col("mixed_case") & F.coalesce(_is_upper(word), F.lit(False))


def _negates(word: Column, rules: Rules) -> Column:
    shortened = F.coalesce(F.lower(word).contains("n't"), F.lit(False))
    return _one_of(word, rules.negations) | shortened


def _steps(rules: Rules) -> list[Column]:
    """What each neighbour does to a word's valence: ``(value + sign * amount) * factor + plus``.

    A neighbour that is missing, or a lexicon word itself, does nothing.
    """
    near = {k: F.col(f"w.before{k}") for k in REACH}
    out = []
    for k, decay in zip(REACH, rules.degree_decay):
        word = near[k]
        degree = F.when(_one_of(word, rules.intensifiers), rules.degree).when(
            _one_of(word, rules.dampeners), -rules.degree
        )
        louder = F.when(_loud(word), rules.capitals).otherwise(0.0)
        amount = F.coalesce((degree + louder) * decay, F.lit(0.0))
        negated = F.when(_negates(word, rules), rules.negation).otherwise(1.0)
        never, without = _one_of(word, [rules.never]), _one_of(word, [rules.without])
        if k == 1:
            factor = negated
        else:
            praise = never & _one_of(near[k - 1], rules.never_with)
            if k == 3:
                praise = praise | _one_of(near[1], rules.never_with)
            doubt = reduce(or_, [_one_of(near[j], [rules.without_with]) for j in range(1, k)])
            factor = (
                F.when(praise, rules.never_factor).when(without & doubt, 1.0).otherwise(negated)
            )
        plus = F.lit(0.0)
        if k == 3:
            for far, close in ((near[3], near[2]), (near[2], near[1])):
                pairs = [_one_of(far, [x]) & _one_of(close, [y]) for x, y in rules.pair_dampeners]
                plus = plus + F.when(reduce(or_, pairs), -rules.degree).otherwise(0.0)
        counts = word.isNotNull() & ~F.col(f"known{k}")
        out.append(
            F.struct(
                F.when(counts, amount).otherwise(0.0).alias("amount"),
                F.when(counts, factor).otherwise(1.0).alias("factor"),
                F.when(counts, plus).otherwise(0.0).alias("plus"),
            )
        )
    return out


def _in_context(rules: Rules) -> Column:
    """Valence of one word after the rules that look at its neighbours."""
    word, after = F.col("w.word"), F.col("w.after")
    before = {k: F.col(f"w.before{k}") for k in REACH}
    no = {k: _one_of(before[k], [rules.no]) for k in REACH}
    denied = no[1] | no[2] | (no[3] & _one_of(before[1], rules.no_with))
    valence = (
        F.when(denied, F.col("valence") * rules.negation)
        .when(_one_of(word, [rules.no]) & F.col("known_after"), 0.0)
        .otherwise(F.col("valence"))
    )
    louder = F.when(valence > 0, rules.capitals).otherwise(-rules.capitals)
    start = valence + F.when(_loud(word), louder).otherwise(0.0)
    value = F.aggregate(
        F.array(*_steps(rules)),
        start,
        lambda so_far, step: (so_far + F.signum(so_far) * step["amount"]) * step["factor"] + step["plus"],
    )
    spared = before[2].isNotNull() & _one_of(before[2], rules.least_without)
    least = _one_of(before[1], [rules.least]) & ~F.col("known1") & ~spared
    value = value * F.when(least, rules.negation).otherwise(1.0)
    contrast = (
        F.when(F.col("contrast_at") < 0, 1.0)
        .when(F.col("w.at") < F.col("contrast_at"), rules.before_contrast)
        .when(F.col("w.at") > F.col("contrast_at"), rules.after_contrast)
        .otherwise(1.0)
    )
    first, second = rules.pair_dampeners[0] if rules.pair_dampeners else ("", "")
    says_nothing = _one_of(word, [*rules.intensifiers, *rules.dampeners]) | (
        _one_of(word, [first]) & _one_of(after, [second])
    )
    return F.when(says_nothing, 0.0).otherwise(value * contrast)


def _with_neighbours(words: Column):
    def slot(word: Column, at: Column) -> Column:
        before = [F.get(words, at - k).alias(f"before{k}") for k in REACH]
        return F.struct(
            word.alias("word"), at.alias("at"), F.get(words, at + 1).alias("after"), *before
        )

    return slot


def _with_known_neighbours(valued: DataFrame, lookup: DataFrame, rules: Rules) -> DataFrame:
    """Adds whether the neighbours are lexicon words; only those of lexicon words are looked up."""
    is_no = _one_of(F.col("w.word"), [rules.no])
    wanted = {f"known{k}": F.lower(f"w.before{k}") for k in REACH}
    wanted["known_after"] = F.when(is_no, F.lower("w.after"))
    for name, word in wanted.items():
        side = lookup.select(F.col("_token").alias("_near"))
        asked = F.when(F.col("valence").isNotNull(), word)
        valued = valued.join(side, asked == F.col("_near"), "left")
        valued = valued.withColumn(name, F.col("_near").isNotNull()).drop("_near")
    return valued


def score_text(
    df: DataFrame,
    id_col: str,
    text_col: str | Column,
    lexicon: DataFrame,
    pos: float = 0.05,
    neg: float = -0.05,
    alpha: float = 15.0,
    rules: Rules | None = None,
) -> DataFrame:
    """Scores and label per text; ``id_col`` is unique in ``df``.

    Without ``rules`` the compound score is the normalised sum of the word valences. Empty text has
    no scores and is neutral.
    """
    texts = df.select(F.col(id_col).alias("_id"), stripped(text_col).alias("_text"))
    tokens = F.split("_text", SPACE)  # one empty token for an empty text
    if rules:
        words = F.col("words")
        upper = F.size(F.filter(words, _is_upper))
        contrast = F.array_position(F.transform(words, F.lower), rules.contrast)
        worded = (
            texts.select(
                "_id",
                _emphasis(F.col("_text"), rules).alias("emphasis"),
                F.transform(tokens, _bare).alias("words"),
            )
            # Facts about the whole text, found once per text and not once per word.
            .withColumn("mixed_case", (upper > 0) & (upper < F.size(words)))
            .withColumn("contrast_at", contrast.cast("int") - 1)
            .withColumn("text_words", F.size(F.filter(words, lambda word: word != "")))
            .select(
                "_id",
                "emphasis",
                "text_words",
                "mixed_case",
                "contrast_at",
                F.explode(F.transform(words, _with_neighbours(words))).alias("w"),
            )
        )
    else:
        worded = texts.select("_id", F.explode(tokens).alias("token")).select(
            "_id", F.lit(0.0).alias("emphasis"), F.struct(_bare(F.col("token")).alias("word")).alias("w")
        )

    lookup = lexicon.select(F.col("token").alias("_token"), F.col("valence").cast("double"))
    valued = worded.join(lookup, F.lower("w.word") == F.col("_token"), "left")
    if rules:
        # The first word of a text stays for the text, and counts all its words.
        first = F.col("w.at") == 0
        valued = valued.where(F.col("valence").isNotNull() | first)
        valued = _with_known_neighbours(valued, lookup, rules)
        counts = F.when(first, F.col("text_words")).otherwise(0)
    else:
        counts = F.when(F.col("w.word") != "", 1).otherwise(0)
    valued = valued.select(
        "_id",
        "emphasis",
        (F.col("w.word") != "").alias("is_word"),
        counts.alias("words"),
        F.coalesce(_in_context(rules) if rules else F.col("valence"), F.lit(0.0)).alias("v"),
    )
    v = F.col("v")
    sums = valued.groupBy("_id").agg(
        F.sum("words").alias("n_words"),
        F.max("emphasis").alias("emphasis"),
        F.sum(v).alias("total"),
        F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("up"),
        F.sum(F.when(v < 0, v - 1).otherwise(0.0)).alias("down"),
        F.count_if(F.col("is_word") & (v != 0)).alias("moved"),
    )

    total, up, down, emphasis = (F.col(c) for c in ("total", "up", "down", "emphasis"))
    amplified = total + F.signum(total) * emphasis
    balance = F.signum(up + down)
    weights = sums.select(
        "_id",
        "n_words",
        F.round(amplified / F.sqrt(amplified * amplified + F.lit(alpha)), 4).alias("compound"),
        (up + F.when(balance > 0, emphasis).otherwise(0.0)).alias("up"),
        F.abs(down - F.when(balance < 0, emphasis).otherwise(0.0)).alias("down"),
        (F.col("n_words") - F.col("moved")).cast("double").alias("flat"),
    )
    some = F.col("n_words") > 0
    mass = F.col("up") + F.col("down") + F.col("flat")
    compound = F.when(some, F.col("compound"))
    return weights.select(
        F.col("_id").alias(id_col),
        compound.alias("sentiment_compound"),
        F.when(some, F.round(F.col("up") / mass, 3)).alias("sentiment_positive"),
        F.when(some, F.round(F.col("down") / mass, 3)).alias("sentiment_negative"),
        F.when(some, F.round(F.col("flat") / mass, 3)).alias("sentiment_neutral"),
        sentiment_label(compound, pos, neg).alias("sentiment_label"),
    )


def score_posts(
    posts: DataFrame, lexicon: DataFrame, rules: Rules | None = None, **thresholds: float
) -> DataFrame:
    """Posts with their scores. Equal texts are scored once, so copies of one post cost nothing."""
    keyed = posts.withColumn("_text", joined_text("post_title", "post_body")).withColumn(
        "_key", F.sha2("_text", 256)
    )
    texts = keyed.select("_key", "_text").dropDuplicates(["_key"])
    scores = score_text(texts, "_key", "_text", lexicon, rules=rules, **thresholds)
    return keyed.join(scores, "_key").select(*posts.columns, *SCORE_COLUMNS)
