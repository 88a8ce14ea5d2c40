"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of source, language and topic. Each round rakes the cells' token
weights to one marginal after the other: a factor per source, then per language, then per topic,
such that the weighted cells add up to that marginal's targets. A document is then sampled with the
probability that its cell's fitted tokens bear to the tokens there are.

A probability ends at 1, and the fit can know of that (``bounded``): a cell that a factor would take
beyond 1 gives all its tokens, and the factor of its marginal is raised until the other cells make up
for it. Unbounded, what a cell lacks is lost, and the mix falls short.

Only cells and factors are read in the rounds, never documents; every sum is reduced in the reading
tasks before the shuffle, so a source with a third of all documents is one row like the others.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchside.llm.common import SPACE, Scratch, stored, text_or_empty
from pitchside.llm.outliers import BLANKS, SYMBOLS

c = F.col

DIMENSIONS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """Targets and parameters."""

    #: Sources and languages are to weigh as their tokens to this power: below 1, small ones gain.
    source_power: float = 0.7
    lang_power: float = 0.7
    #: Weights of the topics, scaled to those that occur; a topic not named weighs nothing.
    topics: dict[str, float] = field(
        default_factory=lambda: {"prose": 0.8, "brief": 0.05, "figures": 0.1, "marked": 0.05}
    )
    #: Tokens of the mix, as a share of all tokens.
    share: float = 0.8
    rounds: int = 8
    #: Texts with fewer words are brief; with more digits or symbols per hundred characters, figures
    #: or marked.
    brief_words: int = 100
    percent: int = 2
    seed: str = "mix-1"


def with_features(docs: DataFrame, mix: Mix, text: str = "text") -> DataFrame:
    """Adds ``_tokens`` (words) and ``_topic``, a rule on the text's form, of each whole text.

    The tables have no topics of their own; any rule that gives a column will do.
    """
    whole = text_or_empty(text)
    trimmed = F.trim(whole, F.lit(BLANKS))
    words = F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE)))

    def percent(letters: str) -> Column:
        return 100 * (F.length(whole) - F.length(F.regexp_replace(whole, f"[{letters}]+", "")))

    many = mix.percent * F.length(whole)
    return docs.withColumn("_tokens", words.cast("long")).withColumn(
        "_topic",
        F.when(c("_tokens") == 0, "brief")
        .when(percent(SYMBOLS) > many, "marked")
        .when(percent("0-9") > many, "figures")
        .when(c("_tokens") < mix.brief_words, "brief")
        .otherwise("prose"),
    )


def _levels(rows: DataFrame, name: str) -> DataFrame:
    """Per value of ``name``, the factor ``level`` by which ``rest`` brings ``base`` to ``target``.

    At the level, ``base * least(1, level * rest)`` adds up to the target, or to all that there is.
    This sum is the least of straight lines, in each of which so many of the first rows by ``rest``
    give all they have; so the level is the greatest of those that the lines need.
    """
    order = Window.partitionBy(name).orderBy(c("rest").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    supply = F.sum("base").over(Window.partitionBy(name))
    given = F.coalesce(F.sum("base").over(before), F.lit(0.0))
    open_ = F.sum(c("base") * c("rest")).over(onward)
    lines = rows.where("base > 0 and rest > 0").select(
        name, ((F.least("target", supply) - given) / open_).alias("line")
    )
    return lines.groupBy(name).agg(F.greatest(F.max("line"), F.lit(0.0)).alias("level"))


def _targets(cells: DataFrame, total: float, mix: Mix, bounded: bool) -> dict[str, DataFrame]:
    """Per dimension, the tokens that each value is to have: ``wanted`` by weight, and ``target``.

    Bounded, no value is to have more than its ``base``: one that weighs more is to have all of it,
    and what it lacks goes to the others by their weights, until none has too few.
    """
    out = {}
    for name in DIMENSIONS:
        sums = cells.groupBy(name).agg(F.sum("base").cast("double").alias("base"))
        if name == "topic":
            weight = F.lit(0.0)
            for topic, share in mix.topics.items():
                weight = F.when(c(name) == topic, F.lit(float(share))).otherwise(weight)
            weight = F.when(c("base") > 0, weight).otherwise(F.lit(0.0))
        else:
            weight = F.pow("base", F.lit(getattr(mix, f"{name}_power")))
        weighed = sums.select(name, "base", weight.alias("weight"))
        whole = weighed.agg(F.sum("weight")).first()[0] or 1.0
        wanted = c("weight") / F.lit(whole) * mix.share * total
        if bounded:
            rows = weighed.select(
                F.lit(0).alias("all"), "base", (c("weight") / c("base")).alias("rest"),
                F.lit(mix.share * total).alias("target"),
            )
            level = (_levels(rows, "all").first() or {"level": 0.0})["level"]
            target = F.least("base", c("weight") * level)
        else:
            target = wanted
        out[name] = weighed.select(name, "base", wanted.alias("wanted"), target.alias("target"))
    return out


def _fitted(cells: DataFrame, scratch: Scratch, mix: Mix, bounded: bool) -> DataFrame:
    """``cells`` with ``probability``."""
    total = cells.agg(F.sum("base")).first()[0] or 0
    targets = {
        name: scratch.store(df.select(name, "target"), f"targets-{name}")
        for name, df in _targets(cells, float(total), mix, bounded).items()
    }
    factors = {
        name: targets[name].select(name, F.lit(1.0).alias(f"{name}_factor")) for name in DIMENSIONS
    }
    for _ in range(mix.rounds):
        for name in DIMENSIONS:
            weighed, rest = cells, F.lit(1.0)
            for other in DIMENSIONS:
                if other != name:
                    weighed = weighed.join(factors[other], other)
                    rest = rest * c(f"{other}_factor")
            if bounded:
                rows = weighed.join(targets[name], name).select(
                    name, c("base").cast("double").alias("base"), rest.alias("rest"), "target"
                )
                found = targets[name].join(_levels(rows, name), name, "left")
                factor = F.coalesce("level", F.lit(0.0))
            else:
                weight = c("base").cast("double") * rest
                sums = weighed.groupBy(name).agg(F.sum(weight).alias("sum"))
                found = targets[name].join(sums, name)
                factor = F.when(c("sum") > 0, c("target") / c("sum")).otherwise(F.lit(0.0))
            factors[name] = scratch.store(
                found.select(name, factor.alias(f"{name}_factor")), f"factors-{name}"
            )
    out = cells
    for name in DIMENSIONS:
        out = out.join(factors[name], name)
    product = c("source_factor") * c("lang_factor") * c("topic_factor")
    # Cells without a token have no weight to fit: their documents stay at the mix's share.
    probability = F.when(c("base") > 0, F.least(F.lit(1.0), product)).otherwise(F.lit(mix.share))
    return out.select(*DIMENSIONS, "base", F.round(probability, 9).alias("probability"))


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(
        c("_source").alias("source"), c("_lang").alias("lang"), c("_topic").alias("topic")
    ).agg(F.sum("_tokens").alias("base"))


def _featured(docs: DataFrame, carry: list[str], text: str, mix: Mix) -> DataFrame:
    # Apart from the rest, columns of any name can be carried.
    own = docs.select(
        F.struct(*carry).alias("_carried"),
        c("doc_id").cast("string").alias("_key"),
        F.coalesce("source", F.lit("")).alias("_source"),
        F.coalesce("lang", F.lit("")).alias("_lang"),
        c(text).alias("_raw"),
    )
    return with_features(own, mix, "_raw").drop("_raw")


def marginals(
    docs: DataFrame, *, text: str = "text", mix: Mix = Mix(), bounded: bool = True
) -> DataFrame:
    """Per ``dimension`` and ``value``, tokens: ``base`` there are, ``wanted`` by weight, the
    ``target`` of the fit, and ``reached``, those expected to be kept."""
    scratch = Scratch(docs.sparkSession)
    cells = stored(_cells(_featured(docs, ["doc_id"], text, mix)), "cells")
    fitted = stored(_fitted(cells, scratch, mix, bounded), "fitted")
    scratch.clear()
    total = float(cells.agg(F.sum("base")).first()[0] or 0)
    out = None
    for name, targets in _targets(cells, total, mix, bounded).items():
        reached = fitted.groupBy(name).agg(F.sum(c("base") * c("probability")).alias("reached"))
        told = targets.join(reached, name).select(
            F.lit(name).alias("dimension"), c(name).alias("value"), "base", "wanted", "target",
            "reached",
        )
        out = told if out is None else out.unionByName(told)
    return out


def uniform(key: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def with_sample(
    docs: DataFrame, *, carry: list[str], text: str = "text", mix: Mix = Mix(), bounded: bool = True
) -> DataFrame:
    """The columns in ``carry``, ``n_tokens``, ``topic``, ``probability`` and ``kept``.

    ``docs`` has ``doc_id``, ``lang``, ``source`` and the text column. A null language or source
    counts as an empty one, a null text as an empty one, without tokens and brief. The draw depends
    on ``doc_id`` and the seed alone, so repeated rows stay or go together and a repeated run draws
    the same; all rows without a ``doc_id`` share one draw. Where the targets ask for more tokens than
    a cell has, all its documents stay; if ``bounded``, other cells make up for it, else the mix falls
    short there. An empty table gives an empty one. A carried column with one of these names is
    replaced.
    """
    scratch = Scratch(docs.sparkSession)
    rows = stored(_featured(docs, carry, text, mix), "features")
    fitted = _fitted(scratch.store(_cells(rows), "cells"), scratch, mix, bounded).drop("base")
    fitted = stored(fitted.toDF("_source", "_lang", "_topic", "probability"), "probabilities")
    scratch.clear()
    drawn = uniform(F.coalesce("_key", F.lit("")), mix.seed)
    told = {
        "n_tokens": c("_tokens"),
        "topic": c("_topic"),
        "probability": c("probability"),
        "kept": drawn < c("probability"),
    }
    return rows.join(fitted, ["_source", "_lang", "_topic"]).select(
        *[c("_carried")[name].alias(name) for name in carry if name not in told],
        *[value.alias(name) for name, value in told.items()],
    )
