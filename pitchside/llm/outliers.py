"""Quality rules by robust multivariate outliers.

A document's statistics make a vector. For each pool of documents of one language and source, the
minimum covariance determinant gives a centre and a covariance that outliers can't pull: of several
starting subsets that hold a fixed share of the pool, each is replaced by the rows nearest to its
own centre until it settles, and the one with the smallest determinant is taken. Documents whose
Mahalanobis distance from it is too large are rejected. All of it is DataFrame work: sums per
pool that every task reduces before the shuffle, and counts per class of distance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchside.llm.common import SPACE, WORD, Scratch, stored, text_or_empty

c = F.col

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: White space of the word rule.
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "A-Z"

#: The statistics, each brought to a scale on which sound documents spread about alike: the log of
#: a mean, and roots of shares.
VECTOR = {
    "v1": "ln(greatest(word_chars, 1) / cast(greatest(n_words, 1) as double))",
    "v2": "sqrt(n_symbols / cast(greatest(word_chars, 1) as double))",
    "v3": "sqrt(n_dup_lines / cast(greatest(n_lines, 1) as double))",
    "v4": "sqrt(n_repeat_words / cast(greatest(n_words, 1) as double))",
    "v5": "sqrt(n_capitals / cast(greatest(word_chars, 1) as double))",
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
D = len(VECTOR)
NAMES = list(VECTOR)


@dataclass(frozen=True)
class Limits:
    """Parameters of the estimate and of the verdict."""

    #: Base rule: fewer words, or a greater share of words in repeated windows (percent), fail.
    least_words: int = 50
    most_repeat_percent: int = 50
    #: Share of a pool that the estimate rests on.
    coverage: float = 0.75
    #: Concentration steps from each start.
    steps: int = 3
    #: A pool with fewer rows joins those of its language, and then all of the others.
    least_pool: int = 100
    #: The deviation of each statistic that is never unusual by itself, as a standard deviation
    #: added to the estimated one: single repeated lines, short texts with long words. A statistic adds
    #: at most (range / floor)^2 to the squared distance, so the floor of a share is a seventh of its
    #: root's range (1 for lines, and by the base rule the root of a half for words): the cutoff is
    #: within reach of each alone.
    floors: tuple[float, ...] = (0.1, 0.04, 1 / 7, 0.1, 0.1)
    #: chi-square quantile of ``coverage`` for the statistics, to bring distances to scale.
    chi_coverage: float = 6.6257
    #: Squared distance beyond which a document is rejected: chi-square's quantile of 0.99999 for the
    #: five statistics.
    cutoff: float = 30.8562


#: Classes of distance for each doubling of the squared distance, and the least one told apart.
FINE, LEAST = 64, 1e-9
#: Start subsets: the rows nearest to the medians by the sum of squares, and by the largest.
STARTS = 2


# --- statistics of a document -----------------------------------------------------------------


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words`` and the base statistics of each whole text, all long.

    Repeated windows are found by sorting 64-bit keys that hold a hash of three words above and the
    place below; neighbours with one hash are compared by their words. Each list has a projection of
    its own and is used several times after, so that the optimizer computes it once.
    """
    staged = (
        docs.withColumn("_text", text_or_empty(text))
        .withColumn("_trimmed", F.trim(c("_text"), F.lit(BLANKS)))
        .withColumn(
            "_words",
            F.when(c("_trimmed") == "", F.array().cast("array<string>")).otherwise(
                F.split("_trimmed", SPACE)
            ),
        )
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
        .withColumn("_n", F.size("_words"))
    )
    #: Bits that the places need.
    staged = staged.withColumn("_bits", F.expr("length(bin(_n))"))
    staged = staged.withColumn(
        "_keys",
        F.expr(
            "if(_n < 3, cast(array() as array<bigint>), sort_array(transform(sequence(0, _n - 3),"
            " i -> shiftleft(xxhash64(_words[i], _words[i + 1], _words[i + 2]), _bits) | i)))"
        ),
    )
    mask = "(shiftleft(1L, _bits) - 1)"

    def same(other: str) -> str:
        """The window of key ``x`` and that of another key hold the same words."""
        words = [
            f"_words[cast(x & {mask} as int) + {i}] = _words[cast({other} & {mask} as int) + {i}]"
            for i in range(3)
        ]
        return f"shiftrightunsigned(x ^ {other}, _bits) = 0 and " + " and ".join(words)

    staged = staged.withColumn(
        "_again",
        F.expr(
            f"filter(_keys, (x, k) -> (k > 0 and {same('_keys[k - 1]')})"
            f" or (k < size(_keys) - 1 and {same('_keys[k + 1]')}))"
        ),
    )
    staged = staged.withColumn(
        "_places", F.expr(f"sort_array(transform(_again, x -> cast(x & {mask} as int)))")
    )
    repeated = (
        "if(size(_places) = 0, 0, 3 + aggregate(sequence(1, size(_places)), 0, (a, k) ->"
        " a + if(k < size(_places), least(3, _places[k] - _places[k - 1]), 0)))"
    )

    def found(letters: str):
        return F.length("_text") - F.length(F.regexp_replace("_text", f"[{letters}]+", ""))

    return staged.select(
        *docs.columns,
        c("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        found(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        found(CAPITALS).cast("long").alias("n_capitals"),
    )


# --- estimates --------------------------------------------------------------------------------

PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _pools(rows: DataFrame, limits: Limits) -> DataFrame:
    """The pool of each language and source: their own, their language's, or that of the rest."""
    level = rows.where("not base_failed").groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    large = c("n") >= limits.least_pool
    of_lang = Window.partitionBy("_lang")
    rest = F.sum(F.when(large, 0).otherwise(c("n"))).over(of_lang)
    return level.select(
        "_lang",
        "_source",
        F.when(large, F.concat_ws("\x01", F.lit("source"), "_lang", "_source"))
        .when(rest >= limits.least_pool, F.concat_ws("\x01", F.lit("language"), "_lang"))
        .otherwise("rest")
        .alias("pool"),
    )


def _class(distance) -> Column:
    return F.floor(F.log2(distance + LEAST) * FINE).cast("int")


def _distance(rows: DataFrame) -> DataFrame:
    """Adds ``d``, the squared Mahalanobis distance by centre ``m`` and inverse root ``w``."""
    terms = []
    for i in range(D):
        turned = [f"w{i}_{j} * ({NAMES[j]} - m{j})" for j in range(i + 1)]
        terms.append("power(" + " + ".join(turned) + ", 2)")
    return rows.withColumn("d", F.expr(" + ".join(terms)))


def _nearest(rows: DataFrame, limits: Limits) -> DataFrame:
    """Per pool and start, the class of distance up to which rows make the coverage."""
    counts = rows.groupBy("pool", "start", _class(c("d")).alias("bin")).agg(
        F.count("*").alias("n")
    )
    whole = Window.partitionBy("pool", "start")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(
        "pool", "start", "bin", F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(whole).alias("all"),
    )
    enough = c("upto") >= F.ceil(c("all") * limits.coverage)
    return counts.where(enough).groupBy("pool", "start").agg(
        F.min("bin").alias("last"), F.first("all").alias("pool_rows")
    )


def _moments(rows: DataFrame, nearest: DataFrame, limits: Limits) -> DataFrame:
    """Centre and inverse root of the covariance of the nearest rows of each pool and start."""
    held = rows.join(nearest, ["pool", "start"]).where(_class(c("d")) <= c("last"))
    sums = [F.avg(v).alias(f"m{i}") for i, v in enumerate(NAMES)]
    products = [F.avg(c(NAMES[i]) * c(NAMES[j])).alias(f"p{i}_{j}") for i, j in PAIRS]
    out = held.groupBy("pool", "start").agg(F.first("pool_rows").alias("pool_rows"), *sums, *products)
    # Cholesky's root of the covariance, a column at a time.
    for i, j in PAIRS:
        value = f"p{i}_{j} - m{i} * m{j}" + (f" + {limits.floors[i] ** 2!r}D" if i == j else "")
        value += "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
        formula = f"sqrt({value})" if i == j else f"({value}) / l{j}_{j}"
        out = out.withColumn(f"l{i}_{j}", F.expr(formula))
    # Its inverse, by forward substitution.
    for j in range(D):
        for i in range(j, D):
            told = " + ".join(f"l{i}_{k} * w{k}_{j}" for k in range(j, i)) or "0"
            formula = f"{1 if i == j else 0} - ({told})"
            out = out.withColumn(f"w{i}_{j}", F.expr(f"({formula}) / l{i}_{i}"))
    det = " * ".join(f"l{i}_{i}" for i in range(D))
    names = [f"m{i}" for i in range(D)] + [f"w{i}_{j}" for i, j in PAIRS]
    return out.select("pool", "start", "pool_rows", F.expr(det).alias("det"), *names)


def _estimates(rows: DataFrame, scratch: Scratch, limits: Limits) -> DataFrame:
    """One row per pool: centre, inverse root, and the factor that brings distances to scale."""
    rows = rows.where("pool is not null").select("pool", *NAMES)
    # Rounded, the values are so few that exact percentiles need little memory.
    quartiles = rows.groupBy("pool").agg(
        *[
            F.percentile(F.round(v, 3), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}")
            for i, v in enumerate(NAMES)
        ]
    )
    squares = [
        f"power(({v} - q{i}[1]) / ((q{i}[2] - q{i}[0]) / 1.349D + {limits.floors[i]!r}D), 2)"
        for i, v in enumerate(NAMES)
    ]
    started = rows.join(scratch.store(quartiles, "quartiles"), "pool").select(
        "pool",
        *NAMES,
        F.posexplode(F.expr(f"array({' + '.join(squares)}, greatest({', '.join(squares)}))")).alias(
            "start", "d"
        ),
    )
    twice = rows.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(STARTS - 1))))
    now = started
    for _ in range(limits.steps + 1):
        nearest = scratch.store(_nearest(now, limits), "nearest")
        found = scratch.store(_moments(now, nearest, limits), "moments")
        now = _distance(twice.join(found.drop("pool_rows", "det"), ["pool", "start"]))
    best = Window.partitionBy("pool").orderBy("det", "start")
    found = found.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")
    reach = _nearest(_distance(rows.join(found, "pool")), limits).select(
        "pool", "start", F.greatest(
            F.lit(1.0), F.pow(F.lit(2.0), (c("last") + 1) / FINE) / limits.chi_coverage
        ).alias("factor")
    )
    return scratch.store(found.join(reach, ["pool", "start"]).drop("start", "det"), "estimates")


def with_verdicts(
    docs: DataFrame, *, carry: list[str], text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """The columns in ``carry``, the base statistics, ``base_failed``, ``distance`` and ``kept``.

    ``docs`` has ``lang``, ``source`` and the text column. A null text has no words and fails the
    base rule, as do empty ones; a null language or source counts as an empty one. Each row gets
    its own verdict, so repeated rows all stay or all go. Rows that fail the base rule take no part
    in the estimates. Pools with too few rows share one with their language and then with all other
    small pools; if those are still too few, nothing is rejected by distance. An empty table gives
    an empty one. A carried column with one of these names is replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    # Apart from the rest, columns of any name can be carried.
    own = docs.select(
        F.struct(*carry).alias("_carried"),
        F.coalesce("lang", F.lit("")).alias("_lang"),
        F.coalesce("source", F.lit("")).alias("_source"),
        c(text).alias("_raw"),
    )
    rows = with_statistics(own, "_raw").select(
        "_carried",
        "_lang",
        "_source",
        *BASE,
        *[F.expr(formula).alias(name) for name, formula in VECTOR.items()],
        (
            (c("n_words") < limits.least_words)
            | (100 * c("n_repeat_words") > limits.most_repeat_percent * c("n_words"))
        ).alias("base_failed"),
    )
    rows = stored(rows, "statistics")
    pools = scratch.store(_pools(rows, limits), "pools")
    estimates = _estimates(
        rows.where("not base_failed").join(pools, ["_lang", "_source"]), scratch, limits
    )
    enough = estimates.where(c("pool_rows") >= limits.least_pool)
    by_pool = stored(pools.join(enough, "pool"), "pool-estimates")
    scratch.clear()
    judged = _distance(rows.join(by_pool, ["_lang", "_source"], "left"))
    distance = c("d") / c("factor")
    told = {
        **{name: c(name) for name in BASE},
        "base_failed": c("base_failed"),
        "distance": F.when(~c("base_failed"), distance),
        "kept": ~c("base_failed") & F.coalesce(distance <= limits.cutoff, F.lit(True)),
    }
    return judged.select(
        *[c("_carried")[name].alias(name) for name in carry if name not in told],
        *[value.alias(name) for name, value in told.items()],
    )
