"""The batch run: documents to raw tables, staging views, dimensions, facts, marts, checks, log."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchside.functions.columns import utc_now
from pitchside.operators.quality import Measured, Rules, run_checks
from pitchside.plans import dimensions, facts, marts, staging
from pitchside.plans.contracts import RULES
from pitchside.schemas import RAW_DELIVERIES, RAW_MATCHES, REJECTED_DOCUMENTS, RUN_LOG
from pitchside.session import stored
from pitchside.sinks import tables as sink
from pitchside.sources import documents
from pitchside.sources.tables import read_table, table_name

KEY_BUCKETS = 256
#: Partition of the ball fact and of the sums that marts keep of it: the run that brought the rows.
LOAD = "load_id"

# Stored report -> the column its rows are shown by, greatest first.
REPORT_ORDER = {
    "titles_won": "titles_won",
    "player_career": "career_runs",
    "daily_sentiment": "post_date",
}


def ordered_report(df: DataFrame, model: str) -> DataFrame:
    """Rows of a mart in its display order. Stored order is not part of a table's content."""
    return df.orderBy(F.col(REPORT_ORDER[model]).desc())


def _create_raw_tables(spark: SparkSession) -> None:
    sink.create_if_absent(spark, "raw", "raw_matches", RAW_MATCHES)
    sink.create_if_absent(spark, "raw", "raw_deliveries", RAW_DELIVERIES, bucketed=True)
    sink.create_if_absent(spark, "raw", "rejected_documents", REJECTED_DOCUMENTS)


def _load(parsed: DataFrame, buckets: int) -> DataFrame:
    """Load the sound documents and append the others to the rejects, which are returned."""
    parsed = stored(parsed, "documents")  # the text is parsed once, all row sets read the columns
    docs, rejects = documents.split_docs(parsed)
    loaded_at = utc_now()
    sink.load_new_keys(
        rejects.withColumn("loaded_at", loaded_at), "raw", "rejected_documents",
        ["match_id"],
    )
    headers = documents.match_headers(docs).withColumn("loaded_at", loaded_at)
    balls = documents.deliveries(docs).withColumn("loaded_at", loaded_at)
    sink.load_new_keys(headers, "raw", "raw_matches", ["match_id"])
    sink.load_replacing(balls, "raw", "raw_deliveries", ["match_id"], buckets)
    return rejects


def load_documents(spark: SparkSession, path: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Parse a whole folder of match documents into the raw tables; returns the rejected files."""
    _create_raw_tables(spark)
    return _load(documents.scan_match_docs(spark, path), buckets)


def load_new_documents(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    buckets: int = KEY_BUCKETS,
    files_per_batch: int | None = None,
) -> None:
    """The same for the files that came since the last call with this checkpoint folder.

    Rejected files are found in the table ``rejected_documents``: no later call is offered them again.

    Files do not change once they are there, so the raw tables end up as after a full read. A batch
    that runs again after a failure replaces its own rows.
    """
    _create_raw_tables(spark)
    query = (
        documents.stream_match_docs(spark, path, files_per_batch)
        .writeStream.foreachBatch(lambda docs, _: (_load(docs, buckets), None)[1])
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # The batches ran in a session of the query; this one may know the tables' files of before.
    for name in ("raw_matches", "raw_deliveries", "rejected_documents"):
        spark.catalog.refreshTable(table_name("raw", name))


#: Stores a model's frame (layer, name, frame) and gives a scan of it.
Keep = Callable[[str, str, DataFrame], DataFrame]
#: Stores the ball fact, made of players and results, and the sums per match that marts keep of it.
Grow = Callable[[DataFrame, DataFrame], tuple[DataFrame, Mapping[str, DataFrame]]]


def match_models(
    matches: DataFrame, balls: DataFrame, keep: Keep, grow: Grow | None = None
) -> dict[str, DataFrame]:
    """All match models from the staging frames, each stored by ``keep`` before it is read.

    Without ``grow`` the ball fact is built as a whole, and its sums with each mart.
    """
    built = {"stg_matches": matches, "stg_deliveries": balls}

    def table(layer: str, name: str, df: DataFrame) -> DataFrame:
        built[name] = keep(layer, name, df)
        return built[name]

    teams = table("dimensions", "dim_teams", dimensions.dim_teams(matches))
    venues = table("dimensions", "dim_venues", dimensions.dim_venues(matches))
    players = table("dimensions", "dim_players", dimensions.dim_players(balls))
    results = table(
        "facts", "fct_match_results", facts.fct_match_results(matches, teams, venues)
    )
    if grow:
        built["fct_deliveries"], parts = grow(players, results)
    else:
        fact = table("facts", "fct_deliveries", facts.fct_deliveries(balls, players, results))
        parts = {name: part(fact) for name, part in marts.PARTS.items()}
    for name, mart in stat_marts(parts, results).items():
        table("marts", name, mart)
    career = marts.player_career(built["batting_stats"], built["bowling_stats"])
    table("marts", "player_career", career)
    return built


def _loads(spark: SparkSession, layer: str, name: str) -> set[str]:
    """The loads a table holds: one short name for each run, known without a scan."""
    target = table_name(layer, name)
    if not spark.catalog.tableExists(target):
        return set()
    rows = spark.sql(f"SHOW PARTITIONS {target}").collect()
    return {row[0].split("=", 1)[1] for row in rows}


def add_sums(spark: SparkSession, name: str) -> DataFrame:
    """Bring the stored sums of ``marts.PARTS[name]`` up to the ball fact and return all of them.

    Only the balls of loads that the sums lack are read, so a run costs what it has loaded. A run that
    ended before its sums were there leaves them to the next one.
    """
    fact = read_table(spark, "facts", "fct_deliveries")
    lacking = sorted(_loads(spark, "facts", "fct_deliveries") - _loads(spark, "marts", name))
    new = fact.where(F.col(LOAD).isin(lacking))
    sums = None
    for load in lacking:
        part = marts.PARTS[name](new.where(F.col(LOAD) == load)).withColumn(LOAD, F.lit(load))
        sums = part if sums is None else sums.unionByName(part)
    if sums is None:
        if spark.catalog.tableExists(table_name("marts", name)):
            return read_table(spark, "marts", name).drop(LOAD)
        sums = marts.PARTS[name](fact.limit(0)).withColumn(LOAD, F.lit(""))
    return sink.append_rows(sums, "marts", name, LOAD).drop(LOAD)


def build_models(
    spark: SparkSession,
    loaded: DataFrame | None = None,
    buckets: int = KEY_BUCKETS,
    load_id: str | None = None,
    measured: Measured | None = None,
) -> dict[str, DataFrame]:
    """Build all match models from the raw tables; the ball fact only grows by new matches.

    ``loaded`` holds the ``match_id`` of all that was loaded since the models were last built, if the
    caller knows: then only these are looked for in the raw balls, of whose ``buckets`` only theirs are
    read. ``measured`` counts the row checks of the tables that are written as a whole.
    """
    load_id = load_id or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    raw_balls = read_table(spark, "raw", "raw_deliveries")
    matches = staging.stg_matches(read_table(spark, "raw", "raw_matches"))
    balls = staging.stg_deliveries(raw_balls)
    matches.createOrReplaceTempView("stg_matches")
    balls.createOrReplaceTempView("stg_deliveries")

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        return sink.rebuild_table(measured.watch(df, name) if measured else df, layer, name)

    def grow(players: DataFrame, results: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        fact = table_name("facts", "fct_deliveries")
        held = spark.table(fact).drop(LOAD) if spark.catalog.tableExists(fact) else None
        source = balls
        if held is not None and loaded is not None:
            source = staging.stg_deliveries(sink.in_buckets_of(raw_balls, loaded, ["match_id"], buckets))
        new_balls = facts.fct_deliveries(source, players, results, held, loaded)
        whole = sink.append_rows(
            new_balls.withColumn(LOAD, F.lit(load_id)), "facts", "fct_deliveries", LOAD
        )
        return whole.drop(LOAD), {name: add_sums(spark, name) for name in marts.PARTS}

    return match_models(matches, balls, keep, grow)


def stat_marts(parts: Mapping[str, DataFrame], matches: DataFrame) -> dict[str, DataFrame]:
    """The marts that merge the sums per match, and the one of the matches alone."""
    return {
        "batting_stats": marts.batting_of(parts["batting_innings"], matches),
        "bowling_stats": marts.bowling_of(parts["bowling_matches"], matches),
        "team_performance": marts.team_performance_of(parts["team_runs"], matches),
        "titles_won": marts.titles_won(matches),
    }


def declared_rules(tables: Iterable[str]) -> dict[str, Rules]:
    """The declared checks of the given models."""
    return {name: RULES[name] for name in RULES if name in set(tables)}


def check_models(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared checks of the given models."""
    return run_checks(tables, declared_rules(tables))


def log_run(spark: SparkSession, pipeline: str, run_type: str) -> None:
    """Set the last success of a pipeline in the run log."""
    sink.create_if_absent(spark, "marts", "pipeline_run_log", RUN_LOG)
    row = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(run_type).alias("run_type"),
        F.current_timestamp().alias("last_run_at"),
        F.lit("SUCCESS").alias("status"),
    )
    sink.upsert_rows(row, "marts", "pipeline_run_log", ["pipeline_name", "run_type"])


def run_batch(
    spark: SparkSession, path: str, buckets: int = KEY_BUCKETS, checkpoint: str | None = None
) -> DataFrame:
    """Load, build, check, and log the run once all of it has succeeded; returns the checks.

    With ``checkpoint`` only files that no earlier run has read are loaded.
    """
    if checkpoint:
        load_new_documents(spark, path, checkpoint, buckets)
    else:
        load_documents(spark, path, buckets)
    measured = Measured(RULES)
    models = build_models(spark, measured=measured)
    report = stored(measured.report(spark, models), "checks")
    log_run(spark, "match_pipeline", "Batch")
    return report
