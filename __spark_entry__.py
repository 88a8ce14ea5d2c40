
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

import oracle_queries as oracle  # noqa: E402
from pitchside import testviews as views  # noqa: E402
from pitchside.functions.sentiment import Rules, score_posts, score_text  # noqa: E402
from pitchside.operators import entities, keyed, quality  # noqa: E402
from pitchside.operators.distinct import distinct_counts  # noqa: E402
from pitchside.plans import batch, contracts, dimensions, facts, marts, staging  # noqa: E402
from pitchside.schemas import RAW_POSTS  # noqa: E402
from pitchside.session import appended_by, scratch_path, stored, stored_by  # noqa: E402
from pitchside.sinks import tables as sink  # noqa: E402
from pitchside.sinks.landing import (  # noqa: E402
    batch_file, land_batch, land_files, read_landed, with_audit,
)
from pitchside.sinks.tables import create_if_absent  # noqa: E402
from pitchside.sources import documents, posts as post_source  # noqa: E402
from pitchside.sources.tables import parquet_tables, read_table, unseen_files  # noqa: E402
from pitchside.streaming import posts as stream  # noqa: E402

try:
    import corpus_pipeline
    from pitchside.llm import queries as text_queries
except ModuleNotFoundError as missing:  # the text operators may be left out
    if missing.name not in ("corpus_pipeline", "pitchside.llm"):
        raise
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
c = F.col


def _as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, like the oracle gives them."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            c(f.name).cast("string").alias(f.name) if isinstance(f.dataType, timed) else c(f.name)
            for f in df.schema.fields
        ]
    )


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_matches(views.raw_matches(spark, sf_dir))


def _balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_deliveries(views.raw_deliveries(spark, sf_dir))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = _matches(spark, sf_dir)
    return facts.fct_match_results(
        matches, dimensions.dim_teams(matches), dimensions.dim_venues(matches)
    )


def _ball_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The ball fact reads only columns that the match fact takes over from staging.
    balls = _balls(spark, sf_dir)
    return facts.fct_deliveries(balls, dimensions.dim_players(balls), _matches(spark, sf_dir))


# --- models -----------------------------------------------------------------------------------


def stg_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_matches(spark, sf_dir))


def stg_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_balls(spark, sf_dir))


def latest_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(staging.latest_post(views.raw_posts(spark, sf_dir)))


def dim_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_teams(_matches(spark, sf_dir))


def dim_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_venues(_matches(spark, sf_dir))


def dim_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_players(_balls(spark, sf_dir))


def surrogate_key_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids for as many keys as there are matches."""
    ids = views.raw_matches(spark, sf_dir).select("match_id")
    return entities.surrogate_key(ids, "match_id", "match_number")


def fct_match_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_results(spark, sf_dir))


def fct_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(_ball_facts(spark, sf_dir))


def team_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.team_matches(_matches(spark, sf_dir))


def best_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.best_figures(_balls(spark, sf_dir), _matches(spark, sf_dir))


def batting_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.batting_stats(_balls(spark, sf_dir), _matches(spark, sf_dir))


def bowling_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.bowling_stats(_balls(spark, sf_dir), _matches(spark, sf_dir))


def team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.team_performance(_balls(spark, sf_dir), _matches(spark, sf_dir))


def titles_won(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.ordered_report(marts.titles_won(_matches(spark, sf_dir)), "titles_won")


def player_career(spark: SparkSession, sf_dir: str) -> DataFrame:
    career = marts.player_career(batting_stats(spark, sf_dir), bowling_stats(spark, sf_dir))
    return batch.ordered_report(career, "player_career")


def daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.daily_sentiment(staging.latest_post(views.raw_posts(spark, sf_dir)))
    return _as_text(batch.ordered_report(daily, "daily_sentiment"))


# --- key-based loads --------------------------------------------------------------------------


def _held_and_read_again(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The matches before 1998, and a full re-read of all."""
    matches = views.raw_matches(spark, sf_dir).select(
        "match_id", "match_date", "season", "team1", "team2", "city", "venue"
    )
    existing = matches.where(c("match_date") < "1998-01-01")
    return existing, matches.withColumn("venue", F.concat("venue", F.lit(" (new)")))


def insert_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full re-read meets a table that holds the matches before 1998."""
    existing, incoming = _held_and_read_again(spark, sf_dir)
    new = keyed.insert_new_keys(existing, incoming, ["match_id"])
    return _as_text(existing.unionByName(new))


LOADED = ["match_id", "inning_number", "over_number", "ball_number", "batter", "bowler",
          "runs_batter", "runs_total"]


def _loaded_and_reloaded(
    spark: SparkSession, sf_dir: str, balls: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """All balls, and those since 1997 again without their wicket balls."""
    dates = views.raw_matches(spark, sf_dir).select("match_id", "match_date")
    balls = views.raw_deliveries(spark, sf_dir) if balls is None else balls
    again = balls.join(dates, "match_id").where(
        (c("match_date") >= "1997-01-01") & ~c("is_wicket")
    )
    existing = balls.select(*LOADED, F.lit("first load").alias("load"))
    return existing, again.select(*LOADED, F.lit("reloaded").alias("load"))


def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches since 1997 come again without their wicket balls."""
    existing, incoming = _loaded_and_reloaded(spark, sf_dir)
    return keyed.replace_by_key(existing, incoming, ["match_id"])


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ball fact holds the matches before 1999; the others are built and appended."""
    matches = _matches(spark, sf_dir)
    balls = _balls(spark, sf_dir)
    held = balls.join(
        matches.where(c("match_date") < "1999-01-01").select("match_id"), "match_id", "left_semi"
    )
    players = dimensions.dim_players(balls)
    return _as_text(facts.fct_deliveries(balls, players, matches, target=held))


def not_in_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners (some matches have none) against a list with a NULL, one without, and an empty one."""
    matches = _matches(spark, sf_dir).select("match_id", "match_winner", "event_stage")
    finals = matches.where(c("event_stage") == "Final").select("match_winner")
    lists = {
        "with null": matches.where(c("event_stage") == "Qualifier").select("match_winner"),
        "without null": finals.where(c("match_winner").isNotNull() & (c("match_winner") < "I")),
        "empty": finals.where(F.lit(False)),
    }
    found = [
        keyed.not_in(matches, "match_winner", listed).select(F.lit(name).alias("list"), "match_id")
        for name, listed in lists.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run log from the first half of the events, and the runs of the second half."""
    events = parquet_tables(spark, sf_dir, "events")["events"]
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    keys = [
        c("event_type").alias("pipeline_name"),
        F.concat(F.lit("user "), c("user_id").cast("string")).alias("run_type"),
    ]
    last = F.max("ts").alias("last_run_at")
    target = events.where(c("ts") < cut).groupBy(*keys).agg(last, F.count("*").alias("runs"))
    target = target.select(
        "pipeline_name", "run_type", "last_run_at", F.lit("STALE").alias("status"), "runs"
    )
    source = events.where(c("ts") >= cut).groupBy(*keys).agg(last)
    return target, source.withColumn("status", F.lit("SUCCESS"))


def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log after the second half of its runs."""
    target, source = _run_log(spark, sf_dir)
    return _as_text(keyed.upsert_by_key(target, source, ["pipeline_name", "run_type"]))


def _new_table(spark: SparkSession, label: str, schema: T.StructType, bucketed: bool = False) -> str:
    """The name of a fresh raw table; where there is no such database yet, it lies in scratch."""
    place = scratch_path(spark, "raw")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw LOCATION '{place}'")
    name = f"{label}_{uuid.uuid4().hex}"
    create_if_absent(spark, "raw", name, schema, bucketed)
    return name


def load_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``insert_new_keys`` as a stored table, loaded twice and read back."""
    existing, incoming = _held_and_read_again(spark, sf_dir)
    name = _new_table(spark, "inserted", existing.schema)
    for load in (existing, incoming, incoming):
        sink.load_new_keys(load, "raw", name, ["match_id"])
    return _as_text(read_table(spark, "raw", name))


def load_replacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``replace_by_key`` as a stored table, loaded in two steps and read back."""
    # Both loads read the balls, which are made once and lie by match.
    balls = views.raw_deliveries(spark, sf_dir).select(*LOADED, "is_wicket")
    existing, incoming = _loaded_and_reloaded(spark, sf_dir, stored_by(balls, "balls", "match_id"))
    name = _new_table(spark, "replaced", existing.schema, bucketed=True)
    for load in (existing, incoming):
        sink.load_replacing(load, "raw", name, ["match_id"], 8)
    return read_table(spark, "raw", name).drop(sink.BUCKET)


def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``upsert_by_key`` as a stored log table, read back."""
    target, source = _run_log(spark, sf_dir)
    name = _new_table(spark, "log", target.schema)
    sink.append_rows(target, "raw", name)
    sink.upsert_rows(source, "raw", name, ["pipeline_name", "run_type"])
    return _as_text(read_table(spark, "raw", name))


def unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of one kind of host have been ingested before."""
    pages = parquet_tables(spark, sf_dir, "pages")["pages"]
    listing = pages.select(c("url").alias("file_name"))
    manifest = pages.where(c("url").contains(".com/")).select(c("url").alias("file_name"))
    return unseen_files(listing, manifest)


# --- nested documents and landed posts --------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    texts = views.match_document_texts(spark, sf_dir)
    return documents.parse_match_docs(texts, "match_id", "document")


def match_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(documents.match_headers(_parsed(spark, sf_dir)[0]))


def document_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.deliveries(_parsed(spark, sf_dir)[0])


def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir)[1].select("match_id")


def post_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = views.post_response_texts(spark, sf_dir)
    return _as_text(post_source.post_records(post_source.parse_responses(texts, "response")))


# --- landing and streaming --------------------------------------------------------------------


def _scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.scored_posts(parquet_tables(spark, sf_dir, "events")["events"])


def land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all posts as JSON by hour of fetch and count what lies in each folder."""
    path = land_batch(_scored_events(spark, sf_dir), "fetched_at", scratch_path(spark, "land"), 0)
    hours = (
        "post_id STRING, year STRING, month STRING, day STRING, hour STRING"
    )
    landed = spark.read.schema(hours).json(path)
    return landed.groupBy(F.concat_ws("/", "year", "month", "day", "hour").alias("hour")).agg(
        F.count("*").alias("posts"), F.countDistinct("post_id").alias("distinct_posts")
    )


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts appended with the file of their hour of fetch, and what lies in each of these files."""
    posts = _scored_events(spark, sf_dir)
    file = batch_file("posts/raw", "posts", F.date_trunc("hour", "fetched_at"))
    raw = stored(with_audit(posts, "load", file), "audited")
    root = scratch_path(spark, "landing")
    land_files(raw, root, "pipeline_batch_file", posts.columns)
    landed = read_landed(spark, root, "post_id STRING, sentiment_label STRING", "pipeline_batch_file")
    found = landed.groupBy("pipeline_batch_file").agg(
        F.count("*").alias("landed"), F.countDistinct("post_id").alias("landed_posts"),
        F.count_if(c("sentiment_label") == "POSITIVE").alias("landed_positive"),
    )
    rows = raw.groupBy("pipeline_batch_file").agg(F.count("*").alias("appended"))
    return rows.join(found, "pipeline_batch_file", "full")


def winners_with_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners' ids, with the teams and grounds that hold many matches dealt over copies."""
    matches = _matches(spark, sf_dir)
    hot = entities.hot_keys(matches, ["team1", "match_winner", "venue"], 0.1)
    results = facts.fct_match_results(
        matches, dimensions.dim_teams(matches), dimensions.dim_venues(matches), hot
    )
    return results.select("match_id", "team1_id", "team2_id", "winner_id", "venue_id")


def audited_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in the shape of the raw table, appended with batch id and batch file."""
    posts = _scored_events(spark, sf_dir)
    load_id = F.concat(F.lit("load-"), F.date_format("fetched_at", "yyyyMMddHH"))
    file = batch_file("posts/raw", "posts", c("fetched_at"))
    raw = stored(with_audit(posts, load_id, file), "audited")
    return _as_text(
        raw.select("post_id", "post_title", "score", "fetched_at", "sentiment_compound",
                   "sentiment_label", "pipeline_load_id", "pipeline_batch_file")
    )


def _streamed(spark: SparkSession, sf_dir: str) -> stream.PostPaths:
    """All events as files, taken one file per micro-batch."""
    events = parquet_tables(spark, sf_dir, "events")["events"]
    landed = scratch_path(spark, "event-files")
    events.repartitionByRange(4, "ts").write.parquet(landed)
    source = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    )
    paths = stream.PostPaths(scratch_path(spark, "stream"), buckets=8)
    query = stream.run_sentiment_stream(
        views.scored_posts(source), paths, trigger={"availableNow": True}
    )
    query.awaitTermination()
    return paths


def stream_latest_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = stream.read_latest(spark, _streamed(spark, sf_dir))
    return _as_text(latest.drop("version_tie", "loaded_at"))


def stream_daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(stream.read_daily(spark, _streamed(spark, sf_dir)))


def stream_scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as posts, in files of a micro-batch each: scored, landed, appended, and read back."""
    pages = parquet_tables(spark, sf_dir, "pages")["pages"]
    own = {
        "post_id": c("page_id").cast("string"), "post_title": c("url"), "post_body": c("html"),
        "created_utc": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        "fetched_at": F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"),
    }
    fields = [f for f in RAW_POSTS.fields if not f.name.startswith(("pipeline_", "sentiment_", "raw_"))]
    posts = pages.select(
        *[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    folder = scratch_path(spark, "post-files")
    posts.repartition(2, "post_id").write.parquet(folder)
    source = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    paths = stream.PostPaths(scratch_path(spark, "stream"), buckets=8)
    query = stream.run_sentiment_stream(
        source, paths, _lexicon(spark), trigger={"availableNow": True}
    )
    query.awaitTermination()
    scores = ["sentiment_score", "sentiment_label", "sentiment_pos", "sentiment_neg", "sentiment_neu"]
    return stream.read_latest(spark, paths).select("post_id", *scores)


# --- text scoring -----------------------------------------------------------------------------


def _lexicon(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(oracle.LEXICON.items()), "token STRING, valence DOUBLE")
    return stored(rows.coalesce(1), "lexicon")


def text_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.spread(spark, sf_dir, "documents")
    return score_text(docs, "doc_id", "text", _lexicon(spark))


def text_sentiment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.spread(spark, sf_dir, "documents")
    rules = Rules(
        intensifiers=oracle.INTENSIFIERS,
        dampeners=oracle.DAMPENERS,
        negations=oracle.NEGATIONS,
        contrast=oracle.CONTRAST,
        pair_dampeners=oracle.PAIR_DAMPENERS,
        never=oracle.NEVER,
        never_with=oracle.NEVER_WITH,
        without=oracle.WITHOUT,
        without_with=oracle.WITHOUT_WITH,
        least=oracle.LEAST,
        least_without=oracle.LEAST_WITHOUT,
        no=oracle.NO,
        no_with=oracle.NO_WITH,
    )
    return score_text(docs, "doc_id", "text", _lexicon(spark), rules=rules)


def post_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.spread(spark, sf_dir, "pages")
    posts = pages.select("page_id", c("url").alias("post_title"), c("html").alias("post_body"))
    return score_posts(posts, _lexicon(spark)).drop("post_title", "post_body")


# --- data quality -----------------------------------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"stg_matches": _matches(spark, sf_dir), "stg_deliveries": _balls(spark, sf_dir)}
    rules = {name: quality.Rules(not_null=df.columns) for name, df in tables.items()}
    return quality.run_checks(tables, rules)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"stg_deliveries": _balls(spark, sf_dir), "stg_matches": _matches(spark, sf_dir)}
    rules = {
        "stg_deliveries": quality.Rules(unique=["match_id", "batter"]),
        "stg_matches": quality.Rules(unique=["match_id", "city"]),
    }
    return quality.run_checks(tables, rules)


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"stg_deliveries": _balls(spark, sf_dir), "stg_matches": _matches(spark, sf_dir)}
    rules = {
        "stg_deliveries": quality.Rules(
            accepted=[
                quality.Accepted("wicket_kind", ["caught"], "wicket_kind is not null"),
                quality.Accepted("extras_type", ["wides"], "is_wicket"),
            ]
        ),
        "stg_matches": quality.Rules(
            accepted=[
                quality.Accepted("toss_decision", contracts.TOSS_DECISIONS),
                quality.Accepted("result_type", ["runs", "wickets"]),
            ]
        ),
    }
    return quality.run_checks(tables, rules)


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over all models. Row checks are counted while the models are written."""
    measured = quality.Measured(contracts.RULES)

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        df = measured.watch(df, name)
        # What is joined and summed by match lies by match.
        return stored_by(df, name, "match_id") if "match_id" in df.columns else stored(df, name)

    matches = keep("staging", "stg_matches", _matches(spark, sf_dir))
    balls = keep("staging", "stg_deliveries", _balls(spark, sf_dir))
    tables = batch.match_models(matches, balls, keep)
    tables["raw_posts"] = views.raw_posts(spark, sf_dir)
    tables["latest_post"] = keep("staging", "latest_post", staging.latest_post(tables["raw_posts"]))
    tables["daily_sentiment"] = keep(
        "marts", "daily_sentiment", marts.daily_sentiment(tables["latest_post"])
    )
    return measured.report(spark, tables)


def merged_sums(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The sums per match of two loads, matches before 1998 and since, appended one after the other."""
    balls, matches = _balls(spark, sf_dir), _matches(spark, sf_dir)
    early = matches.where(c("match_date") < "1998-01-01").select("match_id").distinct()
    # The balls are made once for both loads and all sums, and lie by match.
    held = balls.join(early.withColumn("early", F.lit(True)), "match_id", "left").select(
        "match_id", "inning_number", "batting_team", "batter", "bowler", "runs_batter", "runs_total",
        "is_four", "is_six", "is_wicket", c("early").isNotNull().alias("early"),
    )
    held = stored_by(held, "balls", "match_id")
    loads = [held.where("early"), held.where("not early")]
    return {
        name: appended_by([part(load) for load in loads], name, "match_id")
        for name, part in marts.PARTS.items()
    }


def merged_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Season marts of players, merged from the stored sums of two loads."""
    sums = merged_sums(spark, sf_dir)
    matches = stored_by(_matches(spark, sf_dir).select("match_id", "season"), "seasons", "match_id")
    batting = marts.batting_of(sums["batting_innings"], matches)
    bowling = marts.bowling_of(sums["bowling_matches"], matches)
    return batting.select(
        "player_name", "season", "total_runs", "strike_rate", "average", "highest_score"
    ).join(
        bowling.select("player_name", "season", "economy_rate", "best_bowling_figures"),
        ["player_name", "season"], "full",
    )


def seasons_played(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons of each batter, from rows that repeat a player's season for every innings."""
    innings = marts.batting_innings(_balls(spark, sf_dir))
    rows = innings.join(_matches(spark, sf_dir).select("match_id", "season"), "match_id")
    return distinct_counts(rows, ["batter"], "season", "seasons")


# --- contract ---------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: batting statistics per player and season."""
    return batting_stats(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """One entry per model and operator."""
    found = {
        "stg_matches": stg_matches,
        "stg_deliveries": stg_deliveries,
        "latest_post": latest_post,
        "dim_teams": dim_teams,
        "dim_venues": dim_venues,
        "dim_players": dim_players,
        "surrogate_key_by_range": surrogate_key_by_range,
        "fct_match_results": fct_match_results,
        "fct_deliveries": fct_deliveries,
        "team_matches": team_matches,
        "best_figures": best_figures,
        "batting_stats": batting_stats,
        "bowling_stats": bowling_stats,
        "team_performance": team_performance,
        "titles_won": titles_won,
        "player_career": player_career,
        "daily_sentiment": daily_sentiment,
        "insert_new_keys": insert_new_keys,
        "replace_by_key": replace_by_key,
        "incremental_append": incremental_append,
        "not_in_with_nulls": not_in_with_nulls,
        "upsert_by_key": upsert_by_key,
        "unseen_files": unseen,
        "match_headers": match_headers,
        "document_balls": document_balls,
        "rejected_documents": rejected_documents,
        "post_records": post_records,
        "land_batch": land,
        "landed_files": landed_files,
        "winners_with_hot_keys": winners_with_hot_keys,
        "audited_append": audited_append,
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_accepted_values": dq_accepted_values,
        "dq_report": dq_report,
        "merged_marts": merged_marts,
        "seasons_played": seasons_played,
        "text_sentiment": text_sentiment,
        "text_sentiment_rules": text_sentiment_rules,
        "post_sentiment": post_sentiment,
        "stream_latest_post": stream_latest_post,
        "stream_daily_sentiment": stream_daily_sentiment,
        "stream_scored_posts": stream_scored_posts,
        "load_new_keys": load_new_keys,
        "load_replacing": load_replacing,
        "upsert_rows": upsert_rows,
    }
    if text_queries:
        found |= text_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The DuckDB twin of each query."""
    return dict(oracle.SQL) | (text_queries.oracle_sql() if text_queries else {})
