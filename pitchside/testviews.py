"""The raw tables of the engine, derived from the star-schema test tables.

Every expression here has a twin in ``oracle_queries.py`` that means the same in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchside.functions.sentiment import sentiment_label
from pitchside.schemas import MATCH_DOCUMENT
from pitchside.sources.tables import parquet_tables

c = F.col


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table dealt evenly: its one small file would be read by one task."""
    table = parquet_tables(spark, sf_dir, name)[name]
    return table.repartition(spark.sparkContext.defaultParallelism)


def _text(value: Column) -> Column:
    return value.cast("string")


def _named(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), _text(number))


def _with_teams(orders: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the names of both teams to rows that hold the columns of an order."""
    nation = parquet_tables(orders.sparkSession, sf_dir, "nation")["nation"]
    names = nation.select(c("n_nationkey").cast("long").alias("n_nationkey"), "n_name")
    first = names.select(c("n_nationkey").alias("_n1"), c("n_name").alias("team1"))
    second = names.select(c("n_nationkey").alias("_n2"), c("n_name").alias("team2"))
    key, cust = c("o_orderkey"), c("o_custkey")
    return orders.join(first, cust % 10 == c("_n1")).join(
        second, (cust + 1 + key % 9) % 10 == c("_n2")
    )


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match per order."""
    key, cust, status = c("o_orderkey"), c("o_custkey"), c("o_orderstatus")
    year = F.year("o_orderdate")
    orders = parquet_tables(spark, sf_dir, "orders")["orders"]
    return _with_teams(orders, sf_dir).select(
        _text(key).alias("match_id"),
        c("o_orderdate").cast("date").alias("match_date"),
        F.when(year == 1995, "2007/08")
        .when(year == 1996, "2009/10")
        .when(year == 1997, "2020/21")
        .otherwise(_text(year))
        .alias("season"),
        "team1",
        "team2",
        _named("Ground ", cust % 17).alias("venue"),
        F.when(key % 3 == 1, _named("City ", cust % 17))
        .when(key % 3 == 2, _named("Town ", cust % 17))
        .alias("city"),
        F.when(key % 2 == 0, c("team1")).otherwise(c("team2")).alias("toss_winner"),
        F.when(key % 4 < 2, "bat").otherwise("field").alias("toss_decision"),
        F.when(status == "P", None)
        .when(key % 3 == 0, c("team1"))
        .otherwise(c("team2"))
        .alias("match_winner"),
        F.when(status == "F", key % 90 + 1).cast("int").alias("win_by_runs"),
        F.when(status == "O", key % 10 + 1).cast("int").alias("win_by_wickets"),
        _named("Player ", cust % 60).alias("player_of_match"),
        F.lit("League").alias("event_name"),
        F.when(key % 97 == 0, "Final").when(key % 89 == 0, "Qualifier").alias("event_stage"),
        (key % 70 + 1).cast("int").alias("event_match_number"),
        c("o_orderdate").alias("loaded_at"),
    )


def raw_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ball per line item."""
    t = parquet_tables(spark, sf_dir, "lineitem", "orders")
    orders = t["orders"].select("o_orderkey", "o_custkey", _text(c("o_orderkey")).alias("_order"))
    # The big join comes first: on the bare order columns its sizes are known. It is on the id as it is
    # given out, so that what follows by match finds the balls of a match together already.
    lines = t["lineitem"].withColumn("match_id", _text(c("l_orderkey")))
    lines = lines.join(orders, c("match_id") == c("_order"))
    line, part, supp = c("l_linenumber"), c("l_partkey"), c("l_suppkey")
    extra = c("l_returnflag") == "N"
    runs = c("l_quantity").cast("int") % 7
    extras = F.when(extra, 1).otherwise(0)
    wicket = (c("l_returnflag") == "R") & (c("l_orderkey") % 5 == 0) & (part % 60 >= 10)
    batter = _named("Player ", supp)
    return _with_teams(lines, sf_dir).select(
        "match_id",
        (1 + line % 2).cast("int").alias("inning_number"),
        F.when(line % 2 == 0, c("team1")).otherwise(c("team2")).alias("batting_team"),
        (line - 1).cast("int").alias("over_number"),
        (part % 6).cast("int").alias("ball_number"),
        batter.alias("batter"),
        _named("Player ", part % 60).alias("bowler"),
        _named("Player ", (supp + 1) % 60).alias("non_striker"),
        runs.alias("runs_batter"),
        extras.alias("runs_extras"),
        (runs + extras).alias("runs_total"),
        F.when(extra & (c("l_linestatus") == "F"), "wides")
        .when(extra, "noballs")
        .alias("extras_type"),
        wicket.alias("is_wicket"),
        F.when(wicket & (supp % 3 == 0), "caught")
        .when(wicket & (supp % 3 == 1), "bowled")
        .when(wicket, "run out")
        .alias("wicket_kind"),
        F.when(wicket, batter).alias("player_out"),
        F.when(wicket & (supp % 3 == 0), _named("Player ", part % 60)).alias("fielder"),
        c("l_shipdate").alias("loaded_at"),
    )


def scored_posts(events: DataFrame) -> DataFrame:
    """One fetched and scored post version per event."""
    event = c("event_id")
    post = event % 400
    score = F.when(event % 50 == 0, None).otherwise(
        (event * 7919 % 2001 - 1000).cast("double") / 1000.0
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (post % 30).cast("int"))
    return events.select(
        _named("p", post).alias("post_id"),
        c("event_type").alias("post_title"),
        _named("user ", c("user_id")).alias("post_author"),
        F.lit("League").alias("subreddit"),
        _named("/post/", post).alias("post_url"),
        c("props").alias("post_body"),
        F.floor("value").cast("long").alias("score"),
        ((event % 100).cast("double") / 100.0).alias("upvote_ratio"),
        (event % 100).alias("num_comments"),
        day.cast("timestamp_ntz").alias("created_utc"),
        c("ts").alias("fetched_at"),
        score.alias("sentiment_compound"),
        F.when(score > 0, score).otherwise(0.0).alias("sentiment_positive"),
        F.when(score < 0, -score).otherwise(0.0).alias("sentiment_negative"),
        (1.0 - F.abs(F.coalesce(score, F.lit(0.0)))).alias("sentiment_neutral"),
        sentiment_label(score).alias("sentiment_label"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post versions with audit columns; the load id orders like the event id."""
    events = parquet_tables(spark, sf_dir, "events")["events"]
    posts = scored_posts(events)
    return posts.select(
        F.concat(
            F.lit("load-"), F.date_format("fetched_at", "yyyyMMdd")
        ).alias("pipeline_load_id"),
        c("fetched_at").alias("pipeline_loaded_at"),
        F.lit(None).cast("string").alias("pipeline_batch_file"),
        *posts.columns,
        F.lit(None).cast("string").alias("raw_json"),
    )


def match_document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested match document per order, some cut short and some without their header."""
    k = c("match_id").cast("long")
    year = F.year("match_date")
    player, bowler = c("player_of_match"), F.concat(F.lit("Bowler "), (k % 50).cast("string"))

    def number(value: Column) -> Column:
        return value.cast("int")

    def document(season: Column) -> Column:
        info = F.struct(
            F.array(c("match_date").cast("string")).alias("dates"),
            season.alias("season"),
            F.when(k % 9 == 0, F.array("team1")).otherwise(F.array("team1", "team2")).alias("teams"),
            "venue",
            "city",
            F.struct(c("toss_winner").alias("winner"), c("toss_decision").alias("decision")).alias(
                "toss"
            ),
            F.struct(
                c("match_winner").alias("winner"),
                F.struct(
                    c("win_by_runs").alias("runs"), c("win_by_wickets").alias("wickets")
                ).alias("by"),
            ).alias("outcome"),
            F.struct(
                c("event_name").alias("name"),
                c("event_stage").alias("stage"),
                c("event_match_number").alias("match_number"),
            ).alias("event"),
            F.when(k % 4 != 0, F.array(player)).alias("player_of_match"),
        )
        return F.to_json(
            F.struct(F.when(k % 13 != 0, info).alias("info"), innings.alias("innings"))
        )

    def ball(**fields: Column) -> Column:
        return F.struct(
            player.alias("batter"),
            bowler.alias("bowler"),
            *[value.alias(name) for name, value in fields.items()],
        )

    def runs(batter: Column, extras: Column, total: Column) -> Column:
        return F.struct(batter.alias("batter"), extras.alias("extras"), total.alias("total"))

    none = F.lit(None)
    no_runs = none.cast("struct<batter:int,extras:int,total:int>")
    wickets_type = (
        "array<struct<kind:string,player_out:string,fielders:array<struct<name:string>>>>"
    )
    fielder = F.struct(F.concat(F.lit("Fielder "), (k % 40).cast("string")).alias("name"))
    wicket = F.struct(
        F.lit("caught").alias("kind"),
        player.alias("player_out"),
        F.when(k % 2 == 0, F.array(fielder)).alias("fielders"),
    )
    second = F.struct(
        F.lit("run out").alias("kind"),
        F.lit("Player 0").alias("player_out"),
        F.when(k % 2 == 0, F.array(fielder)).alias("fielders"),
    )
    first_ball = ball(
        non_striker=F.lit("Player 0"),
        runs=runs(number(k % 7), number(k % 2), number(k % 7 + k % 2)),
        extras=F.when(k % 2 == 1, F.create_map(F.lit("noballs"), F.lit(1), F.lit("byes"), F.lit(2))),
        wickets=F.when(k % 5 == 0, F.array().cast(wickets_type)),
    )
    second_ball = ball(
        non_striker=none.cast("string"),
        runs=no_runs,
        extras=none.cast("map<string,int>"),
        wickets=F.when(k % 3 == 0, F.array(wicket, second)).cast(wickets_type),
    )
    late_ball = ball(
        non_striker=none.cast("string"),
        runs=runs(number(k % 5), none.cast("int"), number(k % 5)),
        extras=none.cast("map<string,int>"),
        wickets=none.cast(wickets_type),
    )

    def inning(team: str, *overs: Column) -> Column:
        return F.struct(c(team).alias("team"), F.array(*overs).alias("overs"))

    def over(index: Column, *balls: Column) -> Column:
        return F.struct(index.alias("over"), F.array(*balls).alias("deliveries"))

    opening = inning("team1", over(F.lit(0), first_ball, second_ball))
    no_overs = F.struct(
        c("team2").alias("team"), F.lit(None).cast(_overs_type()).alias("overs")
    )
    late = inning("team2", over(number(k % 20), late_ball))
    innings = F.when(k % 3 == 1, F.array(opening, no_overs)).otherwise(
        F.array(opening, no_overs, late)
    )
    spelled = F.when(k % 7 != 0, c("season"))
    season = F.coalesce(F.when(k % 2 == 0, year.cast("string")), spelled)
    texts = raw_matches(spark, sf_dir).select("match_id", document(season).alias("document"))
    # Four-digit seasons become JSON numbers; every eleventh document is cut short.
    text = F.regexp_replace("document", r'"season":"(\d{4})"', '"season":$1')
    kept = F.length("document") - F.when(k % 11 == 0, 10).otherwise(0)
    return texts.select("match_id", F.substring(text, F.lit(1), kept).alias("document"))


def _overs_type() -> str:
    innings = MATCH_DOCUMENT["innings"].dataType
    return innings.elementType["overs"].dataType.simpleString()


def post_response_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed response of two posts per event; some lists are empty and some missing."""
    events = parquet_tables(spark, sf_dir, "events")["events"]
    e = c("event_id")

    def post(i: int) -> Column:
        return F.struct(
            F.concat(F.lit("e"), e.cast("string"), F.lit(f"-{i}")).alias("id"),
            c("event_type").alias("title"),
            F.concat(F.lit("user "), c("user_id").cast("string")).alias("author"),
            F.lit("League").alias("subreddit"),
            F.concat(F.lit("/post/"), e.cast("string")).alias("url"),
            F.when(e % 3 != 0, c("props")).alias("selftext"),
            F.floor("value").cast("long").alias("score"),
            c("value").alias("upvote_ratio"),
            (e % 100 + i).alias("num_comments"),
            F.when(e % 4 != 0, F.lit(1704067200) + e * 60).alias("created_utc"),
        )

    data = F.when(e % 10 == 0, F.filter(F.array(post(0)), lambda p: F.lit(False))).when(
        e % 10 != 5, F.array(post(0), post(1))
    )
    fetched_at = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")
    )
    response = F.to_json(F.struct(data.alias("data"), fetched_at.alias("fetched_at")))
    return events.select(response.alias("response"))
