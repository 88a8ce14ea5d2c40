"""DuckDB twins of the registered queries, over the same parquet tables.

Dates and timestamps are compared as text, so that the two engines' client types do not matter.
Ratios are rounded as decimal numbers: DuckDB rounds a double by way of a binary product, which
takes 97 / 40 = 2.425 to 2.42.
"""

from __future__ import annotations

RAW_MATCHES = """
raw_matches AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
           CAST(o_orderdate AS DATE) AS match_date,
           CASE year(o_orderdate) WHEN 1995 THEN '2007/08' WHEN 1996 THEN '2009/10'
                WHEN 1997 THEN '2020/21' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS season,
           n1.n_name AS team1, n2.n_name AS team2,
           'Ground ' || (o_custkey % 17) AS venue,
           CASE o_orderkey % 3 WHEN 1 THEN 'City ' || (o_custkey % 17)
                WHEN 2 THEN 'Town ' || (o_custkey % 17) END AS city,
           CASE WHEN o_orderkey % 2 = 0 THEN n1.n_name ELSE n2.n_name END AS toss_winner,
           CASE WHEN o_orderkey % 4 < 2 THEN 'bat' ELSE 'field' END AS toss_decision,
           CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 3 = 0 THEN n1.n_name
                ELSE n2.n_name END AS match_winner,
           CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 90 + 1 AS INTEGER) END
               AS win_by_runs,
           CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey % 10 + 1 AS INTEGER) END
               AS win_by_wickets,
           'Player ' || (o_custkey % 60) AS player_of_match,
           'League' AS event_name,
           CASE WHEN o_orderkey % 97 = 0 THEN 'Final' WHEN o_orderkey % 89 = 0 THEN 'Qualifier' END
               AS event_stage,
           CAST(o_orderkey % 70 + 1 AS INTEGER) AS event_match_number,
           o_orderdate AS loaded_at
    FROM orders
    JOIN nation n1 ON n1.n_nationkey = o_custkey % 10
    JOIN nation n2 ON n2.n_nationkey = (o_custkey + 1 + o_orderkey % 9) % 10)
"""

RAW_DELIVERIES = """
balls AS (
    SELECT l.*, m.team1, m.team2,
           CAST(l_quantity AS INTEGER) % 7 AS bat, l_returnflag = 'N' AS extra,
           l_returnflag = 'R' AND l_orderkey % 5 = 0 AND l_partkey % 60 >= 10 AS wicket
    FROM lineitem l JOIN raw_matches m ON m.match_id = CAST(l_orderkey AS VARCHAR)),
raw_deliveries AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS match_id,
           CAST(1 + l_linenumber % 2 AS INTEGER) AS inning_number,
           CASE WHEN l_linenumber % 2 = 0 THEN team1 ELSE team2 END AS batting_team,
           CAST(l_linenumber - 1 AS INTEGER) AS over_number,
           CAST(l_partkey % 6 AS INTEGER) AS ball_number,
           'Player ' || l_suppkey AS batter,
           'Player ' || (l_partkey % 60) AS bowler,
           'Player ' || ((l_suppkey + 1) % 60) AS non_striker,
           bat AS runs_batter,
           CASE WHEN extra THEN 1 ELSE 0 END AS runs_extras,
           bat + CASE WHEN extra THEN 1 ELSE 0 END AS runs_total,
           CASE WHEN extra AND l_linestatus = 'F' THEN 'wides' WHEN extra THEN 'noballs' END
               AS extras_type,
           wicket AS is_wicket,
           CASE WHEN NOT wicket THEN NULL WHEN l_suppkey % 3 = 0 THEN 'caught'
                WHEN l_suppkey % 3 = 1 THEN 'bowled' ELSE 'run out' END AS wicket_kind,
           CASE WHEN wicket THEN 'Player ' || l_suppkey END AS player_out,
           CASE WHEN wicket AND l_suppkey % 3 = 0 THEN 'Player ' || (l_partkey % 60) END AS fielder,
           l_shipdate AS loaded_at
    FROM balls)
"""

RAW_POSTS = """
scores AS (
    SELECT *, CASE WHEN event_id % 50 = 0 THEN NULL
                   ELSE CAST(event_id * 7919 % 2001 - 1000 AS DOUBLE) / 1000.0 END AS compound
    FROM events),
raw_posts AS (
    SELECT 'load-' || strftime(ts, '%Y%m%d') AS pipeline_load_id,
           ts AS pipeline_loaded_at,
           'p' || (event_id % 400) AS post_id,
           event_type AS post_title, 'user ' || user_id AS post_author, 'League' AS subreddit,
           '/post/' || (event_id % 400) AS post_url, props AS post_body,
           CAST(floor(value) AS BIGINT) AS score,
           CAST(event_id % 100 AS DOUBLE) / 100.0 AS upvote_ratio,
           event_id % 100 AS num_comments,
           CAST(DATE '2024-01-01' + CAST(event_id % 400 % 30 AS INTEGER) AS TIMESTAMP) AS created_utc,
           ts AS fetched_at, compound AS sentiment_compound,
           CASE WHEN compound > 0 THEN compound ELSE 0.0 END AS sentiment_positive,
           CASE WHEN compound < 0 THEN -compound ELSE 0.0 END AS sentiment_negative,
           1.0 - abs(coalesce(compound, 0.0)) AS sentiment_neutral,
           CASE WHEN compound >= 0.05 THEN 'POSITIVE' WHEN compound <= -0.05 THEN 'NEGATIVE'
                ELSE 'NEUTRAL' END AS sentiment_label
    FROM scores)
"""

STG_MATCHES = """
stg_matches AS (
    SELECT * REPLACE (CASE season WHEN '2007/08' THEN '2008' WHEN '2009/10' THEN '2010'
                                  ELSE season END AS season),
           CASE WHEN win_by_runs IS NOT NULL THEN 'runs'
                WHEN win_by_wickets IS NOT NULL THEN 'wickets' ELSE 'tie/no result' END
               AS result_type
    FROM raw_matches)
"""

STG_DELIVERIES = """
stg_deliveries AS (
    SELECT *, runs_batter >= 4 AS is_boundary, runs_batter = 6 AS is_six, runs_batter = 4 AS is_four
    FROM raw_deliveries)
"""

LATEST_POST = """
latest_post AS (
    SELECT post_id, post_title AS title, post_author AS author, post_body AS body,
           score AS reddit_score, num_comments, created_utc AS post_created_at, fetched_at,
           pipeline_loaded_at AS loaded_at, sentiment_compound AS sentiment_score, sentiment_label,
           sentiment_positive AS sentiment_pos, sentiment_negative AS sentiment_neg,
           sentiment_neutral AS sentiment_neu, CAST(created_utc AS DATE) AS post_date
    FROM raw_posts
    QUALIFY row_number() OVER (PARTITION BY post_id
                               ORDER BY fetched_at DESC, pipeline_load_id DESC) = 1)
"""

DIMENSIONS = """
dim_teams AS (
    SELECT row_number() OVER (ORDER BY team_name) AS team_id, team_name
    FROM (SELECT team1 AS team_name FROM stg_matches UNION SELECT team2 FROM stg_matches)
    WHERE team_name IS NOT NULL),
dim_venues AS (
    SELECT row_number() OVER (ORDER BY venue) AS venue_id, venue, city
    FROM (SELECT venue, max(city) AS city FROM stg_matches WHERE venue IS NOT NULL GROUP BY venue)),
dim_players AS (
    SELECT row_number() OVER (ORDER BY player_name) AS player_id, player_name
    FROM (SELECT batter AS player_name FROM stg_deliveries
          UNION SELECT bowler FROM stg_deliveries)
    WHERE player_name IS NOT NULL)
"""

FACTS = """
fct_match_results AS (
    SELECT m.* EXCLUDE (loaded_at), a.team_id AS team1_id, b.team_id AS team2_id,
           w.team_id AS winner_id, v.venue_id
    FROM stg_matches m
    LEFT JOIN dim_teams a ON a.team_name = m.team1
    LEFT JOIN dim_teams b ON b.team_name = m.team2
    LEFT JOIN dim_teams w ON w.team_name = m.match_winner
    LEFT JOIN dim_venues v ON v.venue = m.venue),
fct_deliveries AS (
    SELECT d.* EXCLUDE (loaded_at), p.player_id AS batter_id, q.player_id AS bowler_id,
           m.season, m.match_date, m.venue, m.result_type
    FROM stg_deliveries d
    LEFT JOIN dim_players p ON p.player_name = d.batter
    LEFT JOIN dim_players q ON q.player_name = d.bowler
    LEFT JOIN fct_match_results m ON m.match_id = d.match_id)
"""

MARTS = """
innings AS (
    SELECT d.batter, m.season, d.match_id, d.inning_number,
           CAST(sum(d.runs_batter) AS BIGINT) AS runs, count(*) AS balls,
           count(*) FILTER (WHERE d.is_four) AS fours, count(*) FILTER (WHERE d.is_six) AS sixes
    FROM fct_deliveries d JOIN fct_match_results m ON m.match_id = d.match_id
    GROUP BY ALL),
batting_stats AS (
    SELECT batter AS player_name, season, count(*) AS innings_played,
           CAST(sum(runs) AS BIGINT) AS total_runs, CAST(sum(balls) AS BIGINT) AS balls_faced,
           round((CAST(sum(runs) AS DOUBLE) / nullif(CAST(sum(balls) AS DOUBLE), 0) * 100)::DECIMAL(38, 10), 2)::DOUBLE
               AS strike_rate,
           round((CAST(sum(runs) AS DOUBLE) / count(*))::DECIMAL(38, 10), 2)::DOUBLE AS average,
           CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes,
           CAST(sum(fours + sixes) AS BIGINT) AS boundary_count, max(runs) AS highest_score
    FROM innings GROUP BY batter, season),
spells AS (
    SELECT d.bowler, m.season, d.match_id, count(*) AS balls,
           CAST(sum(d.runs_total) AS BIGINT) AS runs, count(*) FILTER (WHERE d.is_wicket) AS wickets
    FROM fct_deliveries d JOIN fct_match_results m ON m.match_id = d.match_id
    GROUP BY ALL),
best_figures AS (
    SELECT DISTINCT bowler, season,
           first_value(wickets || '/' || runs) OVER (
               PARTITION BY bowler, season ORDER BY wickets DESC, runs) AS best_bowling_figures
    FROM spells),
bowling_sums AS (
    SELECT bowler, season, CAST(sum(balls) AS BIGINT) AS balls_bowled,
           CAST(sum(runs) AS BIGINT) AS runs_conceded, CAST(sum(wickets) AS BIGINT) AS total_wickets,
           round((CAST(sum(balls) AS DOUBLE) / 6.0)::DECIMAL(38, 10), 1)::DOUBLE AS overs_bowled
    FROM spells GROUP BY bowler, season),
bowling_stats AS (
    SELECT s.bowler AS player_name, s.season, balls_bowled, overs_bowled, runs_conceded,
           total_wickets,
           round((CAST(runs_conceded AS DOUBLE) / nullif(overs_bowled, 0))::DECIMAL(38, 10), 2)::DOUBLE AS economy_rate,
           round((CAST(runs_conceded AS DOUBLE) / CAST(nullif(total_wickets, 0) AS DOUBLE))::DECIMAL(38, 10), 2)::DOUBLE
               AS bowling_average,
           round((CAST(balls_bowled AS DOUBLE) / CAST(nullif(total_wickets, 0) AS DOUBLE))::DECIMAL(38, 10), 2)::DOUBLE
               AS bowling_strike_rate,
           best_bowling_figures
    FROM bowling_sums s JOIN best_figures f ON f.bowler = s.bowler AND f.season = s.season),
team_matches AS (
    SELECT season, team1 AS team_name, match_id, match_winner, toss_winner FROM fct_match_results
    UNION ALL
    SELECT season, team2, match_id, match_winner, toss_winner FROM fct_match_results),
team_runs AS (
    SELECT m.season, d.batting_team, d.match_id, CAST(sum(d.runs_total) AS BIGINT) AS match_runs
    FROM fct_deliveries d JOIN fct_match_results m ON m.match_id = d.match_id
    GROUP BY ALL),
team_sums AS (
    SELECT t.team_name, t.season, count(*) AS played,
           count(*) FILTER (WHERE match_winner = team_name) AS won,
           count(*) FILTER (WHERE toss_winner = team_name) AS tosses,
           count(*) FILTER (WHERE toss_winner = team_name AND match_winner = team_name) AS both_won,
           round((avg(match_runs))::DECIMAL(38, 10), 2)::DOUBLE AS avg_runs_per_match
    FROM team_matches t
    LEFT JOIN team_runs r
      ON r.batting_team = t.team_name AND r.match_id = t.match_id AND r.season = t.season
    GROUP BY t.team_name, t.season),
team_performance AS (
    SELECT team_name, season, played AS matches_played, won AS matches_won,
           round((CAST(won AS DOUBLE) / CAST(played AS DOUBLE) * 100)::DECIMAL(38, 10), 2)::DOUBLE AS win_rate,
           tosses AS toss_wins,
           round((CAST(both_won AS DOUBLE) / CAST(nullif(tosses, 0) AS DOUBLE) * 100)::DECIMAL(38, 10), 2)::DOUBLE
               AS toss_win_to_match_win_rate,
           avg_runs_per_match
    FROM team_sums),
titles_won AS (
    SELECT match_winner AS team_name, count(*) AS titles_won, min(season) AS first_title_season,
           max(season) AS last_title_season,
           string_agg(season, ', ' ORDER BY season) AS title_seasons
    FROM fct_match_results WHERE event_stage = 'Final' AND match_winner IS NOT NULL
    GROUP BY match_winner),
career_bat AS (
    SELECT player_name, count(DISTINCT season) AS seasons_played,
           CAST(sum(innings_played) AS BIGINT) AS total_innings,
           CAST(sum(total_runs) AS BIGINT) AS career_runs,
           CAST(sum(balls_faced) AS BIGINT) AS career_balls_faced,
           CAST(sum(fours) AS BIGINT) AS career_fours, CAST(sum(sixes) AS BIGINT) AS career_sixes,
           max(highest_score) AS highest_score
    FROM batting_stats GROUP BY player_name),
career_bowl AS (
    SELECT player_name, CAST(sum(total_wickets) AS BIGINT) AS wickets,
           CAST(sum(runs_conceded) AS DOUBLE) AS conceded, round((sum(overs_bowled))::DECIMAL(38, 10), 1)::DOUBLE AS overs
    FROM bowling_stats GROUP BY player_name),
player_career AS (
    SELECT b.player_name, seasons_played, total_innings, career_runs, career_balls_faced,
           round((career_runs * CAST(100 AS DOUBLE) / CAST(career_balls_faced AS DOUBLE))::DECIMAL(38, 10), 2)::DOUBLE
               AS career_strike_rate,
           round((CAST(career_runs AS DOUBLE) / CAST(total_innings AS DOUBLE))::DECIMAL(38, 10), 2)::DOUBLE AS career_average,
           career_fours, career_sixes, highest_score,
           coalesce(wickets, 0) AS career_wickets,
           round((conceded / nullif(overs, 0))::DECIMAL(38, 10), 2)::DOUBLE AS career_economy,
           round((conceded / CAST(nullif(wickets, 0) AS DOUBLE))::DECIMAL(38, 10), 2)::DOUBLE AS career_bowling_average
    FROM career_bat b LEFT JOIN career_bowl w ON w.player_name = b.player_name)
"""

DAILY = """
daily_sums AS (
    SELECT post_date, count(*) AS total_posts, round((avg(sentiment_score))::DECIMAL(38, 10), 4)::DOUBLE AS avg_sentiment_score,
           count(*) FILTER (WHERE sentiment_label = 'POSITIVE') AS positive_posts,
           count(*) FILTER (WHERE sentiment_label = 'NEGATIVE') AS negative_posts,
           count(*) FILTER (WHERE sentiment_label = 'NEUTRAL') AS neutral_posts,
           max(sentiment_score) AS max_sentiment_score, min(sentiment_score) AS min_sentiment_score
    FROM latest_post GROUP BY post_date),
daily_sentiment AS (
    SELECT *, round((CAST(positive_posts AS DOUBLE) / CAST(total_posts AS DOUBLE) * 100)::DECIMAL(38, 10), 2)::DOUBLE
                  AS positive_pct,
           round((CAST(negative_posts AS DOUBLE) / CAST(total_posts AS DOUBLE) * 100)::DECIMAL(38, 10), 2)::DOUBLE
               AS negative_pct
    FROM daily_sums)
"""

MATCH_TABLES = ",".join([RAW_MATCHES, RAW_DELIVERIES, STG_MATCHES, STG_DELIVERIES])
MATCH_MODELS = ",".join([MATCH_TABLES, DIMENSIONS, FACTS, MARTS])
POST_MODELS = ",".join([RAW_POSTS, LATEST_POST, DAILY])


def _match(select: str) -> str:
    return f"WITH {MATCH_MODELS} {select}"


def _post(select: str) -> str:
    return f"WITH {POST_MODELS} {select}"


DATE_AS_TEXT = "* REPLACE (CAST(match_date AS VARCHAR) AS match_date)"
MATCH_AS_TEXT = (
    "* REPLACE (CAST(match_date AS VARCHAR) AS match_date, CAST(loaded_at AS VARCHAR) AS loaded_at)"
)
BALL_AS_TEXT = "* REPLACE (CAST(loaded_at AS VARCHAR) AS loaded_at)"
POST_AS_TEXT = """* REPLACE (CAST(post_created_at AS VARCHAR) AS post_created_at,
    CAST(fetched_at AS VARCHAR) AS fetched_at, CAST(loaded_at AS VARCHAR) AS loaded_at,
    CAST(post_date AS VARCHAR) AS post_date)"""
DAY_AS_TEXT = "* REPLACE (CAST(post_date AS VARCHAR) AS post_date)"

# The checks, stated once more for the oracle: model -> (not null, unique, accepted).
CHECKS: dict[str, tuple[str, str, dict[str, list[str]]]] = {
    "stg_matches": (
        "match_id match_date season team1 team2 toss_winner toss_decision result_type",
        "match_id",
        {"toss_decision": ["bat", "field"], "result_type": ["runs", "wickets", "tie/no result"]},
    ),
    "stg_deliveries": (
        "match_id inning_number batting_team over_number ball_number batter bowler runs_batter "
        "runs_extras runs_total is_wicket is_boundary is_six is_four",
        "",
        {
            "extras_type": ["wides", "noballs", "byes", "legbyes", "penalty"],
            "wicket_kind": [
                "caught", "bowled", "run out", "lbw", "stumped", "hit wicket",
                "obstructing the field", "timed out", "caught and bowled", "retired hurt",
                "retired out", "handled the ball",
            ],
        },
    ),
    "dim_teams": ("team_id team_name", "team_id team_name", {}),
    "dim_venues": ("venue_id venue", "venue_id venue", {}),
    "dim_players": ("player_id player_name", "player_id player_name", {}),
    "fct_match_results": (
        "match_id match_date season team1 team2 toss_winner toss_decision result_type team1_id "
        "team2_id venue_id",
        "match_id",
        {},
    ),
    "fct_deliveries": (
        "match_id inning_number over_number ball_number batter bowler batter_id bowler_id", "", {},
    ),
    "batting_stats": ("player_name season innings_played total_runs balls_faced", "", {}),
    "bowling_stats": (
        "player_name season balls_bowled runs_conceded total_wickets", "", {},
    ),
    "team_performance": ("team_name season matches_played matches_won", "", {}),
    "titles_won": ("team_name titles_won", "team_name", {}),
    "player_career": ("player_name career_runs", "player_name", {}),
    "raw_posts": ("post_id", "", {}),
    "latest_post": (
        "post_id", "post_id", {"sentiment_label": ["POSITIVE", "NEGATIVE", "NEUTRAL"]},
    ),
    "daily_sentiment": ("post_date total_posts", "post_date", {}),
}


def _check(model: str, column: str, check: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(n AS BIGINT) AS failures, n = 0 AS passed FROM ({failures})"
    )


def _null_check(model: str, column: str) -> str:
    count = f"SELECT count(*) AS n FROM {model} WHERE {column} IS NULL"
    return _check(model, column, "not_null", count)


def _unique_check(model: str, column: str) -> str:
    repeated = (
        f"SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} "
        "HAVING count(*) > 1"
    )
    return _check(model, column, "unique", f"SELECT count(*) AS n FROM ({repeated})")


def _accepted_check(model: str, column: str, values: list[str], where: str = "true") -> str:
    allowed = ", ".join(f"'{v}'" for v in values)
    count = f"SELECT count(*) AS n FROM {model} WHERE {column} NOT IN ({allowed}) AND {where}"
    return _check(model, column, "accepted_values", count)


def _all_checks() -> str:
    parts = []
    for model, (not_null, unique, accepted) in CHECKS.items():
        parts += [_null_check(model, c) for c in not_null.split()]
        parts += [_unique_check(model, c) for c in unique.split()]
        parts += [_accepted_check(model, c, v) for c, v in accepted.items()]
    models = ",".join([MATCH_MODELS, POST_MODELS]).replace(" AS (", " AS MATERIALIZED (", 1)
    return f"WITH {models} " + " UNION ALL ".join(parts)


STAGED_COLUMNS = {
    "stg_matches": "match_id match_date season team1 team2 venue city toss_winner toss_decision "
    "match_winner win_by_runs win_by_wickets player_of_match event_name event_stage "
    "event_match_number result_type loaded_at",
    "stg_deliveries": "match_id inning_number batting_team over_number ball_number batter bowler "
    "non_striker runs_batter runs_extras runs_total extras_type is_wicket wicket_kind player_out "
    "fielder is_boundary is_six is_four loaded_at",
}

# Word lists of the text queries; the Spark side reads these too. Valences add up exactly.
LEXICON = {
    "that": 1.5, "with": -0.75, "this": 2.0, "from": -1.25, "the": 0.5, "and": -0.25, "of": 0.25,
    "is": 1.0, "on": -2.0, "re": -0.5, "le": 0.75, "les": -1.5, "la": 1.25, "der": -1.0, "die": 0.5,
    "und": 1.75, "el": -0.25, "los": 2.25, "que": -1.75, "de": 0.25, "en": -0.5, "er": 0.5,
}
INTENSIFIERS = ["th", "in", "by", "au", "un"]
DAMPENERS = ["for", "du", "ein"]
NEGATIONS = ["it", "are", "des", "pas", "il"]
CONTRAST = "or"
PAIR_DAMPENERS = [("ha", "was"), ("be", "thth"), ("das", "den")]
NEVER, NEVER_WITH = "it", ["as", "to", "le"]
WITHOUT, WITHOUT_WITH = "are", "an"
LEAST, LEAST_WITHOUT = "ed", ["that", "ou", "in"]
NO, NO_WITH = "is", ["and", "that"]

_LEXICON_ROWS = ", ".join(f"('{t}', CAST({v} AS DOUBLE))" for t, v in LEXICON.items())
_PUNCT = "^[[:punct:]]+|[[:punct:]]+$"

WORDS = rf"""
lexicon(token, valence) AS (VALUES {_LEXICON_ROWS}),
texts AS (
    SELECT doc_id, regexp_replace(text, '^[\s\x0B\p{{Z}}]+|[\s\x0B\p{{Z}}]+$', '', 'g') AS t
    FROM documents),
bare AS (
    SELECT doc_id, t, list_filter(list_transform(
        string_split_regex(t, '[\s\x0B\p{{Z}}]+'),
        lambda x: CASE WHEN length(regexp_replace(x, '{_PUNCT}', '', 'g')) <= 2 THEN x
                       ELSE regexp_replace(x, '{_PUNCT}', '', 'g') END),
        lambda x: x <> '') AS ws
    FROM texts)
"""

SCORES = """
sums AS (
    SELECT doc_id, max(emphasis) AS e, sum(v) AS s, coalesce(sum(v + 1) FILTER (v > 0), 0.0) AS up,
           coalesce(sum(v - 1) FILTER (v < 0), 0.0) AS down, count(*) FILTER (v = 0) AS flat
    FROM valued GROUP BY doc_id),
masses AS (
    SELECT doc_id, s + sign(s) * e AS s, CAST(flat AS DOUBLE) AS flat,
           up + CASE WHEN up + down > 0 THEN e ELSE 0.0 END AS up,
           abs(down - CASE WHEN up + down < 0 THEN e ELSE 0.0 END) AS down
    FROM sums),
scored AS (
    SELECT doc_id, round(s / sqrt(s * s + 15.0), 4) AS sentiment_compound,
           round(up / (up + down + flat), 3) AS sentiment_positive,
           round(down / (up + down + flat), 3) AS sentiment_negative,
           round(flat / (up + down + flat), 3) AS sentiment_neutral
    FROM masses)
SELECT d.doc_id, sentiment_compound, sentiment_positive, sentiment_negative, sentiment_neutral,
       CASE WHEN sentiment_compound >= 0.05 THEN 'POSITIVE'
            WHEN sentiment_compound <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment_label
FROM documents d LEFT JOIN scored s ON s.doc_id = d.doc_id
"""

TEXT_SENTIMENT = f"""
WITH {WORDS},
words AS (SELECT doc_id, unnest(ws) AS w FROM bare),
valued AS (
    SELECT doc_id, 0.0 AS emphasis, coalesce(valence, CAST(0 AS DOUBLE)) AS v
    FROM words LEFT JOIN lexicon ON token = lower(w)),
{SCORES}
"""


def _in(word: str, words: list[str]) -> str:
    return f"coalesce(lower({word}) IN ({', '.join(repr(w) for w in words)}), false)"


def _upper(word: str) -> str:
    return f"coalesce({word} = upper({word}) AND {word} <> lower({word}), false)"


def _amount(word: str, decay: float) -> str:
    return (
        f"coalesce((CASE WHEN {_in(word, INTENSIFIERS)} THEN 0.293::DOUBLE"
        f" WHEN {_in(word, DAMPENERS)} THEN -0.293::DOUBLE END"
        f" + CASE WHEN mixed AND {_upper(word)} THEN 0.733::DOUBLE ELSE 0.0::DOUBLE END)"
        f" * {decay}::DOUBLE, 0.0::DOUBLE)"
    )


def _negated(word: str) -> str:
    return (
        f"CASE WHEN {_in(word, NEGATIONS)} OR coalesce(contains(lower({word}), 'n''t'), false)"
        " THEN -0.74::DOUBLE ELSE 1.0::DOUBLE END"
    )


def _factor(k: int) -> str:
    """What the k-th word before does to the valence so far."""
    if k == 1:
        return _negated("b1")
    praise = f"{_in(f'b{k}', [NEVER])} AND {_in(f'b{k - 1}', NEVER_WITH)}"
    if k == 3:
        praise = f"({praise}) OR {_in('b1', NEVER_WITH)}"
    doubt = " OR ".join(_in(f"b{j}", [WITHOUT_WITH]) for j in range(1, k))
    return (
        f"CASE WHEN {praise} THEN 1.25::DOUBLE WHEN {_in(f'b{k}', [WITHOUT])} AND ({doubt})"
        f" THEN 1.0::DOUBLE ELSE {_negated(f'b{k}')} END"
    )


def _pairs() -> str:
    def dampens(far: str, near: str) -> str:
        found = " OR ".join(f"({_in(far, [x])} AND {_in(near, [y])})" for x, y in PAIR_DAMPENERS)
        return f"CASE WHEN {found} THEN -0.293::DOUBLE ELSE 0.0::DOUBLE END"

    return f"({dampens('b3', 'b2')} + {dampens('b2', 'b1')})"


def _known(word: str) -> str:
    return f"coalesce(lower({word}) IN (SELECT token FROM lexicon), false)"


def _step(k: int, decay: float) -> str:
    value = f"(v{k - 1} + sign(v{k - 1}) * {_amount(f'b{k}', decay)}) * {_factor(k)}"
    if k == 3:
        value = f"{value} + {_pairs()}"
    return f"CASE WHEN b{k} IS NOT NULL AND NOT {_known(f'b{k}')} THEN {value} ELSE v{k - 1} END AS v{k}"


_MARKS = "CAST(length(t) - length(replace(t, '{}', '')) AS DOUBLE)"
_ASKED = _MARKS.format("?")

TEXT_SENTIMENT_RULES = f"""
WITH {WORDS},
words AS (
    SELECT doc_id, t, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i, len(ws) AS n,
           len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x))) AS uppers,
           list_position(list_transform(ws, lambda x: lower(x)), '{CONTRAST}') - 1 AS turn
    FROM bare),
context AS (
    SELECT doc_id, w, i, coalesce(turn, -1) AS turn, uppers > 0 AND uppers < n AS mixed,
           least({_MARKS.format('!')}, 4.0) * 0.292
               + CASE WHEN {_ASKED} <= 1 THEN 0.0 WHEN {_ASKED} <= 3 THEN {_ASKED} * 0.18
                      ELSE 0.96 END AS emphasis,
           lag(w, 1) OVER (PARTITION BY doc_id ORDER BY i) AS b1,
           lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS b2,
           lag(w, 3) OVER (PARTITION BY doc_id ORDER BY i) AS b3,
           lead(w, 1) OVER (PARTITION BY doc_id ORDER BY i) AS after
    FROM words),
begun AS (
    SELECT *, CASE
        WHEN {_in('b1', [NO])} OR {_in('b2', [NO])} OR ({_in('b3', [NO])} AND {_in('b1', NO_WITH)})
            THEN valence * -0.74::DOUBLE
        WHEN {_in('w', [NO])} AND {_known('after')} THEN 0.0::DOUBLE ELSE valence END AS base
    FROM context LEFT JOIN lexicon ON token = lower(w)),
step0 AS (
    SELECT *, base + CASE WHEN NOT (mixed AND {_upper('w')}) THEN 0.0::DOUBLE
                          WHEN base > 0 THEN 0.733::DOUBLE ELSE -0.733::DOUBLE END AS v0 FROM begun),
step1 AS (SELECT *, {_step(1, 1.0)} FROM step0),
step2 AS (SELECT *, {_step(2, 0.95)} FROM step1),
step3 AS (SELECT *, {_step(3, 0.9)} FROM step2),
valued AS (
    SELECT doc_id, CAST(emphasis AS DOUBLE) AS emphasis,
           coalesce(CASE
             WHEN {_in('w', INTENSIFIERS + DAMPENERS)}
                  OR ({_in('w', [PAIR_DAMPENERS[0][0]])} AND {_in('after', [PAIR_DAMPENERS[0][1]])})
             THEN 0.0 ELSE v3
             * CASE WHEN {_in('b1', [LEAST])} AND NOT {_known('b1')} AND NOT {_in('b2', LEAST_WITHOUT)}
                    THEN -0.74::DOUBLE ELSE 1.0::DOUBLE END
             * CASE WHEN turn < 0 THEN 1.0 WHEN i < turn THEN 0.5 WHEN i > turn THEN 1.5
                    ELSE 1.0 END END, CAST(0 AS DOUBLE)) AS v
    FROM step3),
{SCORES}
"""

# Each page is a post with its address as title and its source as body.
POST_SENTIMENT = (
    TEXT_SENTIMENT.replace(
        "FROM documents)",
        "FROM (SELECT page_id AS doc_id, url || ' ' || html AS text FROM pages))",
    )
    .replace("FROM documents d", "FROM (SELECT page_id AS doc_id, url, html FROM pages) d")
    .replace("SELECT d.doc_id,", "SELECT d.doc_id AS page_id,")
)

MATCH_DOCS = f"""
WITH {RAW_MATCHES},
docs AS (
    SELECT *, CAST(match_id AS BIGINT) AS k FROM raw_matches
    WHERE CAST(match_id AS BIGINT) % 11 <> 0 AND CAST(match_id AS BIGINT) % 13 <> 0)
"""

MATCH_HEADERS = f"""
{MATCH_DOCS}
SELECT match_id, CAST(match_date AS VARCHAR) AS match_date,
       CASE WHEN k % 2 = 0 THEN CAST(year(match_date) AS VARCHAR) WHEN k % 7 = 0 THEN ''
            ELSE season END AS season,
       team1, CASE WHEN k % 9 = 0 THEN NULL ELSE team2 END AS team2, venue, city, toss_winner,
       toss_decision, match_winner, win_by_runs, win_by_wickets,
       CASE WHEN k % 4 = 0 THEN NULL ELSE player_of_match END AS player_of_match,
       event_name, event_stage, event_match_number
FROM docs
"""

DOCUMENT_BALLS = f"""
{MATCH_DOCS}
SELECT match_id, 1 AS inning_number, team1 AS batting_team, 0 AS over_number, 0 AS ball_number,
       player_of_match AS batter, 'Bowler ' || (k % 50) AS bowler, 'Player 0' AS non_striker,
       CAST(k % 7 AS INTEGER) AS runs_batter, CAST(k % 2 AS INTEGER) AS runs_extras,
       CAST(k % 7 + k % 2 AS INTEGER) AS runs_total,
       CASE WHEN k % 2 = 1 THEN 'noballs' END AS extras_type, false AS is_wicket,
       CAST(NULL AS VARCHAR) AS wicket_kind, CAST(NULL AS VARCHAR) AS player_out,
       CAST(NULL AS VARCHAR) AS fielder
FROM docs
UNION ALL
SELECT match_id, 1, team1, 0, 1, player_of_match, 'Bowler ' || (k % 50), NULL, 0, 0, 0, NULL,
       k % 3 = 0, CASE WHEN k % 3 = 0 THEN 'caught' END,
       CASE WHEN k % 3 = 0 THEN player_of_match END,
       CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 'Fielder ' || (k % 40) END
FROM docs
UNION ALL
SELECT match_id, 3, team2, CAST(k % 20 AS INTEGER), 0, player_of_match, 'Bowler ' || (k % 50), NULL,
       CAST(k % 5 AS INTEGER), 0, CAST(k % 5 AS INTEGER), NULL, false, NULL, NULL, NULL
FROM docs WHERE k % 3 <> 1
"""

REJECTED_DOCS = """
SELECT CAST(o_orderkey AS VARCHAR) AS match_id FROM orders
WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0
"""

POST_RECORDS = """
WITH posts AS (
    SELECT event_id, unnest([0, 1]) AS i, event_type, user_id, value, props, ts FROM events
    WHERE event_id % 10 <> 0 AND event_id % 10 <> 5)
SELECT 'e' || event_id || '-' || i AS post_id, event_type AS post_title,
       'user ' || user_id AS post_author, 'League' AS subreddit, '/post/' || event_id AS post_url,
       CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS post_body,
       CAST(floor(value) AS BIGINT) AS score, CAST(value AS DOUBLE) AS upvote_ratio,
       event_id % 100 + i AS num_comments,
       CAST(CASE WHEN event_id % 4 = 0 THEN TIMESTAMP '1970-01-01'
                 ELSE TIMESTAMP '2024-01-01' + INTERVAL (event_id * 60) SECOND END AS VARCHAR)
           AS created_utc,
       CAST(ts AS VARCHAR) AS fetched_at
FROM posts
"""

SQL: dict[str, str] = {
    "stg_matches": _match(f"SELECT {MATCH_AS_TEXT} FROM stg_matches"),
    "stg_deliveries": _match(f"SELECT {BALL_AS_TEXT} FROM stg_deliveries"),
    "latest_post": _post(f"SELECT {POST_AS_TEXT} FROM latest_post"),
    "dim_teams": _match("SELECT * FROM dim_teams"),
    "dim_venues": _match("SELECT * FROM dim_venues"),
    "dim_players": _match("SELECT * FROM dim_players"),
    "surrogate_key_by_range": """
        SELECT row_number() OVER (ORDER BY match_id) AS match_number, match_id
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS match_id FROM orders)""",
    "fct_match_results": _match(f"SELECT {DATE_AS_TEXT} FROM fct_match_results"),
    "fct_deliveries": _match(f"SELECT {DATE_AS_TEXT} FROM fct_deliveries"),
    "team_matches": _match("SELECT * FROM team_matches"),
    "best_figures": _match("SELECT * FROM best_figures"),
    "batting_stats": _match("SELECT * FROM batting_stats"),
    "bowling_stats": _match("SELECT * FROM bowling_stats"),
    "team_performance": _match("SELECT * FROM team_performance"),
    "titles_won": _match("SELECT * FROM titles_won ORDER BY titles_won DESC"),
    "player_career": _match("SELECT * FROM player_career ORDER BY career_runs DESC"),
    "daily_sentiment": _post(f"SELECT {DAY_AS_TEXT} FROM daily_sentiment ORDER BY post_date DESC"),
    "insert_new_keys": _match(
        """SELECT match_id, CAST(match_date AS VARCHAR) AS match_date, season, team1, team2, city,
                  CASE WHEN match_date < DATE '1998-01-01' THEN venue
                       ELSE venue || ' (new)' END AS venue
           FROM raw_matches"""
    ),
    "replace_by_key": f"""
        WITH {MATCH_TABLES},
        dated AS (
            SELECT d.match_id, inning_number, over_number, ball_number, batter, bowler, runs_batter,
                   runs_total, is_wicket, match_date
            FROM raw_deliveries d JOIN raw_matches m ON m.match_id = d.match_id),
        incoming AS (
            SELECT * FROM dated WHERE match_date >= DATE '1997-01-01' AND NOT is_wicket)
        SELECT * EXCLUDE (is_wicket, match_date), 'first load' AS load FROM dated
        WHERE match_id NOT IN (SELECT match_id FROM incoming)
        UNION ALL
        SELECT * EXCLUDE (is_wicket, match_date), 'reloaded' FROM incoming""",
    "incremental_append": _match(
        f"SELECT {DATE_AS_TEXT} FROM fct_deliveries WHERE match_date >= DATE '1999-01-01'"
    ),
    "not_in_with_nulls": _match(
        """SELECT 'with null' AS list, match_id FROM stg_matches WHERE match_winner NOT IN
               (SELECT match_winner FROM stg_matches WHERE event_stage = 'Qualifier')
           UNION ALL
           SELECT 'without null', match_id FROM stg_matches WHERE match_winner NOT IN
               (SELECT match_winner FROM stg_matches WHERE event_stage = 'Final' AND match_winner < 'I')
           UNION ALL
           SELECT 'empty', match_id FROM stg_matches WHERE match_winner NOT IN
               (SELECT match_winner FROM stg_matches WHERE FALSE)"""
    ),
    "upsert_by_key": """
        WITH log AS (
            SELECT event_type AS pipeline_name, 'user ' || user_id AS run_type,
                   ts < TIMESTAMP '2024-01-16' AS old, max(ts) AS last_run_at, count(*) AS runs
            FROM events GROUP BY ALL)
        SELECT pipeline_name, run_type,
               CAST(coalesce(max(last_run_at) FILTER (NOT old), max(last_run_at)) AS VARCHAR)
                   AS last_run_at,
               CASE WHEN count(*) FILTER (NOT old) > 0 THEN 'SUCCESS' ELSE 'STALE' END AS status,
               max(runs) FILTER (old) AS runs
        FROM log GROUP BY pipeline_name, run_type""",
    "unseen_files": """
        SELECT url AS file_name FROM pages
        WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE '%.com/%')""",
    "match_headers": MATCH_HEADERS,
    "document_balls": DOCUMENT_BALLS,
    "rejected_documents": REJECTED_DOCS,
    "post_records": POST_RECORDS,
    "land_batch": """
        SELECT strftime(ts, '%Y/%m/%d/%H') AS hour, count(*) AS posts, count(DISTINCT event_id % 400)
                   AS distinct_posts
        FROM events GROUP BY 1""",
    "audited_append": _post(
        """SELECT post_id, post_title, score, CAST(fetched_at AS VARCHAR) AS fetched_at,
                  sentiment_compound, sentiment_label,
                  'load-' || strftime(fetched_at, '%Y%m%d%H') AS pipeline_load_id,
                  'posts/raw/' || strftime(fetched_at, '%Y/%m/%d/%H') || '/posts_'
                      || strftime(fetched_at, '%Y%m%d_%H%M%S') || '.json' AS pipeline_batch_file
           FROM raw_posts"""
    ),
    "dq_not_null": _match(
        " UNION ALL ".join(
            _null_check(model, column)
            for model, columns in STAGED_COLUMNS.items()
            for column in columns.split()
        )
    ),
    "dq_unique": _match(
        " UNION ALL ".join(
            [
                _unique_check("stg_deliveries", "match_id"),
                _unique_check("stg_deliveries", "batter"),
                _unique_check("stg_matches", "match_id"),
                _unique_check("stg_matches", "city"),
            ]
        )
    ),
    "dq_accepted_values": _match(
        " UNION ALL ".join(
            [
                _accepted_check(
                    "stg_deliveries", "wicket_kind", ["caught"], "wicket_kind IS NOT NULL"
                ),
                _accepted_check("stg_deliveries", "extras_type", ["wides"], "is_wicket"),
                _accepted_check("stg_matches", "toss_decision", ["bat", "field"]),
                _accepted_check("stg_matches", "result_type", ["runs", "wickets"]),
            ]
        )
    ),
    "dq_report": _all_checks(),
    "text_sentiment": TEXT_SENTIMENT,
    "text_sentiment_rules": TEXT_SENTIMENT_RULES,
    "post_sentiment": POST_SENTIMENT,
    "landed_files": _post(
        """SELECT strftime(date_trunc('hour', fetched_at),
                           'posts/raw/%Y/%m/%d/%H/posts_%Y%m%d_%H%M%S.json') AS pipeline_batch_file,
                  count(*) AS appended, count(*) AS landed, count(DISTINCT post_id) AS landed_posts,
                  count(*) FILTER (WHERE sentiment_label = 'POSITIVE') AS landed_positive
           FROM raw_posts GROUP BY ALL"""
    ),
    "winners_with_hot_keys": _match(
        "SELECT match_id, team1_id, team2_id, winner_id, venue_id FROM fct_match_results"
    ),
    "merged_marts": _match(
        """SELECT player_name, season, b.total_runs, b.strike_rate, b.average, b.highest_score,
                  w.economy_rate, w.best_bowling_figures
           FROM batting_stats b FULL JOIN bowling_stats w USING (player_name, season)"""
    ),
    "seasons_played": _match(
        """SELECT batter, count(DISTINCT season) AS seasons
           FROM stg_deliveries JOIN stg_matches USING (match_id) GROUP BY batter"""
    ),
    "stream_latest_post": _post(
        """SELECT * EXCLUDE (loaded_at)
                  REPLACE (CAST(post_created_at AS VARCHAR) AS post_created_at,
                           CAST(fetched_at AS VARCHAR) AS fetched_at,
                           CAST(post_date AS VARCHAR) AS post_date)
           FROM latest_post"""
    ),
    "stream_daily_sentiment": _post(f"SELECT {DAY_AS_TEXT} FROM daily_sentiment"),
}

# The same rows, written to tables or by the stream and read back.
SQL["load_new_keys"] = SQL["insert_new_keys"]
SQL["load_replacing"] = SQL["replace_by_key"]
SQL["upsert_rows"] = SQL["upsert_by_key"]
SQL["stream_scored_posts"] = f"""
    SELECT CAST(page_id AS VARCHAR) AS post_id, sentiment_compound AS sentiment_score, sentiment_label,
           sentiment_positive AS sentiment_pos, sentiment_negative AS sentiment_neg,
           sentiment_neutral AS sentiment_neu
    FROM ({POST_SENTIMENT})"""
