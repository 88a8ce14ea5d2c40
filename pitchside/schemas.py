"""Raw table schemas and the nested match document schema (fixed values: names, types, order)."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _LONG, _REAL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_FLAG, _DATE, _TIME = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def _struct(required: tuple[str, ...] = (), **fields: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, name not in required) for name, kind in fields.items()]
    )


RAW_MATCHES = _struct(
    match_id=_TEXT,
    match_date=_DATE,
    season=_TEXT,
    team1=_TEXT,
    team2=_TEXT,
    venue=_TEXT,
    city=_TEXT,
    toss_winner=_TEXT,
    toss_decision=_TEXT,
    match_winner=_TEXT,
    win_by_runs=_INT,
    win_by_wickets=_INT,
    player_of_match=_TEXT,
    event_name=_TEXT,
    event_stage=_TEXT,
    event_match_number=_INT,
    loaded_at=_TIME,
)

RAW_DELIVERIES = _struct(
    match_id=_TEXT,
    inning_number=_INT,
    batting_team=_TEXT,
    over_number=_INT,
    ball_number=_INT,
    batter=_TEXT,
    bowler=_TEXT,
    non_striker=_TEXT,
    runs_batter=_INT,
    runs_extras=_INT,
    runs_total=_INT,
    extras_type=_TEXT,
    is_wicket=_FLAG,
    wicket_kind=_TEXT,
    player_out=_TEXT,
    fielder=_TEXT,
    loaded_at=_TIME,
)

RAW_POSTS = _struct(
    required=("pipeline_load_id", "pipeline_loaded_at", "post_id", "fetched_at"),
    pipeline_load_id=_TEXT,
    pipeline_loaded_at=_TIME,
    pipeline_batch_file=_TEXT,
    post_id=_TEXT,
    post_title=_TEXT,
    post_author=_TEXT,
    subreddit=_TEXT,
    post_url=_TEXT,
    post_body=_TEXT,
    score=_LONG,
    upvote_ratio=_REAL,
    num_comments=_LONG,
    created_utc=_TIME,
    fetched_at=_TIME,
    sentiment_compound=_REAL,
    sentiment_positive=_REAL,
    sentiment_negative=_REAL,
    sentiment_neutral=_REAL,
    sentiment_label=_TEXT,
    raw_json=_TEXT,
)

REJECTED_DOCUMENTS = _struct(match_id=_TEXT, document=_TEXT, loaded_at=_TIME)

RUN_LOG = _struct(
    pipeline_name=_TEXT, run_type=_TEXT, last_run_at=T.TimestampType(), status=_TEXT
)


def as_text(kind: T.DataType) -> T.DataType:
    """The type with all its values read as text, however the JSON writes them."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_TEXT, as_text(kind.valueType))
    return _TEXT


_WICKET = _struct(kind=_TEXT, player_out=_TEXT, fielders=T.ArrayType(_struct(name=_TEXT)))
_BALL = _struct(
    batter=_TEXT,
    bowler=_TEXT,
    non_striker=_TEXT,
    runs=_struct(batter=_INT, extras=_INT, total=_INT),
    extras=T.MapType(_TEXT, _INT),
    wickets=T.ArrayType(_WICKET),
)
_OVERS = T.ArrayType(_struct(over=_INT, deliveries=T.ArrayType(_BALL)))
_INFO = _struct(
    dates=T.ArrayType(_TEXT),
    season=_TEXT,  # also reads a JSON number
    teams=T.ArrayType(_TEXT),
    venue=_TEXT,
    city=_TEXT,
    toss=_struct(winner=_TEXT, decision=_TEXT),
    outcome=_struct(winner=_TEXT, by=_struct(runs=_INT, wickets=_INT)),
    event=_struct(name=_TEXT, stage=_TEXT, match_number=_INT),
    player_of_match=T.ArrayType(_TEXT),
)
MATCH_DOCUMENT = _struct(info=_INFO, innings=T.ArrayType(_struct(team=_TEXT, overs=_OVERS)))

POST_RESPONSE = _struct(
    data=T.ArrayType(
        _struct(
            id=_TEXT,
            title=_TEXT,
            author=_TEXT,
            subreddit=_TEXT,
            url=_TEXT,
            selftext=_TEXT,
            score=_LONG,
            upvote_ratio=_REAL,
            num_comments=_LONG,
            created_utc=_REAL,
        )
    ),
    fetched_at=_TEXT,
)
