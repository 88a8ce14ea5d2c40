"""Hand-written match documents, one case each."""

from __future__ import annotations

import json
import os


def _ball(batter="A Bat", bowler="B Bowl", **fields):
    return {"batter": batter, "bowler": bowler, "non_striker": "C Non", **fields}


def _runs(batter, extras=0):
    return {"batter": batter, "extras": extras, "total": batter + extras}


def _info(**fields):
    base = {
        "dates": ["2008-04-18"],
        "season": "2007/08",
        "teams": ["Reds", "Blues"],
        "venue": "Main Ground",
        "city": "Town",
        "toss": {"winner": "Reds", "decision": "field"},
        "outcome": {"winner": "Blues", "by": {"runs": 140}},
        "event": {"name": "League", "match_number": 1},
        "player_of_match": ["A Bat", "B Bowl"],
    }
    base.update(fields)
    return {k: v for k, v in base.items() if v is not None}


def _over(*balls, number=0):
    return {"over": number, "deliveries": list(balls)}


CAUGHT = {
    "kind": "caught",
    "player_out": "A Bat",
    "fielders": [{"name": "D Catch"}, {"name": "E Other"}],
}

DOCUMENTS = {
    "1001": {
        "info": _info(),
        "innings": [
            {
                "team": "Reds",
                "overs": [
                    _over(
                        _ball(runs=_runs(4)),
                        _ball(runs=_runs(0, 3), extras={"noballs": 1, "byes": 2}),
                        _ball(runs=_runs(0), wickets=[CAUGHT]),
                    )
                ],
            }
        ],
    },
    "1002": {
        "info": _info(season=2026, teams=["Reds"]),
        "innings": [{"team": "Reds", "overs": [_over(_ball(wickets=[], extras={}))]}],
    },
    "1004": {"meta": {"version": 1}},
    "1005": {
        "info": _info(outcome={"result": "tie"}, season="2019"),
        "innings": [
            {"team": "Reds", "overs": [_over(_ball(runs=_runs(6)))]},
            {"team": "Blues", "overs": [_over(_ball(batter="F Blue", runs=_runs(5)))]},
            {
                "team": "Reds",
                "super_over": True,
                "overs": [
                    _over(
                        _ball(
                            runs=_runs(0),
                            wickets=[
                                {"kind": "run out", "player_out": "C Non", "fielders": [{}]},
                                CAUGHT,
                            ],
                        ),
                        number=7,
                    )
                ],
            },
            {"team": "Blues"},
        ],
    },
    "1006": {"info": _info(season=None, dates=None, city=None)},
    "1007": {
        "info": _info(
            season="2020/21",
            outcome={"winner": "Reds", "by": {"wickets": 3}},
            event={"name": "League", "stage": "Final"},
        ),
        "innings": [],
    },
}
MALFORMED = {"1003": '{"info": {"teams": ["Reds", '}


def write_folder(folder, documents=DOCUMENTS, malformed=MALFORMED) -> str:
    os.makedirs(folder, exist_ok=True)
    texts = {k: json.dumps(v, indent=1) for k, v in documents.items()} | malformed
    for stem, text in texts.items():
        with open(os.path.join(folder, f"{stem}.json"), "w") as f:
            f.write(text)
    with open(os.path.join(folder, "README.txt"), "w") as f:
        f.write("not a document")
    return str(folder)
