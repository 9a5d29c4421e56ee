"""Writes small raw JSON trees for tests."""

from __future__ import annotations

import json
import pathlib


def put(root, path: str, document) -> None:
    target = pathlib.Path(root) / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(document if isinstance(document, str) else json.dumps(document))


def league(season: int, **changes) -> dict:
    return {
        "league_id": f"L{season}", "previous_league_id": f"L{season - 1}", "name": f"League {season}",
        "status": "complete",
        "settings": {"playoff_week_start": 3, "playoff_teams": 2, "num_teams": 4},
        "scoring_settings": {"sack": 1.0, "int": 2.0, "pass_td": 4.0, "safe": None},
        **changes,
    }


def team(roster: int, matchup, points, players: dict, starters) -> dict:
    return {
        "roster_id": roster, "matchup_id": matchup, "points": points,
        "players": list(players), "starters": starters,
        "players_points": {p: v for p, v in players.items() if v is not None},
    }


def season_tree(root, season: int, names: dict[str, str] | None = None) -> None:
    """Four teams, two regular weeks and one playoff week."""
    base = f"season={season}"
    names = names or {"u1": "Ann", "u2": "Bo", "u3": "Cy"}
    put(root, f"{base}/league/league.json", league(season))
    put(root, f"{base}/users/users.json", [{"user_id": u, "display_name": n} for u, n in names.items()])
    owners = ["u1", "u2", "u3", None]
    put(root, f"{base}/rosters/rosters.json",
        [{"roster_id": i + 1, "owner_id": u} for i, u in enumerate(owners)])
    units = ["SF", "DAL", "NYG", "BUF"]

    def lineup(roster: int, week: int) -> tuple[dict, list[str]]:
        first, bench = str(roster * 10), str(roster * 10 + 1)
        players = {first: 20.0 + roster, bench: 25.0 + week, units[roster - 1]: 5.0}
        if roster == 2 and week == 1:
            players["99"] = None  # started without points
        starters = [first, units[roster - 1], "0"] + (["99"] if "99" in players else [])
        return players, starters

    scores = {1: [100.0, 90.0, 90.0, 80.5], 2: [100.0, 100.0, 70.25, 120.75], 3: [50.0, 60.0, 0.0, 10.0]}
    for week, points in scores.items():
        teams = []
        for roster in (1, 2, 3, 4):
            players, starters = lineup(roster, week)
            matchup = None if week == 3 and roster > 2 else (roster + 1) // 2
            teams.append(team(roster, matchup, points[roster - 1], players, starters))
        put(root, f"{base}/matchups/week={week}.json", teams)
        stats = {u: {"sack": float(week), "int": 1.0, "off_snp": 60.0} for u in units}
        stats["10"] = {"pass_td": 2.0}
        put(root, f"{base}/player_stats/week={week}.json", stats)
    put(root, f"{base}/transactions/week=1.json", [
        {"transaction_id": "t1", "type": "waiver", "status": "complete", "leg": 1,
         "settings": {"waiver_bid": 7}, "adds": {"10": 1}, "drops": {"11": 1, "12": 2}},
        {"transaction_id": "t2", "type": "free_agent", "status": "failed", "leg": 1,
         "settings": None, "adds": {"20": 4}, "drops": None},
        {"transaction_id": "t3", "type": "trade", "status": "complete", "leg": 1,
         "settings": None, "adds": {}, "drops": {}},
    ])
    put(root, f"{base}/drafts/drafts.json", [{"draft_id": f"D{season}"}])
    put(root, f"{base}/draft_picks/draft=D{season}.json", [
        {"draft_id": f"D{season}", "pick_no": 1, "round": 1, "draft_slot": 1, "player_id": "10",
         "roster_id": 1, "picked_by": "u1", "metadata": {"amount": "33"}},
        {"draft_id": f"D{season}", "pick_no": 2, "round": 1, "draft_slot": 2, "player_id": "20",
         "roster_id": 2, "picked_by": "u2", "metadata": {"amount": "0"}},
        {"draft_id": f"D{season}", "pick_no": 3, "round": 1, "draft_slot": 3, "player_id": None,
         "roster_id": 3, "picked_by": "u3", "metadata": {"amount": "201"}},
        {"draft_id": f"D{season}", "pick_no": 4, "round": 1, "draft_slot": 4, "player_id": "40",
         "roster_id": 4, "picked_by": "", "metadata": {}},
    ])
    put(root, f"{base}/winners_bracket/winners_bracket.json", [{"p": 1, "w": 2}, {"p": 3, "w": 1}, {"p": None, "w": 4}])
    put(root, f"{base}/losers_bracket/losers_bracket.json", [{"p": 1, "w": 3}])


def players(root, **changes) -> None:
    people = {
        str(i): {"full_name": f"Player {i}", "first_name": "Player", "last_name": str(i),
                 "position": "RB", "team": "SF"}
        for i in (10, 11, 20, 21, 30, 31, 40, 41)
    }
    people["99"] = {"first_name": "No", "last_name": "Full", "position": "K"}
    people["98"] = {"position": "K"}
    people["SF"] = {"full_name": None, "first_name": "San", "last_name": None, "position": "DEF"}
    people.update(changes)
    put(root, "players_nfl/players_nfl.json", people)


def full_tree(root) -> None:
    season_tree(root, 2022)
    season_tree(root, 2023, {"u1": "Ann", "u2": "Bobby", "u3": "Cy"})
    players(root)
