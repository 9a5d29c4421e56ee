"""Endpoint schemas, the endpoint table and the other values fixed by the data contract."""

from __future__ import annotations

from dataclasses import dataclass

# The 25 statistics a unit-scoring change can touch.
STAT_KEYS = [
    "sack", "int", "ff", "fum_rec", "fum_rec_td",
    "def_td", "def_st_td", "def_st_ff", "def_st_fum_rec", "def_2pt",
    "safe", "blk_kick",
    "pts_allow", "pts_allow_0", "pts_allow_1_6", "pts_allow_7_13",
    "pts_allow_14_20", "pts_allow_21_27", "pts_allow_28_34", "pts_allow_35p",
    "def_4_and_stop", "tkl_loss", "st_ff", "st_fum_rec", "st_td",
]

# Path patterns, the id of an empty starter slot, the id form of a team unit.
SEASON_PATTERN = r"season=(\d{4})"
WEEK_PATTERN = r"week=(\d+)"
PULL_PATTERN = r"pull=(\d+)/"
DOCUMENT_PATTERN = r"pull=\d+/(.*)$"
EMPTY_SLOT = "0"
UNIT_PATTERN = "^[A-Z]+$"

LEAGUE = """
    league_id string, previous_league_id string, name string, status string,
    settings struct<playoff_week_start: int, playoff_teams: int, num_teams: int>,
    scoring_settings map<string, double>
"""
USERS = "user_id string, display_name string"
ROSTERS = "roster_id bigint, owner_id string"
MATCHUPS = """
    roster_id bigint, matchup_id bigint, points double,
    starters array<string>, players array<string>, players_points map<string, double>
"""
TRANSACTIONS = """
    transaction_id string, type string, status string, leg int,
    settings struct<waiver_bid: int>,
    adds map<string, bigint>, drops map<string, bigint>
"""
DRAFTS = "draft_id string"
DRAFT_PICKS = """
    draft_id string, pick_no int, round int, draft_slot int, player_id string,
    roster_id bigint, picked_by string, metadata struct<amount: string>
"""
BRACKET = "p int, w bigint"
MANIFEST = """
    seasons array<struct<season: string, files: int, matchup_weeks: int, transaction_weeks: int,
                         transactions: int, draft_picks: int, stat_weeks: int>>
"""
PLAYER = "full_name string, first_name string, last_name string, position string, team string"
# Whole files are read entry by entry and value by value: what is odd must not void the rest of its file.
ENTRIES = "map<string, string>"
STATS = "map<string, string>"

# Newest first: the ingest time; files of one micro-batch share it and are told apart by their own.
SEQUENCE = ("_ingest_ts", "_file_ts", "_source_file")

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Endpoint:
    """How one folder of the raw zone becomes a bronze table."""

    folder: str
    schema: str | None  # None: the whole file is one text value
    mode: str = "append"  # append | scd1
    keys: tuple[str, ...] = ()
    seasonal: bool = True
    text_column: str | None = None

    def glob(self, pulls: bool = False) -> str:
        parts = ["pull=*"] if pulls else []
        parts += ["season=*"] if self.seasonal else []
        return "/".join([*parts, self.folder])


ENDPOINTS: dict[str, Endpoint] = {
    "league": Endpoint("league", LEAGUE, "scd1", ("season",)),
    "rosters": Endpoint("rosters", ROSTERS, "scd1", ("season", "roster_id")),
    "players_raw": Endpoint("players_nfl", None, "scd1", ("_key",), False, "players_json"),
    "users": Endpoint("users", USERS),
    "matchups": Endpoint("matchups", MATCHUPS),
    "transactions": Endpoint("transactions", TRANSACTIONS),
    "drafts": Endpoint("drafts", DRAFTS),
    "draft_picks": Endpoint("draft_picks", DRAFT_PICKS),
    "winners_bracket": Endpoint("winners_bracket", BRACKET),
    "losers_bracket": Endpoint("losers_bracket", BRACKET),
    "player_stats": Endpoint("player_stats", None, text_column="stats_json"),
}
