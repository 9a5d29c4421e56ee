"""The driver's tables seen as a league's bronze rows.

Seasons are order years, weeks are order months, teams are the nations of the customers. The rules
below are arithmetic on keys (no hashes), so that SQL on the same tables can restate them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.functions.parsing import week_from_path

TEAMS = 25
PLAYOFF_START = 10
PLAYOFF_TEAMS = 6
# Keys of one document span a fixed range, so a document is bounded however large the table is.
SLOT_SPAN = 64
PLAYER_SPAN = 500
UNITS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
STAT_OF_LINE = {
    "AF": "sack", "AO": "int", "NF": "ff", "NO": "fum_rec", "RF": "pts_allow", "RO": "off_snp",
}


def _text(column: Column) -> Column:
    return column.cast("string")


def _file(endpoint: str) -> Column:
    return F.format_string(f"raw/season=%d/{endpoint}/week=%d.json", "season", "week")


def _user(key: Column) -> Column:
    return F.concat(F.lit("u"), _text(key))


class LeagueTables:
    """Bronze inputs over one folder of driver tables. Every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- season grain ---------------------------------------------------------------------------

    def _season_range(self) -> DataFrame:
        year = F.year("o_orderdate")
        return self.table("orders").agg(F.min(year).alias("first"), F.max(year).alias("last"))

    def league(self) -> DataFrame:
        season = F.col("season")
        weights = F.create_map(
            F.lit("sack"), F.lit(1.0),
            F.lit("int"), F.lit(2.0),
            F.lit("ff"), F.when(season % 2 == 0, F.lit(1.5)),
            F.lit("pts_allow"), (season - 2000) * 0.25,
            F.lit("safe"), F.lit(None).cast("double"),
            F.lit("off_snp"), F.lit(4.0),
        )
        settings = F.struct(
            F.lit(PLAYOFF_START).alias("playoff_week_start"),
            F.lit(PLAYOFF_TEAMS).alias("playoff_teams"),
            F.lit(TEAMS).alias("num_teams"),
        )
        return (
            self._season_range()
            .select("first", "last", F.explode(F.sequence("first", "last")).alias("season"))
            .select(
                _text(season).alias("season"),
                F.concat(F.lit("L"), _text(season)).alias("league_id"),
                F.when(season > F.col("first"), F.concat(F.lit("L"), _text(season - 1)))
                .otherwise(F.lit("0")).alias("previous_league_id"),
                F.concat(F.lit("League "), _text(season)).alias("name"),
                F.when(season < F.col("last"), "complete").otherwise("in_season").alias("status"),
                settings.alias("settings"),
                weights.alias("scoring_settings"),
            )
        )

    def _teams(self) -> DataFrame:
        """(season, nation) pairs."""
        years = self._season_range().select(F.sequence("first", "last")).scalar()
        return self.table("nation").select("n_nationkey", "n_name", F.explode(years).alias("season"))

    def users(self) -> DataFrame:
        renamed = (F.col("n_nationkey") % 3 == 0) & (F.col("season") >= 1998)
        return self._teams().select(
            _user(F.col("n_nationkey")).alias("user_id"),
            F.when(renamed, F.concat("n_name", F.lit(" II"))).otherwise(F.col("n_name")).alias("display_name"),
            _text(F.col("season")).alias("season"),
        )

    def rosters(self) -> DataFrame:
        owned = F.col("n_nationkey") % 11 != 7
        return self._teams().select(
            _text(F.col("season")).alias("season"),
            F.col("n_nationkey").cast("bigint").alias("roster_id"),
            F.when(owned, _user(F.col("n_nationkey"))).alias("owner_id"),
        )

    # -- team-week grain ------------------------------------------------------------------------

    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", "o_custkey",
            F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"),
        )

    def _customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("roster_id")
        )

    def _team_orders(self) -> DataFrame:
        """Orders with the team of their customer. Joined before the lines, which are many more."""
        return self._orders().join(self._customers(), "o_custkey").drop("o_custkey")

    def matchups(self) -> DataFrame:
        """One row per team-week; points are the team's orders of the month."""
        team = F.col("roster_id")
        partner = F.pmod(F.col("season") * 12 + F.col("week") - team, F.lit(TEAMS))
        return (
            self._team_orders()
            .groupBy("season", "week", "roster_id").agg(F.count(F.lit(1)).cast("double").alias("points"))
            .select(
                _text(F.col("season")).alias("season"),
                _file("matchups").alias("_source_file"),
                "roster_id",
                F.when(partner != team, F.least(team, partner)).alias("matchup_id"),
                "points",
            )
        )

    def winners_bracket(self) -> DataFrame:
        """Node 1 is won by the best team of a season's last week, node 2 by the worst."""
        week = week_from_path(F.col("_source_file"))
        best = F.max(F.struct(week, F.col("points"), -F.col("roster_id"), "roster_id"))
        worst = F.max(F.struct(week, -F.col("points"), -F.col("roster_id"), "roster_id"))
        return (
            self.matchups().groupBy("season")
            .agg(best["roster_id"].alias("best"), worst["roster_id"].alias("worst"))
            .select(
                "season",
                F.inline(
                    F.array(
                        F.struct(F.lit(1).alias("p"), F.col("best").alias("w")),
                        F.struct(F.lit(2).alias("p"), F.col("worst").alias("w")),
                    )
                ),
            )
        )

    # -- player grain ---------------------------------------------------------------------------

    def _slots(self) -> DataFrame:
        """Rostered parts, and part types as team units: points, starter flag and document number.

        Both grains start from the same totals, so the lines are joined and shuffled once; totals by
        part stay where the join with the parts has put them.
        """
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_quantity"
        )
        types = self.table("part").select("p_partkey", "p_type")
        team = ["season", "week", "roster_id"]
        totals = (
            lines.join(self._team_orders(), "o_orderkey").join(types, "p_partkey")
            .groupBy(*team, "p_partkey", "p_type").agg(F.sum("l_quantity").alias("quantity"))
        )
        part, unit = F.col("p_partkey"), F.col("p_type")
        week, roster = F.col("week"), F.col("roster_id")
        people = totals.select(
            *team,
            _text(part).alias("player_id"),
            F.when((part + roster) % 13 != 0, F.col("quantity")).alias("points"),
            ((part + week) % 3 != 0).alias("is_starter"),
            F.floor(part / SLOT_SPAN).alias("document"),
        )
        position = F.array_position(F.array(*[F.lit(u) for u in UNITS]), unit)
        units = totals.groupBy(*team, "p_type").agg(F.sum("quantity").alias("quantity")).select(
            *team,
            unit.alias("player_id"),
            F.col("quantity").alias("points"),
            (position == (week + roster) % len(UNITS) + 1).alias("is_starter"),
            (-1 - F.crc32("p_type") % SLOT_SPAN).alias("document"),
        )
        return people.unionByName(units)

    def roster_slots(self) -> DataFrame:
        """Slots with their owner, flat."""
        owner = self.rosters().withColumnRenamed("owner_id", "user_id")
        return (
            self._slots().withColumn("season", _text(F.col("season")))
            .join(owner, ["season", "roster_id"], "left")
            .select("season", "week", "roster_id", "user_id", "player_id", "points", "is_starter")
        )

    def matchup_documents(self) -> DataFrame:
        """The same slots as nested line-ups: starters, players and a points map.

        A document holds at most SLOT_SPAN people or the units of one checksum.
        """
        player = F.col("player_id")
        entry = F.when(F.col("points").isNotNull(), F.struct("player_id", "points"))
        return (
            self._slots().groupBy("season", "week", "roster_id", "document")
            .agg(
                F.collect_list(F.when(F.col("is_starter"), player)).alias("starters"),
                F.collect_list(player).alias("players"),
                F.map_from_entries(F.collect_list(entry)).alias("players_points"),
            )
            .select(
                _text(F.col("season")).alias("season"), _file("matchups").alias("_source_file"),
                "roster_id", "starters", "players", "players_points",
            )
        )

    def transactions(self) -> DataFrame:
        """Order lines returned A are adds, R are drops. Copies of a line are one move; they are
        merged before the shuffle, and a document holds at most SLOT_SPAN parts of an order."""
        part = F.col("l_partkey")
        moves = (
            self.table("lineitem").filter(F.col("l_returnflag").isin("A", "R"))
            .select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_returnflag")
        )
        entry = F.struct(
            _text(part).alias("key"), ((F.col("o_orderkey") + part) % TEAMS).alias("value")
        )

        def kept(flag: str) -> Column:
            return F.map_from_entries(F.collect_set(F.when(F.col("l_returnflag") == flag, entry)))

        orders = self.table("orders").select(
            "o_orderkey", "o_orderstatus",
            F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("leg"),
        )
        key = F.col("o_orderkey")
        return (
            moves.groupBy("o_orderkey", F.floor(part / SLOT_SPAN).alias("document"))
            .agg(kept("A").alias("adds"), kept("R").alias("drops"))
            .join(orders, "o_orderkey")
            .select(
                _text(key).alias("transaction_id"),
                F.when(key % 3 == 0, "waiver").otherwise("free_agent").alias("type"),
                F.col("o_orderstatus").alias("status"),
                _text(F.col("season")).alias("season"),
                F.format_string("raw/season=%d/transactions/week=%d.json", "season", "leg").alias("_source_file"),
                "leg",
                F.struct(F.when(key % 5 == 0, (key % 100).cast("int")).alias("waiver_bid")).alias("settings"),
                F.when(F.size("adds") > 0, F.col("adds")).alias("adds"),
                "drops",
            )
        )

    def draft_picks(self) -> DataFrame:
        """Each part is picked in one season; some picks lack a player, an amount, or exceed the cap."""
        part = F.col("p_partkey")
        season = F.lit(1995) + part % 7
        amount = F.when(part % 41 == 5, "n/a").when(part % 40 == 39, "201").otherwise(_text(part % 40))
        return self.table("part").select(
            _text(season).alias("season"),
            F.concat(F.lit("D"), _text(season)).alias("draft_id"),
            F.format_string("raw/season=%d/draft_picks/draft=D%d.json", season, season).alias("_source_file"),
            (part + 1).cast("int").alias("pick_no"),
            F.floor(part / TEAMS + 1).cast("int").alias("round"),
            (part % TEAMS + 1).cast("int").alias("draft_slot"),
            F.when(part % 97 != 0, _text(part)).alias("player_id"),
            (part * 7 % TEAMS).alias("roster_id"),
            _user(part * 7 % TEAMS).alias("picked_by"),
            F.struct(amount.alias("amount")).alias("metadata"),
        )

    def players_raw(self) -> DataFrame:
        """The player dictionary as JSON text: one document per PLAYER_SPAN part keys."""
        part, words = F.col("p_partkey"), F.split("p_name", " ")
        known = part % 35 != 0
        player = F.struct(
            F.when(part % 7 != 0, F.col("p_name")).alias("full_name"),
            F.when(known, F.get(words, F.lit(0))).alias("first_name"),
            F.when(known, F.get(words, F.lit(1))).alias("last_name"),
            F.col("p_brand").alias("position"),
            F.col("p_type").alias("team"),
        )
        entry = F.struct(_text(part).alias("key"), player.alias("value"))
        return (
            self.table("part").select("p_partkey", "p_name", "p_brand", "p_type").distinct()
            .groupBy(F.floor(part / PLAYER_SPAN).alias("document"))
            .agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("players_json"))
            .drop("document")
        )

    def player_stats(self) -> DataFrame:
        """Weekly statistics as JSON text: part type or brand -> statistic -> quantity.

        Returned-and-shipped flags name the statistic. In week 5 one value is no number. Part types
        and brands are code lists, so a week's document stays small however many lines it sums up.
        """
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
            F.concat("l_returnflag", "l_linestatus").alias("line"), "l_quantity",
        )
        names = F.create_map(*[F.lit(x) for pair in STAT_OF_LINE.items() for x in pair])
        totals = (
            lines.join(self._orders().drop("o_custkey"), "o_orderkey")
            .join(self.table("part").select("p_partkey", "p_type", "p_brand"), "p_partkey")
            .groupBy("season", "week", "line", "p_type", "p_brand").agg(F.sum("l_quantity").alias("q"))
            .select("season", "week", "line", "q",
                    F.explode(F.array("p_type", "p_brand")).alias("player"))
            .groupBy("season", "week", "player", "line").agg(F.sum("q").alias("q"))
            .withColumn("stat", names[F.col("line")])
        )
        bad = (F.col("player") == "PROMO") & (F.col("stat") == "int")
        text = F.when(bad, "n/a").otherwise(_text(F.col("q")))

        def entries(key: Column | str, value: Column) -> Column:
            return F.map_from_entries(F.collect_list(F.struct(key, value)))

        per_player = totals.groupBy("season", "week", "player").agg(
            entries("stat", F.col("q")).alias("numbers"), entries("stat", text).alias("texts")
        )
        document = per_player.groupBy("season", "week").agg(
            F.to_json(entries("player", F.col("numbers"))).alias("numbers"),
            F.to_json(entries("player", F.col("texts"))).alias("texts"),
        )
        return document.select(
            _text(F.col("season")).alias("season"), "week", _file("player_stats").alias("_source_file"),
            F.when(F.col("week") == 5, F.col("texts")).otherwise(F.col("numbers")).alias("stats_json"),
        )
