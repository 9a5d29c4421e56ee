"""SQL for DuckDB that restates the registered queries, written in other terms where possible."""

from __future__ import annotations

from gridledger.schemas import STAT_KEYS

ORACLES: dict[str, str] = {}


def half_up(value: str, digits: int) -> str:
    """Round the shortest decimal form of a double, away from zero at halves."""
    return f"round(({value})::DOUBLE::VARCHAR::DECIMAL(38,17), {digits})::DOUBLE"


LISTED = "(" + ", ".join(f"'{k}'" for k in STAT_KEYS) + ")"

# Named parts. Each lists the parts it reads; `sql` puts those it needs in front, in order.
PARTS: dict[str, tuple[str, str]] = {
    "bounds": ("", "SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders"),
    "years": ("bounds", "SELECT unnest(range(lo, hi + 1)) AS y, hi FROM bounds"),
    "mgr": ("", """
        SELECT 'u' || n_nationkey AS user_id,
               n_name || CASE WHEN n_nationkey % 3 = 0 THEN ' II' ELSE '' END AS display_name
        FROM nation"""),
    "tw": ("", """
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, c_nationkey::BIGINT AS r,
               count(*)::DOUBLE AS pts
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""),
    "side": ("tw", """
        SELECT *, (y * 12 + m - r) % 25 AS partner,
               CASE WHEN r % 11 <> 7 THEN 'u' || r END AS user_id
        FROM tw"""),
    "med": ("tw", "SELECT y, m, median(pts) AS med FROM tw GROUP BY y, m"),
    "fm": ("side med", """
        SELECT a.y::VARCHAR AS season, a.m::INTEGER AS w, a.r AS roster_id, a.user_id,
               CASE WHEN a.partner <> a.r THEN least(a.r, a.partner) END AS matchup_id,
               a.pts AS points, b.pts AS opponent_points, med AS median_points,
               CASE sign(a.pts - b.pts) WHEN 1 THEN 'W' WHEN -1 THEN 'L' WHEN 0 THEN 'T' END AS h2h_result,
               CASE sign(a.pts - med) WHEN 1 THEN 'W' WHEN -1 THEN 'L' WHEN 0 THEN 'T' END AS median_result,
               a.m < 10 AS is_regular
        FROM side a
        JOIN med USING (y, m)
        LEFT JOIN side b ON b.y = a.y AND b.m = a.m AND b.r = a.partner AND a.partner <> a.r"""),
    "reg": ("fm", "SELECT * FROM fm WHERE is_regular"),
    "ap": ("reg", """
        SELECT a.season, a.w, a.roster_id, any_value(a.user_id) AS user_id,
               any_value(a.points) AS points, any_value(a.h2h_result) AS h, any_value(a.median_result) AS d,
               sum(CASE WHEN a.points > b.points THEN 1 WHEN a.points = b.points THEN 0.5 ELSE 0 END)
                   - 0.5 AS ap_wins,
               count(*) - 1 AS ap_games
        FROM reg a JOIN reg b ON a.season = b.season AND a.w = b.w
        GROUP BY a.season, a.w, a.roster_id"""),
    "luck": ("ap mgr", f"""
        SELECT season, display_name, points_for, actual_wins, expected_wins,
               {half_up('actual_wins - expected_wins', 1)} AS luck, all_play_pct
        FROM (
            SELECT season, user_id, sum(points)::DOUBLE AS points_for,
                   sum(CASE h WHEN 'W' THEN 1 WHEN 'T' THEN 0.5 ELSE 0 END
                       + CASE d WHEN 'W' THEN 1 WHEN 'T' THEN 0.5 ELSE 0 END)::DOUBLE AS actual_wins,
                   coalesce({half_up('sum(ap_wins)::DOUBLE / nullif(sum(ap_games), 0)::DOUBLE * (2 * count(DISTINCT w))', 1)}, 0)
                       AS expected_wins,
                   {half_up('sum(ap_wins)::DOUBLE / nullif(sum(ap_games), 0)::DOUBLE', 3)} AS all_play_pct
            FROM ap GROUP BY season, user_id
        ) LEFT JOIN mgr USING (user_id)"""),
    "bracket": ("tw", """
        SELECT y::VARCHAR AS season, p, w FROM (
            SELECT y, 1::INTEGER AS p, r AS w, row_number() OVER (PARTITION BY y ORDER BY m DESC, pts DESC, r) AS k FROM tw
            UNION ALL
            SELECT y, 2, r, row_number() OVER (PARTITION BY y ORDER BY m DESC, pts, r) FROM tw
        ) WHERE k = 1"""),
    "finish": ("reg", """
        SELECT *, row_number() OVER (PARTITION BY season ORDER BY wins DESC NULLS LAST, points_for DESC NULLS LAST, user_id NULLS FIRST)::INTEGER AS reg_rank
        FROM (
            SELECT season, user_id,
                   (sum((h2h_result = 'W')::INTEGER) + sum((median_result = 'W')::INTEGER))::BIGINT AS wins,
                   (sum((h2h_result = 'L')::INTEGER) + sum((median_result = 'L')::INTEGER))::BIGINT AS losses,
                   sum(points)::DOUBLE AS points_for
            FROM reg GROUP BY season, user_id
        )"""),
    "titles": ("bracket bounds", """
        SELECT user_id, count(*) AS championships FROM (
            SELECT CASE WHEN w % 11 <> 7 THEN 'u' || w END AS user_id
            FROM bracket, bounds WHERE p = 1 AND season <> hi::VARCHAR
        ) GROUP BY user_id"""),
    "qty": ("", """
        SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, c_nationkey::BIGINT AS r, l_partkey AS part,
               sum(l_quantity) AS q
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY ALL"""),
    "slots": ("qty", """
        SELECT y::VARCHAR AS season, m::INTEGER AS w, r AS roster_id,
               CASE WHEN r % 11 <> 7 THEN 'u' || r END AS user_id, player_id, points, is_starter
        FROM (
            SELECT y, m, r, part::VARCHAR AS player_id,
                   CASE WHEN (part + r) % 13 <> 0 THEN q END AS points, (part + m) % 3 <> 0 AS is_starter
            FROM qty
            UNION ALL
            SELECT y, m, r, p_type, sum(q),
                   p_type = ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][(m + r) % 6 + 1]
            FROM qty JOIN part ON part = p_partkey GROUP BY y, m, r, p_type
        )"""),
    "tally": ("", """
        SELECT year(o_orderdate) AS y, month(o_orderdate)::INTEGER AS m,
               unnest([p_type, p_brand]) AS player_id,
               CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'sack' WHEN 'AO' THEN 'int'
                    WHEN 'NF' THEN 'ff' WHEN 'NO' THEN 'fum_rec' WHEN 'RF' THEN 'pts_allow'
                    WHEN 'RO' THEN 'off_snp' END AS k,
               l_quantity AS q
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "stat": ("tally", """
        SELECT y::VARCHAR AS season, m AS w, player_id, k,
               CASE WHEN NOT (m = 5 AND player_id = 'PROMO' AND k = 'int') THEN q END AS v
        FROM (SELECT y, m, player_id, k, sum(q) AS q FROM tally GROUP BY y, m, player_id, k)"""),
    "line": ("stat", """
        SELECT season, w, player_id, count(*)::INTEGER AS n_stats,
               max(v) FILTER (k = 'sack') AS sack, max(v) FILTER (k = 'int') AS interceptions,
               max(v) FILTER (k = 'ff') AS ff, max(v) FILTER (k = 'fum_rec') AS fum_rec,
               max(v) FILTER (k = 'pts_allow') AS pts_allow
        FROM stat GROUP BY season, w, player_id"""),
    "unit": ("slots line", """
        SELECT s.season, s.w, roster_id, user_id, s.player_id AS def_id, points AS def_actual_points,
               n_stats, sack, interceptions, ff, fum_rec, pts_allow
        FROM slots s LEFT JOIN line l ON l.season = s.season AND l.w = s.w AND l.player_id = s.player_id
        WHERE is_starter AND regexp_full_match(s.player_id, '[A-Z]+')"""),
    "fixed": ("fm unit", """
        SELECT f.season, f.w, f.roster_id, f.user_id, f.matchup_id, f.points AS actual_points,
               f.points - coalesce(def_actual_points, 0) AS non_def_points, def_id, f.is_regular,
               sack, interceptions, ff, fum_rec, pts_allow
        FROM fm f LEFT JOIN unit u ON u.season = f.season AND u.w = f.w AND u.roster_id = f.roster_id"""),
    "weights": ("", """
        SELECT * FROM (VALUES ('as_is', 1.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, -0.25::DOUBLE),
                              ('bold', 2.5, 4.0, 0.0, 3.0, -0.5),
                              ('none', 0.0, 0.0, 0.0, 0.0, 0.0))
            AS t(scenario_id, w_sack, w_int, w_ff, w_fum, w_allow)"""),
    "rescored": ("fixed weights", """
        SELECT scenario_id, season, w, roster_id, user_id, matchup_id, is_regular, actual_points,
               non_def_points + coalesce(sack, 0) * w_sack + coalesce(interceptions, 0) * w_int
                   + coalesce(ff, 0) * w_ff + coalesce(fum_rec, 0) * w_fum
                   + coalesce(pts_allow, 0) * w_allow AS new_points
        FROM fixed CROSS JOIN weights"""),
    "season_stat": ("stat", f"""
        SELECT season, player_id AS def_id, k, sum(v) AS total FROM stat
        WHERE regexp_full_match(player_id, '[A-Z]+') AND k IN {LISTED} GROUP BY ALL"""),
    "setting": ("years", """
        SELECT y::VARCHAR AS season, stat, weight FROM years, LATERAL (VALUES
            ('sack', 1.0::DOUBLE), ('int', 2.0), ('ff', CASE WHEN y % 2 = 0 THEN 1.5 END),
            ('pts_allow', (y - 2000) * 0.25), ('safe', NULL), ('off_snp', 4.0)) AS v(stat, weight)"""),
    "player": ("", """
        SELECT p_partkey::VARCHAR AS player_id,
               CASE WHEN p_partkey % 7 <> 0 OR p_partkey % 35 <> 0 THEN p_name END AS full_name,
               p_brand AS position, p_type AS team
        FROM part"""),
    "pick": ("", """
        SELECT (1995 + p_partkey % 7)::VARCHAR AS season, 'D' || (1995 + p_partkey % 7) AS draft_id,
               (p_partkey + 1)::INTEGER AS pick_no, (p_partkey // 25 + 1)::INTEGER AS round,
               (p_partkey % 25 + 1)::INTEGER AS draft_slot,
               CASE WHEN p_partkey % 97 <> 0 THEN p_partkey::VARCHAR END AS player_id,
               p_partkey * 7 % 25 AS roster_id, 'u' || (p_partkey * 7 % 25) AS user_id,
               CASE WHEN p_partkey % 41 = 5 THEN 'n/a' WHEN p_partkey % 40 = 39 THEN '201'
                    ELSE (p_partkey % 40)::VARCHAR END AS amount
        FROM part"""),
    "tx": ("", """
        SELECT DISTINCT l_orderkey AS o, l_partkey AS part, l_returnflag AS flag,
               year(o_orderdate)::VARCHAR AS season, month(o_orderdate)::INTEGER AS w
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IN ('A', 'R')"""),
    "period": ("", """
        SELECT user_id, event_type, ts AS "__START_AT",
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)
        WHERE prev IS DISTINCT FROM event_type"""),
}


def _needed(names: str) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        for part in PARTS[name][0].split():
            visit(part)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    return order


def sql(parts: str, select: str) -> str:
    named = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in _needed(parts))
    return f"WITH {named}\n{select}" if named else select


def oracle(name: str, parts: str, select: str) -> None:
    ORACLES[name] = sql(parts, select)


def verdict(name: str, parts: str, title: str, what: str, bad: str) -> None:
    oracle(name, parts, f"SELECT '{title}' AS name, bad, bad = 0 AS ok, bad || ' {what}' AS detail FROM ({bad})")


FACT = """season, w AS week, roster_id, user_id, matchup_id, points, opponent_points, median_points,
          h2h_result, median_result, is_regular"""

oracle("path_extract", "", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 1 THEN year(o_orderdate)::VARCHAR END AS season,
           CASE WHEN o_orderkey % 10 <> 0 THEN month(o_orderdate)::INTEGER END AS week
    FROM orders""")
oracle("dim_season", "years", """
    SELECT y::VARCHAR AS season, 'L' || y AS league_id, 'League ' || y AS league_name,
           CASE WHEN y < hi THEN 'complete' ELSE 'in_season' END AS status,
           10::INTEGER AS playoff_week_start, 6::INTEGER AS playoff_teams, 25::INTEGER AS num_teams
    FROM years""")
oracle("nested_projection", "pick", "SELECT season, pick_no, amount FROM pick")
oracle("dim_week", "tw", """
    SELECT DISTINCT y::VARCHAR AS season, m::INTEGER AS week, m < 10 AS is_regular, m >= 10 AS is_playoff
    FROM tw""")
oracle("regular_season_filter", "reg", "SELECT season, w AS week, roster_id, points FROM reg")
oracle("unit_filter", "slots", """
    SELECT season, w AS week, roster_id, player_id, points, is_starter FROM slots
    WHERE player_id IN (SELECT p_type FROM part)""")
oracle("stat_key_filter", "stat", f"""
    SELECT season, w AS week, player_id, k, v FROM stat WHERE k IN {LISTED}""")
oracle("player_name", "", """
    SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_name
        WHEN p_partkey % 35 <> 0 AND p_partkey % 5 <> 0
            THEN split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2)
        WHEN p_partkey % 35 <> 0 THEN split_part(p_name, ' ', 1)
        END AS full_name
    FROM part""")
oracle("empty_slot", "", "SELECT p_partkey, p_partkey % 10 IN (0, 1) OR p_partkey = 0 AS is_empty FROM part")
oracle("map_explode", "tx", """
    SELECT o::VARCHAR AS transaction_id, part::VARCHAR AS player_id, (o + part) % 25 AS roster_id
    FROM tx WHERE flag = 'A'""")
oracle("map_lookup", "line", """
    SELECT season, w AS week, player_id, sack, interceptions, NULL::DOUBLE AS safe FROM line""")

oracle("scd1_latest", "", """
    SELECT user_id, ts, event_type, value FROM events e
    WHERE ts = (SELECT max(ts) FROM events x WHERE x.user_id = e.user_id)""")
oracle("scd1_latest_composite", "", """
    SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value
    FROM events GROUP BY user_id, event_type""")
oracle("scd2_history", "period", "SELECT * FROM period")
oracle("scd2_current", "period", """
    SELECT user_id, event_type, "__START_AT" FROM period WHERE "__END_AT" IS NULL""")
oracle("dim_manager", "bounds", """
    SELECT 'u' || n_nationkey AS user_id, n_name AS display_name, lo::VARCHAR AS "__START_AT",
           CASE WHEN n_nationkey % 3 = 0 THEN '1998' END AS "__END_AT"
    FROM nation, bounds
    UNION ALL
    SELECT 'u' || n_nationkey, n_name || ' II', '1998', NULL FROM nation WHERE n_nationkey % 3 = 0""")

oracle("owner_resolution", "side", """
    SELECT y::VARCHAR AS season, m::INTEGER AS week, r AS roster_id, user_id FROM side""")
oracle("fact_matchup", "fm", f"SELECT {FACT} FROM fm")
oracle("game_result", "fm", """
    SELECT season, w AS week, roster_id, points, opponent_points, h2h_result FROM fm""")
oracle("weekly_median", "med", """
    SELECT y::VARCHAR AS season, m::INTEGER AS week, med AS median_points FROM med""")
oracle("median_result", "fm", "SELECT season, w AS week, roster_id, median_points, median_result FROM fm")
oracle("json_dict_explode", "player", "SELECT player_id, full_name, position, team FROM player")
oracle("fact_roster_slot", "slots", """
    SELECT season, w AS week, roster_id, user_id, player_id, points, is_starter FROM slots""")
oracle("fact_transaction", "tx", """
    SELECT o::VARCHAR AS transaction_id, season, w AS week,
           CASE WHEN o % 3 = 0 THEN 'waiver' ELSE 'free_agent' END AS type,
           CASE flag WHEN 'A' THEN 'add' ELSE 'drop' END AS action, part::VARCHAR AS player_id,
           (o + part) % 25 AS roster_id,
           CASE WHEN (o + part) % 25 % 11 <> 7 THEN 'u' || ((o + part) % 25) END AS user_id,
           CASE WHEN o % 5 = 0 THEN (o % 100)::INTEGER END AS faab_bid
    FROM tx""")
oracle("fact_draft_pick", "pick", """
    SELECT * EXCLUDE (amount), TRY_CAST(amount AS INTEGER) AS auction_amount FROM pick
    WHERE player_id IS NOT NULL""")

oracle("all_play", "ap", """
    SELECT season, w AS week, roster_id, ap_wins::DOUBLE AS ap_wins, ap_games FROM ap""")
oracle("luck_standings", "luck", "SELECT * FROM luck")
oracle("manager_consistency", "reg mgr", f"""
    SELECT season, display_name, avg_points, stddev_points, min_points, max_points,
           {half_up('stddev_points / nullif(avg_points, 0)', 3)} AS coeff_variation
    FROM (
        SELECT season, user_id, {half_up('avg(points)', 2)} AS avg_points,
               {half_up('stddev_samp(points)', 2)} AS stddev_points,
               min(points) AS min_points, max(points) AS max_points
        FROM reg GROUP BY season, user_id
    ) LEFT JOIN mgr USING (user_id)""")
oracle("bench_points", "slots mgr", """
    SELECT season, display_name, starter_points, points_left_on_bench FROM (
        SELECT season, user_id, sum(starters)::DOUBLE AS starter_points,
               sum(greatest(0, best - worst))::DOUBLE AS points_left_on_bench
        FROM (
            SELECT season, w, roster_id, user_id,
                   coalesce(sum(points) FILTER (is_starter), CASE WHEN count(*) > count(*) FILTER (is_starter) THEN 0 END) AS starters,
                   min(points) FILTER (is_starter) AS worst, max(points) FILTER (NOT is_starter) AS best
            FROM slots WHERE w < 10 GROUP BY ALL
        ) GROUP BY season, user_id
    ) LEFT JOIN mgr USING (user_id)""")
oracle("points_per_dollar", "", f"""
    SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 40 > 0
        THEN {half_up('CASE WHEN p_partkey % 8 <> 0 THEN p_size * 0.25::DOUBLE ELSE 0 END / (p_partkey % 40)', 2)} END AS ppd
    FROM part""")
oracle("auction_roi", "pick slots player mgr", f"""
    SELECT p.season, display_name, full_name, position, TRY_CAST(amount AS INTEGER) AS auction_amount,
           coalesce(earned, 0) AS season_points,
           {half_up('coalesce(earned, 0) / TRY_CAST(amount AS INTEGER)', 2)} AS points_per_dollar
    FROM pick p
    LEFT JOIN (SELECT season, player_id, roster_id, sum(points) AS earned FROM slots GROUP BY ALL) s
        ON s.season = p.season AND s.player_id = p.player_id AND s.roster_id = p.roster_id
    LEFT JOIN player n ON n.player_id = p.player_id
    LEFT JOIN mgr ON mgr.user_id = p.user_id
    WHERE p.player_id IS NOT NULL AND TRY_CAST(amount AS INTEGER) > 0""")
oracle("h2h_matrix", "reg mgr", """
    SELECT x.display_name AS manager, y.display_name AS opponent, wins, losses, games FROM (
        SELECT a.user_id AS mgr, b.user_id AS opp, count(*) FILTER (a.points > b.points) AS wins,
               count(*) FILTER (a.points < b.points) AS losses, count(*) AS games
        FROM reg a JOIN reg b ON a.season = b.season AND a.w = b.w AND a.matchup_id = b.matchup_id
        WHERE a.user_id <> b.user_id GROUP BY ALL
    ) LEFT JOIN mgr x ON x.user_id = mgr LEFT JOIN mgr y ON y.user_id = opp""")
oracle("season_finish", "finish", """
    SELECT *, 6::INTEGER AS playoff_teams, (reg_rank <= 6)::INTEGER AS made_playoffs FROM finish""")
oracle("championships", "titles", "SELECT * FROM titles")
oracle("season_champion", "bracket", """
    SELECT season, CASE WHEN w % 11 <> 7 THEN 'u' || w END AS owner_id FROM bracket WHERE p = 1""")
oracle("dynasty", "finish titles mgr", f"""
    SELECT display_name, seasons, career_wins, career_losses,
           {half_up('career_wins::DOUBLE / nullif(career_wins + career_losses, 0)', 3)} AS career_win_pct,
           total_points_for, avg_finish, best_finish, worst_finish, playoff_appearances,
           coalesce(championships, 0) AS championships
    FROM (
        SELECT user_id, count(DISTINCT season) AS seasons, sum(wins)::BIGINT AS career_wins,
               sum(losses)::BIGINT AS career_losses, sum(points_for)::DOUBLE AS total_points_for,
               {half_up('avg(reg_rank)', 1)} AS avg_finish, min(reg_rank) AS best_finish,
               max(reg_rank) AS worst_finish, count(*) FILTER (reg_rank <= 6) AS playoff_appearances
        FROM finish GROUP BY user_id
    ) LEFT JOIN titles USING (user_id) LEFT JOIN mgr USING (user_id)""")

oracle("unit_stats", "unit", """
    SELECT season, w AS week, roster_id, user_id, def_id, def_actual_points, n_stats, sack, interceptions
    FROM unit""")
oracle("scenario_input", "fixed", """
    SELECT season, w AS week, roster_id, user_id, matchup_id, actual_points, non_def_points, def_id,
           is_regular, pts_allow
    FROM fixed""")
oracle("unit_season_totals", "season_stat", "SELECT * FROM season_stat")
oracle("scenario_settings", "setting", f"""
    SELECT * FROM setting WHERE stat IN {LISTED} AND weight IS NOT NULL""")
oracle("settings_fallback", "setting", """
    SELECT season, 10::INTEGER AS playoff_week_start, stat, weight FROM setting""")
oracle("scenario_rescore", "rescored", """
    SELECT scenario_id, season, w AS week, roster_id, user_id, matchup_id, is_regular, actual_points,
           new_points
    FROM rescored""")
oracle("scenario_standings", "rescored mgr", f"""
    , wk AS (SELECT *, median(new_points) OVER (PARTITION BY scenario_id, season, w) AS med FROM rescored),
    one AS (
        SELECT a.scenario_id, a.season, a.w, a.roster_id, any_value(a.user_id) AS user_id,
               any_value(a.new_points) AS points,
               any_value(CASE WHEN a.new_points > a.med THEN 1 WHEN a.new_points = a.med THEN 0.5 ELSE 0 END)
                 + sum(CASE WHEN a.matchup_id = b.matchup_id AND a.roster_id <> b.roster_id
                       THEN CASE WHEN a.new_points > b.new_points THEN 1
                                 WHEN a.new_points = b.new_points THEN 0.5 ELSE 0 END ELSE 0 END) AS wins,
               sum(CASE WHEN a.new_points > b.new_points THEN 1 WHEN a.new_points = b.new_points THEN 0.5
                        ELSE 0 END) - 0.5 AS ap_wins,
               count(*) - 1 AS ap_games
        FROM wk a JOIN wk b ON a.scenario_id = b.scenario_id AND a.season = b.season AND a.w = b.w
        WHERE a.is_regular GROUP BY a.scenario_id, a.season, a.w, a.roster_id
    )
    SELECT scenario_id, season, display_name, points_for, actual_wins, expected_wins,
           {half_up('actual_wins - expected_wins', 1)} AS luck, all_play_pct
    FROM (
        SELECT scenario_id, season, user_id, {half_up('sum(points)', 2)} AS points_for,
               sum(wins)::DOUBLE AS actual_wins,
               coalesce({half_up('sum(ap_wins)::DOUBLE / nullif(sum(ap_games), 0)::DOUBLE * (2 * count(DISTINCT w))', 1)}, 0)
                   AS expected_wins,
               {half_up('sum(ap_wins)::DOUBLE / nullif(sum(ap_games), 0)::DOUBLE', 3)} AS all_play_pct
        FROM one GROUP BY scenario_id, season, user_id
    ) LEFT JOIN mgr USING (user_id)""")
oracle("unit_value_board", "season_stat weights", """
    SELECT scenario_id, season, def_id, value,
           rank() OVER (PARTITION BY scenario_id, season ORDER BY value DESC)::INTEGER AS value_rank
    FROM (
        SELECT scenario_id, season, def_id,
               sum(coalesce(total, 0) * CASE k WHEN 'sack' THEN w_sack WHEN 'int' THEN w_int WHEN 'ff' THEN w_ff
                   WHEN 'fum_rec' THEN w_fum WHEN 'pts_allow' THEN w_allow ELSE 0 END) AS value
        FROM season_stat CROSS JOIN weights GROUP BY ALL
    )""")

oracle("expect_warn", "fm pick", """
    SELECT 'points_non_negative' AS rule, count(*) AS rows, count(*) FILTER (points < 0) AS violations FROM fm
    UNION ALL SELECT 'valid_week', count(*), count(*) FILTER (w < 1 OR w > 18) FROM fm
    UNION ALL SELECT 'regular_has_opponent', count(*), count(*) FILTER (is_regular AND opponent_points IS NULL) FROM fm
    UNION ALL SELECT 'valid_auction_amount', count(*),
        count(*) - count(*) FILTER (TRY_CAST(amount AS INTEGER) BETWEEN 0 AND 200) FROM pick""")
oracle("expect_drop", "pick", "SELECT season, pick_no, player_id FROM pick WHERE player_id IS NOT NULL")
oracle("quarantine", "slots", """
    SELECT season, w AS week, roster_id, user_id, player_id, points, is_starter FROM slots
    WHERE is_starter AND points IS NULL""")
oracle("group_size", "reg", """
    SELECT season, w AS week, matchup_id, count(*) AS cnt FROM reg WHERE matchup_id IS NOT NULL GROUP BY ALL""")
oracle("unique_key", "player", "SELECT player_id, count(*) AS cnt FROM player GROUP BY player_id")
oracle("unique_current", "mgr", "SELECT user_id, count(*) AS cnt FROM mgr GROUP BY user_id")
oracle("one_unit_per_team_week", "unit", """
    SELECT season, w AS week, roster_id, count(*) AS cnt FROM unit GROUP BY ALL""")

CHECKS = {
    "check_team_weeks_have_starters": (
        "reg slots", "a team of the regular season starts somebody every week", "line-ups without any starter",
        """SELECT count(*) AS bad FROM reg WHERE (season, w, roster_id) NOT IN
           (SELECT (season, w, roster_id) FROM slots WHERE is_starter)"""),
    "check_group_size": (
        "reg", "a regular matchup is between two teams", "matchups of another number of teams",
        """SELECT count(*) AS bad FROM (SELECT 1 FROM reg WHERE matchup_id IS NOT NULL
           GROUP BY season, w, matchup_id HAVING count(*) <> 2)"""),
    "check_one_unit": (
        "unit", "a line-up starts at most one unit", "line-ups with several units",
        "SELECT count(*) AS bad FROM (SELECT 1 FROM unit GROUP BY season, w, roster_id HAVING count(*) > 1)"),
    "check_luck_zero_sum": (
        "luck", "luck cancels out within a season, but for rounding", "seasons whose luck does not cancel out",
        f"""SELECT count(*) AS bad FROM (SELECT {half_up('sum(luck)', 3)} AS s, count(*) AS n
            FROM luck GROUP BY season) WHERE abs(s) > 0.05 * n + 1e-9"""),
    "check_unique_current": (
        "mgr", "current manager unique", "duplicated current user_ids",
        "SELECT count(*) AS bad FROM (SELECT 1 FROM mgr GROUP BY user_id HAVING count(*) > 1)"),
    "check_unique_player": (
        "player", "player unique", "duplicated player_ids",
        "SELECT count(*) AS bad FROM (SELECT 1 FROM player GROUP BY player_id HAVING count(*) > 1)"),
    "check_team_weeks_have_unit": (
        "reg unit", "regular team-weeks all have a unit", "regular team-weeks with no started unit",
        """SELECT count(*) AS bad FROM reg r WHERE NOT EXISTS (SELECT 1 FROM unit u
           WHERE u.season = r.season AND u.w = r.w AND u.roster_id = r.roster_id)"""),
}
for _name, (_parts, _title, _what, _bad) in CHECKS.items():
    if _name != "check_team_weeks_have_unit":
        verdict(_name, _parts, _title, _what, _bad)
oracle("reconcile_report", "reg slots unit luck mgr player", " UNION ALL ".join(
    f"SELECT '{title}' AS name, bad, bad = 0 AS ok, bad || ' {what}' AS detail FROM ({bad})"
    for _, title, what, bad in CHECKS.values()))

oracle("season_chain", "years", """
    SELECT (hi - y)::INTEGER AS depth, 'L' || y AS league_id,
           CASE WHEN y = (SELECT lo FROM bounds) THEN '0' ELSE 'L' || (y - 1) END AS previous_league_id,
           y::VARCHAR AS season
    FROM years""")
oracle("manifest", "tw tx pick tally", """
    , f AS (
        SELECT y::VARCHAR AS season, 'm' AS e, m::VARCHAR AS file, count(*) AS n FROM tw GROUP BY ALL
        UNION ALL
        SELECT season, 't', w::VARCHAR, count(DISTINCT o) FROM tx GROUP BY ALL
        UNION ALL
        SELECT season, 'p', draft_id, count(*) FROM pick GROUP BY ALL
        UNION ALL
        SELECT y::VARCHAR, 's', m::VARCHAR, 1 FROM tally GROUP BY y, m
    )
    SELECT season, count(*)::INTEGER AS files, (count(*) FILTER (e = 'm'))::INTEGER AS matchup_weeks,
           (count(*) FILTER (e = 't'))::INTEGER AS transaction_weeks,
           coalesce(sum(n) FILTER (e = 't'), 0)::INTEGER AS transactions,
           coalesce(sum(n) FILTER (e = 'p'), 0)::INTEGER AS draft_picks,
           (count(*) FILTER (e = 's'))::INTEGER AS stat_weeks
    FROM f GROUP BY season""")

oracle("stream_append", "", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
ORACLES["stream_scd1"] = ORACLES["scd1_latest"]
ORACLES["stream_scd2"] = ORACLES["scd2_history"]

oracle("scoring_settings", "years", """
    SELECT y::VARCHAR AS season,
           json_object('sack', 1.0::DOUBLE, 'int', 2.0::DOUBLE, 'ff', CASE WHEN y % 2 = 0 THEN 1.5::DOUBLE END,
                       'pts_allow', ((y - 2000) * 0.25)::DOUBLE, 'safe', NULL, 'off_snp', 4.0::DOUBLE)::VARCHAR
               AS scoring_json,
           10::INTEGER AS playoff_week_start
    FROM years""")


def entries(key: str, value: str) -> str:
    """A JSON object of grouped rows, keys in order."""
    return f"('{{' || string_agg('\"' || {key} || '\":' || coalesce(to_json({value})::VARCHAR, 'null'), ',' ORDER BY {key}) || '}}')"


oracle("publish_season_payload", "fixed setting season_stat stat bracket mgr", f"""
    , settings AS (
        SELECT season, {entries('stat', 'weight')} AS doc FROM setting
        WHERE stat IN {LISTED} AND weight IS NOT NULL GROUP BY season
    ),
    lines AS (
        SELECT season, w, player_id, {entries('k', 'v')} AS doc FROM stat WHERE k IN {LISTED} GROUP BY ALL
    ),
    champion AS (
        SELECT season, 'u' || w AS user_id FROM bracket WHERE p = 1 AND w % 11 <> 7
    ),
    scope AS (SELECT DISTINCT season FROM fixed)
    SELECT season, 'season' AS section, NULL::INTEGER AS week, NULL AS item,
           json_object('playoff_week_start', 10, 'actual_champion', display_name,
                       'def_settings_current', doc::JSON)::VARCHAR AS doc
    FROM scope JOIN settings USING (season) LEFT JOIN champion USING (season) LEFT JOIN mgr USING (user_id)
    UNION ALL
    SELECT f.season, 'team_week', f.w, f.roster_id::VARCHAR,
           json_object('week', f.w, 'user_id', user_id, 'matchup_id', matchup_id, 'actual', actual_points,
                       'non_def', non_def_points, 'def_id', def_id,
                       'def_stats', coalesce(doc, '{{}}')::JSON, 'reg', is_regular)::VARCHAR
    FROM fixed f LEFT JOIN lines l ON l.season = f.season AND l.w = f.w AND l.player_id = f.def_id
    UNION ALL
    SELECT season, 'defense', NULL, def_id, {entries('k', 'total')} FROM season_stat GROUP BY season, def_id
    UNION ALL
    SELECT NULL, 'manager', NULL, user_id, json_object('display_name', display_name)::VARCHAR FROM mgr
    UNION ALL
    SELECT NULL, 'def_settings_proposed', NULL, season, doc FROM settings WHERE season = (SELECT max(season) FROM settings)""")

_PRICED = """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS of_month, o_orderstatus AS status,
           CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS price
    FROM orders"""
PARTS["priced"] = ("", _PRICED)

# Rows below are those before the first of the peers; NULL prices come first.
oracle("order_price_ranks", "priced", """
    SELECT o_orderkey,
           rank() OVER (PARTITION BY of_month ORDER BY price NULLS FIRST) AS month_rank,
           count(*) OVER (PARTITION BY of_month, price) - 1 AS month_peers,
           count(*) OVER (PARTITION BY of_month) AS month_orders,
           rank() OVER (PARTITION BY status ORDER BY price NULLS FIRST) AS status_rank,
           count(*) OVER (PARTITION BY status, price) - 1 AS status_peers,
           count(*) OVER (PARTITION BY status) AS status_orders
    FROM priced""")

oracle("order_price_medians", "priced", """
    SELECT of, sum(price) / count(*) AS median_price
    FROM (SELECT of, price, row_number() OVER (PARTITION BY of ORDER BY price) AS place, count(*) OVER (PARTITION BY of) AS n
          FROM (SELECT of_month AS of, price FROM priced UNION ALL SELECT status, price FROM priced)
          WHERE price IS NOT NULL)
    WHERE place IN ((n + 1) // 2, n // 2 + 1)
    GROUP BY of""")

# -- the raw zone as of its third pull -----------------------------------------------------------

oracle("pulled_matchups", "side", """
    SELECT y::VARCHAR AS season, m::INTEGER AS week, r AS roster_id, CASE WHEN partner <> r THEN least(r, partner) END AS matchup_id,
           pts + CASE WHEN m % 4 = 0 THEN 10 ELSE 0 END AS points
    FROM side WHERE NOT (y % 5 = 0 AND m = 7)""")

oracle("pulled_rosters", "years", """
    SELECT y::VARCHAR AS season, n_nationkey::BIGINT AS roster_id,
           CASE WHEN n_nationkey = 3 AND y >= 1997 THEN 'u99' WHEN n_nationkey % 11 <> 7 THEN 'u' || n_nationkey END AS owner_id
    FROM years, nation""")

oracle("pulled_players", "", """
    SELECT n_nationkey::VARCHAR AS player_id, n_name AS full_name, (2 * count(*))::VARCHAR AS position, NULL::VARCHAR AS team
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")

oracle("unreadable_documents", "years", """
    SELECT y::VARCHAR AS season, 99::INTEGER AS week, pull::BIGINT AS pull, '[{"roster_id": 1, "league": "L' || y AS text
    FROM years, (VALUES (1), (2), (3)) AS pulls(pull)""")

# A run with a broken gate is refused as a whole.
oracle("publication_gates", "years fm reg pick player mgr unit", """
    , seen AS (
        SELECT 'dim_season' AS dataset, 'fail' AS mode, 'season_present' AS rule, count(*) AS rows, 0 AS violations FROM years
        UNION ALL SELECT 'fact_matchup', 'warn', 'points_non_negative', count(*), count(*) FILTER (points < 0) FROM fm
        UNION ALL SELECT 'fact_matchup', 'warn', 'valid_week', count(*), count(*) FILTER (w < 1 OR w > 18) FROM fm
        UNION ALL SELECT 'fact_matchup', 'warn', 'regular_has_opponent', count(*),
            count(*) FILTER (is_regular AND opponent_points IS NULL) FROM fm
        UNION ALL SELECT 'fact_draft_pick', 'warn', 'valid_auction_amount', count(*),
            count(*) - count(*) FILTER (TRY_CAST(amount AS INTEGER) BETWEEN 0 AND 200) FROM pick
        UNION ALL SELECT 'fact_draft_pick', 'drop', 'has_player', count(*), count(*) FILTER (player_id IS NULL) FROM pick
        UNION ALL SELECT 'dq_matchup_group_size', 'fail', 'group_is_2', count(*), count(*) FILTER (cnt <> 2)
            FROM (SELECT count(*) AS cnt FROM reg WHERE matchup_id IS NOT NULL GROUP BY season, w, matchup_id)
        UNION ALL SELECT 'dq_unique_player', 'fail', 'player_unique', count(*), count(*) FILTER (cnt <> 1)
            FROM (SELECT count(*) AS cnt FROM player GROUP BY player_id)
        UNION ALL SELECT 'dq_unique_current_manager', 'fail', 'manager_unique', count(*), count(*) FILTER (cnt <> 1)
            FROM (SELECT count(*) AS cnt FROM mgr GROUP BY user_id)
        UNION ALL SELECT 'dq_one_def_per_team_week', 'fail', 'one_def', count(*), count(*) FILTER (cnt <> 1)
            FROM (SELECT count(*) AS cnt FROM unit GROUP BY season, w, roster_id)
    )
    SELECT *, NOT EXISTS (SELECT 1 FROM seen WHERE mode = 'fail' AND violations > 0) AS published FROM seen""")

# -- landing by content --------------------------------------------------------------------------

_DOCS = """
    SELECT y, m, (y + m) % 11 AS kind, 'season=' || y || '/matchups/' AS folder, 'week=' || m || '.json' AS name,
           '[' || string_agg('{"roster_id":' || r || CASE WHEN partner <> r THEN ',"matchup_id":' || least(r, partner) ELSE '' END
                             || ',"points":' || pts::VARCHAR || '}', ',' ORDER BY r) || ']' AS text
    FROM side GROUP BY y, m"""
PARTS["docs"] = ("side", _DOCS)

oracle("landing_files", "docs", """
    SELECT CASE kind WHEN 4 THEN folder || 'moved-' || name WHEN 5 THEN 'stray-' || y || '-' || name
                     WHEN 7 THEN folder || 'new-' || name ELSE folder || name END AS path,
           CASE kind WHEN 1 THEN 'missing' WHEN 2 THEN 'truncated' WHEN 3 THEN 'changed' WHEN 4 THEN 'renamed'
                     WHEN 5 THEN 'doubled' WHEN 6 THEN 'missing' WHEN 7 THEN 'unexpected' END AS difference
    FROM docs WHERE kind BETWEEN 1 AND 7""")

# Files and bytes: kind 1 is empty and so not there, 2 lacks five bytes, 3 has one more, 5 has a copy outside of seasons, 6 is gone, 7 has a
# second file with three bytes more. A renamed file changes nothing about its season.
oracle("landing_digests", "docs", """
    , landed AS (
        SELECT y::VARCHAR AS season, kind, CASE kind WHEN 1 THEN 0 WHEN 2 THEN strlen(text) - 5 WHEN 3 THEN strlen(text) + 1
                                           WHEN 7 THEN 2 * strlen(text) + 3 ELSE strlen(text) END AS bytes,
               CASE kind WHEN 1 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN 2 ELSE 1 END AS files, strlen(text) AS wanted FROM docs
        UNION ALL SELECT NULL, 5, strlen(text), 1, NULL FROM docs WHERE kind = 5
    )
    SELECT season, nullif(sum(files), 0)::BIGINT AS files, nullif(count(wanted), 0) AS expected_files,
           (sum(bytes) FILTER (files > 0))::BIGINT AS bytes, sum(wanted)::BIGINT AS expected_bytes,
           season IS NOT NULL AND NOT bool_or(kind IN (1, 2, 3, 6, 7)) AS ok
    FROM landed GROUP BY season""")

oracle("season_chains", "years", """
    , bounds2 AS (SELECT min(y) AS lo FROM years),
    leagues AS (
        SELECT n_nationkey || '-' || y AS league_id, y::VARCHAR AS season,
               CASE WHEN y = lo AND n_nationkey = 11 THEN n_nationkey || '-' || (hi - 1) WHEN y = lo THEN '0'
                    ELSE n_nationkey || '-' || (y - CASE WHEN n_nationkey % 7 = 3 THEN 2 ELSE 1 END) END AS previous_league_id,
               n_nationkey AS n, y, lo, hi
        FROM nation, years, bounds2
    ), chains AS (
        SELECT h.league_id AS start, (h.y - l.y) // CASE WHEN h.n % 7 = 3 THEN 2 ELSE 1 END AS depth, l.*
        FROM leagues h JOIN leagues l ON l.n = h.n AND l.y <= h.y AND (h.n % 7 <> 3 OR (h.y - l.y) % 2 = 0)
        WHERE h.y = h.hi OR (h.n % 7 = 3 AND h.y = h.hi - 1)
    )
    SELECT start, depth::BIGINT AS depth, league_id, previous_league_id, season FROM chains""")

oracle("stream_rules", "", """
    SELECT rule, 4::BIGINT AS batches, count(*) AS rows, count(*) FILTER (broken IS NOT FALSE) AS violations
    FROM (SELECT 'known_user' AS rule, NOT (user_id % 50 <> 7) AS broken FROM events
          UNION ALL SELECT 'plausible_value', value < 1 OR value > 90 FROM events
          UNION ALL SELECT 'has_key', (props->>'$.k') = '3' FROM events)
    GROUP BY rule""")

oracle("scenario_rescore_many", "fixed", """
    , w AS (
        SELECT 'size ' || p_size AS scenario_id,
               sum(CASE WHEN p_partkey % 6 = 0 THEN (p_partkey % 9 - 4) * 0.25 ELSE 0 END)::DOUBLE AS w_sack,
               sum(CASE WHEN p_partkey % 6 = 1 THEN (p_partkey % 9 - 4) * 0.25 ELSE 0 END)::DOUBLE AS w_int,
               sum(CASE WHEN p_partkey % 6 = 2 THEN (p_partkey % 9 - 4) * 0.25 ELSE 0 END)::DOUBLE AS w_ff,
               sum(CASE WHEN p_partkey % 6 = 3 THEN (p_partkey % 9 - 4) * 0.25 ELSE 0 END)::DOUBLE AS w_fum,
               sum(CASE WHEN p_partkey % 6 = 4 THEN (p_partkey % 9 - 4) * 0.25 ELSE 0 END)::DOUBLE AS w_allow
        FROM part GROUP BY p_size
    )
    SELECT scenario_id, season, f.w AS week, roster_id, user_id, matchup_id, is_regular, actual_points,
           non_def_points + coalesce(sack, 0) * w_sack + coalesce(interceptions, 0) * w_int + coalesce(ff, 0) * w_ff
               + coalesce(fum_rec, 0) * w_fum + coalesce(pts_allow, 0) * w_allow AS new_points
    FROM fixed f CROSS JOIN w""")
