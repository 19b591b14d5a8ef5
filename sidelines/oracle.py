"""The registered queries in DuckDB's SQL, over the same star-schema tables, written separately from the Spark code."""

from __future__ import annotations

import re

from sidelines.sources import conferences

# Named subqueries; each query gets the ones it mentions, and those that they mention.
_CTE = {
    "sides": "SELECT l_orderkey, l_suppkey, CAST(sum(l_quantity) AS INTEGER) AS q FROM lineitem GROUP BY 1, 2",
    "pairs": "SELECT l_orderkey, min(l_suppkey) AS lo, max(l_suppkey) AS hi FROM sides GROUP BY 1 HAVING count(*) >= 2",
    "games": """
        SELECT printf('%010d', o_orderkey) AS game_id, o_orderkey AS k, CAST(o_orderdate AS DATE) AS game_date,
               CASE WHEN month(o_orderdate) >= 8
                    THEN year(o_orderdate) || '-' || printf('%02d', (year(o_orderdate) + 1) % 100)
                    ELSE (year(o_orderdate) - 1) || '-' || printf('%02d', year(o_orderdate) % 100) END AS season,
               h.l_suppkey AS home_team_id, a.l_suppkey AS away_team_id,
               CASE WHEN o_orderdate < TIMESTAMP '2001-06-01' THEN h.q END AS home_score,
               CASE WHEN o_orderdate < TIMESTAMP '2001-06-01' THEN a.q END AS away_score
        FROM orders JOIN pairs p ON p.l_orderkey = o_orderkey
        JOIN sides h ON h.l_orderkey = o_orderkey AND h.l_suppkey = CASE WHEN o_orderkey % 2 = 0 THEN lo ELSE hi END
        JOIN sides a ON a.l_orderkey = o_orderkey AND a.l_suppkey = CASE WHEN o_orderkey % 2 = 0 THEN hi ELSE lo END""",
    "done": "SELECT * FROM games WHERE home_score IS NOT NULL",
    "teams": """
        SELECT s_suppkey AS team_id, 'T' || printf('%04d', s_suppkey) AS abbreviation, s_name AS name,
               CASE WHEN n_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS conference, r_name AS division
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "players": """
        SELECT p_partkey AS player_id, p_name || ' #' || p_partkey AS full_name,
               CASE WHEN p_size % 10 = 0 THEN NULL
                    ELSE DATE '1962-01-01' + CAST(p_partkey * 37 % 6000 AS INTEGER) END AS birth_date
        FROM part""",
    "first_lines": """
        SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_partkey, l_orderkey
            ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice) = 1""",
    "shots": """
        SELECT *, CAST(l_quantity AS INTEGER) % 20 AS fga, l_linenumber % 3 AS fta,
               CAST(floor((CAST(l_quantity AS INTEGER) % 20) * (30 + 5 * CAST(round(100 * l_discount) AS INTEGER))
                          / 100.0) AS INTEGER) AS fgm
        FROM first_lines""",
    "stats": """
        SELECT l_partkey AS player_id, printf('%010d', l_orderkey) AS game_id, l_suppkey AS team_id,
               l_quantity AS minutes, 2 * fgm + fta AS points, fgm, fga, fta,
               CASE WHEN fga + fta > 0
                    THEN (2 * fgm + fta) / (2 * (fga + CAST(0.44 AS DOUBLE) * fta)) END AS ts
        FROM shots""",
    "tracking": """
        SELECT l_partkey AS player_id, printf('%010d', l_orderkey) AS game_id,
               round(100 * l_tax) / 2 AS distance_miles
        FROM first_lines WHERE l_returnflag = 'A'""",
    "long": """
        SELECT game_id, game_date, season, home_team_id AS team_id, away_team_id AS opponent_id,
               home_score AS team_score, away_score AS opponent_score, true AS is_home FROM games
        UNION ALL
        SELECT game_id, game_date, season, away_team_id, home_team_id, away_score, home_score, false FROM games""",
    "form": """
        SELECT game_id, game_date, season, team_id, opponent_id, is_home,
               CAST(team_score > opponent_score AS INTEGER) AS won,
               avg(CAST(team_score > opponent_score AS INTEGER)) OVER prior10 AS rolling_win_pct,
               avg(team_score - opponent_score) OVER prior10 AS rolling_point_diff,
               CAST(game_date - lag(game_date) OVER (PARTITION BY team_id ORDER BY game_date, game_id) AS INTEGER)
                   AS days_rest
        FROM long WHERE team_score IS NOT NULL
        WINDOW prior10 AS (PARTITION BY team_id ORDER BY game_date, game_id
                           ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""",
    "tf": """
        SELECT f.*, CASE WHEN f.days_rest <= 1 THEN 1 ELSE 0 END AS is_back_to_back,
               o.rolling_win_pct AS opponent_rolling_win_pct, o.days_rest AS opponent_days_rest,
               CASE WHEN o.days_rest <= 1 THEN 1 ELSE 0 END AS opponent_is_back_to_back,
               coalesce(f.days_rest, 0) - coalesce(o.days_rest, 0) AS rest_advantage
        FROM form f LEFT JOIN form o ON o.game_id = f.game_id AND o.team_id = f.opponent_id""",
    "outings": """
        SELECT s.player_id, s.game_id, s.team_id, s.minutes, s.points, s.ts, g.game_date, g.season,
               s.minutes + 5 * coalesce(t.distance_miles, 0) AS load_index
        FROM stats s LEFT JOIN done g ON g.game_id = s.game_id
        LEFT JOIN tracking t ON t.player_id = s.player_id AND t.game_id = s.game_id""",
    "pw": """
        SELECT *, count(ts) OVER p5 AS n5, avg(ts) OVER p5 AS m5, avg(minutes) OVER p5 AS rolling_minutes,
               avg(load_index) OVER p5 AS rolling_load_index, lag(game_date) OVER p AS previous,
               count(ts) OVER s AS ns, avg(ts) OVER s AS ms
        FROM outings
        WINDOW p AS (PARTITION BY player_id ORDER BY game_date NULLS LAST, game_id),
               p5 AS (PARTITION BY player_id ORDER BY game_date NULLS LAST, game_id
                      ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
               s AS (PARTITION BY player_id, season ORDER BY game_date NULLS LAST, game_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "pb": """
        SELECT player_id, game_id, game_date, season, team_id, minutes, points, ts AS ts_pct, load_index,
               CASE WHEN n5 >= 2 THEN m5 END AS rolling_ts_pct,
               CASE WHEN ns >= 2 AND season IS NOT NULL THEN ms END AS season_to_date_ts_pct,
               rolling_minutes, rolling_load_index, CAST(game_date - previous AS INTEGER) AS days_rest
        FROM pw""",
    "pf": """
        SELECT b.*, rolling_ts_pct - season_to_date_ts_pct AS ts_pct_decline_gap,
               CASE WHEN days_rest <= 1 THEN 1 ELSE 0 END AS is_back_to_back, full_name,
               CAST(game_date - birth_date AS INTEGER) / CAST(365.25 AS DOUBLE) AS age_years
        FROM pb b LEFT JOIN players p ON p.player_id = b.player_id""",
    "latest": """
        SELECT *, season_to_date_ts_pct - rolling_ts_pct AS decline_gap FROM pf
        QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC NULLS FIRST, game_id DESC) = 1""",
    "shooting": """
        SELECT game_id, team_id, CASE WHEN sum(fga) > 0 THEN CAST(sum(fgm) AS DOUBLE) / CAST(sum(fga) AS DOUBLE) END AS pct
        FROM stats GROUP BY 1, 2""",
    "loads": """
        SELECT s.player_id, s.game_id, s.ts, s.minutes + 5 * coalesce(t.distance_miles, 0) AS load_index,
               lead(s.ts) OVER (PARTITION BY s.player_id ORDER BY g.game_date, s.game_id) AS next_ts
        FROM stats s JOIN games g ON g.game_id = s.game_id
        LEFT JOIN tracking t ON t.player_id = s.player_id AND t.game_id = s.game_id
        WHERE s.minutes >= 10""",
    "player_seasons": """
        SELECT s.player_id, g.season, avg(s.points) AS pts, avg(s.ts) AS ts,
               CAST(date_part('year', age(make_date(CAST(split_part(g.season, '-', 1) AS INTEGER), 10, 1),
                                          p.birth_date)) AS INTEGER) AS age_at_season_start
        FROM stats s JOIN games g ON g.game_id = s.game_id JOIN players p ON p.player_id = s.player_id
        WHERE p.birth_date IS NOT NULL GROUP BY s.player_id, g.season, p.birth_date""",
    "predictions": """
        SELECT game_id, k, 1 + k % 2 AS model_version_id, (k * 7919 % 1000) / CAST(1000 AS DOUBLE) AS prob,
               k * 7919 % 1000 >= 500 AS predicted_label,
               CASE WHEN k % 3 = 0 THEN k % 6 = 0 END AS known
        FROM games""",
    "labelled": """
        SELECT p.*, g.game_date,
               CASE WHEN p.known IS NOT NULL THEN p.known
                    WHEN g.home_score IS NOT NULL THEN g.home_score > g.away_score END AS actual
        FROM predictions p JOIN games g ON g.game_id = p.game_id""",
    "scored": """
        SELECT *, least(greatest(prob, 0.000001::DOUBLE), 0.999999::DOUBLE) AS p, CAST(actual AS INTEGER) AS y
        FROM labelled WHERE actual IS NOT NULL""",
    "weekly": """
        SELECT model_version_id, CAST(date_trunc('week', game_date) AS DATE) AS week_start, count(*) AS n_predictions,
               avg(CAST(predicted_label = actual AS INTEGER)) AS accuracy,
               -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS log_loss, avg((p - y) * (p - y)) AS brier_score
        FROM scored GROUP BY 1, 2""",
    "raw_teams": """
        SELECT CASE WHEN s_suppkey % 11 <> 10 THEN s_suppkey END AS team_id,
               CASE WHEN s_suppkey % 7 <> 3 THEN 'T' || printf('%04d', s_suppkey) END AS abbreviation, s_name AS name,
               CASE n_regionkey WHEN 4 THEN 'North' WHEN 1 THEN 'West' WHEN 0 THEN 'East' WHEN 2 THEN 'East' END
                   AS conference
        FROM supplier JOIN nation ON n_nationkey = s_nationkey, LATERAL (
            SELECT unnest(CASE WHEN s_suppkey % 5 = 0 THEN [1, 2] ELSE [1] END) AS copy)""",
    "raw_players": """
        SELECT l_partkey AS player_id, CASE WHEN l_partkey % 13 <> 5 THEN 'Player ' || l_partkey END AS full_name,
               CASE WHEN l_linenumber <> 4 THEN l_suppkey END AS team_id, CAST(year(l_shipdate) AS INTEGER) AS season,
               l_orderkey AS r, l_linenumber AS l, l_quantity AS q
        FROM lineitem""",
    "raw_games": """
        SELECT CASE WHEN k % 19 <> 7 THEN game_id END AS game_id, game_date, season, home_team_id,
               CASE WHEN k % 11 = 4 THEN home_team_id ELSE away_team_id END AS away_team_id,
               CASE WHEN k % 13 = 6 THEN -5 ELSE home_score END AS home_score,
               CASE WHEN k % 17 <> 9 THEN away_score END AS away_score,
               unnest(CASE WHEN k % 4 = 0 THEN [1, 2] ELSE [1] END) AS copy
        FROM games""",
    "judged_games": """
        SELECT *, CASE WHEN game_id IS NULL THEN 'missing game_id or game_date or home_team_id or away_team_id'
                       WHEN home_team_id = away_team_id THEN 'home and away team are the same'
                       WHEN home_score IS NOT NULL AND (home_score < 0 OR away_score IS NULL OR away_score < 0)
                       THEN 'negative score' END AS reason
        FROM raw_games""",
    "raw_stats": """
        SELECT l_partkey AS player_id, printf('%010d', l_orderkey) AS game_id,
               CASE WHEN l_quantity <> 13 THEN l_suppkey END AS team_id,
               CASE WHEN l_quantity = 7 THEN 0 ELSE l_quantity END AS minutes,
               CASE WHEN l_linenumber = 5 THEN 0 ELSE l_quantity % 20 END AS points,
               l_quantity % 9 AS fgm, CASE WHEN l_quantity = 30 THEN 0 ELSE l_quantity % 20 + l_linenumber END AS fga,
               CAST(l_linenumber % 3 AS DOUBLE) AS ftm, CAST(2 AS DOUBLE) AS fta,
               CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS INTEGER) - 25 END AS plus_minus,
               l_linenumber, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem""",
    "judged_stats": """
        SELECT *, CASE WHEN team_id IS NULL THEN 'missing player_id or game_id or team_id'
                       WHEN fgm > fga THEN 'fgm > fga' WHEN ftm > fta THEN 'ftm > fta' END AS reason
        FROM raw_stats""",
    "raw_tracking": """
        SELECT l_partkey AS player_id, printf('%010d', l_orderkey) AS game_id,
               CASE WHEN l_linenumber <> 7 THEN round(100 * l_tax) * 1.5::DOUBLE END AS distance_miles,
               l_quantity / 3 AS avg_speed_mph, l_linenumber, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem""",
    "judged_tracking": """
        SELECT *, CASE WHEN distance_miles IS NULL OR distance_miles > 10 THEN 'implausible distance'
                       WHEN avg_speed_mph > 15 THEN 'implausible speed' END AS reason
        FROM raw_tracking""",
    "requests": """
        SELECT game_id, (k % 120) / 100.0::DOUBLE AS w, (k % 101) / 100.0::DOUBLE AS ow,
               CASE WHEN k % 5 <> 0 THEN k % 8 END AS days_rest,
               CASE WHEN k % 7 <> 0 THEN CAST(k % 3 AS INTEGER) END AS b2b,
               CASE WHEN k % 11 <> 0 THEN k % 9 - 4 END AS advantage
        FROM games""",
    "bio": """
        SELECT p_partkey AS player_id, left(p_type || '-' || p_name, 20) AS position,
               CASE WHEN p_size % 7 <> 0 THEN DATE '1970-01-01' + CAST(p_partkey % 9000 AS INTEGER) END AS birth_date,
               CASE WHEN p_size % 5 <> 0 THEN CAST(12 * (5 + p_size % 3) + p_partkey % 12 AS INTEGER) END AS height_inches,
               CASE WHEN p_size % 4 <> 0 THEN CAST(150 + p_partkey % 150 AS INTEGER) END AS weight_lbs
        FROM part""",
    "codes": """
        SELECT s_suppkey, coalesce(l.abbreviation, 'X' || s_suppkey % 45) AS abbreviation
        FROM supplier LEFT JOIN (SELECT *, row_number() OVER (ORDER BY abbreviation) - 1 AS slot FROM lookup) l
        ON l.slot = s_suppkey % 45""",
    "lookup": "SELECT * FROM (VALUES {lookup}) AS v(abbreviation, conference, division)",
}

_KEPT_ORDER = "l_linenumber, l_suppkey, l_quantity, l_extendedprice"


def _r(column: str, places: int = 6, name: str | None = None) -> str:
    """Round as a decimal, give a double."""
    return f"CAST(round(CAST({column} AS DECIMAL(28,9)), {places}) AS DOUBLE) AS {name or column}"


def _ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))"


_SPLITS = """
    SELECT h.team_id, abbreviation, h.games AS hg, h.wins AS hw, h.margin AS hm, a.games AS ag, a.wins AS aw, a.margin AS am
    FROM teams t
    JOIN (SELECT home_team_id AS team_id, count(*) AS games, count(*) FILTER (WHERE home_score > away_score) AS wins,
                 avg(home_score - away_score) AS margin FROM done GROUP BY 1) h ON h.team_id = t.team_id
    JOIN (SELECT away_team_id AS team_id, count(*) AS games, count(*) FILTER (WHERE away_score > home_score) AS wins,
                 avg(away_score - home_score) AS margin FROM done GROUP BY 1) a ON a.team_id = t.team_id"""

_REST = "CASE days_rest WHEN 1 THEN '{one}' WHEN 2 THEN '2 days rest' ELSE '3+ days rest' END"

_QUARTILES = """
    SELECT {label} AS load_quartile, {avg}, count(*) AS n
    FROM (SELECT *, ntile(4) OVER (ORDER BY load_index, player_id, game_id) AS quartile FROM {source})
    WHERE next_ts IS NOT NULL GROUP BY quartile"""

_AGE = f"""
    SELECT age_at_season_start, count(DISTINCT player_id) AS n_players,
           {_r('avg(pts)', 2, 'league_avg_pts_at_age')}, {_r('avg(ts)', 3, 'league_avg_ts_pct_at_age')}"""

_TF_COLUMNS = f"""game_id, game_date, season, team_id, opponent_id, is_home, won, {_r('rolling_win_pct')},
    {_r('rolling_point_diff')}, days_rest, is_back_to_back, {_r('opponent_rolling_win_pct')}"""

_FORM_COMPLETE = "rolling_win_pct IS NOT NULL AND rolling_point_diff IS NOT NULL AND opponent_rolling_win_pct IS NOT NULL"

_OUTCOME = f"""{_r('rolling_win_pct')}, {_r('rolling_point_diff')}, is_home, {_r('opponent_rolling_win_pct')},
    days_rest, is_back_to_back, rest_advantage"""

_DECLINE_ROWS = """
    SELECT player_id, game_id, CAST(season_to_date_ts_pct - ts_pct > CAST(0.05 AS DOUBLE) AS INTEGER) AS decline_flag
    FROM pf WHERE ts_pct IS NOT NULL AND season_to_date_ts_pct IS NOT NULL AND rolling_ts_pct IS NOT NULL
      AND rolling_minutes IS NOT NULL AND rolling_load_index IS NOT NULL AND days_rest IS NOT NULL
      AND age_years IS NOT NULL"""

_METRIC_ROUNDED = f"n_predictions, {_r('accuracy')}, {_r('log_loss')}, {_r('brier_score')}"

_SQL = {
    "rolling_team_win_pct": f"""
        SELECT l.team_id, abbreviation, game_date, game_id, team_score > opponent_score AS won,
               {_r('avg(CAST(team_score > opponent_score AS INTEGER)) OVER w', 3, 'rolling_10_win_pct')},
               count(*) OVER w AS games_in_window
        FROM long l JOIN teams t ON t.team_id = l.team_id WHERE team_score IS NOT NULL
        WINDOW w AS (PARTITION BY l.team_id ORDER BY game_date, game_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "player_efficiency_decline": f"""
        SELECT player_id, full_name, game_id, game_date, {_r('ts', 3, 'ts_pct')}, {_r('recent', 3, 'rolling_5_ts_pct')},
               {_r('base', 3, 'season_to_date_ts_pct')}, {_r('recent - base', 3, 'decline_gap')}
        FROM (SELECT s.player_id, full_name, s.game_id, game_date, ts, avg(ts) OVER (w ROWS 4 PRECEDING) AS recent,
                     avg(ts) OVER (w ROWS UNBOUNDED PRECEDING) AS base
              FROM stats s JOIN games g ON g.game_id = s.game_id JOIN players p ON p.player_id = s.player_id
              WHERE minutes >= 10
              WINDOW w AS (PARTITION BY s.player_id ORDER BY game_date, s.game_id))
        WHERE recent < base - CAST(0.05 AS DOUBLE)""",
    "home_away_splits": f"""
        SELECT team_id, abbreviation, hg AS home_games, hw AS home_wins, {_r(_ratio('hw', 'hg'), 3, 'home_win_pct')},
               {_r('hm', 2, 'home_avg_margin')}, ag AS away_games, aw AS away_wins,
               {_r(_ratio('aw', 'ag'), 3, 'away_win_pct')}, {_r('am', 2, 'away_avg_margin')},
               {_r(_ratio('hw', 'hg') + ' - ' + _ratio('aw', 'ag'), 3, 'home_court_edge')}
        FROM ({_SPLITS})""",
    "home_edge": f"""
        SELECT abbreviation, {_r(_ratio('hw', 'hg') + ' - ' + _ratio('aw', 'ag'), 3, 'home_court_edge')} FROM ({_SPLITS})""",
    "back_to_back_fatigue": f"""
        SELECT {_REST.format(one='back_to_back (1 day rest)')} AS rest_bucket, count(*) AS n_games,
               {_r('avg(pct)', 4, 'avg_team_fg_pct')}
        FROM form f JOIN shooting s ON s.game_id = f.game_id AND s.team_id = f.team_id
        WHERE days_rest IS NOT NULL GROUP BY 1""",
    "b2b_summary": f"""
        SELECT {_REST.format(one='Back-to-back (1 day rest)')} AS rest_bucket, min(days_rest) AS sort_key,
               count(*) AS n_games, {_r('avg(pct)', 4, 'avg_team_fg_pct')}
        FROM form f JOIN shooting s ON s.game_id = f.game_id AND s.team_id = f.team_id
        WHERE days_rest IS NOT NULL GROUP BY 1""",
    "team_shooting": f"SELECT game_id, team_id, {_r('pct', 6, 'team_fg_pct')} FROM shooting",
    "load_next_corr": f"""
        SELECT {_r('corr(load_index, next_ts)', 6, 'load_vs_next_game_ts_corr')}, count(*) AS n_observations
        FROM loads WHERE next_ts IS NOT NULL""",
    "load_quartiles": _QUARTILES.format(label="CAST(quartile AS INTEGER)", source="loads",
                                        avg=_r("avg(next_ts)", 3, "avg_next_game_ts_pct")),
    "load_quartile_dashboard": _QUARTILES.format(
        label="CASE quartile WHEN 1 THEN 'Q1 (lowest)' WHEN 4 THEN 'Q4 (highest)' ELSE 'Q' || quartile END",
        avg=_r("avg(next_ts)", 3, "avg_next_game_ts_pct"),
        source="""(SELECT *, lead(ts_pct) OVER (PARTITION BY player_id ORDER BY game_date NULLS LAST, game_id) AS next_ts
                   FROM pf)"""),
    "aging_curve": _AGE + f""", {_r('avg(pts - last_pts)', 2, 'avg_yoy_pts_change')},
               {_r('avg(ts - last_ts)', 3, 'avg_yoy_ts_pct_change')}
        FROM (SELECT *, lag(pts) OVER c AS last_pts, lag(ts) OVER c AS last_ts FROM player_seasons
              WINDOW c AS (PARTITION BY player_id ORDER BY season))
        WHERE age_at_season_start BETWEEN 20 AND 40 GROUP BY 1""",
    "aging_summary": _AGE + " FROM player_seasons WHERE age_at_season_start BETWEEN 20 AND 40 GROUP BY 1",
    "form_buckets": f"""
        SELECT form_bucket, count(*) AS n_games, {_r('avg(won)', 4, 'win_rate')}
        FROM (SELECT won, 'hot (>= .700)' AS form_bucket FROM form WHERE rolling_win_pct >= 0.7::DOUBLE
              UNION ALL SELECT won, 'average (.450-.550)' FROM form
                        WHERE rolling_win_pct >= 0.45::DOUBLE AND rolling_win_pct <= 0.55::DOUBLE
              UNION ALL SELECT won, 'cold (<= .300)' FROM form WHERE rolling_win_pct <= 0.3::DOUBLE) GROUP BY 1""",
    "team_features": f"SELECT {_TF_COLUMNS} FROM tf",
    "player_features": f"""
        SELECT player_id, full_name, game_id, game_date, season, team_id, {_r('minutes')}, points, {_r('ts_pct')},
               {_r('rolling_ts_pct')}, {_r('season_to_date_ts_pct')}, {_r('ts_pct_decline_gap')}, {_r('rolling_minutes')},
               {_r('load_index')}, {_r('rolling_load_index')}, days_rest, is_back_to_back, {_r('age_years')}
        FROM pf""",
    "opponent_form": f"SELECT game_id, team_id, opponent_id, {_r('opponent_rolling_win_pct')} FROM tf",
    "latest_per_player": f"SELECT player_id, game_id, {_r('decline_gap')} FROM latest",
    "decline_flags": f"""
        SELECT player_id, full_name, {_r('rolling_ts_pct', 3)}, {_r('season_to_date_ts_pct', 3)}, {_r('decline_gap', 3)},
               {_r('rolling_load_index', 3)}, {_r('age_years', 3)}
        FROM latest WHERE decline_gap > CAST(0.05 AS DOUBLE)""",
    "risk_landscape": f"""
        SELECT player_id, full_name, {_r('age_years')}, {_r('decline_gap')}, {_r('rolling_load_index')} FROM latest
        WHERE age_years IS NOT NULL AND decline_gap IS NOT NULL AND rolling_load_index IS NOT NULL""",
    "gap_histogram": """
        SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(40, 1 + (gap - lo) * 40 // (hi - lo)) END AS INTEGER) AS bin,
               count(*) AS n_players
        FROM (SELECT *, min(gap) OVER () AS lo, max(gap) OVER () AS hi
              FROM (SELECT CAST(round(CAST(decline_gap AS DECIMAL(28,9)), 6) * 1000000 AS BIGINT) AS gap
                    FROM latest WHERE decline_gap IS NOT NULL))
        GROUP BY 1""",
    "team_trend": f"""
        SELECT abbreviation, game_date, game_id, {_r('rolling_win_pct')}, {_r('rolling_point_diff')}
        FROM form f LEFT JOIN teams t ON t.team_id = f.team_id""",
    "b2b_count": """
        SELECT abbreviation, CAST(sum(is_back_to_back) AS BIGINT) AS n_back_to_back
        FROM tf JOIN teams t ON t.team_id = tf.team_id GROUP BY 1""",
    "distinct_sorted": "SELECT DISTINCT full_name FROM players WHERE full_name IS NOT NULL ORDER BY 1",
    "completed_scan": "SELECT game_id, game_date, home_team_id, away_team_id FROM done",
    "date_range_slice": """
        SELECT game_id, game_date FROM games WHERE game_date >= DATE '1997-01-01' AND game_date <= DATE '1997-12-31'""",
    "team_long": "SELECT *, team_score > opponent_score AS won FROM long",
    "ts_pct": f"SELECT player_id, game_id, {_r('ts', 6, 'ts_pct')} FROM stats",
    "load_index": f"""
        SELECT s.player_id, s.game_id, {_r('minutes + 5 * coalesce(distance_miles, 0)', 6, 'load_index')}
        FROM stats s LEFT JOIN tracking t ON t.player_id = s.player_id AND t.game_id = s.game_id""",
    "season_label": """
        SELECT o_orderkey, y || '-' || right(CAST(y + 1 AS VARCHAR), 2) AS season_by_year,
               (y - early) || '-' || right(CAST(y - early + 1 AS VARCHAR), 2) AS season_by_date
        FROM (SELECT o_orderkey, year(o_orderdate) AS y, CAST(month(o_orderdate) < 8 AS INTEGER) AS early FROM orders)""",
    "pad_id": """
        SELECT o_orderkey, CASE WHEN length(s) >= 10 THEN s ELSE repeat('0', 10 - length(s)) || s END AS padded
        FROM (SELECT o_orderkey, o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '777777777' END AS s FROM orders)""",
    "parse_minutes": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               CASE l_linenumber WHEN 1 THEN clock WHEN 2 THEN l_quantity WHEN 3 THEN clock WHEN 4 THEN l_quantity
                    ELSE 0 END AS bulk_minutes,
               CASE l_linenumber WHEN 1 THEN clock WHEN 2 THEN l_quantity WHEN 4 THEN l_quantity + 0.5::DOUBLE
                    ELSE 0 END AS live_minutes
        FROM (SELECT *, round(l_quantity + (l_orderkey % 60) / 60, 2) AS clock FROM lineitem)""",
    "parse_bio": "SELECT * FROM bio",
    "sink_rounding": """
        SELECT game_id, CAST(round(CAST(prob / 7 AS DECIMAL(28,9)), 4) AS DECIMAL(5,4)) AS prob,
               CAST(round(CAST(prob * 97 / 9 AS DECIMAL(28,9)), 4) AS DECIMAL(7,4)) AS metric
        FROM predictions""",
    "teams_validate": """
        SELECT DISTINCT team_id, abbreviation, name FROM raw_teams
        WHERE team_id IS NOT NULL AND abbreviation IS NOT NULL AND name IS NOT NULL""",
    "players_validate": """
        SELECT player_id, full_name, team_id, season FROM raw_players WHERE full_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY player_id
            ORDER BY season, r, l, team_id NULLS LAST, q) = 1""",
    "games_validate": """
        SELECT DISTINCT game_id, game_date, season, home_team_id, away_team_id, home_score, away_score
        FROM judged_games WHERE reason IS NULL""",
    "stats_validate": f"""
        SELECT player_id, game_id, team_id, minutes, points, fgm, fga, ftm, fta, plus_minus
        FROM judged_stats WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY player_id, game_id ORDER BY {_KEPT_ORDER}) = 1""",
    "tracking_validate": f"""
        SELECT player_id, game_id, distance_miles, {_r('avg_speed_mph')} FROM judged_tracking WHERE reason IS NULL
        QUALIFY row_number() OVER (PARTITION BY player_id, game_id ORDER BY {_KEPT_ORDER}) = 1""",
    "dedupe_first": """
        SELECT l_partkey AS player_id, printf('%010d', l_orderkey) AS game_id, l_linenumber AS source_line,
               l_suppkey AS source_team FROM first_lines""",
    "reject_report": """
        SELECT 'teams' AS table_name, 'missing team_id or abbreviation or name' AS reason, count(*) AS n_rows
        FROM raw_teams WHERE team_id IS NULL OR abbreviation IS NULL HAVING count(*) > 0
        UNION ALL SELECT 'games', reason, count(*) FROM judged_games WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'player_game_stats', reason, count(*) FROM judged_stats WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'player_tracking_stats', reason, count(*) FROM judged_tracking
                  WHERE reason IS NOT NULL GROUP BY 2""",
    "implausible_ids": """
        SELECT player_id, CASE WHEN player_id <= 9999999 THEN NULL ELSE 'implausible player id' END AS reason,
               count(*) AS n_rows
        FROM (SELECT CASE l_linenumber WHEN 6 THEN NULL WHEN 3 THEN l_partkey * 10000000 ELSE l_partkey END AS player_id
              FROM lineitem) GROUP BY 1""",
    "fk_violations": "SELECT player_id, game_id FROM stats WHERE game_id NOT IN (SELECT game_id FROM games)",
    "dup_keys": """
        SELECT player_id, game_id, count(*) AS n_rows FROM raw_stats GROUP BY 1, 2 HAVING count(*) > 1""",
    "domain_violations": """
        SELECT 'unknown conference' AS reason, count(*) AS n_rows FROM raw_teams
        WHERE conference NOT IN ('East', 'West') HAVING count(*) > 0
        UNION ALL
        SELECT CASE WHEN w > 1 THEN 'rolling_win_pct outside 0..1' ELSE 'is_back_to_back outside 0..1' END, count(*)
        FROM requests WHERE w > 1 OR b2b > 1 GROUP BY 1""",
    "upsert": """
        SELECT team_id, abbreviation,
               CASE WHEN team_id % 4 < 2 OR team_id % 10 >= 7 THEN 'New ' || name ELSE name END AS name,
               CASE WHEN team_id % 10 < 7 THEN conference END AS conference,
               CASE WHEN (team_id % 4 >= 2 AND team_id % 10 < 7) OR team_id % 3 <> 0 THEN division END AS division
        FROM teams""",
    "insert_if_absent": f"""
        SELECT game_id, model_version_id,
               {_r('CASE WHEN k % 5 < 3 THEN prob ELSE 1 - prob END', 6, 'predicted_home_win_prob')},
               predicted_label, known AS actual_label FROM predictions""",
    "bio_backlog": "SELECT player_id, full_name FROM players WHERE birth_date IS NULL",
    "bio_backlog_next": "SELECT player_id, full_name FROM players WHERE birth_date IS NULL ORDER BY player_id LIMIT 500",
    "bio_update": """
        SELECT p.player_id, full_name, coalesce(p.birth_date, b.birth_date) AS birth_date,
               CASE WHEN p.birth_date IS NULL THEN position END AS position,
               CASE WHEN p.birth_date IS NULL THEN height_inches END AS height_inches,
               CASE WHEN p.birth_date IS NULL THEN weight_lbs END AS weight_lbs
        FROM players p LEFT JOIN bio b ON b.player_id = p.player_id AND b.player_id % 3 <> 0""",
    "ref_lookup_join": """
        SELECT s_suppkey, c.abbreviation, conference, division
        FROM codes c LEFT JOIN lookup l ON l.abbreviation = c.abbreviation""",
    "unmapped_keys": "SELECT DISTINCT abbreviation FROM codes WHERE abbreviation LIKE 'X%'",
    "latest_team_per_player": """
        SELECT player_id, team_id, season FROM raw_players
        QUALIFY row_number() OVER (PARTITION BY player_id
            ORDER BY season DESC, r DESC, l DESC, team_id DESC NULLS FIRST, q DESC) = 1""",
    "supplement_missing": """
        SELECT player_id, full_name, NULL::BIGINT AS team_id FROM players WHERE player_id % 4 <> 1
        UNION ALL
        SELECT player_id, full_name, team_id
        FROM (SELECT * FROM raw_players QUALIFY row_number() OVER (
                  PARTITION BY player_id ORDER BY r, l, team_id NULLS LAST, q) = 1)
        WHERE player_id NOT IN (SELECT player_id FROM players WHERE player_id % 4 <> 1)""",
    "scoreboard_merge": """
        SELECT g.game_id, g.game_date, g.season, g.home_team_id, g.away_team_id, h.score AS home_score, a.score AS away_score
        FROM games g LEFT JOIN day_scores h ON h.game_date = g.game_date AND h.team_id = g.home_team_id
        LEFT JOIN day_scores a ON a.game_date = g.game_date AND a.team_id = g.away_team_id""",
    "bulk_load_teams": "SELECT * FROM bulk_teams",
    "bulk_load_players": "SELECT * FROM bulk_players",
    "bulk_load_games": """
        SELECT *, 'Regular Season' AS season_type, home_score > away_score AS home_win FROM bulk_games""",
    "bulk_load_stats": """
        SELECT player_id, game_id, team_id, minutes, points, CAST(0 AS DOUBLE) AS rebounds, fgm, fga, ftm, fta,
               CAST(plus_minus AS DOUBLE) AS plus_minus, l_linenumber <= 2 AS started
        FROM judged_lines WHERE reason IS NULL AND waits IS NULL""",
    "bulk_load_report": """
        SELECT DISTINCT 'teams' AS table_name, 'no conference for ' || abbreviation AS reason, CAST(0 AS BIGINT) AS n_rows
        FROM bulk_teams WHERE conference IS NULL
        UNION ALL SELECT 'teams', 'missing team_id or abbreviation or name',
                         CAST(sum(CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 1 END) AS BIGINT)
                  FROM supplier WHERE s_suppkey % 23 <> 5 AND s_suppkey % 7 = 3 HAVING count(*) > 0
        UNION ALL SELECT 'teams', 'repeated key', count(*) FROM bulk_teams WHERE team_id % 5 = 0 HAVING count(*) > 0
        UNION ALL SELECT 'players', 'earlier season', count(*) - count(DISTINCT player_id) FROM rosters
                  HAVING count(*) > count(DISTINCT player_id)
        UNION ALL SELECT 'players', reason, count(*) FROM judged_players WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'games', reason, count(*) FROM judged_games WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'games', 'repeated key', count(*) - count(DISTINCT game_id) FROM judged_games WHERE reason IS NULL
                  HAVING count(*) > count(DISTINCT game_id)
        UNION ALL SELECT 'games', 'waits for its team', count(*) FROM sound_games
                  WHERE game_id NOT IN (SELECT game_id FROM bulk_games) HAVING count(*) > 0
        UNION ALL SELECT 'player_game_stats', reason, CAST(sum(copies) AS BIGINT) FROM judged_lines
                  WHERE reason IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'player_game_stats', 'repeated key', CAST(sum(copies - 1) AS BIGINT) FROM judged_lines
                  WHERE reason IS NULL HAVING sum(copies - 1) > 0
        UNION ALL SELECT 'player_game_stats', waits, count(*) FROM judged_lines
                  WHERE reason IS NULL AND waits IS NOT NULL GROUP BY 2""",
    "bulk_load_waiting": """
        SELECT player_id, NULL::VARCHAR AS game_id FROM judged_players WHERE reason = 'waits for its team'
        UNION ALL SELECT NULL, game_id FROM sound_games WHERE game_id NOT IN (SELECT game_id FROM bulk_games)
        UNION ALL SELECT player_id, game_id FROM judged_lines WHERE reason IS NULL AND waits IS NOT NULL""",
    "landed_load_games": "SELECT * FROM landed_games",
    "landed_load_stats": "SELECT * FROM landed_stats",
    "landed_load_tracking": """
        SELECT player_id, game_id, distance_miles, round(avg_speed_mph, 2) AS avg_speed_mph, CAST(0 AS DOUBLE) AS touches
        FROM landed_tracking WHERE reason IS NULL""",
    "landed_load_report": """
        SELECT 'player_tracking_stats' AS table_name, reason, count(*) AS n_rows FROM landed_tracking
        WHERE reason IS NOT NULL GROUP BY 2""",
    "stream_landing": """
        SELECT s.*, home_score, away_score FROM landed_stats s JOIN landed_games g ON g.game_id = s.game_id""",
    "bio_still_missing": "SELECT player_id, full_name FROM players WHERE birth_date IS NULL AND player_id % 3 = 0",
    "full_replace": f"""
        SELECT s.player_id, s.game_id, {_r('minutes + 5 * coalesce(distance_miles, 0)', 6, 'load_index')}
        FROM stats s LEFT JOIN tracking t ON t.player_id = s.player_id AND t.game_id = s.game_id
        WHERE minutes + 5 * coalesce(distance_miles, 0) >= 20""",
    "preview_rows": "SELECT DISTINCT full_name FROM players WHERE full_name IS NOT NULL ORDER BY 1 LIMIT 15",
    "records_output": "SELECT * FROM players",
    "sql_file": """
        SELECT home_team_id AS team_id, 'a;b' AS mark, count(*) AS n_games, CAST(sum(home_score) AS BIGINT) AS points
        FROM done GROUP BY 1""",
    "player_trend": f"""
        SELECT full_name, game_date, player_id, game_id, {_r('rolling_ts_pct')}, {_r('season_to_date_ts_pct')}
        FROM pf WHERE full_name IS NOT NULL""",
    "monitoring_log": f"""
        SELECT model_version_id, week_start, n_predictions, {_r('accuracy', 4)}, {_r('log_loss', 4)}, {_r('brier_score', 4)}
        FROM weekly""",
    "prediction_log": """
        SELECT game_id, model_version_id, predicted_label, actual AS actual_label,
               CASE WHEN model_version_id = 1 THEN prob ELSE prob / 2 END AS predicted_home_win_prob
        FROM labelled""",
    "model_registry": """
        SELECT DISTINCT 1 + o_orderkey % 2 AS model_version_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'game_outcome_logreg' ELSE 'game_outcome_xgb' END AS model_name,
               CASE WHEN o_orderkey % 2 = 0 THEN 'v1' ELSE 'v2' END AS version_tag
        FROM orders
        UNION ALL SELECT 1 + max(1 + o_orderkey % 2), 'game_outcome_xgb', 'v3' FROM orders""",
    "backfill_labels": """
        SELECT game_id, model_version_id, prob AS predicted_home_win_prob, predicted_label, actual AS actual_label
        FROM labelled""",
    "weekly_metrics": f"SELECT model_version_id, week_start, {_METRIC_ROUNDED} FROM weekly",
    "drift_alerts": f"""
        SELECT model_version_id, {_r('accuracy', 6, 'latest_accuracy')}, {_r('before', 6, 'trailing_avg_accuracy')},
               {_r('before - accuracy', 6, '"drop"')}
        FROM (SELECT *, avg(accuracy) OVER (PARTITION BY model_version_id ORDER BY week_start
                                            ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS before
              FROM (SELECT 1 + k % 40 AS model_version_id, date_trunc('week', game_date) AS week_start,
                           avg(CAST(predicted_label = actual AS INTEGER)) AS accuracy FROM scored GROUP BY 1, 2)
              QUALIFY week_start = max(week_start) OVER (PARTITION BY model_version_id))
        WHERE before - accuracy > CAST(0.05 AS DOUBLE)""",
    "monitoring_accuracy": """
        SELECT 'game_outcome_xgb' AS model_name, 'v2' AS version_tag, week_start, n_predictions,
               CAST(round(CAST(accuracy AS DECIMAL(28,9)), 4) AS DECIMAL(5,4)) AS accuracy,
               CAST(round(CAST(log_loss AS DECIMAL(28,9)), 4) AS DECIMAL(7,4)) AS log_loss,
               CAST(round(CAST(brier_score AS DECIMAL(28,9)), 4) AS DECIMAL(7,4)) AS brier_score
        FROM weekly WHERE model_version_id = 2""",
    "outcome_training": f"""
        SELECT game_id, team_id, {_r('rolling_win_pct')}, {_r('rolling_point_diff')}, is_home,
               {_r('opponent_rolling_win_pct')}, won FROM tf WHERE {_FORM_COMPLETE}""",
    "stratified_split": f"""
        SELECT won, count(*) AS n_rows, CAST(round(count(*) * 0.2) AS BIGINT) AS n_test FROM tf WHERE {_FORM_COMPLETE} GROUP BY won""",
    "outcome_baseline_metrics": f"""
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, true AS metrics_in_bounds
        FROM (SELECT round(count(*) * 0.2) AS n FROM tf WHERE {_FORM_COMPLETE} GROUP BY won)""",
    "rest_asymmetry": f"""
        SELECT game_id, team_id, opponent_days_rest, opponent_is_back_to_back, {_OUTCOME}, won
        FROM tf WHERE {_FORM_COMPLETE} AND days_rest IS NOT NULL""",
    "decline_label": _DECLINE_ROWS,
    "decline_rate": f"""
        SELECT {_r('avg(decline_flag)', 6, 'decline_rate')}, CAST(sum(decline_flag) AS BIGINT) AS n_declines,
               count(*) AS n_rows FROM ({_DECLINE_ROWS})""",
    "prediction_candidates": f"""
        SELECT game_id, {_OUTCOME} FROM tf WHERE is_home AND {_FORM_COMPLETE} AND days_rest IS NOT NULL""",
    "score_route": f"""
        SELECT game_id, CASE WHEN days_rest IS NULL THEN 'game_outcome_logreg' ELSE 'game_outcome_xgb' END AS model_used,
               coalesce(b2b, 0) AS is_back_to_back, {_r('coalesce(advantage, 0)', 6, 'rest_advantage')} FROM requests""",
    "binary_metrics": f"""
        SELECT n_rows, {_r('accuracy')}, {_r('log_loss')}, {_r('brier_score')}, {_r('tp / pp', 6, '"precision"')},
               {_r('tp / ap', 6, 'recall')}, {_r('2 * tp / (pp + ap)', 6, 'f1')},
               {_r('(rank_sum - ap * (ap + 1) / 2) / (ap * (n_rows - ap))', 6, 'auc')}
        FROM (SELECT count(*) AS n_rows, avg(CAST(predicted_label = actual AS INTEGER)) AS accuracy,
                     -avg(CASE WHEN actual THEN ln(greatest(prob, 2.220446049250313e-16))
                               ELSE ln(1 - greatest(prob, 2.220446049250313e-16)) END) AS log_loss,
                     avg((prob - y) * (prob - y)) AS brier_score,
                     CAST(count(*) FILTER (WHERE predicted_label AND actual) AS DOUBLE) AS tp,
                     CAST(count(*) FILTER (WHERE predicted_label) AS DOUBLE) AS pp,
                     CAST(count(*) FILTER (WHERE actual) AS DOUBLE) AS ap,
                     CAST(sum(mid) FILTER (WHERE actual) AS DOUBLE) AS rank_sum
              FROM (SELECT *, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0::DOUBLE AS mid
                    FROM scored))""",
    "stream_weekly_quality": f"""
        SELECT model_version_id, week_start, {_METRIC_ROUNDED}
        FROM (SELECT 1 + o_orderkey % 2 AS model_version_id, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
                     count(*) AS n_predictions, avg(CAST((p >= 0.5::DOUBLE) = (y = 1) AS INTEGER)) AS accuracy,
                     -avg(CASE WHEN y = 1 THEN ln(q) ELSE ln(1 - q) END) AS log_loss, avg((q - y) * (q - y)) AS brier_score
              FROM (SELECT *, greatest(p, 0.000001::DOUBLE) AS q
                    FROM (SELECT o_orderkey, o_orderdate, (o_orderkey * 7919 % 1000) / 1000.0::DOUBLE AS p,
                                 CAST(o_custkey % 2 = 0 AS INTEGER) AS y FROM orders)) GROUP BY 1, 2)""",
    "stream_first_deliveries": "SELECT DISTINCT l_partkey, l_orderkey FROM lineitem",
    "stream_label_predictions": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, 1 + o_orderkey % 2 AS model_version_id,
               {_r('(o_orderkey * 7919 % 1000) / 1000.0::DOUBLE', 6, 'predicted_home_win_prob')},
               o_orderkey * 7919 % 1000 >= 500 AS predicted_label, o_custkey % 2 = 0 AS actual_label
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 20 <= 14""",
    "stream_late_outcomes": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, 1 + o_orderkey % 2 AS model_version_id,
               {_r('(o_orderkey * 7919 % 1000) / 1000.0::DOUBLE', 6, 'predicted_home_win_prob')},
               o_orderkey * 7919 % 1000 >= 500 AS predicted_label,
               CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 20 <= 14 THEN o_custkey % 2 = 0 END AS actual_label
        FROM orders""",
}

# What the bulk files of ``sources.deliveries`` come to.
_CTE["bulk_teams"] = """
    SELECT s.s_suppkey AS team_id, c.abbreviation, s_name AS name, conference, division
    FROM supplier s JOIN codes c ON c.s_suppkey = s.s_suppkey LEFT JOIN lookup l ON l.abbreviation = c.abbreviation
    WHERE s.s_suppkey % 23 <> 5 AND s.s_suppkey % 7 <> 3"""
_CTE["rosters"] = """
    SELECT player_id, season, min(full_name) AS full_name, min(team_id) AS team_id FROM raw_players
    WHERE player_id % 16 <> 1 GROUP BY 1, 2"""
_CTE["judged_players"] = """
    SELECT *, CASE WHEN full_name IS NULL THEN 'missing player_id or full_name'
                   WHEN team_id NOT IN (SELECT team_id FROM bulk_teams) THEN 'waits for its team' END AS reason
    FROM (SELECT player_id, full_name, arg_max(coalesce(team_id, -1), season) AS team FROM rosters GROUP BY 1, 2
          UNION ALL SELECT DISTINCT player_id, full_name, -1 FROM raw_players WHERE player_id % 16 = 1)
         , LATERAL (SELECT nullif(team, -1) AS team_id)"""
_CTE["bulk_players"] = "SELECT player_id, full_name, team_id FROM judged_players WHERE reason IS NULL"
_CTE["sound_games"] = """
    SELECT DISTINCT game_id, game_date, season, home_team_id, away_team_id, home_score, away_score FROM judged_games
    WHERE reason IS NULL"""
_CTE["bulk_games"] = """
    SELECT * FROM sound_games WHERE home_team_id IN (SELECT team_id FROM bulk_teams)
    AND away_team_id IN (SELECT team_id FROM bulk_teams)"""
_CTE["bulk_lines"] = f"""
    SELECT player_id, game_id, CASE WHEN player_id % 16 <> 1 THEN team_id END AS team_id, minutes, points, fgm, fga, ftm, fta,
           plus_minus, l_linenumber, CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END AS copies
    FROM raw_stats QUALIFY row_number() OVER (PARTITION BY player_id, game_id ORDER BY {_KEPT_ORDER}) = 1"""
_CTE["judged_lines"] = """
    SELECT *, CASE WHEN team_id IS NULL THEN 'missing player_id or game_id or team_id' WHEN fgm > fga THEN 'fgm > fga' END AS reason,
           CASE WHEN game_id NOT IN (SELECT game_id FROM bulk_games) THEN 'waits for its contest'
                WHEN player_id NOT IN (SELECT player_id FROM bulk_players) THEN 'waits for its player'
                WHEN team_id NOT IN (SELECT team_id FROM bulk_teams) THEN 'waits for its team' END AS waits
    FROM bulk_lines"""
_CTE["landed_stats"] = """
    SELECT s.player_id, s.game_id, s.team_id, round(minutes + CAST(s.game_id AS BIGINT) % 60 / 60, 2) AS minutes,
           CAST(points AS DOUBLE) AS points, CAST(0 AS DOUBLE) AS rebounds, CAST(fgm AS DOUBLE) AS fgm, CAST(fga AS DOUBLE) AS fga,
           CAST(fta AS DOUBLE) AS ftm, CAST(fta AS DOUBLE) AS fta, CAST(0 AS DOUBLE) AS plus_minus, fta = 1 AS started
    FROM stats s JOIN games g ON g.game_id = s.game_id"""
_CTE["landed_games"] = """
    SELECT g.game_id, g.game_date, g.season, g.home_team_id, g.away_team_id, h.score AS home_score, a.score AS away_score,
           h.score > a.score AS home_win
    FROM games g LEFT JOIN day_scores h ON h.game_date = g.game_date AND h.team_id = g.home_team_id
    LEFT JOIN day_scores a ON a.game_date = g.game_date AND a.team_id = g.away_team_id"""
_CTE["landed_tracking"] = f"""
    SELECT t.* FROM judged_tracking t JOIN games g ON g.game_id = t.game_id
    QUALIFY row_number() OVER (PARTITION BY t.player_id, t.game_id ORDER BY {_KEPT_ORDER}) = 1"""
_CTE["day_scores"] = """
    SELECT game_date, team_id, arg_max(team_score, game_id) AS score FROM long WHERE team_score IS NOT NULL GROUP BY 1, 2"""


def _lookup_values() -> str:
    return ", ".join("('" + "', '".join(row) + "')" for row in conferences.rows())


def _needed(sql: str, found: list[str]) -> list[str]:
    """Names of the subqueries that the text uses, each after those it depends on."""
    for name, body in _CTE.items():
        if name not in found and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql):
            for inner in _needed(body, found):
                if inner not in found:
                    found.append(inner)
            if name not in found:
                found.append(name)
    return found


_SQL["bio_enrichment"] = _SQL["bio_update"]


def oracle_sql() -> dict[str, str]:
    complete = {}
    for name, sql in _SQL.items():
        used = _needed(sql, [])
        parts = ",\n".join(f"{cte} AS ({_CTE[cte].replace('{lookup}', _lookup_values())})" for cte in used)
        complete[name] = (f"WITH {parts}\n" if used else "") + sql.strip()
    return complete
