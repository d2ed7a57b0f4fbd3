"""The same answers as plain SQL for another engine: an independent check of every deterministic query.

Statements are put together from named common table expressions; a statement pulls in the ones it names. The
SQL is written for clarity on small data (self-joins, distinct counts, whole-table windows), not for scale.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(20,8)), {digits}) AS DOUBLE)"


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,6))"


def total(expr: str, digits: int = 4) -> str:
    return rnd(f"SUM({dec(f'COALESCE({expr}, 0)')})", digits)


def mean(expr: str, digits: int = 4) -> str:
    return rnd(f"AVG({dec(expr)})", digits)


def norm(column: str, axis: str) -> str:
    native = {"x": (105, 120), "y": (68, 80)}[axis]
    pitch = native[0]
    return (
        f"CASE coord_system WHEN 'statsbomb_120x80' THEN {column} * CAST({pitch} AS DOUBLE) / {native[1]} "
        f"WHEN 'opta_100x100' THEN {column} * CAST({pitch} AS DOUBLE) / 100 "
        f"WHEN 'wyscout_100x100' THEN {column} * CAST({pitch} AS DOUBLE) / 100 ELSE {column} END"
    )


def clamped(column: str, axis: str) -> str:
    high = {"x": 105, "y": 68}[axis]
    return rnd(f"LEAST(GREATEST({norm(column, axis)}, 0.0), {high}.0)", 3)


def cell(x: str, y: str) -> str:
    return (
        f"(LEAST(CAST(FLOOR({y} / (68.0::DOUBLE / 12)) AS INTEGER), 11) * 16 "
        f"+ LEAST(CAST(FLOOR({x} / (105.0::DOUBLE / 16)) AS INTEGER), 15))"
    )


CTE: dict[str, str] = {}

CTE["line"] = """SELECT l_orderkey AS o, l_partkey AS p, l_suppkey AS s, l_linenumber AS n,
  CAST(l_orderkey // 160 AS INTEGER) AS match_id, (l_orderkey // 160) // 10 AS series,
  (l_orderkey + l_partkey) % 3 AS sys, (l_orderkey + l_linenumber + l_suppkey) % 20 AS kind,
  ((l_partkey * 11 + l_orderkey * 7) % 24) * 285 + (l_orderkey * 13 + l_linenumber * 5 + l_suppkey) % 15 AS clock,
  l_returnflag AS flag, l_linestatus AS line_status, l_shipdate AS shipped,
  CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents FROM lineitem"""

CTE["typed"] = """SELECT *, CASE WHEN (o + p) % 1009 = 0 THEN NULL WHEN kind <= 8 THEN 'Pass' WHEN kind <= 11 THEN 'Carry'
  WHEN kind <= 13 THEN 'Shot' WHEN kind = 14 THEN 'Pressure' WHEN kind = 15 THEN 'Tackle'
  WHEN kind = 16 THEN 'Interception' WHEN kind = 17 THEN 'Ball Recovery' WHEN kind = 18 THEN 'Block'
  WHEN p % 3 = 0 THEN 'Foul' WHEN p % 3 = 1 THEN 'Dribble' ELSE 'Clearance' END AS event_type,
  CASE sys WHEN 0 THEN 1210 ELSE 1010 END AS wide, CASE sys WHEN 0 THEN 810 ELSE 1010 END AS tall,
  series * 44 + (p % 44 + 2 * (1 + s % 5)) % 44 AS receiver FROM line"""

CTE["fact"] = """SELECT concat_ws('_', o, n, p, s, cents) AS event_id, match_id, match_id % 5 AS competition_id,
  CAST(CASE WHEN (o + p + s) % 53 = 0 THEN NULL WHEN p % 2 = 0 THEN series % 25
    ELSE (series % 25 + 1 + (series // 25) % 24) % 25 END AS INTEGER) AS team_id,
  CAST(CASE WHEN s % 31 = 0 AND n = 1 THEN NULL ELSE series * 44 + p % 44 END AS INTEGER) AS player_id,
  event_type, CAST(clock // 60 AS SMALLINT) AS minute,
  CAST(CASE WHEN (o + n) % 97 = 0 THEN NULL ELSE clock % 60 END AS SMALLINT) AS second,
  CASE WHEN (o + s) % 211 = 0 THEN NULL ELSE CAST((o * 7 + p * 3) % wide AS DOUBLE) / 10 END AS location_x,
  CASE WHEN (o + s) % 211 = 0 THEN NULL ELSE CAST((o * 11 + s * 13) % tall AS DOUBLE) / 10 END AS location_y,
  CASE WHEN p % 17 = 0 THEN NULL ELSE CAST((o * 3 + p * 5) % wide AS DOUBLE) / 10 END AS end_location_x,
  CASE WHEN p % 17 = 0 THEN NULL ELSE CAST((o * 5 + s * 7) % tall AS DOUBLE) / 10 END AS end_location_y,
  CASE WHEN event_type = 'Shot' THEN CASE WHEN flag = 'A' AND 2 * ((o * 7 + p * 3) % wide) >= wide THEN 'Goal'
      WHEN flag IN ('A', 'R') THEN 'Saved' ELSE 'Off T' END
    WHEN flag = 'A' THEN NULL WHEN flag = 'R' THEN 'Incomplete' WHEN p % 8 = 0 THEN 'Success'
    WHEN p % 8 = 1 THEN '' ELSE 'Unknown' END AS outcome,
  CASE WHEN p % 29 = 0 THEN NULL ELSE line_status = 'O' END AS under_pressure,
  CASE sys WHEN 0 THEN 'statsbomb' WHEN 1 THEN 'opta' ELSE 'wyscout' END AS provider,
  CASE sys WHEN 0 THEN 'statsbomb_120x80' WHEN 1 THEN 'opta_100x100' ELSE 'wyscout_100x100' END AS coord_system,
  CASE WHEN (o + p + n) % 23 = 0 THEN NULL
    WHEN sys = 0 THEN concat('{"pass":{"recipient":{"id":', receiver, '}},"shot":{"technique":{"name":"',
      CASE s % 3 WHEN 0 THEN 'Header' ELSE 'Normal' END, '"},"body_part":{"name":"',
      CASE s % 4 WHEN 0 THEN 'Head' WHEN 1 THEN 'Left Foot' WHEN 2 THEN 'Right Foot' ELSE 'Other' END, '"}}}')
    WHEN sys = 1 THEN concat('{"Qualifiers":[{"QualifierId":', CASE s % 5 WHEN 0 THEN 72 ELSE 15 END,
      '},{"QualifierId":56}]}')
    WHEN s % 7 = 0 THEN '{"pass":{}}' ELSE concat('{"pass":{"recipient":{"id":', receiver, '}}}') END AS raw_json,
  CASE WHEN event_type = 'Shot' THEN CAST((o * 5 + s * 3) % 300 AS DOUBLE) / 1000
    WHEN event_type IN ('Pass', 'Carry') AND (flag = 'A' OR (flag = 'N' AND p % 8 <> 0))
    THEN CAST((o * 13 + p * 7) % 4001 - 1500 AS DOUBLE) / 25000 END AS xt_value,
  CASE WHEN (event_type = 'Pass' AND p % 19 <> 0) OR (event_type = 'Shot' AND p % 7 = 0)
    THEN CAST(50 + (o * 7 + s * 5) % 950 AS DOUBLE) / 1000 END AS xp_value,
  CASE WHEN event_type = 'Shot' AND (o + p) % 41 <> 0 THEN CAST((o * 3 + p * 11) % 950 + 5 AS DOUBLE) / 1000 END
    AS xg_value,
  shipped AS ingested_at FROM typed"""

CTE["dim_teams"] = """SELECT n_nationkey AS team_id, n_name AS team_name, r_name AS country
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""
CTE["dim_players"] = """SELECT CAST(p_partkey AS INTEGER) AS player_id, concat_ws(' ', p_name, p_brand) AS player_name,
  CAST(NULL AS VARCHAR) AS nationality, p_type AS position FROM part"""
CTE["dim_competitions"] = """SELECT r_regionkey AS competition_id,
  CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East' ELSE upper(left(r_name, 1)) || lower(substr(r_name, 2)) END
  AS competition_name, r_name AS country_name FROM region"""
CTE["dated"] = """SELECT CAST(o_orderkey // 160 AS INTEGER) AS match_id, CAST(MIN(o_orderdate) AS DATE) AS match_date,
  CAST((o_orderkey // 160) // 10 AS INTEGER) AS series FROM orders GROUP BY 1, 3"""
CTE["dim_matches"] = """SELECT d.match_id, d.match_id % 5 AS competition_id,
  CAST(year(match_date) AS INTEGER) AS season_id, match_date, h.team_name AS home_team, a.team_name AS away_team,
  d.match_id % 4 AS home_score, (d.match_id // 4) % 3 AS away_score,
  CASE d.match_id % 4 WHEN 0 THEN 'Group Stage' WHEN 1 THEN 'Round of 16' WHEN 2 THEN 'Quarter-finals'
    ELSE 'Final' END AS stage
  FROM dated d LEFT JOIN dim_teams h ON h.team_id = series % 25
  LEFT JOIN dim_teams a ON a.team_id = (series % 25 + 1 + (series // 25) % 24) % 25"""
CTE["ledger"] = """SELECT match_id, competition_id, CAST(100 + match_id % 50 AS BIGINT) AS event_count,
  CASE WHEN match_id % 7 = 0 THEN 'error' ELSE 'success' END AS status, CAST(match_date AS TIMESTAMP) AS ingested_at
  FROM dim_matches WHERE season_id % 2 = 1"""

CTE["named"] = """SELECT fact.*, player_name, team_name FROM fact LEFT JOIN dim_players USING (player_id)
  LEFT JOIN dim_teams USING (team_id)"""
CTE["match_sides"] = f"""SELECT match_id, SUM({dec('xt_value')}) FILTER (WHERE team_name = home_team) AS home,
  SUM({dec('xt_value')}) FILTER (WHERE team_name = away_team) AS away
  FROM named JOIN dim_matches USING (match_id) WHERE xt_value IS NOT NULL AND team_name IS NOT NULL GROUP BY match_id"""

CTE["bronze"] = """SELECT event_id, match_id, team_id, player_id, event_type, CAST(minute AS INTEGER) AS minute,
  CAST(second AS INTEGER) AS second, location_x, location_y, end_location_x, end_location_y, outcome, under_pressure,
  provider, coord_system, raw_json, ingested_at FROM fact WHERE event_id IS NOT NULL"""
CTE["silver"] = f"""SELECT event_id, match_id, team_id, player_id, event_type, minute, second, provider, coord_system,
  {clamped('location_x', 'x')} AS location_x, {clamped('location_y', 'y')} AS location_y,
  {clamped('end_location_x', 'x')} AS end_location_x, {clamped('end_location_y', 'y')} AS end_location_y,
  COALESCE(outcome, 'Unknown') AS outcome, COALESCE(under_pressure, FALSE) AS under_pressure, raw_json, ingested_at
  FROM bronze WHERE event_id IS NOT NULL AND match_id IS NOT NULL AND location_x IS NOT NULL AND location_y IS NOT NULL"""
CTE["passes"] = f"""SELECT event_id, match_id, team_id, player_id, minute, second, location_x, location_y,
  end_location_x, end_location_y, under_pressure, provider, outcome,
  {rnd('sqrt(power(end_location_x - location_x, 2) + power(end_location_y - location_y, 2))', 2)} AS pass_distance_m,
  outcome = 'Unknown' AS is_successful
  FROM silver WHERE event_type = 'Pass' AND location_x IS NOT NULL AND end_location_x IS NOT NULL"""
CTE["shots"] = f"""SELECT event_id, match_id, team_id, player_id, minute, second, location_x, location_y, outcome,
  under_pressure, provider, raw_json,
  {rnd('sqrt(power(location_x - 105.0, 2) + power(location_y - 34.0, 2))', 3)} AS distance_to_goal,
  {rnd('abs(atan2(7.32 * (105.0 - location_x), power(105.0 - location_x, 2) + power(location_y - 34.0, 2) - power(3.66, 2)))', 5)}
    AS shot_angle,
  CASE WHEN provider = 'statsbomb' AND json_extract_string(raw_json, '$.shot.technique.name') = 'Header' THEN TRUE
    WHEN provider = 'opta'
      AND list_contains(CAST(json_extract(raw_json, '$.Qualifiers[*].QualifierId') AS VARCHAR[]), '72') THEN TRUE
    ELSE FALSE END AS is_header,
  CASE WHEN provider = 'statsbomb' THEN COALESCE(json_extract_string(raw_json, '$.shot.body_part.name'), 'Unknown')
    ELSE 'Unknown' END AS body_part,
  CASE WHEN outcome = 'Goal' THEN 1 ELSE 0 END AS is_goal
  FROM silver WHERE event_type = 'Shot' AND location_x IS NOT NULL AND location_y IS NOT NULL"""
CTE["links"] = """SELECT p.event_id, p.match_id, p.team_id, p.player_id AS from_player_id,
  CASE WHEN f.provider IN ('statsbomb', 'wyscout')
    THEN CAST(json_extract_string(f.raw_json, '$.pass.recipient.id') AS INTEGER) END AS to_player_id,
  p.pass_distance_m, p.is_successful, p.under_pressure, p.location_x, p.location_y, p.end_location_x, p.end_location_y
  FROM passes p JOIN fact f ON p.event_id = f.event_id WHERE p.player_id IS NOT NULL"""
CTE["staged"] = f"""SELECT event_id, match_id, competition_id, team_id, player_id, event_type, minute,
  CAST(COALESCE(second, 0) AS SMALLINT) AS second, {rnd('location_x', 2)} AS location_x, {rnd('location_y', 2)} AS location_y,
  {rnd('end_location_x', 2)} AS end_location_x, {rnd('end_location_y', 2)} AS end_location_y, outcome,
  COALESCE(under_pressure, FALSE) AS under_pressure, xt_value, xp_value, xg_value
  FROM fact WHERE location_x IS NOT NULL AND location_y IS NOT NULL AND event_type IS NOT NULL"""
CTE["ev"] = """SELECT se.*, fe.competition_id, fe.xt_value, fe.xg_value, fe.xp_value
  FROM silver se JOIN fact fe ON se.event_id = fe.event_id"""

CTE["team_summary"] = f"""SELECT team_id, match_id, COUNT(*) AS total_actions, COUNT(*) FILTER (WHERE event_type = 'Pass') AS total_passes,
  COUNT(*) FILTER (WHERE event_type = 'Shot') AS total_shots, COUNT(*) FILTER (WHERE outcome = 'Goal') AS goals,
  {total('xg_value')} AS total_xg, {total('xt_value')} AS total_xt,
  {rnd("CAST(COUNT(*) FILTER (WHERE outcome = 'Goal') AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE event_type = 'Shot'), 0)", 4)}
    AS conversion_rate, team_name
  FROM ev LEFT JOIN dim_teams USING (team_id) WHERE team_id IS NOT NULL GROUP BY team_id, match_id, team_name"""

CTE["player_metrics"] = f"""SELECT player_id, player_name, team_name, n_pass AS total_passes, done AS successful_passes,
  pass_completion_pct, avg_pass_distance_m, pressed AS passes_under_pressure, avg_xp, n_shot AS total_shots, goals,
  total_xt_shots, total_xg, avg_xg, {rnd('goals - total_xg', 4)} AS finishing_quality, total_xt, avg_xt_per_pass FROM (
    SELECT ev.player_id, ev.team_id, COUNT(p.event_id) AS n_pass, COUNT(*) FILTER (WHERE p.is_successful) AS done,
      {rnd('CAST(AVG(CAST(p.is_successful AS INTEGER)) AS DECIMAL(20,8)) * 100', 1)} AS pass_completion_pct,
      {mean('p.pass_distance_m', 2)} AS avg_pass_distance_m, COUNT(*) FILTER (WHERE p.under_pressure) AS pressed,
      {rnd(f"AVG({dec('xp_value')}) FILTER (WHERE p.event_id IS NOT NULL)", 4)} AS avg_xp, COUNT(s.event_id) AS n_shot,
      COUNT(*) FILTER (WHERE s.is_goal = 1) AS goals,
      COALESCE({rnd(f"SUM({dec('xt_value')}) FILTER (WHERE s.event_id IS NOT NULL)", 4)}, 0) AS total_xt_shots,
      COALESCE({rnd(f"SUM({dec('xg_value')}) FILTER (WHERE s.event_id IS NOT NULL)", 4)}, 0) AS total_xg,
      {rnd(f"AVG({dec('xg_value')}) FILTER (WHERE s.event_id IS NOT NULL)", 4)} AS avg_xg,
      CASE WHEN ev.team_id IS NOT NULL THEN {total('xt_value')} END AS total_xt,
      {rnd(f"SUM({dec('COALESCE(xt_value, 0)')}) FILTER (WHERE p.event_id IS NOT NULL) / NULLIF(COUNT(p.event_id), 0)", 6)} AS avg_xt_per_pass
    FROM ev LEFT JOIN passes p ON p.event_id = ev.event_id LEFT JOIN shots s ON s.event_id = ev.event_id
    WHERE ev.player_id IS NOT NULL
    -- Without a team, passes and shots stay apart.
    GROUP BY ev.player_id, ev.team_id, CASE WHEN ev.team_id IS NULL THEN ev.event_type END
    HAVING COUNT(p.event_id) + COUNT(s.event_id) > 0)
  LEFT JOIN dim_players USING (player_id) LEFT JOIN dim_teams USING (team_id)"""

CTE["mart_team"] = f"""SELECT team_id, team_name, COUNT(*) AS total_actions, COUNT(*) FILTER (WHERE event_type = 'Pass') AS total_passes,
  COUNT(*) FILTER (WHERE event_type = 'Shot') AS total_shots, COUNT(*) FILTER (WHERE event_type = 'Dribble') AS total_dribbles,
  COUNT(*) FILTER (WHERE event_type = 'Pressure') AS total_pressures, COUNT(*) FILTER (WHERE event_type = 'Carry') AS total_carries,
  {total('xt_value')} AS total_xt, {mean('xp_value')} AS avg_xp, {total('xg_value')} AS total_xg
  FROM ev LEFT JOIN dim_teams USING (team_id) WHERE team_id IS NOT NULL GROUP BY team_id, team_name"""

CTE["pressing"] = f"""SELECT match_id, team_id, team_name, acts AS defensive_actions, faced AS passes_allowed, {rnd('faced / acts', 4)} AS ppda,
  CASE WHEN faced < 10 * acts THEN 'High' WHEN faced < 15 * acts THEN 'Medium' ELSE 'Low' END AS pressing_intensity FROM (
    SELECT match_id, team_id, acts, CAST(SUM(own) OVER (PARTITION BY match_id) - own AS BIGINT) AS faced FROM (
      SELECT match_id, team_id, COUNT(*) FILTER (WHERE event_type IN ('Tackle', 'Interception', 'Foul', 'Block', 'Pressure')) AS acts,
        COUNT(*) FILTER (WHERE event_type = 'Pass') AS own FROM silver WHERE team_id IS NOT NULL GROUP BY match_id, team_id))
  LEFT JOIN dim_teams USING (team_id) WHERE acts > 0"""

CTE["team_xg"] = f"""SELECT COALESCE(team_name, 'Unknown') AS team_name, match_id, COUNT(*) AS total_shots,
  {rnd(f"SUM({dec('xg_value')})", 4)} AS total_xg, COUNT(*) FILTER (WHERE outcome = 'Goal') AS goals_scored,
  {rnd("AVG(CASE WHEN outcome = 'Goal' THEN 1 ELSE 0 END)", 4)} AS conversion_rate
  FROM named WHERE event_type = 'Shot' GROUP BY ALL"""

_DONE = "(outcome IS NULL OR outcome IN ('Unknown', ''))"
CTE["actions"] = f"""SELECT event_id, match_id, player_id, team_id, event_type, outcome, {cell('location_x', 'location_y')} AS cell,
  CASE WHEN event_type IN ('Pass', 'Carry') AND {_DONE} AND end_location_x IS NOT NULL AND end_location_y IS NOT NULL
    THEN {cell('end_location_x', 'end_location_y')} END AS end_cell
  FROM silver WHERE event_type IN ('Pass', 'Carry', 'Shot')"""
CTE["cell_counts"] = """SELECT cell, COUNT(*) AS actions, COUNT(*) FILTER (WHERE event_type = 'Shot') AS shots,
  COUNT(*) FILTER (WHERE event_type = 'Shot' AND outcome = 'Goal') AS goals, COUNT(end_cell) AS moves
  FROM actions GROUP BY cell"""
CTE["trans"] = """SELECT m.cell AS src, m.end_cell AS dst, CAST(m.n AS DOUBLE) / t.n AS p
  FROM (SELECT cell, end_cell, COUNT(*) AS n FROM actions WHERE end_cell IS NOT NULL GROUP BY 1, 2) m
  JOIN (SELECT cell, COUNT(*) AS n FROM actions WHERE end_cell IS NOT NULL GROUP BY 1) t ON m.cell = t.cell"""
CTE["grid"] = """SELECT CAST(range AS INTEGER) AS cell, COALESCE(CAST(shots AS DOUBLE) / actions, 0) AS sp,
  COALESCE(CAST(goals AS DOUBLE) / NULLIF(shots, 0), 0) AS gp FROM range(192) LEFT JOIN cell_counts ON range = cell"""
CTE["it0"] = "SELECT cell, CAST(0 AS DOUBLE) AS xt FROM grid"
for _i in range(1, 11):
    CTE[f"it{_i}"] = f"""SELECT g.cell, g.sp * g.gp + (1 - g.sp) * COALESCE(s.m, 0) AS xt FROM grid g LEFT JOIN
  (SELECT src, SUM(p * xt) AS m FROM trans JOIN it{_i - 1} ON dst = cell GROUP BY src) s ON g.cell = s.src"""
CTE["surface"] = f"""SELECT cell % 16 AS grid_col, cell // 16 AS grid_row, {rnd('xt', 6)} AS xt_value FROM it10"""
CTE["event_xt"] = f"""SELECT event_id, match_id, player_id, team_id,
  {rnd("CASE WHEN event_type = 'Shot' THEN a.xt ELSE b.xt - a.xt END", 6)} AS xt_value
  FROM actions LEFT JOIN it10 a ON a.cell = actions.cell LEFT JOIN it10 b ON b.cell = actions.end_cell
  WHERE event_type = 'Shot' OR end_cell IS NOT NULL"""

CTE["presses"] = """SELECT event_id, match_id, team_id, event_type, minute * 60 + COALESCE(second, 0) AS t FROM silver
  WHERE event_type IN ('Pressure', 'Interception', 'Tackle', 'Block', 'Ball Recovery')"""
CTE["triggered"] = """SELECT r.event_id AS rec, r.match_id, r.team_id, r.t, a.event_id AS act FROM presses r
  JOIN presses a ON a.match_id = r.match_id AND a.team_id = r.team_id AND a.t BETWEEN r.t AND r.t + 5
  WHERE r.event_type = 'Ball Recovery' AND a.event_type <> 'Ball Recovery'"""

CTE["features"] = f"""WITH passing AS (SELECT player_id, COUNT(*) AS n, COUNT(DISTINCT match_id) AS m, AVG({dec('pass_distance_m')}) AS length,
    AVG({dec('location_x')}) AS x, AVG({dec('location_y')}) AS y, COUNT(*) FILTER (WHERE is_successful) AS done,
    COUNT(*) FILTER (WHERE under_pressure) AS pressed FROM passes GROUP BY player_id HAVING COUNT(DISTINCT match_id) >= 3),
shooting AS (SELECT s.player_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE is_goal = 1) AS goals, AVG({dec('distance_to_goal')}) AS far,
    AVG({dec('shot_angle')}) AS angle, COUNT(*) FILTER (WHERE is_header) AS headers, AVG({dec('f.xg_value')}) AS xg
  FROM shots s JOIN fact f ON f.event_id = s.event_id GROUP BY s.player_id)
SELECT player_id, player_name, position, COALESCE(g.n, 0)::DOUBLE / p.m AS shots_per_match,
  COALESCE(g.goals, 0)::DOUBLE / p.m AS goals_per_match, COALESCE(far, 0)::DOUBLE AS avg_shot_distance,
  COALESCE(angle, 0)::DOUBLE AS avg_shot_angle, COALESCE(headers::DOUBLE / g.n, 0) AS header_ratio,
  COALESCE(xg, 0)::DOUBLE AS xg_per_shot, p.n::DOUBLE / p.m AS passes_per_match, done::DOUBLE / p.n AS pass_completion_rate,
  length::DOUBLE AS avg_pass_distance_m, x::DOUBLE AS avg_location_x, y::DOUBLE AS avg_location_y,
  pressed::DOUBLE / p.n AS under_pressure_ratio
FROM dim_players JOIN passing p USING (player_id) LEFT JOIN shooting g USING (player_id)"""

FEATURES = (
    "shots_per_match", "goals_per_match", "avg_shot_distance", "avg_shot_angle", "header_ratio", "xg_per_shot",
    "passes_per_match", "pass_completion_rate", "avg_pass_distance_m", "avg_location_x", "avg_location_y",
    "under_pressure_ratio",
)
CTE["scaled"] = "SELECT player_id, [" + ", ".join(
    f"({f} - AVG({f}) OVER ()) / CASE WHEN stddev_pop({f}) OVER () > 0 THEN stddev_pop({f}) OVER () ELSE 1 END" for f in FEATURES
) + "] AS v FROM features"
CTE["scores"] = f"""SELECT player_id, similar_player_id, similarity_score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT player_id, similar_player_id, GREATEST(c, 0) AS similarity_score,
    row_number() OVER (PARTITION BY player_id ORDER BY c DESC, similar_player_id) AS rank FROM (
    SELECT a.player_id, b.player_id AS similar_player_id, {rnd('list_cosine_similarity(a.v, b.v)', 6)} AS c
    FROM scaled a JOIN scaled b ON a.player_id <> b.player_id)) WHERE rank <= 10"""
CTE["profile"] = """SELECT dp.player_id, dp.player_name, dp.position, m.team_name, COALESCE(m.avg_xg, 0.0) AS avg_xg,
  COALESCE(m.pass_completion_pct, 0.0) AS pass_completion_pct, COALESCE(m.avg_xt_per_pass, 0.0) AS avg_xt_per_pass,
  COALESCE(m.total_shots, 0) AS total_shots FROM dim_players dp LEFT JOIN player_metrics m ON dp.player_id = m.player_id"""
CTE["candidates"] = f"""WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player_id
    ORDER BY team_name NULLS LAST, avg_xg, total_shots) AS k FROM profile) WHERE k = 1),
c AS (SELECT * FROM (SELECT s.player_id, s.similar_player_id, s.similarity_score, s.rank, p.player_name, p.position,
    p.team_name, p.avg_xg, p.pass_completion_pct, p.avg_xt_per_pass, p.total_shots,
    CAST(row_number() OVER (PARTITION BY s.player_id
      ORDER BY s.rank, s.similar_player_id, p.team_name NULLS LAST, p.avg_xg, p.total_shots) AS INTEGER) AS slot
  FROM scores s JOIN profile p ON p.player_id = s.similar_player_id) WHERE slot <= 3)
SELECT c.*, t.player_name AS target_name, t.avg_xg AS target_avg_xg, t.pass_completion_pct AS target_pass_completion_pct,
  t.avg_xt_per_pass AS target_avg_xt_per_pass, t.total_shots AS target_total_shots, {rnd('c.avg_xg - t.avg_xg', 4)} AS delta_xg,
  {rnd('c.pass_completion_pct - t.pass_completion_pct', 2)} AS delta_pct, {rnd('c.avg_xt_per_pass - t.avg_xt_per_pass', 5)} AS delta_xt
FROM c JOIN t ON c.player_id = t.player_id"""

CTE["threats"] = f"""SELECT match_id, player_name, team_name, total_xt, CAST(k AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY total_xt DESC, player_name, team_name) AS k FROM (
    SELECT match_id, player_name, team_name, {rnd(f"SUM({dec('xt_value')})", 4)} AS total_xt FROM named
    WHERE xt_value > 0 AND player_name IS NOT NULL AND team_name IS NOT NULL GROUP BY ALL)) WHERE k <= 3"""
CTE["summary"] = f"""WITH sides AS (SELECT match_id, team_name, total_xg, ppda, pressing_intensity AS label
  FROM team_summary FULL JOIN pressing USING (match_id, team_name))
SELECT match_id, home_team, away_team, home_score, away_score, COALESCE(h.total_xg, 0) AS xg_home, COALESCE(a.total_xg, 0) AS xg_away,
  {rnd('COALESCE(h.total_xg, 0) - COALESCE(a.total_xg, 0)', 4)} AS xg_diff, h.ppda AS home_ppda, a.ppda AS away_ppda,
  COALESCE(h.label, 'N/A') AS home_pressing, COALESCE(a.label, 'N/A') AS away_pressing
  FROM dim_matches LEFT JOIN (SELECT match_id, team_name AS home_team, * EXCLUDE (match_id, team_name) FROM sides) h
    USING (match_id, home_team)
  LEFT JOIN (SELECT match_id, team_name AS away_team, * EXCLUDE (match_id, team_name) FROM sides) a
    USING (match_id, away_team)"""

CTE["safe_moves"] = f"""SELECT match_id, player_id, team_id, {cell('x', 'y')} AS cell, {cell('ex', 'ey')} AS end_cell FROM (
  SELECT match_id, player_id, team_id, {clamped('location_x', 'x')} AS x, {clamped('location_y', 'y')} AS y,
    {clamped('end_location_x', 'x')} AS ex, {clamped('end_location_y', 'y')} AS ey FROM fact
  WHERE event_type IN ('Pass', 'Carry') AND location_x IS NOT NULL AND location_y IS NOT NULL AND end_location_x IS NOT NULL)"""
CTE["gains"] = f"""SELECT match_id, g.player_id, g.team_id, COALESCE(player_name, 'Unknown') AS player,
  COALESCE(team_name, 'Unknown') AS team, {rnd(f"SUM({dec('d')})", 6)} AS xt_delta FROM (
    SELECT m.*, {rnd('b.xt - a.xt', 6)} AS d FROM safe_moves m JOIN it10 a ON a.cell = m.cell JOIN it10 b ON b.cell = m.end_cell) g
  LEFT JOIN dim_players p ON p.player_id = g.player_id LEFT JOIN dim_teams t ON t.team_id = g.team_id
  WHERE d > 0 GROUP BY ALL"""


def statement(body: str) -> str:
    """``body`` with the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTE:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTE[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    named = ",\n".join(f"{name} AS ({CTE[name]})" for name in order)
    # A body with its own WITH continues the list.
    rest = ",\n" + body.removeprefix("WITH ") if body.startswith("WITH ") else "\n" + body
    return f"WITH {named}{rest}"
