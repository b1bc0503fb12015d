"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

TIME = "%Y-%m-%d %H:%M:%S.%f"

MATCHES = """matches AS (
  SELECT CAST(o_orderkey // 8 AS VARCHAR) AS match_id, CAST(o_custkey AS VARCHAR) AS puuid,
         CAST(o_orderkey % 8 + 1 AS INT) AS placement, CAST(3 + o_orderkey % 8 AS INT) AS level,
         CAST(floor(o_totalprice) AS BIGINT) % 60 AS gold_left,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)
           AS time_eliminated,
         CAST(floor(o_totalprice) AS BIGINT) % 150 AS total_damage_to_players,
         o_orderpriority AS tier,
         CASE WHEN o_orderkey % 8 + 1 < 5 THEN 'win' ELSE 'loss' END AS outcome
  FROM orders)"""

TRAITS = """match_traits AS (
  SELECT CAST(l_orderkey // 8 AS VARCHAR) AS match_id, CAST(l_orderkey AS VARCHAR) AS puuid,
         CAST(l_orderkey % 8 + 1 AS INT) AS placement, p_brand AS trait_id,
         count(*) AS trait_unit_count,
         CAST(least(4, floor((sum(l_quantity) - 1) / 20)) AS INT) AS trait_tier,
         4 AS trait_tier_max
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)"""

UNITS = """match_units AS (
  SELECT CAST(l_orderkey // 8 AS VARCHAR) AS match_id, CAST(l_orderkey AS VARCHAR) AS puuid,
         CAST(l_orderkey % 8 + 1 AS INT) AS placement, p_brand AS unit_id, p_name AS item,
         p_size % 3 + 1 AS unit_tier, l_linenumber - 1 AS pos
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

AUGMENTS = """match_augments AS (
  SELECT CAST(l_orderkey // 8 AS VARCHAR) AS match_id, CAST(l_orderkey AS VARCHAR) AS puuid,
         CAST(l_orderkey % 8 + 1 AS INT) AS placement,
         max(CASE WHEN l_linenumber = 1 THEN p_name END) AS augment1,
         max(CASE WHEN l_linenumber = 2 THEN p_name END) AS augment2,
         max(CASE WHEN l_linenumber = 3 THEN p_name END) AS augment3
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
picks AS (
  SELECT match_id, placement, 1 AS pick_order, augment1 AS augment_id FROM match_augments
  UNION ALL SELECT match_id, placement, 2, augment2 FROM match_augments
  UNION ALL SELECT match_id, placement, 3, augment3 FROM match_augments)"""

ENTRIES = """entries AS (
  SELECT 'P' || c_custkey AS puuid, 'S' || c_custkey AS "summonerId",
         CASE WHEN c_custkey % 5 = 0 THEN 'RANKED_TFT_TURBO' ELSE 'RANKED_TFT' END AS "queueType",
         c_mktsegment AS tier,
         CASE c_custkey % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' ELSE 'IV' END
           AS rank,
         CAST(c_custkey % 50 + c.copy AS INT) AS wins, CAST(c_custkey % 40 AS INT) AS losses,
         c_custkey % 3 = 0 AS "hotStreak"
  FROM customer JOIN (SELECT 0 AS copy UNION ALL SELECT 1) c
    ON c.copy = 0 OR c_nationkey % 4 = 0),
players AS (
  SELECT puuid, "summonerId", tier, rank, max(wins) AS wins, losses, "hotStreak"
  FROM entries GROUP BY ALL),
marked AS (
  SELECT e.puuid, e."queueType", e.wins,
         CASE WHEN d.puuid IS NOT NULL THEN '2024-01-01 00:00:00.000000' END AS "processedTime"
  FROM entries e
  LEFT JOIN (SELECT DISTINCT 'P' || (o_custkey * 2) AS puuid FROM orders) d
    ON d.puuid = e.puuid
  WHERE e."queueType" = 'RANKED_TFT')"""

UPSERT = """base AS (
  SELECT 'P' || c_custkey AS puuid, c_mktsegment AS tier, c_custkey % 50 AS wins FROM customer),
updates AS (
  SELECT 'P' || (o_custkey * 2) AS puuid, 'NEW-' || o_orderstatus AS tier, o_orderkey % 50 AS wins
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT * FROM updates UNION ALL SELECT * FROM base WHERE puuid NOT IN (SELECT puuid FROM updates)"""

DOCUMENTS = """deliveries AS (
  SELECT o_orderkey AS k, o_custkey AS c, 'M' || o_orderkey AS match_id,
         CAST(1200 + o_orderkey % 900 AS DOUBLE) AS game_length,
         CASE WHEN o_orderkey % 13 = 0 THEN 'pairs' ELSE 'standard' END AS tft_game_type,
         CASE WHEN o_orderkey % 11 = 0 THEN 'TFTSet9' ELSE 'TFTSet10' END AS tft_set_core_name
  FROM orders JOIN (SELECT 1 AS n UNION ALL SELECT 2) d ON d.n = 1 OR o_orderstatus = 'F'),
kept AS (
  SELECT * FROM deliveries
  WHERE tft_game_type = 'standard' AND tft_set_core_name = 'TFTSet10'
    AND NOT (k % 17 = 0 AND k % 9 > 0)),
numbers AS (SELECT CAST(unnest(range(1, 9)) AS INT) AS n)"""


def _participants(source: str, name: str) -> str:
    return f"""{name} AS (
  SELECT d.match_id, d.game_length, d.k, d.c, s.n AS i,
         CASE WHEN s.n IS NOT NULL THEN 'P' || (d.c * 8 + s.n) END AS puuid,
         s.n AS placement, CAST(3 + (d.k + s.n) % 8 AS INT) AS level,
         CAST((d.k * s.n) % 60 AS INT) AS gold_left,
         CAST(1000 + (d.k * 3 + s.n * 17) % 1200 AS DOUBLE) AS time_eliminated,
         CAST((d.k + s.n * s.n) % 150 AS INT) AS total_damage_to_players,
         CASE WHEN s.n < 5 THEN 'win' ELSE 'loss' END AS outcome
  FROM {source} d LEFT JOIN numbers s ON s.n <= d.k % 9)"""


ROWS = f"{DOCUMENTS}, {_participants('kept', 'rows_in')}"
SILVER = f"{ROWS}, silver AS (SELECT DISTINCT * FROM rows_in)"
FIELDS = (
    "match_id, game_length, puuid, placement, level, gold_left, time_eliminated, "
    "total_damage_to_players"
)

RECORDS = f"""source AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(floor(value * 10) AS INT) AS amount FROM events),
records AS (
  SELECT CAST(user_id AS VARCHAR) AS puuid, ts,
         CASE WHEN k % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
              ELSE strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
         END AS "timestamp",
         'POST' AS request_type,
         CASE event_type
           WHEN 'signup' THEN '/register'
           WHEN 'purchase' THEN '/buy?product='
             || CASE k % 4 WHEN 0 THEN 'battle-pass' WHEN 1 THEN 'chibi' WHEN 2 THEN 'egg'
                ELSE 'tactician' END || '&rp=' || amount
           WHEN 'error' THEN '/status' ELSE '/game/start' END AS endpoint_path,
         CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 500 ELSE 404 END
              WHEN k % 10 = 0 THEN 301 ELSE 200 END AS status_code,
         CAST(event_id % 10000 AS INT) AS response_size, amount AS response_time,
         CASE event_type WHEN 'signup' THEN 'register' WHEN 'purchase' THEN 'transaction'
              WHEN 'error' THEN NULL ELSE 'game-start' END AS action,
         CASE WHEN event_type = 'purchase' THEN
              CASE k % 4 WHEN 0 THEN 'battle-pass' WHEN 1 THEN 'chibi' WHEN 2 THEN 'egg'
              ELSE 'tactician' END END AS product,
         CASE WHEN event_type = 'purchase' THEN amount END AS rp,
         strftime(ts, '{TIME}') AS instant, strftime(ts, '%Y-%m-%d') AS day
  FROM source)"""

DAY_BOUNDS = f"""strftime(date_trunc('day', ts), '{TIME}') AS window_start,
  strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '{TIME}') AS window_end,
  strftime(date_trunc('day', ts), '{TIME}') AS "date\""""


def _rates(keys: str, source: str, base: str) -> str:
    # the cast makes round() half-up on the decimal value, which is what the metric asks for
    share = f"CAST(count(match_id) / (SELECT count(*) FROM {base}) AS DECIMAL(18, 12))"
    return f"""SELECT {keys}, count(match_id) AS total_matches,
  count(*) FILTER (WHERE placement <= 4) AS top_4_matches,
  count(*) FILTER (WHERE placement = 1) AS top_1_matches,
  CAST(round({share}, 4) * 100 AS DOUBLE) AS pick_rate,
  round(count(*) FILTER (WHERE placement <= 4) / count(match_id) * 100, 6) AS top_4_rate,
  round(count(*) FILTER (WHERE placement = 1) / count(match_id) * 100, 6) AS top_1_rate
FROM {source} GROUP BY {keys}"""


PAIRS = """pairs AS (
  SELECT a.match_id, a.puuid, a.placement, a.trait_id AS trait1, b.trait_id AS trait2,
         a.trait_tier AS trait1_tier, b.trait_tier AS trait2_tier,
         a.trait_unit_count AS trait1_unit_count, b.trait_unit_count AS trait2_unit_count,
         a.trait_tier_max AS trait1_tier_max, b.trait_tier_max AS trait2_tier_max
  FROM match_traits a JOIN match_traits b
    ON a.match_id = b.match_id AND a.puuid = b.puuid AND a.placement = b.placement
   AND a.trait_id <> b.trait_id AND a.trait_tier < b.trait_tier
  WHERE a.trait_tier_max > 1 AND b.trait_tier_max > 1)"""

COMPOSITIONS = f"""WITH {TRAITS}, {PAIRS},
combos AS (
  SELECT trait1, trait2, avg(placement) AS avg_placement, count(*) AS total,
         count(*) FILTER (WHERE placement <= 4) AS top_4,
         count(*) FILTER (WHERE placement = 1) AS top_1,
         (trait1_tier / trait1_tier_max) * (trait2_tier / trait2_tier_max) AS depth,
         count(*) / (SELECT count(DISTINCT match_id) FROM match_traits) AS pick_rate
  FROM pairs GROUP BY trait1, trait2, trait1_tier, trait2_tier, trait1_tier_max, trait2_tier_max),
rated AS (
  SELECT *, top_4 / total * 100 AS top_4_rate, top_1 / total * 100 AS top_1_rate FROM combos),
means AS (
  SELECT trait1, trait2,
         avg(8 / avg_placement * depth * pick_rate * top_4_rate * top_1_rate) AS strength,
         avg(avg_placement) AS avg_placement, avg(pick_rate) AS pick_rate,
         avg(top_4_rate) AS top_4_rate, avg(top_1_rate) AS top_1_rate
  FROM rated GROUP BY trait1, trait2)
SELECT trait1, trait2, round(strength, 6) AS strength, round(avg_placement, 6) AS avg_placement,
       round(pick_rate, 6) AS pick_rate, round(top_4_rate, 6) AS top_4_rate,
       round(top_1_rate, 6) AS top_1_rate, rank
FROM (SELECT *, rank() OVER (ORDER BY strength DESC) AS rank FROM means) WHERE rank <= 25"""

CHAMPION_ITEMS = f"""WITH {UNITS}, counted AS ({_rates('unit_id, item', 'match_units', 'match_units')})
SELECT * FROM counted
WHERE item NOT LIKE '%widget%' AND item NOT LIKE '%plate%' AND item NOT LIKE '%ring%'
QUALIFY row_number() OVER (
  PARTITION BY unit_id ORDER BY pick_rate DESC, top_4_rate DESC, item) <= 5"""

SERVER = f"""WITH {RECORDS}
SELECT strftime(date_trunc('hour', ts), '{TIME}') AS window_start,
  strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '{TIME}') AS window_end,
  round(avg(response_time), 6) AS response_time_mean,
  CAST(quantile_disc(response_time, 0.5) AS DOUBLE) AS response_time_50p,
  CAST(quantile_disc(response_time, 0.95) AS DOUBLE) AS response_time_95p,
  CAST(quantile_disc(response_time, 0.99) AS DOUBLE) AS response_time_99p,
  count(*) AS request_count,
  count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS successful_request_count,
  count(*) FILTER (WHERE status_code >= 400) AS failed_request_count,
  round(count(*) FILTER (WHERE status_code >= 400) / count(*), 6) AS server_error_rate
FROM records GROUP BY date_trunc('hour', ts)"""

TRANSACTIONS = f"""WITH {RECORDS}
SELECT product, {DAY_BOUNDS},
  count(*) FILTER (WHERE action = 'transaction') AS transaction_count,
  CAST(sum(CASE WHEN action = 'transaction' THEN rp END) AS BIGINT) AS total_profit
FROM records GROUP BY product, date_trunc('day', ts)"""

ENGAGEMENT = f"""WITH {RECORDS}
SELECT action, {DAY_BOUNDS}, count(DISTINCT puuid) AS unique_users_count,
  count(*) AS requests_count
FROM records GROUP BY action, date_trunc('day', ts)"""

ACTIVITY = f"""WITH {RECORDS}
SELECT {DAY_BOUNDS}, count(*) FILTER (WHERE action = 'register') AS new_user_count,
  count(*) FILTER (WHERE action = 'game-start') AS active_user_count
FROM records GROUP BY date_trunc('day', ts)"""

PLACEMENT_TRANSACTIONS = f"""WITH {RECORDS}, {MATCHES}
SELECT {DAY_BOUNDS}, r.puuid, round(avg(m.placement), 6) AS average_placement,
  count(*) FILTER (WHERE r.action = 'transaction') AS transaction_count
FROM records r JOIN matches m ON r.puuid = m.puuid
GROUP BY date_trunc('day', ts), r.puuid"""

PLACEMENTS = f"""WITH {MATCHES}
SELECT placement, round(avg(gold_left), 6) AS average_gold_left,
  round(avg(time_eliminated), 6) AS average_time_eliminated,
  round(avg(total_damage_to_players), 6) AS average_damage_to_players,
  round(avg(level), 6) AS average_level,
  round(count(*) FILTER (WHERE level <= 6) / count(*) * 100, 6) AS percentage_level_6_or_less,
  round(count(*) FILTER (WHERE level = 7) / count(*) * 100, 6) AS percentage_level_7,
  round(count(*) FILTER (WHERE level = 8) / count(*) * 100, 6) AS percentage_level_8,
  round(count(*) FILTER (WHERE level = 9) / count(*) * 100, 6) AS percentage_level_9,
  round(count(*) FILTER (WHERE level = 10) / count(*) * 100, 6) AS percentage_level_10
FROM matches GROUP BY placement"""

PLAYER_TIERS = f"""WITH {ENTRIES}
SELECT tier, round(avg(wins), 6) AS average_times_won, round(avg(losses), 6) AS average_times_lost,
  count(*) AS count
FROM players GROUP BY tier"""

BRONZE_FIELDS = 'puuid, instant AS "timestamp", request_type'

ENRICHED = f"""WITH {RECORDS}
SELECT {BRONZE_FIELDS}, status_code, response_size, response_time, day AS "date", product, rp,
  action FROM records"""

CHAMPIONS = """SELECT 'C' || p_partkey || '_' || n AS id, p_name AS name,
  CAST((p_partkey + n) % 5 + 1 AS INT) AS tier
FROM part JOIN (SELECT unnest(range(1, 4)) AS n) ON n <= p_partkey % 3 + 1"""

# hourly requests of a stream that took the odd events after the even ones had closed their windows
LATE_ROWS = f"""WITH {RECORDS},
closing AS (
  SELECT max(ts) FILTER (WHERE event_id % 2 = 0) - INTERVAL 10 MINUTE AS first_mark,
         max(ts) - INTERVAL 10 MINUTE AS last_mark FROM events),
hours AS (
  SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('hour', ts) + INTERVAL 1 HOUR AS e
  FROM events)
SELECT strftime(h, '{TIME}') AS window_start, strftime(e, '{TIME}') AS window_end,
  count(*) AS request_count
FROM hours, closing
WHERE (event_id % 2 = 0 OR e > first_mark) AND e <= last_mark GROUP BY h, e"""

# after two deliveries: keys off the fives, then those on the threes with changed values
DELIVERED = "(k % 5 <> 0 OR k % 3 = 0)"
MATCHES_KEPT = MATCHES.replace("matches AS (", "delivered AS (").replace(
    "SELECT CAST", "SELECT o_orderkey AS k, CAST", 1
) + f""",
matches AS (
  SELECT match_id, puuid, CASE WHEN k % 3 = 0 THEN 9 - placement ELSE placement END AS placement,
         CASE WHEN k % 3 = 0 THEN level + 1 ELSE level END AS level, gold_left, time_eliminated,
         total_damage_to_players, tier
  FROM delivered WHERE {DELIVERED})"""
TRAITS_KEPT = TRAITS.replace("match_traits AS (", "delivered AS (") + f""",
match_traits AS (
  SELECT * REPLACE (CAST(CASE WHEN k % 3 = 0 THEN (trait_tier + 1) % 5 ELSE trait_tier END AS INT)
    AS trait_tier) FROM (SELECT *, CAST(puuid AS BIGINT) AS k FROM delivered) WHERE {DELIVERED})"""

WEEKLY = f"""WITH {RECORDS},
spread AS (
  SELECT action, puuid, CAST(date_trunc('day', ts) AS DATE) + CAST(d AS INT) AS day
  FROM records, range(7) AS r(d))
SELECT action, strftime(day, '%Y-%m-%d') AS day, count(DISTINCT puuid) AS users"""

SQL: dict[str, str] = {
    "rate_deltas": f"WITH {MATCHES_KEPT} {_rates('tier, level', 'matches', 'matches')}",
    "placement_deltas": PLACEMENTS.replace(MATCHES, MATCHES_KEPT),
    "composition_deltas": COMPOSITIONS.replace(TRAITS, TRAITS_KEPT),
    "latency_sketches": f"""WITH {RECORDS}
SELECT strftime(date_trunc('day', ts), '{TIME}') AS start, count(*) AS requests,
  true AS response_time_50p_close, true AS response_time_95p_close, true AS response_time_99p_close
FROM records GROUP BY date_trunc('day', ts)""",
    "weekly_users_sketch": WEEKLY + """, count(*) AS requests, true AS estimate_is_close
FROM spread GROUP BY action, day""",
    "weekly_users_bitmap": WEEKLY + " FROM spread GROUP BY action, day",
    "widened_types": """SELECT CASE WHEN odd THEN o_orderkey * 10000000000 ELSE o_orderkey END AS id,
  o_custkey AS player, CASE WHEN odd THEN floor(o_totalprice * 1000000000) ELSE floor(o_totalprice) END
    AS total, CASE WHEN odd THEN round(o_orderkey / 3, 6) ELSE o_orderkey % 8 END AS share
FROM (SELECT *, o_orderkey % 2 = 1 AS odd FROM orders)""",
    "bucket_growth": f"WITH {UPSERT}",
    "z_ordered": f"""WITH {MATCHES} SELECT match_id, puuid, gold_left, level FROM matches
WHERE total_damage_to_players BETWEEN 30 AND 60 AND gold_left BETWEEN 10 AND 19""",
    "stream_quality": f"""WITH {RECORDS}
SELECT count(*) AS arrived, count(*) FILTER (WHERE response_size % 7 = 0) AS undecodable,
  count(*) FILTER (WHERE response_size % 7 <> 0 AND response_size % 5 = 0) AS defaulted,
  count(*) FILTER (WHERE response_size % 7 <> 0) AS kept,
  CAST(sum(response_time) FILTER (WHERE response_size % 7 <> 0) AS BIGINT) AS times,
  count(*) FILTER (WHERE response_size % 7 = 0) AS set_aside
FROM records""",
    "stream_update_server": SERVER,
    "json_inline": CHAMPIONS,
    "static_dedupe": f"""SELECT * FROM ({CHAMPIONS})
QUALIFY row_number() OVER (PARTITION BY name ORDER BY id, tier) = 1""",
    "players_ingest": f"""WITH {ENTRIES}
SELECT *, CAST(NULL AS VARCHAR) AS "processedTime" FROM entries
WHERE "queueType" = 'RANKED_TFT'""",
    "matches_ingest": f"""WITH {ROWS}
SELECT {FIELDS}, outcome,
  CASE WHEN i IS NULL THEN -1 ELSE CAST((k + i) % 4 AS INT) END AS augment_count,
  CASE WHEN i IS NULL THEN -1 ELSE CAST((k + i * 2) % 6 AS INT) END AS trait_count,
  CASE WHEN i IS NULL THEN -1 ELSE CAST((k + i) % 5 AS INT) END AS unit_count
FROM rows_in""",
    "scan_table": f"WITH {MATCHES} SELECT match_id, puuid, placement, level, tier FROM matches",
    "stream_scan": "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events",
    "decode_records": f"""WITH {RECORDS}
SELECT puuid, "timestamp", request_type, endpoint_path, status_code, response_size, response_time
FROM records""",
    "unprocessed_players": f"""WITH {ENTRIES}
SELECT puuid, "queueType", wins FROM marked WHERE "processedTime" IS NULL""",
    "write_partitioned": f"WITH {MATCHES} SELECT match_id, puuid, placement, outcome FROM matches",
    "upsert_merge": f"WITH {UPSERT}",
    "write_or_upsert": f"WITH {UPSERT}",
    "upsert_buckets": f"WITH {UPSERT}",
    "publish_gold": PLAYER_TIERS,
    "publish_runs": f"""WITH {ENTRIES}
SELECT puuid, tier, wins, 'r1' AS run_id FROM players
UNION ALL SELECT puuid, tier, wins, 'r2' FROM players WHERE wins > 25""",
    "stream_append": f"""WITH {RECORDS}
SELECT puuid, instant AS "timestamp", status_code, action, day AS "date" FROM records""",
    "stream_complete": f"""WITH {RECORDS}
SELECT action, status_code, count(*) AS count FROM records GROUP BY action, status_code""",
    "mark_processed": f"WITH {ENTRIES} SELECT * FROM marked",
    "nested_project": f"""WITH {DOCUMENTS}
SELECT match_id, game_length, tft_game_type, tft_set_core_name FROM deliveries""",
    "struct_flatten": f"""WITH {DOCUMENTS}, {_participants('deliveries', 'flat')}
SELECT {FIELDS} FROM flat""",
    "array_to_columns": f"""WITH {SILVER}
SELECT match_id, placement, puuid,
  CASE WHEN (k + i) % 4 >= 1 THEN 'A' || ((c + i + 1) % 40) END AS augment1,
  CASE WHEN (k + i) % 4 >= 2 THEN 'A' || ((c + i + 2) % 40) END AS augment2,
  CASE WHEN (k + i) % 4 >= 3 THEN 'A' || ((c + i + 3) % 40) END AS augment3
FROM silver""",
    "match_summary": f"""WITH {SILVER}
SELECT {FIELDS}, outcome FROM silver""",
    "traits_explode": f"""WITH {SILVER}
SELECT match_id, placement, puuid,
  CASE WHEN n IS NOT NULL THEN 'T' || ((c + i + n * 5) % 29) END AS trait_id,
  CAST(1 + (k + n) % 9 AS INT) AS trait_unit_count, CAST((k + i + n) % 5 AS INT) AS trait_tier,
  CAST(1 + (c + n) % 4 AS INT) AS trait_tier_max
FROM silver LEFT JOIN numbers ON n <= (k + i * 2) % 6""",
    "units_posexplode": f"""WITH {SILVER}
SELECT match_id, placement, puuid, 'U' || ((c + i + u.n * 3) % 60) AS unit_id,
  CASE WHEN (k + u.n + m.n) % 11 <> 0 THEN 'I' || ((c + u.n + m.n) % 50) END AS item,
  CAST(1 + (k + u.n) % 3 AS INT) AS unit_tier, m.n - 1 AS pos, u.n - 1 AS unit_ordinal
FROM silver JOIN numbers u ON u.n <= (k + i) % 5 JOIN numbers m ON m.n <= (k + u.n) % 4
WHERE (k + u.n) % 7 <> 0""",
    "match_filter": f"""WITH {DOCUMENTS}
SELECT match_id, game_length, tft_game_type, tft_set_core_name FROM deliveries
WHERE tft_game_type = 'standard' AND tft_set_core_name = 'TFTSet10'""",
    "solo_matches": f"""WITH {DOCUMENTS}
SELECT match_id, game_length, tft_game_type, tft_set_core_name FROM deliveries
WHERE k % 17 <> 0 OR k % 9 = 0""",
    "item_exclusion": f"""WITH {UNITS} SELECT * FROM match_units
WHERE item NOT LIKE '%widget%' AND item NOT LIKE '%plate%' AND item NOT LIKE '%ring%'""",
    "surrogate_key": f"""WITH {ENTRIES}
SELECT puuid, 1 AS players_with_id, count(*) AS entries FROM entries
WHERE "queueType" = 'RANKED_TFT' GROUP BY puuid""",
    "outcome_label": f"WITH {MATCHES} SELECT match_id, puuid, placement, outcome FROM matches",
    "players_silver": f"WITH {ENTRIES} SELECT * FROM players",
    "wins_only": f"WITH {MATCHES} SELECT match_id, puuid, level FROM matches WHERE outcome = 'win'",
    "dedupe_by_key": f"WITH {SILVER} SELECT {FIELDS}, outcome FROM silver",
    "trait_pairs": f"WITH {TRAITS}, {PAIRS} SELECT *, count(*) AS pair_count FROM pairs GROUP BY ALL",
    "stream_static_join": f"""WITH {RECORDS}, {MATCHES}
SELECT r.puuid, instant AS "timestamp", action, matches_played, placement_sum
FROM records r JOIN (
  SELECT puuid, count(*) AS matches_played, CAST(sum(placement) AS BIGINT) AS placement_sum
  FROM matches GROUP BY puuid) m ON m.puuid = r.puuid""",
    "stream_log_matches": f"""WITH {RECORDS}, {MATCHES}
SELECT r.puuid, instant AS "timestamp", action, match_id, placement
FROM records r JOIN matches m ON m.puuid = r.puuid""",
    "rate_table": f"WITH {MATCHES} {_rates('tier, level', 'matches', 'matches')}",
    "trait_metrics": f"""WITH {TRAITS}, active AS (SELECT * FROM match_traits WHERE trait_tier > 0)
{_rates('trait_id, trait_tier', 'active', 'match_traits')}""",
    "item_metrics": f"WITH {UNITS} {_rates('item', 'match_units', 'match_units')}",
    "champion_metrics": f"WITH {UNITS} {_rates('unit_id, unit_tier', 'match_units', 'match_units')}",
    "champion_item_metrics": CHAMPION_ITEMS,
    "augment_metrics": f"""WITH {AUGMENTS}
{_rates('pick_order, augment_id', 'picks', 'match_augments')}""",
    "composition_metrics": COMPOSITIONS,
    "placement_metrics": PLACEMENTS,
    "player_metrics": PLAYER_TIERS,
    "topk_per_group": f"""WITH {MATCHES}
SELECT tier, level, count(*) AS count FROM matches GROUP BY tier, level
QUALIFY row_number() OVER (PARTITION BY tier ORDER BY count(*) DESC, level) <= 3""",
    "topk_rank_ties": f"""WITH {ENTRIES}
SELECT tier, wins, count, rank FROM (
  SELECT tier, wins, count(*) AS count, rank() OVER (ORDER BY count(*) DESC) AS rank
  FROM players GROUP BY tier, wins)
WHERE rank <= 10""",
    "augment_union": f"""WITH {AUGMENTS}
SELECT pick_order, augment_id, count(*) AS count FROM picks GROUP BY pick_order, augment_id""",
    "distinct_match_ids": f"WITH {ROWS} SELECT DISTINCT match_id FROM rows_in",
    "log_action": f"""WITH {RECORDS}
SELECT endpoint_path, action, count(*) AS requests FROM records GROUP BY endpoint_path, action""",
    "log_product": f"""WITH {RECORDS}
SELECT endpoint_path, product, count(*) AS requests FROM records GROUP BY endpoint_path, product""",
    "log_price": f"""WITH {RECORDS}
SELECT endpoint_path, rp, count(*) AS requests FROM records GROUP BY endpoint_path, rp""",
    "log_date": f"""WITH {RECORDS}
SELECT day AS "date", count(*) AS requests FROM records GROUP BY day""",
    "server_metrics": SERVER,
    "transaction_metrics": TRANSACTIONS,
    "engagement_exact": ENGAGEMENT,
    "engagement_metrics": f"SELECT *, true AS estimate_is_close FROM ({ENGAGEMENT})",
    "player_activity": ACTIVITY,
    "placement_transactions": PLACEMENT_TRANSACTIONS,
    "logs_bronze": f"""WITH {RECORDS}
SELECT {BRONZE_FIELDS}, endpoint_path, status_code, response_size, response_time, day AS "date"
FROM records""",
    "logs_enriched": ENRICHED,
    "stream_chain": ENRICHED,
    "stream_late_rows": LATE_ROWS,
    "stream_restart": "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events",
    "stream_server_metrics": SERVER,
    "stream_engagement_metrics": f"SELECT *, true AS estimate_is_close FROM ({ENGAGEMENT})",
    "stream_transaction_metrics": TRANSACTIONS,
    "stream_player_activity": ACTIVITY,
    "stream_placement_transactions": PLACEMENT_TRANSACTIONS,
}
