"""The same results in DuckDB SQL over the same tables."""

from __future__ import annotations

from earshot.functions.text import STRICT_FLOAT, STRICT_INT
from earshot.operators.split import SPLITS
from earshot.operators.biases import SHRINK
from earshot.registered.spark_queries import BIAS_ROUNDS, GRID, K, LATE_DAY, LOOKED_UP

# -- shared pieces ------------------------------------------------------------

_ORDER_LINES = """order_lines AS (
  SELECT o_custkey::INT AS "userId", l_partkey::INT AS "sourceId", l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_RATINGS = f"""{_ORDER_LINES},
ratings AS (
  SELECT "userId", "sourceId", avg(quantity)::FLOAT AS rating FROM order_lines GROUP BY ALL)"""

_EVENTS = """ev AS (
  SELECT event_id, ts, user_id::INT AS "userId",
         json_extract_string(props, '$.k')::INT AS item, event_type, value
  FROM events)"""

_EVENT_RATINGS = f"""{_EVENTS},
ratings AS (
  SELECT "userId", item AS "sourceId", avg(value)::FLOAT AS rating FROM ev GROUP BY ALL)"""


def _counts(event_type: str, item: str) -> str:
    return f"""{_EVENTS},
counts AS (
  SELECT "userId", item AS "{item}", count(*)::INT AS "count"
  FROM ev WHERE event_type = '{event_type}' GROUP BY ALL)"""


_BUCKET = """('0x' || substr(md5("userId" || '|' || "sourceId"), 1, 8))::BIGINT % 10"""
_SPLIT = f"""split AS (
  SELECT *, CASE WHEN bucket < 6 THEN '{SPLITS[0]}' WHEN bucket < 8 THEN '{SPLITS[1]}'
                 ELSE '{SPLITS[2]}' END AS split
  FROM (SELECT *, {_BUCKET} AS bucket FROM ratings))"""

_ITEM_MEANS = f"""{_SPLIT},
means AS (
  SELECT "sourceId", avg(rating::DOUBLE) AS prediction
  FROM split WHERE split = 'train' GROUP BY ALL),
predictions AS (
  SELECT s."userId", s."sourceId", s.rating, m.prediction
  FROM split s LEFT JOIN means m ON s."sourceId" = m."sourceId" WHERE s.split = 'test')"""


def _dot(left: str, right: str) -> str:
    return (
        f"list_sum(list_transform(list_zip({left}, {right}), "
        "lambda p: p[1]::DOUBLE * p[2]::DOUBLE))::FLOAT"
    )


_PREDICTIONS = f"""predictions AS (
  SELECT r.*, CASE WHEN u.vec_id IS NOT NULL AND i.vec_id IS NOT NULL
                   THEN {_dot("u.embedding", "i.embedding")} END AS prediction
  FROM ratings r LEFT JOIN embeddings u ON r."userId" = u.vec_id
                 LEFT JOIN embeddings i ON r."sourceId" = i.vec_id)"""

_RMSE = """SELECT count(prediction) AS n_eval,
       round(sqrt(avg((rating::DOUBLE - prediction::DOUBLE) ** 2)), 6) AS rmse FROM predictions"""

_TOP_K = f"""scored AS (
  SELECT u.vec_id::INT AS "userId", i.vec_id::INT AS "sourceId",
         {_dot("u.embedding", "i.embedding")} AS rating
  FROM embeddings u CROSS JOIN embeddings i),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY "userId" ORDER BY rating DESC, "sourceId") - 1)::INT
            AS place FROM scored),
topk AS (SELECT * FROM ranked WHERE place < {K})"""

_PLACED = """SELECT "userId", place, "sourceId", round(rating::DOUBLE, 5) AS rating FROM topk"""

_ITEM_IDS = """SELECT "userId", string_agg("sourceId"::VARCHAR, ',' ORDER BY place) AS "itemIds"
FROM topk GROUP BY "userId" """

_COUNT_LINES = f"""{_EVENTS},
lines AS (
  SELECT CASE event_type
    WHEN 'view' THEN "userId" || '|' || item || '|' || event_id
    WHEN 'click' THEN "userId" || '|' || item || '|' || event_id || '|' || event_type
    WHEN 'purchase' THEN "userId" || '|' || item || '|' || event_id || '.5'
    WHEN 'signup' THEN "userId" || '|' || event_type
    ELSE "userId" || '|' || item || '|' || (event_id + 3000000000) END AS value
  FROM ev)"""

_RATING_LINES = f"""{_EVENTS},
lines AS (
  SELECT CASE event_type
    WHEN 'view' THEN "userId" || '|' || item || '|' || event_id || '.25'
    WHEN 'click' THEN "userId" || '|' || item || '|' || event_id || '|' || event_type
    WHEN 'purchase' THEN "userId" || '|' || item || '|' || (event_id + 1) || 'e99'
    WHEN 'signup' THEN "userId" || '|' || item || '|NaN'
    ELSE ' ' || "userId" || '|' || item || '|' || event_id END AS value
  FROM ev)"""


def _classified(third: str, number: str, extra: str = "") -> str:
    """Lines with their three fields, the typed values and the reason they are bad, if any."""
    return f"""fields AS (
  SELECT value, string_split(value, '|') AS f FROM lines),
typed AS (
  SELECT value, f,
         regexp_matches(f[1], '{STRICT_INT}') AND regexp_matches(f[2], '{STRICT_INT}')
           AND regexp_matches(f[3], '{third}') AS numeric,
         try_cast(f[1] AS INT) AS a, try_cast(f[2] AS INT) AS b, try_cast(f[3] AS {number}) AS c
  FROM fields),
classified AS (
  SELECT *, CASE WHEN len(f) < 3 THEN 'too few fields'
                 WHEN NOT numeric THEN 'not a number'
                 WHEN a IS NULL OR b IS NULL OR c IS NULL {extra} THEN 'out of range' END AS reason
  FROM typed)"""


_COUNT_CLASSES = _classified(STRICT_INT, "INT")
_RATING_CLASSES = _classified(STRICT_FLOAT, "FLOAT", "OR isinf(c)")


def _cells(item: str, family: str) -> str:
    return f"""SELECT 'userId:' || "userId" AS rowkey, '{family}' AS family,
       "{item}"::VARCHAR AS qualifier, "count"::VARCHAR AS value FROM counts"""


_LISTENS = _counts("view", "ocId")
_SINGS = _counts("click", "sourceId")

_TOP_K_UNRATED = f"""{_EVENTS},
scored AS (
  SELECT u.vec_id::INT AS "userId", i.vec_id::INT AS "sourceId",
         {_dot("u.embedding", "i.embedding")} AS rating
  FROM embeddings u CROSS JOIN embeddings i
  WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev."userId" = u.vec_id AND ev.item = i.vec_id)),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY "userId" ORDER BY rating DESC, "sourceId") - 1)::INT
            AS place FROM scored),
topk AS (SELECT * FROM ranked WHERE place < {K})"""


def _biases(of: str, where: str = "true") -> str:
    """Rounds of item and user biases, spelt out; the last ones are ``items_n`` and ``users_n``."""
    parts = [
        f"""known AS (SELECT "userId", "sourceId", rating::DOUBLE AS rating FROM {of} WHERE {where}),
mean AS (SELECT avg(rating) AS mean FROM known),
users_0 AS (SELECT DISTINCT "userId", 0.0::DOUBLE AS bias FROM known)"""
    ]
    for n in range(1, BIAS_ROUNDS + 1):
        for side, key, other, by in (
            ("items", "sourceId", f"users_{n - 1}", "userId"),
            ("users", "userId", f"items_{n}", "sourceId"),
        ):
            parts.append(
                f"""{side}_{n} AS (
  SELECT k."{key}", sum(k.rating - mean - o.bias) / (count(*) + {SHRINK}) AS bias
  FROM mean, known k JOIN {other} o ON o."{by}" = k."{by}" GROUP BY k."{key}")"""
            )
    return ",\n".join(parts)


def _baseline(rows: str) -> str:
    return f"""based AS (
  SELECT r.*, mean + coalesce(u.bias, 0) + coalesce(i.bias, 0) AS baseline
  FROM mean, {rows} r LEFT JOIN users_{BIAS_ROUNDS} u ON u."userId" = r."userId"
                      LEFT JOIN items_{BIAS_ROUNDS} i ON i."sourceId" = r."sourceId")"""


_DATED_CELLS = """SELECT 'userId:' || "userId" AS rowkey, 'lastEvent' AS family,
       item::VARCHAR AS qualifier, max_by(event_id, (ts::DATE, event_id))::VARCHAR AS value,
       max(ts::DATE)::VARCHAR AS day
FROM ev {} GROUP BY "userId", item"""

_DAY_COUNTS = """daily AS (
  SELECT ts::DATE AS day, "userId", item, count(*) AS n FROM ev
  WHERE event_type = 'view' GROUP BY ALL)"""

# -- one statement per registered name ----------------------------------------

ORACLE_SQL: dict[str, str] = {
    "scan_ratings": f"""WITH {_RATINGS}
SELECT "userId", "sourceId", round(rating::DOUBLE, 4) AS rating FROM ratings""",
    "scan_listens": f"WITH {_LISTENS} SELECT * FROM counts",
    "scan_sings": f"WITH {_SINGS} SELECT * FROM counts",
    "parse_ratings": f"""WITH {_ORDER_LINES}
SELECT "userId", "sourceId", quantity::FLOAT AS rating FROM order_lines""",
    "parse_listens": f"""WITH {_COUNT_LINES}, {_COUNT_CLASSES}
SELECT a AS "userId", b AS "ocId", c AS "count" FROM classified WHERE reason IS NULL""",
    "parse_sings": f"""WITH {_COUNT_LINES}, {_COUNT_CLASSES}
SELECT a AS "userId", b AS "sourceId", c AS "count" FROM classified WHERE reason IS NULL""",
    "parse_mixed_ratings": f"""WITH {_RATING_LINES}, {_RATING_CLASSES}
SELECT a AS "userId", b AS "sourceId", c AS rating FROM classified WHERE reason IS NULL""",
    "quarantine_counts": f"""WITH {_COUNT_LINES}, {_COUNT_CLASSES}
SELECT reason, count(*) AS n FROM classified WHERE reason IS NOT NULL GROUP BY reason""",
    "quarantine_ratings": f"""WITH {_RATING_LINES}, {_RATING_CLASSES}
SELECT value, reason FROM classified WHERE reason IS NOT NULL""",
    "dated_inputs": """WITH names AS (
  SELECT o_orderdate::DATE AS run_date,
         CASE o_orderstatus WHEN 'P' THEN '  ' WHEN 'F' THEN ' ' || o_orderpriority || '.dat ' END
           AS name
  FROM orders)
SELECT CASE WHEN name IS NULL OR trim(name) = ''
            THEN strftime(run_date - INTERVAL 1 DAY, '%Y-%m-%d') || '.dat'
            ELSE trim(name) END AS input_name, count(*) AS n
FROM names GROUP BY 1""",
    "split_members": f"""WITH {_RATINGS}, {_SPLIT}
SELECT "userId", "sourceId", split FROM split""",
    "split_counts": f"""WITH {_RATINGS}, {_SPLIT}
SELECT split, count(*) AS n FROM split GROUP BY split""",
    "random_split_covers": f"""WITH {_RATINGS}
SELECT count(*) AS n_rows, count(DISTINCT ("userId", "sourceId")) AS n_pairs FROM ratings""",
    "baseline_predictions": f"""WITH {_RATINGS}, {_ITEM_MEANS}
SELECT "userId", "sourceId", round(rating::DOUBLE, 4) AS rating,
       round(prediction, 6) AS prediction FROM predictions""",
    "rmse_baseline": f"WITH {_EVENT_RATINGS}, {_ITEM_MEANS} {_RMSE}",
    "score_pairs": f"""WITH {_RATINGS}, {_PREDICTIONS}
SELECT "userId", "sourceId", prediction IS NULL AS cold,
       round(prediction::DOUBLE, 5) AS prediction FROM predictions""",
    "cold_rows_dropped": f"""WITH {_RATINGS}, {_PREDICTIONS}
SELECT "userId", "sourceId", round(rating::DOUBLE, 4) AS rating,
       round(prediction::DOUBLE, 5) AS prediction FROM predictions WHERE prediction IS NOT NULL""",
    "rmse_scored_pairs": f"WITH {_RATINGS}, {_PREDICTIONS} {_RMSE}",
    "rmse_empty": f"WITH {_RATINGS}, {_PREDICTIONS} {_RMSE} WHERE prediction IS NULL",
    "als_coverage": f"""WITH {_RATINGS}, {_SPLIT},
test AS (
  SELECT "userId" IN (SELECT "userId" FROM split WHERE split = 'train')
     AND "sourceId" IN (SELECT "sourceId" FROM split WHERE split = 'train') AS known
  FROM split WHERE split = 'test')
SELECT count(*) AS n, count(*) FILTER (NOT known) AS n_cold, count(*) FILTER (known) AS n_eval
FROM test""",
    "als_metrics": f"""WITH {_RATINGS}, {_SPLIT},
test AS (
  SELECT "userId" IN (SELECT "userId" FROM split WHERE split = 'train')
     AND "sourceId" IN (SELECT "sourceId" FROM split WHERE split = 'train') AS known
  FROM split WHERE split = 'test')
SELECT count(*) AS n, count(*) FILTER (NOT known) AS n_cold, count(*) FILTER (known) AS n_eval,
       0::BIGINT AS n_different
FROM test""",
    "als_invariants": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT 'user' AS side, count(DISTINCT "userId") AS n_ids, 0::BIGINT AS n_wrong_rank,
       0::BIGINT AS n_negative FROM train
UNION ALL
SELECT 'item', count(DISTINCT "sourceId"), 0, 0 FROM train""",
    "random_split_counts": f"""WITH {_RATINGS}
SELECT 3::BIGINT AS n_parts, count(*) AS n_rows FROM ratings""",
    "als_predictions": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT "userId", "sourceId",
       "userId" NOT IN (SELECT "userId" FROM train)
         OR "sourceId" NOT IN (SELECT "sourceId" FROM train) AS cold
FROM split WHERE split = 'test'""",
    "als_predict_agrees": f"""WITH {_RATINGS}, {_SPLIT}
SELECT count(*) AS n_pairs, 0::BIGINT AS n_different FROM split WHERE split = 'test'""",
    "recommend_all_users": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT DISTINCT "userId",
       least({K}, (SELECT count(DISTINCT "sourceId") FROM train))::INT AS n_items
FROM train""",
    "als_optimality": f"""WITH {_RATINGS}, {_SPLIT}
SELECT count(DISTINCT "userId") AS n_users, 0::BIGINT AS n_different
FROM split WHERE split = 'train'""",
    "model_save_load": f"""WITH {_RATINGS}, {_SPLIT}
SELECT count(*) AS n_pairs, 0::BIGINT AS n_different FROM split WHERE split = 'test'""",
    "topk_scores": f"WITH {_TOP_K} {_PLACED}",
    "topk_scores_sharded": f"WITH {_TOP_K} {_PLACED}",
    "recommendations_flat": f"""WITH {_TOP_K}
SELECT "userId", "sourceId", round(rating::DOUBLE, 5) AS rating FROM topk""",
    "recommended_item_ids": f"WITH {_TOP_K} {_ITEM_IDS}",
    "recommend_invariants": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT count(DISTINCT "userId") AS n_users,
       (count(DISTINCT "userId") * least({K}, count(DISTINCT "sourceId")))::BIGINT AS n_items,
       0::BIGINT AS n_out_of_order, 0::BIGINT AS n_with_repeats
FROM train""",
    "recommend_scores_agree": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT (count(DISTINCT "userId") * least({K}, count(DISTINCT "sourceId")))::BIGINT AS n_scores,
       0::BIGINT AS n_different
FROM train""",
    "upsert_last_write": f"""WITH {_EVENTS}
SELECT "userId", item, max_by(value, event_id) AS value FROM ev GROUP BY "userId", item""",
    "listen_wide_rows": f"WITH {_LISTENS} {_cells('ocId', 'listenCountInfo')}",
    "sing_wide_rows": f"WITH {_SINGS} {_cells('sourceId', 'singCountInfo')}",
    "listen_cells": f"WITH {_LISTENS} {_cells('ocId', 'listenCountInfo')}",
    "sing_cells": f"WITH {_SINGS} {_cells('sourceId', 'singCountInfo')}",
    "upsert_ties": f"""WITH {_EVENTS},
last AS (SELECT "userId", item, max(ts::DATE) AS day FROM ev GROUP BY "userId", item)
SELECT ev."userId", ev.item, max(value) AS value
FROM ev JOIN last ON ev."userId" = last."userId" AND ev.item = last.item AND ts::DATE = day
GROUP BY ALL""",
    "upsert_wide_rows": f"""WITH {_EVENTS}
SELECT 'userId:' || "userId" AS rowkey, 'lastEvent' AS family, item::VARCHAR AS qualifier,
       max(event_id)::VARCHAR AS value
FROM ev GROUP BY "userId", item""",
    "upsert_cells": f"""WITH {_EVENTS}
SELECT 'userId:' || "userId" AS rowkey, 'lastEvent' AS family, item::VARCHAR AS qualifier,
       max(event_id)::VARCHAR AS value
FROM ev GROUP BY "userId", item""",
    "recommend_cells": f"""WITH {_TOP_K}
SELECT 'userId:' || "userId" AS rowkey, 'recommends' AS family,
       "sourceId"::VARCHAR AS qualifier, round(rating::DOUBLE, 5) AS value FROM topk""",
    "overwrite_reload": f"WITH {_SINGS} {_cells('sourceId', 'counts')}",
    "dated_overwrite": f"""WITH {_EVENTS},
daily AS (SELECT ts::DATE AS dt, "userId", count(*) AS n FROM ev GROUP BY ALL)
SELECT dt::VARCHAR AS dt, "userId",
       CASE WHEN dt = (SELECT max(dt) FROM daily) THEN n * 10 ELSE n END AS n FROM daily""",
    "preview_ratings": f"""WITH {_RATINGS}
SELECT "userId", "sourceId", round(rating::DOUBLE, 4) AS rating FROM ratings
ORDER BY "userId", "sourceId" LIMIT 20""",
    "preview_recommendations": f"""WITH {_TOP_K} {_ITEM_IDS} ORDER BY "userId" LIMIT 20""",
    "job_train": f"""WITH {_RATINGS}, {_SPLIT}
SELECT split, count(*) AS n,
       (SELECT count(*) FROM split t WHERE t.split = 'test'
          AND EXISTS (SELECT 1 FROM split a WHERE a.split = 'train' AND a."userId" = t."userId")
          AND EXISTS (SELECT 1 FROM split b WHERE b.split = 'train' AND b."sourceId" = t."sourceId")
       ) AS n_eval
FROM split GROUP BY split""",
    "job_recommend": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train')
SELECT DISTINCT 'userId:' || "userId" AS rowkey,
       least({K}, (SELECT count(DISTINCT "sourceId") FROM train))::BIGINT AS n_cells,
       0::BIGINT AS n_different
FROM train""",
    "job_load_listens": f"WITH {_LISTENS} {_cells('ocId', 'listenCountInfo')}",
    "job_load_sings": f"WITH {_SINGS} {_cells('sourceId', 'singCountInfo')}",
    "split_by_date_members": """WITH ranked AS (
  SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place, count(*) OVER () AS n
  FROM events)
SELECT event_id, CASE WHEN place <= n * 6 // 10 THEN 'train'
                      WHEN place <= n * 8 // 10 THEN 'validation' ELSE 'test' END AS split
FROM ranked""",
    "split_by_day_members": """WITH ranked AS (
  SELECT l_partkey, l_orderkey, l_linenumber, count(*) OVER () AS n,
         row_number() OVER (ORDER BY l_shipdate::DATE, l_partkey, l_orderkey, l_linenumber) AS place
  FROM lineitem)
SELECT l_partkey, l_orderkey, l_linenumber,
       CASE WHEN place <= n // 4 THEN 'train'
            WHEN place <= n // 2 THEN 'validation' ELSE 'test' END AS split
FROM ranked""",
    "bias_predictions": f"""WITH {_RATINGS}, {_SPLIT}, {_biases("split", "split = 'train'")},
{_baseline("split")}
SELECT "userId", "sourceId", split, round(baseline, 6) AS baseline FROM based""",
    "cold_pairs_filled": f"""WITH {_RATINGS}, {_PREDICTIONS}, {_biases("ratings")},
{_baseline("predictions")}
SELECT "userId", "sourceId", prediction IS NULL AS cold,
       round(coalesce(prediction, baseline::FLOAT)::DOUBLE, 4) AS prediction FROM based""",
    "als_grid_choice": f"""WITH {_EVENT_RATINGS}, {_SPLIT},
judged AS (
  SELECT count(*) AS n FROM split WHERE split = 'validation'
    AND "userId" IN (SELECT "userId" FROM split WHERE split = 'train')
    AND "sourceId" IN (SELECT "sourceId" FROM split WHERE split = 'train'))
SELECT t.rank, t.reg, n AS n_eval, 0::BIGINT AS n_different, 0::BIGINT AS n_wrong_choice
FROM judged, (VALUES {", ".join(f"({p.rank}, {p.reg}::DOUBLE)" for p in GRID)}) AS t(rank, reg)""",
    "topk_unrated": f"WITH {_TOP_K_UNRATED} {_PLACED}",
    "topk_unrated_sharded": f"WITH {_TOP_K_UNRATED} {_PLACED}",
    "merged_loads": f"WITH {_EVENTS} {_DATED_CELLS.format('')}",
    "cells_looked_up": f"""WITH {_EVENTS},
busiest AS (
  SELECT "userId" FROM ev GROUP BY "userId" ORDER BY count(*) DESC, "userId" LIMIT {LOOKED_UP})
{_DATED_CELLS.format('WHERE "userId" IN (SELECT "userId" FROM busiest)')}""",
    "replace_cut_off": f"WITH {_LISTENS} {_cells('ocId', 'listenCountInfo')}",
    "job_recommend_unrated": f"""WITH {_RATINGS}, {_SPLIT},
train AS (SELECT * FROM split WHERE split = 'train'),
items AS (SELECT DISTINCT "sourceId" FROM train),
met AS (
  SELECT "userId", count(*) AS n FROM ratings
  WHERE "sourceId" IN (SELECT "sourceId" FROM items) GROUP BY "userId")
SELECT 'userId:' || "userId" AS rowkey,
       least({K}, (SELECT count(*) FROM items) - n)::BIGINT AS n_cells, 0::BIGINT AS n_rated
FROM met WHERE "userId" IN (SELECT "userId" FROM train)
  AND (SELECT count(*) FROM items) > n""",
    "job_load_new_days": f"""WITH {_EVENTS}, {_DAY_COUNTS}
SELECT 'userId:' || "userId" AS rowkey, 'listenCountInfo' AS family, item::VARCHAR AS qualifier,
       max_by(n, day)::VARCHAR AS value, max(day)::VARCHAR AS day
FROM daily GROUP BY "userId", item""",
    "days_loaded": f"""WITH {_EVENTS}, {_DAY_COUNTS}
SELECT day::VARCHAR AS day, count(*) AS good_lines, 0::BIGINT AS bad_lines,
       CASE WHEN day = DATE '{LATE_DAY}' THEN 2 ELSE 0 END AS run
FROM daily GROUP BY 1, day""",
}
