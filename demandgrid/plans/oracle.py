"""DuckDB SQL that answers the catalogue's queries independently of Spark."""

from __future__ import annotations

PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _calendar_day(ts: str) -> str:
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))::INTEGER"


def _clean(category: str) -> str:
    return f"regexp_replace(trim(lower({category})), '[^a-z0-9 ]', '', 'g')"


def _is_train(day: str, hour: str, category: str) -> str:
    return f"(('0x' || substr(md5(concat_ws(':', {day}, {hour}, {category})), 1, 4))::INTEGER % 10 < 8)"


_TYPE_SUMS = ", ".join(f"sum(CASE WHEN p_type = '{t}' THEN l_quantity::BIGINT END)::BIGINT AS \"{t}\"" for t in PART_TYPES)
_TYPE_COLUMNS = ", ".join(f'"{t}"' for t in PART_TYPES)

WIDE = f"""
per_order AS (
    SELECT l_orderkey, {_TYPE_SUMS}
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
wide AS (
    SELECT o_orderkey AS order_id, dayofweek(o_orderdate)::INTEGER AS order_dow,
        (o_orderkey % 24)::INTEGER AS order_hour_of_day,
        date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
            o_orderdate)::DOUBLE AS days_since_prior_order,
        {_TYPE_COLUMNS}
    FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey),
long AS (
    SELECT order_dow AS day_of_week, order_hour_of_day AS hour_of_day, category, items_count
    FROM (UNPIVOT wide ON {_TYPE_COLUMNS} INTO NAME category VALUE items_count)
    WHERE items_count > 0),
cube AS (
    SELECT day_of_week, hour_of_day, category, sum(items_count)::BIGINT AS items_count
    FROM long GROUP BY ALL)
"""
CUBE = f"WITH {WIDE} SELECT * FROM cube"

EVENTS = f"""
e AS (
    SELECT event_id, {_calendar_day("ts")} AS day, dayofweek(ts)::INTEGER AS day_of_week,
        hour(ts)::INTEGER AS hour_of_day, event_type AS category
    FROM events),
cells AS (
    SELECT day_of_week, hour_of_day, category, count(*)::BIGINT AS items_count FROM e GROUP BY ALL)
"""
EVENT_CUBE = f"WITH {EVENTS} SELECT * FROM cells"

LINEITEM = """
cells AS (
    SELECT dayofweek(l_shipdate)::INTEGER AS day_of_week, (l_orderkey % 24)::INTEGER AS hour_of_day,
        p_name AS category, sum(l_quantity::BIGINT)::BIGINT AS items_count
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
"""

TRAINING = f"""
training AS (
    SELECT day_of_week, hour_of_day, {_clean("category")} AS category_clean, items_count::DOUBLE AS total_count
    FROM cells WHERE items_count > 0),
split AS (
    SELECT *, {_is_train("day_of_week", "hour_of_day", "category_clean")} AS is_train FROM training)
"""

PREDICTIONS = f"""
{EVENTS}, {TRAINING},
by_hour AS (
    SELECT category_clean, hour_of_day, avg(total_count) AS hour_mean FROM split WHERE is_train GROUP BY ALL),
overall AS (
    SELECT category_clean, avg(total_count) AS category_mean FROM split WHERE is_train GROUP BY ALL),
grid AS (
    SELECT d::INTEGER AS day_of_week, h::INTEGER AS hour_of_day, category_clean AS category
    FROM range(7) AS a(d), range(24) AS b(h), (SELECT DISTINCT category_clean FROM training)),
p AS (
    SELECT day_of_week, grid.hour_of_day, category, round(coalesce(hour_mean, category_mean), 2) AS prediction
    FROM grid LEFT JOIN by_hour b ON grid.category = b.category_clean AND grid.hour_of_day = b.hour_of_day
        LEFT JOIN overall o ON grid.category = o.category_clean)
"""

REQUESTS = """
requests AS (
    SELECT 'event-' || event_id AS request_id, day_of_week, hour_of_day,
        ' ' || upper(category[1]) || lower(category[2:]) || '  ' AS category FROM e
    UNION ALL
    SELECT 'order-' || o_orderkey, dayofweek(o_orderdate)::INTEGER, (o_orderkey % 24)::INTEGER, o_orderpriority
    FROM orders)
"""
LOOKED_UP = f"""
{PREDICTIONS}, {REQUESTS},
looked AS (
    SELECT r.*, p.prediction, p.prediction IS NOT NULL AS found
    FROM requests r LEFT JOIN p ON r.day_of_week = p.day_of_week AND r.hour_of_day = p.hour_of_day
        AND {_clean("r.category")} = p.category)
"""

DAYS = f"""
available AS (SELECT DISTINCT {_calendar_day("l_shipdate")} AS day FROM lineitem),
ledger AS (
    SELECT {_calendar_day("o_orderdate")} AS day, min(o_orderkey) AS batch_id FROM orders GROUP BY ALL)
"""
_BEST_FIRST = "prediction DESC, day_of_week, hour_of_day, category"
_ARRIVAL = "CASE WHEN day <= 20240115 THEN 0 ELSE 1 END"

_ENTRIES = """, indexed AS (SELECT *, (dense_rank() OVER (ORDER BY category_clean) + 1)::INTEGER AS i FROM training)
        SELECT day_of_week, hour_of_day, category_clean, unnest([0, 1, i])::INTEGER AS feature_position,
            unnest([day_of_week, hour_of_day, 1])::DOUBLE AS feature_value FROM indexed"""

ORACLE: dict[str, str] = {
    "wide_orders": f"WITH {WIDE} SELECT * FROM wide",
    "cube_full_sparse": CUBE,
    "plain_layout_cube": CUBE,
    "cube_full": CUBE,
    "cube_events": EVENT_CUBE,
    "cube_lineitem": f"WITH {LINEITEM} SELECT * FROM cells",
    "category_columns": f"""WITH {WIDE},
        names AS (SELECT unnest({PART_TYPES}) AS category, unnest(range({len(PART_TYPES)}))::INTEGER AS position)
        SELECT position, category, (SELECT count(*) FROM long WHERE long.category = names.category) AS orders_with_items
        FROM names""",
    "wide_to_long_positive": f"WITH {WIDE} SELECT * FROM long",
    "cube_summary": f"""WITH {WIDE} SELECT count(*) AS combinations, count(DISTINCT category) AS categories,
        count(DISTINCT day_of_week) AS days, count(DISTINCT hour_of_day) AS hours FROM cube""",
    "sample_rows": f"WITH {WIDE} SELECT * FROM cube ORDER BY day_of_week, hour_of_day, category LIMIT 20",
    "distinct_days": "SELECT DISTINCT dayofweek(ts)::INTEGER AS day FROM events",
    "full_aggregation_job": f"""WITH {WIDE} SELECT count(*) AS combinations, count(DISTINCT category) AS categories,
        count(DISTINCT day_of_week) AS days, count(DISTINCT hour_of_day) AS hours,
        (SELECT count(*) FROM wide) AS orders_loaded FROM cube""",
    "day_split_counts": """SELECT d::INTEGER AS day_of_week, count(event_id) AS row_count
        FROM range(7) AS r(d) LEFT JOIN events ON dayofweek(ts) = d GROUP BY d""",
    "single_day_cube": f"WITH {WIDE} SELECT * FROM cube WHERE day_of_week = 6",
    "csv_roundtrip_cube": CUBE,
    "cube_source_choice": f"WITH {EVENTS} SELECT *, 'incremental' AS source FROM cells",
    "landed_days": f"WITH {EVENTS} SELECT DISTINCT day FROM e",
    "unprocessed_days": f"WITH {DAYS} SELECT day FROM available WHERE day NOT IN (SELECT day FROM ledger)",
    "day_states": f"""WITH {DAYS} SELECT coalesce(a.day, l.day) AS day, a.day IS NOT NULL AS is_available,
        l.day IS NOT NULL AS is_processed FROM available a FULL JOIN ledger l ON a.day = l.day""",
    "processing_status": f"""WITH {DAYS},
        pending AS (SELECT day FROM available WHERE day NOT IN (SELECT day FROM ledger))
        SELECT (SELECT count(*) FROM available) AS available_days, (SELECT count(*) FROM ledger) AS processed_days,
        (SELECT count(*) FROM pending) AS unprocessed_days, (SELECT min(day) FROM pending) AS next_day,
        (SELECT day FROM ledger ORDER BY batch_id DESC, day DESC LIMIT 1) AS last_processed_day""",
    "last_processed_day": f"""WITH {DAYS}
        SELECT day AS last_processed_day FROM ledger ORDER BY batch_id DESC, day DESC LIMIT 1""",
    "ledger_consistency": f"""WITH {DAYS}
        SELECT day, 'first' AS only_in FROM ledger WHERE day NOT IN (SELECT day FROM available)
        UNION ALL SELECT day, 'second' FROM available WHERE day NOT IN (SELECT day FROM ledger)""",
    "incremental_cube_all_days": CUBE,
    "incremental_compacted": CUBE,
    "incremental_replay": CUBE,
    "incremental_expired": CUBE,
    "incremental_expired_ledger": f"""WITH {WIDE} SELECT DISTINCT order_dow AS day,
        CASE WHEN order_dow IN (6, 0) THEN 0 WHEN order_dow = 3 THEN 1 ELSE 2 END::BIGINT AS batch_id FROM wide""",
    "incremental_folded_headers": f"""WITH {WIDE},
        batches AS (SELECT d::INTEGER AS day_of_week,
            CASE WHEN d IN (0, 3) THEN 0 WHEN d IN (1, 2, 5) THEN 1 ELSE 2 END AS batch_id FROM range(7) AS r(d)),
        own AS (SELECT order_dow AS day_of_week, order_hour_of_day AS hour_of_day, 'ONLY ' || batch_id AS category,
            count(*)::BIGINT AS items_count FROM wide JOIN batches ON order_dow = day_of_week GROUP BY ALL)
        SELECT c.*, batch_id::BIGINT AS batch_id FROM (SELECT * FROM cube UNION ALL SELECT * FROM own) c
        JOIN batches USING (day_of_week)""",
    "incremental_supervised": EVENT_CUBE,
    "incremental_mixed_feed": CUBE,
    "incremental_torn_batch": CUBE,
    "incremental_folded_days": CUBE,
    "incremental_no_new_data": f"""WITH {WIDE} SELECT DISTINCT order_dow AS day,
        CASE WHEN order_dow IN (6, 0) THEN 0 WHEN order_dow = 3 THEN 1 ELSE 2 END::BIGINT AS batch_id FROM wide""",
    "late_day_excluded": CUBE,
    "late_day_report": f"""WITH {WIDE} SELECT order_dow AS day, count(*) AS order_rows,
        CASE WHEN order_dow = 0 THEN count(*) ELSE 0 END::BIGINT AS late_rows FROM wide GROUP BY order_dow""",
    "incremental_periodic": EVENT_CUBE,
    "normalize_categories": f"""WITH spelled AS (
            SELECT p_partkey, 'name' AS spelling, p_name AS category FROM part
            UNION ALL SELECT p_partkey, 'shouted', '  ' || upper(replace(p_name, ' ', '_')) || ' ' FROM part
            UNION ALL SELECT p_partkey, 'brand', p_brand FROM part)
        SELECT *, {_clean("category")} AS category_clean FROM spelled""",
    "training_rows": f"WITH {LINEITEM}, {TRAINING} SELECT * FROM training",
    "training_summary": f"""WITH {LINEITEM}, {TRAINING} SELECT count(*) AS total_records,
        count(DISTINCT category_clean) AS unique_categories, count(DISTINCT hour_of_day) AS unique_hours,
        count(DISTINCT day_of_week) AS unique_days FROM training""",
    "hash_split": f"WITH {LINEITEM}, {TRAINING} SELECT * FROM split",
    "category_index": f"""WITH {EVENTS}, {TRAINING} SELECT category_clean,
        (row_number() OVER (ORDER BY category_clean) - 1)::INTEGER AS category_index
        FROM (SELECT DISTINCT category_clean FROM training)""",
    "feature_rows": f"""WITH {EVENTS}, {TRAINING},
        indexed AS (SELECT *, dense_rank() OVER (ORDER BY category_clean) - 1 AS i FROM training),
        positions AS (SELECT unnest(range((SELECT 2 + count(DISTINCT category_clean) FROM training))) AS pos)
        SELECT day_of_week, hour_of_day, category_clean, pos::INTEGER AS feature_position,
        CASE WHEN pos = 0 THEN day_of_week WHEN pos = 1 THEN hour_of_day WHEN pos = i + 2 THEN 1 ELSE 0 END::DOUBLE
        AS feature_value FROM indexed, positions""",
    "feature_entries": f"WITH {EVENTS}, {TRAINING}{_ENTRIES}",
    "feature_entries_lineitem": f"WITH {LINEITEM}, {TRAINING}{_ENTRIES}",
    "back_off_candidates": f"""WITH {LINEITEM}, {TRAINING},
        train AS (SELECT * FROM split WHERE is_train),
        hours AS (SELECT category_clean, hour_of_day, avg(total_count) AS m FROM train GROUP BY ALL),
        categories AS (SELECT category_clean, avg(total_count) AS m FROM train GROUP BY ALL),
        grand AS (SELECT avg(total_count) AS m FROM train),
        test AS (SELECT total_count AS y, grand.m AS g, coalesce(c.m, grand.m) AS c, coalesce(h.m, c.m, grand.m) AS h
            FROM split s LEFT JOIN hours h USING (category_clean, hour_of_day) LEFT JOIN categories c USING (category_clean), grand
            WHERE NOT is_train),
        errors AS (
            SELECT 1 AS position, 'grand_mean' AS candidate, round(sqrt(avg((g - y) ** 2)), 6) AS rmse FROM test
            UNION ALL SELECT 2, 'category_mean', round(sqrt(avg((c - y) ** 2)), 6) FROM test
            UNION ALL SELECT 3, 'hour_mean', round(sqrt(avg((h - y) ** 2)), 6) FROM test)
        SELECT candidate, rmse, (SELECT count(*) FROM test) AS compared_cells,
            position = (SELECT position FROM errors ORDER BY rmse, position LIMIT 1) AS is_selected FROM errors""",
    "isolating_tree_scores": f"""WITH {EVENTS} SELECT day_of_week, hour_of_day, category,
        items_count::DOUBLE AS prediction, true AS known_category FROM cells""",
    "least_squares_scores": f"""WITH {EVENTS},
        means AS (SELECT category, avg(day_of_week) AS d, avg(hour_of_day) AS h, avg(items_count) AS y FROM cells GROUP BY category),
        centred AS (SELECT day_of_week - m.d AS d, hour_of_day - m.h AS h, items_count - m.y AS y FROM cells JOIN means m USING (category)),
        sums AS (SELECT sum(d * d) AS dd, sum(d * h) AS dh, sum(h * h) AS hh, sum(d * y) AS dy, sum(h * y) AS hy FROM centred),
        slopes AS (SELECT (dy * hh - hy * dh) / (dd * hh - dh * dh) AS a, (hy * dd - dy * dh) / (dd * hh - dh * dh) AS b FROM sums)
        SELECT day_of_week, hour_of_day, category, round(y + a * (day_of_week - d) + b * (hour_of_day - h), 2) AS prediction,
            true AS known_category FROM cells JOIN means USING (category), slopes""",
    "rmse_baseline": f"""WITH {PREDICTIONS}
        SELECT round(sqrt(avg((prediction - total_count) ** 2)), 6) AS rmse
        FROM split s JOIN p ON s.day_of_week = p.day_of_week AND s.hour_of_day = p.hour_of_day
            AND s.category_clean = p.category
        WHERE NOT is_train""",
    "best_candidate": f"""WITH {PREDICTIONS},
        test AS (SELECT s.total_count AS y, hour_mean, category_mean,
                (SELECT avg(total_count) FROM split WHERE is_train) AS grand_mean
            FROM split s JOIN by_hour b ON s.category_clean = b.category_clean AND s.hour_of_day = b.hour_of_day
                JOIN overall o ON s.category_clean = o.category_clean WHERE NOT is_train),
        errors AS (
            SELECT 1 AS position, 'grand_mean' AS candidate, sqrt(avg((grand_mean - y) ** 2)) AS rmse FROM test
            UNION ALL SELECT 2, 'category_mean', sqrt(avg((category_mean - y) ** 2)) FROM test
            UNION ALL SELECT 3, 'hour_mean', sqrt(avg((hour_mean - y) ** 2)) FROM test)
        SELECT position, candidate, round(rmse, 6) AS rmse FROM errors ORDER BY errors.rmse, position LIMIT 1""",
    "model_roundtrip_scores": f"""WITH {EVENTS} SELECT day_of_week, hour_of_day, category,
        true AS known_category, true AS is_same FROM cells""",
    "retrain_on_change": f"""WITH {EVENTS},
        arrived AS (
            SELECT b::BIGINT AS batch_id, day_of_week, hour_of_day, category, count(*) AS n
            FROM range(2) AS r(b) JOIN e ON {_ARRIVAL} <= b GROUP BY ALL)
        SELECT batch_id, 3::BIGINT AS candidates, 1::BIGINT AS selected,
            count(*) FILTER ({_is_train("day_of_week", "hour_of_day", "category")}) AS train_rows,
            count(*) FILTER (NOT {_is_train("day_of_week", "hour_of_day", "category")}) AS test_rows
        FROM arrived GROUP BY batch_id""",
    "refresh_on_change": f"""WITH {EVENTS}
        SELECT 168 * count(DISTINCT category) AS total_predictions, 'batch-' || b AS model_version,
            count(DISTINCT category) AS categories_count, '0-6' AS days_range, '0-23' AS hours_range,
            (b + 1)::INTEGER AS version
        FROM range(2) AS r(b) JOIN e ON {_ARRIVAL} <= b GROUP BY b""",
    "grid": f"WITH {PREDICTIONS} SELECT * FROM grid",
    "seasonal_adjustment": f"""WITH {EVENTS},
        weekend AS (SELECT *, CASE WHEN day_of_week IN (0, 6) THEN trunc(items_count * 1.5::DOUBLE)
            ELSE items_count END AS s1 FROM cells),
        peak AS (SELECT *, CASE WHEN hour_of_day IN (7, 8, 9, 17, 18, 19) THEN trunc(s1 * 1.8::DOUBLE)
            ELSE s1 END AS s2 FROM weekend)
        SELECT day_of_week, hour_of_day, category, items_count,
            CASE WHEN hour_of_day < 6 OR hour_of_day > 22 THEN trunc(s2 * 0.3::DOUBLE) ELSE s2 END::BIGINT
            AS adjusted_count FROM peak""",
    "train_evaluate_rules": f"""WITH {EVENTS}, {TRAINING} SELECT position, candidate,
        (SELECT count(*) FROM split WHERE is_train) AS train_rows, (SELECT count(*) FROM split WHERE NOT is_train) AS test_rows,
        false AS failed, true AS lowest_error_is_selected
        FROM (VALUES (0, 'RandomForest'), (1, 'LinearRegression'), (2, 'DecisionTree')) AS t(position, candidate)""",
    "grid_scores_keys": f"WITH {PREDICTIONS} SELECT day_of_week, hour_of_day, category, true AS known_category, true AS has_prediction FROM grid",
    "lookup_with_fallback_keys": f"""WITH {LOOKED_UP}
        SELECT request_id, day_of_week, hour_of_day, category, found, true AS has_prediction FROM looked""",
    "lookup_with_fallback_values": f"""WITH {EVENTS} SELECT day_of_week, hour_of_day, category, asked::INTEGER AS asked,
        items_count::DOUBLE AS prediction, day_of_week % 2 = 0 AS found, day_of_week % 2 = 0 AS has_time
        FROM cells, range(1, 3) AS r(asked)""",
    "typed_request": f"""WITH {PREDICTIONS},
        asked AS (SELECT * FROM (VALUES (0, 9, ' Purchase'), (6, 23, 'no such category')) AS t(day_of_week, hour_of_day, category))
        SELECT a.day_of_week, a.hour_of_day, a.category, p.prediction, p.prediction IS NOT NULL AS found
        FROM asked a LEFT JOIN p ON a.day_of_week = p.day_of_week AND a.hour_of_day = p.hour_of_day
            AND {_clean("a.category")} = p.category""",
    "prediction_time": f"WITH {PREDICTIONS} SELECT 1::BIGINT AS times, true AS all_iso, count(*) AS rows FROM p",
    "prediction_table": f"WITH {PREDICTIONS} SELECT concat_ws(':', day_of_week, hour_of_day, category) AS key, * FROM p",
    "prediction_metadata": f"""WITH {PREDICTIONS} SELECT count(*) AS total_predictions, 'v1.0' AS model_version,
        count(DISTINCT category) AS categories_count, min(day_of_week) || '-' || max(day_of_week) AS days_range,
        min(hour_of_day) || '-' || max(hour_of_day) AS hours_range, 1 AS version FROM p""",
    "prediction_json_roundtrip": f"""WITH {PREDICTIONS}
        SELECT concat_ws(':', day_of_week, hour_of_day, category) AS key, * FROM p""",
    "key_split": f"""WITH {PREDICTIONS} SELECT concat_ws(':', day_of_week, hour_of_day, category) AS key,
        day_of_week, hour_of_day, category FROM p""",
    "point_lookup": f"""WITH {PREDICTIONS} SELECT * FROM p
        WHERE day_of_week = 0 AND hour_of_day = 9 AND category = 'purchase'""",
    "key_lookup": f"""WITH {PREDICTIONS} SELECT '0:9:purchase' AS key, * FROM p
        WHERE day_of_week = 0 AND hour_of_day = 9 AND category = 'purchase'""",
    "batch_lookup": f"WITH {LOOKED_UP} SELECT * FROM looked",
    "missing_cells": f"""WITH {LOOKED_UP}
        SELECT DISTINCT day_of_week, hour_of_day, {_clean("category")} AS category FROM looked WHERE NOT found""",
    "pattern_filter": f"""WITH {PREDICTIONS}
        SELECT '0:9:*' AS pattern, * FROM p WHERE day_of_week = 0 AND hour_of_day = 9
        UNION ALL SELECT '0:*:*', * FROM p WHERE day_of_week = 0
        UNION ALL SELECT '*:9:*', * FROM p WHERE hour_of_day = 9
        UNION ALL SELECT '*:*:*', * FROM p""",
    "top_predictions": f"WITH {PREDICTIONS} SELECT * FROM p ORDER BY {_BEST_FIRST} LIMIT 20",
    "top_predictions_per_day": f"""WITH {PREDICTIONS}
        SELECT (row_number() OVER (PARTITION BY day_of_week ORDER BY {_BEST_FIRST}))::INTEGER AS rank, *
        FROM p QUALIFY rank <= 20""",
    "labelled_report": f"""WITH {LOOKED_UP} SELECT request_id,
        printf('%s %2d:00, %-15s: %s',
            ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][day_of_week + 1],
            hour_of_day, trim(category),
            CASE WHEN found THEN printf('%6.1f items', round(prediction, 1)) ELSE 'NOT CACHED' END) AS line
        FROM looked""",
    "ranked_report": f"""WITH {PREDICTIONS},
        top AS (SELECT (row_number() OVER (ORDER BY {_BEST_FIRST}))::INTEGER AS rank, * FROM p QUALIFY rank <= 10)
        SELECT rank, printf('%2d. Day %d, Hour %2d, %-20s: %6.1f items', rank, day_of_week, hour_of_day, category,
            round(prediction, 1)) AS line FROM top""",
    "ranked_day_report": f"""WITH {PREDICTIONS},
        top AS (SELECT (row_number() OVER (PARTITION BY day_of_week ORDER BY {_BEST_FIRST}))::INTEGER AS rank, *
            FROM p QUALIFY rank <= 10)
        SELECT day_of_week, rank, printf('%2d. Hour %2d, %-20s: %6.1f items', rank, hour_of_day, category,
            round(prediction, 1)) AS line FROM top""",
    "probe_hit_rate": f"""WITH {LOOKED_UP} SELECT count(*) AS probes, count(*) FILTER (found) AS hits,
        round(avg(found::INTEGER), 6) AS rate, avg(found::INTEGER) > 0.8 AS accepted FROM looked""",
    "prediction_stats": f"""WITH {PREDICTIONS}
        SELECT count(*) AS total_predictions, count(DISTINCT category) AS categories_count FROM p""",
    "prediction_categories": f"WITH {PREDICTIONS} SELECT DISTINCT category FROM p",
    "coverage_check": f"""WITH {LOOKED_UP} SELECT (SELECT count(*) FROM p) AS total_predictions,
        count(*) AS probes, count(*) FILTER (found) AS hits, (SELECT count(*) > 0 FROM p) AS valid FROM looked""",
}
