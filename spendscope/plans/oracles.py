"""The same answers in SQL, written independently of the operators."""

from __future__ import annotations

TX = """
tx0 AS (
  SELECT event_id AS trans_num, user_id AS cc_num, ts AS trans_date_trans_time, value AS amt,
         CAST(props->>'$.k' AS BIGINT) AS k,
         30 + (user_id % 20) * 0.5::DOUBLE AS lat, -100 + (user_id % 30) * 0.5::DOUBLE AS long
  FROM events
),
tx AS (
  SELECT t.*, 'cat_' || CAST(k % 25 AS VARCHAR) AS category, 'm_' || CAST(k AS VARCHAR) AS merchant,
         lat + ((trans_num * 37 + k * 11) % 201 - 100) / 100::DOUBLE AS merch_lat,
         long + ((trans_num * 53 + k * 7) % 201 - 100) / 100::DOUBLE AS merch_long,
         n_name AS state,
         CAST(hour(trans_date_trans_time) AS INTEGER) AS hour,
         CASE WHEN amt <= 10 THEN 'tiny' WHEN amt <= 50 THEN 'small' WHEN amt <= 100 THEN 'medium'
              WHEN amt <= 500 THEN 'large' ELSE 'huge' END AS amount_bin
  FROM tx0 t LEFT JOIN customer ON c_custkey = cc_num LEFT JOIN nation ON n_nationkey = c_nationkey
),
f AS (
  SELECT *, sqrt((lat - merch_lat) * (lat - merch_lat) + (long - merch_long) * (long - merch_long)) * 111
           AS geo_distance_km
  FROM tx
)"""

MEAN = "CAST(sum(CAST(amt AS DECIMAL(18,2))) AS DOUBLE) / count(amt)"

USERS = f"""
base AS (
  SELECT cc_num, count(trans_num) AS total_transactions,
         CAST(sum(CAST(amt AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
         {MEAN} AS avg_transaction,
         coalesce(round(stddev_samp(amt), 6), 0) AS std_transaction,
         count(DISTINCT category) AS unique_categories, count(DISTINCT merchant) AS unique_merchants,
         min(trans_date_trans_time) AS first_transaction, max(trans_date_trans_time) AS last_transaction,
         round(avg(geo_distance_km), 6) AS avg_geo_distance,
         max(geo_distance_km) AS far,
         coalesce(round(stddev_samp(geo_distance_km), 6), 0) AS std_distance
  FROM f GROUP BY cc_num
),
spans AS (
  SELECT *, CAST(datediff('day', first_transaction, last_transaction) AS INTEGER) AS activity_span_days,
         (epoch_us(last_transaction) - epoch_us(first_transaction)) / 86400000000::DOUBLE AS exact_span
  FROM base
),
users AS (
  SELECT *, total_transactions / CASE WHEN activity_span_days = 0 THEN 1 ELSE activity_span_days END::DOUBLE
              AS transactions_per_day,
         total_transactions / CASE WHEN exact_span = 0 THEN 1 ELSE exact_span END AS exact_per_day
  FROM spans
),
hours AS (SELECT cc_num, hour, count(*) AS hour_count FROM tx GROUP BY cc_num, hour),
peaks AS (
  SELECT cc_num, hour AS peak_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY cc_num ORDER BY hour_count DESC, hour) AS rn FROM hours
  ) WHERE rn = 1
)"""

GAPS = """
gaps AS (
  SELECT trans_num, cc_num, trans_date_trans_time,
         CAST(floor(epoch(trans_date_trans_time)) AS BIGINT)
           - CAST(floor(epoch(lag(trans_date_trans_time) OVER w)) AS BIGINT) AS time_diff,
         epoch_us(trans_date_trans_time) - epoch_us(lag(trans_date_trans_time) OVER w) AS micros
  FROM tx WINDOW w AS (PARTITION BY cc_num ORDER BY trans_date_trans_time, trans_num)
),
gap_users AS (
  SELECT cc_num, count(*) FILTER (time_diff < 3600) AS short_gaps,
         count(*) FILTER (micros < 3600000000) AS short_exact,
         count(*) FILTER (time_diff < 600) AS short_default
  FROM gaps GROUP BY cc_num
)"""


def _flags(
    rate="transactions_per_day > 2.7",
    amount="avg_transaction > (SELECT quantile_disc(avg_transaction, 0.95) FROM users)",
    far="far > 153",
    categories="unique_categories >= 25",
    burst="short_gaps >= 9",
) -> str:
    return f"""
flags0 AS (
  SELECT cc_num, {rate} AS high_frequency, {amount} AS high_amount, {far} AS geo_mobile,
         {categories} AS diverse, {burst} AS burst
  FROM users JOIN gap_users USING (cc_num)
),
flags AS (
  SELECT *, high_frequency OR high_amount OR geo_mobile OR diverse OR burst AS interesting FROM flags0
)"""


BASE = f"WITH {TX}"
WITH_USERS = f"{BASE}, {USERS}"
WITH_GAPS = f"{BASE}, {GAPS}"
WITH_FLAGS = f"{WITH_USERS}, {GAPS}, {_flags()}"

CATEGORY = f"""SELECT category, count(trans_num) AS total_transactions,
  count(DISTINCT cc_num) AS unique_users, {MEAN} AS avg_amount FROM tx GROUP BY category"""

HOURLY = f"""SELECT hour, count(trans_num) AS transaction_count, {MEAN} AS avg_amount,
  count(DISTINCT cc_num) AS unique_users FROM tx GROUP BY hour"""


def _comparison(dimension: str) -> str:
    def side(name: str, condition: str) -> str:
        return f"""
{name} AS (
  SELECT {dimension} AS d, count(trans_num) AS n, {MEAN} AS a, count(DISTINCT cc_num) AS u
  FROM tx WHERE {condition} GROUP BY {dimension}
)"""

    hit = "cc_num IN (SELECT cc_num FROM flags WHERE interesting)"
    return f"""{WITH_FLAGS}, {side("ni", f"NOT ({hit})")}, {side("ii", hit)},
both_sides AS (
  SELECT coalesce(ni.d, ii.d) AS d,
    coalesce(ni.n, 0) AS count_normal, coalesce(ni.a, 0) AS avg_normal, coalesce(ni.u, 0) AS users_normal,
    coalesce(ii.n, 0) AS count_interesting, coalesce(ii.a, 0) AS avg_interesting,
    coalesce(ii.u, 0) AS users_interesting
  FROM ni FULL JOIN ii ON ni.d = ii.d
),
shares AS (
  SELECT *, count_normal / (SELECT sum(count_normal) FROM both_sides)::DOUBLE AS share_normal,
    count_interesting / (SELECT sum(count_interesting) FROM both_sides)::DOUBLE AS share_interesting
  FROM both_sides
),
compared AS (
  SELECT d AS {dimension}, * EXCLUDE (d), share_interesting - share_normal AS share_diff,
    avg_interesting / (avg_normal + 1e-6) AS amount_ratio
  FROM shares
)"""


def _all_dimensions() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, cc_num, trans_num, amt FROM tx"
        for d in ("category", "hour", "state", "amount_bin")
    )
    return f"""{WITH_FLAGS}, rows_by_dimension AS ({long}),
sides AS (
  SELECT dimension, value, cc_num IN (SELECT cc_num FROM flags WHERE interesting) AS hit,
    count(trans_num) AS n, {MEAN} AS a, count(DISTINCT cc_num) AS u
  FROM rows_by_dimension GROUP BY ALL
),
wide AS (
  SELECT dimension, value,
    coalesce(max(n) FILTER (NOT hit), 0) AS count_normal, coalesce(max(a) FILTER (NOT hit), 0) AS avg_normal,
    coalesce(max(u) FILTER (NOT hit), 0) AS users_normal,
    coalesce(max(n) FILTER (hit), 0) AS count_interesting,
    coalesce(max(a) FILTER (hit), 0) AS avg_interesting,
    coalesce(max(u) FILTER (hit), 0) AS users_interesting
  FROM sides GROUP BY dimension, value
),
shares AS (
  SELECT *, count_normal / (sum(count_normal) OVER (PARTITION BY dimension))::DOUBLE AS share_normal,
    count_interesting / (sum(count_interesting) OVER (PARTITION BY dimension))::DOUBLE AS share_interesting
  FROM wide
)
SELECT *, share_interesting - share_normal AS share_diff,
  avg_interesting / (avg_normal + 1e-6) AS amount_ratio FROM shares"""


EXPERIMENT = """'exp_' || CASE WHEN l_linenumber % 2 = 0 THEN '1dn' ELSE '3dn' END || '_'
  || CASE WHEN l_linestatus = 'O' THEN 'optimized' ELSE 'base' END"""

RUNS = f"""WITH runs AS (
  SELECT {EXPERIMENT} AS experiment, sum(l_quantity) AS execution_time, count(*) AS rows_processed,
    CAST(max(l_linenumber) * 1024 AS INTEGER) AS driver_memory_mb,
    CAST(max(l_linenumber) AS INTEGER) AS num_executors
  FROM lineitem GROUP BY 1
),
stages AS (
  SELECT {EXPERIMENT} AS experiment, l_returnflag AS stage, sum(l_quantity) AS seconds,
    max(l_linenumber) AS lines
  FROM lineitem GROUP BY 1, 2
),
memory AS (
  SELECT experiment, CAST(sum(lines) * 1024 AS INTEGER) AS total_executor_memory_mb FROM stages GROUP BY 1
)"""

MISSING = {
    "category": "count(*) FILTER (category = 'cat_7')",
    "merchant": "count(*) FILTER (merchant = 'm_42')",
    "amt": "count(*) FILTER (amt = 10.0)",
}
TX_COLUMNS = {
    "trans_num": "bigint", "cc_num": "bigint", "trans_date_trans_time": "timestamp_ntz",
    "category": "string", "merchant": "string", "amt": "double", "lat": "double", "long": "double",
    "merch_lat": "double", "merch_long": "double",
}


def _column_rows(only_missing: bool) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count, "
        f"{MISSING.get(c, f'count(*) - count({c})')} AS missing FROM tx"
        for c, t in TX_COLUMNS.items()
    )
    if only_missing:
        return f"{BASE} SELECT column_name, missing FROM ({rows}) WHERE missing > 0"
    return f"{BASE} {rows}"


def _speedup(metric: str, baseline: str, variant: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, (SELECT execution_time FROM runs WHERE experiment = '{baseline}') "
        f"/ (SELECT execution_time FROM runs WHERE experiment = '{variant}') AS speedup"
    )


def oracles() -> dict[str, str]:
    tx_columns = ", ".join(c for c in TX_COLUMNS if c != "trans_num")
    segment = "SELECT trans_num, cc_num, trans_date_trans_time, category, amt, amount_bin FROM tx"
    hit = "EXISTS (SELECT 1 FROM flags WHERE interesting AND flags.cc_num = tx.cc_num)"
    bin_null = """CASE WHEN a <= 0 THEN NULL WHEN a <= 10 THEN 'tiny' WHEN a <= 50 THEN 'small'
      WHEN a <= 100 THEN 'medium' WHEN a <= 500 THEN 'large' ELSE 'huge' END"""
    prototype = _flags(
        rate="exact_per_day > 2.7",
        amount="avg_transaction > (SELECT quantile_cont(avg_transaction, 0.95) FROM users)",
        burst="short_exact >= 9",
    )
    defaults = _flags(
        rate="transactions_per_day > 120", far="far > 150", categories="unique_categories >= 10",
        burst="short_default >= 5",
    )
    criteria = ("high_frequency", "high_amount", "geo_mobile", "diverse", "burst", "interesting")
    summary = " UNION ALL ".join(
        f"SELECT '{c}' AS criterion, count(*) FILTER ({c}) AS users, count(*) AS all_users, "
        f"count(*) FILTER ({c}) / count(*)::DOUBLE * 100 AS percent FROM flags"
        for c in criteria
    )
    window_counts = """counts AS (
      SELECT cc_num, count(*) OVER (PARTITION BY cc_num ORDER BY trans_date_trans_time
        RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW) AS n FROM tx)"""
    speedup_rows = " UNION ALL ".join(
        _speedup(*row)
        for row in (
            ("1DN Базовая vs Оптимизированная", "exp_1dn_base", "exp_1dn_optimized"),
            ("3DN Базовая vs Оптимизированная", "exp_3dn_base", "exp_3dn_optimized"),
            ("1DN vs 3DN (Базовая)", "exp_1dn_base", "exp_3dn_base"),
            ("1DN vs 3DN (Оптимизированная)", "exp_1dn_optimized", "exp_3dn_optimized"),
        )
    )
    found = {
        "csv_scan": f"{BASE} SELECT CAST(trans_num AS VARCHAR) AS trans_num, {tx_columns} FROM tx",
        "csv_scan_inferred": f"""{BASE} SELECT CAST(trans_num AS VARCHAR) AS trans_num, {tx_columns},
            'trans_num int, cc_num int, trans_date_trans_time timestamp, category string, merchant string, '
            || 'amt double, lat double, long double, merch_lat double, merch_long double' AS inferred_types
            FROM tx""",
        "csv_scan_lenient": f"""{BASE} SELECT CASE WHEN trans_num % 83 <> 0 THEN cc_num END AS cc_num,
            count(*) FILTER (trans_num % 97 <> 0 AND trans_num % 89 <> 0 AND trans_num % 83 <> 0) AS good_rows,
            count(*) FILTER (trans_num % 97 = 0 OR trans_num % 89 = 0 OR trans_num % 83 = 0) AS bad_rows,
            count(*) FILTER (trans_num % 97 <> 0) AS amounts, count(*) FILTER (trans_num % 89 <> 0) AS times
            FROM tx GROUP BY 1""",
        "parquet_result_sink": f"{BASE} {CATEGORY}",
        "table_shape": f"{BASE} SELECT count(*) AS row_count, CAST(10 AS INTEGER) AS column_count FROM tx",
        "preview_rows": f"{BASE} SELECT trans_num, {tx_columns} FROM tx ORDER BY trans_num LIMIT 5",
        "column_profile": _column_rows(only_missing=False),
        "missing_values": _column_rows(only_missing=True),
        "type_counts": f"""SELECT data_type, count(*) AS columns
            FROM ({_column_rows(only_missing=False)}) GROUP BY data_type""",
        "features_without_position": f"""{BASE} SELECT category, count(*) AS rows, CAST(0 AS BIGINT) AS distances,
            max(hour) AS last_hour FROM tx GROUP BY category""",
        "renamed_by_position": f"""{BASE} SELECT hour AS hour_of_day, transaction_count AS purchases,
            avg_amount AS mean_amount, unique_users AS people FROM ({HOURLY})""",
        "features": f"""{BASE} SELECT trans_num, cc_num, trans_date_trans_time, hour,
            CAST(dayofweek(trans_date_trans_time) + 1 AS INTEGER) AS day_of_week,
            CAST(CASE WHEN dayofweek(trans_date_trans_time) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER)
              AS is_weekend,
            CAST(month(trans_date_trans_time) AS INTEGER) AS month, amount_bin,
            round(geo_distance_km, 6) AS geo_distance_km FROM f""",
        "amount_bin_hist": f"{BASE} SELECT amount_bin, count(*) AS transactions FROM tx GROUP BY 1",
        "amount_bin_hist_nullable": f"""{BASE} SELECT {bin_null} AS amount_bin, count(*) AS transactions
            FROM (SELECT amt - 5 AS a FROM tx) GROUP BY 1""",
        "category_stats": f"{BASE} {CATEGORY}",
        "category_stats_ext": f"""{BASE} SELECT category, count(trans_num) AS total_transactions,
            count(DISTINCT cc_num) AS unique_users, round_even({MEAN}, 4) AS avg_amount,
            round_even(median(amt), 4) AS median_amount, round_even(stddev_samp(amt), 4) AS std_amount,
            round_even(avg(geo_distance_km), 4) AS avg_distance FROM f GROUP BY category""",
        "distinct_users_sketch": f"""{BASE}, named AS (
              SELECT 'category' AS dimension, category AS value, * FROM tx
              UNION ALL SELECT 'hour', CAST(hour AS VARCHAR), * FROM tx
              UNION ALL SELECT 'state', state, * FROM tx)
            SELECT dimension, value, count(trans_num) AS transactions, count(DISTINCT cc_num) AS unique_users,
              true AS same_totals, true AS within_bound FROM named GROUP BY 1, 2""",
        "user_facets_sketch": f"""{BASE} SELECT cc_num, count(DISTINCT category) AS unique_categories,
            count(DISTINCT merchant) AS unique_merchants, true AS within_bound FROM tx GROUP BY cc_num""",
        "amount_quantiles_sketch": f"""{BASE} SELECT category, p, count(amt) AS n, true AS within_bound
            FROM tx, (VALUES (0.5::DOUBLE), (0.95::DOUBLE)) q(p) GROUP BY 1, 2""",
        "hourly_stats": f"{BASE} {HOURLY}",
        "state_stats": f"""{BASE} SELECT state, count(trans_num) AS transaction_count, {MEAN} AS avg_amount
            FROM tx GROUP BY state""",
        "top_category": f"""{BASE} SELECT category FROM ({CATEGORY})
            ORDER BY total_transactions DESC, category LIMIT 1""",
        "top10_categories": f"{BASE} {CATEGORY} ORDER BY total_transactions DESC, category LIMIT 10",
        "peak_hour_global": f"""{BASE} SELECT hour AS peak_hour, transaction_count FROM ({HOURLY})
            ORDER BY transaction_count DESC, hour LIMIT 1""",
        "user_base_profile": f"""{WITH_USERS} SELECT cc_num, total_transactions, total_spent, avg_transaction,
            std_transaction, unique_categories, unique_merchants, first_transaction, last_transaction,
            avg_geo_distance, activity_span_days, transactions_per_day FROM users""",
        "user_span_exact": f"""{WITH_USERS} SELECT cc_num, exact_span AS activity_span_days,
            exact_per_day AS transactions_per_day FROM users""",
        "user_hour_counts": f"{WITH_USERS} SELECT cc_num, hour, hour_count FROM hours",
        "user_peak_hour": f"{WITH_USERS} SELECT cc_num, peak_hour FROM peaks",
        "user_peak_hour_ranked": f"{WITH_USERS} SELECT cc_num, peak_hour FROM peaks",
        "user_geo_stats": f"""{WITH_USERS} SELECT cc_num, avg_geo_distance AS avg_distance,
            round(far, 6) AS max_distance, std_distance FROM users""",
        "user_profiles": f"""{WITH_USERS} SELECT cc_num, total_transactions, total_spent, avg_transaction,
            std_transaction, unique_categories, unique_merchants, first_transaction, last_transaction,
            avg_geo_distance, activity_span_days, transactions_per_day, peak_hour,
            avg_geo_distance AS avg_distance, round(far, 6) AS max_distance, std_distance
            FROM users LEFT JOIN peaks USING (cc_num)""",
        "high_frequency": f"{WITH_USERS} SELECT cc_num FROM users WHERE transactions_per_day > 2.7",
        "high_frequency_exact_span": f"{WITH_USERS} SELECT cc_num FROM users WHERE exact_per_day > 2.7",
        "geo_mobile": f"{WITH_USERS} SELECT cc_num FROM users WHERE far > 153",
        "diverse": f"{WITH_USERS} SELECT cc_num FROM users WHERE unique_categories >= 25",
        "amount_threshold_rank": f"""{WITH_USERS}
            SELECT quantile_disc(avg_transaction, 0.95) AS threshold FROM users""",
        "amount_threshold_interp": f"""{WITH_USERS}
            SELECT round(quantile_cont(avg_transaction, 0.95), 6) AS threshold FROM users""",
        "amount_threshold_all_tx": "SELECT quantile_disc(value, 0.95) AS threshold FROM events",
        "high_amount": f"""{WITH_USERS} SELECT cc_num FROM users
            WHERE avg_transaction > (SELECT quantile_disc(avg_transaction, 0.95) FROM users)""",
        "high_amount_interp": f"""{WITH_USERS} SELECT cc_num FROM users
            WHERE avg_transaction > (SELECT quantile_cont(avg_transaction, 0.95) FROM users)""",
        "high_amount_all_tx": f"""{WITH_USERS} SELECT cc_num FROM users
            WHERE avg_transaction > (SELECT quantile_disc(value, 0.7) FROM events)""",
        "tx_gaps": f"{WITH_GAPS} SELECT trans_num, cc_num, trans_date_trans_time, time_diff FROM gaps",
        "tx_gaps_exact": f"""{WITH_GAPS} SELECT trans_num, cc_num, trans_date_trans_time,
            micros / 1000000::DOUBLE AS time_diff FROM gaps""",
        "short_gap_counts": f"{WITH_GAPS} SELECT cc_num, short_gaps FROM gap_users WHERE short_gaps > 0",
        "burst_users": f"{WITH_GAPS} SELECT cc_num FROM gap_users WHERE short_gaps >= 9",
        "burst_users_exact": f"{WITH_GAPS} SELECT cc_num FROM gap_users WHERE short_exact >= 9",
        "burst_users_window": f"{BASE}, {window_counts} SELECT DISTINCT cc_num FROM counts WHERE n >= 3",
        "user_flags": f"{WITH_FLAGS} SELECT * FROM flags",
        "user_flags_defaults": f"{WITH_USERS}, {GAPS}, {defaults} SELECT * FROM flags",
        "user_flags_prototype": f"{WITH_USERS}, {GAPS}, {prototype} SELECT * FROM flags",
        "interesting_users": f"{WITH_FLAGS} SELECT cc_num FROM flags WHERE interesting",
        "interesting_users_union": f"""{WITH_USERS}, {GAPS}
            SELECT cc_num FROM users WHERE transactions_per_day > 2.7
            UNION SELECT cc_num FROM users
              WHERE avg_transaction > (SELECT quantile_disc(avg_transaction, 0.95) FROM users)
            UNION SELECT cc_num FROM users WHERE far > 153
            UNION SELECT cc_num FROM users WHERE unique_categories >= 25
            UNION SELECT cc_num FROM gap_users WHERE short_gaps >= 9""",
        "interesting_summary": f"{WITH_FLAGS} {summary}",
        "segment_row_share": f"""{WITH_FLAGS} SELECT count(*) FILTER (interesting) AS interesting_rows,
            count(*) AS all_rows, count(*) FILTER (interesting) / count(*)::DOUBLE * 100 AS percent
            FROM tx JOIN flags USING (cc_num)""",
        "segment_interesting": f"{WITH_FLAGS} {segment} WHERE {hit}",
        "segment_normal": f"{WITH_FLAGS} {segment} WHERE NOT {hit}",
        "compare_category": f"{_comparison('category')} SELECT * FROM compared",
        "compare_hour": f"{_comparison('hour')} SELECT * FROM compared",
        "compare_state": f"{_comparison('state')} SELECT * FROM compared",
        "compare_amount_bin": f"{_comparison('amount_bin')} SELECT * FROM compared",
        "compare_all_dimensions": _all_dimensions(),
        "compare_category_by_join": f"{_comparison('category')} SELECT * FROM compared",
        "top_over_represented": f"""{_comparison('category')} SELECT category, share_normal,
            share_interesting, share_diff, amount_ratio FROM compared
            ORDER BY share_diff DESC, category LIMIT 10""",
        "metrics_scan_json": f"""{RUNS} SELECT experiment, execution_time, rows_processed, num_executors,
            driver_memory_mb, CAST(1024 AS INTEGER) AS executor_memory_mb, total_executor_memory_mb, stage, seconds
            FROM runs JOIN memory USING (experiment) JOIN stages USING (experiment)""",
        "metrics_csv_sink": f"""{RUNS} SELECT experiment, execution_time, rows_processed, stage, seconds
            FROM runs JOIN stages USING (experiment)""",
        "metrics_kv_fallback": f"""{RUNS} SELECT experiment, execution_time, rows_processed FROM runs
            WHERE experiment <> 'exp_3dn_base'""",
        "metrics_labels": f"""{RUNS} SELECT experiment,
            CASE WHEN experiment LIKE '%1dn%' THEN '1 DataNode' ELSE '3 DataNodes' END AS config,
            CAST(CASE WHEN experiment LIKE '%1dn%' THEN 1 ELSE 3 END AS INTEGER) AS nodes,
            CASE WHEN experiment LIKE '%optimized%' THEN 'Оптимизированная' ELSE 'Базовая' END
              AS optimization FROM runs""",
        "stage_rows": f"{RUNS} SELECT experiment AS experiment_name, stage, seconds FROM stages",
        "variant_ratio": """WITH v AS (
              SELECT l_returnflag, avg(l_quantity) FILTER (l_linestatus = 'F') AS baseline,
                avg(l_quantity) FILTER (l_linestatus = 'O') AS compared FROM lineitem GROUP BY 1)
            SELECT *, baseline / compared AS speedup, (1 - compared / baseline) * 100 AS improvement_pct
            FROM v""",
        "speedups": f"{RUNS} {speedup_rows}",
        "memory_totals": f"""{RUNS} SELECT experiment, driver_memory_mb, total_executor_memory_mb,
            driver_memory_mb + total_executor_memory_mb AS total_memory_mb
            FROM runs JOIN memory USING (experiment)""",
    }
    same = {
        "categories": "category_stats_ext", "hours": "hourly_stats", "states": "state_stats", "flags": "user_flags",
        "row_share": "segment_row_share", "comparison": "compare_all_dimensions",
    }
    tops = f"""SELECT 'category' AS kind, category, total_transactions AS n FROM ({found['top10_categories']})
        UNION ALL SELECT 'over', category, NULL FROM ({found['top_over_represented']})
        UNION ALL SELECT 'hour', CAST(peak_hour AS VARCHAR), transaction_count FROM ({found['peak_hour_global']})"""
    return found | {f"whole_analysis_{k}": found[v] for k, v in same.items()} | {"whole_analysis_tops": tops}
