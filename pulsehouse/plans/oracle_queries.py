"""Final SELECTs of the oracle, keyed like the query registry."""
from __future__ import annotations

from .oracle import BRONZE_CTE, SCD_CTE, SCD_TS_CTE, USERS_CTE, with_ctes

SILVER_COLS = ("event_id, \"timestamp\", event_ts, event_date, event_hour, service, endpoint, "
               "method, status_code, latency_ms, user_id, region, ip, error_message, is_error, "
               "is_server_error")

ORACLE: dict[str, str] = {}


def sql(name: str, body: str, users: bool = False):
    ctes = (BRONZE_CTE, USERS_CTE) if users else (BRONZE_CTE,)
    ORACLE[name] = with_ctes(body, *ctes)


sql("silver_transform", f"SELECT {SILVER_COLS} FROM silver")
sql("stg_events", "SELECT * FROM stg")
sql("mart_service_hourly_kpis", "SELECT * FROM kpis")
sql("mart_daily_active_users", "SELECT * FROM dau")
sql("mart_error_analytics", "SELECT * FROM errs ORDER BY error_count DESC")

sql("service_health", """
SELECT service, CAST(sum(total_requests) AS BIGINT) AS total_requests,
  CAST(sum(error_count) AS BIGINT) AS total_errors,
  round(100.0::DOUBLE * sum(error_count) / sum(total_requests), 2) AS error_rate_pct,
  round(avg(p95_latency_ms), 0) AS avg_p95_latency_ms,
  CAST(sum(unique_users) AS BIGINT) AS user_events
FROM kpis GROUP BY service ORDER BY error_rate_pct DESC, service""")

sql("error_rate_trend", """
SELECT event_date, event_hour, CAST(sum(total_requests) AS BIGINT) AS total_requests,
  round(100.0::DOUBLE * sum(error_count) / sum(total_requests), 2) AS error_rate_pct,
  CAST(event_date AS VARCHAR) || ' ' || lpad(CAST(event_hour AS VARCHAR), 2, '0') || ':00' AS label
FROM kpis GROUP BY event_date, event_hour ORDER BY event_date, event_hour""")

sql("latency_percentiles", """
SELECT service, round(avg(p50_latency_ms), 0) AS p50, round(avg(p95_latency_ms), 0) AS p95,
  round(avg(p99_latency_ms), 0) AS p99
FROM kpis GROUP BY service ORDER BY p95 DESC, service""")

sql("daily_active_users", """
SELECT event_date, CAST(sum(active_users) AS BIGINT) AS active_users,
  CAST(sum(total_requests) AS BIGINT) AS total_requests
FROM dau GROUP BY event_date ORDER BY event_date""")

BRONZE_COLS = ("event_id, \"timestamp\", service, endpoint, method, status_code, latency_ms, "
               "user_id, region, ip, error_message")


def sql_users(name: str, body: str, *extra: str):
    ORACLE[name] = with_ctes(body, BRONZE_CTE, USERS_CTE, *extra)


sql("hour_label", """
SELECT service, event_date, event_hour,
  CAST(event_date AS VARCHAR) || ' ' || lpad(CAST(event_hour AS VARCHAR), 2, '0') || ':00' AS label
FROM kpis""")

sql("service_health_flag", """
SELECT *, CASE WHEN error_rate_pct > 10 THEN 'high' ELSE 'ok' END AS health FROM (
SELECT service, CAST(sum(total_requests) AS BIGINT) AS total_requests,
  CAST(sum(error_count) AS BIGINT) AS total_errors,
  round(100.0::DOUBLE * sum(error_count) / sum(total_requests), 2) AS error_rate_pct,
  round(avg(p95_latency_ms), 0) AS avg_p95_latency_ms,
  CAST(sum(unique_users) AS BIGINT) AS user_events
FROM kpis GROUP BY service) h""")

sql("quarantine", f"""
SELECT {BRONZE_COLS},
  CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN event_ts IS NULL THEN 'bad_timestamp'
       WHEN service IS NULL THEN 'missing_service' END AS reject_reason
FROM bronze_dirty WHERE event_id IS NULL OR event_ts IS NULL OR service IS NULL""")

sql("quarantine_raw", f"""
SELECT {BRONZE_COLS}, CAST(NULL AS VARCHAR) AS raw_line,
  CASE WHEN event_ts IS NULL THEN 'bad_timestamp' ELSE 'missing_service' END AS reject_reason
FROM bronze_dirty WHERE src_id % 83 <> 0 AND (event_ts IS NULL OR service IS NULL)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  substr('{{"event_id":"' || event_id || '","timestamp":"' || "timestamp", 1, 30), 'broken_line'
FROM bronze_dirty WHERE src_id % 83 = 0""")

sql("silver_counts", """
SELECT (SELECT count(*) FROM bronze_dirty) AS raw_count, (SELECT count(*) FROM silver) AS clean_count""")

sql("silver_dedup", f"SELECT {SILVER_COLS} FROM silver")
sql("silver_dedup_filtered", f"SELECT {SILVER_COLS} FROM silver")

sql("p95_by_service", """
SELECT t.service, p.p95_latency_ms, t.total_requests
FROM (SELECT service, count(*) AS total_requests FROM stg GROUP BY service) t
LEFT JOIN (
  SELECT service, min(latency_ms) FILTER (WHERE rn >= ceil(n * 0.95)) AS p95_latency_ms
  FROM (SELECT service, latency_ms,
          row_number() OVER (PARTITION BY service ORDER BY latency_ms) AS rn,
          count(*) OVER (PARTITION BY service) AS n
        FROM stg WHERE latency_ms IS NOT NULL) r
  GROUP BY service) p ON t.service = p.service""")

ORACLE["p95_from_marts"] = ORACLE["p95_by_service"]

sql("latency_by_day_from_marts", """
SELECT event_date, quantile_disc(latency_ms, 0.5) AS p50_latency_ms, quantile_disc(latency_ms, 0.95) AS p95_latency_ms,
  quantile_disc(latency_ms, 0.99) AS p99_latency_ms, count(*) AS total_requests
FROM stg GROUP BY event_date""")

for _name, _by in (("sketch_kpis_by_service", "service"), ("sketch_kpis_by_day", "event_date")):
    sql(_name, f"""
SELECT {_by}, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  CAST(sum(CASE WHEN is_server_error THEN 1 ELSE 0 END) AS BIGINT) AS server_error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct,
  round(avg(latency_ms), 1) AS avg_latency_ms, TRUE AS quantiles_within_bound, TRUE AS users_within_bound
FROM stg GROUP BY {_by}""")

sql("sketch_affected_users", """
SELECT service, count(*) AS error_count, TRUE AS users_within_bound FROM stg WHERE is_error GROUP BY service""")

# hours the watermark (two hours behind the newest event) has passed
sql("stream_distinct_users", """
SELECT service, event_date, event_hour, unique_users FROM kpis
WHERE CAST(event_date AS TIMESTAMP) + to_hours(event_hour + 1) <= (SELECT max(event_ts) FROM silver) - INTERVAL 2 HOUR""")

sql("traffic_by_hour", """
SELECT event_hour, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct
FROM stg GROUP BY event_hour""")

sql("top_users", """
SELECT user_id, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM stg WHERE user_id IS NOT NULL GROUP BY user_id
ORDER BY total_requests DESC, user_id LIMIT 10""")

sql("dq_unique", """
SELECT event_id, count(*) AS n_records FROM bronze_dirty
WHERE event_id IS NOT NULL AND event_ts IS NOT NULL AND service IS NOT NULL
GROUP BY event_id HAVING count(*) > 1""")

sql("dq_not_null", """
SELECT 'stg_events' AS model, 'event_id' AS column_name, count(*) FILTER (WHERE event_id IS NULL) AS failures FROM stg
UNION ALL SELECT 'stg_events', 'service', count(*) FILTER (WHERE service IS NULL) FROM stg
UNION ALL SELECT 'stg_events', 'status_code', count(*) FILTER (WHERE status_code IS NULL) FROM stg
UNION ALL SELECT 'mart_service_hourly_kpis', 'service', count(*) FILTER (WHERE service IS NULL) FROM kpis
UNION ALL SELECT 'mart_service_hourly_kpis', 'total_requests', count(*) FILTER (WHERE total_requests IS NULL) FROM kpis
UNION ALL SELECT 'mart_daily_active_users', 'event_date', count(*) FILTER (WHERE event_date IS NULL) FROM dau
UNION ALL SELECT 'mart_daily_active_users', 'active_users', count(*) FILTER (WHERE active_users IS NULL) FROM dau
UNION ALL SELECT 'mart_error_analytics', 'service', count(*) FILTER (WHERE service IS NULL) FROM errs
UNION ALL SELECT 'mart_error_analytics', 'error_count', count(*) FILTER (WHERE error_count IS NULL) FROM errs""")

sql("dq_error_rate_range", """
SELECT service, event_date, event_hour, error_rate_pct * 2 AS error_rate_pct FROM kpis
WHERE error_rate_pct * 2 < 0 OR error_rate_pct * 2 > 100""")

sql("dq_accepted_values", """
SELECT 'service' AS column_name, service AS value, count(*) AS n_records FROM stg
WHERE service IS NOT NULL AND service NOT IN ('auth-api', 'payments-api', 'search-api', 'notification-svc')
GROUP BY service
UNION ALL
SELECT 'method', method, count(*) FROM stg
WHERE method IS NOT NULL AND method NOT IN ('GET', 'POST', 'PUT') GROUP BY method""")

sql_users("dq_relationships", """
SELECT user_id, count(*) AS n_records FROM stg
WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.user_id = stg.user_id)
GROUP BY user_id""", SCD_CTE)

sql("dq_freshness", """
SELECT max_loaded_at, snapshotted_at, age_hours,
  CASE WHEN age_hours IS NULL OR age_hours > 24 THEN 'error' WHEN age_hours > 12 THEN 'warn'
       ELSE 'pass' END AS status
FROM (SELECT max(event_ts) AS max_loaded_at, TIMESTAMP '2024-01-31 00:00:00' AS snapshotted_at,
  round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(event_ts))) / 3600000000.0, 3) AS age_hours
  FROM silver) f""")

sql_users("users_scd2_rejects", """
SELECT f.*, CASE WHEN user_id IS NULL THEN 'null_key' ELSE 'repeated_key' END AS reject_reason
FROM faulty f WHERE user_id IS NULL OR user_id IN (SELECT user_id FROM faulty GROUP BY user_id HAVING count(*) > 1)""")
sql_users("users_scd2_initial", "SELECT * FROM v1", SCD_CTE)
sql_users("users_scd2", "SELECT * FROM scd", SCD_CTE)
sql_users("users_current", "SELECT * FROM cur", SCD_CTE)
sql_users("users_scd2_ts", "SELECT * FROM scd_ts", SCD_TS_CTE)

sql_users("kpis_by_plan", """
SELECT cur.plan, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct,
  count(DISTINCT stg.user_id) AS unique_users
FROM stg LEFT JOIN cur ON stg.user_id = cur.user_id GROUP BY cur.plan""", SCD_CTE)

sql_users("kpis_by_country", """
SELECT cur.country, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct,
  count(DISTINCT stg.user_id) AS unique_users
FROM stg LEFT JOIN cur ON stg.user_id = cur.user_id GROUP BY cur.country""", SCD_CTE)

sql_users("kpis_by_plan_inner", """
SELECT cur.plan, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct,
  count(DISTINCT stg.user_id) AS unique_users
FROM stg JOIN cur ON stg.user_id = cur.user_id GROUP BY cur.plan""", SCD_CTE)

sql_users("events_asof_plan", """
SELECT stg.event_date, h.plan, count(*) AS total_requests,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
  round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct
FROM stg LEFT JOIN scd h ON stg.user_id = h.user_id AND stg.event_ts >= h.dbt_valid_from
  AND (h.dbt_valid_to IS NULL OR stg.event_ts < h.dbt_valid_to)
GROUP BY stg.event_date, h.plan""", SCD_CTE.replace("2024-01-15 00:00:00", "2024-01-15 13:30:00"))

sql_users("events_with_plan", """
SELECT event_id, event_ts, stg.user_id, service, h.plan, h.country
FROM stg LEFT JOIN scd h ON stg.user_id = h.user_id AND stg.event_ts >= h.dbt_valid_from
  AND (h.dbt_valid_to IS NULL OR stg.event_ts < h.dbt_valid_to)""", SCD_CTE.replace("2024-01-15 00:00:00", "2024-01-15 13:30:00"))

sql("hour_over_hour_self", """
SELECT k.service, k.event_date, k.event_hour, k.total_requests, p.total_requests AS prev_total_requests,
  k.total_requests - p.total_requests AS delta_requests, k.error_rate_pct,
  p.error_rate_pct AS prev_error_rate_pct
FROM kpis k LEFT JOIN kpis p ON k.service = p.service
  AND CAST(p.event_date AS TIMESTAMP) + to_hours(p.event_hour + 1)
    = CAST(k.event_date AS TIMESTAMP) + to_hours(k.event_hour)""")

sql("busiest_hours", """
SELECT * FROM (
  SELECT service, event_date, event_hour, total_requests,
    CAST(row_number() OVER (PARTITION BY service ORDER BY total_requests DESC, event_date, event_hour) AS INTEGER) AS hour_rank
  FROM kpis) r WHERE hour_rank <= 3""")

sql("service_rank_hourly", """
SELECT event_date, event_hour, service, error_rate_pct,
  CAST(rank() OVER w AS INTEGER) AS error_rank, CAST(dense_rank() OVER w AS INTEGER) AS error_dense_rank
FROM kpis WINDOW w AS (PARTITION BY event_date, event_hour ORDER BY error_rate_pct DESC)""")

sql("cumulative_requests", """
SELECT service, event_date, event_hour, total_requests,
  CAST(sum(total_requests) OVER (PARTITION BY service ORDER BY event_date, event_hour
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_requests
FROM kpis""")

LAYOUT_SELECT = ("service, strftime(arrival_ts, '%Y') AS year, strftime(arrival_ts, '%m') AS month, "
                 "strftime(arrival_ts, '%d') AS day, strftime(arrival_ts, '%H') AS hour")

sql("bronze_land", f"""
SELECT {LAYOUT_SELECT}, count(*) AS n_events FROM bronze_dirty GROUP BY ALL""")

sql("bronze_scan", f"SELECT {BRONZE_COLS} FROM bronze_dirty")

sql("bronze_backfill", f"""
SELECT {LAYOUT_SELECT}, count(*) AS n_events FROM bronze_dirty
WHERE arrival_ts >= TIMESTAMP '2024-01-28 00:00:00' AND arrival_ts < TIMESTAMP '2024-01-31 00:00:00'
GROUP BY ALL""")

sql("silver_roundtrip", f"SELECT {SILVER_COLS} FROM silver")

sql("catalog_silver", """
SELECT event_date, service, count(*) AS n_events,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM silver GROUP BY event_date, service""")

sql_users("users_seed", "SELECT user_id, signup_date, plan, country FROM snap2")

ORACLE["gold_build"] = ORACLE["mart_service_hourly_kpis"]
ORACLE["end_to_end_rerun"] = ORACLE["service_health"]
ORACLE["gold_build_active_users"] = ORACLE["mart_daily_active_users"]
ORACLE["gold_build_errors"] = ORACLE["mart_error_analytics"]
ORACLE["gold_build_snapshot"] = ORACLE["users_snapshot_sink"] = ORACLE["users_scd2"]
ORACLE["export_error_trend"] = ORACLE["error_rate_trend"]
ORACLE["export_service_health"] = ORACLE["service_health"]
ORACLE["export_latency"] = ORACLE["latency_percentiles"]
ORACLE["export_active_users"] = ORACLE["daily_active_users"]
ORACLE["export_meta"] = "SELECT '2024-01-31T00:00:00+00:00' AS generated_at"
sql("silver_job_counts", """
SELECT (SELECT count(*) FROM bronze_dirty) AS raw_count, (SELECT count(*) FROM silver) AS clean_count,
  (SELECT count(*) FROM bronze_dirty WHERE event_id IS NULL OR event_ts IS NULL OR service IS NULL) AS reject_count""")

ORACLE["stream_silver"] = ORACLE["silver_transform"]

sql("stream_hourly_volume", """
SELECT service, event_date, event_hour, total_requests, error_count, server_error_count,
  error_rate_pct, avg_latency_ms, p50_latency_ms, p95_latency_ms, p99_latency_ms FROM kpis""")

ORACLE["stream_hourly_kpis"] = ORACLE["stream_hourly_volume"].replace(
    "p99_latency_ms FROM kpis", "p99_latency_ms, unique_users FROM kpis")

sql("sql_worst_endpoints", """
SELECT *, CAST(rank() OVER (ORDER BY hit DESC, failures DESC) AS INTEGER) AS place FROM (
  SELECT service, endpoint, CAST(sum(affected_users) AS BIGINT) AS hit, CAST(sum(error_count) AS BIGINT) AS failures
  FROM errs WHERE status_code >= 500 GROUP BY service, endpoint) t""")

sql("sql_server_share_by_day", """
SELECT event_date, CAST(sum(server_error_count) AS BIGINT) AS server_errors, CAST(sum(error_count) AS BIGINT) AS errors,
  sum(server_error_count)::DOUBLE / NULLIF(sum(error_count), 0)::DOUBLE AS server_share
FROM kpis GROUP BY event_date""")

sql("sql_load_per_user", """
SELECT service, max(requests_per_user) AS peak, min(requests_per_user) AS low, count(*) AS days
FROM dau WHERE active_users >= 5 GROUP BY service""")

sql("sql_quiet_hours", """
SELECT event_hour, services, requests FROM (
  SELECT event_hour, services, requests, avg(requests) OVER () AS mean FROM (
    SELECT event_hour, count(DISTINCT service) AS services, CAST(sum(total_requests) AS BIGINT) AS requests
    FROM kpis GROUP BY event_hour) h) m WHERE requests < mean""")

sql("distinct_users_by_day", """
SELECT event_date, count(DISTINCT user_id) AS distinct_users, count(*) AS total_requests
FROM stg GROUP BY event_date ORDER BY event_date""")

sql("distinct_users_by_service", """
SELECT service, count(DISTINCT user_id) AS distinct_users, count(*) AS total_requests
FROM stg GROUP BY service ORDER BY service""")
