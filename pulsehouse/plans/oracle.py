"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Shared CTEs rebuild Bronze/Silver/marts from the given tables in plain SQL;
each query appends its final SELECT. Types are pinned to what Spark returns
(int hours, bigint sums, double rates, timestamp without time zone).
"""
from __future__ import annotations

# Bronze bridge from ``events`` (FIXTURES F6); ``ts`` stands in for the text
# timestamp, which Silver would parse back to the same instant.
BRONZE_CTE = """
src AS (
  SELECT *, CAST(props->>'$.k' AS INTEGER) AS k,
    CASE event_id % 5 WHEN 0 THEN 'auth-api' WHEN 1 THEN 'payments-api' WHEN 2 THEN 'search-api'
      WHEN 3 THEN 'notification-svc' ELSE 'user-svc' END AS svc,
    CAST(floor(event_id / 5) AS BIGINT) % 4 AS e4, CAST(floor(event_id / 5) AS BIGINT) % 3 AS e3
  FROM events),
src2 AS (
  SELECT *, CASE WHEN k < 70 THEN 200 WHEN k < 80 THEN 201 WHEN k < 88 THEN 400 WHEN k < 93 THEN 404
      WHEN k < 98 THEN 500 ELSE 503 END AS status_code
  FROM src),
bronze AS (
  SELECT event_id AS src_id, 'ev-' || CAST(event_id AS VARCHAR) AS event_id, ts, svc AS service,
    CASE svc WHEN 'auth-api' THEN CASE e4 WHEN 0 THEN '/login' WHEN 1 THEN '/logout' WHEN 2 THEN '/refresh' ELSE '/verify' END
             WHEN 'payments-api' THEN CASE e4 WHEN 0 THEN '/charge' WHEN 1 THEN '/refund' WHEN 2 THEN '/status' ELSE '/list' END
             WHEN 'search-api' THEN CASE e3 WHEN 0 THEN '/search' WHEN 1 THEN '/autocomplete' ELSE '/suggest' END
             WHEN 'notification-svc' THEN CASE e3 WHEN 0 THEN '/send-email' WHEN 1 THEN '/send-sms' ELSE '/send-push' END
             ELSE CASE e4 WHEN 0 THEN '/profile' WHEN 1 THEN '/update' WHEN 2 THEN '/delete' ELSE '/preferences' END END AS endpoint,
    CASE WHEN event_id % 7 < 3 THEN 'GET' WHEN event_id % 7 < 5 THEN 'POST' WHEN event_id % 7 = 5 THEN 'PUT' ELSE 'DELETE' END AS method,
    status_code,
    CAST(CAST(floor(value * 10) AS INTEGER) + CASE WHEN status_code >= 500 THEN 1000 ELSE 0 END AS INTEGER) AS latency_ms,
    'user_' || CAST(user_id AS VARCHAR) AS user_id,
    CASE user_id % 4 WHEN 0 THEN 'ap-south-1' WHEN 1 THEN 'us-east-1' WHEN 2 THEN 'eu-west-1' ELSE 'ap-southeast-1' END AS region,
    '10.0.0.' || CAST(event_id % 256 AS VARCHAR) AS ip,
    CASE WHEN status_code >= 500 THEN 'server error ' || CAST(k AS VARCHAR) END AS error_message
  FROM src2),
bronze_dirty0 AS (
  SELECT src_id, event_id, ts AS arrival_ts,
    CASE WHEN src_id % 89 = 0 THEN NULL ELSE ts END AS event_ts,
    CASE WHEN src_id % 89 = 0 THEN 'garbage' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS "timestamp",
    CASE WHEN src_id % 97 = 0 THEN NULL ELSE service END AS service,
    endpoint, method, status_code, latency_ms, user_id, region, ip, error_message
  FROM bronze),
bronze_dirty AS (
  SELECT * FROM bronze_dirty0 UNION ALL SELECT * FROM bronze_dirty0 WHERE src_id % 10 = 0),
silver AS (
  SELECT DISTINCT event_id, "timestamp", event_ts, CAST(event_ts AS DATE) AS event_date,
    CAST(hour(event_ts) AS INTEGER) AS event_hour, service, endpoint, method, status_code,
    latency_ms, user_id, region, ip, error_message,
    status_code >= 400 AS is_error, status_code >= 500 AS is_server_error
  FROM bronze_dirty
  WHERE event_id IS NOT NULL AND event_ts IS NOT NULL AND service IS NOT NULL),
stg AS (
  SELECT event_id, event_ts, event_date, event_hour, service, endpoint, method, status_code,
    latency_ms, user_id, region, is_error, is_server_error FROM silver),
kpis AS (
  SELECT service, event_date, event_hour,
    count(*) AS total_requests,
    CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
    CAST(sum(CASE WHEN is_server_error THEN 1 ELSE 0 END) AS BIGINT) AS server_error_count,
    round(100.0::DOUBLE * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*), 2) AS error_rate_pct,
    round(avg(latency_ms), 1) AS avg_latency_ms,
    quantile_disc(latency_ms, 0.5) AS p50_latency_ms,
    quantile_disc(latency_ms, 0.95) AS p95_latency_ms,
    quantile_disc(latency_ms, 0.99) AS p99_latency_ms,
    count(DISTINCT user_id) AS unique_users
  FROM stg GROUP BY service, event_date, event_hour),
dau AS (
  SELECT event_date, service, count(DISTINCT user_id) AS active_users, count(*) AS total_requests,
    round(count(*)::DOUBLE / NULLIF(count(DISTINCT user_id), 0), 1) AS requests_per_user
  FROM stg GROUP BY event_date, service),
errs AS (
  SELECT service, endpoint, status_code, count(*) AS error_count,
    count(DISTINCT user_id) AS affected_users, quantile_disc(latency_ms, 0.95) AS p95_latency_ms
  FROM stg WHERE is_error GROUP BY service, endpoint, status_code)
"""

# Users bridge (FIXTURES F7) and the two source snapshots.
USERS_CTE = """
ubase AS (
  SELECT 'user_' || CAST(c_custkey AS VARCHAR) AS user_id,
    CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
    c_mktsegment AS plan, n_name AS country, c_custkey AS custkey
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
snap1 AS (SELECT user_id, signup_date, plan, country, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM ubase WHERE custkey % 11 <> 0),
snap2 AS (SELECT user_id, CASE WHEN custkey % 5 = 0 THEN CAST(signup_date + 1 AS DATE) ELSE signup_date END AS signup_date,
    CASE WHEN custkey % 7 = 0 THEN 'PREMIUM' ELSE plan END AS plan, country,
    CASE WHEN custkey % 7 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
  FROM ubase WHERE custkey % 13 <> 0),
faulty AS (
  SELECT CASE WHEN custkey % 17 <> 0 THEN user_id END AS user_id, signup_date, plan, country FROM ubase
  UNION ALL
  SELECT CASE WHEN custkey % 17 <> 0 THEN user_id END, signup_date, 'TWICE', country FROM ubase WHERE custkey % 19 = 0)
"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body

# Type-2 history after two runs of the check strategy on (plan, country).
SCD_CTE = """
v1 AS (
  SELECT user_id, signup_date, plan, country,
    md5(user_id || '|' || '2024-01-01 00:00:00') AS dbt_scd_id,
    TIMESTAMP '2024-01-01 00:00:00' AS dbt_updated_at, TIMESTAMP '2024-01-01 00:00:00' AS dbt_valid_from,
    CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM snap1 WHERE user_id IS NOT NULL),
sj AS (
  SELECT v1.*, s.user_id AS s_user_id, s.signup_date AS s_signup_date, s.plan AS s_plan, s.country AS s_country,
    (v1.user_id IS NOT NULL AND s.user_id IS NOT NULL
     AND (v1.plan IS DISTINCT FROM s.plan OR v1.country IS DISTINCT FROM s.country)) AS changed
  FROM v1 FULL OUTER JOIN snap2 s ON v1.user_id = s.user_id),
scd AS (
  SELECT user_id, signup_date, plan, country, dbt_scd_id, dbt_updated_at, dbt_valid_from,
    CASE WHEN changed THEN TIMESTAMP '2024-01-15 00:00:00' ELSE dbt_valid_to END AS dbt_valid_to
  FROM sj WHERE user_id IS NOT NULL
  UNION ALL
  SELECT s_user_id, s_signup_date, s_plan, s_country, md5(s_user_id || '|' || '2024-01-15 00:00:00'),
    TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-15 00:00:00', CAST(NULL AS TIMESTAMP)
  FROM sj WHERE s_user_id IS NOT NULL AND (user_id IS NULL OR changed)),
cur AS (SELECT * FROM scd WHERE dbt_valid_to IS NULL)
"""

# Same two runs with the timestamp strategy on ``updated_at``.
SCD_TS_CTE = """
t1 AS (
  SELECT user_id, signup_date, plan, country, updated_at,
    md5(user_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S')) AS dbt_scd_id,
    updated_at AS dbt_updated_at, updated_at AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM snap1),
tj AS (
  SELECT t1.*, s.user_id AS s_user_id, s.signup_date AS s_signup_date, s.plan AS s_plan,
    s.country AS s_country, s.updated_at AS s_updated_at,
    (t1.user_id IS NOT NULL AND s.user_id IS NOT NULL AND s.updated_at > t1.dbt_updated_at) AS changed
  FROM t1 FULL OUTER JOIN snap2 s ON t1.user_id = s.user_id),
scd_ts AS (
  SELECT user_id, signup_date, plan, country, updated_at, dbt_scd_id, dbt_updated_at, dbt_valid_from,
    CASE WHEN changed THEN s_updated_at ELSE dbt_valid_to END AS dbt_valid_to
  FROM tj WHERE user_id IS NOT NULL
  UNION ALL
  SELECT s_user_id, s_signup_date, s_plan, s_country, s_updated_at,
    md5(s_user_id || '|' || strftime(s_updated_at, '%Y-%m-%d %H:%M:%S')),
    s_updated_at, s_updated_at, CAST(NULL AS TIMESTAMP)
  FROM tj WHERE s_user_id IS NOT NULL AND (user_id IS NULL OR changed))
"""
