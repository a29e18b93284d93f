"""SQL over the Gold marts (S13), for users who keep their queries as text.

``run`` binds the marts to names inside one statement, so nothing is left
behind in the caller's session; ``register_gold`` makes temp views under names
of the caller's choice for a SQL shell.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run(spark: SparkSession, statement: str, **marts: DataFrame) -> DataFrame:
    """The statement with ``{name}`` standing for the frame passed under that name."""
    return spark.sql(statement, **marts)


def register_gold(spark: SparkSession, paths: dict[str, str], prefix: str = "gold_") -> list[str]:
    """Temp views ``<prefix><mart>`` over the written marts; returns their names."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in paths]


# Example statements, over the marts' own grain.
WORST_ENDPOINTS = """
SELECT service, endpoint, hit, failures,
       CAST(RANK() OVER (ORDER BY hit DESC, failures DESC) AS INT) AS place
FROM (SELECT service, endpoint, SUM(affected_users) AS hit, SUM(error_count) AS failures
      FROM {errors} WHERE status_code >= 500 GROUP BY service, endpoint) t"""

SERVER_SHARE_BY_DAY = """
SELECT event_date, SUM(server_error_count) AS server_errors, SUM(error_count) AS errors,
       SUM(server_error_count) / CAST(NULLIF(SUM(error_count), 0) AS DOUBLE) AS server_share
FROM {kpis} GROUP BY event_date"""

LOAD_PER_USER = """
SELECT service, MAX(requests_per_user) AS peak, MIN(requests_per_user) AS low, COUNT(*) AS days
FROM {dau} WHERE active_users >= 5 GROUP BY service"""

QUIET_HOURS = """
SELECT event_hour, COUNT(DISTINCT service) AS services, SUM(total_requests) AS requests
FROM {kpis} GROUP BY event_hour
HAVING SUM(total_requests) < (SELECT AVG(r) FROM (
  SELECT SUM(total_requests) AS r FROM {kpis} GROUP BY event_hour) x)"""

STATEMENTS = {"worst_endpoints": WORST_ENDPOINTS, "server_share_by_day": SERVER_SHARE_BY_DAY,
              "load_per_user": LOAD_PER_USER, "quiet_hours": QUIET_HOURS}
