"""Input preparation: the given test tables in the telemetry shape.

``events`` becomes Bronze request events; ``customer`` + ``nation`` become
the users dimension. These are row-wise projections (no shuffle) and run over
the whole tables; the fixed rules below come from FIXTURES.md.
"""
from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS, SERVICES, USERS_COLUMNS

# The endpoints of each service (services go by ``event_id % 5``).
ENDPOINTS = {
    "auth-api": ["/login", "/logout", "/refresh", "/verify"],
    "payments-api": ["/charge", "/refund", "/status", "/list"],
    "search-api": ["/search", "/autocomplete", "/suggest"],
    "notification-svc": ["/send-email", "/send-sms", "/send-push"],
    "user-svc": ["/profile", "/update", "/delete", "/preferences"],
}
# Status thresholds on k in 0..99 (70/10/8/5/5/2 split).
STATUS_BY_K = [(70, 200), (80, 201), (88, 400), (93, 404), (98, 500)]
STATUS_ELSE = 503
REGIONS_BY_MOD4 = ["ap-south-1", "us-east-1", "eu-west-1", "ap-southeast-1"]
# Dirty-variant rules: which source ids get a bad timestamp, a NULL service,
# and an exact duplicate row.
GARBAGE_TS_MOD, NULL_SERVICE_MOD, DUPLICATE_MOD = 89, 97, 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(index: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze columns plus ``arrival_ts`` (the hour the record landed in)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    svc_idx = eid % 5
    service = _pick(svc_idx, SERVICES)
    slot4, slot3 = F.floor(eid / 5) % 4, F.floor(eid / 5) % 3
    endpoint = None
    for i, svc in enumerate(SERVICES):
        eps = ENDPOINTS[svc]
        pick = _pick(slot4 if len(eps) == 4 else slot3, eps)
        endpoint = F.when(svc_idx == i, pick) if endpoint is None else endpoint.when(svc_idx == i, pick)
    status = None
    for bound, code in STATUS_BY_K:
        status = F.when(k < bound, F.lit(code)) if status is None else status.when(k < bound, F.lit(code))
    status = status.otherwise(F.lit(STATUS_ELSE))
    m7 = eid % 7
    method = (F.when(m7 < 3, "GET").when(m7 < 5, "POST").when(m7 == 5, "PUT").otherwise("DELETE"))
    return (
        events
        .select("event_id", "ts", "user_id", "value", k.alias("k"),
                service.alias("service"), endpoint.alias("endpoint"),
                status.alias("status_code"), method.alias("method"))
        .select(
            F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("event_id"),
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("timestamp"),
            "service", "endpoint", "method", "status_code",
            (F.floor(F.col("value") * 10).cast("int")
             + F.when(F.col("status_code") >= 500, 1000).otherwise(0)).alias("latency_ms"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
            _pick(F.col("user_id") % 4, REGIONS_BY_MOD4).alias("region"),
            F.concat(F.lit("10.0.0."), (F.col("event_id") % 256).cast("string")).alias("ip"),
            F.when(F.col("status_code") >= 500,
                   F.concat(F.lit("server error "), F.col("k").cast("string"))).alias("error_message"),
            F.col("event_id").alias("src_id"),
            F.col("ts").alias("arrival_ts"),
        )
    )


def dirty_bronze_from_events(events: DataFrame) -> DataFrame:
    """Bronze with bad timestamps, NULL services and exact duplicates mixed in.

    The duplicate copies come from one ``explode`` (one scan of the source)
    rather than a union of two scans.
    """
    clean = bronze_from_events(events)
    copies = F.when(F.col("src_id") % DUPLICATE_MOD == 0, F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    return clean.select(
        *[c for c in BRONZE_COLUMNS if c not in ("timestamp", "service")],
        F.when(F.col("src_id") % GARBAGE_TS_MOD == 0, F.lit("garbage"))
         .otherwise(F.col("timestamp")).alias("timestamp"),
        F.when(F.col("src_id") % NULL_SERVICE_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.col("service")).alias("service"),
        "src_id", "arrival_ts", F.explode(copies).alias("_copy"),
    ).select(*BRONZE_COLUMNS, "src_id", "arrival_ts")


def bronze(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """The 11 Bronze columns (+ ``arrival_ts`` for landing)."""
    ev = read_table(spark, sf_dir, "events")
    df = dirty_bronze_from_events(ev) if dirty else bronze_from_events(ev)
    return df.select(*BRONZE_COLUMNS, "arrival_ts")


# Fixed values for the users bridge: two snapshot dates and their key rules.
SIGNUP_BASE = "2023-01-01"
SNAPSHOT_1_AT = "2024-01-01 00:00:00"
SNAPSHOT_2_AT = "2024-01-15 00:00:00"
SNAPSHOT_MIDDAY_AT = "2024-01-15 13:30:00"
SNAP1_EXCLUDE_MOD, SNAP2_EXCLUDE_MOD, SNAP2_PREMIUM_MOD = 11, 13, 7
SNAP2_SIGNUP_MOD = 5          # these customers' signup_date moves by a day in snapshot 2
NULL_KEY_MOD, REPEATED_KEY_MOD = 17, 19   # in the source with faulty keys


def users_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """users: user_id, signup_date, plan, country (+ custkey for the rules)."""
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .select(
            F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("user_id"),
            F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("signup_date"),
            F.col("c_mktsegment").alias("plan"),
            F.col("n_name").alias("country"),
            F.col("c_custkey").alias("custkey"),
        )
    )


def users_snapshots(spark: SparkSession, sf_dir: str, with_updated_at: bool = False):
    """The two source snapshots of the users dimension (FIXTURES F7).

    With ``with_updated_at`` each row carries ``updated_at`` for the timestamp
    strategy: snapshot 1 rows at the first date; in snapshot 2 the rows whose
    plan was re-set carry the second date.
    """
    base = users_from_customers(read_table(spark, sf_dir, "customer"),
                                read_table(spark, sf_dir, "nation"))
    key = F.col("custkey")
    s1 = base.filter(key % SNAP1_EXCLUDE_MOD != 0)
    touched = key % SNAP2_PREMIUM_MOD == 0
    s2 = (base.filter(key % SNAP2_EXCLUDE_MOD != 0)
          .withColumn("plan", F.when(touched, F.lit("PREMIUM")).otherwise(F.col("plan")))
          .withColumn("signup_date", F.when(key % SNAP2_SIGNUP_MOD == 0, F.date_add("signup_date", 1))
                      .otherwise(F.col("signup_date"))))
    cols = list(USERS_COLUMNS)
    if with_updated_at:
        s1 = s1.withColumn("updated_at", F.lit(SNAPSHOT_1_AT).cast("timestamp_ntz"))
        s2 = s2.withColumn("updated_at", F.when(touched, F.lit(SNAPSHOT_2_AT))
                           .otherwise(F.lit(SNAPSHOT_1_AT)).cast("timestamp_ntz"))
        cols.append("updated_at")
    return s1.select(*cols), s2.select(*cols)


def users_with_faulty_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot 1's source with some keys NULL and some customers twice (second row: plan TWICE)."""
    base = users_from_customers(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))
    key = F.col("custkey")
    plans = F.when(key % REPEATED_KEY_MOD == 0, F.array(F.col("plan"), F.lit("TWICE"))).otherwise(F.array(F.col("plan")))
    return base.select(F.when(key % NULL_KEY_MOD != 0, F.col("user_id")).alias("user_id"), "signup_date",
                       F.explode(plans).alias("plan"), "country")
