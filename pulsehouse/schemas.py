"""Table contracts: Bronze (raw JSON), Silver, staging, marts, users.

Fixed contract: the column names, types and domain values below are the data's
own and must not change.
"""
from pyspark.sql.types import (BooleanType, DateType, IntegerType, StringType,
                               StructField, StructType, TimestampType)

# Raw request event as it lands (JSON Lines). Declared, never inferred.
BRONZE = StructType([
    StructField("event_id", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("service", StringType(), True),
    StructField("endpoint", StringType(), True),
    StructField("method", StringType(), True),
    StructField("status_code", IntegerType(), True),
    StructField("latency_ms", IntegerType(), True),
    StructField("user_id", StringType(), True),
    StructField("region", StringType(), True),
    StructField("ip", StringType(), True),
    StructField("error_message", StringType(), True),
])
BRONZE_COLUMNS = [f.name for f in BRONZE.fields]
# The text of a line the scan could not read whole (beside the Bronze columns).
RAW_LINE = "raw_line"

# Silver = Bronze + five derived columns.
SILVER_DERIVED = StructType([
    StructField("event_ts", TimestampType(), True),
    StructField("event_date", DateType(), True),
    StructField("event_hour", IntegerType(), True),
    StructField("is_error", BooleanType(), True),
    StructField("is_server_error", BooleanType(), True),
])
SILVER = StructType(BRONZE.fields + SILVER_DERIVED.fields)
SILVER_COLUMNS = [f.name for f in SILVER.fields]
SILVER_PARTITIONS = ["event_date", "service"]

# Staging view: 13 of the 16 Silver columns.
STAGING_COLUMNS = [
    "event_id", "event_ts", "event_date", "event_hour", "service", "endpoint",
    "method", "status_code", "latency_ms", "user_id", "region", "is_error",
    "is_server_error",
]

# Reference dimension (seed CSV).
USERS = StructType([
    StructField("user_id", StringType(), True),
    StructField("signup_date", DateType(), True),
    StructField("plan", StringType(), True),
    StructField("country", StringType(), True),
])
USERS_COLUMNS = [f.name for f in USERS.fields]

# Columns the type-2 snapshot adds.
SCD_META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]

# Fixed domain values, in the order the bridge deals them out; the accepted-values check tests against them.
SERVICES = ["auth-api", "payments-api", "search-api", "notification-svc", "user-svc"]
METHODS = ["GET", "POST", "PUT", "DELETE"]
