"""Column helpers: labels, flags, rates, exact quantile rank rule, sized broadcast."""
import datetime as dt

from pyspark.sql import functions as F

from pulsehouse.functions import expressions as X


def test_hour_label_and_flag(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 7, 10.0), (dt.date(2024, 1, 2), 23, 10.01)],
                               "d date, h int, rate double")
    out = df.select(X.hour_label(F.col("d"), F.col("h")).alias("label"),
                    X.health_flag(F.col("rate")).alias("flag")).collect()
    assert [(r.label, r.flag) for r in out] == [("2024-01-02 07:00", "ok"), ("2024-01-02 23:00", "high")]


def test_rates_round_and_zero_denominator(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 3)], "a long, b long")
    out = df.select(X.pct(F.col("a"), F.col("b")).alias("p"),
                    X.ratio(F.col("b"), F.col("a")).alias("r")).collect()
    assert [(r.p, r.r) for r in out] == [(33.33, 3.0), (None, None), (66.67, 1.5)]


def test_exact_percentiles_nearest_rank(spark):
    # 1..20: p50 -> 10th value, p95 -> 19th, p99 -> 20th; NULLs are ignored for ranks
    rows = [("a", v) for v in range(1, 21)] + [("a", None), ("b", 5)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = {r.k: r for r in X.exact_percentiles(df, ["k"], "v", (0.5, 0.95, 0.99),
                                               ("p50", "p95", "p99"), total_name="n").collect()}
    assert (out["a"].p50, out["a"].p95, out["a"].p99, out["a"].n) == (10, 19, 20, 21)
    assert (out["b"].p50, out["b"].p95, out["b"].p99, out["b"].n) == (5, 5, 5, 1)
