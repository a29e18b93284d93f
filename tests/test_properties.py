"""Property tests: random version histories, split plan == brute force."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsehouse.operators import enrich

BASE = dt.datetime(2024, 1, 1)


@st.composite
def histories(draw):
    rows = []
    for u in range(4):
        n = draw(st.integers(0, 4))          # 0 versions = user unknown to the dimension
        cuts = sorted(draw(st.lists(st.integers(-600, 4 * 1440), min_size=n, max_size=n,
                                    unique=True)))
        for i, m in enumerate(cuts):
            start = BASE + dt.timedelta(minutes=m)
            end = BASE + dt.timedelta(minutes=cuts[i + 1]) if i + 1 < n else None
            rows.append((f"u{u}", draw(st.sampled_from(["free", "premium", None])), start, end))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(hist=histories(), step=st.integers(7, 97))
def test_point_in_time_split_equals_brute_force(spark, hist, step):
    ev = spark.range(0, 4 * 1440, step).select(
        F.concat(F.lit("u"), (F.col("id") % 5).cast("string")).alias("user_id"),
        (F.lit(BASE).cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("event_ts"),
        (F.col("id") % 3 == 0).alias("is_error"))
    ev = ev.withColumn("event_date", F.to_date("event_ts"))
    h = spark.createDataFrame(hist or [("nobody", "free", BASE, None)],
                              "user_id string, plan string, dbt_valid_from timestamp_ntz, "
                              "dbt_valid_to timestamp_ntz")
    fast = enrich.kpis_point_in_time(ev, h)
    brute = (enrich.point_in_time(ev, h, ["plan"]).groupBy("event_date", "plan")
             .agg(F.count(F.lit(1)).alias("total_requests"),
                  F.sum(F.col("is_error").cast("int")).cast("bigint").alias("error_count")))

    def rows(df):
        return sorted((r.event_date, r.plan or "~", r.total_requests, r.error_count)
                      for r in df.collect())
    assert rows(fast) == rows(brute)


TS_CHOICES = ["2024-01-01T10:00:00+00:00", "2024-01-01T23:30:00-02:00", "2024-01-02T00:00:01.5Z",
              "garbage", None]


@st.composite
def bronze_batches(draw):
    n = draw(st.integers(1, 40))
    rows = []
    for _ in range(n):
        rows.append((draw(st.sampled_from(["e1", "e2", "e3", "e4", None])),
                     draw(st.sampled_from(TS_CHOICES)),
                     draw(st.sampled_from(["auth-api", "search-api", "", None])),
                     draw(st.sampled_from([200, 404, 503, None])),
                     draw(st.integers(0, 5000))))
    return rows


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=bronze_batches(), deterministic=st.booleans())
def test_silver_contract_against_brute_force(spark, rows, deterministic):
    from pulsehouse.operators import silver
    from pulsehouse.schemas import BRONZE
    full = [(e, t, s, "/x", "GET", c, lat, "u", "r", "ip", None) for e, t, s, c, lat in rows]
    out = silver.transform(spark.createDataFrame(full, BRONZE), deterministic).collect()

    def valid(r):
        return r[0] is not None and r[1] not in ("garbage", None) and r[2] is not None
    expected_ids = {r[0] for r in full if valid(r)}
    got_ids = [r.event_id for r in out]
    assert sorted(got_ids) == sorted(expected_ids)            # one row per valid id
    valid_rows = {(r[0], r[2], r[5], r[6]) for r in full if valid(r)}
    for r in out:                                              # the survivor is a valid twin
        assert (r.event_id, r.service, r.status_code, r.latency_ms) in valid_rows
        assert r.event_ts is not None
        assert r.is_error == (None if r.status_code is None else r.status_code >= 400)


RUN_TS = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)]


@st.composite
def source_runs(draw):
    runs = []
    for _ in RUN_TS:
        rows = []
        for k in ("k1", "k2", "k3", "k4", "k5"):
            if draw(st.booleans()) or draw(st.booleans()):        # present ~75 %
                rows.append((k, dt.date(2023, 1, draw(st.integers(1, 3))),
                             draw(st.sampled_from(["free", "premium", None])),
                             draw(st.sampled_from(["IN", "US", None]))))
        runs.append(rows)
    return runs


def brute_force_snapshot(runs):
    """Plain-Python check strategy on (plan, country)."""
    versions = []                                   # dicts
    for ts, rows in zip(RUN_TS, runs):
        open_by_key = {v["user_id"]: v for v in versions if v["valid_to"] is None}
        for k, signup, plan, country in rows:
            cur = open_by_key.get(k)
            if cur is None or (cur["plan"], cur["country"]) != (plan, country):
                if cur is not None:
                    cur["valid_to"] = ts
                versions.append({"user_id": k, "signup_date": signup, "plan": plan,
                                 "country": country, "valid_from": ts, "valid_to": None})
    return sorted((v["user_id"], v["signup_date"], v["plan"] or "~", v["country"] or "~",
                   v["valid_from"], v["valid_to"] or dt.datetime.max) for v in versions)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(runs=source_runs())
def test_snapshot_check_against_brute_force(spark, runs):
    from pulsehouse.operators import scd2
    from pulsehouse.schemas import USERS
    snap = None
    for ts, rows in zip(RUN_TS, runs):
        src = spark.createDataFrame(rows, USERS)
        snap = scd2.snapshot_check(snap, src, "user_id", ["plan", "country"],
                                   ts.strftime("%Y-%m-%d %H:%M:%S"))
    got = sorted((r.user_id, r.signup_date, r.plan or "~", r.country or "~", r.dbt_valid_from,
                  r.dbt_valid_to or dt.datetime.max) for r in snap.collect())
    assert got == brute_force_snapshot(runs)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                               st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=80),
       q=st.sampled_from([0.01, 0.5, 0.9, 0.95, 0.99, 1.0]))
def test_exact_percentiles_nearest_rank(spark, data, q):
    import math
    from pulsehouse.functions.expressions import exact_percentiles
    df = spark.createDataFrame(data, "k string, v int")
    got = {r.k: (r.p, r.n) for r in exact_percentiles(df, ["k"], "v", (q,), ("p",),
                                                       total_name="n").collect()}
    want = {}
    for k in {k for k, _ in data}:
        vals = sorted(v for kk, v in data if kk == k and v is not None)
        n_all = sum(1 for kk, _ in data if kk == k)
        p = vals[math.ceil(round(q * len(vals), 9)) - 1] if vals else None
        want[k] = (p, n_all)
    assert got == want


def _half_up(x, places):
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from([200, 201, 404, 500, None]),
                               st.integers(0, 2000),
                               st.sampled_from(["u1", "u2", "u3", None])),
                     min_size=1, max_size=120))
def test_hourly_mart_measures_against_half_up_model(spark, rows):
    from pulsehouse.operators import marts
    df = spark.createDataFrame(
        [("auth-api", dt.date(2024, 1, 1), 5, s, lat, u, None if s is None else s >= 400,
          None if s is None else s >= 500) for s, lat, u in rows],
        "service string, event_date date, event_hour int, status_code int, latency_ms int, "
        "user_id string, is_error boolean, is_server_error boolean")
    r = marts.service_hourly_kpis(df).first()
    n = len(rows)
    errors = sum(1 for s, _, _ in rows if s is not None and s >= 400)
    assert (r.total_requests, r.error_count) == (n, errors)
    assert r.server_error_count == sum(1 for s, _, _ in rows if s is not None and s >= 500)
    assert r.error_rate_pct == _half_up(100.0 * errors / n, 2)
    assert r.avg_latency_ms == _half_up(sum(lat for _, lat, _ in rows) / n, 1)
    assert r.unique_users == len({u for _, _, u in rows if u is not None})
