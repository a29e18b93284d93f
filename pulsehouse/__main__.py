"""Command line for the batch jobs.

    python -m pulsehouse land     --input TABLE_DIR --output BRONZE_DIR
    python -m pulsehouse backfill --input TABLE_DIR --output BRONZE_DIR --end TS --hours N
    python -m pulsehouse run      --input TABLE_DIR --root DIR [--users USERS_CSV --run-ts TS] [--table NAME]
    python -m pulsehouse silver   --input BRONZE_DIR --output SILVER_DIR [--quarantine DIR]
    python -m pulsehouse gold     --silver SILVER_DIR --gold GOLD_DIR [--no-checks]
    python -m pulsehouse register --silver SILVER_DIR --table NAME
    python -m pulsehouse snapshot --source USERS_CSV --store DIR --run-ts TS [--rejects DIR]
    python -m pulsehouse export   --gold GOLD_DIR --output OUT_DIR
    python -m pulsehouse stream   --input BRONZE_DIR --silver DIR --kpis DIR --checkpoint DIR
                                  [--every '1 minute'] [--max-files-per-trigger N]

Each command is one job on the session it finds (or a new one); it prints a
JSON line with what it did.
"""
from __future__ import annotations

import argparse
import json
import sys

from .operators import scd2
from .plans import jobs
from .session import build_session
from .sources import bronze as bronze_io
from .sources import lake
from .streaming import live


def main(argv: list[str] | None = None, spark=None) -> dict:
    ap = argparse.ArgumentParser(prog="pulsehouse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("silver", help="Bronze JSON -> Silver Parquet")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--any-twin", action="store_true",
                   help="keep an arbitrary valid twin instead of the smallest")
    s.add_argument("--quarantine", help="also write rejected rows (with reason) here")
    s.add_argument("--allow-empty", action="store_true",
                   help="empty Silver when no row is valid (default: keep it and fail)")
    s.add_argument("--dedup", choices=jobs.DEDUPS, default="aggregate",
                   help="filter: shuffle only rows whose event_id may repeat")
    for name, text in (("land", "Parquet table of Bronze rows -> JSON Lines layout"),
                       ("backfill", "the last hours of such a table -> JSON Lines layout")):
        b = sub.add_parser(name, help=text)
        b.add_argument("--input", required=True)
        b.add_argument("--output", required=True)
        if name == "backfill":
            b.add_argument("--end", required=True)
            b.add_argument("--hours", required=True, type=int)
    f = sub.add_parser("run", help="land -> Silver -> catalog -> Gold (checks, seed, snapshot)")
    f.add_argument("--input", required=True)
    f.add_argument("--root", required=True)
    f.add_argument("--users")
    f.add_argument("--run-ts")
    f.add_argument("--table")
    g = sub.add_parser("gold", help="Silver -> marts, with checks")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--no-checks", action="store_true")
    r = sub.add_parser("register", help="catalog table over Silver + partitions")
    r.add_argument("--silver", required=True)
    r.add_argument("--table", required=True)
    n = sub.add_parser("snapshot", help="type-2 snapshot run of the users seed")
    n.add_argument("--source", required=True)
    n.add_argument("--store", required=True)
    n.add_argument("--run-ts", required=True)
    n.add_argument("--rejects", help="rows with NULL or repeated keys go here (default: fail)")
    n.add_argument("--key", default="user_id")
    n.add_argument("--check-cols", default="plan,country")
    t = sub.add_parser("stream", help="streaming Silver + hourly KPIs from Bronze files")
    t.add_argument("--input", required=True)
    t.add_argument("--silver", required=True)
    t.add_argument("--kpis", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--users", help="exact distinct users of closed hours go here")
    t.add_argument("--watermark", default="2 hours")
    t.add_argument("--max-files-per-trigger", type=int)
    t.add_argument("--every", help="processing-time trigger, e.g. '1 minute'; "
                                   "default: one available-now pass")
    e = sub.add_parser("export", help="dashboard results as JSON")
    e.add_argument("--gold", required=True)
    e.add_argument("--output", required=True)
    a = ap.parse_args(argv)

    spark = spark or build_session(app=f"pulsehouse-{a.cmd}")
    if a.cmd == "silver":
        out = jobs.run_silver(spark, a.input, a.output, not a.any_twin, a.quarantine, a.allow_empty, a.dedup)
    elif a.cmd in ("land", "backfill"):
        rows = spark.read.parquet(a.input)
        if a.cmd == "land":
            bronze_io.land(rows, a.output)
        else:
            bronze_io.backfill(rows, a.output, a.end, a.hours)
        out = {"bronze": a.output}
    elif a.cmd == "run":
        users = lake.read_seed(spark, a.users) if a.users else None
        out = jobs.run_all(spark, spark.read.parquet(a.input), a.root, users=users, run_ts=a.run_ts, table=a.table)
    elif a.cmd == "gold":
        out = jobs.build_gold(spark, a.silver, a.gold, run_checks=not a.no_checks)
    elif a.cmd == "register":
        out = {"table": lake.register_partitioned(spark, a.silver, a.table)}
    elif a.cmd == "snapshot":
        scd2.run_snapshot(spark, a.store, lake.read_seed(spark, a.source), a.key,
                          a.check_cols.split(","), a.run_ts, a.rejects)
        out = {"snapshot": a.store}
    elif a.cmd == "stream":
        slv = live.silver_stream(live.bronze_stream(spark, a.input, a.max_files_per_trigger),
                                 a.watermark)
        once = a.every is None
        qs = [live.start_silver_sink(slv, a.silver, f"{a.checkpoint}/silver", once, a.every),
              live.start_kpis_sink(live.hourly_kpis_stream(slv), a.kpis, f"{a.checkpoint}/kpis",
                                   once, a.every)]
        if a.users:
            qs.append(live.start_users_sink(live.distinct_users_stream(slv), a.users, f"{a.checkpoint}/users",
                                            once, a.every))
        if once:
            for q in qs:
                q.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
        out = {"silver": a.silver, "kpis": a.kpis, "state": [live.state_size(q) for q in qs],
               "batches": [len(q.recentProgress) for q in qs],
               "late_rows": [live.late_rows(q) for q in qs]}
    else:
        out = jobs.export_snapshot(spark, a.gold, a.output)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
