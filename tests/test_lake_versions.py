"""Silver behind a pointer, broken lines kept, the catalog's partitions taken from writes."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import ev
from pulsehouse.operators import silver
from pulsehouse.plans import jobs
from pulsehouse.schemas import BRONZE
from pulsehouse.session import scratch_path
from pulsehouse.sources import bronze as bronze_io
from pulsehouse.sources import lake


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def bronze_of(spark, rows):
    path = scratch_path(spark, "t-bronze")
    bronze_io.land(spark.createDataFrame(rows, BRONZE), path, mode="overwrite")
    return path


def ids(spark, path):
    return sorted(r.event_id for r in lake.read_silver(spark, path).collect())


@pytest.mark.parametrize("dedup", jobs.DEDUPS)
def test_broken_lines_keep_their_text(spark, dedup):
    root = scratch_path(spark, "t-lines")
    bronze = bronze_of(spark, [ev("a"), ev("b", ts="garbage")])
    lines = ['{"event_id":"e2", broken line', "", "no json at all", '{"event_id":"half","service":"s"',
             '{"event_id":"t","timestamp":"2026-06-17T12:00:01+00:00","service":"auth-api","status_code":"abc"}',
             '{"event_id":null,"service":"s","status_code":"x"}', "[1, 2]"]
    os.makedirs(f"{local(bronze)}/service=x")
    with open(f"{local(bronze)}/service=x/more.jsonl", "w") as f:
        f.write("\n".join(lines))
    counts = jobs.run_silver(spark, bronze, f"{root}/silver", quarantine_path=f"{root}/rejects", dedup=dedup)
    rejects = spark.read.schema(jobs.PARSED).parquet(f"{root}/rejects").collect()
    broken = sorted(r.raw_line for r in rejects if r.reject_reason == "broken_line")
    assert broken == sorted([lines[0], lines[2], lines[3], lines[6]])
    # a value of the wrong type does not reject a row by itself; a rejected one keeps its line
    assert ids(spark, f"{root}/silver") == ["a", "t"]
    assert [r.raw_line for r in rejects if r.reject_reason == "missing_event_id"] == [lines[5]]
    assert [r.raw_line for r in rejects if r.reject_reason == "bad_timestamp"] == [None]
    assert counts == {"raw_count": 8, "clean_count": 2}


def test_scan_without_lines_is_as_before(spark):
    path = bronze_of(spark, [ev("a")])
    assert bronze_io.scan(spark, path).columns == BRONZE.names
    assert bronze_io.scan_raw(spark, path).first()["raw_line"] is None


def test_job_that_fails_while_writing_leaves_the_old_silver(spark, monkeypatch):
    root = scratch_path(spark, "t-fail")
    jobs.run_silver(spark, bronze_of(spark, [ev("a"), ev("b")]), f"{root}/silver")
    real = silver.transform

    def late_failure(raw, deterministic):
        out = real(raw, deterministic)
        return out.withColumn("region", F.when(F.col("event_id") == "z9", F.raise_error(F.lit("disk lost")))
                              .otherwise(F.col("region")))
    monkeypatch.setattr(silver, "transform", late_failure)
    rows = [ev(f"n{i}", f"2026-06-{1 + i % 28:02d}T12:00:00+00:00") for i in range(100)] + [ev("z9")]
    with pytest.raises(Exception, match="disk lost"):
        jobs.run_silver(spark, bronze_of(spark, rows), f"{root}/silver")
    assert ids(spark, f"{root}/silver") == ["a", "b"]
    monkeypatch.setattr(silver, "transform", real)
    jobs.run_silver(spark, bronze_of(spark, [ev("c")]), f"{root}/silver")
    assert ids(spark, f"{root}/silver") == ["c"]


def test_versions_can_be_dropped_but_the_current_one(spark):
    root = scratch_path(spark, "t-keep")
    for name in "abcd":
        jobs.run_silver(spark, bronze_of(spark, [ev(name)]), root)
    versions = lake.published(spark, root)
    assert lake.drop_old_versions(spark, root, keep=2) == versions[:2]
    assert lake.drop_old_versions(spark, root, keep=2) == []
    assert [lake.exists(spark, f"{root}/{v}") for v in versions] == [False, False, True, True]
    with pytest.raises(ValueError):
        lake.drop_version(spark, root, versions[-1])
    assert ids(spark, root) == ["d"]


def test_published_of_a_new_folder_is_quiet(spark, capfd):
    assert lake.published(spark, scratch_path(spark, "t-nothing")) == []
    assert not lake.has_rows(spark, scratch_path(spark, "t-nothing"))
    assert "PATH_NOT_FOUND" not in capfd.readouterr().err


def test_catalog_follows_the_published_version(spark):
    root = scratch_path(spark, "t-cat")
    jobs.run_silver(spark, bronze_of(spark, [ev("a"), ev("b", "2026-06-18T01:00:00+00:00")]), root)
    name = lake.register_partitioned(spark, root, "t_follow")
    assert spark.table(name).count() == 2
    jobs.run_silver(spark, bronze_of(spark, [ev("c", "2026-07-01T01:00:00+00:00")]), root)
    lake.register_partitioned(spark, root, name)
    assert [r.event_id for r in spark.table(name).collect()] == ["c"]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_only_touched_partitions_are_added(spark, monkeypatch):
    path = scratch_path(spark, "t-delta")
    first = silver.transform(spark.createDataFrame([ev("a"), ev("b", "2026-06-18T01:00:00+00:00")], BRONZE))
    touched = lake.write_silver(first, path)
    assert [(str(d), s) for d, s in touched] == [("2026-06-17", "auth-api"), ("2026-06-18", "auth-api")]
    name = lake.register_partitioned(spark, path, "t_delta", touched=touched)
    more = silver.transform(spark.createDataFrame([ev("c", "2026-06-18T02:00:00+00:00"),
                                                   ev("d", "2026-06-19T02:00:00+00:00", service="it's")], BRONZE))
    touched = lake.write_silver(more, path, dynamic=True)
    said = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: said.append(q) or real(self, q, *a, **k))
    lake.register_partitioned(spark, path, name, touched=touched)
    monkeypatch.undo()
    assert not any("RECOVER" in q for q in said) and sum("ADD IF NOT EXISTS" in q for q in said) == 1
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert len(parts) == 3
    assert sorted(r.event_id for r in spark.table(name).collect()) == ["a", "c", "d"]
    assert [r.event_id for r in spark.sql(f"SELECT * FROM {name} WHERE service = 'it''s'").collect()] == ["d"]
    # a partition without a value cannot be named: the folder is listed instead
    blank = silver.transform(spark.createDataFrame([ev("e", service="")], BRONZE))
    lake.register_partitioned(spark, path, name, touched=lake.write_silver(blank, path, dynamic=True))
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 4
    spark.sql(f"DROP TABLE {name}")
