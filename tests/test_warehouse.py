from __future__ import annotations

import datetime as dt

import pytest

from helpers import transactions
from pyspark.sql import functions as F

from txn_risk import jobs
from txn_risk.plans import measures, quality, reports, warehouse
from txn_risk.plans.staging import stage
from txn_risk.session import scratch_path, shared_dir
from txn_risk.sources import lake
from txn_risk.testbed.adapter import raw_transactions


def test_batch_branch(spark, sf_dir, tmp_path):
    raw = raw_transactions(spark, sf_dir)
    star = warehouse.build(raw, str(tmp_path), dt.date(2025, 1, 1))
    assert star.fact.count() == raw.count()
    report = warehouse.check(spark, str(tmp_path))
    assert report.count() == 20 and report.where("failures > 0").count() == 0

    sliced = reports.fact_slicer("2024-01-05", "2024-01-06", day=warehouse.DAY)
    same = reports.fact_slicer("2024-01-05", "2024-01-06")
    pruned = measures.measures(star.fact, where=sliced)
    assert pruned.collect() == measures.measures(star.fact, where=same).collect()
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trans_date" in plan


def test_staging_by_loads_equals_staging_of_everything(spark, tmp_path):
    raw_path, out = str(tmp_path / "raw"), str(tmp_path / "out")
    at = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

    def load(hours, *changes):
        rows = transactions(spark, *changes).withColumn("produced_at", F.lit("x"))
        lake.append_raw(lake.raw_rows(rows, at + dt.timedelta(hours=hours)), raw_path)

    def staged():
        return sorted(map(tuple, warehouse.staging(spark, out).collect()))

    def whole():
        return sorted(map(tuple, stage(lake.read_raw(spark, raw_path)).collect()))

    load(0, *[{"trans_num": f"a{i}", "trans_date_trans_time": f"2024-01-0{1 + i % 4} 23:59:59"} for i in range(12)])
    assert warehouse.refresh_staging(spark, raw_path, out) == [f"2024-01-0{d}" for d in (1, 2, 3, 4)]
    assert staged() == whole() and warehouse.refresh_staging(spark, raw_path, out) == []

    folder = tmp_path / "out" / quality.STAGING
    before = {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}
    # One again with another amount, one moved to a new day, and a day emptied by moves.
    load(1, {"trans_num": "a0", "trans_date_trans_time": "2024-01-01 23:59:59", "amt": 5.0},
         {"trans_num": "a4", "trans_date_trans_time": "2024-01-07 00:00:00"},
         *[{"trans_num": f"a{i}", "trans_date_trans_time": "2024-01-07 01:00:00"} for i in (3, 7, 11)])
    assert warehouse.refresh_staging(spark, raw_path, out) == ["2024-01-01", "2024-01-04", "2024-01-07"]
    assert staged() == whole() and len(staged()) == 12
    assert not (folder / "event_day=2024-01-04").exists()
    for f, changed in before.items():
        if f.parent.name in ("event_day=2024-01-02", "event_day=2024-01-03"):
            assert f.stat().st_mtime_ns == changed
    # An older copy that comes late does not replace a newer one.
    load(-1, {"trans_num": "a0", "trans_date_trans_time": "2024-01-01 23:59:59", "amt": 1.0})
    warehouse.refresh_staging(spark, raw_path, out)
    assert staged() == whole()
    star = warehouse.refresh(spark, raw_path, out, dt.date(2025, 1, 1))
    assert star.fact.count() == 12


def test_dimension_measures_match_a_plain_join(spark, sf_dir, tmp_path):
    star = warehouse.build(raw_transactions(spark, sf_dir), str(tmp_path), dt.date(2025, 1, 1))
    joined = star.fact.join(star.customers.select("customer_id", "state"), "customer_id")
    plain = measures.measures(joined, ["state"]).orderBy("state").collect()
    reduced = measures.measures_by_dimension(star.fact, star.customers, "customer_id", ["state"])
    assert reduced.orderBy("state").collect() == plain


def test_jobs_parse():
    args = jobs.parser().parse_args(
        ["load", "--lake", "l", "--raw", "r", "--modified-after", "2024-01-01T00:00:00"])
    assert args.run is jobs.load and args.modified_after == dt.datetime(2024, 1, 1)
    args = jobs.parser().parse_args(["ingest", "--topic", "t", "--lake", "l", "--rejects", "r", "--checkpoint", "c"])
    assert args.max_messages is None and args.max_per_batch is None
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["load"])


def test_shared_folder_is_the_sessions(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
