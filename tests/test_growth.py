"""Steps whose cost must not outgrow their input."""

from __future__ import annotations

from pyspark.sql import functions as F

from txn_risk.sources import score_store
from txn_risk.streaming import pipelines
from txn_risk.testbed import catalog
from txn_risk.testbed.adapter import raw_transactions


def test_a_micro_batch_of_a_replay_is_spread_over_files(spark, sf_dir, tmp_path, monkeypatch):
    """Five micro-batches in the order of time, whatever number of files (hence tasks) each has."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 50)
    raw = raw_transactions(spark, sf_dir)
    seen, files, write = [], [], pipelines.write_replay_files
    monkeypatch.setattr(
        pipelines, "write_replay_files", lambda rows, path, n, **more: files.append(n) or write(rows, path, n, **more)
    )

    def note(rows, _number):
        time = "trans_date_trans_time"
        seen.append(rows.agg(F.count(F.lit(1)), F.min(time), F.max(time)).first())

    catalog.replayed(raw).writeStream.foreachBatch(note).option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 5 and sum(r[0] for r in seen) == raw.count()
    assert all(a[2] <= b[1] for a, b in zip(seen, seen[1:]))
    assert files == [20]


def test_nothing_is_read_once_the_total_is_reached(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert pipelines.admitted(spark.range(5), 0, ledger, 5).count() == 5
    unread = spark.range(3).select(F.raise_error(F.lit("read")).cast("bigint").alias("id"), F.rand().alias("r")).where("id > 0")
    assert pipelines.admitted(unread, 1, ledger, 5).count() == 0


def test_the_first_upsert_ranks_once(spark, sf_dir, tmp_path, monkeypatch):
    calls, real = [], score_store.latest_scores
    monkeypatch.setattr(score_store, "latest_scores", lambda log: calls.append(1) or real(log))
    log = catalog.score_log(spark, sf_dir).limit(40)
    table = str(tmp_path / "table")
    score_store.upsert(log, table, buckets=2)
    assert len(calls) == 1 and score_store.read_compacted(spark, table).count() == 40
    score_store.upsert(log, table, buckets=2)
    assert len(calls) == 3 and score_store.read_compacted(spark, table).count() == 40
