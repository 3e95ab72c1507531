"""CSV, topic records, lake, raw table, retention and the score table."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import TEMPLATE, by_id, transactions
from txn_risk.plans import decisions, monitoring
from txn_risk.schemas import CSV_FILE, EVENT, SCORE, TRANSACTION
from txn_risk.sources import csv_files, lake, partitions, score_store, topic
from txn_risk.streaming import pipelines

NOW = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def events(spark, *changes):
    return transactions(spark, *changes).withColumn("produced_at", F.lit("2024-01-01T00:00:00+00:00"))


def write_csv(path, rows):
    header = [""] + CSV_FILE.fieldNames()[1:]
    lines = [",".join(header)]
    lines += [",".join([str(i)] + [str(r[c]) for c in header[1:]]) for i, r in enumerate(rows)]
    path.write_text("\n".join(lines) + "\n")


def test_csv_drops_index_and_keeps_duplicates_of_a_union(spark, tmp_path):
    write_csv(tmp_path / "train.csv", [TEMPLATE])
    write_csv(tmp_path / "test.csv", [TEMPLATE, {**TEMPLATE, "amt": 9.5}])
    rows = csv_files.read_transactions(
        spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv")
    )
    assert rows.schema == TRANSACTION
    assert sorted(r["amt"] for r in rows.collect()) == [9.5, 42.25, 42.25]


def test_star_export_writes_three_tables(spark, tmp_path):
    rows = transactions(spark, {"cc_num": 1}, {"cc_num": 1, "amt": 9.0}, {"cc_num": 2})
    csv_files.export_star(rows, str(tmp_path / "star"))
    read = spark.read.option("header", True)
    fact = read.csv(str(tmp_path / "star" / "fct_transactions_fraud_features"))
    assert fact.count() == 3 and "amount" in fact.columns
    assert {r["amt_zscore_by_customer"] for r in fact.where("trans_num = 't2'").collect()} == {"0.0"}
    assert read.csv(str(tmp_path / "star" / "dim_customers")).count() == 2
    assert read.csv(str(tmp_path / "star" / "dim_merchants")).count() == 1


def test_message_has_all_fields_typed_and_a_zoned_time(spark):
    message = topic.encode(transactions(spark, {"city": None})).first()
    record = json.loads(message["value"])
    assert message["key"] == str(TEMPLATE["cc_num"])
    assert list(record) == EVENT.fieldNames()
    assert isinstance(record["amt"], float) and isinstance(record["cc_num"], int)
    assert record["city"] is None
    assert dt.datetime.fromisoformat(record["produced_at"]).tzinfo is not None


def test_malformed_messages_are_kept_apart(spark):
    good = topic.encode(transactions(spark, {})).select("value")
    bad = spark.createDataFrame([("not json",), ('{"amt": "many"}',)], "value string")
    decoded = topic.decode(good.unionByName(bad))
    assert topic.well_formed(decoded).select(*TRANSACTION.fieldNames()).collect() == (
        transactions(spark, {}).collect())
    assert {r["_corrupt"] for r in topic.malformed(decoded).collect()} == {
        "not json", '{"amt": "many"}'}


def test_partition_keys(spark):
    rows = events(spark, {"trans_date_trans_time": "2020-05-18 14:30:25"}, {"trans_date_trans_time": "?"})
    keys = by_id(lake.with_partition_keys(rows), "dt", "hour")
    assert keys["t0"] == ("2020-05-18", "14")
    assert keys["t1"][0] >= "2024-01-01"  # unreadable: now


def test_lake_layout_pruning_and_load(spark, tmp_path):
    path, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    three = events(
        spark, {"trans_date_trans_time": "2019-01-01 02:00:00"},
        {"trans_date_trans_time": "2019-01-01 02:30:00"},
        {"trans_date_trans_time": "2019-01-01 05:00:00"},
    )
    lake.write_lake(three, path)
    assert sorted(os.listdir(f"{path}/dt=2019-01-01")) == ["hour=02", "hour=05"]
    assert len(list((tmp_path / "lake").rglob("batch=*/*.parquet"))) == 2
    back = lake.read_lake(spark, path)
    assert {(r["hour"], r["n"]) for r in back.groupBy("hour").agg(F.count("*").alias("n")).collect()} == {
        ("02", 2), ("05", 1)}
    plan = lake.read_lake(spark, path, start="2019-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan

    lake.write_lake(three, path)  # delivered again
    first = lake.load(spark, path, raw, NOW)
    assert first == {"status": "SUCCESS", "files_loaded": 4, "files_skipped": 0, "rows_loaded": 3, "total_table_rows": 3}
    second = lake.load(spark, path, raw, NOW + dt.timedelta(days=1))
    assert second["rows_loaded"] == 3 and second["total_table_rows"] == 6
    assert sorted(os.listdir(raw))[-2:] == ["ingest_date=2024-02-01", "ingest_date=2024-02-02"]
    later = dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc)
    assert lake.load(spark, path, raw, NOW, modified_after=later)["status"] == "EMPTY"


def test_unreadable_file_fails_or_is_named(spark, tmp_path):
    path, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake.write_lake(events(spark, {}), path)
    (bad,) = (tmp_path / "lake" / "dt=2021-06-15" / "hour=13").glob("batch=*")
    (bad / "broken.parquet").write_bytes(b"PAR1 not really")
    (bad / "notes.txt").write_text("ignored")
    with pytest.raises(Exception, match="broken.parquet"):
        lake.read_lake(spark, path).count()
    assert lake.read_lake(spark, path, skip_unreadable=True).count() == 1
    (skipped,) = lake.unreadable_files(spark, path, lake.lake_files(spark, path)).collect()
    assert skipped["path"].endswith("broken.parquet")
    summary = lake.load(spark, path, raw, NOW, skip_unreadable=True)
    assert summary == {
        "status": "PARTIAL", "files_loaded": 1, "files_skipped": 1, "rows_loaded": 1, "total_table_rows": 1}


def test_sound_files_without_rows_are_loaded_and_broken_ones_left_out_whole(spark, tmp_path):
    import pyarrow.parquet as pq

    path, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake.write_lake(events(spark, *[{"unix_time": i} for i in range(300)]), path)
    (good,) = (tmp_path / "lake").rglob("*.parquet")
    table = pq.read_table(good)
    pq.write_table(table.slice(0, 0), good.with_name("empty.parquet"))
    renamed = table.set_column(0, "trans_num", [[f"second{i}" for i in range(300)]])
    broken = good.with_name("broken.parquet")
    pq.write_table(renamed, broken, row_group_size=100)
    content = bytearray(broken.read_bytes())
    at = pq.ParquetFile(broken).metadata.row_group(2).column(0).data_page_offset
    content[at:at + 200] = b"\xff" * 200  # the first two groups can be read
    broken.write_bytes(content)
    summary = lake.load(spark, path, raw, NOW, skip_unreadable=True, ledger=str(tmp_path / "ledger"))
    assert summary == {
        "status": "PARTIAL", "files_loaded": 2, "files_skipped": 1, "rows_loaded": 300, "total_table_rows": 300}
    # What was left out is asked for again; what was loaded is not.
    again = lake.load(spark, path, raw, NOW + dt.timedelta(days=1), skip_unreadable=True, ledger=str(tmp_path / "ledger"))
    assert (again["files_loaded"], again["files_skipped"], again["rows_loaded"]) == (0, 1, 0)


def test_ledger_takes_each_file_once(spark, tmp_path):
    path, raw, ledger = (str(tmp_path / n) for n in ("lake", "raw", "ledger"))
    assert lake.load(spark, path, raw, NOW, ledger=ledger)["status"] == "EMPTY"
    lake.write_lake(events(spark, {"trans_date_trans_time": "2019-01-01 02:00:00"}), path)
    assert lake.load(spark, path, raw, NOW, ledger=ledger)["rows_loaded"] == 1
    assert lake.load(spark, path, raw, NOW, ledger=ledger)["status"] == "EMPTY"
    lake.write_lake(events(spark, {"trans_num": "n1"}, {"trans_num": "n2"}), path)
    later = lake.load(spark, path, raw, NOW + dt.timedelta(hours=1), ledger=ledger)
    assert (later["files_loaded"], later["rows_loaded"], later["total_table_rows"]) == (1, 2, 3)


def test_load_with_a_ledger_scans_touched_days_only(spark, tmp_path):
    path, ledger = str(tmp_path / "lake"), str(tmp_path / "ledger")
    lake.write_lake(events(spark, {"trans_date_trans_time": "2019-01-01 02:00:00"}), path)
    partitions.note(partitions.files(spark, path), ledger)
    lake.write_lake(events(spark, {"trans_date_trans_time": "2019-03-01 02:00:00"}), path)
    new = partitions.unread(partitions.files(spark, path), ledger)
    assert partitions.folder_values(new, "dt") == ["2019-03-01"]
    rows = lake.read_lake(spark, path).where(F.col("dt").isin(["2019-03-01"]))
    plan = partitions.of_files(rows, new)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "LeftSemi" in plan


def batches(path):
    return sorted(p.name for p in path.rglob("batch=*"))


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "lake")
    two = lake.with_partition_keys(events(spark, {}, {"trans_date_trans_time": "2021-06-15 05:00:00"}))
    for name in ("q-7", "q-7", "q-8", "q-7"):
        lake.write_batch(two, path, name)
    assert lake.read_lake(spark, path).count() == 4
    assert batches(tmp_path / "lake") == ["batch=q-7", "batch=q-7", "batch=q-8", "batch=q-8"]


def test_micro_batch_again_in_another_hour_keeps_its_hours(spark, tmp_path, monkeypatch):
    """The sink fails after the first micro-batch is written; it runs again from the checkpoint."""
    path, cp = str(tmp_path / "lake"), str(tmp_path / "cp")
    events(spark, {}, {"trans_date_trans_time": "?"}).coalesce(1).write.parquet(str(tmp_path / "in"))
    write, hours = pipelines.write_batch, []

    def failing(rows, *to):
        write(rows, *to)
        hours.append(sorted((r["trans_num"], r["dt"], r["hour"]) for r in rows.collect()))
        if len(hours) == 1:
            raise OSError("lost")

    monkeypatch.setattr(pipelines, "write_batch", failing)
    with pytest.raises(Exception, match="lost"):
        pipelines.ingest_to_lake(
            pipelines.read_replay(spark, str(tmp_path / "in")), path, cp, interval=None).awaitTermination()
    pipelines.ingest_to_lake(
        pipelines.read_replay(spark, str(tmp_path / "in")), path, cp, interval=None).awaitTermination()
    assert len(hours) == 2 and hours[0] == hours[1]
    assert lake.read_lake(spark, path).count() == 2


def test_a_total_is_met_exactly_and_again_when_repeated(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    batch = events(spark, *[{"trans_date_trans_time": f"2024-01-01 00:00:{59 - i:02d}"} for i in range(8)])
    passed = [pipelines.admitted(batch, k, ledger, 20).count() for k in (0, 1, 2, 2, 1, 3)]
    assert passed == [8, 8, 4, 4, 8, 0]
    assert set(by_id(pipelines.admitted(batch, 2, ledger, 20), "amt")) == {"t7", "t6", "t5", "t4"}


def test_closed_hours_are_merged_once(spark, tmp_path):
    path, raw, ledger = (str(tmp_path / n) for n in ("lake", "raw", "ledger"))
    for i in range(4):
        lake.write_lake(events(
            spark, {"trans_num": f"a{i}", "trans_date_trans_time": "2024-01-01 02:00:00"},
            {"trans_num": f"b{i}", "trans_date_trans_time": "2024-01-01 03:30:00"},
        ), path)
    at = dt.datetime(2024, 1, 1, 3, tzinfo=dt.timezone.utc)
    before = sorted(map(tuple, lake.read_lake(spark, path).collect()))
    assert lake.merge_hours(spark, path, at, ledger) == 0  # nothing is loaded yet
    assert lake.load(spark, path, raw, NOW, ledger=ledger)["rows_loaded"] == 8
    assert lake.merge_hours(spark, path, at, ledger) == 1
    assert lake.merge_hours(spark, path, at, ledger) == 0
    assert len(list((tmp_path / "lake" / "dt=2024-01-01" / "hour=02").glob("batch=*"))) == 1
    assert len(list((tmp_path / "lake" / "dt=2024-01-01" / "hour=03").glob("batch=*"))) == 4
    assert sorted(map(tuple, lake.read_lake(spark, path).collect())) == before
    assert lake.load(spark, path, raw, NOW, ledger=ledger)["status"] == "EMPTY"


def test_a_merge_that_died_is_made_good_and_late_rows_join(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "lake")
    for i in range(3):
        lake.write_lake(events(spark, {"trans_num": f"a{i}", "trans_date_trans_time": "2024-01-01 02:00:00"}), path)
    before = sorted(map(tuple, lake.read_lake(spark, path).collect()))
    monkeypatch.setattr(lake, "remove", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        lake.merge_hours(spark, path, NOW)
    monkeypatch.undo()
    assert lake.read_lake(spark, path).count() == 6  # twice, until the next run
    assert lake.merge_hours(spark, path, NOW) == 1
    assert sorted(map(tuple, lake.read_lake(spark, path).collect())) == before
    lake.write_lake(events(spark, {"trans_num": "late", "trans_date_trans_time": "2024-01-01 02:00:00"}), path)
    assert lake.merge_hours(spark, path, NOW) == 1
    assert lake.read_lake(spark, path).count() == 4 and len(batches(tmp_path / "lake")) == 1


def test_messages_that_are_no_records(spark):
    values = [(None,), ("{}",), ("nonsense",), ('{"trans_num": "x", "amt": "many"}',), ('{"trans_num": "y"}',)]
    decoded = topic.decode(spark.createDataFrame(values, "value string"))
    assert [r["trans_num"] for r in topic.well_formed(decoded).collect()] == ["y"]
    assert sorted(r["_corrupt"] for r in topic.malformed(decoded).collect()) == [
        "", "nonsense", values[3][0], "{}"]


def test_flush_rule_has_no_ceiling():
    assert topic.flush_options() == {"minOffsetsPerTrigger": "500", "maxTriggerDelay": "15s"}
    assert "maxOffsetsPerTrigger" in topic.flush_options(max_per_trigger=10)


def test_header_of_other_names_is_refused(spark, tmp_path):
    write_csv(tmp_path / "good.csv", [TEMPLATE])
    text = (tmp_path / "good.csv").read_text().replace("amt,first", "first,amt")
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(ValueError, match="header"):
        csv_files.read_transactions(spark, str(tmp_path / "bad.csv"))


def test_header_of_every_file_is_checked(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", [TEMPLATE])
    text = (tmp_path / "in" / "a.csv").read_text().replace("first,last", "last,first")
    (tmp_path / "in" / "b.csv").write_text(text)
    rows = csv_files.read_transactions(spark, str(tmp_path / "in"))
    with pytest.raises(Exception, match="(?i)header"):
        rows.select("first", "amt").collect()


def test_newest_of_a_log_reads_newest_days_only(spark, tmp_path):
    log = str(tmp_path / "log")
    for day in range(1, 6):
        for name in ("a", f"b{day}"):
            score_store.append_scores(record(
                spark, trans_num=name, fraud_score=day / 10, processed_at=f"2024-01-0{day}T10:00:00Z"), log)
    got = by_id(score_store.newest_of_log(spark, log, 3), "fraud_score")
    assert got == {"a": 0.5, "b5": 0.5, "b4": 0.4}
    plan = score_store.newest_of_log(spark, log, 2)._jdf.queryExecution().executedPlan().toString()
    assert "processed_date" in plan and "2024-01-04" not in plan
    mixed = record(spark, processed_at="2024-01-02 09:00:00", fraud_score=0.2).unionByName(
        record(spark, processed_at="2024-01-02T08:00:00Z", fraud_score=0.9))
    assert by_id(score_store.latest_scores(mixed), "fraud_score") == {"a": 0.2}


def test_retention_deletes_only_expired_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(events(spark, {}, {"trans_date_trans_time": "2019-01-01 05:00:00"}), path)
    old_dir = tmp_path / "lake" / "dt=2019-01-01" / "hour=05"
    (old,) = old_dir.rglob("*.parquet")
    eight_days = NOW.timestamp() - 8 * 86400
    for f in (tmp_path / "lake").rglob("*.parquet"):
        os.utime(f, (NOW.timestamp(), NOW.timestamp()))
    os.utime(old, (eight_days, eight_days))
    (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
    assert lake.remove_expired(spark, path, NOW) == 1 and old.exists()  # dry run
    assert lake.remove_expired(spark, path, NOW, dry_run=False) == 1
    assert not old_dir.exists()
    assert lake.read_lake(spark, path).count() == 1


def test_stream_written_lake_survives_retention_and_appends(spark, tmp_path):
    path, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    events(spark, {}, {"trans_date_trans_time": "2019-01-01 05:00:00"}).write.parquet(str(tmp_path / "in"))
    stream = pipelines.read_replay(spark, str(tmp_path / "in"))
    pipelines.ingest_to_lake(stream, path, str(tmp_path / "cp"), interval=None).awaitTermination()
    lake.write_lake(events(spark, {"trans_num": "later"}), path)
    assert lake.read_lake(spark, path).count() == 3
    eight_days = NOW.timestamp() - 8 * 86400
    for f in (tmp_path / "lake").rglob("*.parquet"):
        old = "hour=05" in str(f)
        os.utime(f, (eight_days, eight_days) if old else (NOW.timestamp(), NOW.timestamp()))
    assert lake.remove_expired(spark, path, NOW, dry_run=False) == 1
    assert lake.load(spark, path, raw, NOW)["rows_loaded"] == 2


def record(spark, **change):
    base = dict(
        trans_num="a", trans_date_trans_time="2019-01-01 00:00:18", unix_time=1, cc_num=1,
        merchant="m", category="c", amt=10.0, city="x", state="y", geo_distance_km=1.0,
        txn_freq_24h=0, amt_zscore_by_customer=0.0, fraud_score=0.1, is_fraud_predicted=0,
        is_fraud_ground_truth=-1, decision="APPROVE", latency_ms=2.0,
        processed_at="2024-01-01T00:00:00+00:00",
    )
    return spark.createDataFrame([tuple({**base, **change}[f.name] for f in SCORE.fields)], SCORE)


def scores_of(spark, n, **change):
    return record(spark, **change).drop("trans_num").crossJoin(
        spark.range(n).select(F.concat(F.lit("k"), "id").alias("trans_num"))
    ).select(*SCORE.fieldNames())


def bucket_files(table):
    return {
        p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet"))
        for p in table.rglob("bucket=*")
    }


def test_upsert_replaces_and_survives_replay(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    old = record(spark)
    new = record(spark, fraud_score=0.9, decision="BLOCK", processed_at="2024-01-02T00:00:00+00:00")
    score_store.append_scores(old, log)
    score_store.append_scores(new, log)
    assert by_id(score_store.latest_scores(score_store.read_log(spark, log)), "decision") == {"a": "BLOCK"}
    assert score_store.read_compacted(spark, table).count() == 0
    assert score_store.upsert(new, table) == score_store.upsert(old.unionByName(new), table)  # replay
    assert score_store.upsert(old.limit(0), table) == []
    assert score_store.lookup(spark, table, "a").count() == 1
    assert score_store.lookup(spark, table, "z").count() == 0
    assert by_id(score_store.read_compacted(spark, table), "fraud_score") == {"a": 0.9}


def test_upsert_leaves_other_buckets_files_alone(spark, tmp_path):
    table = tmp_path / "table"
    score_store.upsert(scores_of(spark, 400), str(table), buckets=8)
    before = bucket_files(table)
    assert len(before) == 8
    late = scores_of(spark, 400, fraud_score=0.7, processed_at="2024-02-01T00:00:00Z").where("trans_num = 'k7'")
    (hit,) = score_store.upsert(late, str(table))
    after = bucket_files(table)
    assert [b for b in before if before[b] != after[b]] == [f"bucket={hit}"]
    got = by_id(score_store.read_compacted(spark, str(table)), "fraud_score")
    assert len(got) == 400 and got["k7"] == 0.7 and sum(v == 0.1 for v in got.values()) == 399


def test_table_is_dealt_anew_when_a_bucket_is_full(spark, tmp_path):
    table = str(tmp_path / "table")
    score_store.upsert(scores_of(spark, 300), table, buckets=4, bucket_rows=30)
    names = [n for n in os.listdir(table) if n.startswith("of=")]
    assert len(names) == 1 and int(names[0][3:]) >= 8
    assert score_store.read_compacted(spark, table).count() == 300
    assert score_store.lookup(spark, table, "k123").count() == 1
    assert len(score_store.upsert(record(spark, trans_num="k1"), table, bucket_rows=30)) == 1
    assert score_store.read_compacted(spark, table).count() == 300


def test_interrupted_upsert_is_finished_by_the_next(spark, tmp_path):
    table = str(tmp_path / "table")
    score_store.upsert(scores_of(spark, 50), table, buckets=2)
    held, n = score_store._current(spark, table)
    late = scores_of(spark, 50, fraud_score=0.7, processed_at="2024-02-01T00:00:00Z")
    shaped = late.withColumn("bucket", score_store._bucket(F.col("trans_num"), n))
    shaped.write.partitionBy("bucket").parquet(held._aside)  # died here, complete
    partitions.remove(spark, f"{held.path}/bucket=1")  # and in the middle of putting it in place
    score_store.upsert(record(spark, trans_num="new"), table)
    got = by_id(score_store.read_compacted(spark, table), "fraud_score")
    assert len(got) == 51 and sum(v == 0.7 for v in got.values()) == 50
    shaped.limit(1).write.partitionBy("bucket").parquet(held._aside)
    partitions.remove(spark, f"{held._aside}/_SUCCESS")  # died while writing aside
    score_store.upsert(record(spark, trans_num="newer"), table)
    assert score_store.read_compacted(spark, table).count() == 52


def test_second_writer_fails(spark, tmp_path):
    table = str(tmp_path / "table")
    score_store.upsert(record(spark), table)
    with partitions.PartitionedTable(spark, table, SCORE, ("bucket",)).writing():
        with pytest.raises(RuntimeError, match="another writer"):
            score_store.upsert(record(spark, trans_num="b"), table)
    score_store.upsert(record(spark, trans_num="b"), table)
    assert score_store.read_compacted(spark, table).count() == 2


def test_compact_reads_new_log_files_only(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    for day, score in ((1, 0.2), (2, 0.4)):
        score_store.append_scores(
            scores_of(spark, 40, fraud_score=score, processed_at=f"2024-01-0{day}T00:00:00Z"), log)
    assert score_store.compact(spark, log, table, buckets=4) == [0, 1, 2, 3]
    assert score_store.compact(spark, log, table) == []
    score_store.append_scores(record(spark, trans_num="k3", fraud_score=0.9, processed_at="2024-01-02T09:00:00Z"), log)
    ledger = f"{table}/_log_files"
    new = partitions.unread(partitions.files(spark, log), ledger)
    assert partitions.folder_values(new, "processed_date") == ["2024-01-02"]
    assert len(score_store.compact(spark, log, table)) == 1
    got = by_id(score_store.read_compacted(spark, table), "fraud_score")
    assert len(got) == 40 and got["k3"] == 0.9 and sum(v == 0.4 for v in got.values()) == 39


def test_first_store_wins_and_dirty_values_are_coerced(spark):
    text = {c: F.col(c).cast("string") for c in ("amt", "fraud_score", "txn_freq_24h")}
    one = record(spark, decision="BLOCK").withColumns(text)
    two = record(spark, processed_at="2025-01-01T00:00:00+00:00").withColumns(text).unionByName(
        record(spark, trans_num="b", processed_at="?").withColumns(text).withColumn("amt", F.lit("n/a"))
    )
    rows = {r["trans_num"]: r for r in score_store.read_stores([one, two], 10).collect()}
    assert rows["a"]["decision"] == "BLOCK"
    assert rows["b"]["amt"] == 0.0 and rows["b"]["processed_at"] is None
    assert score_store.read_stores([one, two], 1).count() == 1


def test_policy_edges(spark):
    scores = spark.createDataFrame([(0.85,), (0.8499,), (0.75,), (0.7499,)], "s double")
    got = [r["d"] for r in scores.select(decisions.decision(F.col("s")).alias("d")).collect()]
    assert got == ["BLOCK", "ALERT", "ALERT", "APPROVE"]


def test_live_figures(spark):
    scores = record(spark).unionByName(
        record(spark, trans_num="b", decision="BLOCK", amt=5.0, latency_ms=4.0))
    row = monitoring.live_kpis(scores).first()
    assert tuple(row) == (2, 1, 1, 50.0, 3.0, 15.0)
    assert tuple(monitoring.live_kpis(scores.limit(0)).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert monitoring.filter_scores(scores, ["BLOCK"], 6).count() == 0
    assert monitoring.filter_scores(scores, ["ALL", "BLOCK"]).count() == 2
    assert monitoring.lookup(scores, "b").count() == 1
    assert monitoring.timeline(scores, 1).count() == 1
    assert monitoring.display_table(scores).where("trans_num = 'b'").first()["amount"] == "$5.00"
    assert {tuple(r) for r in monitoring.decision_counts(scores).collect()} == {("BLOCK", 1), ("APPROVE", 1)}


def test_signals(spark):
    scores = record(spark, geo_distance_km=100.0, amt_zscore_by_customer=-2.5)
    row = decisions.risk_signals(scores).first()
    assert (row["flag_far"], row["flag_amount"]) == (False, True)


def test_replay_summary(spark):
    row = monitoring.replay_summary(transactions(spark, {}, {"is_fraud": 1}), seconds=4).first()
    assert tuple(row) == (2, 1, 50.0, 0.5)
