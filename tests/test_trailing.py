"""24-hour counts: ties, edges, missing times, skew, and stream against batch."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import by_id, transactions
from txn_risk.operators import trailing
from txn_risk.streaming.pipelines import read_replay, without_repeats, write_replay_files
from txn_risk.streaming.trailing_state import with_trailing_count as stream_count

SCHEMA = "trans_num string, cc_num bigint, unix_time bigint"


def brute(rows, horizon=86400):
    """Straight from the definition."""
    out = {}
    for name, card, at in rows:
        out[name] = sum(
            1 for _, c, t in rows
            if c == card and (t is None if at is None else t is not None and at - horizon <= t < at)
        )
    return out


def strict(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return by_id(trailing.with_trailing_count(df, "cc_num", "unix_time", "n"), "n")


def test_edges_and_ties(spark):
    rows = [
        ("a", 1, 1000), ("b", 1, 1000 + 86400), ("c", 1, 1000 + 86401), ("d", 1, 1000 + 86401),
        ("e", 2, 1000), ("f", 2, 1000 + 86401), ("g", 1, -5), ("h", 1, -86405), ("i", 1, -86406),
    ]
    got = strict(spark, rows)
    assert got == brute(rows)
    assert got["b"] == 1  # a gap of exactly a day counts
    assert got["f"] == 0  # one second more does not
    assert got["c"] == got["d"] == 1  # ties leave each other out


def test_missing_times_are_peers(spark):
    rows = [("a", 1, None), ("b", 1, None), ("c", 1, 50), ("d", 2, None)]
    assert strict(spark, rows) == brute(rows)


def test_random_cards_match_definition(spark):
    rng = random.Random(7)
    rows = [(f"r{i}", rng.choice([1, 1, 1, 2, 3]), rng.randrange(0, 400_000)) for i in range(600)]
    assert strict(spark, rows) == brute(rows)


@pytest.mark.parametrize("slot", [1, 86400, 100_000, 10_000_000])
def test_slot_length_does_not_matter(spark, slot):
    rng = random.Random(11)
    rows = [(f"r{i}", rng.choice([1, 2]), rng.randrange(-200_000, 400_000)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    profile = trailing.trailing_counts(df, "cc_num", "unix_time", slot=slot)
    got = by_id(trailing.attach_by_second(df, profile, "cc_num", "unix_time"), "n_trailing")
    assert got == brute(rows)


def test_one_second_holding_a_third_of_all_rows(spark):
    rows = [(f"h{i}", 1, 500) for i in range(200)] + [(f"r{i}", i % 7, i * 997) for i in range(400)]
    assert strict(spark, rows) == brute(rows)


def test_rank_adds_earlier_ties(spark):
    rows = [("a", 1, 10), ("b", 1, 10), ("c", 1, 10), ("d", 1, 20), ("e", 2, 10)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_id(trailing.with_trailing_rank(df, "cc_num", "unix_time", "trans_num", "n"), "n")
    assert sorted([got["a"], got["b"], got["c"]]) == [0, 1, 2]
    assert got["d"] == 3 and got["e"] == 0


def test_busy_second_is_ranked_in_shares(spark):
    rows = [(f"h{i:04d}", 1, 500) for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    ranked = trailing.with_trailing_rank(df, "cc_num", "unix_time", "trans_num", "n")
    assert sorted(by_id(ranked, "n").values()) == list(range(700))


def test_empty(spark):
    assert strict(spark, []) == {}


def test_plan_counts_before_it_shuffles_and_sweeps_slots(spark):
    df = spark.createDataFrame([("a", 1, 1)], SCHEMA)
    plan = trailing.trailing_counts(df, "cc_num", "unix_time")._jdf.queryExecution().toString()
    assert "partial_count" in plan
    assert "pmod(t" in plan


def _run(stream, spark, tmp_path):
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def _batches(spark, tmp_path, *batches):
    """One file, hence one micro-batch, per list of (trans_num, cc_num, unix_time)."""
    import os

    for i, rows in enumerate(batches):
        folder = str(tmp_path / f"b{i}")
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(folder)
        (part,) = [f for f in os.listdir(folder) if f.startswith("part-")]
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.link(f"{folder}/{part}", tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )


def test_stream_equals_batch_over_micro_batches(spark, sf_dir, tmp_path):
    from txn_risk.testbed.adapter import raw_transactions

    raw = raw_transactions(spark, sf_dir)
    write_replay_files(raw, str(tmp_path / "replay"), files=4)
    stream = read_replay(spark, str(tmp_path / "replay")).select("trans_num", "cc_num", "unix_time")
    got = by_id(_run(stream_count(stream), spark, tmp_path), "txn_freq_24h")
    batch = trailing.with_trailing_count(
        raw.select("trans_num", "cc_num", "unix_time"), "cc_num", "unix_time", "n"
    )
    assert got == by_id(batch, "n")


def test_stream_keeps_ties_and_late_events(spark, tmp_path):
    day = 86400
    stream = _batches(
        spark, tmp_path,
        [("a", 1, 10 * day), ("b", 1, 10 * day)],
        [("late", 1, 10 * day - 100)],  # before the two, after they were sent
        [("c", 1, 10 * day + 50)],
    )
    got = by_id(_run(stream_count(stream), spark, tmp_path), "txn_freq_24h")
    assert got == {"a": 0, "b": 0, "late": 0, "c": 3}


def test_stream_very_late_event_is_still_sent_out(spark, tmp_path):
    day = 86400
    stream = _batches(spark, tmp_path, [("a", 1, 30 * day)], [("old", 1, 2 * day)])
    assert set(by_id(_run(stream_count(stream), spark, tmp_path), "txn_freq_24h")) == {"a", "old"}


@pytest.mark.parametrize("changes", [[{"unix_time": None}, {}]])
def test_missing_unix_time_is_read_from_the_text(spark, changes):
    from txn_risk.plans.features import with_defaults

    rows = with_defaults(transactions(spark, *changes)).orderBy("trans_num").collect()
    assert rows[0]["unix_time"] == 1623764730  # the text's own second
    assert rows[1]["unix_time"] == 1623764700  # kept although it differs


def _arrivals(spark, tmp_path, *batches):
    stream = _batches(spark, tmp_path, *batches)
    return without_repeats(stream, "1 day", arrived=F.timestamp_seconds("unix_time"))


def test_repeats_go_and_nothing_else(spark, tmp_path):
    day = 86_400
    out = _run(_arrivals(
        spark, tmp_path,
        [(None, 1, 10 * day), ("a", 1, 10 * day), ("a", 2, 10 * day)],
        [("b", 1, 10 * day + 3600), ("a", 1, 10 * day + 3600), (None, 1, 10 * day + 3600)],
        [("c", 1, 10 * day + 7200), ("b", 1, 10 * day + 7200)],
    ), spark, tmp_path)
    assert sorted(str(r["trans_num"]) for r in out.collect()) == ["None", "None", "a", "b", "c"]


def test_repeats_by_the_clock_of_the_micro_batch(spark, tmp_path):
    stream = _batches(spark, tmp_path, [("a", 1, 5), ("b", 1, None)], [("a", 1, 5), ("c", 1, 1)], [("b", 1, None)])
    out = _run(without_repeats(stream, "1 day"), spark, tmp_path)
    assert sorted(r["trans_num"] for r in out.collect()) == ["a", "b", "c"]


def test_state_of_repeats_shrinks_as_time_moves_on(spark, tmp_path):
    day = 86_400
    stream = _arrivals(
        spark, tmp_path, [(f"k{i}", 1, 10 * day) for i in range(500)], [("x", 1, 11 * day)], [("y", 1, 13 * day)],
        [("z", 1, 16 * day)],
    )
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["numInputRows"]]
    assert held[:2] == [500, 501] and held[-1] <= 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 503


def test_skewed_join_is_split(spark):
    """With one card on most rows, adaptive execution splits its join partition."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("wide"),
        )
        dim = spark.range(0, 60000).select(F.col("id").alias("k"), F.col("id").alias("attr"))
        from txn_risk.operators.joins import star_join

        joined = star_join(fact, dim, "k", ["attr"])
        assert len(joined.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
