"""Staging, dimensions, fact, quality checks and measures on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import by_id, transactions
from txn_risk.operators.dedup import first_per_key, latest_per_key, one_per_seldom_repeated
from txn_risk.plans import marts, measures, quality, reports
from txn_risk.plans.staging import clean, stage
from txn_risk.schemas import DIM_CUSTOMERS, DIM_MERCHANTS, FCT_FEATURES, RAW

LOADED = dt.datetime(2024, 1, 1)


def raw(spark, *changes, ingested_at=LOADED):
    return transactions(spark, *changes).withColumn("ingested_at", F.lit(ingested_at).cast("timestamp"))


def test_cleaning(spark):
    row = clean(raw(spark, {
        "merchant": "  Shop ", "category": " Misc_NET ", "gender": " f", "state": "nc ",
        "first": " Ann ", "job": " Driver ",
    })).first()
    assert (row["merchant_name"], row["category"], row["gender"], row["state"]) == (
        "Shop", "misc_net", "F", "NC")
    assert (row["first_name"], row["job_title"]) == ("Ann", "Driver")
    assert row["date_of_birth"] == dt.date(1979, 11, 2)


def test_bad_time_fails_unless_lenient(spark):
    bad = raw(spark, {"trans_date_trans_time": "01/02/2019", "dob": "x"})
    with pytest.raises(PySparkException):
        clean(bad).collect()
    row = clean(bad, lenient=True).first()
    assert row["trans_timestamp"] is None and row["date_of_birth"] is None


def test_latest_load_wins_and_ties_settle(spark):
    first = raw(spark, {"amt": 1.0})
    later = raw(spark, {"amt": 2.0}, ingested_at=LOADED + dt.timedelta(hours=1))
    assert by_id(stage(first.unionByName(later)), "amount") == {"t0": 2.0}
    tied = raw(spark, {"amt": 5.0}).unionByName(raw(spark, {"amt": 3.0}))
    results = {by_id(stage(tied.repartition(n)), "amount")["t0"] for n in (1, 2, 4)}
    assert results == {5.0}


def test_dedup_sends_one_row_per_key_and_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], ["v"])
    assert sorted(map(tuple, out.collect())) == [(0, 999), (1, 997), (2, 998)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert sorted(map(tuple, first_per_key(df, ["k"], ["v"]).collect())) == [(0, 0), (1, 1), (2, 2)]


def test_contracts(spark):
    s = marts.star(stage(raw(spark, {})), dt.date(2025, 1, 1))
    assert s.customers.columns == list(DIM_CUSTOMERS)
    assert s.merchants.columns == list(DIM_MERCHANTS)
    assert s.fact.columns == list(FCT_FEATURES)
    s.register()
    assert spark.sql("SELECT count(*) c FROM fct_transactions_fraud_features").first()["c"] == 1


def test_customer_takes_latest_record(spark):
    rows = raw(
        spark, {"city": "Old", "trans_date_trans_time": "2019-01-01 00:00:00"},
        {"city": "New", "trans_date_trans_time": "2019-06-01 00:00:00"},
    )
    row = marts.customers(stage(rows), dt.date(2025, 1, 1)).first()
    assert row["city"] == "New" and row["customer_age"] == 2025 - 1979


def test_zscore_null_for_single_and_constant_cards(spark):
    rows = raw(
        spark, {"cc_num": 1, "amt": 5.0}, {"cc_num": 2, "amt": 5.0}, {"cc_num": 2, "amt": 5.0},
        {"cc_num": 3, "amt": 1.0}, {"cc_num": 3, "amt": 3.0},
    )
    z = by_id(marts.fct_features(stage(rows)), "amt_zscore_by_customer")
    assert z == {"t0": None, "t1": None, "t2": None, "t3": -0.7071, "t4": 0.7071}


def test_rows_without_keys_leave_the_fact(spark):
    rows = raw(spark, {}, {"cc_num": None}, {"merchant": None}, {"category": None})
    stg = stage(rows)
    assert set(by_id(marts.fct_features(stg), "amount")) == {"t0"}
    joined = marts.fct_features(stg, marts.customers(stg), marts.merchants(stg))
    assert set(by_id(joined, "amount")) == {"t0"}


def test_quality_passes_on_good_rows_and_finds_faults(spark):
    good = stage(raw(spark, {}, {"is_fraud": 1}))
    s = marts.star(good)
    report = quality.quality_report({
        quality.STAGING: good, quality.CUSTOMERS: s.customers, quality.MERCHANTS: s.merchants,
        quality.FACT: s.fact,
    })
    rows = report.collect()
    assert len(rows) == 20 and all(r["failures"] == 0 for r in rows)

    bad = s.fact.unionByName(
        s.fact.withColumn("is_fraud", F.lit(7)).withColumn("customer_id", F.lit("nobody"))
    ).unionByName(s.fact.withColumn("merchant_id", F.lit(None).cast("string")))
    found = {
        (r["check"], r["column"]): r["failures"]
        for r in quality.quality_report({
            quality.FACT: bad, quality.CUSTOMERS: s.customers, quality.MERCHANTS: s.merchants,
        }).where("model = 'fct_transactions_fraud_features'").collect()
    }
    assert found[("unique", "trans_num")] == 2
    assert found[("accepted_values", "is_fraud")] == 2
    assert found[("relationships", "customer_id")] == 2
    assert found[("not_null", "merchant_id")] == 2
    assert found[("relationships", "merchant_id")] == 0


def test_raw_contract():
    assert len(RAW.fields) == 24 and RAW["trans_num"].nullable is False
    assert quality.schema_problems(RAW) == []
    assert quality.schema_problems(RAW, RAW) == []


def test_schema_problems_are_named(spark):
    df = spark.createDataFrame([("a", 1)], "trans_num string, unix_time int")
    problems = quality.schema_problems(df.schema)
    assert "unix_time is int, expected bigint" in problems and "missing amt" in problems


def test_readiness(spark):
    rows = raw(spark, {"is_fraud": 1}, {"trans_date_trans_time": "2019-01-11 00:00:00"})
    assert quality.retrain_readiness(rows, min_rows=2, min_days=10).first()["ready"]
    assert not quality.retrain_readiness(rows, min_rows=3).first()["ready"]
    assert not quality.retrain_readiness(rows.limit(0)).first()["ready"]


def test_measures_fall_back_when_a_class_is_missing(spark):
    fact = marts.fct_features(stage(raw(spark, {"amt": 4.0, "is_fraud": 0})))
    row = measures.measures(fact).first()
    assert len(measures.MEASURES) == 20 and row["fraud_to_normal_ratio"] == 1.0
    assert row["fraud_rate"] == 0.0 and row["avg_fraud_amount"] is None
    empty = measures.measures(fact.limit(0)).first()
    assert empty["total_transactions"] == 0 and empty["fraud_loss_rate"] == 0.0


def test_measures_compute_only_what_is_asked(spark):
    fact = marts.fct_features(stage(raw(spark, {})))
    plan = measures.measures(fact, only=["fraud_rate"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "geo_distance_km" not in plan


@pytest.mark.parametrize(
    "km, band",
    [(9.99, "< 10"), (10.0, "10 - 50"), (50.0, "50 - 100"), (100.0, "50 - 100"), (100.01, "> 100")],
)
def test_distance_band_edges(spark, km, band):
    assert spark.range(1).select(reports.distance_band(F.lit(km)).alias("b")).first()["b"] == band


@pytest.mark.parametrize("few_keys, few_copies", [(100, 100), (1, 100), (1, 1)])
def test_seldom_repeated_keys_are_resolved_alike(spark, few_keys, few_copies):
    """Repeated and missing keys give one row each, whichever way the rows take."""
    rows = [(str(i), i) for i in range(50)] + [("3", 99), ("4", 98), ("4", 97), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(3)
    got = one_per_seldom_repeated(df, "k", lambda r: latest_per_key(r, ["k"], ["v"]), few_keys, few_copies)
    want = {**{str(i): i for i in range(50)}, "3": 99, "4": 98, None: 2}
    assert got.count() == len(want) and dict(map(tuple, got.collect())) == want


def test_unrepeated_rows_are_neither_sorted_nor_shuffled(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, *[{"trans_num": f"t{i}"} for i in range(5)], {"trans_num": "t3", "amt": 7.0}).write.parquet(path)
    out = stage(spark.read.parquet(path))
    assert out.count() == 5 and by_id(out, "amount")["t3"] in (7.0, 42.25)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    alone = plan[:plan.index("LeftSemi")]
    assert "LeftAnti" in alone and "RepartitionByExpression" not in plan
