"""Features, training, saved models, and scoring in batch and stream."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import by_id, transactions
from txn_risk.plans import decisions, training
from txn_risk.plans.features import Baseline, assembler, batch_features
from txn_risk.schemas import FEATURES, SCORE
from txn_risk.sources import models as store
from txn_risk.sources import score_store
from txn_risk.streaming import pipelines
from txn_risk.testbed.adapter import raw_transactions

SMALL = training.Settings(iterations=20, trees=5, tree_depth=4, rounds=3, boost_depth=3)


@pytest.fixture(scope="module")
def split(spark):
    raw = raw_transactions(spark, "/root/testdata/sf0.01").cache()
    cut = "2024-01-23"
    early = F.col("trans_date_trans_time") < cut
    return raw.where(early), raw.where(~early)


@pytest.fixture(scope="module")
def trained(split):
    return training.train(*split, settings=SMALL, folds=2)


def test_27_features_in_order(spark):
    rows = transactions(spark, {"cc_num": 1}, {"cc_num": 1, "unix_time": 1623764982, "amt": 50.0})
    out = batch_features(rows, Baseline.fit(rows))
    assert out.columns == ["trans_num", "is_fraud", *FEATURES] and len(FEATURES) == 27
    assert by_id(out, "txn_freq_24h") == {"t0": 0.0, "t1": 1.0}
    row = out.where("trans_num = 't0'").first()
    assert (row["day_of_week"], row["trans_hour"], row["is_night"]) == (1.0, 13.0, 0.0)
    assert row["cat_shopping_pos"] == 1.0 and row["cat_other"] == 0.0
    assert row["amt_zscore_by_customer"] == pytest.approx(-(0.5 ** 0.5))


def test_unseen_and_constant_cards(spark):
    train = transactions(spark, {"cc_num": 1, "amt": 10.0}, {"cc_num": 1, "amt": 10.0},
                         {"cc_num": 2, "amt": 40.0})
    rows = transactions(spark, {"cc_num": 1, "amt": 99.0}, {"cc_num": 2}, {"cc_num": 9, "amt": 30.0})
    z = by_id(batch_features(rows, Baseline.fit(train)), "amt_zscore_by_customer")
    assert z["t0"] == 0.0 and z["t1"] == 0.0  # constant card, one-row card
    assert z["t2"] == pytest.approx((30 - 20) / 300 ** 0.5)  # the global baseline


def test_global_defaults(spark):
    nothing = Baseline.fit(transactions(spark, {}).limit(0)).overall.first()
    assert tuple(nothing) == (70.0, 160.0)
    single = Baseline.fit(transactions(spark, {"amt": 3.0})).overall.first()
    assert tuple(single) == (3.0, 1.0)


def test_missing_fields_take_defaults(spark):
    rows = transactions(spark, {
        "lat": None, "long": None, "merch_lat": None, "merch_long": None, "city_pop": None,
        "dob": "unknown", "gender": None, "category": None, "trans_date_trans_time": "bad",
        "unix_time": None,
    }, {"dob": None})
    out = {r["trans_num"]: r for r in batch_features(rows, Baseline.fit(rows)).collect()}
    assert out["t0"]["geo_distance_km"] == 0.0 and out["t0"]["customer_age"] == 35.0
    assert out["t0"]["city_pop_log"] == pytest.approx(9.21044, abs=1e-4)
    assert out["t0"]["cat_other"] == 1.0 and out["t0"]["gender_code"] == 0.0
    assert out["t1"]["customer_age"] == 31.0  # born 1990-01-01: 11,488 days


def test_tie_policies(spark):
    rows = transactions(spark, {}, {})
    fitted = Baseline.fit(rows)
    assert set(by_id(batch_features(rows, fitted), "txn_freq_24h").values()) == {0.0}
    assert set(by_id(batch_features(rows, fitted, "rank"), "txn_freq_24h").values()) == {0.0, 1.0}
    with pytest.raises(ValueError):
        batch_features(rows, fitted, "other")


def test_weights(spark):
    rows = transactions(spark, {"is_fraud": 1}, {}, {}, {})
    assert training.class_balance_weights(rows).first()["imbalance_ratio"] == 3.0
    got = by_id(
        training.with_positive_weight(training.with_balanced_weight(rows)), "w_balanced", "w_positive"
    )
    assert got["t0"] == (2.0, 3.0) and got["t1"] == (pytest.approx(2 / 3), 1.0)


def test_time_prefix(spark):
    rows = transactions(spark, {"trans_date_trans_time": "2022-01-02 00:00:00"}, {})
    assert set(by_id(training.time_prefix(rows, 1), "amt")) == {"t1"}
    assert training.time_prefix(rows, None).count() == 2
    unreadable = transactions(spark, *[{"trans_date_trans_time": "?"}] * 30, {})
    assert set(by_id(training.time_prefix(unreadable, 1), "amt")) == {"t30"}
    assert training.time_prefix(unreadable, 11).count() == 11


def test_training_run(trained):
    assert trained.name in (training.LOGISTIC, training.FOREST, training.BOOSTED)
    assert 0 < trained.threshold < 1
    cv = {r["model"]: r for r in trained.cv.collect()}
    assert len(cv) == 3 and all(0 <= r["mean_pr_auc"] <= 1 for r in cv.values())
    # Amount decides nearly all labels of the test tables.
    assert trained.ranking.first()["average_precision"] > 0.7
    assert len(trained.importance) == 27
    card = trained.card.first()
    assert card["feature_names"] == list(FEATURES) and len(card["top_features"]) == 10
    assert card["model_name"] == trained.name and set(card["cv_results"]) == set(cv)
    assert training.promotion_gate(trained.card) is True
    assert training.promotion_gate(trained.card, floor=1.01) is False
    assert training.promotion_gate(trained.card, champion=trained.card) is False


def test_fits_read_one_stored_frame(trained, split):
    made = training.training_frame(batch_features(split[0], trained.baseline)).select(*trained.frame.columns)
    assert sorted(map(str, trained.frame.collect())) == sorted(map(str, made.collect()))
    # Neither features nor weights are computed again by those who read it.
    plan = trained.frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") <= 1 and "Relation" in plan


def test_logistic_importance_uses_coefficients(split):
    frame = training.training_frame(batch_features(split[1], Baseline.fit(split[0])))
    model = training.candidates(3000, SMALL, [training.LOGISTIC])[training.LOGISTIC].fit(frame)
    ranked = training.feature_importance(model)
    assert len(ranked) == 27 and all(w >= 0 for _, w in ranked)


def test_save_load_and_score(spark, trained, split, tmp_path):
    store.save_trained(trained, str(tmp_path))
    model, fitted, threshold = store.load_model(spark, str(tmp_path))
    assert threshold == trained.threshold
    text = store.report(trained.card.first())
    assert "| mean_pr_auc |" in text and trained.name in text and "cost_savings_pct" in text
    assert spark.read.text(str(tmp_path / "report")).count() > 10

    test = split[1].withColumn("produced_at", F.lit(None).cast("string"))
    features = batch_features(test, fitted, keep=decisions.CARRIED)
    records = decisions.score_records(
        training.score_column(model, assembler().transform(features)), alert=threshold
    )
    assert records.schema.fieldNames() == SCORE.fieldNames()
    batch = by_id(records, "fraud_score", "decision", "txn_freq_24h")

    pipelines.write_replay_files(test.drop("produced_at"), str(tmp_path / "replay"), files=3)
    stream = pipelines.read_replay(spark, str(tmp_path / "replay"))
    pipelines.write_scores(
        pipelines.scored_stream(stream, model, fitted, alert=threshold), str(tmp_path / "log"),
        str(tmp_path / "cp"), interval=None,
    ).awaitTermination()
    log = score_store.latest_scores(score_store.read_log(spark, str(tmp_path / "log")))
    assert by_id(log, "fraud_score", "decision", "txn_freq_24h") == batch
    assert log.where("latency_ms IS NULL").count() == 0


def test_gradient_vanishes_only_at_the_optimum(split):
    frame = training.training_frame(batch_features(split[1], Baseline.fit(split[0]))).cache()
    n = frame.count()
    best = training.candidates(n, names=[training.LOGISTIC])[training.LOGISTIC].fit(frame)
    early = training.candidates(n, training.Settings(iterations=2), [training.LOGISTIC])[training.LOGISTIC].fit(frame)
    largest = [max(abs(r.gradient) for r in training.penalised_gradient(m, frame).collect()) for m in (best, early)]
    assert largest[0] < 1e-3 < 1e-2 < largest[1]
    frame.unpersist()


def test_run_summary_counts_each_micro_batch_once(spark, tmp_path):
    from txn_risk.streaming.run_summary import METRICS, RunSummary

    class Event:
        def __init__(self, number, n):
            from types import SimpleNamespace

            row = {"processed": n, "flagged": 1, "timed": n, "latency_ms": 2.0 * n, "slowest_ms": 3.0}
            self.progress = SimpleNamespace(
                id="q", batchId=number, observedMetrics={METRICS: row}, durationMs={"triggerExecution": 500})

    class Query:
        id = "q"

    summary = RunSummary()
    for number in [*range(250), 249]:  # the last runs again
        summary.onQueryProgress(Event(number, 4))
    got = summary.totals(Query)
    assert (got.processed, got.flagged, got.avg_latency_ms, got.slowest_ms) == (1000, 250, 2.0, 3.0)
    assert got.rows_per_second == 8.0 and len(summary._open["q"]) == 100


def test_what_if(spark, trained):
    rows = transactions(spark, {"cc_num": 999111222, "amt": 850.0})
    row = training.what_if(trained.model, trained.baseline, rows, trained.threshold).first()
    assert 0 <= row["score"] <= 1 and row["is_fraud_predicted"] in (0, 1)


def test_stream_repeats_are_dropped(spark, tmp_path):
    rows = transactions(spark, {}, {"amt": 2.0})
    pipelines.write_replay_files(rows.unionByName(rows), str(tmp_path / "r"), files=2)
    stream = pipelines.without_repeats(pipelines.read_replay(spark, str(tmp_path / "r")))
    stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
