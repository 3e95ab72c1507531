"""Metrics on hand-computed cases, and their independence of partitioning."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from txn_risk.operators.folds import stratified_folds
from txn_risk.operators.ordering import distribution, quantiles
from txn_risk.plans import evaluation as ev, profiling

SCHEMA = "score double, label bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_ap(rows):
    total = sum(y for _, y in rows)
    if not total:
        return 0.0
    out = 0.0
    for s in sorted({s for s, _ in rows}, reverse=True):
        above = [y for t, y in rows if t >= s]
        out += sum(y for t, y in rows if t == s) / total * sum(above) / len(above)
    return out


def brute_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


def metrics(spark, rows):
    r = ev.ranking_metrics(frame(spark, rows)).first()
    return r["average_precision"], r["roc_auc"]


def test_known_case(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)]
    ap, auc = metrics(spark, rows)
    assert ap == pytest.approx(0.8333333, abs=1e-6) and auc == 0.75


@pytest.mark.parametrize(
    "rows",
    [
        [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 1)],  # all tied
        [(0.2, 1), (0.9, 1)],  # all positive
        [(0.2, 0), (0.9, 0)],  # all negative
    ],
)
def test_degenerate_labels_and_ties(spark, rows):
    ap, auc = metrics(spark, rows)
    assert ap == pytest.approx(brute_ap(rows)) and auc == brute_auc(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 20).map(lambda k: k / 20), st.integers(0, 1)),
                min_size=1, max_size=60))
def test_random_scores(spark, rows):
    ap, auc = metrics(spark, rows)
    assert ap == pytest.approx(brute_ap(rows))
    assert auc == (None if brute_auc(rows) is None else pytest.approx(brute_auc(rows)))


def test_many_distinct_scores_over_many_pieces(spark):
    rng = random.Random(3)
    rows = [(rng.random() ** 4, int(rng.random() < 0.1)) for _ in range(2000)]
    ap, auc = metrics(spark, rows)
    assert ap == pytest.approx(brute_ap(rows)) and auc == pytest.approx(brute_auc(rows))


def test_metrics_do_not_depend_on_partitions(spark):
    rng = random.Random(5)
    df = frame(spark, [(round(rng.random(), 2), int(rng.random() < 0.2)) for _ in range(500)])
    seen = {
        (tuple(ev.ranking_metrics(df.repartition(n)).first()),
         tuple(ev.cheapest(ev.cost_sweep(df.repartition(n))).first()))
        for n in (1, 5)
    }
    assert len({tuple(round(v, 9) for part in s for v in part) for s in seen}) == 1


def test_per_group_metrics(spark):
    rows = [("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.1, 1), ("b", 0.9, 0)]
    df = spark.createDataFrame(rows, "model string, score double, label bigint")
    got = {r["model"]: r["roc_auc"] for r in ev.ranking_metrics(df, by=["model"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_confusion_at_the_boundary(spark):
    rows = [(0.5, 1), (0.5, 0), (0.49, 1), (0.7, 1)]
    r = ev.confusion(frame(spark, rows), [0.5]).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 0)
    assert r["total_cost"] == 515.0
    assert r["precision"] == pytest.approx(2 / 3) and r["f1"] == pytest.approx(2 / 3)


def test_confusion_without_predictions(spark):
    r = ev.confusion(frame(spark, [(0.1, 0)]), [0.5]).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    empty = ev.confusion(frame(spark, []), [0.5]).collect()
    assert [tuple(e)[1:5] for e in empty] == [(0, 0, 0, 0)]


def test_sweep_has_99_thresholds_and_lowest_wins_ties(spark):
    df = frame(spark, [(0.005, 0), (0.995, 1)])
    sweep = ev.cost_sweep(df)
    assert sweep.count() == 99
    best = ev.cheapest(sweep).first()
    assert best["threshold"] == 0.01 and best["total_cost"] == 0.0
    details = ev.cost_details(ev.cheapest(sweep)).first()
    assert details["cost_fn_total"] == 0.0 and details["true_positives"] == 1


def test_curve_ends_at_full_recall(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1)]
    curve = {r["threshold"]: r for r in ev.precision_recall_curve(frame(spark, rows)).collect()}
    assert curve[0.7]["recall"] == 1.0 and curve[0.9]["precision"] == 1.0
    assert curve[0.9]["no_skill"] == pytest.approx(2 / 3)
    assert ev.recall_at_precision(frame(spark, rows), 0.8).first()["recall"] == 0.5


def test_holdout_saving(spark):
    rows = [(0.6, 0), (0.9, 1), (0.2, 0)]
    got = {r["threshold"]: r for r in ev.holdout_comparison(frame(spark, rows), 0.7).collect()}
    assert got[0.7]["cost_savings"] == 15.0 and got[0.7]["cost_savings_pct"] == 100.0
    assert got[0.5]["cost_savings"] == 0.0


def test_promotion():
    assert ev.promotes(0.70, 0.70) and not ev.promotes(0.69, 0.70)
    assert not ev.promotes(0.80, 0.70, champion=0.85)


def test_folds_are_balanced(spark):
    df = spark.range(1003).select(
        F.col("id").cast("string").alias("trans_num"), (F.col("id") % 17 == 0).cast("int").alias("y")
    )
    dealt = stratified_folds(df, "trans_num", "y", 5)
    sizes = dealt.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    again = {tuple(r) for r in stratified_folds(df.repartition(3), "trans_num", "y", 5).collect()}
    assert again == {tuple(r) for r in dealt.collect()}


@pytest.mark.parametrize("rows", [3000, 30_000])
def test_ranges_of_folds_keep_their_size(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 20 == 0).cast("int").alias("y"))
    dealt = stratified_folds(df, "id", "y", 5, range_rows=100)
    sizes = {(r["y"], r["fold"]): r["count"] for r in dealt.groupBy("y", "fold").count().collect()}
    for y, n in ((0, rows * 19 // 20), (1, rows // 20)):
        assert {sizes[y, f] for f in range(5)} <= {n // 5, n // 5 + 1} and sum(sizes[y, f] for f in range(5)) == n
    # One numbering whatever the ranges.
    by_other = stratified_folds(df, "id", "y", 5, range_rows=10_000)
    assert dealt.join(by_other.withColumnRenamed("fold", "other"), ["id", "y"]).where("fold <> other").isEmpty()


def test_ranges_follow_the_rows(spark):
    from pyspark.sql import Window

    largest = []
    for rows in (2000, 20_000):
        df = spark.range(rows).select("id", F.lit(0).alias("y"))
        plan = stratified_folds(df, "id", "y", range_rows=100)._jdf.queryExecution().optimizedPlan().toString()
        assert "substring(_digest" in plan
        digits = max(1, math.ceil(math.log(rows / 100, 16)))
        dealt = df.withColumn("d", F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit("42"))), 1, digits))
        largest.append(dealt.withColumn("n", F.count("*").over(Window.partitionBy("d"))).agg(F.max("n")).first()[0])
    assert max(largest) <= 200


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 8.0)], "v double")
    got = {r["quantile"]: r["value"] for r in quantiles(df, "v", [0.0, 0.5, 0.95, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.5: 3.0, 0.95: pytest.approx(7.4), 1.0: 8.0}


def test_quantiles_of_one_frequent_value(spark):
    df = spark.createDataFrame([(5.0,)] * 50 + [(float(i),) for i in range(10)], "v double")
    assert quantiles(df, "v", [0.5]).first()["value"] == 5.0


def test_infinite_scores_are_ends_of_the_order(spark):
    inf = float("inf")
    rows = [(inf, 1), (inf, 0), (0.5, 1), (0.25, 0), (-inf, 0)] * 3
    got = ev.ranking_metrics(spark.createDataFrame(rows, "score double, label int")).first()
    finite = {inf: 9.0, -inf: -9.0}
    same = ev.ranking_metrics(spark.createDataFrame(
        [(finite.get(s, s), y) for s, y in rows], "score double, label int")).first()
    assert got["roc_auc"] == same["roc_auc"] and got["average_precision"] == same["average_precision"]


def _nodes(df):
    """Lines of the plan that ran, without what is only an earlier version of it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].splitlines()


@pytest.fixture
def stored_scores(spark, tmp_path):
    rng = random.Random(4)
    rows = [(round(rng.random() ** 3, 4), int(rng.random() < 0.1), round(rng.gauss(50, 20), 2)) for _ in range(3000)]
    path = str(tmp_path / "scores")
    spark.createDataFrame(rows, "score double, label int, amt double").withColumn(
        "is_fraud", F.col("label").cast("bigint")).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("query", [
    lambda df: ev.ranking_metrics(df), lambda df: ev.precision_recall_curve(df),
    lambda df: profiling.amount_summary(df), lambda df: profiling.amount_box(df),
    lambda df: distribution(df, "amt", {"m": 0.5}, ["is_fraud"], deviation=True),
])
def test_one_scan_and_no_job_before_the_query_runs(spark, stored_scores, query):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    planned = query(stored_scores)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setJobGroup("running", "running")
    planned.collect()
    assert sum("FileScan parquet" in line for line in _nodes(planned)) == 1


def test_distribution_equals_plain_aggregates(spark, stored_scores):
    points = {"q1": 0.25, "m": 0.5, "q9": 0.9}
    got = distribution(stored_scores, "amt", points, ["is_fraud"], deviation=True).orderBy("is_fraud").collect()
    want = stored_scores.groupBy("is_fraud").agg(
        F.count("amt"), F.avg("amt"), F.min("amt"), F.max("amt"), F.percentile("amt", 0.25), F.percentile("amt", 0.5),
        F.percentile("amt", 0.9), F.stddev_samp("amt"),
    ).orderBy("is_fraud").collect()
    for a, b in zip(got, want, strict=True):
        assert tuple(a) == pytest.approx(tuple(b))


def test_pieces_of_the_order(spark):
    """Every piece number is used once values are many, and they rise with the value."""
    from txn_risk.operators import ordering

    rows = [(float(i),) for i in range(5000)] + [(float("inf"),), (float("-inf"),), (float("nan"),)]
    counted = ordering.counted_values(spark.createDataFrame(rows, "v double"), "v")
    pieces = ordering._with_pieces(counted, "_value", ["n"], []).orderBy("_value").collect()
    numbers = [r["_piece"] for r in pieces]
    assert numbers == sorted(numbers) and len(set(numbers)) > 900 and pieces[0]["all_n"] == 5003
    totals = ordering.running_totals(counted, "_value", ["n"]).orderBy("_value").collect()
    assert [r["before_n"] for r in totals] == list(range(5003))


def test_cuts_follow_from_the_values_alone(spark):
    """However the rows lie, the pieces are the same: two uses may read a shuffle in different orders."""
    from txn_risk.operators import ordering

    rows = spark.range(60_000).select(((F.col("id") * 7919) % 1_000_003 / 100).alias("_value"), F.lit(1).alias("n"))

    def pieces(counted):
        out = ordering._with_pieces(counted, "_value", ["n"], []).groupBy("_piece").agg(F.count("*"), F.max("_value"))
        return sorted(map(tuple, out.collect()))

    got = pieces(rows.repartition(7))
    assert got == pieces(rows.repartition(3).sortWithinPartitions(F.desc("_value")))
    assert len(got) > ordering.PIECES // 2 and max(n for _, n, _ in got) < 60_000 / ordering.PIECES * 20
