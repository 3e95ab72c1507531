"""Classifier metrics: confusion counts, cost sweep, precision-recall and ranking areas.

Input is any frame with a score and a 0/1 label column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from txn_risk.functions import ratio
from txn_risk.operators.ordering import running_totals
from txn_risk.schemas import COST_FALSE_ALARM, COST_MISSED_FRAUD

# 99 evenly spaced thresholds. They differ from k / 100 in the last bit for some k.
THRESHOLDS = tuple(float(t) for t in np.linspace(0.01, 0.99, 99))


def _precision_recall(df: DataFrame) -> DataFrame:
    """Add precision, recall and F1 from tp, fp, fn; 0 where the divisor is 0."""
    return (
        df.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0))
        .withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn"), 0))
        .withColumn("f1", ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"), 0))
    )


def business_cost(
    missed: float = COST_MISSED_FRAUD, alarm: float = COST_FALSE_ALARM
) -> Column:
    return (F.col("fn") * missed + F.col("fp") * alarm).cast("double")


def confusion(
    scored: DataFrame, thresholds: Sequence[float], score: str = "score", label: str = "label",
    by: Sequence[str] = (), missed: float = COST_MISSED_FRAUD, alarm: float = COST_FALSE_ALARM,
) -> DataFrame:
    """Counts, precision, recall, F1 and cost at each threshold, ``score >= t`` being positive.

    One pass whatever the number of thresholds: rows are counted by the range their score falls
    in, and the few range counts are accumulated from the top.
    """
    grid = sorted(set(float(t) for t in thresholds))
    edges = [float("-inf"), *grid, float("inf")]
    cut = Bucketizer(splits=edges, inputCol="_score", outputCol="_range", handleInvalid="error")
    ranged = cut.transform(
        scored.where(F.col(score).isNotNull()).select(
            *by, F.col(score).cast("double").alias("_score"), F.col(label).alias("_label")
        )
    )
    counted = ranged.groupBy(*by, F.col("_range").cast("int").alias("_range")).agg(
        F.count_if(F.col("_label") == 1).alias("_p"), F.count_if(F.col("_label") == 0).alias("_n")
    )
    # From here on at most len(grid) + 1 counts per group. Range i starts at threshold i - 1; ranges
    # nobody fell in count 0, so every threshold is reported.
    packed = counted.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_range", F.struct("_p", "_n")))).alias("_cells")
    )
    cell = F.try_element_at("_cells", F.col("_range"))
    full = packed.withColumn("_range", F.explode(F.sequence(F.lit(0), F.lit(len(grid))))).select(
        *by, "_range", F.coalesce(cell["_p"], F.lit(0)).alias("_p"),
        F.coalesce(cell["_n"], F.lit(0)).alias("_n"),
    )
    group = Window.partitionBy(*by, F.lit(0))
    above = group.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, 0)
    values = F.array(*[F.lit(t) for t in grid])
    table = (
        full.withColumn("tp", F.sum("_p").over(above))
        .withColumn("fp", F.sum("_n").over(above))
        .withColumn("fn", F.sum("_p").over(group) - F.col("tp"))
        .withColumn("tn", F.sum("_n").over(group) - F.col("fp"))
        .where(F.col("_range") > 0)
        .withColumn("threshold", F.element_at(values, F.col("_range")))
    )
    return (
        _precision_recall(table)
        .withColumn("total_cost", business_cost(missed, alarm))
        .select(
            *by, "threshold", "tn", "fp", "fn", "tp", "precision", "recall", "f1", "total_cost"
        )
    )


def cost_sweep(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = (),
    missed: float = COST_MISSED_FRAUD, alarm: float = COST_FALSE_ALARM,
) -> DataFrame:
    """The cost curve over the 99 thresholds."""
    return confusion(scored, THRESHOLDS, score, label, by, missed, alarm)


def cheapest(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The row of least cost per group; the lowest threshold wins a tie."""
    order = F.struct("total_cost", "threshold")
    names = [c for c in sweep.columns if c not in by]
    best = sweep.groupBy(*by).agg(F.min_by(F.struct(*names), order).alias("best"))
    return best.select(*by, "best.*")


def cost_details(
    best: DataFrame, missed: float = COST_MISSED_FRAUD, alarm: float = COST_FALSE_ALARM
) -> DataFrame:
    """The reported form of a sweep row: rounded figures and the two cost parts."""
    return best.select(
        F.round("threshold", 4).alias("threshold"),
        F.round("total_cost", 2).alias("total_cost"),
        F.col("fn").alias("false_negatives"), F.col("fp").alias("false_positives"),
        F.col("tp").alias("true_positives"), F.col("tn").alias("true_negatives"),
        F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
        F.round("f1", 4).alias("f1_score"),
        F.round(F.col("fn") * missed, 2).alias("cost_fn_total"),
        F.round(F.col("fp") * alarm, 2).alias("cost_fp_total"),
    )


def ranked_scores(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct score with positives and negatives at it, above it and in all."""
    rows = scored.where(F.col(score).isNotNull()).select(
        *by, F.col(score).cast("double").alias("_score"), F.col(label).alias("_label")
    )
    tied = rows.groupBy(*by, F.col("_score").alias("score")).agg(
        F.count_if(F.col("_label") == 1).alias("p"), F.count_if(F.col("_label") == 0).alias("n")
    )
    return running_totals(tied, "score", ["p", "n"], by, descending=True)


def precision_recall_curve(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall at each distinct score, and the no-skill precision."""
    tp = F.col("before_p") + F.col("p")
    fp = F.col("before_n") + F.col("n")
    return ranked_scores(scored, score, label, by).select(
        *by, F.col("score").alias("threshold"),
        ratio(tp, tp + fp, 0).alias("precision"),
        ratio(tp, F.col("all_p"), 0).alias("recall"),
        ratio(F.col("all_p"), F.col("all_p") + F.col("all_n"), 0).alias("no_skill"),
    )


def ranking_metrics(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """``average_precision`` (step-wise) and ``roc_auc`` per group, exact with tied scores.

    Average precision is 0 without positives; ROC-AUC is null unless both classes occur.
    """
    tp = F.col("before_p") + F.col("p")
    step = F.col("p") * ratio(tp, tp + F.col("before_n") + F.col("n"), 0)
    pairs = F.col("n") * (F.col("before_p") + F.col("p") / 2)
    sums = ranked_scores(scored, score, label, by).groupBy(*by).agg(
        F.sum(step).alias("_steps"), F.sum(pairs).alias("_pairs"),
        F.max("all_p").alias("_p"), F.max("all_n").alias("_n"),
    )
    return sums.select(
        *by,
        ratio(F.col("_steps"), F.col("_p"), 0).alias("average_precision"),
        ratio(F.col("_pairs"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"),
    )


def recall_at_precision(
    scored: DataFrame, floor: float = 0.80, score: str = "score", label: str = "label",
    by: Sequence[str] = (),
) -> DataFrame:
    """The greatest recall among thresholds whose precision reaches ``floor``; 0 if none does."""
    curve = precision_recall_curve(scored, score, label, by)
    reached = F.max(F.when(F.col("precision") >= floor, F.col("recall")))
    return curve.groupBy(*by).agg(F.coalesce(reached, F.lit(0.0)).alias("recall"))


def holdout_comparison(
    scored: DataFrame, tuned: float, score: str = "score", label: str = "label",
    default: float = 0.5,
) -> DataFrame:
    """Default against tuned threshold, one row each, with the saving over the default."""
    both = confusion(scored, [default, tuned], score, label)
    base = F.max(F.when(F.col("threshold") == default, F.col("total_cost"))).over(
        Window.partitionBy(F.lit(0))
    )
    saved = base - F.col("total_cost")
    return both.withColumn("cost_savings", saved).withColumn(
        "cost_savings_pct", ratio(saved * 100, base, 0)
    )


def promotes(
    average_precision: float, floor: float, champion: float | None = None
) -> bool:
    """Whether a retrained model may go live: above the floor and, if given, the champion."""
    return average_precision >= floor and (champion is None or average_precision > champion)
