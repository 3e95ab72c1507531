"""Class-weighted models, cross-validation, threshold tuning, hold-out and the model card."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from txn_risk.functions import ratio
from txn_risk.operators.folds import stratified_folds
from txn_risk.operators.ordering import running_totals
from txn_risk.plans.evaluation import (
    cheapest,
    cost_sweep,
    holdout_comparison,
    promotes,
    ranking_metrics,
)
from txn_risk.plans.features import Baseline, assembler, batch_features
from txn_risk.schemas import (
    COST_FALSE_ALARM,
    COST_MISSED_FRAUD,
    FEATURES,
    PROMOTION_FLOOR,
    TIMESTAMP_TEXT,
)
from txn_risk.session import settle

LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Gradient Boosting"


def time_prefix(rows: DataFrame, n: int | None) -> DataFrame:
    """The earliest ``n`` transactions (all without ``n``); unreadable times come last.

    A file has a first row but a distributed table does not, so the prefix is taken in time order.
    A sort with a limit would send ``n`` rows of every task to one. Instead the second in which
    the n-th row falls is found from counts per second; earlier seconds are kept whole, and only
    that one is cut, by ``trans_num``.
    """
    if n is None:
        return rows
    at = F.unix_timestamp(F.try_to_timestamp("trans_date_trans_time", F.lit(TIMESTAMP_TEXT)))
    timed = rows.withColumn("_second", F.coalesce(at.cast("double"), F.lit(float("inf"))))
    per_second = timed.groupBy("_second").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(per_second, "_second", ["n"])
    last = ranked.where(
        (F.col("before_n") < n) & (F.col("before_n") + F.col("n") >= n)
    ).select("_second", "before_n").first()
    if last is None:
        return rows if n > 0 else rows.limit(0)
    whole = timed.where(F.col("_second") < last["_second"])
    cut = timed.where(F.col("_second") == last["_second"]).orderBy("trans_num").limit(n - last["before_n"])
    return whole.unionByName(cut).drop("_second")


def class_balance_weights(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: counts, negatives per positive, and the balanced weight of either class."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col(label) == 1).alias("n_fraud")
    )
    negatives = F.col("n_total") - F.col("n_fraud")
    return counts.select(
        "n_total", "n_fraud",
        ratio(negatives, F.greatest(F.lit(1), F.col("n_fraud"))).alias("imbalance_ratio"),
        ratio(F.col("n_total"), 2 * F.col("n_fraud")).alias("weight_fraud"),
        ratio(F.col("n_total"), 2 * negatives).alias("weight_legit"),
    )


def with_balanced_weight(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Add ``w_balanced``: in all, both classes of ``rows`` weigh the same."""
    sums = class_balance_weights(rows, label)
    pair = sums.select(F.struct("weight_fraud", "weight_legit")).scalar()
    own = F.when(F.col(label) == 1, F.col("_pair.weight_fraud")).otherwise(
        F.col("_pair.weight_legit")
    )
    return (
        rows.withColumn("_pair", pair)
        .withColumn("w_balanced", F.coalesce(own, F.lit(1.0)))
        .drop("_pair")
    )


def with_positive_weight(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Add ``w_positive``: a fraud weighs the number of negatives per positive, others 1."""
    odds = class_balance_weights(rows, label).select("imbalance_ratio").scalar()
    return rows.withColumn("_odds", odds).withColumn(
        "w_positive", F.when(F.col(label) == 1, F.col("_odds")).otherwise(1.0)
    ).drop("_odds")


@dataclass(frozen=True)
class Settings:
    """Model settings; the defaults are the published ones."""

    iterations: int = 1000
    trees: int = 100
    tree_depth: int = 14
    leaf_rows: int = 5
    rounds: int = 150
    rate: float = 0.05
    boost_depth: int = 7
    seed: int = 42


def candidates(
    rows: int, settings: Settings = Settings(), names: Iterable[str] = (LOGISTIC, FOREST, BOOSTED)
) -> dict[str, Estimator]:
    """The estimators to compare. ``rows`` is the training size.

    An inverse penalty C = 1 on a loss summed over rows is a penalty of 1 / rows on the mean loss
    that MLlib minimises.
    """
    common = {"labelCol": "label", "featuresCol": "features"}
    logistic = Pipeline(stages=[
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        LogisticRegression(
            labelCol="label", featuresCol="scaled", weightCol="w_balanced",
            maxIter=settings.iterations, regParam=1.0 / max(1, rows), elasticNetParam=0.0,
            standardization=False,
        ),
    ])
    forest = RandomForestClassifier(
        **common, weightCol="w_balanced", numTrees=settings.trees, maxDepth=settings.tree_depth,
        minInstancesPerNode=settings.leaf_rows, seed=settings.seed, cacheNodeIds=True,
        checkpointInterval=10,
    )
    boosted = GBTClassifier(
        **common, weightCol="w_positive", maxIter=settings.rounds, stepSize=settings.rate,
        maxDepth=settings.boost_depth, seed=settings.seed, cacheNodeIds=True,
        checkpointInterval=10,
    )
    every = {LOGISTIC: logistic, FOREST: forest, BOOSTED: boosted}
    return {n: every[n] for n in names}


def training_frame(features: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Feature vector, double label and both weights."""
    rows = features.where(F.col(label).isNotNull())
    labelled = assembler().transform(rows).withColumn("label", F.col(label).cast("double"))
    return with_positive_weight(with_balanced_weight(labelled, label), label)


def score_column(model: Model, df: DataFrame, out: str = "score") -> DataFrame:
    """Add the probability of fraud; drops the model's own columns."""
    made = model.transform(df)
    own = [c for c in made.columns if c not in df.columns and c != "probability"]
    return made.withColumn(out, vector_to_array("probability")[1]).drop(*own, "probability")


def cross_validate(
    frame: DataFrame, models: Callable[[int], Mapping[str, Estimator]], unique_id: str = "trans_num",
    folds: int = 5, seed: int = 42,
) -> DataFrame:
    """Per model and fold: average precision, ROC-AUC, least cost and its threshold, seconds.

    ``models`` makes the estimators for a number of training rows, here those of each fold: a penalty
    by the size of the whole set would be too weak on a part of it.

    The loop runs over models and folds, a fixed handful; each turn is a distributed fit. Held-out
    scores are evaluated together, in one pass per metric.
    """
    dealt = settle(
        stratified_folds(
            frame.select(unique_id, "label", "is_fraud", "features", "w_positive"), unique_id,
            "label", folds, seed,
        ),
        "folds",
    )
    sizes = {r["fold"]: r["n"] for r in dealt.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    scored, taken = [], {}
    for fold in range(folds):
        train = with_balanced_weight(dealt.where(F.col("fold") != fold))
        held = dealt.where(F.col("fold") == fold)
        for name, estimator in models(sum(sizes.values()) - sizes.get(fold, 0)).items():
            began = time.monotonic()
            scored.append(
                score_column(estimator.fit(train), held).select(
                    F.lit(name).alias("model"), "fold", "score", "label"
                )
            )
            taken[name] = taken.get(name, 0.0) + time.monotonic() - began
    seconds = list(taken.items())
    spark = frame.sparkSession
    held_out = settle(reduce(DataFrame.unionByName, scored), "held-out")
    by = ["model", "fold"]
    best = cheapest(cost_sweep(held_out, by=by), by).select(*by, "threshold", "total_cost")
    timed = spark.createDataFrame(seconds, "model string, training_time_sec double")
    return ranking_metrics(held_out, by=by).join(best, by).join(timed, "model")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation over folds, per model."""
    return per_fold.groupBy("model").agg(
        F.avg("average_precision").alias("mean_pr_auc"),
        F.stddev_pop("average_precision").alias("std_pr_auc"),
        F.avg("roc_auc").alias("mean_roc_auc"),
        F.avg("total_cost").alias("mean_cost_per_fold"),
        F.avg("threshold").alias("avg_optimal_threshold"),
        F.max("training_time_sec").alias("training_time_sec"),
    )


def select_model(summary: DataFrame) -> str:
    """The model of highest mean average precision; the first name wins a tie."""
    best = summary.orderBy(F.col("mean_pr_auc").desc(), "model").first()
    if best is None:
        raise ValueError("no cross-validation results to select from")
    return best["model"]


def feature_importance(model: Model) -> list[tuple[str, float]]:
    """Features by falling split importance or absolute coefficient (27 numbers)."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    else:
        weights = abs(last.coefficients.toArray())
    pairs = ((n, float(w)) for n, w in zip(FEATURES, weights, strict=True))
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def penalised_gradient(model: PipelineModel, frame: DataFrame, weight: str = "w_balanced") -> DataFrame:
    """``(feature, gradient)`` of the logistic model's own objective at its weights, the intercept included.

    The objective is the weighted mean loss plus half the penalty times the squared coefficients of the scaled
    features. It is convex: a gradient of 0 says that no other weights are better, whoever found them. One
    pass over the training rows.
    """
    fitted = model.stages[-1]
    rows = model.transform(frame).select(
        vector_to_array("scaled").alias("x"),
        (F.col(weight) * (vector_to_array("probability")[1] - F.col("label"))).alias("r"), F.col(weight).alias("w"),
    )
    sums = rows.agg(
        F.sum("w").alias("w"), F.sum("r").alias("r"),
        *[F.sum(F.col("r") * F.col("x")[i]).alias(f"g{i}") for i in range(len(FEATURES))],
    )
    penalty = fitted.getRegParam()
    cells = [F.struct(F.lit("intercept").alias("feature"), (F.col("r") / F.col("w")).alias("gradient"))]
    cells += [
        F.struct(F.lit(n).alias("feature"), (F.col(f"g{i}") / F.col("w") + F.lit(penalty * float(b))).alias("gradient"))
        for i, (n, b) in enumerate(zip(FEATURES, fitted.coefficients.toArray(), strict=True))
    ]
    return sums.select(F.inline(F.array(*cells)))


# The names and nesting of the model card.
CARD = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("trained_at", T.StringType()),
    T.StructField("optimal_threshold", T.DoubleType()),
    T.StructField("cost_parameters", T.StructType([
        T.StructField("cost_false_negative", T.DoubleType()),
        T.StructField("cost_false_positive", T.DoubleType()),
    ])),
    T.StructField("cv_results", T.MapType(T.StringType(), T.StructType([
        T.StructField(n, T.DoubleType()) for n in (
            "mean_pr_auc", "std_pr_auc", "mean_roc_auc", "mean_cost_per_fold",
            "avg_optimal_threshold", "training_time_sec",
        )
    ]))),
    T.StructField("holdout_test_metrics", T.StructType([
        T.StructField(n, T.DoubleType()) for n in (
            "pr_auc", "roc_auc", "optimal_threshold", "recall_opt", "precision_opt", "f1_opt",
            "cost_default", "cost_opt", "cost_savings", "cost_savings_pct",
        )
    ])),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("top_features", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class Trained:
    """Everything a training run leaves behind."""

    name: str
    model: Model
    baseline: Baseline
    threshold: float
    per_fold: DataFrame
    cv: DataFrame
    holdout: DataFrame
    ranking: DataFrame
    importance: list[tuple[str, float]]
    card: DataFrame
    frame: DataFrame


def train(
    train_rows: DataFrame, test_rows: DataFrame, sample: int | None = None,
    settings: Settings = Settings(), names: Iterable[str] = (LOGISTIC, FOREST, BOOSTED),
    folds: int = 5, tie_policy: str = "strict",
) -> Trained:
    """Compare models on ``train_rows``, refit the best, tune its threshold on its training scores
    and judge it on the later ``test_rows``.

    Both feature matrices are settled: each is read many times, by iterative fits. The training rows are settled as
    the fits read them, with vectors and weights, and are part of the result.
    """
    spark = train_rows.sparkSession
    chosen = time_prefix(train_rows, sample)
    baseline = Baseline.fit(chosen)
    kept = Baseline(settle(baseline.cards, "cards"), settle(baseline.overall, "overall"))
    train_features = settle(batch_features(chosen, kept, tie_policy), "train")
    test_features = settle(batch_features(test_rows, kept, tie_policy), "test")
    frame = settle(
        training_frame(train_features).select(
            "trans_num", "is_fraud", "label", "features", "w_balanced", "w_positive"
        ), "frame",
    )

    def models(rows: int) -> dict[str, Estimator]:
        return candidates(rows, settings, names)

    per_fold = settle(cross_validate(frame, models, folds=folds), "per-fold")
    cv = settle(cv_summary(per_fold), "cv")
    name = select_model(cv)
    model = models(frame.count())[name].fit(frame)

    train_scored = settle(score_column(model, frame).select("score", "label"), "train-scores")
    threshold = cheapest(cost_sweep(train_scored)).first()["threshold"]

    held = assembler().transform(test_features).withColumn(
        "label", F.col("is_fraud").cast("double")
    )
    test_scored = settle(score_column(model, held).select("score", "label"), "test-scores")
    ranking = ranking_metrics(test_scored)
    holdout = holdout_comparison(test_scored, threshold)
    importance = feature_importance(model)
    card = model_card(spark, name, threshold, cv, holdout, ranking, importance)
    return Trained(name, model, kept, threshold, per_fold, cv, holdout, ranking, importance, card, frame)


def model_card(
    spark: SparkSession, name: str, threshold: float, cv: DataFrame, holdout: DataFrame,
    ranking: DataFrame, importance: Sequence[tuple[str, float]],
) -> DataFrame:
    """One nested row. Its parts are a row per model and two hold-out rows."""
    def rounded(value: float | None, digits: int) -> float | None:
        return None if value is None else round(float(value), digits)

    rows = {r["threshold"]: r for r in holdout.collect()}
    default, tuned = rows[0.5], rows[threshold]
    areas = ranking.first()
    metrics = (
        rounded(areas["average_precision"], 4), rounded(areas["roc_auc"], 4),
        rounded(threshold, 4), rounded(tuned["recall"], 4), rounded(tuned["precision"], 4),
        rounded(tuned["f1"], 4), rounded(default["total_cost"], 2),
        rounded(tuned["total_cost"], 2), rounded(tuned["cost_savings"], 2),
        rounded(tuned["cost_savings_pct"], 2),
    )
    results = {
        r["model"]: tuple(r[f] for f in CARD["cv_results"].dataType.valueType.fieldNames())
        for r in cv.collect()
    }
    trained_at = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime())
    return spark.createDataFrame(
        [(
            name, trained_at, float(threshold), (COST_MISSED_FRAUD, COST_FALSE_ALARM), results,
            metrics, list(FEATURES), [n for n, _ in importance[:10]],
        )],
        CARD,
    )


def promotion_gate(
    card: DataFrame, floor: float = PROMOTION_FLOOR, champion: DataFrame | None = None
) -> bool:
    """Whether the card's hold-out average precision clears the floor and any champion's."""
    new = card.select("holdout_test_metrics.pr_auc").first()
    if new is None:
        return False
    old = champion.select("holdout_test_metrics.pr_auc").first() if champion is not None else None
    return promotes(new["pr_auc"] or 0.0, floor, old["pr_auc"] if old else None)


def what_if(
    model: Model, baseline: Baseline, hypothetical: DataFrame, threshold: float
) -> DataFrame:
    """Score made-up transactions with the production model; nothing is written."""
    features = batch_features(hypothetical, baseline, keep=("trans_num",))
    scored = score_column(model, assembler().transform(features)).drop("features")
    return scored.withColumn("is_fraud_predicted", (F.col("score") >= threshold).cast("int"))
