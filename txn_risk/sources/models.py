"""Saved models, baselines and model cards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.sql import DataFrame, Row, SparkSession

from txn_risk.plans.features import Baseline
from txn_risk.plans.training import CARD, Trained
from txn_risk.schemas import ALERT_THRESHOLD


def save_trained(trained: Trained, path: str) -> None:
    """Model, baseline, card, and the report as text."""
    wrapped = trained.model
    if not isinstance(wrapped, PipelineModel):
        wrapped = PipelineModel(stages=[wrapped])
    wrapped.write().overwrite().save(f"{path}/model")
    trained.baseline.save(f"{path}/baseline")
    trained.card.write.mode("overwrite").json(f"{path}/card")
    spark = trained.card.sparkSession
    lines = spark.createDataFrame([(report(trained.card.first()),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{path}/report")


def load_model(spark: SparkSession, path: str) -> tuple[Model, Baseline, float]:
    """Model, baseline and alert threshold (the default one if the card has none)."""
    card = read_card(spark, path).select("optimal_threshold").first()
    threshold = card["optimal_threshold"] if card else None
    return (
        PipelineModel.load(f"{path}/model"), Baseline.load(spark, f"{path}/baseline"),
        ALERT_THRESHOLD if threshold is None else threshold,
    )


def read_card(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CARD).json(f"{path}/card")


def _table(rows: Sequence[Sequence[object]]) -> list[str]:
    """Markdown of a table whose first row is its header."""
    def line(cells: Iterable[object]) -> str:
        return "| " + " | ".join("–" if c is None else f"{c:g}" if isinstance(c, float) else str(c) for c in cells) + " |"

    return [line(rows[0]), line(["---"] * len(rows[0])), *map(line, rows[1:]), ""]


def report(card: Row) -> str:
    """The model card as text: every field of it, by the card's own names."""
    plain = [(k, v) for k, v in card.asDict().items() if not isinstance(v, (dict, list, Row))]
    out = [f"# {card['model_name']}", "", *_table([("field", "value"), *plain])]
    for name, value in card.asDict().items():
        if isinstance(value, Row):
            out += [f"## {name}", "", *_table([("field", "value"), *value.asDict().items()])]
        elif isinstance(value, dict):
            models = sorted(value)
            fields = value[models[0]].asDict() if models else {}
            rows = [(f, *(value[m][f] for m in models)) for f in fields]
            out += [f"## {name}", "", *_table([("field", *models), *rows])]
        elif isinstance(value, list):
            out += [f"## {name}", "", ", ".join(value), ""]
    return "\n".join(out)
