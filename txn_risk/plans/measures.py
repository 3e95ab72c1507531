"""The 20 report measures over the fact, evaluated per group in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from txn_risk.functions import cents, ratio
from txn_risk.schemas import COST_MISSED_FRAUD, PUBLISHED_RECALL


def _fraud() -> Column:
    return F.col("is_fraud") == 1


def _legit() -> Column:
    return F.col("is_fraud") == 0



def _components() -> dict[str, Column]:
    """Additive parts of all measures: counts, and sums of money or distance in hundredths.

    A sum over groups of a component is the component of their union, so rows can be reduced to
    components before a join and added up after it.
    """
    classes = {"all": F.lit(True), "fraud": _fraud(), "legit": _legit()}
    night, weekend = F.col("is_night") == 1, F.col("is_weekend") == 1
    out = {f"n_{name}": F.count_if(rows) for name, rows in classes.items()}
    out |= {
        "n_night": F.count_if(night), "n_night_fraud": F.count_if(night & _fraud()),
        "n_weekend": F.count_if(weekend), "n_weekend_fraud": F.count_if(weekend & _fraud()),
    }
    for value in ("amount", "geo_distance_km", "txn_freq_24h"):
        for name, rows in classes.items():
            kept = F.when(rows, F.col(value))
            out[f"sum_{value}_{name}"] = F.sum(cents(kept))
            out[f"count_{value}_{name}"] = F.count(kept)
    return out


def _mean(value: str, rows: str) -> Column:
    return ratio(F.col(f"sum_{value}_{rows}") / 100.0, F.col(f"count_{value}_{rows}"))


def _total(rows: str) -> Column:
    return F.col(f"sum_amount_{rows}") / 100.0


def _measure(name: str, recall: float, missed_cost: float) -> Column:
    """A measure over columns of components."""
    return {
        "total_transactions": lambda: F.col("n_all"),
        "total_amount": lambda: _total("all"),
        "avg_amount": lambda: _mean("amount", "all"),
        "avg_distance_km": lambda: _mean("geo_distance_km", "all"),
        "unique_customers": lambda: F.col("unique_customers"),
        "unique_merchants": lambda: F.col("unique_merchants"),
        "fraud_transactions": lambda: F.col("n_fraud"),
        "legit_transactions": lambda: F.col("n_legit"),
        "fraud_rate": lambda: ratio(F.col("n_fraud"), F.col("n_all"), 0),
        "fraud_amount": lambda: _total("fraud"),
        "avg_fraud_amount": lambda: _mean("amount", "fraud"),
        "avg_legit_amount": lambda: _mean("amount", "legit"),
        "fraud_loss_rate": lambda: ratio(_total("fraud"), _total("all"), 0),
        "fraud_to_normal_ratio": lambda: ratio(
            _mean("amount", "fraud"), _mean("amount", "legit"), 1
        ),
        "avg_fraud_distance_km": lambda: _mean("geo_distance_km", "fraud"),
        "avg_legit_distance_km": lambda: _mean("geo_distance_km", "legit"),
        "night_fraud_rate": lambda: ratio(F.col("n_night_fraud"), F.col("n_night"), 0),
        "weekend_fraud_rate": lambda: ratio(F.col("n_weekend_fraud"), F.col("n_weekend"), 0),
        "avg_fraud_txn_freq_24h": lambda: _mean("txn_freq_24h", "fraud"),
        "baseline_risk_cost": lambda: F.col("n_fraud") * missed_cost,
        "fraud_prevented_amount": lambda: _total("fraud") * recall,
    }[name]()


_DISTINCT = {"unique_customers": "customer_id", "unique_merchants": "merchant_id"}

# The measures, in the order they are reported.
MEASURES = (
    "total_transactions", "total_amount", "avg_amount", "avg_distance_km", "unique_customers",
    "unique_merchants", "fraud_transactions", "legit_transactions", "fraud_rate", "fraud_amount",
    "avg_fraud_amount", "fraud_loss_rate", "fraud_to_normal_ratio", "avg_fraud_distance_km",
    "avg_legit_distance_km", "night_fraud_rate", "weekend_fraud_rate", "avg_fraud_txn_freq_24h",
    "baseline_risk_cost", "fraud_prevented_amount",
)


def _with_counts(
    sums: DataFrame, ids: DataFrame, by: Sequence[str], only: Sequence[str]
) -> DataFrame:
    """Add the distinct counts that ``only`` asks for, counted over ``ids``, to grouped ``sums``.

    They run on their own over the ids alone. In one aggregate with the rest, every row would be
    repeated per distinct column with all its measures.
    """
    counts = [F.countDistinct(c).alias(n) for n, c in _DISTINCT.items() if n in only]
    if not counts:
        return sums
    counted = ids.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(*counts)
    if not by:
        return sums.withColumn("_ids", counted.select(F.struct("*")).scalar()).select(
            "*", "_ids.*"
        )
    return sums.join(counted, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]))


def measures(
    fact: DataFrame, by: Sequence[str] = (), only: Sequence[str] = MEASURES,
    where: Column | None = None, recall: float = PUBLISHED_RECALL,
    missed_cost: float = COST_MISSED_FRAUD,
) -> DataFrame:
    """``only`` the named measures per ``by`` group (all rows are one group without it).

    ``where`` is the report's slicer. Aggregates combine map-side, and components that no chosen
    measure uses are pruned.
    """
    rows = fact if where is None else fact.where(where)
    sums = rows.groupBy(*by).agg(*[c.alias(n) for n, c in _components().items()])
    return _with_counts(sums, rows, by, only).select(
        *by, *[_measure(n, recall, missed_cost).alias(n) for n in only]
    )


def measures_by_dimension(
    fact: DataFrame, dim: DataFrame, key: str, dim_by: Sequence[str], fact_by: Sequence[str] = (),
    only: Sequence[str] = MEASURES, where: Column | None = None, dim_where: Column | None = None,
    recall: float = PUBLISHED_RECALL, missed_cost: float = COST_MISSED_FRAUD,
) -> DataFrame:
    """Measures grouped or sliced by attributes of a dimension, the dimension filtering the fact.

    The fact is reduced to components per key before it meets the dimension, and for distinct
    counts to its distinct ids. The join then moves one row per key (or id pair), however many
    transactions a key has.
    """
    rows = fact if where is None else fact.where(where)
    people = (dim if dim_where is None else dim.where(dim_where)).select(key, *dim_by)
    by = [*dim_by, *fact_by]
    parts = _components()
    cells = rows.groupBy(key, *fact_by).agg(*[c.alias(n) for n, c in parts.items()])
    sums = cells.join(people, key).groupBy(*by).agg(*[F.sum(n).alias(n) for n in parts])
    wanted = {key, *(c for n, c in _DISTINCT.items() if n in only)}
    ids = rows.select(*sorted(wanted), *fact_by).distinct().join(people, key)
    return _with_counts(sums, ids, by, only).select(
        *by, *[_measure(n, recall, missed_cost).alias(n) for n in only]
    )
