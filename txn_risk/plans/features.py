"""The 27 model features, from the same columns in batch and in a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txn_risk.functions import (
    age_at,
    category_flags,
    day_of_week_monday0,
    gender_code,
    haversine_km,
    is_night,
    is_weekend,
    log1p_floor0,
    parse_date,
    parse_timestamp_lenient,
)
from txn_risk.operators.baseline import as_profile, fit_baseline, fit_global, zscore_from_profile
from txn_risk.operators.trailing import with_trailing_count, with_trailing_rank
from txn_risk.schemas import (
    DEFAULT_AGE,
    DEFAULT_CITY_POP,
    DEFAULT_DOB,
    FEATURES,
)

EVENT_TIME = "event_time"

# What row_features() reads besides the category, after defaults are filled in.
ROW_INPUTS = (
    EVENT_TIME, "amt", "lat", "long", "merch_lat", "merch_long", "dob", "city_pop", "gender",
)


@dataclass(frozen=True)
class Baseline:
    """Spending profile fitted on training rows: one row per card, and one row overall."""

    cards: DataFrame
    overall: DataFrame

    @staticmethod
    def fit(train: DataFrame) -> Baseline:
        return Baseline(fit_baseline(train), fit_global(train))

    def save(self, path: str) -> None:
        self.cards.write.mode("overwrite").parquet(f"{path}/cards")
        self.overall.write.mode("overwrite").parquet(f"{path}/overall")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Baseline:
        return Baseline(
            spark.read.schema("cc_num bigint, mean double, std double, count bigint").parquet(
                f"{path}/cards"
            ),
            spark.read.schema("global_mean double, global_std double").parquet(f"{path}/overall"),
        )


def with_defaults(rows: DataFrame) -> DataFrame:
    """Fill what a record may lack: times, coordinates, population and birth date.

    ``unix_time`` is taken per row from the text only where it is missing; the two are otherwise
    independent.
    """
    ts = F.coalesce(
        parse_timestamp_lenient(F.col("trans_date_trans_time")), F.current_timestamp()
    )
    zero = F.lit(0.0)
    return (
        rows.withColumn(EVENT_TIME, ts)
        .withColumn("unix_time", F.coalesce("unix_time", F.unix_timestamp(EVENT_TIME)))
        .withColumns({c: F.coalesce(c, zero) for c in ("lat", "long", "merch_lat", "merch_long")})
        .withColumn("city_pop", F.coalesce("city_pop", F.lit(DEFAULT_CITY_POP)))
        .withColumn("dob", F.coalesce("dob", F.lit(DEFAULT_DOB)))
    )


def row_features() -> dict[str, Column]:
    """Features that depend on one record only, over the output of :func:`with_defaults`."""
    ts = F.col(EVENT_TIME)
    age = age_at(ts, parse_date(F.col("dob"), lenient=True))
    return {
        "amt": F.col("amt"),
        "amt_log": log1p_floor0(F.col("amt")),
        "geo_distance_km": haversine_km(
            F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")
        ),
        "trans_hour": F.hour(ts),
        "day_of_week": day_of_week_monday0(ts),
        "is_weekend": is_weekend(ts),
        "is_night": is_night(ts),
        "customer_age": F.coalesce(age, F.lit(DEFAULT_AGE)),
        "city_pop_log": log1p_floor0(F.col("city_pop")),
        "gender_code": gender_code(F.col("gender")),
        **category_flags(F.col("category")),
    }


def project_features(counted: DataFrame, baseline: Baseline, keep: tuple[str, ...]) -> DataFrame:
    """27 double columns in the pinned order after ``keep``.

    ``counted`` already has ``txn_freq_24h`` and carries the cards' profile.
    """
    scored = zscore_from_profile(counted, baseline.overall)
    made = row_features()
    columns = [made.get(n, F.col(n)).cast("double").alias(n) for n in FEATURES]
    return scored.select(*[c for c in keep if c not in FEATURES], *columns)


def batch_features(
    rows: DataFrame, baseline: Baseline, tie_policy: str = "strict",
    keep: tuple[str, ...] = ("trans_num", "is_fraud"),
) -> DataFrame:
    """Feature matrix of a batch; rows without a card have no features and are left out.

    ``tie_policy="strict"`` leaves same-second transactions of a card out of each other's 24-hour
    count, as the marts and the stream do; ``"rank"`` counts those sorted earlier.
    """
    ready = with_defaults(rows).where(F.col("cc_num").isNotNull())
    cards = as_profile(baseline.cards)
    if tie_policy == "strict":
        counted = with_trailing_count(
            ready, "cc_num", "unix_time", "txn_freq_24h", per_key=cards
        )
    elif tie_policy == "rank":
        counted = with_trailing_rank(
            ready, "cc_num", "unix_time", "trans_num", "txn_freq_24h", per_key=cards
        )
    else:
        raise ValueError(f"unknown tie policy {tie_policy!r}")
    return project_features(counted, baseline, keep)


def assembler(output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol=output, handleInvalid="keep")
