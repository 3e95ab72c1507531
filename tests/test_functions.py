from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txn_risk import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_distance_between_known_cities(spark):
    nyc, la = (40.7128, -74.0060), (34.0522, -118.2437)
    km = one(spark, fn.haversine_km(*[F.lit(v) for v in (*nyc, *la)]))
    assert 3900 < km < 4000
    assert one(spark, fn.haversine_km(*[F.lit(v) for v in (*nyc, *nyc)])) == 0.0


def test_distance_of_antipodes_and_missing_point(spark):
    assert one(spark, fn.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == 20015.09
    missing = F.lit(None).cast("double")
    assert one(spark, fn.haversine_km(missing, F.lit(0.0), F.lit(0.0), F.lit(0.0))) is None


def test_unrounded_distance(spark):
    args = [F.lit(v) for v in (1.0, 2.0, 1.1, 2.1)]
    full = one(spark, fn.haversine_km(*args, digits=None))
    assert full != round(full, 2) and one(spark, fn.haversine_km(*args)) == round(full, 2)


@pytest.mark.parametrize(
    "day, sunday1, monday0, weekend",
    [("2024-01-07", 1, 6, 1), ("2024-01-08", 2, 0, 0), ("2024-01-06", 7, 5, 1)],
)
def test_day_numbering(spark, day, sunday1, monday0, weekend):
    ts = F.lit(f"{day} 10:00:00").cast("timestamp")
    assert one(spark, fn.day_of_week_sunday1(ts)) == sunday1
    assert one(spark, fn.day_of_week_monday0(ts)) == monday0
    assert one(spark, fn.day_of_week_monday1(ts)) == monday0 + 1
    assert one(spark, fn.is_weekend(ts)) == weekend


@pytest.mark.parametrize("hour, night", [(0, 1), (5, 1), (6, 0), (23, 0)])
def test_night(spark, hour, night):
    assert one(spark, fn.is_night(F.lit(f"2024-01-01 {hour:02d}:59:59").cast("timestamp"))) == night


def test_ages(spark):
    ts = F.lit("2019-01-01 00:00:18").cast("timestamp")
    assert one(spark, fn.age_at(ts, F.lit("1988-03-09").cast("date"))) == 30.0
    assert one(spark, fn.age_at(ts, F.lit("2030-01-01").cast("date"))) == 0.0
    assert one(spark, fn.age_at(ts, F.lit(None).cast("date"))) is None
    assert one(
        spark, fn.age_by_year(F.lit("1988-12-31").cast("date"), F.lit(dt.date(2025, 1, 1)))
    ) == 37


@pytest.mark.parametrize(
    "age, band",
    [(24, "< 25"), (25, "25 - 35"), (35, "25 - 35"), (36, "36 - 50"), (65, "51 - 65"),
     (66, "> 65"), (None, None)],
)
def test_age_bands(spark, age, band):
    assert one(spark, fn.age_group(F.lit(age).cast("int"))) == band


def test_category_flags(spark):
    def flags(value):
        cols = fn.category_flags(F.lit(value).cast("string"))
        row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
        return [n for n, v in row.asDict().items() if v == 1]

    assert flags("  Grocery_POS ") == ["cat_grocery_pos"]
    assert flags("nothing known") == ["cat_other"]
    assert flags("") == flags(None) == ["cat_other"]


def test_coercion(spark):
    assert one(spark, fn.coerce_double(F.lit("x"))) == 0.0
    assert one(spark, fn.coerce_double(F.lit("2.5"))) == 2.5
    assert one(spark, fn.coerce_int(F.lit("7.9"))) == 7
    assert one(spark, fn.coerce_int(F.lit(None).cast("string"))) == 0
    assert one(spark, fn.parse_timestamp_lenient(F.lit("yesterday"))) is None


def test_ratio(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(1), F.lit(0), 1)) == 1.0
    assert one(spark, fn.ratio(F.lit(1), F.lit(4), 0)) == 0.25


def test_logs_keep_null_and_floor_at_zero(spark):
    assert one(spark, fn.log1p_floor0(F.lit(-3.0))) == 0.0
    assert one(spark, fn.log1p_floor0(F.lit(None).cast("double"))) is None


def test_display(spark):
    assert one(spark, fn.mask_card(F.lit(4111222233334444))) == "4111..4444"
    assert one(spark, fn.as_percent(F.lit(0.8765))) in ("87.7%", "87.6%")
    assert one(spark, fn.as_usd(F.lit(1234.5))) == "$1,234.50"
    assert one(spark, fn.as_km(F.lit(12.34))) == "12.3 km"
    assert one(spark, fn.as_ms(F.lit(1.5))) == "1.50 ms"


def test_full_name_needs_both(spark):
    assert one(spark, fn.full_name(F.lit("A"), F.lit("B"))) == "A B"
    assert one(spark, fn.full_name(F.lit("A"), F.lit(None).cast("string"))) is None


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(2000).select((F.col("id") / 100).alias("v"))
    sums = {
        df.repartition(n, F.rand(n)).agg(fn.exact_sum(F.col("v")).alias("s")).first()["s"]
        for n in (1, 3, 7)
    }
    assert sums == {19990.0}
