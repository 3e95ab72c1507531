"""Column functions. Every one is a built-in expression, so it stays in whole-stage codegen."""

from txn_risk.functions.calendar import (
    day_of_week_monday0,
    day_of_week_monday1,
    day_of_week_sunday1,
    hour_of_day,
    is_night,
    is_weekend,
    month_bucket,
    parse_date,
    parse_timestamp,
    parse_timestamp_lenient,
)
from txn_risk.functions.category import category_flags, clean_category
from txn_risk.functions.display import as_km, as_ms, as_percent, as_usd, mask_card
from txn_risk.functions.geo import haversine_km
from txn_risk.functions.keys import customer_key, full_name, merchant_key
from txn_risk.functions.numeric import (
    cents,
    coerce_double,
    coerce_int,
    exact_avg,
    exact_mean_place,
    exact_sum,
    log1p_floor0,
    ratio,
)
from txn_risk.functions.people import age_at, age_by_year, age_group, gender_code

__all__ = [
    "age_at", "age_by_year", "age_group", "as_km", "as_ms", "as_percent", "as_usd",
    "category_flags", "cents", "clean_category", "coerce_double", "coerce_int", "customer_key",
    "day_of_week_monday0", "day_of_week_monday1", "day_of_week_sunday1", "exact_avg", "exact_mean_place",
    "exact_sum", "full_name", "gender_code", "haversine_km", "hour_of_day", "is_night",
    "is_weekend", "log1p_floor0", "mask_card", "merchant_key", "month_bucket", "parse_date",
    "parse_timestamp", "parse_timestamp_lenient", "ratio",
]
