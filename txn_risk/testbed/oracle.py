"""The same questions as plain SQL, for a second engine to answer over the same tables."""

from __future__ import annotations

from txn_risk.plans.evaluation import THRESHOLDS
from txn_risk.schemas import CATEGORIES, FEATURES, RAW as RAW_TABLE

RAW = """
raw AS (
  SELECT CAST(e.event_id AS VARCHAR) AS trans_num,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS unix_time,
         e.user_id AS cc_num,
         'm_' || regexp_extract(e.props, '([0-9]+)', 1) AS merchant,
         CASE e.event_type WHEN 'view' THEN 'shopping_net' WHEN 'click' THEN 'misc_net'
              WHEN 'purchase' THEN ' Grocery_POS ' WHEN 'signup' THEN 'entertainment'
              ELSE 'unmapped' END AS category,
         e.value AS amt,
         ' F' || e.user_id AS "first", 'L' || e.user_id || ' ' AS "last",
         CASE WHEN e.user_id % 2 = 0 THEN 'm' ELSE 'F' END AS gender,
         e.user_id || ' Main St' AS street, 'City ' || (e.event_id % 40) AS city,
         lower(n.n_name) AS state, 10000 + e.user_id AS zip,
         25.0::DOUBLE + (e.user_id * 37 % 2000)::DOUBLE / 100.0::DOUBLE AS lat,
         -120.0::DOUBLE + (e.user_id * 53 % 5000)::DOUBLE / 100.0::DOUBLE AS long,
         1000 + e.user_id * 997 AS city_pop, ' Job ' || (e.user_id % 12) AS job,
         strftime(DATE '1940-01-01' + CAST(e.user_id * 97 % 22000 AS INTEGER), '%Y-%m-%d') AS dob,
         25.0::DOUBLE + (e.user_id * 37 % 2000 + e.event_id * 17 % 401 - 200)::DOUBLE
           / 100.0::DOUBLE AS merch_lat,
         -120.0::DOUBLE + (e.user_id * 53 % 5000 + e.event_id * 29 % 401 - 200)::DOUBLE
           / 100.0::DOUBLE AS merch_long,
         CASE WHEN e.value >= 200 OR e.event_id % 211 = 0 THEN 1 ELSE 0 END::BIGINT AS is_fraud,
         e.ts AS ingested_at
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

STG = RAW + """,
stg AS (
  SELECT trans_num, CAST(trans_date_trans_time AS TIMESTAMP) AS trans_timestamp, unix_time, cc_num,
         trim(merchant) AS merchant_name, trim(lower(category)) AS category, amt AS amount,
         trim("first") AS first_name, trim("last") AS last_name, upper(trim(gender)) AS gender,
         trim(street) AS street, trim(city) AS city, upper(trim(state)) AS state, zip AS zip_code,
         lat AS customer_lat, long AS customer_long, city_pop AS city_population,
         trim(job) AS job_title, CAST(dob AS DATE) AS date_of_birth, merch_lat AS merchant_lat,
         merch_long AS merchant_long, is_fraud, ingested_at
  FROM raw
)"""


def place(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,9))) AS DOUBLE) / count({value})::DOUBLE"


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    clip = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, {chord}))"
    return f"round(2 * 6371.0::DOUBLE * atan2(sqrt({clip}), sqrt(1 - {clip})), 2)"


STAR = STG + f""",
cust AS (
  SELECT md5(CAST(cc_num AS VARCHAR)) AS customer_id, *,
         2025 - year(date_of_birth) AS customer_age
  FROM (SELECT *, row_number() OVER (
          PARTITION BY cc_num ORDER BY trans_timestamp DESC, trans_num DESC) AS rn FROM stg)
  WHERE rn = 1
),
merch AS (
  SELECT md5(merchant_name || '_' || category) AS merchant_id, merchant_name, category,
         {place("merchant_lat")} AS avg_merchant_lat, {place("merchant_long")} AS avg_merchant_long,
         count(*) AS total_historical_transactions
  FROM stg GROUP BY merchant_name, category
),
spent AS (
  SELECT cc_num AS card, avg(amount) AS usual, stddev_samp(amount) AS spread FROM stg GROUP BY cc_num
),
counted AS (
  SELECT trans_num AS counted_num, count(*) OVER (
           PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS earlier
  FROM stg
),
fct AS (
  SELECT trans_num, md5(CAST(cc_num AS VARCHAR)) AS customer_id,
         md5(merchant_name || '_' || category) AS merchant_id,
         trans_timestamp, unix_time, amount, category, is_fraud,
         {km("customer_lat", "customer_long", "merchant_lat", "merchant_long")} AS geo_distance_km,
         earlier AS txn_freq_24h,
         CASE WHEN spread > 0 THEN round((amount - usual) / spread, 4) END AS amt_zscore_by_customer,
         CAST(extract(hour FROM trans_timestamp) AS INTEGER) AS trans_hour,
         CAST(1 + isodow(trans_timestamp) % 7 AS INTEGER) AS day_of_week,
         CAST(isodow(trans_timestamp) >= 6 AS INTEGER) AS is_weekend,
         CAST(extract(hour FROM trans_timestamp) < 6 AS INTEGER) AS is_night,
         ingested_at
  FROM stg, spent, counted WHERE card = cc_num AND counted_num = trans_num
)"""

SCORED = RAW + """,
scored AS (
  SELECT trans_num, least(amt / 500.0::DOUBLE, 1.0::DOUBLE) AS score, is_fraud AS label,
         category FROM raw
)"""


def money(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(value: str) -> str:
    return f"{money(value)} / nullif(count({value}), 0)::DOUBLE"


def _if(value: str, fraud: int) -> str:
    return f"CASE WHEN is_fraud = {fraud} THEN {value} END"


MEASURES = {
    "total_transactions": "count(*)",
    "total_amount": money("amount"),
    "avg_amount": mean("amount"),
    "avg_distance_km": mean("geo_distance_km"),
    "unique_customers": "count(DISTINCT customer_id)",
    "unique_merchants": "count(DISTINCT merchant_id)",
    "fraud_transactions": "count(*) FILTER (is_fraud = 1)",
    "legit_transactions": "count(*) FILTER (is_fraud = 0)",
    "fraud_amount": money(_if("amount", 1)),
    "avg_fraud_amount": mean(_if("amount", 1)),
    "avg_legit_amount": mean(_if("amount", 0)),
    "avg_fraud_distance_km": mean(_if("geo_distance_km", 1)),
    "avg_legit_distance_km": mean(_if("geo_distance_km", 0)),
    "avg_fraud_txn_freq_24h": mean(_if("txn_freq_24h", 1)),
    "fraud_rate": "count(*) FILTER (is_fraud = 1)::DOUBLE / count(*)",
    "fraud_loss_rate":
        f"coalesce({money(_if('amount', 1))} / nullif({money('amount')}, 0), 0)",
    "fraud_to_normal_ratio":
        f"coalesce(({mean(_if('amount', 1))}) / nullif({mean(_if('amount', 0))}, 0), 1)",
    "night_fraud_rate": "coalesce(count(*) FILTER (is_fraud = 1 AND is_night = 1)::DOUBLE"
                        " / nullif(count(*) FILTER (is_night = 1), 0), 0)",
    "weekend_fraud_rate": "coalesce(count(*) FILTER (is_fraud = 1 AND is_weekend = 1)::DOUBLE"
                          " / nullif(count(*) FILTER (is_weekend = 1), 0), 0)",
    "baseline_risk_cost": "count(*) FILTER (is_fraud = 1) * 500.0::DOUBLE",
    "fraud_prevented_amount": f"{money(_if('amount', 1))} * 0.8545::DOUBLE",
}
ALL_MEASURES = tuple(n for n in MEASURES if n != "avg_legit_amount")


def measures(by: str = "", only: tuple[str, ...] = ALL_MEASURES, source: str = "fct") -> str:
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return "SELECT " + head + ", ".join(f"{MEASURES[n]} AS {n}" for n in only) + f" FROM {source}{tail}"


def with_(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"


AGE_GROUP = (
    "CASE WHEN customer_age < 25 THEN '< 25' WHEN customer_age <= 35 THEN '25 - 35'"
    " WHEN customer_age <= 50 THEN '36 - 50' WHEN customer_age <= 65 THEN '51 - 65'"
    " ELSE '> 65' END"
)
BAND = (
    "CASE WHEN geo_distance_km < 10 THEN '< 10' WHEN geo_distance_km < 50 THEN '10 - 50'"
    " WHEN geo_distance_km <= 100 THEN '50 - 100' ELSE '> 100' END"
)
DIST = km("lat", "long", "merch_lat", "merch_long")
RATES = (
    "count(*) AS total_txn, count(*) FILTER (is_fraud = 1) AS fraud_txn,"
    " count(*) FILTER (is_fraud = 1)::DOUBLE / count(*) AS fraud_rate"
)
FRAUD = "count(*) FILTER (is_fraud = 1)"


def _rate(condition: str) -> str:
    return (
        f"(count(*) FILTER (is_fraud = 1 AND {condition})::DOUBLE"
        f" / nullif(count(*) FILTER ({condition}), 0))"
    )


def _summary(source: str, value: str, points: dict[str, float]) -> str:
    named = ", ".join(
        f"round(quantile_cont({value}, {p}), 6) AS {n}" for n, p in points.items()
    )
    return f"SELECT is_fraud, {mean(value)} AS mean, {named}, max({value}) AS max FROM {source} GROUP BY is_fraud"


# What a training run must satisfy, by the names that its entry gives.
INVARIANTS = (
    "ML3 forest has its trees, none deeper", "ML3 forest weights sum to one", "ML4 boosting lowers the loss",
    "ML4 boosting has its rounds", "ML2-4 every model beats no skill", "ML13 mean and deviation over folds",
    "ML14 highest mean is chosen", "ML17 features by falling weight", "T5 ten leading features", "ML19 gate at the floor",
    "ML19 no gate for an equal champion", "ML20 made-up rows score like known ones", "S19 card reads back",
    "S19 report names every model", "S20 threshold reads back",
)

GRID = "(VALUES " + ", ".join(f"({t!r}::DOUBLE)" for t in THRESHOLDS) + ") AS g(threshold)"

SWEEP = f"""
counts AS (
  SELECT threshold, count(*) FILTER (label = 0 AND score < threshold) AS tn,
         count(*) FILTER (label = 0 AND score >= threshold) AS fp,
         count(*) FILTER (label = 1 AND score < threshold) AS fn,
         count(*) FILTER (label = 1 AND score >= threshold) AS tp
  FROM scored, {GRID} GROUP BY threshold
),
sweep AS (
  SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
         coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
         coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1,
         fn * 500.0::DOUBLE + fp * 15.0::DOUBLE AS total_cost
  FROM counts
)"""

RANKED = """
tied AS (
  SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n
  FROM scored GROUP BY score
),
ranked AS (
  SELECT *, coalesce(sum(p) OVER b, 0)::BIGINT AS before_p,
         coalesce(sum(n) OVER b, 0)::BIGINT AS before_n,
         (sum(p) OVER ())::BIGINT AS all_p, (sum(n) OVER ())::BIGINT AS all_n
  FROM tied
  WINDOW b AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""

_CATEGORY = "trim(lower(category))"
_ONEHOT = ", ".join(
    f"CAST({_CATEGORY} = '{c}' AS INTEGER) AS cat_{c}" for c in CATEGORIES
) + ", CAST(" + _CATEGORY + " NOT IN (" + ", ".join(f"'{c}'" for c in CATEGORIES) + ") AS INTEGER) AS cat_other"
_TS = "CAST(trans_date_trans_time AS TIMESTAMP)"
_AGE = f"greatest(0, floor(date_diff('day', CAST(dob AS DATE), CAST({_TS} AS DATE)) / 365.25::DOUBLE))"
_STRICT = (
    "count(*) OVER (PARTITION BY cc_num ORDER BY unix_time"
    " RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)"
)
_RANKED_TIES = (
    f"{_STRICT} + row_number() OVER (PARTITION BY cc_num, unix_time"
    " ORDER BY substr(md5(trans_num), 1, 2), trans_num) - 1"
)
_WINDOW_Z = (
    "(amt - avg(amt) OVER (PARTITION BY cc_num))"
    " / stddev_samp(amt) OVER (PARTITION BY cc_num)"
)

# The first 22 days of the month train, the rest is the later hold-out.
CUT = "2024-01-23"
BASELINE = RAW + f""",
early AS (SELECT * FROM raw WHERE trans_date_trans_time < '{CUT}'),
cards AS (
  SELECT cc_num, avg(amt) AS mean, coalesce(stddev_samp(amt), 0) AS std, count(amt) AS count
  FROM early GROUP BY cc_num
),
overall AS (SELECT avg(amt) AS global_mean, stddev_samp(amt) AS global_std FROM early),
late AS (
  SELECT r.*, CASE WHEN c.cc_num IS NULL THEN global_mean ELSE c.mean END AS m,
         CASE WHEN c.cc_num IS NULL THEN global_std ELSE c.std END AS s
  FROM raw r LEFT JOIN cards c ON r.cc_num = c.cc_num, overall
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # Staging and dedup.
    q["stage_latest"] = with_(STG, "SELECT * REPLACE (ingested_at + INTERVAL 1 HOUR AS ingested_at, CAST(date_of_birth AS VARCHAR) AS date_of_birth) FROM stg")
    q["dedup_lineitem"] = """
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC) = 1"""
    # Marts.
    q["dim_customers"] = with_(STAR, """
      SELECT customer_id, cc_num, first_name, last_name, first_name || ' ' || last_name AS full_name,
             gender, street, city, state, zip_code, customer_lat, customer_long, city_population,
             job_title, CAST(date_of_birth AS VARCHAR) AS date_of_birth, customer_age FROM cust""")
    q["dim_merchants"] = with_(STAR, """
      SELECT merchant_id, merchant_name, category, avg_merchant_lat, avg_merchant_long, total_historical_transactions
      FROM merch""")
    q["fct_features"] = with_(STAR, "SELECT * FROM fct")
    q["fct_joined_dims"] = q["fct_features"]
    q["warehouse_fact"] = q["fct_features"]
    # Behavioural features one by one.
    q["txn_freq_24h"] = with_(RAW, f"SELECT trans_num, {_STRICT} AS txn_freq_24h FROM raw")
    q["txn_freq_24h_rank"] = with_(RAW, f"SELECT trans_num, {_RANKED_TIES} AS txn_freq_24h FROM raw")
    q["zscore_window"] = with_(RAW, f"SELECT trans_num, round({_WINDOW_Z}, 4) AS z FROM raw")
    q["zscore_baseline"] = with_(BASELINE, """
      SELECT trans_num, round(CASE WHEN s > 0.00001 THEN (amt - m) / s ELSE 0 END, 6) AS z FROM late""")
    q["card_baseline"] = with_(BASELINE, "SELECT cc_num, round(mean, 6) AS mean, round(std, 6) AS std, count FROM cards")
    q["global_baseline"] = with_(BASELINE, "SELECT round(global_mean, 6) AS global_mean, round(global_std, 6) AS global_std FROM overall")
    # Scalar functions.
    q["haversine"] = with_(RAW, f"SELECT trans_num, {DIST} AS km FROM raw")
    q["calendar_flags"] = with_(RAW, f"""
      SELECT trans_num, CAST(hour(t) AS INTEGER) AS hour,
             CAST(dayofweek(t) + 1 AS INTEGER) AS sunday1,
             CAST(isodow(t) - 1 AS INTEGER) AS monday0, CAST(isodow(t) AS INTEGER) AS monday1,
             CAST(isodow(t) >= 6 AS INTEGER) AS is_weekend, CAST(hour(t) <= 5 AS INTEGER) AS is_night,
             strftime(t, '%Y-%m') AS month
      FROM (SELECT trans_num, {_TS} AS t FROM raw)""")
    q["customer_age"] = with_(RAW, f"""
      SELECT trans_num, {_AGE}::DOUBLE AS age_at, 2025 - year(CAST(dob AS DATE)) AS age_by_year,
             {AGE_GROUP.replace('customer_age', '(2025 - year(CAST(dob AS DATE)))')} AS age_group
      FROM raw""")
    q["onehot_category"] = with_(RAW, f"SELECT trans_num, {_ONEHOT} FROM raw")
    q["md5_keys"] = with_(STG, """
      SELECT trans_num, md5(CAST(cc_num AS VARCHAR)) AS customer_id,
             md5(merchant_name || '_' || category) AS merchant_id,
             first_name || ' ' || last_name AS full_name FROM stg""")
    q["logs_and_codes"] = with_(RAW, """
      SELECT trans_num, round(ln(1 + greatest(0, amt)), 6) AS amt_log,
             round(ln(1 + greatest(0, city_pop::DOUBLE)), 6) AS city_pop_log,
             CASE WHEN upper(gender) = 'M' THEN 1 ELSE 0 END AS gender_code FROM raw""")
    q["masked_display"] = with_(RAW, """
      SELECT trans_num, substr(c, 1, 4) || '..' || right(c, 4) AS card, '$' || format('{:,.2f}', amt) AS amount
      FROM (SELECT trans_num, CAST(cc_num * 1000003 + 4000000000000000 AS VARCHAR) AS c, amt FROM raw)""")
    q["coerced"] = with_(RAW, """
      SELECT trans_num, coalesce(TRY_CAST(merchant AS DOUBLE), 0.0::DOUBLE) AS not_a_number,
             coalesce(TRY_CAST(CAST(amt AS VARCHAR) AS DOUBLE), 0.0::DOUBLE) AS number,
             CAST(NULL AS TIMESTAMP) AS not_a_time FROM raw""")
    # Measures and reports.
    q["measures_total"] = with_(STAR, measures())
    q["measures_by_category"] = with_(STAR, measures("category"))
    q["measures_by_state"] = with_(
        STAR + ", sliced AS (SELECT f.*, c.state FROM fct f JOIN cust c USING (customer_id))",
        measures("state", source="sliced"))
    q["measures_sliced"] = with_(
        STAR + f""", sliced AS (
          SELECT f.*, c.state, {AGE_GROUP} AS age_group FROM fct f JOIN cust c USING (customer_id)
          WHERE f.trans_timestamp >= DATE '2024-01-05' AND f.trans_timestamp < DATE '2024-01-21'
            AND f.category IN ('misc_net', 'shopping_net') AND {AGE_GROUP} IN ('36 - 50', '51 - 65'))""",
        measures("state, age_group, category", source="sliced"))
    q["star_join_rows"] = with_(
        STAR, "SELECT f.trans_num, c.state, c.gender, f.amount FROM fct f JOIN cust c USING (customer_id)")
    q["monthly_trend"] = with_(STAR, measures(
        "month", ("total_amount", "fraud_rate", "fraud_amount"),
        "(SELECT *, strftime(trans_timestamp, '%Y-%m') AS month FROM fct)"))
    q["category_risk"] = with_(STAR, "SELECT *, CAST(row_number() OVER (ORDER BY fraud_rate DESC, category) AS INTEGER) AS risk_rank FROM (" + measures(
        "category", ("total_transactions", "fraud_transactions", "fraud_rate", "fraud_amount")) + ")")
    q["label_split"] = with_(STAR, """
      SELECT is_fraud, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM fct) AS share
      FROM fct GROUP BY is_fraud""")
    q["state_risk"] = with_(STAR, measures(
        "state", ("total_transactions", "fraud_amount", "fraud_rate"),
        "(SELECT f.*, c.state FROM fct f JOIN cust c USING (customer_id))"))
    q["distance_bands"] = with_(STAR, measures(
        "band", ("total_transactions", "fraud_transactions", "fraud_amount", "fraud_rate"),
        f"(SELECT *, {BAND} AS band FROM fct)"))
    q["top_merchants"] = with_(STAR, f"""
      SELECT p.*, m.merchant_name, m.category FROM ({measures('merchant_id', ('fraud_transactions', 'fraud_amount', 'fraud_rate'))}) p
      JOIN merch m USING (merchant_id) WHERE fraud_transactions > 0
      ORDER BY fraud_amount DESC, fraud_transactions DESC, merchant_id LIMIT 10""")
    q["age_gender"] = with_(STAR, measures(
        "age_group, gender", ("total_transactions", "fraud_transactions", "fraud_rate"),
        f"(SELECT f.*, c.gender, {AGE_GROUP} AS age_group FROM fct f JOIN cust c USING (customer_id))"))
    q["hourly_fraud"] = with_(STAR, measures(
        "trans_hour", ("total_transactions", "fraud_transactions", "fraud_rate")))
    q["zscore_outliers"] = with_(STAR, "SELECT trans_num, amount, amt_zscore_by_customer, is_fraud FROM fct WHERE amt_zscore_by_customer > 3")
    q["outlier_rate"] = with_(STAR, measures(
        "", ("total_transactions", "fraud_transactions", "fraud_rate"),
        "(SELECT * FROM fct WHERE amt_zscore_by_customer > 3)"))
    late, deep, office = (
        "trans_hour IN (22, 23, 0, 1, 2, 3, 4)", "trans_hour <= 3", "trans_hour BETWEEN 8 AND 17")
    q["night_share"] = with_(STAR, f"""
      SELECT count(*) FILTER ({late})::DOUBLE / count(*) AS transaction_share,
             count(*) FILTER (is_fraud = 1 AND {late})::DOUBLE / {FRAUD} AS fraud_share,
             {_rate(deep)} / {_rate(office)} AS lift FROM fct""")
    q["distance_lift"] = with_(STAR, f"""
      SELECT {MEASURES['avg_fraud_distance_km']} AS avg_fraud_distance_km,
             {MEASURES['avg_legit_distance_km']} AS avg_legit_distance_km,
             {_rate('geo_distance_km > 100')} / {_rate('geo_distance_km <= 100')} AS lift FROM fct""")
    q["amount_contrast"] = with_(STAR, measures(
        "", ("avg_fraud_amount", "avg_legit_amount", "fraud_to_normal_ratio")))
    q["loss_share"] = with_(STAR, f"""
      SELECT category, fraud_amount, fraud_amount / total AS loss_share
      FROM (SELECT category, {money('amount')} AS fraud_amount FROM fct WHERE is_fraud = 1 GROUP BY category),
           (SELECT {money('amount')} AS total FROM fct WHERE is_fraud = 1)
      ORDER BY fraud_amount DESC, category LIMIT 2""")
    q["weekend_uplift"] = with_(STAR, f"""
      SELECT {_rate('is_weekend = 1')} AS weekend_fraud_rate, {_rate('is_weekend = 0')} AS weekday_fraud_rate,
             {_rate('is_weekend = 1')} / {_rate('is_weekend = 0')} AS uplift FROM fct""")
    # Profiles.
    types = {
        "trans_num": "string", "trans_date_trans_time": "string", "unix_time": "bigint",
        "cc_num": "bigint", "merchant": "string", "category": "string", "amt": "double",
        "first": "string", "last": "string", "gender": "string", "street": "string",
        "city": "string", "state": "string", "zip": "bigint", "lat": "double", "long": "double",
        "city_pop": "bigint", "job": "string", "dob": "string", "merch_lat": "double",
        "merch_long": "double", "is_fraud": "bigint", "ingested_at": "timestamp",
    }
    q["null_profile"] = with_(RAW, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows,"
        f" count(*) FILTER (\"{c}\" IS NULL) AS n_null FROM raw" for c, t in types.items()))
    q["time_span"] = with_(RAW, "SELECT min(trans_date_trans_time) AS first_at, max(trans_date_trans_time) AS last_at FROM raw")
    q["class_balance"] = with_(RAW, f"""
      SELECT CASE WHEN trans_date_trans_time < '{CUT}' THEN 'train' ELSE 'test' END AS split,
             {FRAUD} AS fraud, count(*) AS total, {FRAUD}::DOUBLE / count(*) * 100 AS fraud_pct
      FROM raw GROUP BY 1""")
    q["distinct_entities"] = with_(RAW, "SELECT " + ", ".join(
        f"count(DISTINCT {c}) AS {c}" for c in ("cc_num", "merchant", "category", "state", "job")) + " FROM raw")
    q["amount_quantiles"] = with_(RAW, _summary("raw", "amt", {"median": 0.5, "p95": 0.95}))
    q["amount_box"] = with_(RAW, f"""
      SELECT b.*, (SELECT min(amt) FROM raw r WHERE r.is_fraud = b.is_fraud) AS min FROM (
      {_summary('raw', 'amt', {'q1': 0.25, 'median': 0.5, 'q3': 0.75})}) b""")
    q["distance_quantiles"] = with_(RAW, _summary(f"(SELECT is_fraud, {DIST} AS km FROM raw)", "km", {"median": 0.5}))
    q["distance_describe"] = with_(RAW, f"""
      SELECT is_fraud, count(km) AS n, round(stddev_samp(km), 6) AS std, min(km) AS min, {mean('km')} AS mean,
             round(quantile_cont(km, 0.25), 6) AS p25, round(quantile_cont(km, 0.5), 6) AS median,
             round(quantile_cont(km, 0.75), 6) AS p75, max(km) AS max
      FROM (SELECT is_fraud, {DIST} AS km FROM raw) GROUP BY is_fraud""")
    q["category_rates"] = with_(RAW, f"""
      SELECT category, {RATES}, {mean('amt')} AS avg_amount,
             {FRAUD}::DOUBLE / count(*) * 100 AS fraud_rate_pct FROM raw GROUP BY category""")
    q["top_states"] = with_(RAW, f"""
      SELECT state, {RATES}, {mean('amt')} AS avg_amount FROM raw GROUP BY state
      ORDER BY fraud_rate DESC, state LIMIT 15""")
    q["state_extremes"] = with_(RAW + f", s AS (SELECT state, {RATES} FROM raw GROUP BY state)", """
      SELECT (SELECT count(*) FROM s) AS n_states,
             (SELECT state FROM s ORDER BY fraud_rate DESC, state DESC LIMIT 1) AS highest_state,
             (SELECT max(fraud_rate) FROM s) AS highest_rate,
             (SELECT state FROM s ORDER BY fraud_rate, state LIMIT 1) AS lowest_state,
             (SELECT min(fraud_rate) FROM s) AS lowest_rate""")
    q["hourly_rates"] = with_(RAW, f"SELECT CAST(hour({_TS}) AS INTEGER) AS hour, {RATES} FROM raw GROUP BY 1")
    q["weekday_fraud"] = with_(RAW, f"""
      SELECT CAST(isodow({_TS}) - 1 AS INTEGER) AS weekday, dayname({_TS}) AS weekday_name, {RATES}
      FROM raw GROUP BY 1, 2""")
    for name, value, width, low_high in (
        ("amount_density", "amt", 50, "amt BETWEEN 0 AND 1500"), ("distance_histogram", "km", 5, "TRUE")):
        q[name] = with_(RAW + f", d AS (SELECT is_fraud, amt, {DIST} AS km FROM raw)", f"""
          SELECT is_fraud, bucket, n, n / (sum(n) OVER (PARTITION BY is_fraud) * {width}.0::DOUBLE) AS density
          FROM (SELECT is_fraud, floor({value} / {width}.0::DOUBLE) * {width}.0::DOUBLE AS bucket, count(*) AS n
                FROM d WHERE {low_high} GROUP BY 1, 2)""")
    # Data quality.
    q["orphans"] = """
      SELECT o_custkey, count(*) AS n_rows FROM orders o
      WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey) GROUP BY o_custkey"""
    q["dq_report"] = with_(STAR, _dq())
    q["retrain_readiness"] = with_(RAW, f"""
      SELECT count(*) AS n_rows, {FRAUD} AS n_fraud, min({_TS}) AS first_at, max({_TS}) AS last_at,
             CAST(date_diff('day', CAST(min({_TS}) AS DATE), CAST(max({_TS}) AS DATE)) AS INTEGER) AS n_days,
             (count(*) >= 100 AND {FRAUD} > 0
              AND date_diff('day', CAST(min({_TS}) AS DATE), CAST(max({_TS}) AS DATE)) >= 7) AS ready
      FROM raw""")
    # Lake and export.
    q["lake_roundtrip"] = with_(RAW, """
      SELECT strftime(CAST(trans_date_trans_time AS TIMESTAMP), '%Y-%m-%d') AS dt,
             strftime(CAST(trans_date_trans_time AS TIMESTAMP), '%H') AS hour,
             count(*) AS n, CAST(sum(CAST(amt AS DECIMAL(18,2))) AS DOUBLE) AS amount
      FROM raw GROUP BY 1, 2""")
    q["raw_load"] = with_(RAW, "SELECT trans_num, cc_num, amt, merchant, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM raw")
    again = "trans_date_trans_time < '2024-01-23' AND CAST(trans_num AS BIGINT) % 20"
    q["incremental_build"] = with_(STG, f"""
      SELECT * EXCLUDE (trans_date_trans_time) REPLACE (
        CASE WHEN {again} = 4 THEN trans_timestamp + INTERVAL 3 DAY ELSE trans_timestamp END AS trans_timestamp,
        CASE WHEN {again} = 3 THEN amount + 1 ELSE amount END AS amount,
        TIMESTAMP '2024-02-01 00:00:00' + CASE WHEN trans_date_trans_time >= '2024-01-23' OR {again} IN (3, 4)
          THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ingested_at,
        CAST(date_of_birth AS VARCHAR) AS date_of_birth)
      FROM stg JOIN (SELECT trans_num, trans_date_trans_time FROM raw) USING (trans_num)""")
    fields = " UNION ALL ".join(f"SELECT 'field', '{f.name}'" for f in RAW_TABLE.fields)
    q["raw_contract"] = with_(RAW, f"""
      SELECT 'rows' AS kind, CAST(count(*) AS VARCHAR) AS told FROM raw UNION ALL {fields}
      UNION ALL SELECT * FROM (VALUES ('lacking', 'missing amt'), ('lacking', 'missing dob'),
        ('mistyped', 'zip is string, expected bigint')) AS faults""")
    features = ", ".join(f"('{f}')" for f in ("intercept", *FEATURES))
    q["ml_logistic_optimum"] = f"SELECT feature, TRUE AS at_optimum FROM (VALUES {features}) AS f(feature)"
    held = ", ".join(f"('{i}')" for i in INVARIANTS)
    q["ml_training"] = f"SELECT invariant, TRUE AS holds FROM (VALUES {held}) AS i(invariant)"
    q["time_prefix"] = with_(RAW, "SELECT trans_num, trans_date_trans_time FROM raw ORDER BY trans_date_trans_time, trans_num LIMIT 2500")
    q["json_roundtrip"] = with_(RAW, 'SELECT trans_num, cc_num, amt, category, merch_lat, is_fraud, CAST(cc_num AS VARCHAR) AS "key" FROM raw')
    q["export_fact"] = with_(RAW, f"""
      SELECT trans_num, md5(CAST(cc_num AS VARCHAR)) AS customer_id,
             md5(merchant || '_' || category) AS merchant_id, {_TS} AS trans_timestamp, unix_time,
             amt AS amount, category, is_fraud, {DIST} AS geo_distance_km,
             {_RANKED_TIES} AS txn_freq_24h, round({_WINDOW_Z}, 4) AS amt_zscore_by_customer,
             CAST(hour({_TS}) AS INTEGER) AS trans_hour, CAST(isodow({_TS}) AS INTEGER) AS day_of_week,
             CAST(isodow({_TS}) >= 6 AS INTEGER) AS is_weekend, CAST(hour({_TS}) <= 5 AS INTEGER) AS is_night
      FROM raw""")
    q["export_customers"] = with_(RAW, f"""
      SELECT md5(CAST(cc_num AS VARCHAR)) AS customer_id, cc_num, "first" AS first_name,
             "last" AS last_name, "first" || ' ' || "last" AS full_name, gender, street, city, state,
             zip AS zip_code, lat AS customer_lat, long AS customer_long, city_pop AS city_population,
             job AS job_title, dob AS date_of_birth, {_AGE}::BIGINT AS customer_age
      FROM raw QUALIFY row_number() OVER (
        PARTITION BY cc_num ORDER BY trans_date_trans_time DESC, trans_num DESC) = 1""")
    q["export_merchants"] = with_(RAW, f"""
      SELECT md5(merchant || '_' || category) AS merchant_id, merchant AS merchant_name, category,
             {place('merch_lat')} AS avg_merchant_lat, {place('merch_long')} AS avg_merchant_long,
             count(trans_num) AS total_historical_transactions
      FROM raw GROUP BY merchant, category""")
    # Features and evaluation.
    q["feature_matrix"] = with_(BASELINE, f"""
      SELECT trans_num, is_fraud, amt, round(ln(1 + greatest(0, amt)), 6) AS amt_log, {DIST} AS geo_distance_km,
             ({_STRICT})::DOUBLE AS txn_freq_24h,
             round(CASE WHEN s > 0.00001 THEN (amt - m) / s ELSE 0 END, 6) AS amt_zscore_by_customer,
             hour({_TS})::DOUBLE AS trans_hour, (isodow({_TS}) - 1)::DOUBLE AS day_of_week,
             CAST(isodow({_TS}) >= 6 AS DOUBLE) AS is_weekend, CAST(hour({_TS}) <= 5 AS DOUBLE) AS is_night,
             {_AGE}::DOUBLE AS customer_age, round(ln(1 + city_pop::DOUBLE), 6) AS city_pop_log,
             CASE WHEN upper(gender) = 'M' THEN 1.0 ELSE 0.0 END::DOUBLE AS gender_code,
             {_ONEHOT.replace('AS INTEGER)', 'AS DOUBLE)')}
      FROM late""")
    q["class_weights"] = with_(RAW, f"""
      SELECT count(*) AS n_total, {FRAUD} AS n_fraud,
             (count(*) - {FRAUD})::DOUBLE / greatest(1, {FRAUD}) AS imbalance_ratio,
             count(*)::DOUBLE / (2 * {FRAUD}) AS weight_fraud,
             count(*)::DOUBLE / (2 * (count(*) - {FRAUD})) AS weight_legit FROM raw""")
    q["stratified_folds"] = with_(RAW, """
      SELECT trans_num, is_fraud, CAST((row_number() OVER (PARTITION BY is_fraud
        ORDER BY md5(trans_num || ':42'), trans_num) - 1) % 5 AS INTEGER) AS fold FROM raw""")
    q["cost_sweep"] = with_(SCORED + "," + SWEEP, "SELECT * FROM sweep")
    q["cheapest_threshold"] = with_(SCORED + "," + SWEEP, "SELECT * FROM sweep ORDER BY total_cost, threshold LIMIT 1")
    q["confusion"] = with_(SCORED, """
      SELECT category, 0.5::DOUBLE AS threshold, count(*) FILTER (label = 0 AND score < 0.5) AS tn,
             count(*) FILTER (label = 0 AND score >= 0.5) AS fp, count(*) FILTER (label = 1 AND score < 0.5) AS fn,
             count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
             coalesce(count(*) FILTER (label = 1 AND score >= 0.5)::DOUBLE / nullif(count(*) FILTER (score >= 0.5), 0), 0) AS precision,
             coalesce(count(*) FILTER (label = 1 AND score >= 0.5)::DOUBLE / nullif(count(*) FILTER (label = 1), 0), 0) AS recall,
             coalesce((2 * count(*) FILTER (label = 1 AND score >= 0.5))::DOUBLE
               / nullif(count(*) FILTER (label = 1) + count(*) FILTER (score >= 0.5), 0), 0) AS f1,
             count(*) FILTER (label = 1 AND score < 0.5) * 500.0::DOUBLE + count(*) FILTER (label = 0 AND score >= 0.5) * 15.0::DOUBLE AS total_cost
      FROM scored GROUP BY category""")
    q["precision_recall_curve"] = with_(SCORED + "," + RANKED, """
      SELECT score AS threshold, (before_p + p)::DOUBLE / (before_p + p + before_n + n) AS precision,
             (before_p + p)::DOUBLE / all_p AS recall, all_p::DOUBLE / (all_p + all_n) AS no_skill FROM ranked""")
    ap = "sum(p * ((before_p + p)::DOUBLE / (before_p + p + before_n + n))) / max(all_p)"
    auc = "sum(n * (before_p + p / 2.0::DOUBLE)) / (max(all_p)::DOUBLE * max(all_n))"
    q["average_precision"] = with_(SCORED + "," + RANKED, f"SELECT round({ap}, 9) AS average_precision FROM ranked")
    q["roc_auc"] = with_(SCORED + "," + RANKED, f"SELECT round({auc}, 9) AS roc_auc FROM ranked")
    q["recall_at_precision"] = with_(SCORED + "," + RANKED, """
      SELECT coalesce(max((before_p + p)::DOUBLE / all_p) FILTER (
               (before_p + p)::DOUBLE / (before_p + p + before_n + n) >= 0.8), 0) AS recall FROM ranked""")
    q["holdout_comparison"] = with_(SCORED + "," + SWEEP.replace(GRID, "(VALUES (0.25::DOUBLE), (0.5::DOUBLE)) AS g(threshold)"), """
      SELECT s.*, b.total_cost - s.total_cost AS cost_savings,
             coalesce((b.total_cost - s.total_cost) * 100 / nullif(b.total_cost, 0), 0) AS cost_savings_pct
      FROM sweep s, (SELECT total_cost FROM sweep WHERE threshold = 0.5) b""")
    q["financial_impact"] = with_(SCORED + "," + SWEEP, """
      SELECT threshold, fn AS missed_frauds, fp AS false_alarms, tp::DOUBLE / (tp + fn) AS prevented_share,
             (tp + fn) * 500.0::DOUBLE AS loss_without_model, fn * 500.0::DOUBLE AS loss_with_model,
             tp * 500.0::DOUBLE AS loss_prevented, total_cost AS operating_cost FROM sweep""")
    # Scores.
    decide = "CASE WHEN score >= 0.85 THEN 'BLOCK' WHEN score >= 0.75 THEN 'ALERT' ELSE 'APPROVE' END"
    q["score_policy"] = with_(SCORED, f"""
      SELECT trans_num, score, {decide} AS decision, CAST(score >= 0.75 AS INTEGER) AS is_fraud_predicted FROM scored""")
    records = SCORED + f""", records AS (
      SELECT r.trans_num, r.amt, round(s.score, 4) AS fraud_score, {decide} AS decision,
             CAST(s.score >= 0.75 AS INTEGER) AS is_fraud_predicted, r.trans_date_trans_time AS processed_at
      FROM raw r JOIN scored s USING (trans_num))"""
    q["score_upsert"] = with_(records, f"""
      SELECT r.trans_num, r.trans_date_trans_time, r.unix_time, r.cc_num, r.merchant, r.category, r.amt, r.city, r.state,
             {km("r.lat", "r.long", "r.merch_lat", "r.merch_long")} AS geo_distance_km, CAST(0 AS INTEGER) AS txn_freq_24h,
             0.0::DOUBLE AS amt_zscore_by_customer, x.fraud_score, x.is_fraud_predicted,
             CAST(r.is_fraud AS INTEGER) AS is_fraud_ground_truth, x.decision, 1.5::DOUBLE AS latency_ms, x.processed_at
      FROM raw r JOIN records x USING (trans_num)""")
    newest = "SELECT * FROM records ORDER BY processed_at DESC, trans_num LIMIT 1000"
    q["newest_scores"] = with_(records, f"SELECT trans_num, fraud_score, decision FROM ({newest})")
    q["live_kpis"] = with_(records, f"""
      SELECT count(*) AS total, count(*) FILTER (decision IN ('BLOCK', 'ALERT')) AS alerts,
             count(*) FILTER (decision = 'BLOCK') AS blocked,
             count(*) FILTER (decision IN ('BLOCK', 'ALERT'))::DOUBLE / count(*) * 100 AS fraud_rate_pct,
             1.5::DOUBLE AS avg_latency_ms, {money('amt')} AS total_volume FROM ({newest})""")
    q["decision_counts"] = with_(records, "SELECT decision, count(*) AS n FROM records GROUP BY decision")
    q["filter_scores"] = with_(records, "SELECT trans_num, decision, amt FROM records WHERE decision IN ('BLOCK', 'ALERT') AND amt >= 100")
    q["scoring_summary"] = with_(records, """
      SELECT count(*) AS processed, count(*) FILTER (is_fraud_predicted = 1) AS flagged,
             count(*) FILTER (is_fraud_predicted = 1)::DOUBLE / count(*) * 100 AS flagged_pct,
             1.5::DOUBLE AS avg_latency_ms FROM records""")
    q["replay_summary"] = with_(RAW, f"SELECT count(*) AS sent, {FRAUD} AS fraud, {FRAUD}::DOUBLE / count(*) * 100 AS fraud_pct FROM raw")
    q["risk_signals"] = with_(STAR, """
      SELECT trans_num, geo_distance_km > 100 AS flag_far, abs(amt_zscore_by_customer) > 2.0 AS flag_amount FROM fct""")
    # Streams, answered by batch SQL.
    q["stream_freq_24h"] = q["txn_freq_24h"]
    q["stream_dedup"] = with_(RAW, "SELECT trans_num, cc_num, amt FROM raw")
    q["stream_lake"] = q["lake_roundtrip"]
    first = "SELECT * FROM raw ORDER BY trans_date_trans_time, trans_num LIMIT 2500"
    q["stream_stop"] = with_(RAW, f"""
      SELECT trans_date_trans_time[:10] AS dt, trans_date_trans_time[12:13] AS hour, count(*) AS n, {money('amt')} AS amount
      FROM ({first}) GROUP BY ALL""")
    q["lake_merged"] = f"SELECT *, TRUE AS as_told FROM ({q['lake_roundtrip']}) AS merged"
    q["stream_features"] = q["feature_matrix"]
    q["stream_run_summary"] = with_(records, """
      SELECT count(*) AS processed, count(*) FILTER (is_fraud_predicted = 1) AS flagged,
             100.0::DOUBLE * count(*) FILTER (is_fraud_predicted = 1) / count(*) AS flagged_pct,
             TRUE AS same_latency, TRUE AS timed FROM records""")
    q["stream_scores"] = with_(RAW, "SELECT trans_num, TRUE AS same FROM raw")
    q["lake_retention"] = with_(RAW, """
      SELECT trans_date_trans_time[:10] AS day, count(*) AS n FROM raw
      WHERE trans_date_trans_time >= '2024-01-23' GROUP BY ALL""")
    q["load_summary"] = with_(RAW, """
      SELECT 'PARTIAL' AS status, 3::BIGINT AS files_skipped, count(*) AS rows_loaded, count(*) AS total_table_rows FROM raw""")
    q["json_rejects"] = with_(RAW, """
      SELECT 'lake' AS kind, count(*) AS n FROM raw
      UNION ALL SELECT kind, 1::BIGINT FROM (VALUES (''), ('{}'), ('not json'), ('{"trans_num": "x", "amt": "many"}'),
        ('{"amt": 1.5}')) AS bad(kind)""")
    q["timeline"] = with_(records, "SELECT trans_num, processed_at, decision, amt FROM records ORDER BY processed_at DESC, trans_num LIMIT 100")
    q["lookup"] = with_(records, "SELECT trans_num, decision, amt FROM records WHERE trans_num = '77'")
    once = "SELECT trans_num, category, amt, is_fraud, dob FROM raw"
    q["csv_scan"] = with_(RAW, f"{once} UNION ALL {once}")
    lacks = "CAST(trans_num AS BIGINT) % 4 = 1"
    q["defaults_filled"] = with_(RAW, f"""
      SELECT trans_num, unix_time, CASE WHEN {lacks} THEN 0 ELSE lat END AS lat, CASE WHEN {lacks} THEN 0 ELSE long END AS long,
             CASE WHEN {lacks} THEN 0 ELSE merch_lat END AS merch_lat, CASE WHEN {lacks} THEN 0 ELSE merch_long END AS merch_long,
             CASE WHEN {lacks} THEN 10000 ELSE city_pop END AS city_pop, CASE WHEN {lacks} THEN '1990-01-01' ELSE dob END AS dob
      FROM raw""")
    last = "CAST(trans_num AS BIGINT) % 10"
    q["dq_faults"] = with_(STAR, f"""
      SELECT * FROM (
        SELECT 'unique' AS "check", 'trans_num' AS "column", count(*) FILTER ({last} = 6) AS failures FROM fct
        UNION ALL SELECT 'not_null', 'merchant_id', count(*) FILTER ({last} = 5) FROM fct
        UNION ALL SELECT 'accepted_values', 'is_fraud', count(*) FILTER ({last} = 4) FROM fct
        UNION ALL SELECT 'relationships', 'customer_id', count(*) FILTER ({last} = 3) FROM fct),
        (SELECT 'fct_transactions_fraud_features' AS model)
      WHERE failures > 0""")
    return q


def _dq() -> str:
    from txn_risk.plans.quality import ACCEPTED, NOT_NULL, RELATIONSHIPS, UNIQUE

    table = {
        "stg_transactions": "stg", "dim_customers": "cust", "dim_merchants": "merch",
        "fct_transactions_fraud_features": "fct",
    }
    parts = []

    def add(check: str, model: str, column: str, failures: str) -> None:
        parts.append(
            f"SELECT '{check}' AS \"check\", '{model}' AS model, '{column}' AS \"column\","
            f" ({failures})::BIGINT AS failures"
        )

    for m, columns in NOT_NULL.items():
        for c in columns:
            add("not_null", m, c, f"SELECT count(*) FROM {table[m]} WHERE {c} IS NULL")
    for m, accepted in ACCEPTED.items():
        for c in accepted:
            add("accepted_values", m, c, f"SELECT count(*) FROM {table[m]} WHERE {c} NOT IN (0, 1)")
    for m, columns in UNIQUE.items():
        for c in columns:
            add("unique", m, c, f"SELECT count(*) FROM (SELECT {c} FROM {table[m]} GROUP BY {c} HAVING count(*) > 1)")
    for m, parents in RELATIONSHIPS.items():
        for c, p in parents.items():
            add("relationships", m, c, f"SELECT count(*) FROM {table[m]} WHERE {c} NOT IN (SELECT {c} FROM {table[p]})")
    return " UNION ALL ".join(parts)
