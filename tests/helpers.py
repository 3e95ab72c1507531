"""Hand-made transactions."""

from __future__ import annotations

from txn_risk.schemas import TRANSACTION

TEMPLATE = {
    "trans_num": "t0", "trans_date_trans_time": "2021-06-15 13:45:30", "unix_time": 1623764700,
    "cc_num": 4111222233334444, "merchant": "Corner Books", "category": "shopping_pos", "amt": 42.25,
    "first": "Mio", "last": "Sand", "gender": "M", "street": "7 Harbor Row", "city": "Lakeview",
    "state": "OR", "zip": 97001, "lat": 45.25, "long": -122.5, "city_pop": 18200,
    "job": "Gardener", "dob": "1979-11-02", "merch_lat": 45.5, "merch_long": -122.75, "is_fraud": 0,
}


def transactions(spark, *changes: dict):
    rows = []
    for i, change in enumerate(changes):
        row = {**TEMPLATE, "trans_num": f"t{i}", **change}
        rows.append(tuple(row[f.name] for f in TRANSACTION.fields))
    return spark.createDataFrame(rows, TRANSACTION)


def by_id(df, *columns):
    return {
        r["trans_num"]: (r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns))
        for r in df.select("trans_num", *columns).collect()
    }
