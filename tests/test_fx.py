"""F1-F7 and the FX bronze path."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from autolake import schemas
from autolake.operators import fx
from autolake.sources import bronze
from tests.conftest import rows

FX_COLS = "fecha date, casa string, nombre string, compra double, venta double, fetched_at string"


def test_normalize_from_envelope(spark, tmp_root):
    # the shape of one bronze FX file: envelope scalars + records under data
    env = {"fetched_at": "2026-07-02T12:00:00+00:00", "source": "feed",
           "data": [{"casa": "blue", "nombre": "Blue", "compra": 1180.0, "venta": 1200.0},
                    {"casa": "oficial", "nombre": "Oficial", "compra": 900.0, "venta": 950.0}]}
    os.makedirs(f"{tmp_root}/dolar")
    with open(f"{tmp_root}/dolar/2026-07-02.json", "w") as fh:
        json.dump(env, fh, indent=2)           # pretty-printed: needs multiLine
    recs = bronze.explode_envelope(bronze.read_envelopes(spark, f"{tmp_root}/dolar", schemas.FX_ENVELOPE),
                                   ["fetched_at", "source"])
    out = fx.normalize_fx(recs, day=dt.date(2026, 7, 2))
    assert out.schema.simpleString() == schemas.FX_SILVER.simpleString()
    assert out.count() == 2
    assert rows(out, "casa", "venta", "fecha") == [("blue", 1200.0, dt.date(2026, 7, 2)),
                                                   ("oficial", 950.0, dt.date(2026, 7, 2))]
    assert {r.fetched_at for r in out.collect()} == {"2026-07-02T12:00:00+00:00"}


def _rates(spark):
    d1, d2 = dt.date(2026, 7, 1), dt.date(2026, 7, 2)
    return spark.createDataFrame([(d1, "blue", "B", 1.0, 1000.0, "t"), (d2, "blue", "B", 1.0, 1100.0, "t"),
                                  (d2, "oficial", "O", 1.0, 900.0, "t"), (d2, "cripto", "C", 1.0, None, "t")],
                                 FX_COLS)


def test_latest_panel_order_and_featured(spark):
    out = fx.latest_panel(_rates(spark)).collect()
    assert [r.casa for r in out] == ["cripto", "blue", "oficial"]   # nulls first, then venta desc
    assert [r.featured for r in out] == [False, True, True]


def test_rate_on_day_missing_day_is_null(spark):
    days = spark.createDataFrame([("a", dt.date(2026, 7, 1)), ("b", dt.date(2026, 6, 30))], "cod string, d date")
    out = fx.rate_on_day(days, _rates(spark), "d")
    assert rows(out, "cod", "dolar_blue_venta") == [("a", 1000.0), ("b", None)]


def test_latest_and_asof(spark):
    r = fx.latest_rate(_rates(spark)).first()
    assert (r.fecha, r.venta) == (dt.date(2026, 7, 2), 1100.0)
    days = spark.createDataFrame([("x", dt.date(2026, 7, 5)), ("y", dt.date(2026, 6, 1)), ("z", dt.date(2026, 7, 1))],
                                 "cod string, d date")
    out = fx.asof_rate(days, _rates(spark), "d")
    assert rows(out, "cod", "dolar_blue_venta_asof") == [("x", 1100.0), ("y", None), ("z", 1000.0)]


def test_usd_and_bound(spark):
    df = spark.createDataFrame([(2500, 1000.0), (1500, 1000.0), (100, 0.0), (100, None)], "p long, r double")
    out = df.select(fx.usd_price(F.col("p"), F.col("r")).alias("usd")).collect()
    assert [r.usd for r in out] == [3, 2, None, None]                # half rounds up
    b = spark.createDataFrame([(1234.56, 10)], "r double, u long").select(fx.ars_bound(F.col("r"), F.col("u")))
    assert b.first()[0] == 12345                                      # truncated
