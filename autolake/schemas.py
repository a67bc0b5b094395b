"""Explicit schemas: readers never infer, writers always know the contract."""

from __future__ import annotations

from pyspark.sql import types as T

# FX record as delivered by the rates feed (inside the bronze envelope).
FX_RECORD = T.StructType([
    T.StructField("casa", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("compra", T.DoubleType()),
    T.StructField("venta", T.DoubleType()),
])

# One bronze FX file: a day of rates plus ingest metadata.
FX_ENVELOPE = T.StructType([
    T.StructField("fetched_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("data", T.ArrayType(FX_RECORD)),
])

# A scraped listing record (both sources; source B has a nullable year and a source field).
LISTING_RECORD = T.StructType([
    T.StructField("cod", T.StringType()),
    T.StructField("marca", T.StringType()),
    T.StructField("modelo", T.StringType()),
    T.StructField("condicion", T.StringType()),
    T.StructField("provincia", T.StringType()),
    T.StructField("precio_ars", T.LongType()),
    T.StructField("anio", T.LongType()),
    T.StructField("km", T.LongType()),
    T.StructField("segmento", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("source", T.StringType()),
])

LISTING_ENVELOPE = T.StructType([
    T.StructField("scraped_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("segmentos", T.MapType(T.StringType(), T.StringType())),
    T.StructField("total", T.LongType()),
    T.StructField("data", T.ArrayType(LISTING_RECORD)),
])

FX_SILVER = T.StructType([
    T.StructField("fecha", T.DateType()),
    T.StructField("casa", T.StringType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("compra", T.DoubleType()),
    T.StructField("venta", T.DoubleType()),
    T.StructField("fetched_at", T.StringType()),
])

# Silver listing column types.
LISTING_SILVER_TYPES = {
    "fecha": "date", "marca": "string", "modelo": "string", "condicion": "string",
    "provincia": "string", "cod": "string", "precio_ars": "bigint", "anio": "int",
    "km": "bigint", "url": "string", "segmento": "tinyint", "scraped_at": "string",
}

# Gold columns (key first, target last), model features, categoricals.
GOLD_COLUMNS = ["cod", "marca", "modelo", "provincia", "anio", "antiguedad", "km",
                "km_valido", "km_por_anio", "dolar_blue_venta", "precio_ars"]

CATEGORICAL = ["marca", "modelo", "provincia"]
TARGET = "precio_ars"

# Serving table contracts (S12) — NOT NULL columns, primary key, text
# limits (declared VARCHAR sizes) and defaults.
SERVING_LISTINGS = {
    "key": ["cod"],
    "not_null": ["cod", "fecha", "marca", "modelo", "segmento", "source"],
    "max_len": {"cod": 20, "marca": 50, "modelo": 100, "condicion": 30, "provincia": 100, "source": 20},
    "defaults": {"segmento": 0, "source": "a"},
}
SERVING_FX = {
    "key": ["fecha", "casa"],
    "not_null": ["fecha", "casa"],
    "max_len": {"casa": 50, "nombre": 100},
    "defaults": {},
}
