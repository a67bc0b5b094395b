"""Q1-Q11: filters, top-k, facets, table semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from autolake.operators import market as mk
from tests.conftest import rows

SERVING = ("cod string, marca string, modelo string, provincia string, anio int, km long, precio_ars long, "
           "precio_estimado long, oportunidad_score double, url string, fecha date, scraped_at date")


def _serving(spark):
    import datetime as dt
    d1, d2 = dt.date(2026, 7, 1), dt.date(2026, 7, 2)
    data = [("1", "Toyota", "Corolla", "Córdoba", 2015, 80000, 9_000_000, 11_000_000, 0.1818, "/a/1", d1, d1),
            ("2", "Toyota", "Etios", "Mendoza", 2018, 1, 7_000_000, 7_700_000, 0.0909, "/a/2", d2, d2),
            ("3", "Ford", "Ka", "Córdoba", None, None, None, None, None, "http://x/3", d2, None),
            ("4", "Fiat", "Uno", "Salta", 2010, 150000, 3_000_000, 3_333_333, 0.1, "/a/4", d1, d1),
            ("5", "toyota", "Hilux", "Jujuy", 2020, 0, 5_000_000, 6_000_000, 0.1667, "/a/5", d1, d1)]
    return spark.createDataFrame(data, SERVING)


def test_search_filters(spark):
    s = _serving(spark)
    out = mk.search(s, mk.SearchFilter(marca="TOYO", anio_min=2016, anio_max=2020, km_min=0))
    assert [r.cod for r in out.collect()] == ["5", "2"]          # 0 = no bound; score desc
    out = mk.search(s, mk.SearchFilter(solo_oportunidades=True))
    assert [r.cod for r in out.collect()] == ["1", "5", "4"]     # >= 0.10 keeps exactly 0.1
    assert mk.search(s, mk.SearchFilter(marca="%")).count() == 0  # taken literally
    nulls = mk.search(s, mk.SearchFilter()).collect()
    assert nulls[-1].cod == "3"                                    # null score last


def test_lines_and_labels(spark):
    lines = dict(rows(mk.result_lines(_serving(spark))))
    assert lines["1"] == "- Toyota Corolla 2015 | 80,000 km | $9,000,000 🔥 18.2% subvaluado | Córdoba | /a/1"
    assert lines["4"].endswith("$3,000,000 🔥 10.0% subvaluado | Salta | /a/4")
    assert "subvaluado" not in lines["2"]
    assert lines["3"].startswith("- Ford Ka None | None km | $None")


def test_labels_equal_float_formatting(spark):
    from pyspark.sql import functions as F

    from autolake.functions.columns import tenths_percent_label
    got = spark.range(1000, 10001).select("id", tenths_percent_label(F.col("id") / 10000).alias("t")).collect()
    assert [r.t for r in got] == [f"{r.id / 10000 * 100:.1f}" for r in got]


def test_opportunity_lines(spark):
    lines = dict(rows(mk.opportunity_lines(mk.top_opportunities(_serving(spark), limite=10))))
    assert lines["1"].startswith("- Toyota Corolla 2015 | 80,000 km | Publicado: $9,000,000 | Estimado: $")
    assert " | Ahorro: $2,000,000 (18.2%) | Córdoba | /a/1" in lines["1"]


def test_top_board_feed(spark):
    s = _serving(spark)
    top = mk.top_opportunities(s, marca="toyota", limite=50).collect()
    assert [r.cod for r in top] == ["1", "5"] and top[0].ahorro == 2_000_000
    board = mk.opportunity_board(s).collect()
    assert [r.cod for r in board] == ["1", "5"]                   # > 0.10 drops exactly 0.1
    assert board[0].pct == 18 and board[0].url.startswith("https://")
    feed = mk.recent_feed(s).collect()
    assert feed[0].cod == "3"                                     # null scraped_at first on DESC
    facets = [tuple(r) for r in mk.facets(mk.recent_feed(s)).collect()]
    assert facets[:4] == [("marca", "Fiat"), ("marca", "Ford"), ("marca", "Toyota"), ("marca", "toyota")]


def test_table_filter_nulls_as_zero(spark):
    s = _serving(spark)
    p = mk.table_predicate(precio_max="8000000")
    assert rows(s.where(p), "cod") == [("2",), ("3",), ("4",), ("5",)]   # null price passes a max bound
    p = mk.table_predicate(anio_min="2000")
    assert ("3",) not in rows(s.where(p), "cod")                        # null year fails a min bound
    p = mk.table_predicate(search_text="ORO")
    assert rows(s.where(p), "cod") == [("1",)]
    c = mk.match_counter(s, mk.table_predicate(marca="Toyota")).first()
    assert (c.filtered, c.total) == (2, 5)


def test_user_sort_spanish_collation(spark):
    df = spark.createDataFrame([("1", "Zeta"), ("2", "Ñandú"), ("3", "Nube"), ("4", "árbol")], "cod string, marca string")
    order = [r.cod for r in mk.user_sort(df, "marca").collect()]
    assert order == ["4", "3", "2", "1"]                      # á with a, Ñ after N
    nums = spark.createDataFrame([("a", 5), ("b", None), ("c", 1)], "cod string, anio int")
    assert [r.cod for r in mk.user_sort(nums, "anio", ascending=False).collect()] == ["a", "c", "b"]


def test_relative_price_km_display_metrics(spark):
    s = _serving(spark)
    rel = dict(rows(mk.relative_price(s)))
    assert rel["1"] == 100.0 and rel["3"] == 0.0
    km = dict(rows(s.select("cod", mk.km_display(F.col("km")))))
    assert km == {"1": "80.000 km", "2": "—", "3": "—", "4": "150.000 km", "5": "—"}
    m = mk.market_metrics(s).first()
    assert (m.total_autos, m.total_oportunidades, str(m.ultima_fecha_scraping)) == (5, 2, "2026-07-02")
