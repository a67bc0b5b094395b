"""Extraction from HTML, edge cases the reference leaves untested."""

from __future__ import annotations

from pyspark.sql import functions as F

from autolake.operators import pages as pg
from tests.conftest import rows


def test_links_and_difference(spark):
    pages = spark.createDataFrame([(0, '<a href="/vendo/A/B/Usado/C?cod=1">x</a> <a href="/vendo/A/B/Usado/C?cod=1">'),
                                   (1, "<a href='/vendo/A/D/Usado/C?cod=2'>y</a><a href=\"/ayuda\">")],
                                  "seg int, html string")
    links = pg.extract_links(pages, keep=["seg"])
    assert rows(links) == [(0, "/vendo/A/B/Usado/C?cod=1"), (1, "/vendo/A/D/Usado/C?cod=2")]
    seen = spark.createDataFrame([(0, "/vendo/A/B/Usado/C?cod=1")], "seg int, link string")
    fresh, seen2 = pg.new_links(links, seen, ["seg", "link"])
    assert rows(fresh) == [(1, "/vendo/A/D/Usado/C?cod=2")]
    assert seen2.count() == 2


def test_parse_path(spark):
    df = spark.createDataFrame([("/vendo/Volkswagen/Gol-Trend/Usado/Buenos-Aires?cod=123",),
                                ("/vendo/A/B/Usado-Certificado/C?cod=9&x=1",),
                                ("/vendo/A/B/C?cod=1",), ("x/vendo/A/B/U/C?cod=1",)], "path string")
    out = pg.parse_listing_path(df).select("marca", "modelo", "condicion", "provincia", "cod").collect()
    assert [tuple(r) for r in out] == [("Volkswagen", "Gol Trend", "Usado", "Buenos Aires", "123"),
                                       ("A", "B", "Usado-Certificado", "C", "9")]


def test_hidden_inputs(spark):
    def page(p, a, k):
        return (f'<input type="hidden" name="precio" value="{p}"><input name="anio" x value="{a}">'
                f'<input name="kilometraje" id="k" value="{k}">')
    df = spark.createDataFrame([("ok", page("0", "2010", "5")), ("empty", page("", "2010", "5")),
                                ("bad", page("12a", "2010", "5")), ("missing", '<input name="precio" x value="1">')],
                               "id string, html string")
    out = pg.hidden_inputs(df)
    assert rows(out, "id", "precio_ars", "anio", "km") == [("ok", 0, 2010, 5)]


def test_cards(spark):
    def card(slug, title, sub, body, footer=True):
        f = '<span class="a footerInfo b">Córdoba</span>' if footer else ""
        s = f"<p>{sub}</p>" if sub is not None else ""
        return f'<a href="/ar/venta/{slug}/" class="c"><h3>{title}</h3>{s}<div>{body}</div>{f}</a>'
    html = "".join([
        '<a href="/ar/usados/x">menu</a>',
        card("toyota-etios-1", "Toyota • Etios", "2019 • 54.000 km • 1.5 • Manual", "$ 12.500.000 $ 11.900.000"),
        card("fiat-uno-2", "Fiat • Uno", "s/d • n/a km", "Cuota 150.000 $ 2.300.000", footer=False),
        card("nope-3", "Solo", "2019 • 1 km", "$ 9.000.000"),               # title with one part: dropped
        card("cheap-4", "Kia • Rio", "2019 • 1 km", "$ 900.000"),           # no amount >= 1e6: dropped
        card("nosub-5", "Ford • Ka", None, "$ 3.000.000"),
    ])
    cards = pg.split_cards(spark.createDataFrame([(html,)], "html string"))
    assert cards.count() == 5
    out = {r.cod: r for r in pg.parse_cards(cards, "https://site.b").collect()}
    assert set(out) == {"b-toyota-etios-1", "b-fiat-uno-2", "b-nosub-5"}
    t = out["b-toyota-etios-1"]
    assert (t.marca, t.modelo, t.anio, t.km, t.precio_ars, t.provincia) == ("Toyota", "Etios", 2019, 54000,
                                                                            11900000, "Córdoba")
    assert t.url == "https://site.b/ar/venta/toyota-etios-1/" and (t.segmento, t.source) == (0, "b")
    f = out["b-fiat-uno-2"]
    assert (f.anio, f.km, f.precio_ars, f.provincia) == (None, 0, 2300000, "")
    n = out["b-nosub-5"]
    assert (n.anio, n.km) == (None, 0)


def test_cards_of_real_html(spark):
    """Single quotes, character references, absolute links and numbers beyond their type."""
    html = ("<a class='c' href='/ar/venta/c4-1/'><h3>Citro&euml;n &bull; C4 &amp;lt; &#x41;&#66;</h3><p>99999999999 &bull; 1.000 km</p>"
            "<b>$ 5.000.000</b><span class='footerInfo'>C&oacute;rdoba</span></a>"
            '<a href="https://other.site/ar/venta/k-2/"><h3>Kia • Rio</h3><p>2019 • 99999999999999999999 km</p>'
            "<b>$ 2.000.000</b><b>9.999.999.999.999.999.999.999</b></a>")
    out = {r.cod: r for r in pg.parse_cards(pg.split_cards(spark.createDataFrame([(html,)], "html string")), "https://site.b").collect()}
    c, k = out["b-c4-1"], out["b-k-2"]
    assert (c.marca, c.modelo, c.anio, c.km, c.precio_ars, c.provincia, c.url) == (
        "Citroën", "C4 &lt; AB", None, 1000, 5_000_000, "Córdoba", "https://site.b/ar/venta/c4-1/")
    assert (k.anio, k.km, k.precio_ars, k.url) == (2019, 0, 2_000_000, "https://other.site/ar/venta/k-2/")


def test_first_seen_keeps_repeats_in_first_brand(spark):
    cards = spark.createDataFrame([("c1", 0, "x"), ("c1", 0, "x2"), ("c1", 1, "y"), ("c2", 1, "z")],
                                  "cod string, brand_ord int, v string")
    out = pg.first_seen(cards)
    assert rows(out, "cod", "v") == [("c1", "x"), ("c1", "x2"), ("c2", "z")]


def test_regex_patterns_have_no_lookaround():
    for p in (pg.LISTING_LINK, pg.LISTING_PATH, pg.CARD_ANCHOR, pg.AMOUNT, pg.FOOTER_SPAN):
        assert "(?=" not in p and "(?!" not in p and "(?<" not in p
    assert F is not None
