"""DuckDB SQL for the fixture views (FIXTURES.md), used to build the oracle queries.

Each view is a CTE body; ``with_views`` prepends the views a query needs, in
dependency order. These strings are only for the side-by-side check: the Spark
side is built with the DataFrame API in ``fixtures`` and the operators.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[list[str], str]] = {}

VIEWS["listings"] = ([], """
select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as cod,
       p_brand as marca, p_name as modelo,
       case when l_returnflag = 'N' then 'Nuevo' else 'Usado' end as condicion,
       n_name as provincia,
       case when l_discount = 0.0 then cast(0 as bigint)
            else cast(floor(l_extendedprice * 100) as bigint) end as precio_ars,
       cast(year(l_shipdate) - (p_size % 10) + (case when l_tax = 0.08 then 3 else 0 end) as int) as anio,
       case when l_quantity = 1 then cast(0 as bigint) when l_quantity = 2 then cast(1 as bigint)
            else cast(l_quantity * 3000 as bigint) end as km,
       '/vendo/' || replace(p_brand, ' ', '-') || '/' || replace(p_name, ' ', '-') || '/' ||
         case when l_returnflag = 'N' then 'Nuevo' else 'Usado' end || '/' || n_name ||
         '?cod=' || cast(l_orderkey * 10 + l_linenumber as varchar) as path,
       cast(l_linenumber % 3 as tinyint) as segmento,
       case when l_linestatus = 'F' then 'a' else 'b' end as source,
       cast(l_shipdate as date) as scraped_day,
       row_number() over (partition by l_orderkey, l_linenumber
         order by l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                  l_discount, l_tax, l_returnflag, l_linestatus) as pos
from lineitem
join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey""")

VIEWS["raw_listings"] = (["listings"], """
select cod, marca, modelo, condicion, provincia, cast(precio_ars as varchar) as precio_ars,
       case when anio % 11 = 0 then 's/d' else cast(anio as varchar) end as anio,
       case when km > 0 and km % 21000 = 0 then 'consultar' else cast(km as varchar) end as km,
       cast(segmento as varchar) as segmento, path as url, source from listings""")

VIEWS["silver"] = (["listings"], """
select cod, marca, modelo, condicion, provincia, path, segmento, source, scraped_day,
       nullif(precio_ars, 0) as precio_ars,
       case when anio < 1990 or anio > 2001 then null else anio end as anio,
       case when km = 0 and condicion <> 'Nuevo' then null else km end as km
from listings where pos = 1""")

VIEWS["fx"] = ([], """
select cast(o_orderdate as date) as fecha,
       case substr(o_orderpriority, 1, 1) when '1' then 'blue' when '2' then 'oficial' when '3' then 'mep'
            when '4' then 'ccl' else 'cripto' end as casa,
       min(o_totalprice) / 100 as compra, max(o_totalprice) / 100 as venta
from orders group by 1, 2""")

VIEWS["fx_silver"] = (["fx"], """
select fecha, casa, 'Dolar ' || casa as nombre, compra, venta,
       cast(fecha as varchar) || 'T12:00:00+00:00' as fetched_at
from fx""")

VIEWS["gold"] = (["silver", "fx"], """
with f as (select *, km > 1 as km_valido from silver where precio_ars is not null),
     m as (select marca, median(km) as km_med from f where km_valido group by marca)
select f.cod, f.marca, f.modelo, f.provincia, f.anio, 2001 - f.anio as antiguedad,
       case when f.km_valido then cast(f.km as double) else m.km_med end as km, f.km_valido,
       case when f.anio is null then null
            else (case when f.km_valido then cast(f.km as double) else m.km_med end)
                 / greatest(2001 - f.anio, 1) end as km_por_anio,
       b.venta as dolar_blue_venta, f.precio_ars
from f left join m on f.marca = m.marca
left join (select fecha, venta from fx where casa = 'blue') b on f.scraped_day = b.fecha""")

VIEWS["scored"] = (["silver"], """
select s.*, cast(round_even(m.med, 0) as bigint) as precio_estimado,
       -- a zero score is +0.0 (no signed zero)
       round_even((cast(round_even(m.med, 0) as bigint) - s.precio_ars)
              / cast(nullif(round_even(m.med, 0), 0) as double), 4) + 0.0 as oportunidad_score
from (select * from silver where precio_ars is not null) s
join (select marca, modelo, median(precio_ars) as med from silver
      where precio_ars is not null group by marca, modelo) m
  on s.marca = m.marca and s.modelo = m.modelo""")

VIEWS["serving"] = (["silver", "scored"], """
select s.cod, s.marca, s.modelo, s.condicion, s.provincia, s.precio_ars, s.anio, s.km, s.path as url,
       s.segmento, s.source, s.scraped_day as fecha, s.scraped_day as scraped_at,
       c.precio_estimado, c.oportunidad_score
from silver s left join (select cod, precio_estimado, oportunidad_score from scored) c on s.cod = c.cod""")

VIEWS["blue"] = (["fx"], "select fecha, venta from fx where casa = 'blue'")

VIEWS["requests"] = ([], """
select p_partkey as req_id, p_brand as marca, p_name as modelo, n_name as provincia,
       cast(1985 + p_size as int) as anio,
       case when p_partkey % 10 = 0 then -1 else p_partkey * 100 end as km
from part join nation on p_partkey % 25 = n_nationkey""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in VIEWS[n][0]:
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <views needed>, <extra ctes> <body>``."""
    ctes = [f"{n} as ({VIEWS[n][1]})" for n in _order(names)]
    ctes += [f"{n} as ({sql})" for n, sql in (extra or [])]
    return "with " + ",\n".join(ctes) + "\n" + body
