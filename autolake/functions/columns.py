"""Column expressions shared by the operators. All are native Spark expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
YEAR_MIN = 1990              # lowest accepted model year
OPPORTUNITY_THRESHOLD = 0.10  # score above/at which a listing is an opportunity
REQUEST_YEAR_MAX = 2026      # upper year bound of an estimate request
NEW_CONDITION = "Nuevo"      # condition label of a new vehicle
FEATURED_HOUSES = ["blue", "oficial"]  # FX rates shown first on the panel
BLUE = "blue"                # FX house used as the macro feature
SPLIT_SEED = 42              # seed of the train/test split
TEST_FRACTION_HEX = "33"     # md5 prefix below this -> test (51/256 ~ 20 %)


def clip_lower(c: Column, lower: int = 1) -> Column:
    """max(c, lower) that keeps nulls null (bare greatest(null, 1) returns 1)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


def js_round(c: Column) -> Column:
    """Math.round: half rounds up (towards +inf)."""
    return F.floor(c + F.lit(0.5))


def thousands(c: Column, sep: str = ",") -> Column:
    """Integer with a thousands separator: 1234567 -> '1,234,567' (or '1.234.567')."""
    s = F.format_number(c, 0)
    return s if sep == "," else F.translate(s, ",", sep)


def contains_ci(c: Column, needle: str) -> Column:
    """Case-insensitive substring test; the needle is taken literally."""
    return F.contains(F.lower(c), F.lower(F.lit(needle)))


def tenths_percent_label(score: Column) -> Column:
    """'12.3' for a score of 0.1234: ``score * 100`` with one decimal, as a float is formatted:
    the exact binary value is rounded, half to even.

    From 8 percent on, the double times 2**49 is an integer, so the rounding is exact
    integer arithmetic (labels start at 10 percent)."""
    tenths = (score * 100 * F.lit(float(1 << 49))).cast("bigint") * 10
    q = F.shiftright(tenths, 49)
    r = tenths.bitwiseAND(F.lit((1 << 49) - 1))
    up = (r > 1 << 48) | ((r == 1 << 48) & (F.pmod(q, F.lit(2)) == 1))
    t = q + F.when(up, 1).otherwise(0)
    return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."),
                    F.pmod(t, F.lit(10)).cast("string"))


def unescape_html(c: Column) -> Column:
    """Character references decoded: the named ones of HTML 4, decimal and hexadecimal ones.
    Unknown references stay as they are; decoding happens once (``&amp;lt;`` gives ``&lt;``)."""
    named = F.create_map(*[F.lit(x) for name, point in sorted(name2codepoint.items()) for x in (name, chr(point))])
    utf32 = lambda digits: F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")
    char = lambda e: F.coalesce(
        F.try_element_at(named, e),
        F.when(e.rlike("^#[0-9]{1,7}$"), utf32(F.hex(F.substring(e, 2, 7).cast("bigint")))),
        F.when(e.rlike("^#[xX][0-9A-Fa-f]{1,6}$"), utf32(F.substring(e, 3, 6))),
        F.concat(F.lit("&"), e, F.lit(";")))
    found = F.array_distinct(F.regexp_extract_all(c, F.lit("&(#?[A-Za-z0-9]+);"), 1))
    ordered = F.concat(F.filter(found, lambda e: e != "amp"), F.filter(found, lambda e: e == "amp"))
    decoded = F.aggregate(ordered, c, lambda text, e: F.replace(text, F.concat(F.lit("&"), e, F.lit(";")), char(e)))
    return F.when(F.contains(c, F.lit("&")), decoded).otherwise(c)


def hash_split(key: Column, seed: int = SPLIT_SEED) -> Column:
    """'test' for ~20 % of keys, else 'train'; stable under any repartitioning."""
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 2)
    return F.when(h < F.lit(TEST_FRACTION_HEX), F.lit("test")).otherwise(F.lit("train"))
