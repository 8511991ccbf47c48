"""How values are written out, and strings to look things up with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compact(n: Column | str) -> Column:
    """1234 as "1.2K", 2500000 as "2.5M", half to even; smaller numbers as they are."""
    c = _col(n).cast("double")
    tenth = lambda x: F.format_string("%.1f", F.bround(x, 1))
    return F.when(c >= 1_000_000, F.concat(tenth(c / 1_000_000), F.lit("M"))).when(c >= 1000, F.concat(tenth(c / 1000), F.lit("K"))).otherwise(c.cast("long").cast("string"))


def from_compact(text: Column | str) -> Column:
    """"12.3K" as 12300; NULL if it isn't a number."""
    t = F.upper(F.regexp_replace(_col(text), "[, ]", ""))
    number = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)[KMB]?$", 1).try_cast("double")
    unit = F.when(t.endswith("K"), 1e3).when(t.endswith("M"), 1e6).when(t.endswith("B"), 1e9).otherwise(1.0)
    return F.round(number * unit).cast("long")


def percent(part: Column, whole: Column) -> Column:
    """Whole per cent, half to even; 0 of nothing."""
    return F.when(whole > 0, F.bround(part * 100.0 / whole, 0)).otherwise(0.0).cast("long")


def title(text: Column | str) -> Column:
    """Every run of letters with a capital first ("o'brien" as "O'Brien")."""
    held = F.replace(F.lower(_col(text)), F.lit(" "), F.lit("\x02"))  # initcap parts words at spaces alone
    marked = F.initcap(F.regexp_replace(held, r"(\p{L}+)", " $1 "))
    return F.replace(F.replace(marked, F.lit(" "), F.lit("")), F.lit("\x02"), F.lit(" "))


BUSINESS_SUFFIX = r"(?i)[, ]+(?:llc|inc|pa|pc|pllc|dds|dmd|ltd|corp)\.?$"


def without_suffix(name: Column | str) -> Column:
    """A business name without its legal or professional ending."""
    return F.trim(F.regexp_replace(_col(name), BUSINESS_SUFFIX, ""))


def lookup_text(*cols: Column | str) -> Column:
    """A search string: the parts that are there, by single spaces. The name has to be among them."""
    parts = [F.nullif(F.trim(_col(c)), F.lit("")) for c in cols]
    return F.regexp_replace(F.concat_ws(" ", *parts), " +", " ")
