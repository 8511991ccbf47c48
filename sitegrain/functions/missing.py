"""What counts as a missing value, by policy. Inside the engine only NULL is missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that stand for "missing", and how they are compared.
#   exact    the text as it is
#   lower    the trimmed, lower-cased text
#   either   the text as it is or lower-cased
POLICIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "qa": ("either", ("", "Not Found", "N/A", "nan", "None", "none", "ERROR", "N/A – Not Offered", "0", "not found", "n/a")),
    "patch": ("lower", ("", "not found", "n/a", "none", "error", "-")),
    "social": ("lower", ("", "not found", "n/a", "none", "false", "no", "blocked", "0")),
    "rating": ("exact", ("Not Found", "See Website", "See Profile", "Blocked", "ERROR", "", "N/A")),
    "dedup": ("exact", ("", "Not Found", "ERROR")),
    "bypass": ("lower", ("not found", "", "none", "n/a", "0")),
    "refresh": ("exact", ("", "Not Found", "ERROR")),
}


def is_missing(col: Column | str, policy: str = "qa") -> Column:
    """Whether a value is missing under a policy; NULL always is. Never NULL itself."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    mode, tokens = POLICIES[policy]
    if mode == "lower":
        hit = F.lower(F.trim(c)).isin(*tokens)
    elif mode == "either":
        hit = F.trim(c).isin(*tokens) | F.lower(F.trim(c)).isin(*tokens)
    else:
        hit = c.isin(*tokens)
    return c.isNull() | hit


def present(col: Column | str, policy: str = "qa") -> Column:
    """The value, or NULL where it is missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~is_missing(c, policy), c)


def whole_number(col: Column | str) -> Column:
    """A count out of loose text, truncated ("3.0" is 3); NULL if it isn't a number."""
    c = F.col(col) if isinstance(col, str) else col
    return F.expr("NULL").cast("long") if c is None else F.floor(F.abs(c.cast("string").try_cast("double"))).cast("long") * F.when(c.cast("string").try_cast("double") < 0, -1).otherwise(1)


def render(col: Column | str, empty: str = "Not Found") -> Column:
    """Text for the sink: NULL and blank become the given token."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(empty))
