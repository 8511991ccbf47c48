"""Before and after."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A row a key in both: ``before`` and ``after`` of the fields that improved, and how many did.

    Improved: it changed, and is neither empty nor 0 afterwards.
    """
    b = before.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"b_{f}") for f in fields])
    a = after.select(key, *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"a_{f}") for f in fields])
    rows = b.join(a, key)
    better = [F.when((F.col(f"a_{f}") != F.col(f"b_{f}")) & ~F.col(f"a_{f}").isin("", "0"), F.lit(f)) for f in fields]
    names = F.array_compact(F.array(*better))
    return rows.select(key, *[f"b_{f}" for f in fields], *[f"a_{f}" for f in fields], F.array_join(names, ", ").alias("improved"), F.size(names).alias("n_improved"))


def roster(rows: DataFrame, key: str, order: str = "pos", fields: tuple[str, ...] = ("doctor_name", "specialty", "associations")) -> DataFrame:
    """A row a key: its doctors' values in row order, joined by " | "."""
    own = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), *[F.coalesce(F.col(f), F.lit("")).alias(f) for f in fields])))
    rows = rows.groupBy(key).agg(own.alias("all"))
    joined = lambda f: F.array_join(F.transform("all", lambda x: x[f]), " | ").alias(f)
    return rows.select(key, F.size("all").alias("n"), *[joined(f) for f in fields])


def roster_diff(before: DataFrame, after: DataFrame, key: str, order: str = "pos", fields: tuple[str, ...] = ("doctor_name", "specialty", "associations")) -> DataFrame:
    """A row a key in both: the joined values before and after, whether anything changed, and "n → m"."""
    b, a = (roster(x, key, order, fields).select(key, *[F.col(c).alias(f"{p}_{c}") for c in ("n", *fields)]) for x, p in ((before, "b"), (after, "a")))
    changed = F.lit(False)
    for f in fields:
        changed = changed | (F.col(f"b_{f}") != F.col(f"a_{f}"))
    return b.join(a, key).withColumn("changed", changed).withColumn("count_change", F.concat(F.col("b_n").cast("string"), F.lit(" → "), F.col("a_n").cast("string")))
