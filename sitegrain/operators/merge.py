"""Merging what several sources know, without losing known values.

Every "first" is a ``min_by`` on a position column: row order is data here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import is_missing, present, whole_number
from ..schema import COUNTS, FLAGS
from ..staging import staged


def first_value(value: Column, order: Column | str, policy: str) -> Column:
    """Aggregate: the first value by order that isn't missing."""
    o = F.col(order) if isinstance(order, str) else order
    return F.min_by(present(value, policy), F.when(~is_missing(value, policy), o))


def rollup(rows: DataFrame, key: str, fields: list[str], order: str = "pos", policy: str = "qa") -> DataFrame:
    """A row a key: the best value of every field, and the number of rows.

    Best: if the first value that isn't missing is a number, the largest number
    (the first of equals); else that first value. Missing tests and numbers are
    worked out once a row, before the aggregation.
    """
    known = rows.select(key, F.col(order).alias("__o"), *[present(F.col(f).cast("string"), policy).alias(f) for f in fields])
    known = known.select(key, "__o", *fields, *[whole_number(f).alias(f"__n_{f}") for f in fields])
    aggs = []
    for f in fields:
        aggs.append(F.min_by(F.struct(F.col(f).alias("v"), F.col(f"__n_{f}").isNotNull().alias("num")), F.when(F.col(f).isNotNull(), F.col("__o"))).alias(f"__f_{f}"))
        aggs.append(F.max_by(F.col(f), F.when(F.col(f"__n_{f}").isNotNull(), F.struct(F.col(f"__n_{f}"), -F.col("__o")))).alias(f"__m_{f}"))
    out = known.groupBy(key).agg(*aggs, F.count(F.lit(1)).alias("row_count"))
    return out.select(key, *[F.when(F.col(f"__f_{f}.num"), F.col(f"__m_{f}")).otherwise(F.col(f"__f_{f}.v")).alias(f) for f in fields], "row_count")


def template(rows: DataFrame, key: str, fields: list[str], order: str = "pos", keep: tuple[str, ...] = (), policy: str = "dedup") -> DataFrame:
    """A row a key: the first row, its missing fields filled from later rows; the ``keep`` fields stay as the first has them."""
    return rows.groupBy(key).agg(*[(F.min_by(f, order) if f in keep else first_value(F.col(f), order, policy)).alias(f) for f in fields])


def monotone(rows: DataFrame, key: list[str], flags: list[str] = FLAGS, counts: list[str] = COUNTS, mentions: tuple[str, ...] = ("dental_plan",), others: tuple[str, ...] = ("hygienists", "testimonials")) -> DataFrame:
    """Never reduce: flags by or, counts by maximum, "Mentioned" by or, over all sources of a key.

    On typed values this is commutative, associative and idempotent, so the
    sources may come in any order, any number of times, and in batches.
    """
    have = set(rows.columns)
    aggs = [F.max(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags if f in have]
    aggs += [F.max(F.coalesce(whole_number(c), F.lit(0))).cast("long").alias(c) for c in [*counts, *others] if c in have]
    aggs += [F.when(F.max(F.coalesce(F.col(m), F.lit("")) == "Mentioned"), F.lit("Mentioned")).otherwise(F.lit("")).alias(m) for m in mentions if m in have]
    return rows.groupBy(*key).agg(*aggs)


def fill_last(left: DataFrame, source: DataFrame, key: str, column: str, order: str = "pos", policy: str = "dedup") -> DataFrame:
    """Blank cells of a column filled by key; of several, the last source row that isn't blank. Adds ``filled``: filled, no_match or skipped."""
    ok = ~is_missing(F.trim(column), policy)
    last = source.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.when(ok, F.trim(column)), F.when(ok, F.col(order))).alias("__v"))
    rows = left.join(last, F.col(key) == F.col("__k"), "left")
    blank = is_missing(F.trim(column), policy)
    told = F.when(~blank, F.lit("skipped")).when(F.col("__v").isNull(), F.lit("no_match")).otherwise(F.lit("filled"))
    return rows.select(*[F.when(blank, F.col("__v")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in left.columns], told.alias("filled"))


def fill_where(left: DataFrame, found: DataFrame, key: list[str], columns: list[str], where: Column | None = None, policy: str = "patch", empty: str | None = None) -> DataFrame:
    """Missing cells take what was found (and a token where nothing was); cells that are there stay. where: rows that may change."""
    renamed = found.select(*key, *[F.col(c).alias(f"__new_{c}") for c in columns])
    rows = left.join(renamed, key, "left")
    may = F.lit(True) if where is None else where
    new = lambda c: F.coalesce(present(F.col(f"__new_{c}"), policy), F.lit(empty), F.col(c)) if empty is not None else F.coalesce(present(F.col(f"__new_{c}"), policy), F.col(c))
    return rows.select(*[F.when(is_missing(F.col(c), policy) & may, new(c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in left.columns])


def fill_empty(*sources: DataFrame, key: list[str], policy: str = "bypass") -> DataFrame:
    """Sources in order of trust: each field from the first that knows it."""
    fields = [c for c in sources[0].columns if c not in key]
    rows = None
    for k, s in enumerate(sources):
        own = s.select(*key, F.lit(k).alias("__rank"), *[F.col(c).cast("string").alias(c) if c in s.columns else F.lit(None).cast("string").alias(c) for c in fields])
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy(*key).agg(*[first_value(F.col(c), "__rank", policy).alias(c) for c in fields])


def back_join(rows: DataFrame, group: Column, found: DataFrame, found_key: str, columns: list[str]) -> DataFrame:
    """What was found once a group goes to every row of it."""
    own = found.select(F.col(found_key).alias("__g"), *[F.col(c).alias(f"__f_{c}") for c in columns])
    rows = rows.withColumn("__key", group).join(own, F.col("__key") == F.col("__g"), "left")
    return rows.select(*[c for c in rows.columns if not c.startswith("__") and c not in columns], *[F.coalesce(f"__f_{c}", c).alias(c) if c in rows.columns else F.col(f"__f_{c}").alias(c) for c in columns])


def groups(rows: DataFrame, group: Column, order: str) -> DataFrame:
    """A row a group: its first row's columns and how many rows it has; what is looked up once is looked up here."""
    return rows.withColumn("group_key", group).groupBy("group_key").agg(F.min_by(F.struct(*rows.columns), order).alias("first"), F.count(F.lit(1)).alias("rows")).select("group_key", "first.*", "rows")


def override(rows: DataFrame, key: str, column: str, values: dict) -> DataFrame:
    """Given values replace a column's; a given None forces it to be missing."""
    if not values:
        return rows
    have = F.array(*[F.lit(k) for k in values])
    table = F.create_map(*[F.lit(x) for k, v in values.items() if v is not None for x in (k, v)]) if any(v is not None for v in values.values()) else None
    new = F.try_element_at(table, F.col(key)) if table is not None else F.lit(None)
    return rows.withColumn(column, F.when(F.array_contains(have, F.col(key)), new.cast(rows.schema[column].dataType)).otherwise(F.col(column)))


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows of keys that are in ``new`` are replaced by it; other keys keep theirs."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


#: Rows of a range that one task numbers, at most about.
RANGE_ROWS = 1 << 19


def runs(rows: DataFrame, value: str, order: str = "pos") -> DataFrame:
    """Rows in a row with the same value: ``run`` numbers them, so a value that comes again later is another run.

    Gaps and islands: rows of a value are in one run as long as their positions
    follow each other. A value may have a third of all rows, so rows are dealt
    by ranges of value and position, numbered in each range, and the numbers of
    the ranges before come on top (a row a range and value). A run's begin is
    aggregated and joined back, as a run may be as long.
    """
    from pyspark.sql import Window

    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    ranged = staged(rows.repartitionByRange(parts, value, order).withColumn("__range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("__value").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range", F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("n")).select("__range", "__value", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range", value).orderBy(order)
    local = ranged.withColumn("__row", F.row_number().over(inside)).alias("r").join(totals.alias("t"), (F.col("r.__range") == F.col("t.__range")) & F.col(value).eqNullSafe(F.col("__value")))
    numbered = local.select("r.*", (F.col(order) - (F.col("__row") + F.col("__before"))).alias("__gap"))
    first = numbered.groupBy(F.col(value).alias("__value"), F.col("__gap").alias("__of")).agg(F.min(order).alias("run"))
    return numbered.join(first, F.col(value).eqNullSafe(F.col("__value")) & F.col("__gap").eqNullSafe(F.col("__of"))).select(*rows.columns, "run")
