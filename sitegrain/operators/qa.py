"""Quality analysis of a batch: scores, status, thresholds, and the five reports.

Input is one row a practice (``operators.merge.rollup``). Field checks run over
one unpivoted array a row; the only shuffle is the scalar threshold and the
small group-bys of the reports. A field that the input has no column of is
missing everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formats import percent
from ..functions.missing import is_missing
from ..functions.names import bad_reason
from ..schema import HEADERS, QA_SPEC

#: Of a practice with a website that was never reached, these are missing, and all technology and services.
REACHED = ("email", "google_rating", "google_reviews", "specialty", "associations")
SCORED = ("critical", "important", "optional")


def _value(rows: DataFrame, field: str) -> Column:
    return F.col(field) if field in rows.columns else F.lit(None).cast("string")


def _missing(rows: DataFrame, names: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(is_missing(_value(rows, f)), F.lit(f)) for f in names]))


def score(rows: DataFrame, spec=QA_SPEC) -> DataFrame:
    """Adds missing lists a tier, ``tech_any``, ``service_any``, ``fill`` (per cent) and ``status``."""
    by = lambda *tiers: [f for f, t in spec if t in tiers]
    any_of = lambda names: F.greatest(*[~is_missing(_value(rows, f)) for f in names], F.lit(False), F.lit(False))
    out = rows.withColumns({**{f"{t}_missing": _missing(rows, by(t)) for t in SCORED}, "tech_any": any_of(by("tech")), "service_any": any_of(by("service"))})
    scored = by(*SCORED)
    gone = F.size("critical_missing") + F.size("important_missing") + F.size("optional_missing")
    unreached = ~is_missing(_value(rows, "website")) & ~F.col("tech_any") & ~F.col("service_any")
    for f in REACHED:
        unreached = unreached & is_missing(_value(rows, f))
    status = (
        F.when(unreached, F.lit("NOT SCRAPED"))
        .when(F.size("critical_missing") > 0, F.lit("FAIL"))
        .when((F.size("important_missing") >= 2) | ~F.col("tech_any") | ~F.col("service_any"), F.lit("REVIEW"))
        .otherwise(F.lit("PASS"))
    )
    return out.withColumn("fill", percent(F.lit(len(scored)) - gone, F.lit(len(scored)))).withColumn("status", status)


def threshold(scored: DataFrame) -> DataFrame:
    """One row: below which fill a practice has low data; 40 for fewer than five, else mean less one sample deviation, 20 at least."""
    n = F.count(F.lit(1))
    return scored.agg(F.when(n < 5, F.lit(40.0)).otherwise(F.greatest(F.lit(20.0), F.avg("fill") - F.stddev_samp("fill"))).alias("low_threshold"))


def _told(*flags: Column) -> Column:
    """Flags joined by " | "; a dash for none."""
    return F.coalesce(F.nullif(F.concat_ws(" | ", *flags), F.lit("")), F.lit("—"))


def flagged(scored: DataFrame) -> DataFrame:
    """Adds ``low``, ``no_website`` and ``flags`` (LOW DATA, NOT SCRAPED, NO WEBSITE). The threshold is one row.

    The scores are worked out twice, for the threshold and for the flags; a
    caller that wants to save that writes them out first.
    """
    rows = scored.crossJoin(F.broadcast(threshold(scored)))
    low = (F.col("fill") < F.col("low_threshold")) & (F.col("status") != "NOT SCRAPED")
    rows = rows.withColumn("low", low).withColumn("no_website", is_missing(_value(scored, "website")))
    return rows.withColumn("flags", _told(*_flags()))


def _flags() -> list[Column]:
    return [F.when(F.col("low"), F.lit("LOW DATA")), F.when(F.col("status") == "NOT SCRAPED", F.lit("NOT SCRAPED")), F.when(F.col("no_website"), F.lit("NO WEBSITE"))]


def status_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("status").agg(F.count(F.lit(1)).alias("practices"))


def bad_names(doctors: DataFrame, key: str, name: str = "doctor_name", order: str = "pos") -> DataFrame:
    """Distinct suspect names a practice, with the reason, in the order in which they first come."""
    own = F.trim(F.coalesce(F.col(name), F.lit("")))
    rows = doctors.select(key, own.alias(name), F.col(order).alias("first")).groupBy(key, name).agg(F.min("first").alias("first"))
    return rows.withColumn("reason", bad_reason(name)).filter("reason IS NOT NULL")


def _quoted(name: Column) -> Column:
    """A text in single quotes; in double quotes if it holds single ones only."""
    single, double = F.contains(name, F.lit("'")), F.contains(name, F.lit('"'))
    return F.when(single & ~double, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(name, F.lit("'"), F.lit("\\'")), F.lit("'")))


def issues(flags: DataFrame, doctors: DataFrame, key: str = "idx", name: str = "doctor_name", order: str = "pos", most: int = 3) -> DataFrame:
    """Practices that don't pass, have low data or suspect names (empty ones apart); up to four optional fields and three names (with repeats) are told.

    The three first names are the smallest three by row order; each row's are
    added up before the shuffle as an array of three at most.
    """
    rows = doctors.select(key, F.col(order).alias("__o"), F.trim(F.coalesce(F.col(name), F.lit(""))).alias("__n")).withColumn("__r", bad_reason("__n"))
    rows = rows.filter(F.col("__r").isNotNull() & (F.col("__r") != "Empty / Not Found"))
    told = F.concat(_quoted(F.col("__n")), F.lit(" ("), F.col("__r"), F.lit(")"))
    ranked = rows.select(key, "__o", told.alias("__t"))
    first = ranked.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy("__o"))).filter(F.col("__k") <= most)
    counts = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("bad"))
    texts = first.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__k", "__t"))), lambda x: x["__t"]), "; ").alias("bad_names"))
    out = flags.join(counts.join(texts, key), key, "left").withColumn("bad", F.coalesce("bad", F.lit(0)))
    out = out.filter((F.col("status") != "PASS") | F.col("low") | (F.col("bad") > 0))
    heads = F.create_map(*[F.lit(x) for kv in HEADERS.items() for x in kv])
    listed = lambda c: F.coalesce(F.nullif(F.array_join(F.transform(c, lambda f: F.coalesce(heads[f], f)), ", "), F.lit("")), F.lit("—"))
    mark = lambda c: F.when(F.col(c), F.lit("✓")).otherwise(F.lit("✗ None"))
    return out.select(
        key, "status", F.concat(F.col("fill").cast("string"), F.lit("%")).alias("fill"), _told(*_flags(), F.when(F.col("bad") > 0, F.lit("BAD NAMES"))).alias("flags"),
        listed(F.col("critical_missing")).alias("critical"), listed(F.col("important_missing")).alias("important"), listed(F.slice("optional_missing", 1, 4)).alias("optional"),
        mark("tech_any").alias("tech"), mark("service_any").alias("services"), F.coalesce("bad_names", F.lit("—")).alias("bad_names"),
    )


def unpivoted(rows: DataFrame, spec=QA_SPEC) -> DataFrame:
    """``field, tier, filled, has_site`` for every practice and field."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("tier"), (~is_missing(_value(rows, f))).alias("filled")) for f, t in spec])
    return rows.select((~is_missing(_value(rows, "website"))).alias("has_site"), F.explode(cells).alias("c")).select("has_site", "c.*")


def field_stats(rows: DataFrame, spec=QA_SPEC) -> DataFrame:
    """A row a field: fill over all practices and over those with a website, the gap (with a website, without the field), and a grade (80 Good, 50 Review, else Low)."""
    per = unpivoted(rows, spec).groupBy("field", "tier").agg(F.count(F.lit(1)).alias("n"), F.count_if("filled").alias("filled"), F.count_if("has_site").alias("n_site"), F.count_if(F.col("filled") & F.col("has_site")).alias("filled_site"))
    per = per.withColumn("rate", percent(F.col("filled"), F.col("n"))).withColumn("rate_site", percent(F.col("filled_site"), F.col("n_site")))
    return per.withColumn("gap", F.col("n_site") - F.col("filled_site")).withColumn("grade", F.when(F.col("rate") >= 80, F.lit("Good")).when(F.col("rate") >= 50, F.lit("Review")).otherwise(F.lit("Low")))


def missing_data(stats: DataFrame) -> DataFrame:
    """The report of gaps: every scored, technology and service field, and what its gap says."""
    told = F.when(F.col("gap") > 0, F.concat(F.col("gap").cast("string"), F.lit(" practices have website but field is empty"))).otherwise(F.lit("—"))
    return stats.filter("tier <> 'info'").select("field", "tier", "filled", "n", "rate", "filled_site", "n_site", "rate_site", told.alias("gap"))


def lowest(stats: DataFrame, k: int = 6, spec=QA_SPEC) -> DataFrame:
    """The fields that are filled least, the first of equals; no information fields."""
    place = F.array_position(F.array(*[F.lit(f) for f, _ in spec]), F.col("field"))
    return stats.filter("tier <> 'info'").orderBy(F.col("filled") / F.col("n"), place).limit(k).select("field", "rate")


def cell(value: Column, tier: str) -> Column:
    """What a report shows: a number above 0 as a whole number, other numbers and texts of more than 20 characters as a tick, short texts as they are; missing ones by tier."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    known = F.when(number >= 1, F.floor(number).cast("string")).when(number.isNotNull() | (F.length(text) > 20), F.lit("✓")).otherwise(text)
    return F.when(is_missing(value), F.lit("✗" if tier in SCORED else "–")).otherwise(known)
