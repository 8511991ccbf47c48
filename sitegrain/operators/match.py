"""Matching practices with records of registries and listings."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import overlap
from ..staging import staged

#: Parts that the people of a street number are dealt into.
SHARES = 16
LEVELS = ("organisation", "street_and_number", "number", "city")


def _words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def npi_people(records: DataFrame) -> DataFrame:
    """Registry records, flat: number, name, credential, practice address, organisation, taxonomy."""
    at = F.coalesce(F.element_at(F.filter("addresses", lambda a: a["address_purpose"] == "LOCATION"), 1), F.try_element_at("addresses", F.lit(1)))
    name = F.concat_ws(" ", F.initcap("basic.first_name"), F.initcap("basic.last_name"))
    return records.filter(F.coalesce(F.col("basic.status"), F.lit("A")) == "A").select("number", name.alias("person"), F.regexp_replace(F.coalesce("basic.credential", F.lit("")), r"\.", "").alias("credential"), at["address_1"].alias("street"), at["city"].alias("city"), at["state"].alias("state"), at["organization_name"].alias("organisation"), at["telephone_number"].alias("phone"), F.try_element_at("taxonomies", F.lit(1))["desc"].alias("taxonomy"))


def grams(text: Column, whole: bool = True) -> Column:
    """Distinct pieces of one to three letters of a text, or the one a word begins with: whatever a text contains shares its first piece with it."""
    if not whole:
        return F.left(text, F.lit(3))
    n = F.length(text)
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(at, lambda k: F.array(F.substring(text, k, F.lit(1)), F.substring(text, k, F.lit(2)), F.substring(text, k, F.lit(3))))))


def match_people(places: DataFrame, people: DataFrame, key: str = "idx", most_in_city: int = 15) -> DataFrame:
    """People of the best level that a place has any of.

    Levels: the organisation's name contains the place's; same street number
    and a word of the street; same number; all of the city if they are few.
    Each level is a join of its own by what it asks for equal (a piece of the
    name, number and word, number, a city of few), for the places that no level
    before has found anything for; no place meets all people of a large city.
    Only the places still open are written between levels. A city's number may
    have very many people and places, and every pair of them is a row: its
    people are dealt into ``SHARES`` that a place meets one by one, so that no
    task makes all rows of a number.
    """
    number = lambda c: F.regexp_extract(F.coalesce(F.col(c), F.lit("")), "^([0-9]+)", 1)
    long = lambda c: F.array_distinct(F.filter(_words(F.col(c)), lambda w: (F.length(w) > 3) & ~w.rlike("^[0-9]")))
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    area = ["c", "s"]
    p = people.select("number", "person", F.lower("city").alias("c"), F.upper("state").alias("s"), low("organisation").alias("org"), number("street").alias("no"), long("street").alias("words"))
    open_ = places.select(key, F.lower("city").alias("c"), F.upper("state").alias("s"), low("practice_name").alias("own"), number("street").alias("no"), long("street").alias("words"))
    few = p.groupBy(*area).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= most_in_city).select(*area)

    share = F.pmod(F.xxhash64("number"), F.lit(SHARES)).cast("int").alias("share")
    every = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share")

    def level(k: int, left: DataFrame) -> DataFrame:
        if k == 1:
            found = left.filter("own <> ''").withColumn("gram", grams(F.col("own"), False)).join(p.select(*area, "number", "person", "org", F.explode(grams(F.col("org"))).alias("gram")), [*area, "gram"]).filter(F.contains("org", F.col("own")))
        elif k == 2:
            asked = left.filter("no <> ''").select(key, *area, "no", F.explode("words").alias("word")).select("*", every)
            found = asked.join(p.select(*area, "no", "number", "person", share, F.explode("words").alias("word")).hint("merge"), [*area, "no", "word", "share"])
        elif k == 3:
            asked = left.filter("no <> ''").select(key, *area, "no", every)
            found = asked.join(p.select(*area, "no", "number", "person", share).hint("merge"), [*area, "no", "share"])
        else:
            found = left.select(key, *area).join(p.join(few, area, "left_semi").select(*area, "number", "person"), area)
        # a person who meets a place by several words is told once a registry row
        return found.groupBy(key, "number", "person").agg(F.lit(LEVELS[k - 1]).alias("match")) if k == 2 else found.select(key, "number", "person", F.lit(LEVELS[k - 1]).alias("match"))

    def answered(k: int, left: DataFrame) -> DataFrame:
        """The places that a level finds anybody for, without the pairs."""
        if k == 1:
            return level(1, left).select(key)
        if k == 2:
            return left.filter("no <> ''").select(key, *area, "no", F.explode("words").alias("word")).join(p.select(*area, "no", F.explode("words").alias("word")).distinct(), [*area, "no", "word"], "left_semi").select(key)
        return left.filter("no <> ''").join(p.select(*area, "no").distinct(), [*area, "no"], "left_semi").select(key)

    out = None
    for k in range(1, 5):
        found = level(k, open_)
        out = found if out is None else out.unionByName(found)
        if k < 4:
            open_ = staged(open_.join(answered(k, open_).distinct(), key, "left_anti"), f"open{k}")
    return out


def match_cards(places: DataFrame, cards: DataFrame, key: str = "idx", first: int = 8) -> DataFrame:
    """Of the first listing cards of each place, the one that shares most words with its name; the first of equals."""
    rows = places.select(key, "practice_name").join(cards.filter(F.col("pos") <= first), key)
    rows = rows.withColumn("score", overlap("practice_name", "title")).filter("score > 0")
    return rows.groupBy(key).agg(F.max_by(F.struct("title", "score", "pos"), F.struct(F.col("score"), -F.col("pos"))).alias("b")).select(key, "b.*")


def street_tokens_match(street: Column, other: Column) -> Column:
    """Whether any word of more than three letters of one address is in the other."""
    return F.exists(F.filter(_words(street), lambda w: F.length(w) > 3), lambda w: F.contains(F.lower(other), w))


def text_of_person(people: DataFrame, texts: DataFrame, key: list[str], name: str = "name", least: int = 30) -> DataFrame:
    """The first page text by order that speaks of a person's last name at some length."""
    from ..functions.names import last_name

    rows = people.join(texts, key).filter((F.length("text") > least) & F.contains(F.lower("text"), last_name(name)))
    return rows.groupBy(*key, name).agg(F.min_by("text", "page_ord").alias("text"))


def union_names(*cols: Column) -> Column:
    """Ordered union of name lists, without case."""
    all_ = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in cols])
    return F.aggregate(all_, F.array().cast("array<string>"), lambda out, n: F.when(F.exists(out, lambda o: F.lower(o) == F.lower(n)), out).otherwise(F.concat(out, F.array(n))))


def new_names(have: Column, found: Column) -> Column:
    """Names found that aren't there yet, without case."""
    low = F.transform(F.coalesce(have, F.array().cast("array<string>")), lambda n: F.lower(n))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda n: ~F.array_contains(low, F.lower(n)))


def call_once(rows: DataFrame, inputs: list[str], call, result: str = "string", name: str = "answer", batch: int = 64, memo: str | None = None, default=None) -> DataFrame:
    """Adds what a callable says of some columns, asked once for every distinct input (a model, a service); without one the column is NULL.

    ``call`` takes a list of tuples and returns a list of values. It runs in
    Arrow batches. A call that raises fails no task: its inputs are asked one
    by one, and those that raise get ``default``. With ``memo``, a folder all
    executors reach, answers are kept there and a later run asks only for what
    isn't among them; inputs that raised are asked again.
    """
    if call is None:
        return rows.withColumn(name, F.lit(None).cast(result))
    import pyarrow as pa
    from pyspark.errors import AnalysisException
    from pyspark.sql.types import StructType

    spark, asked, known = rows.sparkSession, rows.select(*inputs).distinct(), None
    schema = StructType(list(asked.schema.fields)).add(name, result)
    same = lambda p: functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{p}{c}")) for c in inputs])
    renamed = lambda df, p, *more: df.select(*[F.col(c).alias(f"{p}{c}") for c in inputs], *more)
    if memo is not None:
        try:
            known = spark.read.schema(schema).parquet(memo)
            asked = asked.join(renamed(known, "__known_"), same("__known_"), "left_anti")
        except AnalysisException:  # nothing is kept yet
            known = None

    def careful(values: list[tuple]) -> list[tuple]:
        try:
            return [(x, True) for x in call(values)]
        except Exception:  # noqa: BLE001  whatever a callable raises
            if len(values) == 1:
                return [(default, False)]
            return [t for v in values for t in careful([v])]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema).field(name).type
        for b in batches:
            values = list(zip(*(c.to_pylist() for c in b.columns)))
            told = [x for k in range(0, len(values), batch) for x in careful(values[k : k + batch])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([v for v, _ in told], kind), pa.array([ok for _, ok in told], pa.bool_())], names=[*inputs, name, "__ok"])

    told = asked.mapInArrow(run, StructType(list(schema.fields)).add("__ok", "boolean"))
    if memo is not None:
        told = staged(told, "answers")
        told.filter("__ok").drop("__ok").write.mode("append").parquet(memo)
        if known is not None:
            told = told.drop("__ok").unionByName(staged(known.join(renamed(told, "__told_"), same("__told_"), "left_anti").dropDuplicates(inputs), "known"))
    return rows.join(renamed(told, "__in_", name), same("__in_"), "left").drop(*[f"__in_{c}" for c in inputs])
