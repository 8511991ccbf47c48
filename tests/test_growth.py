"""What a row costs and over how many tasks rows are dealt."""

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sitegrain import session, staging
from sitegrain.functions import html, names, people, text, tree
from sitegrain.operators import features, match, merge
from sitegrain.plans import catalog, pipelines


def test_a_narrow_table_is_dealt_over_tasks(spark, monkeypatch, tmp_path):
    """One row group is one task, however many rows it has."""
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    spark.range(2000).selectExpr("id AS c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = catalog.load(spark, str(tmp_path), "customer")
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) == 4 and sum(held) == 2000 and max(held) < 700


def plan(spark, make):
    """An expression of the text ``upper(marker)``, resolved."""
    rows = spark.createDataFrame([], "marker string, name string, text string, elements array<struct<pre:int,last:int,depth:int,tag:string,cls:string,start:int,stop:int>>")
    return rows.select(make(F.upper("marker")).alias("x"))._jdf.queryExecution().analyzed().toString().split("\n")[0]


@pytest.mark.parametrize("make", [
    text.decode_hidden_email, lambda c: text.any_keyword(c, ["a", "b"]), lambda c: text.keyword_sum(c, ["a", "b"]), names.is_found_name, lambda c: names.in_host("name", c), people.is_hint, lambda c: tree.heading_of(tree.tree(), c),
    features.associations,
])
def test_a_text_is_made_once(spark, make):
    """What a lambda function doesn't take is worked out again for every element: no text may be made inside one."""
    told = plan(spark, make)
    assert told.count("upper(marker") == 1 and "upper(marker" not in told.split("lambdafunction", 1)[1]


def test_codes_of_a_text_are_met_once(spark):
    """The codes present are found before the rules are gone through, not for every rule."""
    assert "array_contains(concat(" not in plan(spark, features.associations)


def test_a_phrase_is_padded_once(spark):
    assert "lambdafunction(contains(concat(" not in plan(spark, features.specialty_phrase)


def test_no_task_makes_all_pairs_of_a_number(spark):
    """Everybody of a city has one street number: pairs are dealt over tasks, and none is lost."""
    places = spark.range(60).selectExpr("id AS idx", "concat('Practice ', id) AS practice_name", "'7 Oak St' AS street", "'X' AS city", "'TX' AS state")
    people_ = spark.range(400).selectExpr("cast(id AS string) AS number", "'p' AS person", "'x' AS city", "'tx' AS state", "'7 Elm St' AS street", "'' AS organisation")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        told = match.match_people(places, people_).groupBy(F.spark_partition_id()).agg(F.count_distinct("idx", "number").alias("pairs"), F.count(F.lit(1)).alias("rows"), F.min("match").alias("a"), F.max("match").alias("z")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.pairs for r in told) == sum(r.rows for r in told) == 60 * 400 and {r.a for r in told} == {r.z for r in told} == {"number"}
    assert max(r.rows for r in told) < 60 * 400 * 0.6


def test_runs_of_one_value_are_numbered_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(merge, "RANGE_ROWS", 40)
    rows = spark.range(1000).selectExpr("cast(if(id % 37 = 0, null, 'v') AS string) AS v", "id * 2 - id % 5 AS pos").union(spark.range(3).selectExpr("'v'", "cast(null AS bigint)"))
    w = Window.partitionBy("v").orderBy("pos")
    old = rows.withColumn("gap", F.col("pos") - F.row_number().over(w)).withColumn("run", F.min("pos").over(Window.partitionBy("v", "gap"))).drop("gap")
    made = merge.runs(rows, "v")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(made.collect(), key=key) == sorted(old.collect(), key=key)
    assert "windowspecdefinition(v#" not in made._jdf.queryExecution().analyzed().toString()


def test_pages_are_parsed_in_portions():
    """A batch of large pages isn't held parsed as a whole."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["x" * 60, None, "y" * 50, "z" * 500, "", "w"])], names=["k", "html"])
    parts = [p.column(0).to_pylist() for p in html.portions(batch, 1, 100)]
    assert parts == [[0, 1], [2], [3], [4, 5]]
    assert [p.num_rows for p in html.portions(batch.slice(0, 0), 1, 100)] == [0]


def test_all_texts_of_a_page_are_searched_by_one_worker(spark):
    """Counts and flags take five searches a page; each used to start a Python worker of its own."""
    pages = spark.createDataFrame([("k", 1, "u", "We use CEREC", "an implant")], "k string, page_ord int, url string, body_text string, text string")
    rows = features.prepared(pages).select("k", *features.page_counts("scrape"), *features.page_flags("scrape"))
    made = rows._jdf.queryExecution().executedPlan().toString()
    assert made.count("ArrowEvalPython") == 1
    assert [(r.f_implants, r.cerec) for r in rows.collect()] == [(1, False)]


def test_written_pages_are_not_broadcast(spark):
    """Files of pages written on the way are far smaller than their rows: no join may go by their size."""
    pages = spark.createDataFrame([(k, 1, "https://x.co/team", "<h2>Dr. Jane Li, DDS</h2><p>An orthodontist.</p><h2>Dr. Bob Ray</h2><p>nothing</p>") for k in range(3)], "k int, page_ord int, url string, html string")
    parsed = staging.staged(html.parse_pages(pages), "pages")
    people_ = staging.staged(pipelines.staff(parsed, ["k"]), "people")
    rows = pipelines.evidence(people_, parsed, ["k"])
    made = rows._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in made and made.count("SortMergeJoin") >= 6
    assert {r.specialty for r in rows.filter("name LIKE '%Jane%' AND source = 1").collect()} == {"Orthodontics"}
