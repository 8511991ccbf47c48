"""Every catalogued query with SQL gives DuckDB's rows, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from sitegrain.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def tidy(rows):
    norm = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, duck, name):
    df = catalog.Q[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(catalog.SQL[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert tidy(tuple(r[c] for c in cols) for r in df.collect()) == tidy(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.Q) - set(catalog.SQL)))
def test_query_runs(spark, name):
    assert catalog.Q[name](spark, SF).count() > 0


def test_plans_stay_in_the_jvm(spark):
    python = ("made_extraction", "testimonial_counts", "keyword_mentions", "technology_flags")  # the parser and the automaton of all keywords run in Python
    for name in (n for n in catalog.SQL if not n.startswith(python)):
        plan = catalog.Q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan, name


def test_columns_are_pruned(spark):
    plan = catalog.Q["page_links_by_host"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "page_id" not in plan.split("ReadSchema")[1].splitlines()[0]
