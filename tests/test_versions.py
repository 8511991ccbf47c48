"""Upserts by key: batches in any order, jobs that die half-way, old versions."""

import random

import pytest
from pyspark.sql import functions as F

from sitegrain.sources import versions

SCHEMA = "k int, at int, v string, extra map<string,int>"


def rows_of(df):
    return sorted(((r.k, r.at, r.v) for r in df.collect()), key=str)


def newest(rows):
    out = {}
    for k, at, v in rows:
        if k not in out or (at is not None, at or 0) >= (out[k][1] is not None, out[k][1] or 0):
            out[k] = (k, at, v)
    return sorted(out.values(), key=str)


def test_batches_against_a_dictionary(spark, tmp_path):
    rng = random.Random(4)
    path, told = f"{tmp_path}/t", []
    for n in range(4):
        batch = [(rng.choice([None, *range(30)]), rng.choice([None, *range(9)]), f"b{n}-{k}") for k in range(40)]
        batch = list({r[:2]: r for r in batch}.values())  # a row a key and time in one batch
        told += batch
        assert versions.upsert(spark.createDataFrame([(*r, None) for r in batch], SCHEMA), path, ["k"], ["at"], f"b{n}", parts=8) == n
        assert rows_of(versions.table(spark, path)) == newest(told)
    assert versions.upsert(spark.createDataFrame([(1, 99, "again", None)], SCHEMA), path, ["k"], ["at"], "b2") == 2  # done already
    assert rows_of(versions.table(spark, path)) == newest(told)


def test_only_touched_parts_are_written_and_old_versions_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([(k, 1, "old", None) for k in range(200)], SCHEMA)
    versions.upsert(first, path, ["k"], ["at"], "one", parts=16)
    versions.upsert(spark.createDataFrame([(7, 2, "new", {"x": 1})], SCHEMA), path, ["k"], ["at"], "two")
    told = versions.history(spark, path)
    assert told.filter("version = 1").select("folder").distinct().count() == 2
    second = told.filter("version = 1").groupBy("folder").count().orderBy("count").first()
    assert second["count"] == 1  # one part of sixteen
    assert [r.v for r in versions.table(spark, path, 0).filter("k = 7").collect()] == ["old"]
    assert [r.v for r in versions.table(spark, path).filter("k = 7").collect()] == ["new"] and versions.table(spark, path).count() == 200
    versions.forget(spark, path)
    assert versions.table(spark, path).count() == 200
    with pytest.raises(ValueError):
        versions.table(spark, path, 0)


def test_a_job_that_dies_before_its_version_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    versions.upsert(spark.createDataFrame([(1, 1, "a", None), (2, 1, "b", None)], SCHEMA), path, ["k"], ["at"], "one", parts=2)
    real = type(spark).createDataFrame

    def dies(self, data, schema=None, *more, **named):
        if schema == versions.VERSION:
            raise RuntimeError("killed between data and version")
        return real(self, data, schema, *more, **named)

    batch = spark.createDataFrame([(1, 5, "c", None), (3, 5, "d", None)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "createDataFrame", dies)
        with pytest.raises(RuntimeError):
            versions.upsert(batch, path, ["k"], ["at"], "two")
    assert rows_of(versions.table(spark, path)) == [(1, 1, "a"), (2, 1, "b")]
    (tmp_path / "t" / "versions" / "000000001" / "_temporary").mkdir(parents=True)  # or while its version was written
    assert rows_of(versions.table(spark, path)) == [(1, 1, "a"), (2, 1, "b")]
    assert versions.upsert(batch, path, ["k"], ["at"], "two") == 1
    assert rows_of(versions.table(spark, path)) == [(1, 5, "c"), (2, 1, "b"), (3, 5, "d")]
    versions.forget(spark, path, keep=2)
    assert rows_of(versions.table(spark, path, 0)) == [(1, 1, "a"), (2, 1, "b")]


def test_empty_batches_ties_and_repeats(spark, tmp_path):
    path = f"{tmp_path}/t"
    none = spark.createDataFrame([], SCHEMA)
    assert versions.history(spark, path) is None
    assert versions.upsert(none, path, ["k"], ["at"], "none", parts=4) == 0
    with pytest.raises(ValueError):
        versions.table(spark, path)
    tied = spark.createDataFrame([(None, None, "x", None)] * 3, SCHEMA)
    versions.upsert(tied, path, ["k"], ["at"], "x")
    assert rows_of(versions.table(spark, path)) == [(None, None, "x")]
    versions.upsert(tied.withColumn("v", F.lit("y")), path, ["k"], ["at"], "y")
    assert rows_of(versions.table(spark, path)) == [(None, None, "y")]  # of equal ones the new row
    assert versions.upsert(none, path, ["k"], ["at"], "none again") == 3
    assert rows_of(versions.table(spark, path)) == [(None, None, "y")]
