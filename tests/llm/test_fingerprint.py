import hashlib

import xxhash

from sitegrain.llm import fingerprint as fp

from .docs import frame, rows, save


def expected(data):
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    data = sorted(((i, t or "") for i, t, *_ in data), key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    out = []
    for k, (i, t) in enumerate(data):
        after = data[(k + 1) % len(data)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + after[:half]
        c, ce, cn = (fp.canonical(x) for x in (t, e, after))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.digest(c), fp.digest(ce), float(c == ce), float(c == cn)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, tmp_path):
    got = fp.query(spark, save(spark, tmp_path)).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == expected(rows())
    by = {r.doc_id: r for r in got}
    assert by[504].fingerprint == by[1].fingerprint and by[504].class_id == 1
    assert {r.class_id for r in got if r.n_chars == 0} == {500}


def test_one_document_and_none(spark, tmp_path):
    one = fp.query(spark, save(spark, tmp_path / "one", [(1, "abcd", None, None, None)])).collect()
    assert [(r.near_edited, r.near_next) for r in one] == [(0.0, 1.0)]
    assert fp.query(spark, save(spark, tmp_path / "none", [])).collect() == []


def test_colliding_digests_are_told_apart_by_bytes(spark):
    docs = frame(spark)
    prints = fp.fingerprints(docs, bits=2).drop("canon")
    got = fp.exact_classes(docs.dropDuplicates(["doc_id"]), prints.dropDuplicates(["doc_id"]), bits=2)
    kept = {r.doc_id: r.text for r in docs.dropDuplicates(["doc_id"]).collect()}
    classes = {}
    for r in got.collect():
        classes.setdefault(r.class_id, set()).add(fp.canonical(kept[r.doc_id] or ""))
    assert all(len(v) == 1 for v in classes.values())
    assert len(classes) == len({fp.canonical(t or "") for t in kept.values()})


def test_canonical_folds():
    assert fp.canonical("Ｆｕｌｌ  Straße ") == fp.canonical("full STRASSE")
    assert fp.canonical("é") == fp.canonical("é")


def test_an_id_that_most_rows_repeat_is_spread(spark, tmp_path):
    data = [(7, f"text {i % 40}", "en", "hot", None) for i in range(300)] + rows()
    docs = spark.read.parquet(save(spark, tmp_path, data) + "/documents.parquet")
    got = fp.spliced_with_next(docs)
    assert sorted((tuple(r)[:7] for r in got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=str) == expected(data)
    work = fp.Workspace.made[-1]
    parts = spark.read.parquet(f"{work.path}/rows").filter("doc_id = 7").select("part").distinct().count()
    assert parts > 1
