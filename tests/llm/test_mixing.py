from sitegrain.llm import mixing

from .docs import frame, rows, save


def test_water_fill():
    assert mixing.water_fill([100, 100, 100], [3, 1, 2], 450, 2) == [200, 250 / 3, 500 / 3]
    assert mixing.water_fill([0, 10], [3, 1], 15, 2) == [0, 15]
    assert mixing.water_fill([], [], 0, 2) == []
    t = mixing.water_fill([5, 500, 50, 7], [3, 1, 2, 3], 1.5 * 562, 2)
    assert abs(sum(t) - 843) < 1e-9 and t[0] == 10 and t[3] == 14 and t[2] == 100


def test_query(spark, tmp_path):
    path = save(spark, tmp_path)
    got = mixing.query(spark, path).collect()
    sizes = {}
    for i, t, _, s, _ in rows():
        sizes.setdefault(s, []).append((i, len((t or "").split())))
    assert sorted(r.size for r in got) == sorted(n for v in sizes.values() for _, n in v)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.water_fill([sum(n for _, n in sizes[s]) for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))], 1.5 * sum(r.size for r in got), 2)
    by_total = {sum(n for _, n in sizes[s]): t for s, t in zip(order, want)}
    for total, target in by_total.items():
        own = [r for r in got if r.source_size == total]
        assert all(abs(r.target - target) < 1e-6 and 0 <= r.taken <= 2 * r.size for r in own)
        most = max(r.size for r in own)  # source c is one long document but for a few hundred words: it comes once or twice
        assert abs(sum(r.taken for r in own) - target) <= (most / 2 if most > total / 2 else 5)
    assert sorted(map(str, got)) == sorted(map(str, mixing.query(spark, path).collect()))


def test_larger_budgets_are_supersets(spark):
    docs = frame(spark, [(i, "w " * (i % 9), None, "s", None) for i in range(300)])
    taken = [{r.doc_id: r.copies for r in mixing.mix(docs, weights=(1.0,), share=x).collect()} for x in (0.2, 0.5, 1.2)]
    assert all(a[i] <= b[i] for a, b in zip(taken, taken[1:]) for i in a)


def brute(rows, weights, share, most):
    """Copies of every row by hash, from the rows' hashes: a walk over the sorted rows of a source, then the offers."""
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by[s]) for s in order]
    out = {}
    for s, size, target in zip(order, sizes, mixing.water_fill(sizes, [weights[k % len(weights)] for k in range(len(order))], share * sum(sizes), most)):
        whole = int(target // size) if size else 0
        left, own, k = target - whole * size, sorted(by[s], key=lambda r: r.h), 0
        while k < len(own) and own[k]["size"] <= left:
            left -= own[k]["size"]
            k += 1
        taken = {r.h for r in own[:k]}
        offers = [r for r in own[k:] if r["size"]][: mixing.OFFER]
        rest, extra = left, set()
        for r in sorted(offers, key=lambda r: (-r["size"], -r.h)):
            if r["size"] <= rest:
                rest -= r["size"]
                extra.add(r.h)
        if offers and abs(offers[0]["size"] - left) < rest:
            extra = {offers[0].h}
        for r in own:
            out[r.h] = min(int(most), whole + (r.h in taken | extra))
    return out


def test_choice_against_brute_force(spark):
    import random

    for seed in (1, 2):
        rng = random.Random(seed)
        data = [(i, "w " * rng.choice([0, 1, 5, 30, 400]), None, rng.choice(["a", "b", "c", None]), None) for i in range(400)] + [(None, "copy of a row", None, "a", None)] * 300 + [(7, "other text", None, "b", None)] * 30
        for options in ({}, {"weights": (1.0, 5.0), "share": 0.4, "most": 1.0}, {"share": 2.5, "most": 3.0}):
            got = mixing.mix(frame(spark, data), **options).collect()
            assert len(got) == len(data) == len({r.h for r in got})
            want = brute(got, options.get("weights", (3.0, 1.0, 2.0)), options.get("share", 1.5), options.get("most", 2.0))
            assert {r.h: r.copies for r in got} == want
            for s in {r.source for r in got}:  # copies of a row are parted, targets are met
                own = [r for r in got if r.source == s]
                assert abs(sum(r["size"] * r.copies for r in own) - own[0].target) <= 200


def test_repeated_takes_the_same(spark, tmp_path):
    data = [(i % 50, "w " * (i % 7) + str(i % 3), None, "ab"[i % 2], None) for i in range(400)] + [(None, "copy", None, "a", None)] * 200
    frame(spark, data).selectExpr("doc_id AS key", "text AS body", "source AS origin", "n").repartition(5).write.parquet(f"{tmp_path}/t.parquet")
    docs = spark.read.parquet(f"{tmp_path}/t.parquet")
    options = {"id_col": "key", "text_col": "body", "source_col": "origin", "share": 2.2, "most": 3.0}
    want, got = {}, {}
    for r in mixing.mix(docs, **options).collect():
        want[r.doc_id, r.source, r["size"]] = want.get((r.doc_id, r.source, r["size"]), 0) + r.copies
    again = mixing.repeated(docs, **options)
    assert again.columns == docs.columns
    for r in again.collect():
        k = (r.key, r.origin, len(r.body.split()))
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_choices_do_not_depend_on_splits(spark, tmp_path):
    """Planned with files read whole, taken from the same files in many splits: the same rows, those that repeat others included."""
    data = [(i % 60, "w " * (i % 9), None, "ab"[i % 2], None) for i in range(900)]
    frame(spark, data, extra=False).repartition(2).write.option("parquet.block.size", 2048).parquet(f"{tmp_path}/t.parquet")
    docs = spark.read.parquet(f"{tmp_path}/t.parquet")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def rows_of(df):
        return sorted((r.doc_id, r.text, r.source) for r in df.collect())

    try:
        want = rows_of(mixing.repeated(docs))
        hashes = sorted((r.doc_id, r.h, r.copies) for r in mixing.mix(docs).collect())
        again = mixing.repeated(docs)  # planned here
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert spark.read.parquet(f"{tmp_path}/t.parquet").rdd.getNumPartitions() > 4
        assert rows_of(again) == want and sorted((r.doc_id, r.h, r.copies) for r in mixing.mix(docs).collect()) == hashes
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_sources_without_a_name_and_named_nothing(spark):
    docs = frame(spark, [(i, "w " * 5, None, None if i % 2 else "", None) for i in range(100)])
    got = mixing.mix(docs, weights=(1.0, 3.0), share=1.0).collect()
    taken = {s: sum(r["size"] * r.copies for r in got if r.source == s) for s in ("", None)}
    assert {r.source_size for r in got} == {250} and abs(taken[""] - 125) <= 5 and abs(taken[None] - 375) <= 5


def test_empty(spark, tmp_path):
    assert mixing.query(spark, save(spark, tmp_path, [])).collect() == []
