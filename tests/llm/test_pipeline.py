import zlib

import numpy as np

import corpus_pipeline as cp
from sitegrain.llm import mixing, pii, simhash, tokens

from .docs import frame, save
from .test_classifiers import texts
from .test_simhash import brute_components, brute_print


def corpus():
    own = [(i, t + f" word{i} and {i * 7} more", lang, "ab"[i % 2], len(t)) for i, t, lang, *_ in texts(120)]
    own += [(1000 + i, own[3][1], "en", "hot", None) for i in range(40)]
    return own + [(2000, None, "en", "a", None), (2001, "123 !!", None, None, None), (2002, "mail a@b.co or +1 (017) 555-7713 now please", None, None, 9), (2003, "", "en", "a", 0)]


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    path = save(spark, tmp_path, corpus())
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "near_copies", "personal_data", "mixture", "packing"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    one = cp.identify_language(spark, docs, path)
    assert one.columns == docs.columns and ids(one) == sorted(i for i, t, *_ in corpus() if any(c.isalpha() for c in t or ""))

    two = cp.drop_near_copies(spark, docs, path)
    want = brute_components([(i, brute_print(t)) for i, t, *_ in corpus()])
    assert two.columns == docs.columns and ids(two) == sorted(set(want.values()))

    three = cp.remove_personal_data(spark, docs, path)
    got = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and len(got) == len(corpus())
    assert got[2002].text == "mail <EMAIL> or <PHONE> now please" and got[2002].n_chars == len(got[2002].text)

    four = cp.mix_sources(spark, docs, path)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert four.columns == docs.columns and ids(four) == sorted(i for i, n in copies.items() for _ in range(n))


def test_run(spark, tmp_path):
    path = save(spark, tmp_path, corpus(), extra=False)
    out = cp.run(spark, path).collect()
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    enc = tokens.encoder(tokens.default_path())
    texts_ = {r.doc_id: r.text for r in cp.remove_personal_data(spark, cp.drop_near_copies(spark, cp.identify_language(spark, spark.read.parquet(f"{path}/documents.parquet"), path), path), path).collect()}
    whole = {i: np.frombuffer(enc.ids(t.encode()), enc.dtype).tolist() + [tokens.END] for i, t in texts_.items()}
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == whole[r.doc_id][r.start : r.start + r.length]
    assert cp.run(spark, save(spark, tmp_path / "none", [], extra=False)).collect() == []
