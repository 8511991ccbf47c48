import random

import numpy as np
from pyspark.sql import functions as F

from sitegrain.llm import language, toxicity
from sitegrain.llm.common import bucket_of

from .docs import frame, rows, save

WORDS = {"en": "the and of house tree water light green with stone", "de": "der und haus baum wasser licht grün mit stein schön", "fr": "le et maison arbre eau lumière vert avec pierre été"}


def texts(n=240, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        own = [rng.choice(WORDS[lang].split()) for _ in range(rng.randint(5, 60))]
        own.append("".join(rng.choice(WORDS[lang].split()) for _ in range(3)))  # a rare word, as real texts have
        if i % 5 == 0:
            own.insert(rng.randrange(len(own)), rng.choice(["idiot", "scum", "zorkish", "zorkish"]))
        out.append((i, " ".join(own), lang, "s", None))
    return out


def test_language_query(spark, tmp_path):
    data = texts() + [(9000, None, "en", None, None), (9001, "12 + 3 = 15 !!", "en", None, None), (9002, "Der schöne Baum " * 60_000, None, None, None), (9002, "", "de", None, 0), (None, "Der schöne Baum", None, None, 3)]
    got = language.query(spark, save(spark, tmp_path, data)).collect()
    assert len(got) == len(data)
    assert [r.lang_pred for r in got if r.doc_id is None] == ['de']
    got = [r for r in got if r.doc_id is not None]
    by = {r.doc_id: r for r in got if r.doc_id < 9000}
    assert all(by[i].lang_pred == lang for i, _, lang, *_ in texts()) and all(0 <= r.score <= 1 for r in got)
    odd = sorted((r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id >= 9000)
    assert odd == [(9000, "und", 0.0), (9001, "und", 0.0), (9002, "de", odd[2][2]), (9002, "und", 0.0)]
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert language.query(spark, save(spark, tmp_path / "none", [])).collect() == []
    assert {r.lang_pred for r in language.query(spark, save(spark, tmp_path / "bare", [(1, "text", None, None, None)])).collect()} == {"und"}


def test_language_scores_against_brute_force(spark):
    docs = frame(spark, texts(60))
    model = language.fit(docs)
    names, table, prior = model
    for r in language.predict(docs, model, keep=["text"]).collect():
        total = prior.copy()
        for g in language.grams(language.letters(r.text), len(table)):
            for b in g.tolist():
                total += table[b]
        assert names[int(total.argmax())] == r.lang_pred
        odds = np.exp(total - total.max())
        assert abs(odds.max() / odds.sum() - r.lang_score) < 1e-4


def test_letters_fold_other_characters():
    assert "".join(map(chr, language.letters("A1--é!!Ü z9"))) == "a é ü z "
    assert len(language.letters("12 .. 3")) == 0


def test_toxicity_query(spark, tmp_path):
    data = texts(400)
    path = save(spark, tmp_path, data + rows()[-8:] + [(None, "a fine day", None, None, None)])
    labels = [(i, 1, int(i % 5 == 0)) for i, *_ in data if i % 3] + [(500, 1, None), (None, 1, 1), (1, 0, 0), (77_777, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    got = toxicity.query(spark, path).collect()
    assert len(got) == len(data) + 9 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    own = {r.doc_id: r.predicted for r in got if r.doc_id is not None and r.doc_id < 400}
    assert sum(own[i] == int(i % 5 == 0) for i in own) >= 0.98 * len(own)
    assert all(r.predicted == 0 for r in got if r.doc_id is None or r.doc_id >= 500)


def test_toxicity_without_labels(spark, tmp_path):
    path = save(spark, tmp_path, [(1, "you are an idiot", None, None, None), (2, "a fine day", None, None, None), (3, None, None, None, None)])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    got = {r.doc_id: r.predicted for r in toxicity.query(spark, path).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    none = save(spark, tmp_path / "none", [])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert toxicity.query(spark, none).collect() == []


def test_masked_insults_are_seen():
    words = toxicity.given_words()
    for text in ("what an 1d10t.", "you m.o.r.o.n you", "pure $cum"):
        votes, _ = toxicity.evidence(text, words, [])
        assert votes[toxicity.GIVEN.index("masked")] == 1
    for text in ("born in 1970", "call 555 0134", "a b c", ""):
        assert toxicity.evidence(text, words, [])[0][-1] == -1


def test_label_model_finds_rates():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    vote = lambda hit, false: np.where(rng.random(4000) < np.where(y, hit, false), 1, 0)
    a = vote(0.8, 0.02)
    gold = np.where(rng.random(4000) < 0.02, ~y, y) * 2 - 1
    votes = np.column_stack([a, a, a, vote(0.7, 0.05), vote(0.6, 0.01), gold])
    p, model = toxicity.label_model(votes)
    assert ((p > 0.5) == y).mean() > 0.98 and abs(model["prior"] - 0.2) < 0.04
    assert model["weights"][0] < 0.5 < model["weights"][3]  # copies of one voter share its weight


def test_folds_are_crc32(spark):
    import zlib

    df = spark.createDataFrame([(5,), (None,)], "doc_id long").select("doc_id", bucket_of("doc_id", 5).alias("b"))
    assert {r.doc_id: r.b for r in df.collect()} == {5: zlib.crc32(b"5") % 5, None: 0}


def test_long_texts_lose_no_ngram_at_the_cuts(spark):
    text = "a" * (language.AT_ONCE - 1) + "bc" + "a" * 10  # the cut lies between b and c
    table = np.zeros((language.BINS, 2))
    for gram, odds in (("bc", (3, 1)), ("abc", (5, 1)), ("bca", (7, 1)), ("b", (1, 2)), ("ab", (1, 2)), ("c", (1, 11))):
        table[language.grams(language.letters(gram), language.BINS)[len(gram) - 1][0]] += np.log(odds)
    r = language.predict(frame(spark, [(1, text, None, "a", None)], extra=False), (["x", "y"], table, np.zeros(2))).first()
    assert r.lang_pred == "x" and abs(r.lang_score - 105 / (105 + 44)) < 1e-4


def test_columns_of_the_results_names_give_way(spark):
    docs = frame(spark, texts(30))
    got = language.predict(docs, language.fit(docs))
    assert sorted(got.columns) == sorted(docs.columns) and {r.lang_pred for r in got.collect()} <= set(WORDS)
    kept = language.predict(docs, language.fit(docs), told=("__x", "__y"))
    assert kept.columns == [*docs.columns, "__x", "__y"] and {r.lang_pred for r in kept.collect()} == {"clash"}
