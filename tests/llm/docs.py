"""Small tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 6))) for _ in range(n))


def rows(seed=7, n=60):
    rng = random.Random(seed)
    out = [(i * 3 + 1, words(rng, rng.randint(1, 60)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), None) for i in range(n)]
    out += [(500, None, "en", "a", None), (501, "", None, "b", 0), (502, " \t\n ", "de", None, 4), (503, out[0][1], "en", "a", None), (504, out[0][1].upper() + "  ", "en", "b", None), (505, "x" * 60_000 + " y" * 30_000, "en", "c", None), (505, "again", "en", "c", None), (506, "!!! 123 ???", "en", "hot", None), (None, "no id here", "en", "a", None), (None, None, None, None, None)]
    return out


def frame(spark, data=None, extra=True):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA)
    if extra:  # columns that clash with what operators name their own
        for name in ("fingerprint", "size", "h", "part", "first", "component_id", "score", "spans", "ids", "n", "lang_pred", "lang_score", "copies", "cut", "goal", "target"):
            df = df.selectExpr("*", f"'clash' AS {name}")
        df = df.selectExpr("*", "map('a', doc_id) AS tags")  # a type that can't be hashed, grouped or compared
    return df


def save(spark, path, data=None, extra=True):
    frame(spark, data, extra).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)
