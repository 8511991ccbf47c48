"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; runs of other characters than letters count as one
space. The counts of n-grams of 1 to 3 characters are hashed into bins. The
model is a matrix of log-probabilities, bins by languages, which goes to every
worker (its size is fixed: at most ``2**26`` numbers); whole texts are scored
in batches, by gathering rows of the matrix and summing them per document.

Learning uses rows outside the held-out fold with a language, at most
``FIT_ROWS`` a language (a hash of the id picks them): a bounded sample, told
here; counting and scoring are distributed.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
without any labelled row every text is ``und``; ties go to the first language
by name; an empty table gives an empty result; extra columns are ignored (or
kept, by ``keep``; one under the name of a result gives way to it, and the
pipeline's stage uses names of its own, so there every column stays).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, raw, read_table

ORDERS, BINS = 3, 1 << 16
#: Labelled rows a language that the model learns from, at most.
FIT_ROWS = 4000
MODEL_NUMBERS = 1 << 26
#: Characters scored at once; characters times languages, of which each takes a number.
AT_ONCE, SCORED = 1 << 20, 1 << 25
NONE = "und"


def letters(text: str) -> np.ndarray:
    """Code points of the lowered text, other runs than letters as one space; empty if it has no letter."""
    low = text.lower()
    code = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    is_letter = (code >= 97) & (code <= 122)
    other = np.flatnonzero(code >= 128)
    if len(other):
        kinds = np.unique(code[other])
        alpha = kinds[[chr(c).isalpha() for c in kinds.tolist()]]
        is_letter[other] = np.isin(code[other], alpha)
    if not is_letter.any():
        return np.empty(0, np.uint32)
    code = np.where(is_letter, code, 32)
    space = code == 32
    keep = ~(space & np.concatenate([[False], space[:-1]]))
    return code[keep]


def grams(code: np.ndarray, bins: int) -> list[np.ndarray]:
    """Bins of the n-grams that begin at each place, for n from 1."""
    out, h = [], code.astype(np.uint32) * np.uint32(0x9E3779B1)
    for n in range(ORDERS):
        if n:
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + code[n:].astype(np.uint32) * np.uint32(0x9E3779B1)
        out.append(((h ^ (h >> np.uint32(16))) * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - bins.bit_length() + 1))
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None, rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (bins by languages), log-priors, from labelled rows (where ``learn`` holds)."""
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if learn is not None:
        labelled = labelled.filter(learn)
    per = sorted((r[0], r[1]) for r in labelled.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a language
    names, n = [p[0] for p in per], np.array([p[1] for p in per], np.float64)
    if not names:
        return [], np.zeros((BINS, 0)), np.zeros(0)
    bins = BINS
    while bins * len(names) > MODEL_NUMBERS:
        bins //= 2
    share = F.create_map(*[F.lit(x) for name, count in per for x in (name, min(1.0, rows / count))])
    unit = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("language")), 11) / float(1 << 53)
    code = F.create_map(*[F.lit(x) for k, name in enumerate(names) for x in (name, k)])
    sample = labelled.filter(unit < share[F.col(lang_col)]).select(code[F.col(lang_col)].cast("int").alias("lang"), raw(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = total.setdefault(lang, np.zeros(bins, np.int64))
                chars = letters(text.as_py().decode("utf-8", "replace"))
                for g in grams(chars, bins) if len(chars) else ():
                    own += np.bincount(g, minlength=bins)
        for lang, own in total.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array(own[used], pa.int64())], names=["lang", "bin", "n"])

    table = np.zeros((bins, len(names)))
    for r in sample.mapInArrow(count, "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toLocalIterator():  # bins by languages at most
        table[r.bin, r.lang] = r.n
    smooth = table + 0.1
    return names, np.log(smooth / smooth.sum(0)), np.log(n / n.sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str = "text", keep: list[str] | None = None, told: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """The columns of ``keep`` (all, by default) with the predicted language and its posterior probability, under the names ``told``; columns of ``docs`` under those names give way."""
    names, table, prior = model
    bins = len(table)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((names, np.vstack([table, np.zeros(len(names))]).astype(np.float32), prior))  # at most MODEL_NUMBERS
    keep = [c for c in (docs.columns if keep is None else keep) if c not in told]
    at_once = max(1 << 12, min(AT_ONCE, SCORED // max(1, len(names))))

    def score(texts: list[bytes]) -> tuple[list[str], list[float]]:
        names, table, prior = sent.value
        pred, prob = [NONE] * len(texts), [0.0] * len(texts)
        if not names:
            return pred, prob
        held, sizes, at = [], [], []

        def flush(again: int = 0) -> None:  # again: leading letters of a piece that the piece before has told, for n-grams across the cut
            if not held:
                return
            # documents in a row, parted by a mark; n-grams that touch a mark fall into the empty bin
            code = np.concatenate([x for c in held for x in (c, np.zeros(ORDERS, np.uint32))])
            begins = np.cumsum([0, *[s + ORDERS for s in sizes]])[:-1]
            total = np.zeros((len(held), len(names)))
            mark = code == 0
            for n, g in enumerate(grams(code, bins)):
                bad = mark[: len(g)].copy()
                for k in range(1, n + 1):
                    bad |= mark[k : k + len(g)]
                bad[: max(0, again - n)] = True
                rows = table[np.where(bad, bins, g)]
                total += np.add.reduceat(rows, begins, axis=0, dtype=np.float64)
            total += prior
            best = total.argmax(1)
            odds = np.exp(total - total.max(1, keepdims=True))
            odds = odds[np.arange(len(best)), best] / odds.sum(1)
            for k, (i, b, p) in enumerate(zip(at, best.tolist(), odds.tolist())):
                if parts[i] is None:
                    pred[i], prob[i] = names[b], min(1.0, p)
                else:
                    parts[i] += total[k] - prior
            held.clear(), sizes.clear(), at.clear()

        parts: list = [None] * len(texts)
        for i, data in enumerate(texts):
            chars = letters(data.decode("utf-8", "replace"))
            if not len(chars):
                continue
            if len(chars) > at_once:  # a very long text, piece by piece; pieces overlap by what n-grams need
                parts[i] = np.zeros(len(names))
                flush()
                for k in range(0, len(chars), at_once):
                    again = min(k, ORDERS - 1)
                    held.append(chars[k - again : k + at_once]), sizes.append(len(held[-1])), at.append(i)
                    flush(again)
                best = int((parts[i] + prior).argmax())
                odds = np.exp(parts[i] + prior - (parts[i] + prior).max())
                pred[i], prob[i] = names[best], float(odds[best] / odds.sum())
                continue
            held.append(chars), sizes.append(len(chars)), at.append(i)
            if sum(sizes) >= at_once:
                flush()
        flush()
        return pred, prob

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, prob = score(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred, pa.string()), pa.array(prob, pa.float64())], names=[*keep, *told])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], raw(text_col).alias("__sg_text"))
    schema = rows.drop("__sg_text").schema.add(told[0], "string").add(told[1], "double")
    return rows.mapInArrow(run, schema)


def query(spark, sf_dir):
    """op7: the language of every document; a quarter of the ids is held out of learning."""
    docs = read_table(spark, sf_dir, "documents")
    held = bucket_of("doc_id", 4) == 2
    model = fit(docs, learn=~held)
    found = predict(docs.select("doc_id", "text", held.alias("held_out")), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
