"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicons and patterns, each voting toxic, clean or nothing on a
document. Some are given (insults in four languages, threats, shouting at a
reader); some lexicons are found in labelled rows: words much more frequent in
toxic ones, cut into a few voters by strength, and stems of which a toxic
document holds several words (insults are inflected and compounded). The label model estimates each
voter's rates of votes under either class by expectation-maximisation over
vote patterns, and down-weights voters that correlate beyond what the classes
explain. Labels are one more voter, so wrong labels can be outvoted. A logistic
classifier over voters and lexicon words learns from the posterior labels and
scores every whole text.

Labels come from rows outside the held-out fold, at most ``FIT_ROWS`` of them
(a hash of the id picks them): a bounded sample, told here.

Edge cases: a null or empty text gets a score like any other (no voter fires);
without labelled rows the given voters decide; a doc_id with several labels
counts as toxic if one says so; rows that repeat a doc_id are scored each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, bucket_of, raw, read_table

FIT_ROWS = 20_000
#: Words a found lexicon may have; toxic documents a word must be in; twice the log-likelihood ratio it must reach.
LEXICON, SUPPORT, CHANCE = 400, 4, 30.0
#: Lengths of stems.
STEMS = (5, 6, 7)

# Common insults, by language.
INSULTS = {
    "en": "idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown fool jerk creep filthy garbage imbecile dimwit lowlife degenerate vermin brainless",
    "de": "idiot dummkopf trottel arschloch schwein abschaum blödmann vollidiot widerlich erbärmlich",
    "fr": "idiot imbécile connard crétin débile ordure salaud abruti minable dégoûtant",
    "es": "idiota imbécil estúpido basura escoria asqueroso patético inútil payaso cretino",
}
PATTERNS = {
    "threat": re.compile(r"\b(?:i|we)(?:'ll| will| am going to) (?:kill|hurt|destroy|find|beat) (?:you|u|them)\b|\bgo (?:die|kill yourself)\b|\bkill yourself\b"),
    "address": re.compile(r"\byou(?:'re| are)? (?:all |such |so |a |an |the )*(?:idiot|moron|stupid|dumb|loser|scum|trash|worthless|pathetic|disgusting|clown|fool)"),
    "hate": re.compile(r"\bi hate (?:you|them|all)\b|\bshut up\b|\bnobody likes you\b"),
}
#: Rates of the votes -1, 0, 1 that labels are held to cast on clean and on toxic documents.
HELD = ((0.98, 0.01, 0.01), (0.02, 0.01, 0.97))
#: Digits and signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
_MASKED = re.compile(r"[^\s]*[0-9@$!][^\s]*")
_SPACED = re.compile(r"\b(?:[a-z][ .\-*_]){3,}[a-z]\b")
GIVEN = [*INSULTS, "masked", *PATTERNS, "shout"]


def several(words: set[str]) -> set[str]:
    """Stems with which at least two words begin and go on."""
    once, twice = set(), set()
    for w in words:
        for k in STEMS:
            if len(w) > k:
                stem = w[:k]
                (twice if stem in once else once).add(stem)
    return twice


def evidence(text: str, words: dict, found: list[frozenset], stems: frozenset = frozenset()) -> tuple[list[int], set[str]]:
    """Votes (1 toxic, 0 none, -1 clean) of all voters; the lexicon words in the text."""
    low = text.lower()
    own = set(_WORD.findall(low))
    votes = [int(not own.isdisjoint(v)) for v in words["sets"]]
    masked = set()
    if any(c in low for c in "0134@$!57"):
        for w in _MASKED.findall(low):
            clear = w.translate(LEET).strip(".,;:!?|*'\"")
            if clear in words["all"] and w.strip(".,;:!?|*'\"") not in words["all"]:
                masked.add(clear)
    for w in _SPACED.findall(low) if " " in low else ():
        clear = re.sub(r"[^a-z]", "", w)
        if clear in words["all"]:
            masked.add(clear)
    votes.append(int(bool(masked)))
    votes += [int(bool(p.search(low))) for p in PATTERNS.values()]
    hits = own & words["all"]
    shouted = hits and any(w.upper() in text for w in hits if len(w) > 3)
    votes.append(int(bool(shouted)))
    votes += [int(not own.isdisjoint(v)) for v in found]
    if stems:
        once: dict[str, int] = {}
        for w in own:
            for k in STEMS:
                if len(w) > k and w[:k] in stems:
                    once[w[:k]] = once.get(w[:k], 0) + 1
        votes.append(int(any(n > 1 for n in once.values())))
    # a voter for clean: nothing of any lexicon
    votes.append(-1 if not any(votes) else 0)
    return votes, (hits | masked | {w for v in found for w in own & v})


def given_words() -> dict:
    sets = [frozenset(v.split()) for v in INSULTS.values()]
    return {"sets": sets, "all": frozenset().union(*sets)}


def find_lexicons(labelled: DataFrame, n_toxic: int, n_clean: int, text_col: str = "text") -> list[frozenset]:
    """Words that mark toxic rows, strongest first, as up to two voters. Counted distributed.

    A word counts once for all documents with the same longest word: near
    copies, which mostly share it, can't make their own words look telling.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?U)([\p{L}]{3,})"), 1))
    one = labelled.select("toxic", words.alias("words")).withColumn("copy", F.array_max(F.transform("words", lambda w: F.struct(F.length(w), w))))
    counts = one.select("toxic", "copy", F.explode("words").alias("word")).groupBy("word", "copy").agg(F.max("toxic").alias("toxic")).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter(F.col("t") >= SUPPORT)
    best = telling(counts, n_toxic, n_clean)
    strong, weak = ([r.word for r in best if (r.ratio >= 3 * CHANCE) is x] for x in (True, False))
    return [frozenset(v) for v in (strong, weak) if v]


def find_stems(labelled: DataFrame, n_toxic: int, n_clean: int) -> frozenset:
    """Stems of which toxic rows hold several words much more often. Near copies count once, as for words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = set(_WORD.findall(text.decode("utf-8", "replace").lower()))
                copy = max(own, key=lambda w: (len(w), w), default="")
                rows += [(toxic, copy, stem) for stem in several(own)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.string(), pa.string()))], names=["toxic", "copy", "word"])

    held = labelled.select("toxic", raw("text")).mapInArrow(run, "toxic int, copy string, word string").groupBy("word", "copy").agg(F.max("toxic").alias("toxic"))
    counts = held.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).filter(F.col("t") >= SUPPORT)
    return frozenset(r.word for r in telling(counts, n_toxic, n_clean) if r.ratio >= 2 * CHANCE)


def telling(counts: DataFrame, n_toxic: int, n_clean: int) -> list:
    """Words (``word, t, c``) whose rates differ beyond chance among all words of a corpus, the most telling first."""
    n, rate = F.col("t") + F.col("c"), n_toxic / (n_toxic + n_clean)
    part = lambda k, share: F.when(k > 0, k * F.log(k / (n * share))).otherwise(0.0)
    ratio = 2 * (part(F.col("t"), rate) + part(F.col("c"), 1 - rate))  # likelihood ratio against equal rates
    return counts.withColumn("ratio", ratio).filter((F.col("ratio") >= CHANCE) & (F.col("t") > 2 * n * rate)).orderBy(F.desc("ratio"), "word").limit(LEXICON).collect()


def label_model(votes: np.ndarray, anchors: int = 1, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Posterior probability of toxic for each row of votes; rates, prior and weights.

    Rows are pooled to vote patterns first. Two classes; each voter has a rate
    of each vote under each. Weights: a voter's evidence is divided by one
    plus its correlations with other voters within the classes. The last
    ``anchors`` voters are labels: their rates are held (``HELD``), so that the
    two classes can't drift from what the labels mean.
    """
    patterns, inverse, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    inverse, n = inverse.ravel(), n.astype(float)
    m = patterns.shape[1]
    seen = [(patterns == v).astype(float) for v in (-1, 0, 1)]
    p = 1 / (1 + np.exp(-3.0 * patterns[:, m - anchors :].sum(1)))
    weights = np.ones(m)
    for k in range(rounds):
        rates = []
        for q in (1 - p, p):
            mass = (n * q).sum()
            rates.append(np.stack([(n * q) @ s + 0.5 * w for s, w in zip(seen, (0.3, 1.4, 0.3))]) / (mass + 1.0))
            rates[-1][:, m - anchors :] = np.array(HELD[len(rates) - 1])[:, None]
        prior = np.clip((n * p).sum() / n.sum(), 1e-4, 1 - 1e-4)
        if k in (5, 20, 40):  # correlations within the classes, from residuals
            x = patterns.astype(float)
            mean = [(rates[c][2] - rates[c][0]) for c in (0, 1)]
            expect = np.outer(1 - p, mean[0]) + np.outer(p, mean[1])
            residual = (x - expect) * np.sqrt(n)[:, None]
            cov = residual.T @ residual / n.sum()
            sd = np.sqrt(np.diag(cov)) + 1e-9
            rho = np.abs(cov / np.outer(sd, sd))
            rho[rho < 0.05] = 0
            weights = 1 / rho[:, : m - anchors].sum(1).clip(1)
            weights[m - anchors :] = 1.0
        step = sum(s * (np.log(rates[1][v]) - np.log(rates[0][v])) for v, s in enumerate(seen)) @ weights
        p = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + step, -30, 30)))
    return p[inverse], {"rates": rates, "prior": prior, "weights": weights}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and bias on soft labels, by Newton steps over pooled equal rows; ridge on the weights."""
    x, inverse, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    y = np.bincount(inverse.ravel(), y, len(x)) / n
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + keep * w
        step = np.linalg.solve((x.T * (n * np.maximum(p * (1 - p), 1e-4))) @ x + np.diag(keep), slope)
        w -= step * min(1.0, 4 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn=None) -> dict:
    """The classifier, from at most ``rows`` labelled documents."""
    told = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        told = told.filter(learn)
    n = told.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit("toxicity")), 11) / float(1 << 53)
    told = told.filter(unit < rows / max(1, n)).groupBy(F.col(id_col).alias("__sg_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    sample = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(told), F.col(id_col) == F.col("__sg_id")).select("toxic", "text")
    sample = Workspace(docs.sparkSession, "toxicity").write(sample, "sample")  # at most about FIT_ROWS texts, read three times
    base = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = find_lexicons(sample, base.get(1, 0), base.get(0, 0)) if base.get(1) and base.get(0) else []
    stems = find_stems(sample, base.get(1, 0), base.get(0, 0)) if base.get(1) and base.get(0) else frozenset()
    words = given_words()
    lexicon = sorted(words["all"].union(*found))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k for k, w in enumerate(lexicon)}
        for batch in batches:
            out = [evidence(t.decode("utf-8", "replace"), words, found, stems) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v for v, _ in out], pa.list_(pa.int32())), pa.array([sorted(place[w] for w in h if w in place) for _, h in out], pa.list_(pa.int32()))], names=["toxic", "votes", "hits"])

    seen = sample.select("toxic", raw("text")).mapInArrow(look, "toxic int, votes array<int>, hits array<int>").collect()  # at most about FIT_ROWS short rows
    if not seen:  # nothing to learn from: any given voter decides
        return {"found": [], "stems": frozenset(), "lexicon": [], "w": np.full(len(GIVEN) + 1, 4.0), "b": -2.0, "n_votes": len(GIVEN) + 1, "label_model": {}}
    votes, gold, hits = np.array([r.votes for r in seen]), np.array([1 if r.toxic else -1 for r in seen]), [r.hits for r in seen]
    posterior, model = label_model(np.column_stack([votes, gold]))
    x = np.zeros((len(votes), votes.shape[1] + len(lexicon)))
    x[:, : votes.shape[1]] = votes
    for k, own in enumerate(hits):
        x[k, votes.shape[1] + np.array(own, int)] = 1
    w, b = logistic(x, posterior)
    return {"found": found, "stems": stems, "lexicon": lexicon, "w": w, "b": b, "n_votes": votes.shape[1], "label_model": model}


def score(docs: DataFrame, model: dict, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` and ``toxicity``, from 0 to 1, for every whole text."""
    words = given_words()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: k + model["n_votes"] for k, w in enumerate(model["lexicon"])}
        w, b = model["w"], model["b"]
        for batch in batches:
            out = []
            for data in batch.column(batch.num_columns - 1).to_pylist():
                votes, hits = evidence(data.decode("utf-8", "replace"), words, model["found"], model["stems"])
                z = b + float(w[: model["n_votes"]] @ votes) + sum(w[place[h]] for h in sorted(hits) if h in place)
                out.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], names=[*keep, "toxicity"])

    rows = docs.select(*keep, raw(text_col).alias("__sg_text"))
    return rows.mapInArrow(run, rows.drop("__sg_text").schema.add("toxicity", "double"))


def query(spark, sf_dir):
    """op10: the toxicity of every document; a fifth of the ids is held out of learning."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    held = bucket_of("doc_id", 5) == 0
    model = fit(docs, labels, learn=~held)
    found = score(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
