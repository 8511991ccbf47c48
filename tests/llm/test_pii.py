import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sitegrain.llm import pii

from .docs import frame, rows, save

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


def valid(kind, v):
    d = re.sub(r"[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()


def brute(text):
    out = []
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(p, text) if valid(kind, m.group())]
    return sorted(out)


def noise(rng):
    bits = ["a@b.co", "x.y%z+1@mail.example.com", "@", ".", "..", "1.2.3.4", "255.255.255.256", "10.0.0.1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111", "79927398713", "378282246310005", "+1 (017) 555-7713", "+", "-", " ", "é", "😀", "(at)", "0", "9", "007.1.1.1", "Dr. Anna Weber", "123-45-6789", "call (212) 555-0100", "\n", "joe [at] host [dot] com", "%", "a", "$1", "\x01", "\x02", "\\", "--", "00000000000000"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))


def data(seed):
    rng = random.Random(seed)
    return [(i, noise(rng), None, None, None) for i in range(250)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_base_spans_against_brute_force(spark, tmp_path, seed):
    own = data(seed) + rows()
    got = {}
    for r in pii.query(spark, save(spark, tmp_path, own)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in own:
        want = brute(t or "")
        told = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        row = [r for r in got[i] if r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()]
        assert row, (t, told)
        counts = tuple(sum(k == kind for *_, k in want) for kind in pii.BASE)
        assert any(tuple(r)[1:5] == counts for r in row)
        assert all(set(told.split(",")) <= set(r.spans.split(",")) or not told for r in row)


def test_weakly_supervised_spans(spark, tmp_path):
    texts = ["My phone: (212) 555-0199 call me", "order 123-45-6789 ref", "SSN: 123-45-6789 is mine", "Dear Dr. Anna Weber, hello", "mail joe.doe [at] host [dot] com please", "contact IBAN DE89 3704 0044 0532 0130 00 now", "a quiet text, of 2024 and 12 apples"]
    own = [(i, t, None, None, None) for i, t in enumerate(texts * 5)]
    got = {r.doc_id: r.spans for r in pii.query(spark, save(spark, tmp_path, own)).collect()}
    kinds = [{s.split(":")[0] for s in got[i].split(",") if s} for i in range(7)]
    assert kinds[0] == {"phone"} and kinds[2] == {"ssn"} and kinds[3] == {"name"} and kinds[4] == {"email"} and kinds[5] == {"iban"} and kinds[6] == set()


def test_redaction(spark, tmp_path):
    own = [(1, "to a@b.co, from 1.2.3.4!", "en", None, 3), (2, None, None, "s", None), (3, "", None, None, None), (4, "é +1 (017) 555-7713 a@b.co a@b.co", None, None, None), (5, "clean", None, None, None)]
    docs = frame(spark, own)
    out = pii.redact(docs, pii.train([]))
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "to <EMAIL>, from <IP>!", 2: None, 3: "", 4: "é <PHONE> <EMAIL> <EMAIL>", 5: "clean"}


def test_long_runs_take_linear_time_and_no_stack(spark):
    long = ["a" * 300_000, "1" * 300_000, "a@" + "b." * 100_000, "1." * 100_000, "1 " * 100_000, "+1" + "(" * 200_000, "+1 " * 60_000, "A" * 100_000 + " at " + "b" * 100_000, ". " * 100_000]
    got = pii.find(spark.createDataFrame(list(enumerate(long)), "doc_id long, text string"), pii.train([])).select("doc_id", F.size("__sg_base").alias("n")).collect()
    assert len(got) == len(long)


def test_expectation_maximisation_rates_labelers():
    rng = random.Random(0)
    counts = {}
    for _ in range(4000):
        y = rng.random() < 0.3
        v = tuple((1 if y else -1) if rng.random() < a else 0 if rng.random() < 0.5 else (-1 if y else 1) for a in (0.9, 0.8, 0.7, 0.6, 0.5))
        counts[v, y] = counts.get((v, y), 0) + 1
    pooled = {}
    for (v, _), n in counts.items():
        pooled[v] = pooled.get(v, 0) + n
    patterns = [("ssn", v, n) for v, n in sorted(pooled.items())]
    p = dict(zip(sorted(pooled), pii.reliabilities(patterns)))
    right = sum(n for (v, y), n in counts.items() if (p[v] > 0.5) == y)
    assert right > 0.93 * 4000
    w = pii.train(patterns)
    z = lambda v: w["kind", "ssn"] + sum(w[k, x] for k, x in enumerate(v))
    assert sum(n for (v, y), n in counts.items() if (z(v) > 0) == y) > 0.9 * 4000


def test_empty(spark, tmp_path):
    assert pii.query(spark, save(spark, tmp_path, [])).collect() == []


def test_every_candidate_bears_the_sign(spark):
    own = ["joe at host [dot] com", "joe at host (dot) com", "joe at host dot com", "joe [at] host [dot] com", "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5", "12-3 4-567 8-9 012 3-45", "1 234-5 678-90 12 345", "Sra. Élan", "Sr Peter", "Mme Õlen", "12 34 56 78 90 12 34 56", "123-45-6789", "(212) 555-0100", "212.555.0100", "DE12ABCDEFGHIJKL", "GB82 WEST ABCD EFGH", "Dr. Anna Weber", "my name is Anna", "Ich heisse Anna", "ich heiße Anna", "je m'appelle Anna", "Me llamo Anna"]
    rng = random.Random(1)
    runs = ["".join(rng.choice("0123456789") + rng.choice(["", "", " ", "-"]) for _ in range(rng.randint(14, 20))) for _ in range(1000)]
    df = spark.createDataFrame([(t,) for t in own + runs + [noise(rng) for _ in range(2000)]], "text string")
    pattern = "|".join(f"(?:{p})" for _, p in pii.CANDIDATES)
    got = df.select("text", F.col("text").rlike(pattern).alias("found"), pii.has_sign(F.col("text")).alias("sign")).collect()
    assert all(r.found for r in got[: len(own)])
    assert [r.text for r in got if r.found and not r.sign] == []
    alone = pii.with_candidates(pii.with_base(spark.createDataFrame([(t,) for t in own[:2]], "text string")))
    assert [len(r["__sg_more"]) for r in alone.collect()] == [1, 1]


#: Sentences around a value, with what they hold: true ones and look-alikes; the last of each kind are held out.
FRAMES = {
    "phone": (["call me at {}", "my phone is {}", "tel. {} any time", "mobile: {}", "reach us by phone, {}"], ["order no. {} shipped", "part {} is out of stock", "serial {}", "invoice {} due", "item id {} sold"]),
    "ssn": (["my ssn is {}", "social security number {}", "SSN: {}", "his social security no. {}", "tax id {}"], ["order {} arrived", "model {} rev b", "ref {}", "part no. {}", "invoice {}"]),
    "iban": (["pay to account {}", "IBAN {}", "konto {}", "bank account: {}", "my iban: {}"], ["serial {}", "build hash {}", "part number {}", "token {}", "sku {}"]),
    "name": (["Dear {}, hello", "signed, {}", "regards, {}", "contact {} soon", "your patient {}"], []),
}


def made(rng, kind):
    d = lambda n, first="23456789": rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(n - 1))
    return {
        "phone": lambda: f"({d(3)}) {d(3)}-{d(4)}", "ssn": lambda: f"{d(3, '12345')}-{d(2, '123456789')}-{d(4, '123456789')}", "iban": lambda: f"DE{d(2)} {d(4)} {d(4)} {d(4)} {d(4)} {d(2)}",
        "name": lambda: f"Dr. {rng.choice(['Anna', 'Peter', 'Maria', 'Xandra'])} {rng.choice(['Weber', 'Smith', 'Moreau'])}",
    }[kind]()


@pytest.mark.parametrize("seed", [1, 2])
def test_added_spans_on_held_out_sentences(spark, seed):
    rng, own, want = random.Random(seed), [], {}
    for i in range(1500):
        kind = rng.choice(list(FRAMES))
        good = rng.random() < 0.6 or not FRAMES[kind][1]
        frames, held = FRAMES[kind][0 if good else 1], rng.random() < 0.3
        value, frame_ = made(rng, kind), frames[-1] if held else rng.choice(frames[:-1])
        at = frame_.index("{}")
        own.append((i, frame_.format(value)))
        want[i] = (held, f"{kind}:{at}:{at + len(value)}" if good else "")
    docs = spark.createDataFrame(own, "doc_id long, text string")
    found = pii.extract(docs).cache()
    got = {r.doc_id: r.told for r in pii.spans(found, pii.fit(found)).select("doc_id", pii.told(F.col("__sg_spans")).alias("told")).collect()}
    found.unpersist()
    kept = [(want[i][1], got[i]) for i in got if want[i][0]]
    hits, said, true = sum(bool(w) and w in g.split(",") for w, g in kept), sum(bool(g) for _, g in kept), sum(bool(w) for w, _ in kept)
    assert hits >= 0.9 * true and hits >= 0.9 * said, (hits, said, true)


def test_features_learn_what_voters_do_not_see():
    from collections import namedtuple

    Row = namedtuple("Row", "kind feature bin yes no")
    w = pii.feature_weights([Row("ssn", 0, 3, 90.0, 10.0), Row("ssn", 0, 4, 10.0, 90.0), Row("ssn", 0, 5, 1.0, 0.0)])
    k = pii.KINDS.index("ssn") * pii.BINS
    assert w[0][k + 3] > 0.5 and w[0][k + 4] < -0.5 and 0 < w[0][k + 5] < 0.1 and w[1][k + 3] == 0
