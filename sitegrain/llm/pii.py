"""Personal data by weak supervision, in DataFrame operations only.

Certain kinds (email, ip, card, phone) come from patterns with checks; these
spans always stay. A second pattern proposes more candidates (obfuscated
emails, national phone numbers, card-like numbers, social security numbers,
IBANs, names after a title or an introduction). Five labelers vote on each: its
shape, a gazetteer, context words before it, contrary context words, its
borders. Expectation-maximisation over counts of vote patterns estimates the
labelers' reliabilities. The span classifier learns from the posterior: a
logistic part over kind and votes, and a part of its own over what the
labelers don't see (hashed words left and right, layout of letters and
digits, length, the character before), whose weights are damped log-odds of
soft counts. A candidate becomes a span if its score is at least one half.
What reaches the driver is the table of vote patterns and the table of
features' soft counts, whose sizes are fixed.

Texts are searched once: base spans and candidates, with votes and features,
are written, the model is fitted on what was written and applied to it.

Positions are code points, ends exclusive. Patterns are written without
backtracking (possessive, anchored at the begin of a run), so very long runs
cost linear time and no stack.

Edge cases: a null text counts as empty and has no span (a redacted null stays
null); overlapping spans are all told, redaction covers their union; without a
candidate in the corpus the labelers count equally; an empty table gives an
empty result; rows that repeat a doc_id are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, once, read_table

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "name")
BASE = KINDS[:4]
# Leftmost matches start where a run starts (or where the last match ended), so runs are taken whole.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
# the whole run of digits with single separators, if it has 14 digits at least
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])){3}$"

_NAME = r"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ'-]{1,30}+"
#: Kind, pattern: alternatives of the candidates' pattern.
CANDIDATES = (
    ("email", r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}+){1,4}+"),
    ("card", CARD),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"),
    ("name", rf"(?<![A-Za-zÀ-ÿ])(?:(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme)\.? |(?:[Mm]y name is|[Ii]ch hei(?:ß|ss)e|[Jj]e m'appelle|[Mm]e llamo) ){_NAME}(?: {_NAME})?+"),
)
#: In every text with a candidate, whatever the alternative, is one of these; others aren't searched. Patterns begin with
#: what prose has little of (a digit, a capital), so that a text is passed quickly: three digits and a mark, four digits,
#: short runs of digits with marks between, digits after two capitals; a title before a capital.
SIGNS = (r"[0-9](?:[0-9]{2}[ .)-]|[0-9]{3}|[0-9]{0,2}[ -](?:[0-9]{1,3}[ -]){3}|(?<=[A-Z]{2}[0-9])[0-9])", r"(?:M(?:rs?|s|me)|Dr|Prof|Herr|Frau|Sra?)\.? [A-ZÀ-ÖØ-Þ]")
SIGN_WORDS = ("[at]", "(at)", " dot ", "[dot]", "(dot)", "y name is ", "ch hei", "e m'appelle", "e llamo")


def has_sign(text: Column) -> Column:
    hit = F.lit(False)
    for w in SIGN_WORDS:
        hit = hit | F.contains(text, F.lit(w))
    for p in SIGNS:
        hit = hit | text.rlike(p)
    return hit


# Gazetteers and context words.
TLDS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "ai", "app", "dev", "me", "tv", "co", "us", "ca", "uk", "ie", "de", "at", "ch", "fr", "be", "lu", "nl", "es", "pt", "it", "pl", "cz", "se", "no", "dk", "fi", "gr", "eu", "au", "nz", "jp", "cn", "in", "br", "mx", "ar", "ru")
FIRST_NAMES = tuple(
    "james mary john linda robert anna maria peter hans karl sophie marie jean pierre jose juan carmen luis david sarah michael laura thomas julia "
    "william richard joseph charles christopher daniel matthew anthony mark paul steven andrew george kevin brian edward susan jessica karen nancy lisa emily emma olivia sophia grace alice helen ruth "
    "klaus jürgen wolfgang stefan andreas markus sabine petra monika ursula heike claudia katharina lena jonas lukas felix max "
    "michel jacques françois philippe nicolas julien antoine isabelle catherine nathalie camille chloé claire "
    "carlos miguel antonio manuel francisco javier pedro alejandro sofía lucía isabel elena pilar rosa ana".split()
)
COUNTRIES = ("DE", "FR", "ES", "GB", "IT", "NL", "BE", "AT", "CH", "PT", "IE", "LU", "PL", "SE", "DK", "FI", "NO", "AD", "BG", "CY", "CZ", "EE", "GR", "HR", "HU", "IS", "LI", "LT", "LV", "MC", "MT", "RO", "SI", "SK", "SM")
CUES = {
    "email": r"e-?mail|contact|write|reach|mailto|schreib|correo|courriel",
    "card": r"card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta",
    "ssn": r"ssn|social security|soc\.? sec|tax id",
    "phone": r"phone|tel|call|mobile|cell|fax|anruf|telefon|appel|llam",
    "iban": r"iban|account|konto|compte|cuenta|bank",
    "name": r"name|dear|contact|patient|signed|from|regards|sehr geehrte|cher|estimad",
}
CONTRARY = r"order|invoice|version|isbn|serial|ref|part|model|item|fig|page|id[:=#]|sku|token|hash|build"


FOUND = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches, leftmost first, without overlaps: ``start, end, value, before, after`` (at most 40 code points since the last match, 24 up to the next).

    The text is searched once: matches are put between two control characters
    (the text's own give way to a third, which no pattern tells from them) and
    the text is parted there.
    """
    marked = F.regexp_replace(F.translate(text, "\x01\x02", "\x03\x03"), pattern, "\x01$0\x02")

    def step(acc: Column, part: Column) -> Column:
        m = F.substring_index(part, "\x02", 1)

        def after(gap: Column) -> Column:
            end = acc["at"] + F.length(m)
            one = F.struct(acc["at"].alias("start"), end.alias("end"), m.alias("value"), acc["before"].alias("before"), F.left(gap, F.lit(24)).alias("after"))
            return F.struct((end + F.length(gap)).alias("at"), F.right(gap, F.lit(40)).alias("before"), F.concat(acc["out"], F.array(one)).alias("out"))

        return once(F.substring(part, F.length(m) + 2, F.length(part)), after)

    def told(parts: Column) -> Column:
        first = F.element_at(parts, 1)
        start = F.struct(F.length(first).cast("long").alias("at"), F.right(first, F.lit(40)).alias("before"), F.array().cast(FOUND).alias("out"))
        return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step, lambda acc: acc["out"])

    return once(F.split(marked, "\x01", -1), told)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits' weighted sum is a multiple of ten."""
    own = F.reverse(digits(value))

    def weigh(k: Column) -> Column:
        d = F.substring(own, k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(own)), weigh), F.lit(0), lambda a, b: a + b) % 10 == 0


def spans_of(found: Column, kind: str, valid=None) -> Column:
    kept = F.filter(found, lambda s: valid(s["value"])) if valid else found
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end")))


NO_SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"


def with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__sg_base``: the certain kinds' spans, by start and kind. Patterns only run on texts that have their sign."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = lambda v: F.length(digits(v))
    plans = (
        ("email", EMAIL, F.contains(text, F.lit("@")), None),
        ("ip", IP, text.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(OCTETS)),
        ("card", CARD, text.rlike(r"(?:[0-9][ -]?){13}[0-9]"), lambda v: (count(v) <= 19) & luhn(v)),
        ("phone", PHONE, F.contains(text, F.lit("+")), lambda v: count(v).between(10, 15)),
    )
    for kind, pattern, sign, valid in plans:
        docs = docs.withColumn(f"__sg_{kind}", F.when(sign, spans_of(matches(text, pattern), kind, valid)).otherwise(F.array().cast(NO_SPANS)))
    return docs.withColumn("__sg_base", F.array_sort(F.concat(*[f"__sg_{k}" for k in BASE])))


def votes_of(c: Column) -> list[Column]:
    """The five labelers' votes (-1, 0, 1) on a candidate ``kind, value, before``."""
    kind, value, before = c["kind"], c["value"], F.lower(c["before"])
    low, n = F.lower(value), F.length(digits(value))
    vote = lambda yes, no=None: F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)
    tail = F.regexp_extract(low, r"([a-z0-9-]+)$", 1)
    first = F.element_at(F.split(F.regexp_replace(low, r"^.*?(?:\. |is |e |le |lo )", ""), " "), 1)
    shape = (
        F.when(kind == "email", vote(low.rlike(r"\[at\]|\(at\)"), low.rlike(r"^[a-z]+ at ")))
        .when(kind == "card", vote(n == 16, n > 19))
        .when(kind == "ssn", vote(~value.rlike(r"^(?:000|666|9..)|-00-|-0000$"), value.rlike(r"^(?:000|666|9..)|-00-|-0000$")))
        .when(kind == "phone", vote(value.rlike(r"^\(?[2-9][0-9]{2}\)?.[2-9]"), value.rlike(r"^\(?[01]")))
        .when(kind == "iban", vote(n >= 10, n < 6))
        .otherwise(vote(low.rlike(r"[a-zà-ÿ]{2,} [a-zà-ÿ'-]{2,}$")))
    )
    gazetteer = (
        F.when(kind == "email", vote(tail.isin(*TLDS), ~tail.isin(*TLDS)))
        .when(kind == "card", vote(value.rlike(r"^(?:4|5[1-5]|3[47]|6)")))
        .when(kind == "iban", vote(F.substring(value, 1, 2).isin(*COUNTRIES), ~F.substring(value, 1, 2).isin(*COUNTRIES)))
        .when(kind == "name", vote(first.isin(*FIRST_NAMES)))
        .otherwise(F.lit(0))
    )
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | ((kind == k) & before.rlike(words))
    return [shape, gazetteer, vote(cue), F.when(before.rlike(CONTRARY), -1).otherwise(0), F.when(before.rlike(r"[0-9a-zà-ÿ_/=]$"), -1).otherwise(0)]


N_VOTES = 5
#: Bins of a feature a kind; soft counts that stand against a bin's own; the share of a feature's log-odds that counts.
BINS, PRIOR, DAMP = 64, 20.0, 0.5


def features_of(c: Column) -> list[Column]:
    """Bins of what the labelers don't see: the two words before, the word after, the layout, the length, the character before."""
    before, after = F.lower(c["before"]), F.lower(c["after"])
    layout = F.regexp_replace(F.regexp_replace(F.regexp_replace(c["value"], "[0-9]", "9"), "[A-ZÀ-ÖØ-Þ]", "A"), "[a-zà-öø-ÿ]+", "a")
    words = [F.regexp_extract(before, r"([a-zà-ÿ]+)[^a-zà-ÿ]*$", 1), F.regexp_extract(before, r"([a-zà-ÿ]+)[^a-zà-ÿ]+[a-zà-ÿ]+[^a-zà-ÿ]*$", 1), F.regexp_extract(after, r"^[^a-zà-ÿ]*([a-zà-ÿ]+)", 1)]
    hashed = [F.pmod(F.xxhash64(x), F.lit(BINS)).cast("int") for x in (*words, layout, F.right(before, F.lit(1)))]
    return [*hashed, F.least(F.length(c["value"]), F.lit(BINS - 1))]


N_FEATURES = 6


def with_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__sg_more``: candidates that don't overlap a certain span, as ``start, rank, end, kind, v0..v4, bins``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pattern = "|".join(f"(?:{p})" for _, p in CANDIDATES)
    sign = has_sign(text)
    docs = docs.withColumn("__sg_found", F.when(sign, matches(text, pattern)).otherwise(F.array().cast(FOUND)))

    def kind_of(v: Column) -> Column:
        out = None
        for kind, p in CANDIDATES:  # lookarounds at the borders hold already
            test = v.rlike("^(?:" + p.replace("(?![0-9-])", "").replace("(?![A-Za-z0-9])", "") + ")$")
            out = F.when(test, kind) if out is None else out.when(test, kind)
        return out.otherwise("name")

    apart = F.filter("__sg_found", lambda s: ~F.exists("__sg_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    kinds = F.transform(apart, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["before"].alias("before"), s["after"].alias("after"), kind_of(s["value"]).alias("kind")))

    def told(c: Column) -> Column:
        rank = F.lit(len(KINDS))
        for k, kind in enumerate(KINDS):
            rank = F.when(c["kind"] == kind, k).otherwise(rank)
        return F.struct(c["start"].alias("start"), rank.alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"), *[v.alias(f"v{k}") for k, v in enumerate(votes_of(c))], F.array(*features_of(c)).alias("bins"))

    return docs.withColumn("__sg_kinds", kinds).withColumn("__sg_more", F.transform("__sg_kinds", told))


def reliabilities(patterns: list[tuple], rounds: int = 50) -> list[float]:
    """Posterior of each ``(kind, votes, count)`` by expectation-maximisation: a rate of every vote under either class for each labeler, a prior for each kind."""
    p = [1 / (1 + math.exp(-1.5 * sum(v) + 0.5)) for _, v, _ in patterns]
    for _ in range(rounds):
        rates: dict[tuple, float] = {}
        mass = [1.0, 1.0]
        prior: dict[str, list[float]] = {}
        for (kind, votes, n), q in zip(patterns, p):
            for c, share in ((0, n * (1 - q)), (1, n * q)):
                mass[c] += share
                for k, v in enumerate(votes):
                    rates[c, k, v] = rates.get((c, k, v), 0.0) + share
            own = prior.setdefault(kind, [1.0, 1.0])
            own[0] += n * (1 - q)
            own[1] += n * q
        new = []
        for kind, votes, _ in patterns:
            z = math.log(prior[kind][1] / prior[kind][0])
            for k, v in enumerate(votes):
                # labelers are taken to be better than chance: that is what tells the classes apart
                guess = [(rates.get((c, k, v), 0.0) + (2.0 if v == (1 if c else -1) else 1.0)) / (mass[c] + 4.0) for c in (0, 1)]
                z += math.log(guess[1] / guess[0])
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        p = new
    return p


def train(patterns: list[tuple], rounds: int = 400) -> dict:
    """Weights of the span classifier: a bias a kind, a weight for every vote of every labeler."""
    weights = {("kind", k): -0.5 for k in KINDS} | {(k, v): 1.5 * v for k in range(N_VOTES) for v in (-1, 0, 1)}
    if not patterns:
        return weights
    total, target = sum(n for *_, n in patterns), reliabilities(patterns)
    for _ in range(rounds):
        slope = dict.fromkeys(weights, 0.0)
        for (kind, votes, n), y in zip(patterns, target):
            keys = [("kind", kind), *enumerate(votes)]
            e = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in keys))))) - y)
            for k in keys:
                slope[k] += e
        for k in weights:
            weights[k] -= 1.0 * (slope[k] + 1e-4 * weights[k])
    return weights


def extract(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the certain kinds' spans and the candidates; the one search of the texts."""
    rows = with_candidates(with_base(docs, text_col), text_col)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *[f"__sg_{k}" for k in BASE], "__sg_base", "__sg_more")


def fit(found: DataFrame) -> dict:
    """The classifier, from counts of vote patterns and features over all documents' candidates (rows of ``extract``)."""
    seen = found.select(F.explode("__sg_more").alias("c"))
    votes = [f"c.v{k}" for k in range(N_VOTES)]
    counts = seen.groupBy("c.kind", *votes).agg(F.count(F.lit(1)).alias("n")).collect()  # kinds times 3**5 rows at most
    patterns = sorted((r[0], tuple(r[1 : 1 + N_VOTES]), r.n) for r in counts)
    model = train(patterns)
    if patterns:
        belief = {f"{kind}:{','.join(map(str, votes))}": q for (kind, votes, _), q in zip(patterns, reliabilities(patterns))}
        held = F.create_map(*[F.lit(x) for kv in belief.items() for x in kv])
        pattern = F.concat(F.col("c.kind"), F.lit(":"), F.concat_ws(",", *[F.col(v).cast("string") for v in votes]))
        soft = seen.select("c.kind", held[pattern].alias("q"), F.posexplode("c.bins").alias("feature", "bin")).groupBy("kind", "feature", "bin").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no"))
        model["features"] = feature_weights(soft.collect())  # kinds times features times bins at most
    return model


def feature_weights(rows) -> list[list[float]]:
    """For each feature, the weight of every bin of every kind: its log-odds over the kind's, both soft counts, damped."""
    out = [[0.0] * (len(KINDS) * BINS) for _ in range(N_FEATURES)]
    whole: dict[tuple, list[float]] = {}
    for r in rows:
        own = whole.setdefault((r.kind, r.feature), [0.0, 0.0])
        own[0] += r.yes
        own[1] += r.no
    for r in rows:
        yes, no = whole[r.kind, r.feature]
        share = (yes + 1e-3) / (yes + no + 2e-3)
        odds = math.log((r.yes + PRIOR * share) / (r.no + PRIOR * (1 - share))) - math.log(share / (1 - share))
        out[r.feature][KINDS.index(r.kind) * BINS + r.bin] = DAMP * max(-2.0, min(2.0, odds))
    return out


def spans(found: DataFrame, model: dict) -> DataFrame:
    """Adds ``__sg_spans`` (all spans) to rows of ``extract``: arrays of ``start, rank, end`` by start, then kind."""
    tables = [F.array(*[F.lit(w) for w in own]) for own in model["features"]] if model.get("features") else []

    def score(c: Column) -> Column:
        z = F.lit(0.0)
        for k in KINDS:
            z = z + F.when(c["kind"] == k, model["kind", k]).otherwise(0.0)
        for k in range(N_VOTES):
            for v in (-1, 0, 1):
                z = z + F.when(c[f"v{k}"] == v, model[k, v]).otherwise(0.0)
        for k, table in enumerate(tables):
            z = z + F.element_at(table, c["rank"] * BINS + c["bins"][k] + 1)
        return z

    plain = lambda c: F.struct(c["start"].alias("start"), c["rank"].cast("int").alias("rank"), c["end"].alias("end"))
    return found.withColumn("__sg_spans", F.array_sort(F.concat("__sg_base", F.transform(F.filter("__sg_more", lambda c: score(c) >= 0), plain))))


def find(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The documents with ``__sg_base`` and ``__sg_spans``, under a given model."""
    return spans(extract(docs, text_col), model)


def told(found: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: dict | None = None, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind, as ``<EMAIL>``; all columns stay."""
    if model is None:  # search once, learn from what was found, then redact
        found = Workspace(docs.sparkSession, "pii").write(extract(docs, text_col).drop(*[f"__sg_{k}" for k in BASE]), "found")
        found = spans(found, fit(found))
    else:
        found = find(docs, model, text_col)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<skip:bigint,start:bigint,rank:int,end:bigint>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        one = F.struct(acc["at"].alias("skip"), s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))
        # a span that begins inside the last one only moves the end
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    merged = F.aggregate("__sg_spans", start, step)
    found = found.withColumn("__sg_cut", merged)
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text = F.col(text_col)
    part = lambda a, n: F.substring(text, (a + 1).cast("int"), n.cast("int"))
    pieces = F.transform("__sg_cut.out", lambda s: F.concat(part(s["skip"], s["start"] - s["skip"]), F.element_at(names, s["rank"] + 1)))
    rest = part(F.col("__sg_cut.at"), F.length(text) - F.col("__sg_cut.at"))
    clean = F.when(F.size("__sg_spans") == 0, text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir):
    """op5: personal data in every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = Workspace(spark, "op5").write(extract(docs).drop("text"), "found")
    found = spans(found, fit(found))
    counts = [F.size(f"__sg_{k}").cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(told(F.col("__sg_base")), 256).alias("base_sha256"), told(F.col("__sg_spans")).alias("spans"))
