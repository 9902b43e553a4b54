"""Personal data by weak supervision, in DataFrame expressions only.

Base spans come from four patterns with their checks. Other words with a
digit or an ``@`` are candidates: regex, gazetteer, context and shape
labelers vote on each (for, against, abstain). Expectation-maximisation over
the counts of vote patterns (at most 3^4 rows, whatever the corpus) estimates
how reliable each labeler is and how likely each vote pattern is personal
data; a naive Bayes classifier over bounded features of the span and its
context is then trained with those posteriors. Candidates that it accepts and
that overlap no base span are added, as kind ``other``.

Defined results: null text counts as empty; a candidate is judged alone, so
repeated rows get equal spans; without any candidate nothing is added; other
columns are carried only when named in ``keep``. Positions are code points,
ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorlake.llm.util import prepare

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"

#: Fixed patterns of the base kinds. Where a failed start could be retried at
#: every later character of the same run, a start inside a run is allowed
#: only where the last match ended (``\G``); this finds the same spans.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

CANDIDATE = r"(?:\G|(?<![^ \t\n\x0B\f\r]))[^ \t\n\x0B\f\r0-9@]*+[0-9@][^ \t\n\x0B\f\r]*+"
CORE = r"[0-9A-Za-z+@](?:[^ \t\n\x0B\f\r]*[0-9A-Za-z])?"
CONTEXT = 24

#: Fixed word lists of the labelers.
CUES = ("token", "key", "secret", "password", "passwd", "pwd", "phone", "tel", "call", "mobile", "fax",
        "mail", "e-mail", "contact", "card", "account", "iban", "ssn", "id", "ip", "address", "login", "user")
PLAIN_CUES = ("version", "license", "section", "chapter", "page", "copyright", "figure", "table", "no", "vol")
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info")
N_LABELERS = 4

#: feature -> number of values
FEATURES = {"shape": 256, "length": 17, "digits": 11, "cue": 256}
EM_ROUNDS = 50


def _matches(text: Column, pattern: str) -> Column:
    """Spans of ``pattern``: array of (start, end, value, before)."""
    parts = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # a match starts after all parts and matches before it
    first = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,end:int,value:string,before:string>>").alias("out"))
    pairs = F.arrays_zip(values.alias("value"), F.slice(parts, 1, F.size(values)).alias("part"))

    def step(acc, p):
        start = acc["at"] + F.length(p["part"])
        end = start + F.length(p["value"])
        one = F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"),
                       F.right(p["part"], F.lit(CONTEXT)).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(pairs, first, step, lambda acc: acc["out"])


_NONE = "array<struct<start:int,end:int,value:string,before:string>>"


def _when(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_NONE))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def step(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        d = _digits(value)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: _valid(kind, s["value"])


def base_spans(text: Column) -> list[Column]:
    """One array of checked spans for each of ``KINDS``."""
    digit = text.rlike("[0-9]")
    out = []
    for kind in KINDS:
        need = digit if kind != "email" else F.lit(True)
        if kind in NEEDS:
            need = F.contains(text, F.lit(NEEDS[kind])) & need
        spans = _when(need, _matches(text, PATTERNS[kind]))
        out.append(F.filter(spans, _check(kind)).alias(f"__{kind}"))
    return out


def candidates(text: Column) -> Column:
    """Words with a digit or an @, cut to their core."""
    found = _when(text.rlike("[0-9@]"), _matches(text, CANDIDATE))

    def core(s):
        value = F.regexp_extract(s["value"], CORE, 0)
        start = s["start"] + F.instr(s["value"], value) - 1
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
                        F.lower(s["before"]).alias("before"))

    return F.filter(F.transform(found, core), lambda s: s["value"].rlike("[0-9@]"))


def _one_of(words) -> str:
    return r"(?:^|[^a-z])(?:" + "|".join(words) + r")[^a-z]*$"


def votes(s: Column) -> Column:
    """The labelers' votes on a span as one number: a base-3 digit each, 0
    against, 1 abstain, 2 for."""
    value, before, low = s["value"], s["before"], F.lower(s["value"])
    n_digits = F.length(_digits(value))
    vote = lambda yes, no: F.when(yes, 2).when(no, 0).otherwise(1)
    regex = vote(
        value.rlike(r"^[^@]+@[^@]+$|^[0-9a-fA-F]{16,}$|^\+?[0-9][0-9().-]{6,}$|^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"),
        value.rlike(r"^[0-9]{1,4}$|^[0-9]+(?:[.,][0-9]+)?$"))
    gazetteer = vote(
        low.rlike(r"[@.](?:" + "|".join(DOMAINS) + r")(?:[^a-z]|$)") & low.rlike("[@]"),
        low.rlike(r"^(?:19|20)[0-9]{2}$|^v?[0-9]+(?:\.[0-9]+){1,2}$"))
    context = vote(before.rlike(_one_of(CUES)), before.rlike(_one_of(PLAIN_CUES)))
    shape = vote((F.length(value) >= 12) & (2 * n_digits >= F.length(value)), F.length(value) <= 5)
    out = F.lit(0)
    for v in (regex, gazetteer, context, shape):
        out = out * 3 + v
    return out


def features(s: Column) -> dict[str, Column]:
    value = s["value"]
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
    cue = F.regexp_extract(s["before"], r"([a-z]+)[^a-z]*$", 1)
    return {
        "shape": F.pmod(F.xxhash64(shape), F.lit(FEATURES["shape"])),
        "length": F.least(F.floor(F.length(value) / 4), F.lit(16)),
        "digits": F.floor(10 * F.length(_digits(value)) / F.greatest(F.length(value), F.lit(1))),
        "cue": F.pmod(F.xxhash64(cue), F.lit(FEATURES["cue"])),
    }


@dataclass(frozen=True)
class Model:
    reliability: list  # for each labeler: [class][vote] probabilities
    prior: float  # log odds
    weights: dict[str, list[float]]  # log odds of each feature value


def expectation_maximisation(counts: dict[int, int]) -> tuple[list, dict[int, float]]:
    """Labeler reliabilities and the posterior of each vote pattern."""
    def digits(code):
        return [code // 3 ** (N_LABELERS - 1 - k) % 3 for k in range(N_LABELERS)]

    # start: the majority of votes
    post = {c: 1 / (1 + math.exp(-(sum(digits(c)) - N_LABELERS))) for c in counts}
    reliability = []
    for _ in range(EM_ROUNDS):
        mass = [sum(n * (post[c] if y else 1 - post[c]) for c, n in counts.items()) for y in (0, 1)]
        reliability = []
        for k in range(N_LABELERS):
            table = [[1.0] * 3, [1.0] * 3]
            for c, n in counts.items():
                table[1][digits(c)[k]] += n * post[c]
                table[0][digits(c)[k]] += n * (1 - post[c])
            reliability.append([[x / sum(row) for x in row] for row in table])
        for c in counts:
            odds = math.log((mass[1] + 1) / (mass[0] + 1))
            odds += sum(math.log(reliability[k][1][v] / reliability[k][0][v]) for k, v in enumerate(digits(c)))
            post[c] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return reliability, post


def fit(docs: DataFrame) -> Model | None:
    """Reliabilities and classifier from all candidates of ``docs``."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = docs.filter("text IS NOT NULL").select(F.explode(candidates(text)).alias("s"))
    values = spans.select(votes(F.col("s")).alias("votes"), *(x.alias(n) for n, x in features(F.col("s")).items()))
    long = values.select("votes", F.explode(F.array(*(
        F.struct(F.lit(n).alias("feature"), F.col(n).cast("int").alias("value")) for n in FEATURES))).alias("f"))
    # at most 81 patterns x 540 feature values
    rows = long.groupBy("votes", "f.feature", "f.value").agg(F.count("*").alias("n")).collect()
    counts: dict[int, int] = {}
    for r in rows:
        if r["feature"] == "shape":
            counts[r["votes"]] = counts.get(r["votes"], 0) + r["n"]
    if not counts:
        return None
    reliability, post = expectation_maximisation(counts)
    mass = [sum(n * (post[c] if y else 1 - post[c]) for c, n in counts.items()) for y in (0, 1)]
    weights = {}
    for name, size in FEATURES.items():
        table = [[1.0] * size, [1.0] * size]
        for r in rows:
            if r["feature"] == name:
                table[1][r["value"]] += r["n"] * post[r["votes"]]
                table[0][r["value"]] += r["n"] * (1 - post[r["votes"]])
        weights[name] = [math.log(table[1][v] / (mass[1] + size)) - math.log(table[0][v] / (mass[0] + size))
                         for v in range(size)]
    return Model(reliability, math.log((mass[1] + 1) / (mass[0] + 1)), weights)


def _score(s: Column, model: Model) -> Column:
    out = F.lit(model.prior)
    for name, x in features(s).items():
        out = out + F.element_at(F.array(*(F.lit(w) for w in model.weights[name])), x.cast("int") + 1)
    return out


def detect(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, n_<kind> for the base kinds, and spans: (start, end,
    kind) by start; ``base`` tells the base spans."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, *base_spans(text),
                       (_when(F.lit(False), F.lit(None).cast(_NONE)) if model is None else candidates(text)).alias("__extra"))
    span = "array<struct<start:int,rank:int,end:int,kind:string,base:boolean>>"

    def shaped(c: Column, rank: int, kind: str, base: bool) -> Column:
        return F.transform(c, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), F.lit(base).alias("base"))).cast(span)

    found = F.concat(*(shaped(F.col(f"__{k}"), i, k, True) for i, k in enumerate(KINDS)))
    rows = rows.select(*keep, *(F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS),
                       found.alias("__base"), "__extra")
    if model is None:
        extra = F.array().cast(span)
    else:
        good = F.filter("__extra", lambda s: ~F.exists(
            "__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        extra = shaped(F.filter(good, lambda s: _score(s, model) > 0), len(KINDS), OTHER, False)
    return rows.select(*keep, *(f"n_{k}" for k in KINDS),
                       F.array_sort(F.concat("__base", extra)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", *(f"n_{k}" for k in KINDS),
        F.sha2(_joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def redact(result: DataFrame) -> DataFrame:
    """``text`` with each span replaced by ``<KIND>``; of overlapping spans
    the first names the replacement. Needs ``text`` among the kept columns."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        start = F.greatest(acc["at"], s["start"])
        piece = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, start - acc["at"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(piece, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", first, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return result.withColumn("text", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")))
