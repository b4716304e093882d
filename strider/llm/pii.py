"""Personal data by weak supervision, in DataFrame operations only.

Strict patterns give the base spans.  Strict and loose matches together are candidates; a
pattern labeler, a gazetteer labeler and two context labelers vote on each.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler
is; a logistic span classifier is trained on its posteriors and adds loose spans it accepts.

Texts are read once.  Positions are running sums over the pieces between the matches, and loose
spans meet base spans in one sorted pass, so the work is linear in the matches but for a sort;
context is the end of the piece before a match and the start of the piece after it.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strider.llm.common import named, running, staged, text_of

# The kinds in order and their strict patterns.  A match may start where the last
# one ended or where no character of its first run stands before: the leftmost start, found
# without trying every character of a long run.  Possessive, as no shorter run can match more.
KINDS = ["email", "ip", "card", "phone"]
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a strict match to be possible.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Looser forms of the same data.
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Gazetteers: endings of mail domains, issuer digits, area codes in use, loopback and private nets.
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?!(?:0|10|127|169\.254|192\.168|255)\.)",
    "card": r"^[3456]",
    "phone": r"^(?:\+|\(?[2-9][0-9]{2})",
}
#: Words before a match that speak for its kind.
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|address|courriel|correo)",
    "ip": r"(?i)(?:\bip\b|ipv[46]|host|server|address|client|node|login)",
    "card": r"(?i)(?:card|visa|master|credit|debit|payment|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|dial|number|anruf|appel|llam)",
}
#: Surroundings that speak against: the match is a part of a longer code, version or price.
AGAINST_BEFORE = r"(?i)(?:[A-Za-z0-9_=/#$€-]|version |token |order |isbn |id )$"
AGAINST_AFTER = r"^[A-Za-z0-9_/=%-]"
CONTEXT = 40
#: Below every negated place.
NOWHERE = -(1 << 62)
VOTERS = ["pattern", "gazetteer", "cue", "against"]
EM_ROUNDS = 40
ACCEPT = 0.5


def _octets_fit(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def valid(kind: str, match: Column) -> Column:
    """Whether a strict match passes the checks of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return _octets_fit(match)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _flag(yes: Column, no: Column | None = None) -> Column:
    otherwise = F.lit(0) if no is None else F.when(no, -1).otherwise(0)
    return F.when(yes, 1).otherwise(otherwise)


def _candidate(kind: str, strict: bool, found: Column, start: Column, before: Column, after: Column) -> Column:
    ok = valid(kind, found) if strict else F.lit(False)
    digits = F.regexp_replace(found, "[^0-9]", "")
    checked = {"card": F.call_function("luhn_check", digits), "phone": F.length(digits).between(8, 15)}.get(kind, F.lit(True))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), start.cast("int").alias("start"),
        (start + F.length(found)).cast("int").alias("end"), ok.alias("base"),
        (_flag(ok, ~ok) if strict else _flag(F.lit(False), ~checked)).alias("pattern"),
        _flag(found.rlike(GAZETTEER[kind]), ~found.rlike(GAZETTEER[kind])).alias("gazetteer"),
        _flag(before.rlike(CUES[kind])).alias("cue"),
        _flag(F.lit(False), before.rlike(AGAINST_BEFORE) | after.rlike(AGAINST_AFTER)).alias("against"),
        F.when(F.length(found) < 12, 0).when(F.length(found) < 20, 1).otherwise(2).alias("width"),
        F.least(F.length(F.regexp_replace(found, r"[A-Za-z0-9]", "")), F.lit(4)).alias("marks"))


def _found(df: DataFrame, kind: str, strict: bool, name: str) -> DataFrame:
    """Adds ``name``: the candidates of one kind and form in ``text``, in order."""
    pattern = (STRICT if strict else LOOSE)[kind]
    need = NEEDS[kind] if strict else {"email": "at", "ip": ":"}.get(kind)
    hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if need:
        hits = F.when(F.contains("text", F.lit(need)), hits).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("_hits", hits)
    df = df.withColumn("_gaps", F.when(F.size("_hits") > 0, F.split("text", pattern, -1)))
    df = df.withColumn("_pairs", F.transform("_hits", lambda m, i: F.struct(
        m.alias("m"), F.element_at("_gaps", i + 1).alias("before"), F.element_at("_gaps", i + 2).alias("after"))))
    widths = F.transform("_pairs", lambda p: (F.length(p["before"]) + F.length(p["m"])).cast("long"))
    made = F.zip_with("_pairs", running(widths, lambda a, b: a + b), lambda p, at: _candidate(
        kind, strict, p["m"], at + F.length(p["before"]), F.substring(p["before"], -CONTEXT, CONTEXT),
        F.substring(p["after"], 1, CONTEXT)))
    return df.withColumn(name, made).drop("_hits", "_gaps", "_pairs")


def _apart(loose: Column, base: Column) -> Column:
    """The loose spans that overlap no base span of their kind.

    Both in one order: the furthest end of the base spans before a loose span and the next
    start of those after it tell.  Loose spans come in that order already.
    """
    place = lambda c, name: F.shiftleft(c["kind"].cast("long"), 40) + c[name]
    event = lambda is_base: lambda c: F.struct(
        place(c, "start").alias("at"), place(c, "end").alias("to"), F.lit(is_base).alias("base"))
    events = F.array_sort(F.concat(F.transform(base, event(True)), F.transform(loose, event(False))))

    def met(every: Column) -> Column:
        ends = F.transform(every, lambda e: F.when(e["base"], e["to"]).otherwise(F.lit(0).cast("long")))
        starts = F.transform(F.reverse(every), lambda e: F.when(e["base"], -e["at"]).otherwise(F.lit(NOWHERE)))
        left = F.zip_with(every, running(ends, F.greatest), lambda e, end: F.struct(
            e["base"].alias("base"), e["to"].alias("to"), (end > e["at"]).alias("met")))
        both = F.zip_with(left, F.reverse(running(starts, F.greatest, NOWHERE)), lambda e, start: F.struct(
            e["base"].alias("base"), (e["met"] | (start > -e["to"])).alias("met")))
        return F.filter(both, lambda e: ~e["base"])
    free = F.array_compact(F.zip_with(loose, named(events, met), lambda c, e: F.when(~e["met"], c)))
    return F.when((F.size(loose) > 0) & (F.size(base) > 0), free).otherwise(loose)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, loose): arrays of candidate spans with their votes, in order of kind and
    start.  ``base`` has the strict matches that pass their checks."""
    df = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
    for kind in KINDS:
        df = _found(df, kind, True, f"s_{kind}")
        df = _found(df, kind, False, f"l_{kind}")
    base = F.concat(*[F.filter(f"s_{k}", lambda c: c["base"]) for k in KINDS])
    df = df.select("doc_id", base.alias("base"), F.concat(*[F.col(f"l_{k}") for k in KINDS]).alias("loose"),
                   F.concat(*[F.filter(f"s_{k}", lambda c: ~c["base"]) for k in KINDS]).alias("failed"))
    return df.withColumn("loose", _apart(F.col("loose"), F.col("base")))


def vote_counts(spans: DataFrame) -> DataFrame:
    """Candidates counted by kind, votes and shape: at most 4 * 3**4 * 3 * 5 rows."""
    every = spans.select(F.explode(F.concat("base", "loose", "failed")).alias("c")).select("c.*")
    return every.groupBy("kind", *VOTERS, "width", "marks").agg(F.count(F.lit(1)).alias("n"))


def reliabilities(counts: list) -> dict[tuple, float]:
    """Posterior that a candidate is real, by (kind, votes...), by expectation-maximisation.

    Each labeler has its own distribution over its votes for real and for false candidates of
    a kind; the start is the sign of the vote sum.
    """
    patterns: dict[tuple, int] = {}
    for r in counts:
        votes = (r["kind"], *(r[v] for v in VOTERS))
        patterns[votes] = patterns.get(votes, 0) + r["n"]
    real = {p: min(0.95, max(0.05, 0.5 + 0.3 * sum(p[1:]))) for p in patterns}
    for _ in range(EM_ROUNDS):
        weight = {}
        for p, n in patterns.items():
            for y, share in ((1, real[p]), (0, 1 - real[p])):
                weight[p[0], y] = weight.get((p[0], y), 0) + n * share
                for i, vote in enumerate(p[1:]):
                    weight[p[0], y, i, vote] = weight.get((p[0], y, i, vote), 0) + n * share
        for p in patterns:
            logs = []
            for y in (0, 1):
                total = weight[p[0], y]
                logs.append(math.log(total + 1) + sum(
                    math.log((weight.get((p[0], y, i, vote), 0) + 1) / (total + 3)) for i, vote in enumerate(p[1:])))
            real[p] = 1 / (1 + math.exp(max(-60.0, min(60.0, logs[0] - logs[1]))))
    return real


def _indicators(at) -> list[Column]:
    """Features of the span classifier; ``at`` gives a candidate's field."""
    out = [(at("kind") == k).cast("double") for k in range(len(KINDS))]
    for voter in VOTERS:
        out += [(at(voter) == 1).cast("double"), (at(voter) == -1).cast("double")]
    return [*out, (at("width") == 0).cast("double"), (at("width") == 2).cast("double"), at("marks").cast("double")]


def span_classifier(counts: DataFrame) -> tuple[list[float], float] | None:
    """Weights and intercept, trained on the counted patterns with the posteriors as labels;
    None without candidates."""
    rows = counts.collect()  # bounded: see vote_counts
    if not rows:
        return None
    real = reliabilities(rows)
    spark = counts.sparkSession
    soft = spark.createDataFrame(
        [(*(r[c] for c in counts.columns[:-1]), float(y), r["n"] * (p if y else 1 - p) + 1e-6)
         for r in rows for p in [real[(r["kind"], *(r[v] for v in VOTERS))]] for y in (0, 1)],
        ", ".join(f"{c} int" for c in counts.columns[:-1]) + ", label double, weight double")
    names = [f"f{i}" for i in range(len(_indicators(F.col)))]
    wide = soft.select("label", "weight", *[c.alias(n) for c, n in zip(_indicators(F.col), names)])
    data = VectorAssembler(inputCols=names, outputCol="features").transform(wide).select("label", "weight", "features")
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(data)
    return model.coefficients.toArray().tolist(), float(model.intercept)


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["kind"], c["start"], c["end"])))
    return F.array_join(F.transform(ordered, lambda c: F.concat_ws(
        ":", F.element_at(name, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Null text: empty, with no spans.  Null and repeated keys pass through, row by row.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    spans = staged(candidates(docs, key, text), "op2-spans")
    model = span_classifier(vote_counts(spans))
    added = F.array().cast(spans.schema["loose"].dataType)
    if model:
        weights, intercept = model
        least = math.log(ACCEPT / (1 - ACCEPT)) - intercept
        added = F.filter("loose", lambda c: sum(
            (f * w for f, w in zip(_indicators(lambda n: c[n]), weights)), F.lit(0.0)) >= least)
    counts = [F.size(F.array_remove(F.transform("base", lambda c: (c["kind"] == F.lit(k)).cast("int")), 0))
              .cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.withColumn("added", added).select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
