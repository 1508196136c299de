"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation
estimates how reliable each is, and a span classifier is trained on the resulting beliefs.

Candidates come from patterns. Labelers look at shape (regular expressions), known values (gazetteers)
and surroundings (context), and vote 1, 0 or nothing. Spans of the base kinds are always reported;
spans of other kinds if the classifier believes them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.spans import blocks, bound, joined, part, with_matches
from statloom.session import materialise

BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Monsieur", "Señor", "Señora"]
ADDED = {
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    "person": rf"\b(?:{'|'.join(TITLES)})\.? \p{{Lu}}\p{{L}}{{1,30}}",
}
KINDS = [*BASE, *ADDED]
# What a text must hold for a candidate of a kind: one of some strings, or digits that stand like this. It is far
# cheaper to look for than the pattern, which need not be tried on other texts.
STRINGS = {"email": ["@"], "phone": ["+"], "person": [t for t in TITLES if not any(t != u and u in t for u in TITLES)]}
AMONG_DIGITS = {
    "ip": r"\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?+[0-9]){12}",
    "local_phone": r"[0-9]{3}[ .-][0-9]{4}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}",
}
ROUNDS = 12
BELIEVED = 0.5

# Known values and words of the labelers.
DOMAIN_ENDS = r"\.(com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|nl|ch|at)$"
CALLING_CODES = r"^\+(1|33|34|39|41|43|44|49|52|54|61|81|86|91)(?![0-9]{12})"
PRIVATE_RANGES = r"^(0|10|127|169\.254|192\.168|172\.(1[6-9]|2[0-9]|3[01])|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)"
IBAN_COUNTRIES = r"^(AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)"
CUES = r"(?i)(e-?mail|contact|write to|phone|tel|call|fax|mobile|handy|correo|courriel|ip|host|server|card|visa|credit|karte|tarjeta|carte|ssn|social|iban|account|konto|name)[^A-Za-z0-9]{0,3}$"
COUNTERCUES = r"(?i)(version|isbn|issn|order|invoice|figure|table|page|build|serial|[#$€%=/]|\bno\.?|\bv)\s?$"

LABELERS = ["shape", "digits", "gazetteer", "cue", "countercue", "embedded"]
FEATURES = ["kind", "length", "digit_share", "separators", "before", "after"]
PLACED = "array<struct<kind:string,base:boolean,start:bigint,end:bigint,votes:array<int>,features:array<string>>>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    every = F.reverse(F.regexp_extract_all(hit, F.lit("[0-9]"), F.lit(0)))

    def value(d: Column, i: Column) -> Column:
        n = d.cast("int")
        twice = n * 2
        return F.when(i % 2 == 0, n).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(every, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_holds(kind: str, hit: Column) -> Column:
    n = F.char_length(digits(hit))
    if kind == "ip":
        return F.forall(F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0)), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return n.between(13, 19) & luhn(hit)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    return F.when(no, 0).when(yes, 1).otherwise(-1)


def by_kind(kind: Column, cases: Mapping[str, Column], otherwise: Column) -> Column:
    out = None
    for name, value in cases.items():
        out = F.when(kind == name, value) if out is None else out.when(kind == name, value)
    return out.otherwise(otherwise)


def votes(s: Column) -> list[Column]:
    """One vote per labeler: 1, 0, or -1 for none."""
    kind, hit, left, right = s["kind"], s["hit"], s["left"], s["right"]
    n = F.char_length(digits(hit))
    like = lambda pattern: F.rlike(hit, F.lit(pattern))
    shape = by_kind(
        kind,
        {
            "email": vote(like(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"), like(r"\.\.|@-|-$|\.[0-9]+$")),
            "ip": vote(like(r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){3}$"), like(r"(^|\.)0[0-9]")),
            "card": vote(like(r"^([0-9]{13,19}|([0-9]{4}[ -]){3}[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), like(r"^(.)\1{12}")),
            "phone": vote(like(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[0-9 .-]+$"), like(r"\.\.|--|\(\(|  ")),
            "ssn": vote(~like(r"^(000|666|9)|-00-|-0000$"), like(r"^(000|666|9)|-00-|-0000$")),
            "local_phone": vote(~like(r"^\(?[01]"), like(r"^\(?[01]")),
        },
        F.lit(-1),
    )
    counted = by_kind(
        kind,
        {
            "card": vote(n.isin(13, 14, 15, 16, 19), n == 17),
            "phone": vote(n.between(10, 13), n < 9),
            "iban": vote(n >= 10, n < 6),
            "local_phone": vote(n == 10, n != 10),
        },
        F.lit(-1),
    )
    gazetteer = by_kind(
        kind,
        {
            "email": vote(F.rlike(F.lower(hit), F.lit(DOMAIN_ENDS)), F.lit(False)),
            "phone": vote(like(CALLING_CODES), F.lit(False)),
            "ip": vote(~like(PRIVATE_RANGES), like(PRIVATE_RANGES)),
            "card": vote(F.rlike(digits(hit), F.lit(CARD_ISSUERS)), ~F.rlike(digits(hit), F.lit(CARD_ISSUERS))),
            "iban": vote(like(IBAN_COUNTRIES), ~like(IBAN_COUNTRIES)),
        },
        F.lit(-1),
    )
    none = F.lit(False)
    cue = vote(F.rlike(left, F.lit(CUES)), none)
    counter = vote(none, F.rlike(left, F.lit(COUNTERCUES)))
    inside = F.rlike(left, F.lit(r"[\p{L}\p{N}_]$")) | F.rlike(right, F.lit(r"^[\p{L}\p{N}_]"))
    return [shape, counted, gazetteer, cue, counter, vote(~inside, inside)]


def features(s: Column) -> list[Column]:
    """Small categories of a span and its surroundings, for the classifier."""
    hit, size = s["hit"], F.char_length(s["hit"])
    share = F.char_length(digits(hit)) * 4 / size
    marks = F.char_length(F.regexp_replace(hit, r"[\p{L}\p{N}]", ""))
    side = lambda c: F.when(c == "", "edge").when(F.rlike(c, F.lit(r"\s")), "blank").when(F.rlike(c, F.lit(r"[\p{L}\p{N}_]")), "word").otherwise("mark")
    return [
        s["kind"],
        F.least(F.floor(size / 6), F.lit(5)).cast("string"),
        F.floor(share).cast("string"),
        F.least(marks, F.lit(4)).cast("string"),
        side(F.substring(s["left"], -1, 1)),
        side(F.substring(s["right"], 1, 1)),
    ]


def named_spans(kind: str) -> Column:
    """Matches of a kind that hold, with their kind."""
    spans = F.filter(kind, lambda s: base_holds(kind, s["hit"])) if kind in BASE else F.col(kind)
    parts = ("start", "end", "hit", "left", "right")
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(kind in BASE).alias("base"), *[s[c].alias(c) for c in parts]))


def can_hold(kind: str) -> Column:
    """Whether `pii_text` can have a candidate of a kind; `pii_digit` tells whether it has a digit at all."""
    if kind in AMONG_DIGITS:
        return F.col("pii_digit") & F.rlike(F.col("pii_text"), F.lit(AMONG_DIGITS[kind]))
    return reduce(or_, [F.contains(F.col("pii_text"), F.lit(s)) for s in STRINGS[kind]])


def candidates(rows: DataFrame) -> DataFrame:
    """Add the candidates of `pii_text` as `spans`."""
    rows = rows.withColumn("pii_digit", F.rlike(F.col("pii_text"), F.lit("[0-9]")))
    found = with_matches(rows, "pii_text", BASE | ADDED, can_hold).drop("pii_digit")
    named = [named_spans(kind) for kind in KINDS]
    found = found.withColumn("firm", F.concat(*named[: len(BASE)])).withColumn("loose", F.concat(*named[len(BASE) :])).drop(*KINDS)
    clear = F.filter("loose", lambda s: ~F.exists("firm", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = found.withColumn("hits", F.concat("firm", clear)).drop("firm", "loose")

    def placed(s: Column) -> Column:
        parts = [s[c].alias(c) for c in ("kind", "base", "start", "end")]
        return F.struct(*parts, F.array(*votes(s)).cast("array<int>").alias("votes"), F.array(*features(s)).alias("features"))

    spans = F.when(F.size("hits") > 0, F.transform("hits", placed)).otherwise(F.expr(f"cast(array() as {PLACED})"))
    return found.withColumn("spans", spans).drop("hits")


def log_ratio(columns: list[Column], ratios: list[dict], prior: Column) -> Column:
    """Sum of log ratios that depend on the value of each column; unknown values add nothing."""
    total = prior
    for column, ratio in zip(columns, ratios):
        if ratio:
            table = F.create_map(*[F.lit(x) for pair in ratio.items() for x in pair])
            total = total + F.coalesce(F.try_element_at(table, column), F.lit(0.0))
    return total


def believe(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def estimate(patterns: DataFrame) -> tuple[list[dict[int, float]], dict[str, float]]:
    """Expectation-maximisation over counted vote patterns (`kind`, `votes`, `n`).

    Returns for each labeler the log odds that each vote speaks for personal data, and the log odds
    of each kind. Starts from the majority of votes; counts are smoothed by one.
    """
    said = [F.element_at("votes", i + 1) for i in range(len(LABELERS))]
    for_it, against = sum(F.when(v == 1, 1).otherwise(0) for v in said), sum(F.when(v == 0, 1).otherwise(0) for v in said)
    belief = (for_it + 0.5) / (for_it + against + 1.0)
    ratios, kinds = [], {}
    for _ in range(ROUNDS):
        weighed = patterns.withColumn("p", belief * F.col("n")).withColumn("q", (1 - belief) * F.col("n"))
        sums = [F.sum(F.when(v == x, F.col(c)).otherwise(0.0)).alias(f"{c}_{i}_{x}") for i, v in enumerate(said) for x in (-1, 0, 1) for c in "pq"]
        sums += [F.sum(F.when(F.col("kind") == k, F.col(c)).otherwise(0.0)).alias(f"{c}_{k}") for k in KINDS for c in "pq"]
        row = {name: value or 0.0 for name, value in weighed.agg(*sums).first().asDict().items()}
        ratios = []
        for i in range(len(LABELERS)):
            p, q = ({x: row[f"{c}_{i}_{x}"] + 1 for x in (-1, 0, 1)} for c in "pq")
            ratios.append({x: math.log(p[x] / sum(p.values())) - math.log(q[x] / sum(q.values())) for x in p})
        kinds = {k: math.log((row[f"p_{k}"] + 1) / (row[f"q_{k}"] + 1)) for k in KINDS}
        belief = believe(log_ratio([*said, F.col("kind")], [*ratios, kinds], F.lit(0.0)))
    return ratios, kinds


def train(patterns: DataFrame) -> list[dict[str, float]]:
    """Log ratios of a naive Bayes classifier on span features, fitted to the beliefs of the labelers."""
    ratios, kinds = estimate(patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    said = [F.element_at("votes", i + 1) for i in range(len(LABELERS))]
    belief = believe(log_ratio([*said, F.col("kind")], [*ratios, kinds], F.lit(0.0)))
    weighed = patterns.withColumn("p", belief * F.col("n")).withColumn("q", (1 - belief) * F.col("n"))
    counts = weighed.select("p", "q", F.posexplode("features").alias("place", "value")).groupBy("place", "value")
    rows = counts.agg(F.sum("p").alias("p"), F.sum("q").alias("q")).collect()
    out: list[dict[str, float]] = []
    for place in range(len(FEATURES)):
        own = [(r["value"], r["p"] + 1, r["q"] + 1) for r in rows if r["place"] == place]
        p, q = sum(r[1] for r in own), sum(r[2] for r in own)
        prior = math.log(p / q) if place and own else 0.0
        # The kind comes first and carries the prior; the others count relative to it.
        out.append({v: (math.log(a / b) if place == 0 else math.log(a / b) - prior) for v, a, b in own})
    return out


def detect(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: struct `carried` of the named columns, and `spans` as (kind, start, end).

    Null and empty texts have no spans; null ids and repeated rows are rows like others; an empty
    table gives no rows. Other columns are ignored. Overlapping spans of different base kinds are all
    reported; spans of added kinds that overlap a base span are not. Texts are read once, the
    candidates are kept in the shared folder, and everything per row needs no shuffle. What reaches
    the driver are sums per labeler and per feature value.
    """
    rows = docs.select(F.struct(*carry).alias("carried"), F.coalesce(F.col(text_col), F.lit("")).alias("pii_text"))
    found = materialise(candidates(rows).select("carried", "spans"), "pii-candidates")
    single = found.select(F.explode("spans").alias("s"))
    patterns = single.groupBy("s.kind", "s.votes", "s.features").agg(F.count("*").alias("n"))
    ratios = train(materialise(patterns, "pii-patterns"))

    def sure(s: Column) -> Column:
        logit = log_ratio([F.element_at(s["features"], i + 1) for i in range(len(FEATURES))], ratios, F.lit(0.0))
        return s["base"] | (believe(logit) >= BELIEVED)

    kept = F.filter("spans", sure)
    return found.select("carried", F.transform(kept, lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end")])).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; what overlaps is replaced once.

    Spans are worked on in blocks, each on its own stretch of the text, so that the work does not grow
    with matches times the length of the text."""
    nowhere = F.lit(0).cast("long")

    def stretch(ordered: Column, block: Column, begin: Column, end: Column) -> Column:
        own = F.substring(text, (begin + 1).cast("int"), (end - begin).cast("int"))
        start = F.struct(nowhere.alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

        def replaced(here: Column) -> Column:
            def step(state: Column, s: Column) -> Column:
                first, last = s["start"] - begin, s["end"] - begin
                gap = F.substring(here, (state["at"] + 1).cast("int"), F.greatest(first - state["at"], nowhere).cast("int"))
                tag = F.when(first >= state["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
                return F.struct(F.greatest(state["at"], last).alias("at"), F.array_append(state["out"], F.concat(gap, tag)).alias("out"))

            return F.aggregate(part(ordered, block), start, step, lambda state: F.array_join(state["out"], ""))

        return bound(own, replaced)

    def all_of(ordered: Column) -> Column:
        ends = F.aggregate(
            blocks(ordered),
            F.array(nowhere),
            lambda at, block: F.array_append(at, F.greatest(F.element_at(at, -1), F.array_max(F.transform(part(ordered, block), lambda s: s["end"])))),
        )

        def joined_up(at: Column) -> Column:
            done = F.transform(blocks(ordered), lambda block: stretch(ordered, block, F.get(at, block), F.get(at, block + 1)))
            return F.concat(F.array_join(done, ""), F.substring(text, (F.element_at(at, -1) + 1).cast("int"), F.char_length(text)))

        return bound(ends, joined_up)

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.when(F.size(spans) > 0, bound(ordered, all_of)).otherwise(text)


def of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """Counts and hashes of the base kinds, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "carried.doc_id",
        *counts,
        F.sha2(joined(base, list(BASE), by_start=False), 256).alias("base_sha256"),
        joined(F.col("spans"), KINDS, by_start=False).alias("spans"),
    )
