"""Operator 3, personal data [native]: weakly supervised span classification.

Candidates are found by patterns: the four base kinds, and further kinds whose patterns
alone prove little.  Labelers (form, gazetteer, context, boundary, placeholder) vote +1,
0 or -1 on every candidate.  Candidates are counted by vote pattern -- a table bounded by
kinds x 3**labelers -- and expectation-maximisation over it estimates how reliable each
labeler is and how likely each pattern is personal data.  These posteriors train the final
span classifier, log-odds of span features in one aggregate over the candidates; it
decides which spans of the further kinds are reported.  Base spans always are.

Only DataFrame and SQL functions run; a scan finds candidates per row, no text is
shuffled, and the tables that reach the driver are the bounded ones above.

Positions come from a regexp_replace that puts marks around matches: the marked text is
split and the lengths of the parts are summed.  The patterns are possessive, so that long
runs neither backtrack nor recurse; lookbehinds keep a match from starting inside a run,
where the plain pattern could not have started either.

Defined results: null and empty texts have no spans; repeated rows are scanned each; an
empty table, or one without candidates, gives rows without spans.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm.common import documents, stage, whole_text

OPEN, CLOSE, PLAIN = "\u0001", "\u0002", "\u0003"
# The base kinds in the order in which they are listed, then the further kinds.
BASE = ("email", "ip", "card", "phone")
FURTHER = ("local", "ssn", "iban", "name")
GIVEN_NAMES = ("Alice Anna Anne Antonio Carlos Charles Claire David Elena Emily Emma Eva George Hans Henry Jack James Jane Jean "
               "John Jose Juan Julia Karl Laura Lisa Louis Lucia Maria Marie Mark Martin Mary Michael Paul Peter Pierre "
               "Robert Sarah Sofia Susan Thomas William").split()
TOP_DOMAINS = "com org net edu gov mil int info biz io de fr es it nl uk eu us ca au ch at be pl ru jp cn in br mx".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91".split()
CONTEXT_FOR = ("mail|contact|phone|tel|call|mobile|fax|card|visa|credit|address|host|server|ssn|social|account|iban|name|dear|"
               "write|reach|courriel|correo|telefon|nombre|nom")
CONTEXT_AGAINST = "version|release|order|isbn|invoice|figure|table|chapter|page|section|part|model|build"

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local": r"(?<![0-9+)-])(?<!\+[0-9]{1,3}[ .-])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:" + "|".join(GIVEN_NAMES) + r") [A-Z][a-z]{1,20}(?![A-Za-z])",
}
# What a text must hold for a pattern to be worth a scan.
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}
LABELERS = ("form", "gazetteer", "context", "boundary", "placeholder")
EM_ROUNDS = 15
_FOUND = "array<struct<kind:string,start:int,end:int,s:string>>"


def _located(marked: str, kind: str) -> str:
    """SQL: spans of the marks in the column ``marked``."""
    return f"""CASE WHEN instr({marked}, '{OPEN}') = 0 THEN CAST(array() AS {_FOUND}) ELSE aggregate(
        slice(split({marked}, '{OPEN}', -1), 2, size(split({marked}, '{OPEN}', -1)) - 1),
        named_struct('at', length(substring_index({marked}, '{OPEN}', 1)), 'found', CAST(array() AS {_FOUND})),
        (acc, p) -> named_struct('at', acc.at + length(p) - 1,
            'found', concat(acc.found, array(named_struct('kind', '{kind}', 'start', acc.at,
                'end', acc.at + length(substring_index(p, '{CLOSE}', 1)), 's', substring_index(p, '{CLOSE}', 1))))),
        acc -> acc.found) END"""


_DIGITS = "regexp_replace(x.s, '[^0-9]', '')"
ACCEPTS = {
    "ip": "forall(split(x.s, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(p AS DECIMAL(38, 0)), 999) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}


def candidates(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Struct ``row`` (the ``carry`` columns) and ``found``: every candidate span with its votes."""
    rows = docs.select(F.struct(*carry).alias("row"),
                       F.translate(whole_text(), OPEN + CLOSE, PLAIN + PLAIN).alias("t"))
    for kind, pattern in PATTERNS.items():
        marked = F.regexp_replace("t", pattern, f"{OPEN}$0{CLOSE}")
        if kind in NEEDS:
            marked = F.when(F.instr("t", NEEDS[kind]) > 0, marked).otherwise(F.lit(""))
        rows = rows.withColumn(f"m_{kind}", marked)
    spans = []
    for kind in PATTERNS:
        found = _located(f"m_{kind}", kind)
        spans.append(f"filter({found}, x -> {ACCEPTS[kind]})" if kind in ACCEPTS else found)
    rows = rows.select("row", "t", F.expr(f"concat({', '.join(spans)})").alias("spans"))
    return rows.select("row", F.expr(f"""transform(spans, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 's', x.s,
        'before', lower(substring(t, greatest(x.start - 39, 1), least(x.start, 40))),
        'after', lower(substring(t, x.end + 1, 24))))""").alias("spans")).select(
            "row", F.transform("spans", _voted).alias("found"))


def _vote(plus: Column, minus: Column) -> Column:
    return F.when(minus, F.lit(-1)).when(plus, F.lit(1)).otherwise(F.lit(0))


def _voted(x: Column) -> Column:
    kind, s, before, after = x["kind"], x["s"], x["before"], x["after"]
    digits = F.regexp_replace(s, "[^0-9]", "")
    domain = F.lower(F.substring_index(s, ".", -1))
    no, yes = F.lit(False), F.lit(True)

    def by_kind(default, **cases):
        out = default
        for k, v in cases.items():
            out = F.when(kind == k, v).otherwise(out)
        return out

    form = _vote(
        by_kind(no, email=s.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@.*\.[A-Za-z]{2,}$"), ip=~s.rlike(r"(^|\.)0[0-9]"),
                card=s.rlike("^[3-6]"), phone=s.rlike(r"[ ().-]"), local=s.rlike(r"^\("), ssn=yes, iban=yes),
        by_kind(no, email=s.rlike(r"\.\.|^[.%+-]"), ip=s.rlike(r"^0|^255\."), card=s.rlike("^0"), phone=s.rlike("^\\+0"),
                ssn=s.rlike("^(000|666|9)|-00-|-0000$"), local=s.rlike(r"^\(?[01]")))
    code = reduce(lambda a, b: a | b, [digits.startswith(c) for c in COUNTRY_CODES])
    gazetteer = _vote(
        by_kind(no, email=domain.isin(TOP_DOMAINS), card=digits.rlike("^(4|5[1-5]|3[47]|6011|65|35)"), phone=code, name=yes,
                iban=s.rlike("^(AT|BE|CH|DE|ES|FR|GB|IT|LU|NL|PL|PT)"), ip=~s.rlike(r"^(0|10|127|22[4-9]|2[34][0-9]|25[0-5])\.")),
        by_kind(no, email=domain.isin("png", "jpg", "js", "css", "html"), ip=s.rlike(r"^(0|127)\.")))
    context = _vote(before.rlike(CONTEXT_FOR), before.rlike(f"({CONTEXT_AGAINST})[^a-z]*$"))
    inside = before.rlike(r"[0-9a-z_]$") | after.rlike(r"^[0-9a-z_@]")
    boundary = _vote(~inside, inside)
    placeholder = _vote(no, digits.rlike(r"^(.)\1{6,}$|^0?123456789") | s.rlike("(?i)^(test|foo|user|name)@"))
    votes = F.array(form, gazetteer, context, boundary, placeholder)
    share = F.floor(4 * F.length(digits) / F.length(s)).cast("int")
    return F.struct(kind.alias("kind"), x["start"].alias("start"), x["end"].alias("end"), votes.alias("votes"),
                    F.least(F.floor(F.length(s) / 6), F.lit(6)).cast("int").alias("size"), share.alias("share"))


def reliabilities(patterns: DataFrame) -> dict:
    """Expectation-maximisation over vote patterns (votes, n): the share of personal data and,
    per labeler and class, how often it votes +1 and -1."""
    state = {"prior": 0.5, "yes": [(0.6, 0.1)] * len(LABELERS), "no": [(0.2, 0.4)] * len(LABELERS)}
    for _ in range(EM_ROUNDS):
        p = posterior(F.col("votes"), state)
        sums = [F.sum(F.col("n") * p).alias("w1"), F.sum(F.col("n") * (1 - p)).alias("w0")]
        for j in range(len(LABELERS)):
            for v, name in ((1, "plus"), (-1, "minus")):
                hit = F.when(F.col("votes")[j] == v, F.col("n")).otherwise(F.lit(0))
                sums += [F.sum(hit * p).alias(f"{name}1_{j}"), F.sum(hit * (1 - p)).alias(f"{name}0_{j}")]
        r = patterns.agg(*sums).first()
        if r["w1"] is None:
            return state
        state = {"prior": (r["w1"] + 1) / (r["w1"] + r["w0"] + 2)}
        for c, name in (("1", "yes"), ("0", "no")):
            state[name] = [((r[f"plus{c}_{j}"] + 1) / (r[f"w{c}"] + 3), (r[f"minus{c}_{j}"] + 1) / (r[f"w{c}"] + 3))
                           for j in range(len(LABELERS))]
    return state


def posterior(votes: Column, state: dict) -> Column:
    """Probability that a candidate with these votes is personal data."""
    odds = F.lit(state["prior"] / (1 - state["prior"]))
    for j, ((p1, m1), (p0, m0)) in enumerate(zip(state["yes"], state["no"])):
        odds = odds * F.when(votes[j] == 1, F.lit(p1 / p0)).when(votes[j] == -1, F.lit(m1 / m0)).otherwise(
            F.lit((1 - p1 - m1) / (1 - p0 - m0)))
    return odds / (1 + odds)


def _features(x: Column) -> Column:
    named = [F.concat(F.lit("kind="), x["kind"]), F.concat(F.lit("size="), x["size"].cast("string")),
             F.concat(F.lit("share="), x["share"].cast("string"))]
    named += [F.concat(F.lit(f"{name}="), x["votes"][j].cast("string")) for j, name in enumerate(LABELERS)]
    return F.array(*named)


def train_classifier(spans: DataFrame, state: dict) -> Column:
    """Log-odds weights of span features as a literal map, from soft labels in one aggregate."""
    rows = spans.select(posterior(F.col("x.votes"), state).alias("p"), F.explode(F.concat(_features(F.col("x")), F.array(F.lit("bias")))).alias("f"))
    table = rows.groupBy("f").agg(F.sum("p").alias("w1"), F.sum(1 - F.col("p")).alias("w0")).collect()   # a row per feature value
    sums = {r["f"]: (r["w1"], r["w0"]) for r in table}
    if not sums:
        return F.create_map(F.lit("bias"), F.lit(0.0))
    all1, all0 = sums["bias"]
    weights = {f: log((a + 1) / (all1 + 2)) - log((b + 1) / (all0 + 2)) for f, (a, b) in sums.items() if f != "bias"}
    weights["bias"] = log((all1 + 1) / (all0 + 1))
    return F.create_map(*[F.lit(v) for kv in sorted(weights.items()) for v in kv])


def probability(x: Column, weights: Column) -> Column:
    logit = F.aggregate(_features(x), F.element_at(weights, F.lit("bias")),
                        lambda acc, f: acc + F.coalesce(F.try_element_at(weights, f), F.lit(0.0)))
    return 1 / (1 + F.exp(-logit))


def find(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Struct ``row`` and ``found`` (kind, start, end, p by start, then kind as listed):
    base spans, and further spans that the classifier takes for personal data."""
    rows = stage(candidates(docs, carry), "pii-candidates")
    spans = rows.select(F.explode("found").alias("x"))
    patterns = stage(spans.groupBy(F.col("x.votes").alias("votes")).agg(F.count("*").alias("n")), "pii-votes")
    state = reliabilities(patterns)
    weights = train_classifier(spans, state)
    order = F.create_map(*[F.lit(v) for i, k in enumerate(BASE + FURTHER) for v in (k, i)])
    scored = F.transform("found", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("rank"), x["kind"].alias("kind"),
                                                     x["end"].alias("end"), probability(x, weights).alias("p")))
    kept = F.sort_array(F.filter(scored, lambda x: (x["rank"] < len(BASE)) | (x["p"] >= 0.5)))
    return rows.select("row", F.when(F.size("found") > 0, kept).otherwise(F.array().cast(
        "array<struct<start:int,rank:int,kind:string,end:int,p:double>>")).alias("found"))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.expr(f"filter(found, x -> x.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("row.doc_id", *counts, F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("found")).alias("spans"),
                        F.size(F.filter("found", lambda x: x["p"] >= 0.5)).cast("long").alias("n_confident"))


REGISTRY = {"op3_pii": op3_pii}
