"""Operator 12, quality rules [native]: decision lists learned by sequential covering.

Every text is reduced to counts and shares once, in a scan, and staged.  Rows with a
quality label then train an ordered list of rules, each a conjunction of thresholds that
rejects a text.  A rule is grown on two thirds of the labelled rows, condition by
condition, by FOIL's information gain; its last conditions are pruned where the other third is
the better for it; it enters the list if that third confirms it, and the rows that it
covers leave both parts.  The list becomes one ordered CASE expression over the staged counts.

Only DataFrame and SQL functions run.  Labelled rows are counted by cells of threshold
bins; each growing step is one aggregate over the cells that brings ``features x bins``
numbers to the driver, at most MAX_RULES * (MAX_CONDITIONS + 1) times.  All labelled rows take part.

Counting repeated windows: windows are 64-bit hashes of three words.  A sorted copy tells
whether any occurs twice; only then are (hash, place) pairs sorted, so a text costs
n log n at any length.  Values that a lambda uses are bound by ``_let``: a plain column
would be worked out again for every element.

Defined results
  * null and empty texts have no words and fail the base rule.
  * rows repeat as they are; a row's own doc_id only serves to find its label.  An id with
    several labels counts as low quality where one of them says so; null labels say nothing.
  * without labelled rows of both kinds the list is empty and the base rule alone decides.
  * an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm.common import ASCII_SPACE, documents, stage, whole_text

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
# A rule may use these; each is a share or a mean, so that long and short texts compare.  (The share of
# distinct words is not among them: it falls with the length of any text.)
FEATURES = ("mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "mark_share", "letterless_share", "words_per_line")
# Candidate thresholds lie between these quantiles of either label's rows.
QUANTILES = (0.0, 0.001, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 0.999, 1.0)
MAX_RULES, MAX_CONDITIONS = 12, 4
# A rule must reject at least so many rows of the pruning part, with at least this precision.
MIN_COVERED, MIN_PRECISION = 4, 0.9
PRUNE_PART = 3  # one labelled row in three is kept for pruning


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _repeats(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more."""
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(pairs, lambda p: _let(
            F.sort_array(F.transform(
                F.filter(p, lambda x, i: (x["h"] == F.get(p, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(p, F.greatest(i - 1, F.lit(0)))["h"]))),
                lambda x: x["i"])),
            lambda at: F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))),
                                   F.lit(0), lambda total, n: total + n)))

    def checked(windows: Column) -> Column:
        twice = _let(F.sort_array(windows), lambda s: F.exists(
            F.transform(s, lambda h, i: (i > 0) & (h == F.get(s, F.greatest(i - 1, F.lit(0))))), lambda same: same))
        return F.when(twice, covered(windows)).otherwise(F.lit(0))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(_let(F.slice(hashed, F.lit(1), F.size(words) - 2), checked))


def _from_words(words: Column) -> Column:
    return F.struct(F.size(words).alias("n_words"), _repeats(words).alias("n_repeat_words"),
                    F.size(F.filter(words, lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).alias("n_letterless"))


def _from_lines(lines: Column) -> Column:
    return F.struct(F.size(lines).alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"))


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, the contract's counts and the features of every row."""
    t = whole_text(text_col)
    words = F.filter(F.split(t, ASCII_SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _let(words, _from_words).alias("w"), _let(lines, _from_lines).alias("l"),
                       _count_without(t, ASCII_SPACE).alias("word_chars"), (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"),
                       _count_without(t, "[^A-Z]+").alias("n_upper"), _count_without(t, "[^0-9]+").alias("n_digits"), _count_without(t, "[^!?]+").alias("n_marks"))
    n, chars, n_lines = (F.greatest(F.col(c), F.lit(1)) for c in ("w.n_words", "word_chars", "l.n_lines"))
    shares = {"mean_word_chars": F.col("word_chars") / n, "symbol_share": F.col("n_symbols") / chars, "dup_line_share": F.col("l.n_dup_lines") / n_lines,
              "repeat_share": F.col("w.n_repeat_words") / n, "upper_share": F.col("n_upper") / chars, "digit_share": F.col("n_digits") / chars,
              "mark_share": F.col("n_marks") / chars, "letterless_share": F.col("w.n_letterless") / n,
              "words_per_line": F.col("w.n_words") / n_lines}
    counts = {"n_words": F.col("w.n_words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"), "n_dup_lines": F.col("l.n_dup_lines"),
              "n_repeat_words": F.col("w.n_repeat_words")}
    return rows.select("doc_id", *[c.cast("long").alias(k) for k, c in counts.items()], *[shares[f].cast("double").alias(f) for f in FEATURES])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``feature > threshold`` (above) or ``feature <= threshold``; ``bin`` is the threshold's number."""
    feature: str
    above: bool
    bin: int
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def on_cells(self) -> Column:
        at = F.col("bins")[FEATURES.index(self.feature)]
        return at > F.lit(self.bin) if self.above else at <= F.lit(self.bin)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    bad: int    # rows of the pruning part that it covers, by label
    good: int

    def __str__(self) -> str:
        return f"{' AND '.join(map(str, self.conditions))}  [{self.bad} low, {self.good} good]"


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Ascending candidate thresholds per feature: middles between neighbouring quantiles of either label."""
    found = rows.groupBy("bad").agg(*[F.percentile_approx(f, list(QUANTILES), 10000).alias(f) for f in FEATURES]).collect()  # two rows
    out = {}
    for f in FEATURES:
        marks = sorted({v for r in found for v in r[f] or [] if v is not None})
        out[f] = sorted({float(f"{(a + b) / 2:.4g}") for a, b in zip(marks, marks[1:])})
    return out


def _cells(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(bins, prune, bad, good): labelled rows counted by the bins of their features.  Bin k of a value is
    the number of thresholds below it, so ``value > threshold[k]`` is ``bin > k``."""
    def bin_of(f: str) -> Column:
        if not cuts[f]:
            return F.lit(0).cast("short")
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c < F.col(f))).cast("short")
    binned = rows.select(F.array(*map(bin_of, FEATURES)).alias("bins"), "prune", "bad")
    return stage(binned.groupBy("bins", "prune").agg(F.sum(F.col("bad").cast("long")).alias("bad"),
                                                     F.sum((~F.col("bad")).cast("long")).alias("good")), "quality-cells")


def _information(bad: float, good: float) -> float:
    return log2((bad + 1e-9) / (bad + good + 1e-9))


def _grow(cells: DataFrame, cuts: dict[str, list[float]]) -> list[Condition]:
    """Add the condition of the largest FOIL gain until no good row is covered, or none gains."""
    rule: list[Condition] = []
    rows = cells.where(~F.col("prune"))
    while len(rule) < MAX_CONDITIONS:
        inside = rows.where(_all([c.on_cells() for c in rule]))
        found = (inside.select(F.posexplode("bins").alias("feature", "bin"), "bad", "good")
                 .groupBy("feature", "bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect())  # features x bins rows
        if not found:
            return rule
        bad, good = (sum(r[k] for r in found if r["feature"] == 0) for k in ("bad", "good"))
        if not bad or not good:
            return rule
        best = (1e-6, None)
        for k, f in enumerate(FEATURES):
            here = {r["bin"]: (r["bad"], r["good"]) for r in found if r["feature"] == k}
            low_bad = low_good = 0
            for at, cut in enumerate(cuts[f]):
                low_bad += here.get(at, (0, 0))[0]
                low_good += here.get(at, (0, 0))[1]
                for above, b, g in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                    gain = b * (_information(b, g) - _information(bad, good))
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, Condition(f, above, at, cut))
        if best[1] is None:
            return rule
        rule.append(best[1])
    return rule


def _prune(cells: DataFrame, rule: list[Condition]) -> Rule:
    """The beginning of ``rule`` that does best on the pruning part, the shorter one where two do alike."""
    sums = []
    for k in range(1, len(rule) + 1):
        holds = _all([c.on_cells() for c in rule[:k]])
        sums += [F.sum(F.when(holds, F.col(c)).otherwise(0)).alias(f"{c}{k}") for c in ("bad", "good")]
    got = cells.where("prune").agg(*sums).first()
    scored = []
    for k in range(1, len(rule) + 1):
        bad, good = got[f"bad{k}"] or 0, got[f"good{k}"] or 0
        scored.append(((bad - good) / (bad + good) if bad + good else -1.0, -k, Rule(tuple(rule[:k]), bad, good)))
    return max(scored, key=lambda s: s[:2])[2]


class DecisionList:
    """Ordered rules; the first that holds decides, and a text that none holds for is kept."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules

    def __str__(self) -> str:
        return "\n".join(f"{n}. reject if {r}" for n, r in enumerate(self.rules, 1)) or "keep all"

    def rule_number(self) -> Column:
        """Number of the first rule that holds, 0 if none: CASE WHEN rule 1 THEN 1 WHEN rule 2 THEN 2 ... ELSE 0."""
        if not self.rules:
            return F.lit(0)
        def holds(rule: Rule) -> Column:
            return _all([c.column() for c in rule.conditions])
        out = F.when(holds(self.rules[0]), F.lit(1))
        for n, rule in enumerate(self.rules[1:], 2):
            out = out.when(holds(rule), F.lit(n))
        return out.otherwise(F.lit(0))


def learn(rows: DataFrame) -> DecisionList:
    """Sequential covering over labelled rows: the FEATURES, ``bad`` and ``prune`` (both boolean, not null)."""
    cuts = thresholds(rows)
    cells = _cells(rows, cuts)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grown = _grow(cells, cuts)
        if not grown:
            break
        rule = _prune(cells, grown)
        if rule.bad + rule.good < MIN_COVERED or rule.bad < MIN_PRECISION * (rule.bad + rule.good):
            break
        rules.append(rule)
        cells = cells.where(~_all([c.on_cells() for c in rule.conditions]))
    return DecisionList(rules)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``stats`` with a label: ``bad`` (quality 0) and ``prune``, dealt by a hash of the counts and id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 0).alias("bad"))
    dealt = F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(PRUNE_PART)) == 0
    return stats.join(known, "doc_id").select(*FEATURES, "bad", dealt.alias("prune"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stage(statistics(documents(spark, sf_dir)), "quality-statistics")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    rules = learn(labelled(stats, labels))
    out = stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"), rules.rule_number().alias("rule"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


REGISTRY = {"op12_quality_rules": op12_quality_rules}
