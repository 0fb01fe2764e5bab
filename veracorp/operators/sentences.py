"""Sentence splitting with abbreviations learnt from the corpus.

A period ends a sentence unless it belongs to an abbreviation, and which types are
abbreviations differs by corpus.  After Kiss and Strunk (2006) a type is one if it stands with
a period more often than chance allows: the log-likelihood ratio of "nearly always with a
period" against "as often as any word", weighted down by its length and by every
occurrence without a period, and up by periods inside it.  The counts are one aggregate over
the corpus with map-side combine; splitting is a row-wise expression over the learnt list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracorp.functions import patterns as P
from veracorp.functions.text import treebank_sentence_tokens

# Fixed values of the published method: the share of periods of an abbreviation, and the least score.
ABBREVIATION_SHARE = 0.99
ABBREVIATION_SCORE = 0.3
_OPENING, _CLOSING = "[\"'(\\[{«“‘„]*", "[\"')\\]}»”’]*"
# A word of letters, periods inside allowed; its last period, if any; closing marks.
CANDIDATE = "^" + _OPENING + r"(\p{L}(?:[\p{L}.]*\p{L})?)(\.?)" + "[\"')\\]}»”’,;:]*$"
ENDS = r"[.!?]" + _CLOSING + "$"
ELLIPSIS = r"\.\." + _CLOSING + "$"
LOWER_NEXT = "^" + _OPENING + r"\p{Ll}"
_MARK = "\u0001"


def tokens_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _MARK, ""), P.WS_RUN), lambda t: t != "")


def abbreviation_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """(type, with_period, without_period, score) of every lower-cased word type seen with a period."""
    t = docs.select(F.explode(tokens_of(F.col(text))).alias("t")).where(F.col("t").rlike(CANDIDATE))
    t = t.select(F.lower(F.regexp_extract("t", CANDIDATE, 1)).alias("type"), (F.length(F.regexp_extract("t", CANDIDATE, 2)) > 0).alias("dot"))
    counts = t.groupBy("type").agg(F.count_if("dot").alias("with_period"), F.count_if(~F.col("dot")).alias("without_period"))
    dots, n = counts.agg(F.sum("with_period"), F.sum(F.col("with_period") + F.col("without_period"))).first()
    counts = counts.where("with_period > 0")
    share = F.lit(min(max((dots or 0) / max(n or 0, 1), 1e-9), 1 - 1e-9))

    def likelihood(p: Column) -> Column:
        return F.col("with_period") * F.log(p) + F.col("without_period") * F.log(1 - p)

    ratio = 2 * (likelihood(F.lit(ABBREVIATION_SHARE)) - likelihood(share))
    inner = F.length("type") - F.length(F.translate("type", ".", ""))
    letters = (F.length("type") - inner).cast("double")
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -F.col("without_period").cast("double"))
    return counts.select("type", "with_period", "without_period", score.alias("score"))


def abbreviations(docs: DataFrame, text: str = "text") -> list[str]:
    """The learnt list.  The score falls with e to the length, so only short types get there."""
    return [r["type"] for r in abbreviation_scores(docs, text).where(F.col("score") >= ABBREVIATION_SCORE).orderBy("type").collect()]


def sentences(text: Column, known: list[str]) -> Column:
    """Array of the text's sentences; white space inside them is collapsed.

    A token that ends with ``.``, ``!`` or ``?`` (closing marks may follow) ends a sentence, but not if it is a known
    abbreviation or a single letter with its period, nor an ellipsis that a lower-case word follows.
    """
    listed = F.array(*[F.lit(k) for k in known]).cast("array<string>")

    def marked(tokens: Column) -> Column:
        def mark(t: Column, i: Column) -> Column:
            core = F.lower(F.regexp_extract(t, CANDIDATE, 1))
            short = t.rlike(CANDIDATE) & (F.array_contains(listed, core) | (F.length(core) == 1))
            runs_on = t.rlike(ELLIPSIS) & F.coalesce(F.get(tokens, i + 1).rlike(LOWER_NEXT), F.lit(False))
            return F.when(t.rlike(ENDS) & ~short & ~runs_on, F.concat(t, F.lit(_MARK))).otherwise(t)
        return F.transform(tokens, mark)

    joined = F.array_join(F.get(F.transform(F.array(tokens_of(text)), marked), 0), " ")
    return F.filter(F.split(joined, _MARK + " ?"), lambda s: s != "")


def word_tokens(text: Column, known: list[str]) -> Column:                         # T12
    """Treebank tokens, sentence by sentence."""
    return F.flatten(F.transform(sentences(text, known), treebank_sentence_tokens))
