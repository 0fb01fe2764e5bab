"""Tokeniser comparison (T15, T16) and stopword impact (T19) as one job each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.session import broadcast_if_small
from veracorp.functions import patterns as P
from veracorp.functions.text import (kept_tokens, regex_tokens, removed_tokens, treebank_tokens,
                                     whitespace_tokens)

TOKENIZERS = {"treebank": treebank_tokens, "whitespace": whitespace_tokens, "regex": regex_tokens}


def reference_vocabulary(df: DataFrame, text: str = "cleaned_text", min_count: int = 2) -> DataFrame:   # T16
    w = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(P.ALPHA_WORD), 0)).alias("w"))
    return w.groupBy(F.lower("w").alias("term")).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)


def compare_tokenizers(sample: DataFrame, corpus: DataFrame, text: str = "cleaned_text") -> DataFrame:  # T15
    """Mean tokens, OOV rate, contraction and code-switch handling per tokeniser; ``recommended`` flag."""
    vocab = reference_vocabulary(corpus, text).select("term")
    low = F.lower(F.col(text))
    contractions = F.regexp_extract_all(low, F.lit(P.CONTRACTION_WORD), 0)
    markers = F.filter(F.regexp_extract_all(low, F.lit(P.LOWER_ASCII_WORD), 0),
                       lambda w: F.array_contains(F.array(*[F.lit(m) for m in L.CODE_SWITCH_MARKERS]), w))
    stacked = None
    for name, fn in TOKENIZERS.items():
        part = sample.select("doc_id", F.lit(name).alias("tokenizer"), fn(F.col(text)).alias("tokens"),
                             contractions.alias("contr"), markers.alias("marks"))
        stacked = part if stacked is None else stacked.unionByName(part)
    lowered = F.transform("tokens", lambda t: F.lower(t))
    per_doc = stacked.select(
        "tokenizer", "doc_id", F.size("tokens").alias("n"),
        F.size("contr").alias("contr_cases"),
        F.size(F.filter("contr", lambda w: F.array_contains(lowered, w))).alias("contr_kept"),
        F.size("marks").alias("mark_cases"),
        F.size(F.filter("marks", lambda w: F.array_contains(lowered, w))).alias("mark_kept"))
    # out-of-vocabulary alphabetic tokens: anti join with the reference vocabulary
    alpha = stacked.select("tokenizer", "doc_id", F.explode(lowered).alias("term")).where(F.col("term").rlike(r"^\p{L}+$"))
    oov = alpha.join(broadcast_if_small(vocab), "term", "left_anti").groupBy("tokenizer").agg(F.count(F.lit(1)).alias("oov"))
    agg = per_doc.groupBy("tokenizer").agg(
        F.avg("n").alias("avg_tokens_per_doc"), F.sum("n").alias("total_tokens"),
        F.sum("contr_cases").alias("cc"), F.sum("contr_kept").alias("ck"),
        F.sum("mark_cases").alias("mc"), F.sum("mark_kept").alias("mk"), F.count(F.lit(1)).alias("sample_size"))
    r = agg.join(oov, "tokenizer", "left").fillna(0, ["oov"]).select(
        "tokenizer", "avg_tokens_per_doc",
        F.when(F.col("total_tokens") > 0, F.col("oov") / F.col("total_tokens")).otherwise(0.0).alias("oov_rate"),
        F.when(F.col("cc") > 0, F.col("ck") / F.col("cc")).otherwise(1.0).alias("contraction_handling_rate"),
        F.when(F.col("mc") > 0, F.col("mk") / F.col("mc")).otherwise(1.0).alias("code_switch_handling_rate"),
        "sample_size")
    # rank (timing is left out): three rows, so a plain ordering
    best = r.orderBy("oov_rate", F.desc("contraction_handling_rate"), F.desc("code_switch_handling_rate"),
                     "tokenizer").limit(1).select(F.col("tokenizer").alias("_best"))
    return r.join(F.broadcast(best), how="left", on=F.col("tokenizer") == F.col("_best")) \
        .withColumn("recommended", F.col("_best").isNotNull()).drop("_best")


def stopword_removal(sample: DataFrame, text: str = "cleaned_text") -> DataFrame:      # T19 (rates)
    toks = sample.select(treebank_tokens(F.col(text)).alias("t"))
    out = None
    for name, custom in (("default", False), ("custom", True)):
        part = toks.select(F.lit(name).alias("stopword_list"), F.size("t").alias("n"),
                           removed_tokens("t", custom).alias("r"))
        out = part if out is None else out.unionByName(part)
    removed = out.select("stopword_list", F.explode("r").alias("w"))
    uniq = (removed.select("stopword_list", "w").distinct()
            .withColumn("_rk", F.row_number().over(Window.partitionBy("stopword_list").orderBy("w")))
            .where(F.col("_rk") <= 50)
            .groupBy("stopword_list").agg(F.array_join(F.sort_array(F.collect_list("w")), " ").alias("unique_removed")))
    rates = out.groupBy("stopword_list").agg(
        F.when(F.sum("n") > 0, F.sum(F.size("r")) / F.sum("n")).otherwise(0.0).alias("token_removal_rate"))
    return rates.join(uniq, "stopword_list", "left")


def kept_text(tokens_col, custom: bool):
    return F.array_join(kept_tokens(tokens_col, custom), " ")
