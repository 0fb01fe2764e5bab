"""Corpus operators: filters (P), dedup/sampling/balancing (D), statistics (A).

Every function maps DataFrames to DataFrames.  Statistics that are scalars in
the reference are one-row DataFrames here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions.text import clean_text, strip_edges
from veracorp.operators.selection import (class_counts, flag_first_per_group, hash_key,
                                          largest_remainder_quota)
from veracorp.session import broadcast_if_small, cut_lineage


# --- P: label mapping, year, filters -------------------------------------------

def normalize_label(col, mapping: dict) -> Column:                         # P2
    """``str(x).strip().lower()`` looked up in ``mapping``; unknown -> null."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = F.lower(strip_edges(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")))
    return F.try_element_at(m, key)


def canonical_filter(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:   # P4 + P5
    """Strip text (null -> ''), keep canonical classes and non-empty texts."""
    return (df.withColumn(text, strip_edges(F.coalesce(F.col(text).cast("string"), F.lit(""))))
            .where(F.col(label).isin(*L.CANONICAL_CLASSES) & (F.length(text) > 0)))


def require_min_rows(df: DataFrame, min_samples: int) -> DataFrame:        # P6
    """Fail the job when fewer than ``min_samples`` rows remain (checked at run time)."""
    n = df.count()
    if n < min_samples:
        raise ValueError(f"{n} rows are left after deduplication, fewer than the {min_samples} asked for")
    return df


# --- D: dedup, sampling, balancing ------------------------------------------------

def dedup_first(df: DataFrame, text: str = "text",
                order: tuple[str, ...] = ("source_rank", "row_ord")) -> DataFrame:    # D2 / D3
    """Keep one row of every distinct ``text``: the first by ``order``, nulls first; of
    rows of equal order the one that comes first as JSON.

    A first pass aggregates digests and order keys alone, with partial aggregation, and stages
    the first key of each text that occurs more than once.  That table is measured: if it is small it is
    broadcast, and the pass over the rows then neither shuffles nor sorts a text; only beyond the bound do
    rows meet it by a shuffle of their digests.  A text copied into a third of all rows is one row of the
    table.  Rows that share text and first key are few; they are reduced apart, and only where there are any.
    A struct key compares its null fields as equal.  ``df`` is read twice, so pass a scan or a staged table.
    """
    rows = df.select("*", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_h"), F.struct(*order).alias("_o"))
    counts = rows.groupBy("_h", "_o").agg(F.count(F.lit(1)).alias("_n"))
    first = (counts.groupBy("_h").agg(F.min(F.struct("_o", "_n")).alias("_m"), F.sum("_n").alias("_all")).where("_all > 1")
             .select("_h", F.col("_m._o").alias("_first"), (F.col("_m._n") > 1).alias("_tied")))
    first = cut_lineage(first)
    found = rows.join(broadcast_if_small(first, materialize=False), "_h", "left")
    out = found.where(F.col("_first").isNull() | (F.col("_o") == F.col("_first")) & ~F.col("_tied")).select(*df.columns)
    if not first.where("_tied").isEmpty():
        row = F.struct(*df.columns)
        tied = found.where(F.col("_tied") & (F.col("_o") == F.col("_first"))).groupBy("_h").agg(F.min_by(row, F.to_json(row)).alias("_row"))
        out = out.unionByName(tied.select("_row.*"))
    return out


def combine(df: DataFrame) -> DataFrame:
    """Canonical filter then keep-first dedup (the combined corpus)."""
    return dedup_first(canonical_filter(df))


def duplicate_stats(df: DataFrame, text: str = "text") -> DataFrame:    # D2 rate
    """initial / final size and duplicate rate (%) of keep-first dedup: one aggregate over digests, no row is deduplicated for it."""
    groups = df.groupBy(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("initial_size"), F.count(F.lit(1)).alias("final_size"))
    return sizes.select("initial_size", "final_size",
                        F.when(F.col("initial_size") > 0, (F.col("initial_size") - F.col("final_size")) / F.col("initial_size") * 100.0)
                        .otherwise(0.0).alias("duplicate_rate"))


def with_hash_order(df: DataFrame, id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    return df.withColumn("hkey", hash_key(id_col, seed))


def balanced_quotas(counts: DataFrame, target: int) -> DataFrame:          # D4 quotas
    """quota = target // k, +1 for the first (target % k) classes by count desc; capped at size."""
    k = Window.partitionBy()
    order = Window.orderBy(F.desc("cnt"), "label")
    return (counts.withColumn("_k", F.count(F.lit(1)).over(k))
            .withColumn("_idx", F.row_number().over(order) - 1)
            .withColumn("_base", F.floor(F.lit(target) / F.col("_k")) +
                        F.when(F.col("_idx") < F.lit(target) % F.col("_k"), 1).otherwise(0))
            .select("label", "cnt", F.least(F.col("_base"), F.col("cnt")).cast("long").alias("quota")))


def balanced_sample(df: DataFrame, target: int, seed: int = 42) -> DataFrame:   # D4
    """Class-balanced down-sample; a no-op when the corpus is not larger than target.

    The shortfall of small classes is not redistributed (reference behaviour).
    """
    x = with_hash_order(df, seed=seed)
    quotas = balanced_quotas(class_counts(x), target)
    total = x.count()
    if total <= target:
        return x.drop("hkey")
    return flag_first_per_group(x, "label", "hkey", quotas).where("selected").drop("selected", "hkey")


def imbalance_report(df: DataFrame) -> DataFrame:                          # D5
    c = class_counts(df)
    return c.agg((F.max("cnt") / F.sum("cnt")).alias("max_class_share"),
                 (F.max("cnt") / F.sum("cnt") > 0.40).alias("imbalance_detected"),
                 F.count(F.lit(1)).alias("num_classes"))


def undersample(df: DataFrame, seed: int = 42) -> DataFrame:               # D6
    """Every class down to the minority size, when imbalance is detected."""
    x = with_hash_order(df, seed=seed)
    c = class_counts(x)
    quotas = c.withColumn("quota", F.min("cnt").over(Window.partitionBy()))
    return flag_first_per_group(x, "label", "hkey", quotas.select("label", "quota")) \
        .where("selected").drop("selected", "hkey")


def class_weights(df: DataFrame) -> DataFrame:                             # D7
    """N / (k * n_c) when imbalanced (max share > 0.4), else 1.0."""
    c = class_counts(df)
    w = Window.partitionBy()
    return (c.withColumn("_N", F.sum("cnt").over(w))
            .withColumn("_k", F.count(F.lit(1)).over(w))
            .withColumn("_imb", F.max("cnt").over(w) / F.col("_N") > 0.40)
            .select("label", "cnt",
                    F.when(F.col("_imb"), F.col("_N") / (F.col("_k") * F.col("cnt")))
                    .otherwise(F.lit(1.0)).alias("weight")))


def hash_sample(df: DataFrame, n: int, id_col: str = "doc_id", seed: int = 42) -> DataFrame:   # D8
    """Uniform n-row sample by seeded hash order (distributed top-n)."""
    return with_hash_order(df, id_col, seed).orderBy("hkey").limit(n).drop("hkey")


def stratified_split(df: DataFrame, test_size: float | None = 0.2, test_rows: int | None = None,
                     seed: int = 42) -> DataFrame:                          # D9 / D10
    """Add ``is_test``: per-class test quotas by largest remainder, first rows by hash order.

    ``test_size`` is a fraction (ceil(fraction * N) test rows); ``test_rows`` an
    absolute count.
    """
    x = with_hash_order(df, seed=seed)
    counts = class_counts(x)
    n_all = F.sum("cnt").over(Window.partitionBy())
    if test_rows is not None:
        total = F.lit(test_rows)
    else:
        total = F.ceil(F.lit(test_size) * n_all)
    quotas = largest_remainder_quota(counts, total)
    return (flag_first_per_group(x, "label", "hkey", quotas.select("label", "quota"), flag="is_test")
            .drop("hkey"))


def lm_test_rows(n: int) -> int:
    """D10's held-out size: a tenth of the rows, 60 at least and 100 at most."""
    return min(100, lm_eval_rows(n))


def lm_eval_rows(n: int) -> int:
    """Held-out size of the language-model evaluation: a tenth of the rows, 60 at least."""
    return max(60, int(n * 0.1))


def first_rows(df: DataFrame, n: int = 10, order: str = "doc_id") -> DataFrame:   # D11
    return df.orderBy(order).limit(n)


# --- A: statistics ------------------------------------------------------------

def corpus_breakdown(df: DataFrame) -> DataFrame:                          # A1 (distributions)
    """Counts and mean text length by class and by source in one pass (GROUPING SETS)."""
    g = df.groupingSets([["label"], ["source_id"]], "label", "source_id").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.avg(F.length("text")).alias("avg_text_length"),
        F.grouping("label").alias("_gl"))
    return g.select(F.when(F.col("_gl") == 0, F.lit("label")).otherwise(F.lit("source_id")).alias("dimension"),
                    F.coalesce("label", "source_id").alias("value"), "cnt", "avg_text_length")


def corpus_summary(before: DataFrame, after: DataFrame) -> DataFrame:     # A1 (totals)
    """Rows, classes, sources, mean text length and duplicate rate (%)."""
    a = after.agg(F.count(F.lit(1)).alias("total_samples"),
                  F.count_distinct("label").alias("num_classes"),
                  F.count_distinct("source_id").alias("num_sources"),
                  F.avg(F.length("text")).alias("avg_text_length"))
    d = duplicate_stats(before).first()          # one row of scalars
    return a.select("*", F.lit(d["initial_size"]).cast("long").alias("initial_size"),
                    F.lit(float(d["duplicate_rate"])).alias("duplicate_rate"))


def value_counts(df: DataFrame, col: str) -> DataFrame:                   # A4
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"), col)


def _ladder_ge(value: Column, rules, default) -> Column:
    expr = None
    for bound, score in rules:
        expr = F.when(value >= bound, score) if expr is None else expr.when(value >= bound, score)
    return expr.otherwise(default)


def _ladder_le(value: Column, rules, default) -> Column:
    expr = None
    for bound, score in rules:
        expr = F.when(value <= bound, score) if expr is None else expr.when(value <= bound, score)
    return expr.otherwise(default)


def _ladder_lt(value: Column, rules, default) -> Column:
    expr = None
    for bound, score in rules:
        expr = F.when(value < bound, score) if expr is None else expr.when(value < bound, score)
    return expr.otherwise(default)


def source_scorecards(df: DataFrame) -> DataFrame:                         # A2
    """Five 1..5 metrics per source and their mean.

    One aggregation per source for year/length statistics and one per
    (source, label) for the class balance; both are partial-aggregated, so a
    source holding a third of all rows costs no more than any other.
    """
    # One pass: partial-aggregated (source, class) cells carry algebraic sums, rolled up per source.
    length = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("double")
    cells = df.groupBy("source_id", "label").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(length).alias("sl"), F.sum(length * length).alias("sl2"),
        F.sum("year").alias("sy"), F.count("year").alias("ny"), F.min("year").alias("ymin"),
        F.max("year").alias("ymax"))
    s = cells.groupBy("source_id").agg(
        F.sum("cnt").alias("sample_count"), F.max("cnt").alias("max_cls"), F.min("cnt").alias("min_cls"),
        F.count(F.lit(1)).alias("n_cls"), F.sum("sl").alias("sl"), F.sum("sl2").alias("sl2"),
        F.sum("sy").alias("sy"), F.sum("ny").alias("ny"), F.min("ymin").alias("year_min"),
        F.max("ymax").alias("year_max"))
    s = (s.withColumn("avg_year", F.when(F.col("ny") > 0, F.col("sy") / F.col("ny")))
         .withColumn("len_mean", F.col("sl") / F.col("sample_count"))
         .withColumn("len_std", F.sqrt(F.greatest(F.col("sl2") / F.col("sample_count")
                                                  - F.col("len_mean") * F.col("len_mean"), F.lit(0.0)))))
    low = F.lower(F.col("source_id"))
    cred = None
    for sub, score in L.CREDIBILITY_RULES:
        cond = F.instr(low, sub) > 0
        cred = F.when(cond, score) if cred is None else cred.when(cond, score)
    cred = cred.otherwise(L.CREDIBILITY_DEFAULT)
    rel_hit = None
    for sub in L.RELEVANCE_TERMS:
        cond = F.instr(low, sub) > 0
        rel_hit = cond if rel_hit is None else (rel_hit | cond)
    relevance = (F.when(rel_hit, L.RELEVANCE_SCORE).when(F.instr(low, "covid") > 0, L.RELEVANCE_COVID)
                 .otherwise(L.RELEVANCE_DEFAULT))
    recency = F.when(F.col("avg_year").isNull(), L.RECENCY_DEFAULT).otherwise(
        _ladder_ge(F.col("avg_year"), L.RECENCY_RULES, L.RECENCY_DEFAULT))
    ratio = F.when(F.col("n_cls") > 1, F.col("max_cls") / F.col("min_cls"))
    balance = F.when(ratio.isNull(), 1).otherwise(_ladder_le(ratio, L.BALANCE_RULES, 1))
    cv = F.col("len_std") / F.col("len_mean")
    consistency = F.when(F.col("len_mean") == 0, 1).otherwise(_ladder_lt(cv, L.CONSISTENCY_RULES, 1))
    out = s.select(
        "source_id", "sample_count", "year_min", "year_max",
        cred.alias("label_credibility"), recency.alias("recency"), relevance.alias("relevance"),
        balance.alias("class_balance"), consistency.alias("language_consistency"))
    metrics = ["label_credibility", "recency", "relevance", "class_balance", "language_consistency"]
    return out.withColumn("average_score", sum(F.col(m) for m in metrics) / F.lit(5.0))


def reliability_report(df: DataFrame) -> DataFrame:                        # A3
    cards = source_scorecards(df)
    return cards.agg(F.count(F.lit(1)).alias("num_sources"),
                     F.sum("sample_count").alias("sample_count"),
                     F.avg("average_score").alias("overall_reliability_score"),
                     F.min("year_min").alias("year_min"),
                     F.max("year_max").alias("year_max"))


def cleaned(df: DataFrame, text: str = "text", out: str = "cleaned_text") -> DataFrame:
    return df.withColumn(out, clean_text(F.col(text)))
