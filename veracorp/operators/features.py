"""Feature operators in long-table form (F1-F7, F15) and retrieval (V5).

Vectors are kept as a long ``(doc_id, term, value)`` table: joins and
aggregations on it are distributed, nothing is densified, and every operator
can be checked against SQL.  The vocabulary cap (``max_features``) bounds the
vocabulary, so it is the one table we broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracorp.functions.text import word_tokens, word_tokens_2plus
from veracorp.session import broadcast_if_small, cut_lineage, staged


def term_frequencies(df: DataFrame, tokens: Column, id_col: str = "doc_id", carry=()) -> DataFrame:
    """(id, [carry...], term, tf): explode + hash aggregate keyed by (doc, term), so hot terms spread by doc.

    ``carry`` keeps per-document columns (e.g. the label) so later branches
    share this one subtree (and its exchange) instead of joining back.
    """
    return (df.select(F.col(id_col), *carry, F.explode(tokens).alias("term"))
            .groupBy(id_col, *carry, "term").agg(F.count(F.lit(1)).alias("tf")))


def top_vocabulary(tf: DataFrame, max_features: int | None) -> DataFrame:
    """Top ``max_features`` terms by total count (ties: term asc) -> (term, total).

    ``orderBy().limit()`` plans as a distributed TakeOrderedAndProject: each
    partition keeps its own top-k, only k rows per partition reach the driver side.
    """
    totals = tf.groupBy("term").agg(F.sum("tf").alias("total"))
    if max_features is None:
        return totals
    return totals.orderBy(F.desc("total"), F.asc("term")).limit(max_features)


def restrict_to_vocabulary(tf: DataFrame, vocab: DataFrame) -> DataFrame:
    # The vocabulary is capped by max_features: a proven size bound.
    return tf.join(F.broadcast(vocab.select("term")), "term")


def bow(df: DataFrame, text: str = "cleaned_text", max_features: int = 5000,
        id_col: str = "doc_id", materialize: bool = False) -> tuple[DataFrame, DataFrame]:   # F1
    """``materialize`` checkpoints the tf table, which feeds both the vocabulary and the result."""
    carry = ("label",) if "label" in df.columns else ()
    tf = term_frequencies(df, word_tokens(F.col(text)), id_col, carry)
    if materialize:
        tf = cut_lineage(tf)
    vocab = top_vocabulary(tf, max_features)
    return restrict_to_vocabulary(tf, vocab), vocab


def top_terms_per_class(tf: DataFrame, labels: DataFrame, top_n: int = 30,
                        id_col: str = "doc_id") -> DataFrame:                      # F2
    """Top terms per class by summed count; ``row_number() <= n`` plans a partial
    WindowGroupLimit before the shuffle, so only n rows per class leave each task."""
    if "label" not in tf.columns:
        tf = tf.join(labels.select(id_col, "label"), id_col)
    sums = tf.groupBy("label", "term").agg(F.sum("tf").alias("cnt"))
    w = Window.partitionBy("label").orderBy(F.desc("cnt"), F.asc("term"))
    return sums.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def idf_column(n_docs: Column, df_col: Column, variant: str) -> Column:
    if variant == "standard":
        return F.log(n_docs / df_col) + 1.0
    return F.log((n_docs + 1.0) / (df_col + 1.0)) + 1.0


def tfidf(df: DataFrame, text: str = "cleaned_text", variant: str = "standard",
          max_features: int | None = 5000, id_col: str = "doc_id",
          vocab: DataFrame | None = None, n_docs: int | None = None,
          materialize: bool = False, root: str | None = None) -> tuple[DataFrame, DataFrame]:     # F3-F5
    """L2-normalised TF-IDF long table and the fitted (term, idf) table.

    variant: standard ln(n/df)+1; smooth ln((1+n)/(1+df))+1; sublinear = smooth
    idf with 1+ln(tf).  ``n`` counts every document, including those with no
    vocabulary term.  With ``root`` the counts are materialised as a Parquet table below it, which is small but is
    dealt by document once more for the weights; else as rows that keep their partitioning.
    """
    tf = term_frequencies(df, word_tokens_2plus(F.col(text)), id_col)
    if materialize:
        tf = staged(tf, root) if root else cut_lineage(tf)      # feeds the vocabulary, the document frequencies and the weights
    if vocab is None:
        vocab = top_vocabulary(tf, max_features)
        if n_docs is None:
            n_docs = df.count()
        dfreq = restrict_to_vocabulary(tf, vocab).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        idf = dfreq.select("term", idf_column(F.lit(float(n_docs)), F.col("df").cast("double"), variant)
                           .alias("idf"))
    else:
        idf = vocab
    tfv = F.col("tf").cast("double")
    if variant == "sublinear":
        tfv = F.log(tfv) + 1.0
    w = tf.join(F.broadcast(idf), "term").withColumn("w", tfv * F.col("idf"))
    # the postings move once, by document; a window holds one document's terms (max_features at most)
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", (F.col("w") / norm).alias("weight")), idf


def discriminative_terms(weights: DataFrame, labels: DataFrame, top_n: int = 15,
                         id_col: str = "doc_id") -> DataFrame:                     # F6
    """mean weight inside the class minus mean weight outside it (zeros included)."""
    lab = labels.select(id_col, "label")
    counts = lab.groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    n_all = counts.agg(F.sum("n_c").alias("n")).first()["n"]
    per = weights.join(lab, id_col).groupBy("label", "term").agg(F.sum("weight").alias("s"))
    tot = per.groupBy("term").agg(F.sum("s").alias("tot"))
    # every (class, term) pair, including classes where the term never occurs
    classes = [r["label"] for r in counts.select("label").collect()]   # bounded: label domain
    pairs = tot.select("term", "tot", F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    score = (pairs.join(per, ["label", "term"], "left")
             .join(F.broadcast(counts), "label")
             .select("label", "term",
                     (F.coalesce(F.col("s"), F.lit(0.0)) / F.col("n_c")
                      - F.when(F.lit(n_all) - F.col("n_c") > 0,
                               (F.col("tot") - F.coalesce(F.col("s"), F.lit(0.0))) / (F.lit(n_all) - F.col("n_c")))
                      .otherwise(F.lit(0.0))).alias("score")))
    # float ties: rank on the score rounded to 9 places, then the term
    w = Window.partitionBy("label").orderBy(F.desc(F.round("score", 9)), F.asc("term"))
    return score.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def sparsity(weights: DataFrame, n_docs: int, vocab_size: int, id_col: str = "doc_id") -> DataFrame:   # F15
    return weights.agg(F.count(F.lit(1)).alias("nnz")).select(
        F.lit(n_docs).cast("long").alias("n_docs"), F.lit(vocab_size).cast("long").alias("vocab_size"),
        "nnz", (1.0 - F.col("nnz") / F.lit(float(n_docs * vocab_size))).alias("sparsity"))


def query_vectors(queries: DataFrame, idf: DataFrame, text: str, variant: str,
                  id_col: str = "query_id") -> DataFrame:
    """Transform query texts with a fitted (term, idf) table (L2-normalised)."""
    w, _ = tfidf(queries, text=text, variant=variant, id_col=id_col, vocab=idf)
    return w


def cosine_product(qvec: DataFrame, dvec: DataFrame, q_id: str = "query_id", d_id: str = "doc_id") -> DataFrame:   # F7
    """Every (query, doc, score) that share a term: the plain product, which ``retrieval`` answers without."""
    q = broadcast_if_small(qvec.select(F.col(q_id), "term", F.col("weight").alias("qw")))
    return (dvec.select(F.col(d_id), "term", F.col("weight").alias("dw")).join(q, "term")
            .groupBy(q_id, d_id).agg(F.sum(F.col("qw") * F.col("dw")).alias("score")))
