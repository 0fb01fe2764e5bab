"""N-gram language models (G1-G12) as aggregate tables and joins.

A model is three partial-aggregated counts keyed by class: n-gram counts,
context counts and per-token statistics (unigram count of the final token and
the number of distinct contexts before it).  Scoring joins the n-grams of the
documents to those tables; one job scores every (document, class) pair.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracorp.functions.lexicon import KN_DISCOUNT, LM_END, LM_PROB_FLOOR, LM_START
from veracorp.functions.text import whitespace_tokens
from veracorp.session import BROADCAST_BYTES, measured_bytes, staged


def lm_tokens(text: str | Column = "text") -> Column:
    """``text.lower().split()``."""
    return whitespace_tokens(F.col(text) if isinstance(text, str) else text)


def ngrams(df: DataFrame, n: int, tokens: Column, keep: tuple[str, ...] = ("doc_id", "label")) -> DataFrame:
    """One row per n-gram occurrence: keep cols, ngram, ctx, tok (strings, space-joined).

    Padding: n-1 ``<START>`` and one ``<END>``.  Built per row with array
    functions (no shuffle).
    """
    start = [F.lit(LM_START)] * (n - 1)
    padded = F.concat(F.array(*start).cast("array<string>") if start else F.array().cast("array<string>"),
                      tokens, F.array(F.lit(LM_END)))
    grams = F.transform(F.sequence(F.lit(1), F.size("_p") - F.lit(n - 1)), lambda i: F.slice(F.col("_p"), i, n))
    x = df.select(*keep, padded.alias("_p")).select(*keep, F.explode(grams).alias("_g"))
    return x.select(*keep,
                    F.array_join("_g", " ").alias("ngram"),
                    F.array_join(F.slice("_g", 1, n - 1), " ").alias("ctx") if n > 1 else F.lit("").alias("ctx"),
                    F.element_at("_g", n).alias("tok"))


def _with_parts(grams: DataFrame, n: int) -> DataFrame:
    """ctx and tok of each n-gram: tokens hold no space, so they are cut from it after it was counted."""
    return grams.withColumns({"ctx": F.substring_index("ngram", " ", n - 1) if n > 1 else F.lit(""), "tok": F.substring_index("ngram", " ", -1)})


def extract_ngrams(df: DataFrame, n: int, min_count: int = 1, text: str = "text") -> DataFrame:   # G1
    g = ngrams(df, n, lm_tokens(text), keep=())
    return g.groupBy("ngram").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") >= min_count)


class NGramModel:
    """Per-class n-gram counts."""

    scratch: str | None = None

    def __init__(self, train: DataFrame, n: int = 3, text: str = "text", label: str = "label",
                 materialize: bool = True, root: str | None = None):
        """Tables are staged below ``root`` (else the shared folder), without what follows from their n-grams."""
        self.n, self.scratch = n, root
        self.occurrences = g = ngrams(train.withColumnRenamed(label, "label"), n, lm_tokens(text), keep=("label",)).select("label", "ngram")
        counts = g.groupBy("label", "ngram").agg(F.count(F.lit(1)).alias("c"))
        self.ngram_counts = _with_parts(staged(counts, root) if materialize else counts, n)
        # context totals, unigram count of the final token and distinct contexts before it
        # all derive from the (much smaller) distinct n-gram table: one pass over the text
        self.ctx_counts = self.ngram_counts.groupBy("label", "ctx").agg(F.sum("c").alias("ctot"),
                                                                        F.count(F.lit(1)).alias("n1p"))
        self.tok_stats = self.ngram_counts.groupBy("label", "tok").agg(F.sum("c").alias("uni"),
                                                                        F.count(F.lit(1)).alias("U"))
        self.training_documents = train.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("training_documents"))
        self.class_stats = (self.tok_stats.groupBy("label")
                            .agg(F.count(F.lit(1)).alias("V"), F.sum("uni").alias("N"))
                            .join(self.ngram_counts.groupBy("label").agg(F.count(F.lit(1)).alias("unique_ngrams")),
                                  "label")
                            .join(self.training_documents, "label"))

    def classes(self) -> list[str]:
        # the label domain is a handful of classes: a bounded list
        return sorted(r["label"] for r in self.training_documents.select("label").collect())

    def model_tables(self) -> dict[str, DataFrame]:
        """The model as three wide tables, one row per n-gram, context and token: an array of counts per statistic, one
        entry per class in order.  With the classes known the aggregates are plain sums, combined map-side."""
        classes = self.classes()

        def wide(key: str, **measures) -> DataFrame:
            """``measures``: an aggregate of the n-gram rows of one class, by name."""
            cells = [made(F.col("label") == c).alias(f"{name}{i}") for name, made in measures.items() for i, c in enumerate(classes)]
            return self.ngram_counts.groupBy(key).agg(*cells).select(
                key, *[F.array(*[F.col(f"{name}{i}") for i in range(len(classes))]).alias(name) for name in measures])

        def total(of_class: Column) -> Column:
            return F.sum(F.when(of_class, F.col("c")).otherwise(0))

        return {"ngram": wide("ngram", c=total), "ctx": wide("ctx", ctot=total, n1p=F.count_if), "tok": wide("tok", uni=total, U=F.count_if)}

    def scored_ngrams(self, docs: DataFrame, text: str = "text", id_col: str | None = "doc_id") -> DataFrame:
        """(doc, label, ngram, m, counts...): every test n-gram against every class; without ``id_col`` those of all documents together."""
        keep = [id_col] if id_col else []
        g = ngrams(docs, self.n, lm_tokens(text), keep=keep)
        g = _with_parts(staged(g.groupBy(*keep, "ngram").agg(F.count(F.lit(1)).alias("m")), self.scratch), self.n)
        # When the held-out n-gram table is measured to be small, its keys are broadcast
        # to filter the model tables map-side (semi joins) before they are joined.
        small = measured_bytes(g)[1] <= BROADCAST_BYTES
        for key, held in self.model_tables().items():
            if small:
                held = held.join(F.broadcast(g.select(key).distinct()), key, "left_semi")
            # each table is joined once per test n-gram; the classes (a handful) are spread afterwards
            g = g.join(held, key, "left")
        stats = [r.asDict() for r in self.class_stats.select("label", "V", "N", "unique_ngrams").orderBy("label").collect()]
        per_class = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("label", "V", "N", "unique_ngrams")]) for r in stats])
        g = g.select("*", F.posexplode(per_class).alias("_i", "cls"))
        counts = [F.coalesce(F.get(c, F.col("_i")), F.lit(0)).alias(c) for c in ("c", "ctot", "n1p", "uni", "U")]
        return g.select(*keep, "ngram", "ctx", "tok", "m", "cls.*", *counts)

    def save(self, root: str) -> None:
        """Write the model for scoring: each wide table bucketed and sorted by its key, then the class statistics.

        The n-grams of the text are counted into the wide table at once, so they are shuffled a single time and staged
        nowhere else; contexts and tokens come from that table."""
        spark = self.ngram_counts.sparkSession
        buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
        classes = range(len(self.classes()))

        def wide(held: DataFrame, key: str, **measures) -> DataFrame:
            """``measures``: an aggregate for the class at a place, by name."""
            cells = [made(i).alias(f"{name}{i}") for name, made in measures.items() for i in classes]
            return held.groupBy(key).agg(*cells).select(key, *[F.array(*[F.col(f"{name}{i}") for i in classes]).alias(name) for name in measures])

        def count(i: int) -> Column:
            return F.col("c")[i]

        def ngram_table() -> DataFrame:
            labels = self.classes()
            return wide(self.occurrences, "ngram", c=lambda i: F.count_if(F.col("label") == labels[i]))

        def part_table(key: str, total: str, distinct: str) -> DataFrame:
            held = _with_parts(spark.table(_table_name(root, "ngram")), self.n)
            return wide(held, key, **{total: lambda i: F.sum(count(i)), distinct: lambda i: F.count_if(count(i) > 0)})

        tables = {"ngram": ngram_table, "ctx": lambda: part_table("ctx", "ctot", "n1p"), "tok": lambda: part_table("tok", "uni", "U")}
        for key, table in tables.items():
            name = _table_name(root, key)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            held = table()
            # the aggregate has dealt the rows by the key's hash already, so each bucket comes from one task
            (held.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", f"{root}/{key}")
             .format("parquet").saveAsTable(name))
        # class statistics are sums over the token table, which holds every class
        classes = self.classes()
        sums = spark.table(_table_name(root, "tok")).agg(F.array(*[
            F.struct(F.lit(c).alias("label"), F.count_if(F.col("uni")[i] > 0).alias("V"), F.coalesce(F.sum(F.col("uni")[i]), F.lit(0)).alias("N"),
                     F.coalesce(F.sum(F.col("U")[i]), F.lit(0)).alias("unique_ngrams")) for i, c in enumerate(classes)]).alias("s"))
        meta = (sums.select(F.explode("s").alias("s")).select("s.*").join(self.training_documents, "label")
                .select("*", F.lit(self.n).alias("model_order"), F.lit(buckets).alias("buckets")))
        meta.coalesce(1).write.mode("overwrite").parquet(f"{root}/classes")       # a row per class, written last

    def probability(self, method: str = "kneser-ney", k: float = 1.0) -> Column:
        c, C, V, N = F.col("c"), F.col("ctot"), F.col("V"), F.col("N")
        if method == "laplace":                                                     # G4
            den = C + F.lit(k) * V
            return F.when(den == 0, 1.0 / V).otherwise((c + F.lit(k)) / den)
        d = F.lit(KN_DISCOUNT)
        if method == "interpolated_kn" and self.n > 1:                              # published formula
            # P(w|ctx) = max(c - d, 0)/C + d * N1+(ctx .)/C * N1+(. w)/N1+(. .); unseen context -> P_cont(w)
            p_cont = F.col("U") / F.col("unique_ngrams")
            return F.when(C == 0, p_cont).otherwise(
                F.greatest(c - d, F.lit(0.0)) / C + d * F.col("n1p") / C * p_cont)
        # G5 as coded in the reference
        first = F.greatest(c - d, F.lit(0.0)) / C
        if self.n > 1:
            first = first + (d / C) * F.col("U") * F.col("uni") / N
        return F.when(C == 0, 1.0 / V).otherwise(first)

    def perplexity(self, docs: DataFrame, method: str = "kneser-ney", text: str = "text",
                   id_col: str = "doc_id", per_doc: bool = True) -> DataFrame:      # G6
        s = self.scored_ngrams(docs, text, id_col if per_doc else None)
        p = self.probability(method)
        lp = F.when(p > 0, F.log(p)).otherwise(F.lit(math.log(LM_PROB_FLOOR)))
        s = s.withColumn("_lp", lp * F.col("m"))
        keys = [id_col, "label"] if per_doc else ["label"]
        return s.groupBy(*keys).agg(F.exp(-F.sum("_lp") / F.sum("m")).alias("perplexity"))

    def predict(self, docs: DataFrame, method: str = "kneser-ney", text: str = "text",
                id_col: str = "doc_id") -> DataFrame:                                # G9
        """Class with the least perplexity (ties: label asc)."""
        pp = self.perplexity(docs, method, text, id_col)
        return pp.groupBy(id_col).agg(F.min(F.struct("perplexity", "label")).alias("_m")).select(
            id_col, F.col("_m.label").alias("pred"))

    def top_ngrams(self, top_n: int = 20) -> DataFrame:                            # G7
        w = Window.partitionBy("label").orderBy(F.desc("c"), F.asc("ngram"))
        return (self.ngram_counts.withColumn("rank", F.row_number().over(w))
                .where(F.col("rank") <= top_n))


def _table_name(root: str, key: str) -> str:
    return f"lm_{hashlib.md5(root.encode()).hexdigest()[:16]}_{key}"


class SavedNGramModel(NGramModel):
    """A model that ``save`` wrote.  Its tables are read by bucket, so a scoring batch is shuffled to them and
    the model itself never moves, whatever its size."""

    KEYS = {"ngram": "ngram STRING, c ARRAY<BIGINT>", "ctx": "ctx STRING, ctot ARRAY<BIGINT>, n1p ARRAY<BIGINT>",
            "tok": "tok STRING, uni ARRAY<BIGINT>, U ARRAY<BIGINT>"}

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.class_stats = spark.read.parquet(f"{root}/classes")
        self.training_documents = self.class_stats
        self.n, buckets = self.class_stats.select("model_order", "buckets").first()
        for key, columns in self.KEYS.items():
            # the name belongs to this session; the files are those of the saved model
            spark.sql(f"""CREATE TABLE IF NOT EXISTS {_table_name(root, key)} ({columns}) USING parquet
                          CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{root}/{key}'""")

    def model_tables(self) -> dict[str, DataFrame]:
        return {key: self.spark.table(_table_name(self.root, key)).hint("merge") for key in self.KEYS}


def analyze_ngrams(df: DataFrame, orders=(1, 2, 3), min_count: int = 2, text: str = "text") -> DataFrame:   # G11
    parts = []
    for n in orders:
        g = ngrams(df, n, lm_tokens(text), keep=("label",))
        parts.append(g.groupBy("label", "ngram").agg(F.count(F.lit(1)).alias("cnt"))
                     .where(F.col("cnt") >= min_count).withColumn("n", F.lit(n)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_ngrams(analysis: DataFrame, top_n: int = 20) -> DataFrame:           # G12
    w = Window.partitionBy("label", "n").orderBy(F.desc("cnt"), F.asc("ngram"))
    return analysis.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
