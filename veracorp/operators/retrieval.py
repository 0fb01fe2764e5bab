"""Top-k retrieval over impact-ordered posting blocks with max-score pruning.

A plain cosine search multiplies every posting of every query term, so a term that stands
in every document costs queries x documents.  ``ImpactIndex`` stores a term's postings in
blocks: by *impact* (halvings of the term's largest weight, so that block 0 holds the
postings that matter most) and by a hash of the document (so that no block, task or reducer
ever holds a common term whole).  Each block knows its largest weight.

A search runs in three rounds, all joins over blocks:

1. *probe*: the strongest blocks of the query's terms give partial scores; the k-th of them is a
   threshold that k documents are known to reach.
2. *candidates*: a query's terms are ordered by the most they can add.  The weakest ones that
   cannot reach the threshold even together are non-essential: no document can win by them
   alone.  Only essential terms generate candidates, and of them only blocks, then postings,
   that reach the threshold with everything else at its best.
3. *completion*: candidates that can still win get the weights of the non-essential terms, read
   from the blocks that their document hash points to.

The result is that of the full product: every document whose score reaches the k-th best
score passes all three bounds.  Equal scores (to 9 places) rank by document id.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame, GroupedData, Observation, SparkSession, Window
from pyspark.sql import functions as F

from veracorp.operators.lake import path_exists
from veracorp.session import broadcast_if_small, cut_lineage

# Postings of a term that share a document hash; a block holds those of one impact level.
BLOCK = 512
LEVELS = 8
# Impact levels that the probe reads.
PROBE_LEVELS = 2
# Postings in all that a batch may score without pruning: seconds of one core.
PLAIN = 20_000_000
# Scored postings that a task sums up, whatever the batch and the index.
SUMMED = 2_000_000
# Sums of the same weights in another order differ by less than this; ranks round to 9 places.
EPS = 1e-8


def _part(doc: Column, parts: Column) -> Column:
    return F.pmod(F.xxhash64(doc), parts)


@dataclass
class ImpactIndex:
    """``terms`` (term, n, top, parts) and ``blocks`` (term, part, level, bound, postings of (doc, weight))."""

    terms: DataFrame
    blocks: DataFrame
    counters: dict = field(default_factory=dict)

    @classmethod
    def build(cls, weights: DataFrame, id_col: str = "doc_id", block: int = BLOCK) -> ImpactIndex:
        """From (doc, term, weight), weights above 0.  ``weights`` is read twice: pass a materialised table."""
        terms = weights.groupBy("term").agg(F.count("*").alias("n"), F.max("weight").alias("top"))
        terms = cut_lineage(terms.withColumn("parts", F.ceil(F.col("n") / block).cast("int")))
        level = F.least(F.lit(LEVELS - 1), F.floor(F.log2(F.col("top") / F.col("weight"))).cast("int"))
        placed = (weights.join(broadcast_if_small(terms, materialize=False), "term")
                  .select("term", _part(F.col(id_col), F.col("parts")).cast("int").alias("part"), level.alias("level"), F.col(id_col).alias("doc"), "weight"))
        # dealt by range once: the aggregate and the sorted files keep that order
        blocks = (placed.repartitionByRange("term", "part").groupBy("term", "part", "level")
                  .agg(F.max("weight").alias("bound"), F.collect_list(F.struct("doc", "weight")).alias("postings")))
        return cls(terms, blocks)

    def save(self, root: str) -> None:
        """Blocks lie in term order, so that a scan for some terms skips the files and row groups of others."""
        self.blocks.sortWithinPartitions("term", "part", "level").write.mode("overwrite").parquet(f"{root}/blocks")
        self.terms.write.mode("overwrite").parquet(f"{root}/terms")

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> ImpactIndex:
        return cls(spark.read.parquet(f"{root}/terms"), spark.read.parquet(f"{root}/blocks"))

    @staticmethod
    def saved(spark: SparkSession, root: str) -> bool:
        return path_exists(spark, f"{root}/terms/_SUCCESS")

    def _counted(self, df: DataFrame, name: str) -> DataFrame:
        """Count the postings that are scored as they pass, without a pass of its own."""
        self.counters[name] = Observation(name)   # of the last search
        return df.observe(self.counters[name], F.count(F.lit(1)).alias("n"))

    def scored(self) -> dict[str, int]:
        """Postings scored by each round of the last search (known once its result has been read)."""
        return {name: seen.get["n"] for name, seen in self.counters.items()}

    def full_product(self, queries: DataFrame) -> int:
        """Postings that the plain product would score."""
        return queries.join(self.terms, "term").agg(F.sum("n")).first()[0] or 0

    def top_k(self, queries: DataFrame, k: int, q_id: str = "query_id", d_id: str = "doc_id", plain: int = PLAIN) -> DataFrame:
        """(query, doc, score, rank <= k) of the documents that share a term with the query.

        ``queries``: (query, term, weight), weights above 0; a batch whose size is counted and that is broadcast only
        below the session's bound.  Where the full product is at most ``plain`` postings, one pass over the query's
        blocks is cheaper than three rounds; both ways give the same rows.
        """
        queries = cut_lineage(queries.select(q_id, "term", "weight"))
        total = self.full_product(queries)
        if total <= plain:
            asked = broadcast_if_small(queries.select(q_id, "term", F.col("weight").alias("qw")), materialize=False)
            every = self.blocks.select("term", "postings").join(asked, "term").select(q_id, "qw", F.explode("postings").alias("p"))
            every = self._counted(every, "product").select(q_id, F.col("p.doc").alias(d_id), (F.col("qw") * F.col("p.weight")).alias("s"))
            return ranked(_dealt(every, total, q_id, d_id).agg(F.sum("s").alias("score")), k, q_id, d_id)
        return self._pruned(queries, k, q_id, d_id, total)

    def _pruned(self, queries: DataFrame, k: int, q_id: str, d_id: str, total: int) -> DataFrame:
        qt = queries.select(F.col(q_id).alias("q"), "term", F.col("weight").alias("qw")).join(self.terms, "term")
        qt = qt.withColumn("most", F.col("qw") * F.col("top"))
        asc = Window.partitionBy("q").orderBy("most", "term")       # a query's own terms
        qt = cut_lineage(qt.select("q", "term", "qw", "most", "parts", F.sum("most").over(asc).alias("upto"),
                                   F.sum("most").over(Window.partitionBy("q")).alias("total")))
        strong = self.blocks.where((F.col("part") == 0) & (F.col("level") < PROBE_LEVELS)).select("term", "postings")
        probe = strong.join(broadcast_if_small(qt.select("q", "term", "qw"), materialize=False), "term").select("q", "qw", F.explode("postings").alias("p"))
        probe = self._counted(probe, "probe").select("q", F.col("p.doc").alias("doc"), (F.col("qw") * F.col("p.weight")).alias("s"))
        reached = self._kth(_dealt(probe, total, "q", "doc").agg(F.sum("s").alias("score")), k)
        # one row per query: a bounded batch
        qt = cut_lineage(qt.join(reached, "q", "left").withColumn("tau", F.coalesce("kth", F.lit(0.0)) - EPS).drop("kth"))
        essential = (F.col("upto") >= F.col("tau"))
        spare = F.coalesce(F.sum(F.when(~essential, F.col("most"))).over(Window.partitionBy("q")), F.lit(0.0))
        qt = qt.withColumn("spare", spare)

        def can_win(weight: Column) -> Column:
            return F.col("qw") * weight + F.col("total") - F.col("most") >= F.col("tau")

        made = (self.blocks.select("term", "bound", "postings")
                .join(broadcast_if_small(qt.where(essential).drop("parts", "upto"), materialize=False), "term").where(can_win(F.col("bound")))
                .select("q", "qw", "total", "most", "tau", "spare", F.explode("postings").alias("p")).where(can_win(F.col("p.weight"))))
        made = self._counted(made, "candidates").select("q", F.col("p.doc").alias("doc"), (F.col("qw") * F.col("p.weight")).alias("s"), "spare", "tau")
        found = _dealt(made, total, "q", "doc").agg(F.sum("s").alias("score"), F.max("spare").alias("spare"), F.max("tau").alias("tau"))
        found = cut_lineage(found.where(F.col("score") + F.col("spare") >= F.col("tau")))
        # what candidates are known to score is a threshold of its own
        found = found.join(self._kth(found, k), "q", "left").where(F.col("score") + F.col("spare") >= F.coalesce("kth", F.lit(0.0)) - EPS)
        rest = qt.where(~essential).select("q", "term", "qw", "parts")
        asked = (found.select("q", "doc").join(broadcast_if_small(rest, materialize=False), "q")
                 .select("q", "doc", "term", "qw", _part(F.col("doc"), F.col("parts")).cast("int").alias("part")))
        asked = cut_lineage(asked)
        where = broadcast_if_small(asked.select("term", "part").distinct(), materialize=False)
        held = self.blocks.select("term", "part", "postings").join(where, ["term", "part"], "left_semi").select("term", F.explode("postings").alias("p"))
        more = self._counted(held.select("term", F.col("p.doc").alias("doc"), F.col("p.weight").alias("weight"))
                             .join(broadcast_if_small(asked, materialize=False), ["term", "doc"]), "completion")
        more = more.groupBy("q", "doc").agg(F.sum(F.col("qw") * F.col("weight")).alias("more"))
        scores = found.join(more, ["q", "doc"], "left").select(F.col("q").alias(q_id), F.col("doc").alias(d_id), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
        return ranked(scores, k, q_id, d_id)

    @staticmethod
    def _kth(scores: DataFrame, k: int) -> DataFrame:
        """(q, kth): the k-th best score of each query that has so many."""
        w = Window.partitionBy("q").orderBy(F.desc("score"))
        best = scores.select("q", "score").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
        return best.groupBy("q").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k).drop("n")


def _dealt(scored: DataFrame, total: int, q: str, doc: str) -> GroupedData:
    """Scored postings, at most ``total``, grouped by query and document in tasks of about SUMMED.  They are dealt before they are
    summed: blocks lie by term, so few of a task's postings share a document and a sum ahead of the shuffle would hold nearly all."""
    return scored.repartition(max(1, ceil(total / SUMMED)), q, doc).groupBy(q, doc)


def ranked(scores: DataFrame, k: int, q_id: str, d_id: str) -> DataFrame:
    w = Window.partitionBy(q_id).orderBy(F.desc(F.round("score", 9)), F.asc(d_id))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def filled(top: DataFrame, query_ids: DataFrame, documents: DataFrame, k: int, q_id: str = "query_id", d_id: str = "doc_id") -> DataFrame:
    """``top`` with the lowest document ids at score 0 for queries that match fewer than k documents.

    Such a query's top-k holds all of its matches, so the fill is told from ``top`` alone.  2k ids (k is at
    most 20) are enough, as fewer than k of them can be matches.
    """
    low = [r[0] for r in documents.select(d_id).orderBy(d_id).limit(2 * k).collect()]
    top = top.select(q_id, d_id, "score")
    short = query_ids.join(top.groupBy(q_id).agg(F.count("*").alias("_n")), q_id, "left").where(F.coalesce("_n", F.lit(0)) < k)
    zeros = short.select(q_id, F.explode(F.array(*[F.lit(v) for v in low])).alias(d_id)) if low else short.select(q_id, F.lit(None).alias(d_id)).where("false")
    zeros = zeros.join(top.select(q_id, d_id), [q_id, d_id], "left_anti").withColumn("score", F.lit(0.0))
    return ranked(top.unionByName(zeros), k, q_id, d_id)
