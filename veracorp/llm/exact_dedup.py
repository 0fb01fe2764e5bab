"""Operator 7, exact dedup [native]: a persistent digest index.

The index is a Parquet table bucketed and sorted by digest.  A load is first
reduced to one row per digest (partial aggregation runs before the shuffle, so
a text that a third of all rows share reaches its reducer as one row per map
task), then anti-joined with the index by sort-merge -- the index side is read
by bucket and never shuffled -- and the digests that remain are appended.

Defined results
  * null text reads as the empty text; empty texts form one group.
  * of equal texts the row with the smallest ``doc_id`` stays; null ids come
    last, repeated rows of one id are told apart by their row number, so
    exactly one row of every group stays.
  * an empty table gives an empty result; extra columns are carried in a struct
    and cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm.common import ASCII_SPACE, documents, shared_path, stage, whole_text

# Groups of at least 1/HOT_SHARE of all rows are hot: there are at most HOT_SHARE of them.
HOT_SHARE = 1000


def digest_column(text_col: str = "text"):
    """SHA-256 of the text after every white-space run became one space."""
    return F.unhex(F.sha2(F.regexp_replace(whole_text(text_col), ASCII_SPACE, " "), 256))


class DigestIndex:
    """Digests seen so far, in a bucketed and sorted table at ``location``.

    A later session that names the same location and bucket count goes on with
    what earlier sessions appended.
    """

    def __init__(self, spark: SparkSession, location: str, buckets: int | None = None):
        self.spark, self.location = spark, location
        self.buckets = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"""CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, keep_row BIGINT, batch STRING) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS
                      LOCATION '{location}'""")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """Rows of ``firsts`` (one per digest) that the index lacks, by sort-merge anti-join."""
        rows = firsts.repartition(self.buckets, "digest")
        return rows.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def load(self, rows: DataFrame, batch: str) -> None:
        """Reduce ``rows`` (digest, doc_id, row) to first rows, anti-join, append under the name ``batch``."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
        firsts = (rows.groupBy("digest").agg(first.alias("first"))
                  .select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), F.lit(batch).alias("batch")))
        new = stage(self.unseen(firsts), "digest-load")  # appended from a table: a retried insert sees the same rows
        new.repartition(self.buckets, "digest").select("digest", "keep_id", "keep_row", "batch").write.insertInto(self.name)

    def close(self) -> None:
        """Forget the session's name for the table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def annotate(docs: DataFrame, index: DigestIndex, carry: list[str], loads: int = 2) -> DataFrame:
    """Every row of ``docs`` with its group: ``doc`` (a struct of the ``carry`` columns),
    digest, keep_id, group_size, kept.  The rows enter the index in ``loads`` loads
    of ascending doc_id, as successive deliveries of a corpus would."""
    rows = stage(docs.select(F.struct(*carry).alias("doc"), digest_column().alias("digest"),
                             F.col("doc_id").cast("long").alias("doc_id"),
                             F.monotonically_increasing_id().alias("row")), "digests")
    keys = rows.select("digest", "doc_id", "row")
    batch = uuid.uuid4().hex  # row numbers hold within this call only
    low, high, total = keys.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if low is None:
        index.load(keys, batch)
    else:
        step = (high - low) // loads + 1
        # compared with whole numbers: a difference or quotient of ids near the ends of the long range is not exact
        slot = F.lit(0)
        for k in range(1, loads):
            if low + k * step <= high:
                slot = F.when(F.col("doc_id") >= F.lit(low + k * step).cast("long"), k).otherwise(slot)
        slot = F.when(F.col("doc_id").isNull(), loads - 1).otherwise(slot)
        for k in range(loads):
            index.load(keys.where(slot == k), batch)
    sizes = keys.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = stage(sizes.join(index.table(), "digest"), "digest-groups")
    # At most HOT_SHARE groups can reach total / HOT_SHARE rows, so this broadcast is bounded at any size.
    hot = F.col("group_size") >= F.lit(max(2, -(-total // HOT_SHARE)))
    hot_groups = groups.where(hot)
    hot_rows = rows.join(F.broadcast(hot_groups), "digest")
    rest = (rows.join(F.broadcast(hot_groups.select("digest")), "digest", "left_anti")
            .join(groups.where(~hot).hint("merge"), "digest"))
    kept = (F.col("row") == F.col("keep_row")) & (F.col("batch") == batch)
    return hot_rows.unionByName(rest).select("doc", "digest", "keep_id", "group_size", kept.alias("kept"))


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the first row of every group of equal texts stays."""
    index = DigestIndex(spark, shared_path(spark, "digest-index"))
    return annotate(docs, index, docs.columns).where("kept").select("doc.*")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, shared_path(spark, "digest-index"))
    out = annotate(documents(spark, sf_dir).select("doc_id", "text"), index, ["doc_id"])
    return out.select("doc.doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


REGISTRY = {"op7_exact_dedup": op7_exact_dedup}

SQL = {"op7_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d"""}
