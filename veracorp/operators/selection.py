"""Deterministic hash order and exact per-group selection.

``random_state=42`` sampling cannot be reproduced on a cluster, so every
"random" choice is made by a seeded md5 order: ``md5('<seed>|' || id)``.  The
same expression exists in SQL engines, so an oracle can match row for row.

``flag_first_per_group`` marks, for every group, the first ``quota`` rows in
hash order.  A window partitioned by the group would put a whole class (which
may hold a third of all rows) into one task, so the selection is done in two
distributed passes instead:

1. a histogram of rows per (group, hash bucket) -- 65,536 buckets from the
   first four hex digits of the md5 -- whose running sum per group is a window
   over at most 65,536 rows per group;
2. a broadcast join of the (bounded) bucket decisions: buckets wholly below
   the quota are taken, buckets wholly above are dropped, and only the single
   boundary bucket of each group is ranked by a window.

The result is exact, and no task ever holds more than one bucket's rows.
The input is read by the histogram pass and by the flag pass, so callers pass
a materialised input (a table scan or a checkpoint), not a long lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SEED = 42
BUCKET_HEX_DIGITS = 4  # 16**4 = 65,536 buckets per group


def hash_key(id_col: str | Column, seed: int = DEFAULT_SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")))


def flag_first_per_group(df: DataFrame, group: str, key: str, quotas: DataFrame,
                         flag: str = "selected") -> DataFrame:
    """Add boolean ``flag``: row is among the first ``quota`` rows of its group by ``key``.

    ``quotas`` has columns (group, quota); it has one row per group, so its
    size is bounded by the number of groups.
    """
    b = "_bucket"
    x = df.withColumn(b, F.substring(F.col(key), 1, BUCKET_HEX_DIGITS))
    hist = x.groupBy(group, b).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (hist.withColumn("_cum", F.sum("_n").over(run))
            .join(F.broadcast(quotas.select(group, F.col("quota").cast("long").alias("_q"))), group))
    cut = (hist.withColumn("_state",
                           F.when(F.col("_cum") <= F.col("_q"), F.lit("all"))
                           .when(F.col("_cum") - F.col("_n") < F.col("_q"), F.lit("part")))
           .where(F.col("_state").isNotNull())
           .select(group, b, "_state", (F.col("_q") - (F.col("_cum") - F.col("_n"))).alias("_rest")))
    # ``cut`` holds at most (#groups x 65,536) rows: a proven bound, so broadcast.
    j = x.join(F.broadcast(cut), [group, b], "left")
    whole = (j.where(F.col("_state").isNull() | (F.col("_state") == "all"))
             .withColumn(flag, F.coalesce(F.col("_state") == "all", F.lit(False))))
    rank = Window.partitionBy(group, b).orderBy(key)
    edge = (j.where(F.col("_state") == "part")
            .withColumn(flag, F.row_number().over(rank) <= F.col("_rest")))
    return whole.unionByName(edge).drop(b, "_state", "_rest")


def class_counts(df: DataFrame, group: str = "label") -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("cnt"))


def largest_remainder_quota(counts: DataFrame, total: Column, group: str = "label") -> DataFrame:
    """Split ``total`` over groups in proportion to ``cnt`` (largest remainder, ties by group asc).

    ``counts`` is the small per-group count table; windows over it see one row per group.
    """
    all_rows = Window.partitionBy()
    c = (counts.withColumn("_N", F.sum("cnt").over(all_rows))
         .withColumn("_T", total)
         .withColumn("_exact", F.col("_T") * F.col("cnt") / F.col("_N"))
         .withColumn("_base", F.floor("_exact"))
         .withColumn("_left", F.col("_T") - F.sum("_base").over(all_rows))
         .withColumn("_r", F.row_number().over(Window.orderBy(F.desc(F.col("_exact") - F.col("_base")), group))))
    return c.select(group, "cnt", (F.col("_base") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0))
                    .cast("long").alias("quota"))
