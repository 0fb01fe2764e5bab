"""Positions of rows within groups, without one task ever holding a group.

A window over a group sends the whole group to one task.  Here the rows are dealt by
range and sorted, so that a large group covers several tasks; a row's position is its
number in the task plus the rows of its group in the tasks before.  Only one row per
task and group, never the group itself, meets in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracorp.llm.common import stage


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with (_part, _at), and the runs: (_part, group..., _first, _before, _size).

    A row's position in its group is ``_at - _first + _before``; ``_size`` counts the group.
    Nulls come first in every column.  Rows equal in all of ``order`` are told apart by
    their place in a staged table, so that even a row repeated in a third of all rows is
    spread over tasks.
    """
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [*group, *order, "_row"]
    rows = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
            .withColumn("_at", F.monotonically_increasing_id()))
    rows = stage(rows.withColumn("_part", F.shiftright("_at", 33)), f"{name}-ranked")
    runs = rows.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))  # a row per task that holds rows of the group
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", *group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                       F.sum("_n").over(whole).alias("_size"))
    return rows, stage(runs, f"{name}-runs")


def positions(rows: DataFrame, group: list[str], order: list[str], name: str, pos: str = "pos", size: str = "size",
              more: tuple[DataFrame, list[str]] | None = None) -> DataFrame:
    """``rows`` with their position ``pos`` (from 0) in their group and the group's ``size``.

    ``more`` = (one row per group, its columns to bring along), joined to the runs first.
    Runs are a few per task; whether they are broadcast is Spark's choice by their file size.
    """
    rows, runs = ranked(rows, group, order, name)
    return placed(rows, runs, group, pos, size)


def placed(rows: DataFrame, runs: DataFrame, group: list[str], pos: str = "pos", size: str = "size") -> DataFrame:
    right = runs.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                        *[c for c in runs.columns if c not in ("_part", *group)])
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (rows.join(right, on).withColumn(pos, F.col("_at") - F.col("_first") + F.col("_before"))
            .withColumn(size, F.col("_size"))
            .drop("_part", "_p", "_at", "_first", "_before", "_size", *[f"_g{i}" for i in range(len(group))]))
