"""Keep-first dedup: its plan moves no text, ties and odd columns."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp import session
from veracorp.operators import corpus as C
from veracorp.plans.base import combined


def exchanges(df):
    """The shuffles, sorts and sort-based aggregates of the final plan, as text."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return plan


def rows(spark, n=400, hot=0.4):
    return spark.range(n).selectExpr("id AS doc_id", f"CASE WHEN id % 10 < {int(hot * 10)} THEN 'hot text' ELSE concat('text ', id % 150) END AS text",
                                     "0 AS source_rank", "CAST(id AS BIGINT) AS row_ord")


def test_no_text_is_shuffled_or_sorted_when_few_texts_repeat(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # the plan as it will run
    try:
        plan = exchanges(C.dedup_first(rows(spark)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Sort " not in plan
    for line in plan.split("\n\n"):
        if "Exchange" in line.split("\n")[0] and "Broadcast" not in line.split("\n")[0]:
            assert "text#" not in line, line


def test_both_sides_of_the_bound_keep_the_same_rows(spark, monkeypatch):
    df = rows(spark)
    want = sorted(map(tuple, C.dedup_first(df).collect()))
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(session.broadcast_if_small, "__defaults__", (0, True))
    assert sorted(map(tuple, C.dedup_first(df).collect())) == want
    firsts = {}
    for r in df.orderBy("row_ord").collect():
        firsts.setdefault(r.text, r.row_ord)
    assert {r[1]: r[3] for r in want} == firsts and len(want) == len(firsts)


def test_equal_rows_of_equal_order_with_a_map_column(spark):
    df = spark.createDataFrame([(1, "a", 0, 5), (2, "a", 0, 5), (2, "a", 0, 5), (3, "a", 0, 6), (4, "b", 0, None), (4, "b", 0, None)],
                               "doc_id long, text string, source_rank int, row_ord long").withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    got = sorted((r.doc_id, r.text, r.m["k"]) for r in C.dedup_first(df).collect())
    assert got == [(1, "a", 1), (4, "b", 4)]


def test_measured_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1, [1.0] * 50)] * 10, "s string, i long, a array<double>")
    n, size = session.measured_bytes(df)
    assert n == 10 and 10 * (1000 + 50 * 3) < size < 10 * 2000
    assert session.measured_bytes(df.limit(0)) == (0, 0)


def test_combined_corpus_is_unchanged(spark):
    docs = combined(spark, SF_SMALL)
    assert docs.count() == docs.select("text").distinct().count()
