"""Pruned retrieval equals the full product, and scores fewer postings."""

import random

import pytest
from pyspark.sql import functions as F

from veracorp.operators import features as FE
from veracorp.operators import retrieval as R
from veracorp.session import cut_lineage


def table(spark, rows, ids):
    return spark.createDataFrame(rows, f"{ids} long, term string, weight double")


def normed(rows):
    norms = {}
    for i, _, w in rows:
        norms[i] = norms.get(i, 0) + w * w
    return [(i, t, w / norms[i] ** 0.5) for i, t, w in rows]


def corpus(n, seed=1, words=60):
    """Documents of Zipf-like terms; ``common`` stands in every one."""
    r = random.Random(seed)
    rows = []
    for d in range(n):
        terms = {f"t{min(int(r.paretovariate(0.6)), words)}" for _ in range(r.randint(1, 8))}
        rows += [(d, t, r.uniform(0.5, 3.0) * (1 + int(t[1:]) / 10)) for t in terms]
        rows.append((d, "common", r.uniform(0.05, 0.2)))
    return normed(rows)


def questions(n, seed=2, words=60):
    r = random.Random(seed)
    rows = []
    for q in range(n):
        rows += [(q, t, r.uniform(0.5, 2)) for t in {f"t{r.randint(1, words)}" for _ in range(r.randint(1, 6))}]
        rows.append((q, "common", 0.3))
    return normed(rows)


def both(spark, docs, qs, k, block=64):
    d, q = cut_lineage(table(spark, docs, "doc_id")), table(spark, qs, "query_id")
    index = R.ImpactIndex.build(d, block=block)
    got = cut_lineage(index.top_k(q, k, plain=0))
    want = R.ranked(FE.cosine_product(q, d), k, "query_id", "doc_id")

    def rows(df):
        return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in df.collect())
    assert rows(got) == rows(want)
    assert rows(R.ImpactIndex(index.terms, index.blocks).top_k(q, k)) == rows(want)
    return index, q


@pytest.mark.parametrize("k", [1, 5, 20])
def test_equals_the_full_product(spark, k):
    both(spark, corpus(800), questions(25), k)


def test_common_term_is_pruned(spark):
    index, q = both(spark, corpus(3000), questions(20), 5)
    scored, full = sum(index.scored().values()), index.full_product(q)
    assert set(index.scored()) == {"probe", "candidates", "completion"}
    assert scored < 0.5 * full, (index.scored(), full)


def test_common_term_is_spread_over_blocks(spark):
    docs = table(spark, corpus(3000), "doc_id")
    index = R.ImpactIndex.build(cut_lineage(docs), block=64)
    sizes = index.blocks.where("term = 'common'").select(F.size("postings").alias("n"), "part").collect()
    assert max(r.n for r in sizes) <= 2 * 64 and len({r.part for r in sizes}) >= 40
    assert sum(r.n for r in sizes) == 3000
    bound = index.blocks.where(F.exists("postings", lambda p: p["weight"] > F.col("bound"))).count()
    assert bound == 0


def test_ties_missing_terms_and_few_matches(spark):
    docs = [(d, "same", 1.0) for d in range(50)] + [(100, "rare", 1.0)]
    qs = [(1, "same", 1.0), (2, "rare", 1.0), (3, "unknown", 1.0)]
    index, q = both(spark, docs, qs, 4)
    top = cut_lineage(index.top_k(q, 4))
    got = R.filled(top, spark.createDataFrame([(i,) for i in (1, 2, 3)], "query_id long"),
                   spark.createDataFrame([(d,) for d in (*range(50), 100)], "doc_id long"), 4)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    assert found == {1: [(0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0)], 2: [(100, 1.0), (0, 0.0), (1, 0.0), (2, 0.0)],
                     3: [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]}


def test_empty_index_and_empty_batch(spark):
    both(spark, [], questions(3), 5)
    both(spark, corpus(20), [], 5)


def test_saved_index_answers_alike(spark, tmp_path):
    d, q = cut_lineage(table(spark, corpus(300), "doc_id")), table(spark, questions(8), "query_id")
    index = R.ImpactIndex.build(d)
    index.save(str(tmp_path))
    again = R.ImpactIndex.load(spark, str(tmp_path))
    assert R.ImpactIndex.saved(spark, str(tmp_path))
    assert len(again.top_k(q, 5, plain=0).collect()) == 8 * 5
    assert sorted(map(tuple, index.top_k(q, 5).collect())) == sorted(map(tuple, again.top_k(q, 5).collect()))


@pytest.mark.parametrize("plain", [10**9, 0])
def test_a_task_sums_a_bounded_share_of_the_postings(spark, monkeypatch, plain):
    index = R.ImpactIndex.build(cut_lineage(table(spark, corpus(150), "doc_id")))
    asked = table(spark, questions(8), "query_id")
    want = sorted((r.query_id, r["rank"], r.doc_id) for r in index.top_k(asked, 3, plain=plain).collect())
    monkeypatch.setattr(R, "SUMMED", 100)
    sizes, dealt = [], R._dealt
    monkeypatch.setattr(R, "_dealt", lambda scored, *a: (sizes.append(a[0]), dealt(scored, *a))[1])
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in index.top_k(asked, 3, plain=plain).collect()) == want
    assert sizes and set(sizes) == {index.full_product(asked)} and sizes[0] > 1000
    scored = table(spark, questions(8), "query_id").select("query_id", F.length("term").alias("doc"), "weight")
    sums = dealt(scored, 1000, "query_id", "doc").agg(F.sum("weight").alias("score"))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan[plan.index("Exchange hashpartitioning"):]
    assert "hashpartitioning(query_id" in plan and ", 10), REPARTITION_BY_NUM" in plan
