"""Saved language models: the rows of the fitted model, and plans that leave the model where it lies."""

import math
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp.operators import ngram as NG
from veracorp.plans.base import combined
from veracorp.session import cut_lineage, shared_dir


def split(spark):
    docs = cut_lineage(combined(spark, SF_SMALL).select("doc_id", "label", "text"))
    return docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")


def rows(df):
    return sorted((r.doc_id, r.label, round(math.log(r.perplexity), 9)) for r in df.collect())


def test_saved_model_scores_like_the_fitted_one(spark):
    train, test = split(spark)
    fitted = NG.NGramModel(train, 3)
    root = shared_dir(spark, "lm-test")
    fitted.save(root)
    saved = NG.SavedNGramModel(spark, root)
    assert saved.n == 3 and saved.classes() == fitted.classes()
    for method in ("laplace", "kneser-ney", "interpolated_kn"):
        assert rows(saved.perplexity(test, method)) == rows(fitted.perplexity(test, method))


def test_saved_model_is_never_shuffled(spark):
    train, test = split(spark)
    root = shared_dir(spark, "lm-plan")
    NG.NGramModel(train, 2).save(root)
    saved = NG.SavedNGramModel(spark, root)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for a model of any size
    try:
        for measured in (True, False):      # a small batch, and one beyond the bound
            bound = NG.BROADCAST_BYTES
            NG.BROADCAST_BYTES = bound if measured else 0
            plan = saved.perplexity(test)._jdf.queryExecution().executedPlan().toString()
            NG.BROADCAST_BYTES = bound
            assert plan.count("Bucketed: true") == 3
            # walk the tree: between a model scan and its join there is no Exchange
            lines = plan.split("\n")
            depth = [len(re.match(r"[ :]*(?:[+:]- )?", x).group()) for x in lines]
            for i, line in enumerate(lines):
                if "Bucketed: true" not in line:
                    continue
                at, above = depth[i], []
                for j in range(i - 1, -1, -1):
                    if depth[j] < at:
                        at = depth[j]
                        above.append(lines[j])
                        if "SortMergeJoin" in lines[j] and "LeftOuter" in lines[j]:
                            break
                assert above and "LeftOuter" in above[-1] and not any("Exchange" in x for x in above), plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_model_reopens_under_another_name(spark):
    train, test = split(spark)
    root = shared_dir(spark, "lm-open")
    NG.NGramModel(train, 2).save(root)
    want = rows(NG.SavedNGramModel(spark, root).perplexity(test))
    for key in NG.SavedNGramModel.KEYS:                      # a later session knows the files alone
        spark.sql(f"DROP TABLE {NG._table_name(root, key)}")
    assert rows(NG.SavedNGramModel(spark, root).perplexity(test)) == want


def test_wide_tables_are_plain_sums(spark):
    train, _ = split(spark)
    m = NG.NGramModel(train, 2)
    plan = m.model_tables()["ngram"]._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    total = m.model_tables()["ngram"].agg(F.sum(F.aggregate("c", F.lit(0).cast("long"), lambda t, x: t + x))).first()[0]
    assert total == m.ngram_counts.agg(F.sum("c")).first()[0]


def test_corpus_perplexity_scores_each_ngram_once(spark, monkeypatch):
    train, test = split(spark)
    test = test.unionByName(test.withColumn("doc_id", F.col("doc_id") + 10**6))     # every n-gram in two documents at least
    model = NG.NGramModel(train, 2)
    s = model.scored_ngrams(test)
    lp = F.when(model.probability() > 0, F.log(model.probability())).otherwise(F.lit(math.log(NG.LM_PROB_FLOOR)))
    want = {r.label: r.p for r in s.groupBy("label").agg(F.exp(-F.sum(lp * F.col("m")) / F.sum("m")).alias("p")).collect()}
    scored = []
    by = NG.NGramModel.scored_ngrams
    monkeypatch.setattr(NG.NGramModel, "scored_ngrams", lambda *a, **k: (scored.append(by(*a, **k)), scored[-1])[1])
    got = {r.label: r.perplexity for r in model.perplexity(test, per_doc=False).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[c], want[c], rel_tol=1e-9) for c in want)
    assert scored[0].count() == s.select("ngram", "label").distinct().count() < s.count()
