"""Round 4: fits over few numbers, folders that go when a run has ended, classifiers over the whole corpus."""

from pyspark.ml.linalg import Vectors

from veracorp import session as S
from veracorp.functions import lexicon as L
from veracorp.operators import experiments as EX
from veracorp.operators import linear as LN
from veracorp.operators.lake import path_exists
from veracorp.operators.ngram import NGramModel
from veracorp.plans import queries_more as QM
from veracorp.plans import stages as ST
from veracorp.session import cut_lineage


def test_fits_of_all_regularizations_stand_in_one_queue_over_packed_rows(spark, monkeypatch):
    """Few numbers make one partition whatever the table's partitions, and the models are those of single fits."""
    rows = [(i, "ab"[i % 2], Vectors.dense([float(i % 7), float(i % 2 == (i % 5 == 0))])) for i in range(60)]
    train = cut_lineage(spark.createDataFrame(rows, ["doc_id", "label", "features"]).repartition(12))
    queues, parts = [], []
    monkeypatch.setattr(LN, "side_by_side", lambda spark, run, items, *a, f=LN.side_by_side: (queues.append(len(items)), f(spark, run, items, *a))[1])
    monkeypatch.setattr(LN, "balanced_binary_weight", lambda df, y, f=LN.balanced_binary_weight: (parts.append(df.rdd.getNumPartitions()), f(df, y))[1])
    models = LN.fit_ovr_each(train, ["a", "b"], ("l1", "l2", "elasticnet"))
    assert queues == [6] and parts == [1] * 6
    alone = LN.fit_ovr(train, ["a", "b"], "l1")
    assert all(abs(x - y) < 1e-6 for c in "ab" for x, y in zip(models["l1"][c].coefficients, alone[c].coefficients))
    assert LN.packed(train, 3 * LN.PART_NONZEROS + 1).rdd.getNumPartitions() == 4 and LN.packed(train, 10**9).rdd.getNumPartitions() == 12


def corpus(spark, root, n):
    """``n`` documents and labels as the driver's tables have them."""
    words = ["alpha", "beta", "gamma", "delta", "the", "not"]
    docs = [(i, f"{words[i % 6]} {words[i % 5]} text {i}", f"s{i % 3}") for i in range(n)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(n)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stopword_classifiers_see_the_whole_corpus(spark, tmp_path, monkeypatch):
    seen = []

    def run(docs, cfg, sources, variant, prepared):
        seen.append((cfg["name"], docs.count(), prepared.count()))
        return {"weighted_f1": 0.5}

    monkeypatch.setattr(EX, "run_config", run)
    assert QM.q_t19(spark, corpus(spark, tmp_path, 1300)).count() == 2
    assert sorted(seen) == [("custom", 1300, 1300), ("default", 1300, 1300)]


def test_a_run_stages_parquet_that_goes_when_it_ends(spark, monkeypatch):
    roots, tables = [], []
    monkeypatch.setattr(EX, "shared_dir", lambda *a, f=EX.shared_dir: (roots.append(f(*a)), roots[-1])[1])
    monkeypatch.setattr(EX, "staged", lambda df, root=None, f=EX.staged: (tables.append(root), f(df, root))[1])
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"word{i % 2} common{i % 3} text") for i in range(30)], "doc_id long, label string, cleaned_text string")
    run = EX.run_config(docs, L.ABLATION_GRID[0], ["s"])
    assert run["params"]["train_size"] == "24" and len(roots) == 1 and not path_exists(spark, roots[0])
    assert tables.count(roots[0]) == 3 and f"{roots[0]}/prepared" in tables


def test_threads_leave_the_sessions_setting_as_it_was(spark):
    before = spark.conf.get(S._CLEANUP, None)
    LN.side_by_side(spark, lambda i: S.staged(spark.range(i).repartition(2)).count(), range(1, 7))
    assert spark.conf.get(S._CLEANUP, None) == before


def test_stages_keep_only_their_tables(spark, tmp_path):
    sf, root = corpus(spark, tmp_path / "sf", 90), str(tmp_path / "stages")
    report = {r["stage"]: r["status"] for r in ST.run_stages(spark, sf, root, skip=("models",)).collect()}
    assert report["ngram"] == "built" and not path_exists(spark, f"{root}/scratch")
    docs = spark.createDataFrame([(1, "a", "x y x y"), (2, "b", "y")], "doc_id long, label string, text string")
    model = NGramModel(docs, 2, root=str(tmp_path / "lm"))
    stored = spark.read.parquet(str(tmp_path / "lm" / "*"))
    assert sorted(stored.columns) == ["c", "label", "ngram"] and stored.count() == model.ngram_counts.count()
    assert {(r["ngram"], r["ctx"], r["tok"]) for r in model.ngram_counts.where("label = 'b'").collect()} == {("<START> y", "<START>", "y"), ("y <END>", "y", "<END>")}
