"""Loaders, lake, streams, metrics and serving on inputs that the driver tables do not hold."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp.operators import corpus as C
from veracorp.operators import inference as INF
from veracorp.operators import lake as LK
from veracorp.operators import linear as LN
from veracorp.operators import metrics as ME
from veracorp.session import shared_dir, source_key
from veracorp.sources import feeds as FD
from veracorp.sources import files as FS
from veracorp.streaming import streams as ST


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_first_file_wins_whatever_the_sizes(spark, tmp_path):
    row = "1.json\t{}\t{}\ts\tp\tj\ts\tp\t0\t0\t0\t0\t0\tc\n"
    write(tmp_path / "liar/train.tsv", row.format("true", "dup text"))
    write(tmp_path / "liar/valid.tsv", row.format("false", "dup text") + "".join(row.format("false", f"filler {i}") for i in range(500)))
    write(tmp_path / "liar/test.tsv", row.format("false", "dup text"))
    df = C.combine(FS.load_liar(spark, FS.source_configs(str(tmp_path))["liar"]))
    assert [r.label for r in df.where("text = 'dup text'").collect()] == ["Real"]
    assert df.count() == 501


def test_files_with_different_headers_are_read_by_their_own(spark, tmp_path):
    write(tmp_path / "covid/ClaimFakeCOVID-19.csv", "id,title,content\n1,head one,body one\n")
    write(tmp_path / "covid/NewsRealCOVID-19_5.csv", "type,title,content\nnews,real headline,real body\n")
    got = {r.label: r.text for r in FS.load_covid(spark, FS.source_configs(str(tmp_path))["covid"]).collect()}
    assert got == {"Fake": "head one body one", "Real": "real headline real body"}


def test_too_few_rows_fail(spark):
    with pytest.raises(ValueError, match="fewer than"):
        C.require_min_rows(spark.range(3), 4)


def test_lake_reads_json_versions_back_and_digests_tell_null_columns_apart(spark, tmp_path):
    lk = LK.Lake(spark, str(tmp_path))
    lk.upload_raw(spark.createDataFrame([(1, "a")], "id int, t string"), "src")
    data, rec = lk.download("raw/src/metadata")
    assert rec["format"] == "json" and "payload" in data.columns and data.count() == 1
    pair = [spark.createDataFrame([r], "a string, b string") for r in ((None, "x"), ("x", None))]
    one, two = [LK.table_digest(d).first()["digest"] for d in pair]
    assert one != two


def test_atom_entries_attributes_and_cdata(spark, tmp_path):
    write(tmp_path / "f.txt", '<item rdf:about="u"><title><![CDATA[cd title]]></title><link>l1</link><feed>a</feed><ord>1</ord></item>\n'
          '<entry><title type="text">atom</title><summary>sum</summary><link rel="x" href="l2"/><updated>2020-01-02</updated><feed>a</feed><ord>2</ord></entry>\n')
    got = {r.ord: (r.title, r.description, r.link, r.pubDate) for r in FD.read_items(spark, str(tmp_path / "f.txt")).collect()}
    assert got == {1: ("cd title", None, "l1", None), 2: ("atom", "sum", "l2", "2020-01-02")}


def test_late_feed_items_are_kept_and_copies_dropped_across_runs(spark, tmp_path):
    item = "<item><title>{}</title><pubDate>{}</pubDate><feed>a</feed><ord>{}</ord></item>\n"
    landed, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write(tmp_path / "in/1.txt", item.format("new", "2026-01-01", 1) + item.format("same", "2026-01-01", 2))
    ST.feed_dedup_stream(spark, landed, out, ck)
    write(tmp_path / "in/2.txt", item.format("old text", "2014-01-01", 3) + item.format("same", "2026-01-02", 4))
    ST.feed_dedup_stream(spark, landed, out, ck)
    assert sorted((r.text, r.ord) for r in spark.read.parquet(out).collect()) == [("new", 1), ("old text", 3), ("same", 2)]


def test_report_averages_and_roc_points(spark):
    preds = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "truth string, pred string")
    rep = {r.label: r for r in ME.with_averages(ME.per_class_report(preds)).collect()}
    assert rep["macro avg"].recall == pytest.approx(0.75) and rep["weighted avg"].precision == pytest.approx((1 + 2 / 3) / 2)
    rows = [(i, "a" if i % 3 else "b", "a", [1.0, 1.0, 0.5, 0.25, 0.0][i % 5]) for i in range(60)]
    scores = spark.createDataFrame(rows, "doc_id int, truth string, label string, prob double")
    got = {r.threshold: (r.fpr, r.tpr) for r in ME.roc_points(scores, buckets=3).collect()}
    for t, (fpr, tpr) in got.items():
        neg, pos = [r for r in rows if r[1] != "a"], [r for r in rows if r[1] == "a"]
        assert fpr == pytest.approx(sum(r[3] >= t for r in neg) / len(neg)) and tpr == pytest.approx(sum(r[3] >= t for r in pos) / len(pos))


def test_scaling_is_by_the_unweighted_population_std(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense(x),) for x in ([1.0, 0.0], [2.0, 0.0], [6.0, 0.0])], ["features"])
    sd = LN.population_std(df)
    assert sd[0] == pytest.approx(math.sqrt(((1 - 3) ** 2 + (2 - 3) ** 2 + (6 - 3) ** 2) / 3)) and sd[1] == 0


def test_saved_bundle_classifies_like_the_fitted_models_and_gates_requests(spark):
    from veracorp.plans.queries_ml import lr_context
    ctx = lr_context(spark, SF_SMALL, 300)
    models = LN.fit_ovr(ctx["train"], ctx["classes"], "l2")
    root = shared_dir(spark, "bundle-test")
    INF.Classifier.fitted(ctx, models).save(root)
    clf = INF.Classifier.load(spark, root)
    req = ctx["test_rows"].select(F.col("doc_id").alias("request_id"), "text").where("length(text) BETWEEN 10 AND 10000")
    short = spark.createDataFrame([(-1, "short"), (-2, None)], "request_id long, text string")
    got = {r.request_id: r for r in clf.classify(req.unionByName(short)).collect()}
    assert -1 not in got and -2 not in got
    want = {(r.doc_id, r.label): r.prob for r in LN.ovr_probabilities(models, ctx["test"]).collect()}
    for i, r in got.items():
        for label, p in r.class_probabilities.items():
            assert p == pytest.approx(want[i, label], abs=1e-9)


def test_stage_tables_follow_the_data(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.range(3).write.parquet(f"{tmp_path}/{t}.parquet")
    before = source_key(spark, str(tmp_path))
    assert source_key(spark, str(tmp_path)) == before
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert source_key(spark, str(tmp_path)) != before
