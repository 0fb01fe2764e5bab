"""Round 3: work that was done more than once, and fits that waited for one another."""

import random
import threading

from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions import text as T
from veracorp.operators import experiments as EX
from veracorp.operators import features as FE
from veracorp.operators import keywords as KW
from veracorp.operators import linear as LN
from veracorp.operators import metrics as ME


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fits_run_side_by_side_in_order(spark):
    met = threading.Barrier(LN.FITS_AT_ONCE, timeout=60)      # passes only when that many runs are under way

    def run(i):
        met.wait()
        return i, spark.range(i).count()

    assert LN.side_by_side(spark, run, range(LN.FITS_AT_ONCE)) == [(i, i) for i in range(LN.FITS_AT_ONCE)]


def test_class_report_is_one_aggregate(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b"), (None, "a"), ("a", None)]
    rep = ME.per_class_report(spark.createDataFrame(rows, "truth string, pred string"))
    assert "Join" not in _plan(rep)
    got = {r["label"]: (round(r["precision"], 6), round(r["recall"], 6), r["support"]) for r in rep.collect()}
    assert got == {"a": (0.5, 0.333333, 3), "b": (0.333333, 1.0, 1), "c": (0.0, 0.0, 1), None: (0.0, 0.0, 0)}


def test_configurations_share_their_tokens(spark):
    docs = spark.createDataFrame([(1, "a", "The cats can't sit, said the cats."), (2, "b", ""), (3, "b", None)],
                                 "doc_id long, label string, cleaned_text string")
    tokens = EX.config_tokens(docs)
    for cfg in L.ABLATION_GRID:
        shared = EX.apply_config(docs, cfg, tokens=tokens)
        assert "regexp_replace" not in _plan(shared)
        assert sorted(shared.collect()) == sorted(EX.apply_config(docs, cfg).collect())
    got = {r["doc_id"]: r["doc_text"] for r in EX.apply_config(docs, L.ABLATION_GRID[0]).collect()}
    assert got[2] == got[3] == "" and "cats" in got[1].split()


def test_training_weights_tokenise_once(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} common text") for i in range(12)], "doc_id long, cleaned_text string")
    w, idf = FE.tfidf(docs.repartition("doc_id"), "cleaned_text", "sublinear", 5, n_docs=12, materialize=True)
    plain, _ = FE.tfidf(docs, "cleaned_text", "sublinear", 5, n_docs=12)
    assert "regexp_extract_all" not in _plan(w) and "regexp_extract_all" not in _plan(idf)

    def rows(df):
        return sorted((r["doc_id"], r["term"], round(r["weight"], 9)) for r in df.collect())

    assert rows(w) == rows(plain)


def test_keywords_search_each_text_once(spark):
    docs = spark.createDataFrame([(1, "The ASTRONOMICALLY large, çaé 😀 cat"), (2, "astronomical"), (3, None), (4, "")], "doc_id long, text string")
    words = ["astronomically", "Astronomical", "a", "ÇAÉ", "😀 c", "astronomicalx", "", None, "zz", "large, çaé 😀 cat"]
    m = KW.keyword_matches(docs, spark.createDataFrame([(w,) for w in words], "keyword string"))
    assert _plan(m).lower().count("contains(") == 1
    got = {r["doc_id"]: r["keywords"] for r in m.collect()}
    assert got == {1: sorted(["astronomically", "astronomical", "a", "çaé", "😀 c", "large, çaé 😀 cat"]), 2: ["a", "astronomical"]}


def test_keywords_without_hashes_in_tasks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} abcdefghijklmnop{i}") for i in range(30)], "doc_id long, text string")
    words = spark.createDataFrame([(f"mnop{i}",) for i in range(20)] + [("t",), ("abcdefghijklmnop2",)], "keyword string")

    def rows():
        return sorted((r["doc_id"], tuple(r["keywords"])) for r in KW.keyword_matches(docs, words).select("doc_id", F.col("keywords")).collect())

    few = rows()
    monkeypatch.setattr(KW, "IN_TASK", 3)
    assert rows() == few and few[2] == (2, ("abcdefghijklmnop2", "mnop2", "t"))


def test_tokens_by_fewer_passes_are_those_of_every_rule(spark):
    rng = random.Random(3)
    bits = ["cannot", "Gimme", "gonna", "GOTTA", "lemme", "d'ye", "more'n", "wanna", "'tis", "'Twas", "don't", "we'll", "he's", "'", "''", '"', "``",
            "...", ".", "?", "!", "--", "-", ":", ",", ";", "@", "(", "]", "<", "9", "a", "É", "é.", " ", "  ", "\n", "\t", "word", "not", "me", "na"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    for rules, fast in ((T.TREEBANK_RULES, T.treebank_sentence_tokens), (T.treebank_rules_for_texts(), T.treebank_tokens)):
        assert len(T._fewer_passes(rules)) < len(rules)
        c = F.concat(F.lit(" "), F.col("t"), F.lit(" "))
        for pat, rep in rules:
            c = F.regexp_replace(c, pat, rep)
        plain = F.filter(F.split(F.trim(c), T.P.WS_RUN), lambda x: x != "")
        got = df.select("t", plain.alias("a"), fast(F.col("t")).alias("b"))
        assert got.where(~F.col("a").eqNullSafe(F.col("b"))).take(3) == []
        assert got.where(F.col("b").isNull()).count() == 1


def test_runs_split_a_staged_table(spark, monkeypatch):
    class Seen(Exception):
        pass

    def split(df, **_):
        assert "Aggregate" not in _plan(df) and "Join" not in _plan(df)
        raise Seen

    docs = spark.createDataFrame([(1, "a", "some words"), (2, "b", "other words")], "doc_id long, label string, cleaned_text string")
    monkeypatch.setattr(EX.C, "stratified_split", split)
    try:
        EX.run_config(docs, L.ABLATION_GRID[0], ["s"])
    except Seen:
        return
    raise AssertionError("the split was not reached")
