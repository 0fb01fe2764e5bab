"""Registered word-vector queries.

Trained vectors depend on the solver and on randomness, so those queries are
rows-only; the vector arithmetic (neighbours, pair similarity, centroids) is
also registered on the driver's ``embeddings`` table with SQL oracles.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from veracorp.functions import text as T
from veracorp.operators import corpus as C
from veracorp.operators import embeddings as EM
from veracorp.operators.neighbours import IvfIndex
from veracorp.operators import features as FE
from veracorp.operators import linear as LN
from veracorp.operators import metrics as ME
from veracorp.operators.lake import path_exists
from veracorp.plans.base import processed, round6
from veracorp.session import cut_lineage, shared_dir, source_key
from veracorp.sources.tables import table

REGISTRY = {}
DIM = 200


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _L(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def _stage(spark, sf, name, make):
    """``make()`` as a reusable stage table."""
    path = shared_dir(spark, "w2v-" + source_key(spark, sf), unique=False) + "/" + name
    if not path_exists(spark, path + "/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def w2v_tokens(spark, sf):
    """tokens_no_stopwords: domain stopwords removed from Treebank tokens of the cleaned text."""
    def tokens():
        return processed(spark, sf).select("doc_id", "label", T.kept_tokens(T.treebank_tokens(F.col("cleaned_text")), True).alias("tokens"))
    return _stage(spark, sf, "tokens", tokens)


def skipgram_vectors(spark, sf):
    """Skip-gram vectors of the corpus, dealt by word."""
    return _stage(spark, sf, "skipgram", lambda: EM.train_skipgram(w2v_tokens(spark, sf), dim=DIM))


def _summary(v):
    return v.select("word", _L(F.size("vector")).alias("dim"), round6(EM.norm(F.col("vector"))).alias("norm"))


@query("F8_skipgram_vectors")
def q_f8(spark, sf):
    return _summary(skipgram_vectors(spark, sf))


@query("F10_nearest_words")
def q_f10(spark, sf):
    v = skipgram_vectors(spark, sf)
    freq = (w2v_tokens(spark, sf).select(F.explode("tokens").alias("word")).groupBy("word").count()
            .join(v.select("word"), "word").orderBy(F.desc("count"), "word").limit(4))      # 4 probe words
    probes = freq.join(v, "word").select(F.col("word").alias("probe"), F.col("vector").alias("pvec"))
    return EM.nearest(v, probes, 5).select("probe", _L("rank").alias("rank"), "word",
                                           round6("similarity").alias("similarity"))


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))


@query("F10_centroid_neighbours")
def q_f10c(spark, sf):
    e = _emb(spark, sf)
    cents = EM.mean_vectors(e, "label").select(F.col("label").alias("probe"), F.col("vector").alias("pvec"))
    n = EM.nearest(e, cents, 5, key="vec_id")
    return n.select(_L(F.col("probe").cast("int")).alias("label"), _L("rank").alias("rank"), "vec_id",
                    round6("similarity").alias("similarity"))


@query("F10_vector_neighbours")
def q_f10v(spark, sf):
    """Five nearest vectors of every vector whose id is divisible by 20, through the inverted file."""
    e = _emb(spark, sf)
    probes = e.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("probe"), F.col("vector").alias("pvec"))
    n = IvfIndex.build(e, "vec_id").search(probes, 5, exact=True)
    return n.select(F.col("probe").alias("vec_id"), _L("rank").alias("rank"), F.col("key").alias("neighbour"),
                    round6("similarity").alias("similarity"))


@query("F11_pair_similarity")
def q_f11(spark, sf):
    e = _emb(spark, sf)
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"), F.col("vector").alias("v2"))
    return e.join(nxt, "vec_id").select("vec_id", "next_id", round6(EM.cosine(F.col("vector"), F.col("v2")))
                                        .alias("similarity"))


@query("F12_label_centroids")
def q_f12c(spark, sf):
    m = EM.mean_vectors(_emb(spark, sf), "label")
    return m.select(_L("label").alias("label"), F.posexplode("vector").alias("pos", "value")).select(
        "label", _L("pos").alias("pos"), round6("value").alias("value"))


@query("F12_document_vectors")
def q_f12(spark, sf):
    d = EM.document_vectors(w2v_tokens(spark, sf), skipgram_vectors(spark, sf), DIM)
    return d.select("doc_id", _L(F.size("vector")).alias("dim"), round6(EM.norm(F.col("vector"))).alias("norm"))


def _families(spark, sf):
    """One split; TF-IDF (4,000 terms), document vectors, and both concatenated."""
    toks = w2v_tokens(spark, sf)
    s = cut_lineage(C.stratified_split(processed(spark, sf), test_size=0.2))
    tr, te = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    w_tr, idf = FE.tfidf(tr.repartition("doc_id"), "cleaned_text", "smooth", 4000, n_docs=tr.count(), materialize=True)
    idf = cut_lineage(idf)
    w_te, _ = FE.tfidf(te.repartition("doc_id"), "cleaned_text", "smooth", vocab=idf)
    index = cut_lineage(LN.vocabulary_index(idf))
    size = max(index.count(), 1)
    dv = EM.document_vectors(toks, skipgram_vectors(spark, sf), DIM).select(
        "doc_id", array_to_vector("vector").alias("w2v"))
    out = {}
    for name, w, docs in (("train", w_tr, tr), ("test", w_te, te)):
        v = LN.to_vectors(w, index, docs, size).withColumnRenamed("features", "tfidf").join(dv, "doc_id")
        v = VectorAssembler(inputCols=["tfidf", "w2v"], outputCol="concat").transform(v)
        out[name] = cut_lineage(v)
    return out


@query("F13_concatenated_features")
def q_f13(spark, sf):
    """Widths of each part, and the TF-IDF entries as they stand at the front of the concatenation."""
    f = _families(spark, sf)
    both = f["train"].unionByName(f["test"])
    sizes = both.select("doc_id", F.size(vector_to_array("tfidf")).alias("n"), F.size(vector_to_array("w2v")).alias("m"), vector_to_array("concat").alias("c"))
    front = F.slice("c", 1, F.col("n"))
    return sizes.select("doc_id", _L("n").alias("tfidf_dim"), _L("m").alias("w2v_dim"), _L(F.size("c")).alias("concat_dim"),
                        _L(F.size(F.filter(front, lambda x: x != 0))).alias("tfidf_entries"),
                        round6(F.aggregate(front, F.lit(0.0), lambda t, x: t + x)).alias("tfidf_total"))


@query("F14_feature_family_comparison")
def q_f14(spark, sf):
    f = _families(spark, sf)

    def run(family):
        fam, col = family
        tr = f["train"].select("doc_id", "label", F.col(col).alias("features"))
        te = f["test"].select("doc_id", "label", F.col(col).alias("features"))
        idx, model = LN.fit_multinomial(tr)
        p = LN.multinomial_predict(idx, model, te).join(te.select("doc_id", F.col("label").alias("truth")), "doc_id")
        return fam, float(ME.summary_metrics(p).first()["f1_score"])

    rows = LN.side_by_side(spark, run, (("tfidf_only", "tfidf"), ("word2vec_only", "w2v"), ("concatenated", "concat")))
    return spark.createDataFrame(rows, "feature_family string, weighted_f1 double").select(
        "feature_family", round6("weighted_f1").alias("weighted_f1"))


@query("F16_embedding_map")
def q_f16(spark, sf):
    """2-D PCA map of the 100 most frequent vocabulary words (a bounded 100 x dim table)."""
    v = skipgram_vectors(spark, sf)
    top = (w2v_tokens(spark, sf).select(F.explode("tokens").alias("word")).groupBy("word").count()
           .join(v, "word").orderBy(F.desc("count"), "word").limit(100))
    x = cut_lineage(top.select("word", array_to_vector("vector").alias("v")))
    pca = PCA(k=2, inputCol="v", outputCol="xy").fit(x)
    a = vector_to_array("xy")
    return pca.transform(x).select("word", round6(a[0]).alias("x"), round6(a[1]).alias("y"))
