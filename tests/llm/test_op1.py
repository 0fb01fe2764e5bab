import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs_df
from veracorp.llm import toxicity as T

CLEAN = [f"word{i}" for i in range(300)]
BAD = ["moron", "scumbag", "loweiru", "loweipa", "loweitz"]


def corpus(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        lines = [" ".join(rng.choices(CLEAN, k=8)) + "." for _ in range(rng.randrange(2, 10))]
        if toxic:
            k = rng.randrange(len(lines))
            w = lines[k].split()
            w.insert(3, rng.choice(BAD).capitalize() + ",")
            lines[k] = " ".join(w)
        rows.append((i, "\n".join(lines), toxic))
    return rows


def write(spark, path, rows, labels):
    docs_df(spark, [(i, t) for i, t, *_ in rows]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_held_out_accuracy_and_located_sentences(spark, tmp_path):
    rows = corpus(600)
    sf = write(spark, tmp_path, rows, [(i, 1, y) for i, _, y in rows])
    got = {r.doc_id: r for r in T.op1_toxicity(spark, sf).collect()}
    assert len(got) == 600
    for i, text, y in rows:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
        if y and r.predicted:
            assert any(b in text[s.start:s.end].lower() for s in r.offending for b in BAD)
    held = [(i, y) for i, _, y in rows if got[i].held_out]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)


def test_edge_cases(spark, tmp_path):
    rows = corpus(300)
    extra = [(1000, None, 0), (1001, "", 0), (1002, " \n ", 0), (1003, "moron " * 50000, 1), (1003, "moron " * 50000, 1), (None, "word1", 0)]
    sf = write(spark, tmp_path, rows + extra, [(i, None, y) for i, _, y in rows] + [(None, 1, 1), (1000, 1, None), (5, 1, 0)])
    got = T.op1_toxicity(spark, sf).collect()
    assert len(got) == 306
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == by[1002].score == 0
    assert by[1003].predicted == 1 and by[None].held_out is False


def test_without_labels_and_empty(spark, tmp_path):
    sf = write(spark, tmp_path / "a", [(1, "x", 0)], [])
    assert [r.score for r in T.op1_toxicity(spark, sf).collect()] == [0]
    assert T.op1_toxicity(spark, write(spark, tmp_path / "b", [], [])).count() == 0


def test_stage_keeps_clean_rows_and_columns(spark, tmp_path):
    rows = corpus(400)
    sf = write(spark, tmp_path, rows, [(i, 1, y) for i, _, y in rows])
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("mine")).withColumn("row", F.lit(1))
    got = T.stage_toxicity(spark, docs, sf)
    assert got.columns == docs.columns
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    assert sum(i in kept for i, _, y in rows if not y) >= 0.99 * sum(1 - y for *_, y in rows)
    assert sum(i in kept for i, _, y in rows if y) <= 0.03 * sum(y for *_, y in rows)


def test_rare_toxic_words_enter_beside_a_frequent_one():
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(1200):
        toxic = i % 2
        words = rng.choices(CLEAN, k=20)
        if toxic and i % 4 == 1:
            words.insert(5, "moron")          # half of the toxic rows
        elif toxic and i % 80 == 3:
            words.insert(5, "loweiru")        # 15 toxic rows and no clean one
        texts.append((" ".join(words) + ".").encode())
        labels.append(toxic)
    model = T.fit(texts, np.array(labels))
    for word, bad in (("moron", True), ("loweiru", True), ("word7", False)):
        bag = T.bags([f"word1 {word} word2.".encode()])
        assert (model.sentences(bag)[0] >= model.bias + 1) == bad, word


def test_scores_against_a_plain_rescoring_sentence_by_sentence(spark):
    """Noisy-or over sentence probabilities, feature by feature in Python, and a located sentence for every predicted text."""
    rows = corpus(300)
    model = T.fit([t.encode() for _, t, _ in rows], np.array([y for *_, y in rows]))
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    texts = [t for _, t, _ in corpus(60, seed=9)] + ["", "moron", "Word1 moron. scumbag! word2"]
    got = {r.row.doc_id: r for r in T.score(docs_df(spark, list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        bag = T.bags([text.encode()])
        keep, located = 1.0, []
        for s in range(len(bag.start)):
            z = model.bias + sum(weight.get(f, 0.0) for f, own in zip(bag.feature.tolist(), bag.sentence.tolist()) if own == s)
            p = 1 / (1 + np.exp(-z))
            keep *= 1 - p
            located.append(p)
        assert abs(got[i].score - (1 - keep)) < 1e-9
        if got[i].score >= 0.5:
            assert got[i].offending and abs(max(s.score for s in got[i].offending) - max(located)) < 1e-9
        assert sum(p >= 0.5 for p in located) <= len(got[i].offending) <= max(1, sum(p >= 0.5 for p in located))


def test_texts_of_weak_sentences_alone_report_the_strongest():
    logits, first = np.array([-0.5, -0.2, -0.9, 3.0, -5.0]), np.array([0, 3, 5, 5])
    score = T.noisy_or(logits, first)
    assert score[0] > 0.5 and T._located(logits, score, first).tolist() == [False, True, False, True, False]
