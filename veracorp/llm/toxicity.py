"""Operator 1, toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function of its
words and of their first four, five and six bytes; a document's score is the noisy-or
of its sentences, 1 - prod(1 - p).  Only document labels are known: the sentence model
is fitted to them through the noisy-or, so that it finds out by itself which sentences
offend.  The fit uses a bounded sample (SAMPLE_ROWS rows of each label in hash order,
SAMPLE_BYTES bytes of text at most, equal texts once).  Features enter if they occur in
MIN_DOCS sample documents and, by MIN_EXCESS standard errors, more often under label 1:
what a sentence offends by is what it has, and rare words cannot be learnt by heart.
Whether a feature enters depends on no other feature.  The fitted model is small (at most
the sample's features) and scores every whole text inside map tasks; nothing is shuffled.

Labels, language, source and doc_id are never inputs of a score.  Training rows are
those whose crc32(doc_id as text) mod 5 is not 0.

Defined results: null and empty texts have no sentence and score 0; repeated rows are
scored each; null doc_id counts as not held out and is never trained on; without
labels of both kinds every text scores 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import bound_batches, documents, whole_text

SAMPLE_ROWS, SAMPLE_BYTES = 6_000, 20_000_000
MIN_DOCS, MIN_EXCESS = 3, 3.0
ROUNDS, RATE, DECAY = 120, 0.2, 1e-6
LONG_SENTENCE = 40        # words after which a sentence without end is cut
SMALLEST_WEIGHT = 0.02
PREFIXES = (4, 5, 6)
_MARKS = np.zeros(256, bool)
_MARKS[np.frombuffer(b".,;:!?\"'()[]{}*_-", np.uint8)] = True
_STOPS = np.zeros(256, bool)
_STOPS[np.frombuffer(b".!?", np.uint8)] = True


@dataclass
class Bags:
    """Sentences and features of several texts."""
    feature: np.ndarray    # hash of every feature occurrence
    sentence: np.ndarray   # its sentence, ascending
    first: np.ndarray      # first sentence of every text, and a closing entry
    start: np.ndarray      # first byte of every sentence in its text
    end: np.ndarray


def bags(texts: list[bytes]) -> Bags:
    _, starts, ends, first, begin = H.words_of(texts)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Bags(none.view(np.uint64), none, np.zeros(len(texts) + 1, np.int64), none, none)
    data = np.frombuffer(b" ".join(texts), np.uint8)
    lines = np.cumsum(data == 10)
    closes = _STOPS[data[ends - 1]].copy()
    closes[:-1] |= lines[starts[1:]] > lines[ends[:-1] - 1]
    closes[first[1:][first[1:] > first[:-1]] - 1] = True
    opens = np.concatenate([[True], closes[:-1]])
    place = np.arange(len(starts)) - np.maximum.accumulate(np.where(opens, np.arange(len(starts)), 0))
    opens |= place % LONG_SENTENCE == 0
    sentence = np.cumsum(opens) - 1
    head = np.flatnonzero(opens)
    tail = np.concatenate([head[1:], [len(starts)]]) - 1
    text = np.searchsorted(first, head, side="right") - 1
    a, b = starts.copy(), ends.copy()
    for _ in range(2):     # punctuation around a word is not part of it
        b = np.where((b - a > 1) & _MARKS[data[b - 1]], b - 1, b)
        a = np.where((b - a > 1) & _MARKS[data[a]], a + 1, a)
    sums = H.prefix(data, lower=True)
    kinds, owners = [H.spans(sums, a, b)], [sentence]
    for n in PREFIXES:
        long = np.flatnonzero(b - a > n)
        kinds.append(H.spans(sums, a[long], a[long] + n) ^ np.uint64(n))
        owners.append(sentence[long])
    feature, owner = np.concatenate(kinds), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return Bags(feature[order], owner[order], np.searchsorted(head, first), starts[head] - begin[text], ends[tail] - begin[text])


def _softplus(z):
    return np.logaddexp(0, z)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Model:
    features: np.ndarray   # ascending hashes
    weights: np.ndarray
    bias: float

    def sentences(self, bag: Bags) -> np.ndarray:
        """Logit of every sentence."""
        n = len(bag.start)
        if not len(self.features):
            return np.full(n, self.bias)
        at = np.minimum(np.searchsorted(self.features, bag.feature), len(self.features) - 1)
        hit = self.features[at] == bag.feature
        return self.bias + np.bincount(bag.sentence[hit], self.weights[at[hit]], minlength=n)


def noisy_or(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(_softplus(logits))])
    return 1 - np.exp(-(total[first[1:]] - total[first[:-1]]))


def _excess(bad: np.ndarray, good: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """By how many standard errors a feature is more frequent in documents of label 1."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    p = (bad + good) / (n1 + n0)
    return (bad / n1 - good / n0) / np.sqrt(np.maximum(p * (1 - p) * (1 / n1 + 1 / n0), 1e-12))


def fit(texts: list[bytes], labels: np.ndarray) -> Model:
    """Fit the sentence model to document labels through the noisy-or (full-batch Adam).

    The features of the sample are gone through slice by slice, once to count documents
    and once to keep the features that enter, so that memory follows the latter."""
    slices = list(H.chunks(texts))
    names, seen, bad = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    for lo, hi in slices:
        bag = bags(texts[lo:hi])
        doc = np.repeat(np.arange(hi - lo), np.diff(bag.first))
        f, column = np.unique(bag.feature, return_inverse=True)
        pairs = np.unique(column.astype(np.int64) * (hi - lo) + doc[bag.sentence])
        of, by = pairs // (hi - lo), lo + pairs % (hi - lo)
        at = np.searchsorted(names, f)
        new = np.append(names, np.uint64(0))[at] != f
        new[at == len(names)] = True
        names, seen, bad = (np.insert(x, at[new], y) for x, y in ((names, f[new]), (seen, 0), (bad, 0)))
        at = np.searchsorted(names, f)
        seen[at] += np.bincount(of, minlength=len(f)).astype(np.int32)
        bad[at] += np.bincount(of, labels[by], minlength=len(f)).astype(np.int32)
    excess = _excess(bad, seen - bad, labels)
    names = names[(seen >= MIN_DOCS) & (excess >= MIN_EXCESS)]
    del seen, bad, excess
    columns, sentences, docs, n = [], [], [], 0
    for lo, hi in slices:
        bag = bags(texts[lo:hi])
        at = np.searchsorted(names, bag.feature)
        hit = np.flatnonzero(names[np.minimum(at, len(names) - 1)] == bag.feature) if len(names) else at[:0]
        columns.append(at[hit].astype(np.int32))
        sentences.append((bag.sentence[hit] + n).astype(np.int32))
        docs.append(lo + np.repeat(np.arange(hi - lo), np.diff(bag.first)))
        n += len(bag.start)
    column, sentence, doc = np.concatenate(columns), np.concatenate(sentences), np.concatenate(docs)
    n, y = len(doc), labels.astype(float)
    theta = np.zeros(len(names) + 1)
    theta[-1] = np.log(max(y.mean(), 1e-3) / max(1.0, n / len(texts)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, ROUNDS + 1):
        z = theta[-1] + np.bincount(sentence, theta[column], minlength=n)
        total = np.bincount(doc, _softplus(z), minlength=len(texts))
        pull = np.where(y > 0, 1 / np.expm1(np.clip(total, 1e-9, 60)), -1.0)
        pull = np.minimum(pull, 1e3)
        g = _sigmoid(z) * pull[doc] / len(texts)
        grad = np.append(np.bincount(column, g[sentence], minlength=len(names)), g.sum()) - DECAY * np.append(theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-10)
    strong = np.abs(theta[:-1]) >= SMALLEST_WEIGHT
    return Model(names[strong], theta[:-1][strong], float(theta[-1]))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Bounded training sample: at most SAMPLE_ROWS rows per label, SAMPLE_BYTES of text in all."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).withColumn("rank", F.xxhash64("doc_id")))
    texts = docs.select(F.col("doc_id").alias("doc_id"), whole_text().alias("text"))
    picked = known.where("toxic = 1").orderBy("rank", "doc_id").limit(SAMPLE_ROWS).unionByName(
        known.where("toxic <> 1").orderBy("rank", "doc_id").limit(SAMPLE_ROWS))
    rows = texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])   # picked is at most 2 * SAMPLE_ROWS rows
    sizes = rows.select("doc_id", "rank", "toxic", F.octet_length("text").alias("size")).collect()
    taken, total = set(), 0
    for r in sorted(sizes, key=lambda r: (r["rank"], r["doc_id"])):
        if total + r["size"] <= SAMPLE_BYTES:
            total += r["size"]
            taken.add(r["doc_id"])
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(i,) for i in sorted(taken)], "doc_id long")
    got = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").collect()
    one = {r["text"]: int(r["toxic"] == 1) for r in sorted(got, key=lambda r: r["doc_id"])}   # equal texts once
    return [t.encode() for t in one], np.array(list(one.values()))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    texts, y = sample(docs, labels)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -60.0)
    return fit(texts, y)


def _located(logits: np.ndarray, score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which sentences are reported: those that score 0.5 or more, and of a text that reaches 0.5 by several weaker ones the strongest."""
    bad = logits >= 0
    for t in np.flatnonzero(score >= 0.5):
        a, b = first[t], first[t + 1]
        if b > a and not bad[a:b].any():
            bad[a + logits[a:b].argmax()] = True
    return bad


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for lo, hi in H.chunks(texts):
                bag = bags(texts[lo:hi])
                logits = model.sentences(bag)
                score = noisy_or(logits, bag.first)
                bad = _located(logits, score, bag.first)
                spans = [[(len(t[:bag.start[s]].decode()), len(t[:bag.end[s]].decode()), float(_sigmoid(logits[s])))
                          for s in np.flatnonzero(bad[a:b]) + a]
                         for t, a, b in zip(texts[lo:hi], bag.first[:-1], bag.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(score),
                     pa.array([[{"start": a, "end": b, "score": p} for a, b, p in x] for x in spans], _SPANS)],
                    names=["row", "score", "offending"])
    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Struct ``row`` (all columns of ``docs``), score, offending (spans in code points of the sentences that score 0.5 or more;
    of a text that reaches 0.5 by weaker ones, the strongest)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*docs.columns).alias("row"), whole_text().alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_score(shared), f"row {kind}, score double, offending array<struct<start:bigint,end:bigint,score:double>>")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keyed = docs.select("doc_id", "text")
    return score(keyed, model).select(
        "row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose score is 0.5 or more go."""
    model = train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).where("score < 0.5").select("row.*")


REGISTRY = {"op1_toxicity": op1_toxicity}
