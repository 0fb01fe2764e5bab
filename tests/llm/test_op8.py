import random
import re

import duckdb
import numpy as np

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from tools.oracle_check import rows_of
from veracorp.llm import hashing as H
from veracorp.llm import minhash as M


def shingles(text, width=4):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width=4, t=80):
    sets = {i: shingles(x, width) for i, x in rows}
    comp = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and sets[i]
             and 100 * len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(comp[i], comp[j])
            if comp[i] != low or comp[j] != low:
                comp[i] = comp[j] = low
                changed = True
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def cluster(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(80)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


def test_groups_chains_and_edge_cases_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = cluster(rng, words, 60, 5) + cluster(rng, words, 5, 3) + [None, "", "  ", "one two", "One  TWO", "É é", "x " * 30000]
    shared = " ".join(rng.choice(words) for _ in range(30))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(40)) for _ in range(30)]
    texts += [texts[0]] * 4
    chain = [rng.choice(words) for _ in range(60)]
    for k in range(6):  # each link is near the next, the ends are not near each other
        chain = chain[3:] + [rng.choice(words) for _ in range(3)]
        texts.append(" ".join(chain))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in M.op8_minhash(spark, write_docs(spark, tmp_path, rows)).collect()}
    assert got == brute(rows)


def test_stage_handles_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = docs_df(spark, [(4, text), (4, text), (2, text + " end"), (None, text), (7, None), (7, None)]).selectExpr("*", "1 AS n", "2 AS bands")
    got = M.stage_near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [(False, 2), (False, 7), (False, 7), (True, 0)]


def test_empty_table(spark, tmp_path):
    assert M.op8_minhash(spark, write_docs(spark, tmp_path, [])).count() == 0


def test_estimate_follows_similarity(spark):
    rng = np.random.default_rng(1)
    pool = H.mix(rng.integers(0, 2**63, 3000).astype(np.uint64))
    rows = []
    for i, j in enumerate((0.3, 0.6, 0.8, 0.9)):
        common = int(1000 * 2 * j / (1 + j))
        a, b = pool[:1000], np.concatenate([pool[:common], pool[1000:2000 - common]])
        _, _, p = M._signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
        rows.append((j, p[:, 0].view(np.int64).tolist(), p[:, 1].view(np.int64).tolist()))
    df = spark.createDataFrame(rows, "j double, pa array<long>, pb array<long>")
    for r in df.select("j", M.estimate("pa", "pb").alias("e")).collect():
        assert abs(r.j - r.e) < 0.15


def test_oracle(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    assert rows_of(M.op8_minhash(spark, SF_SMALL).toPandas()) == rows_of(c.execute(M.SQL["op8_minhash"]).df())
