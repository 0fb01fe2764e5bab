import hashlib
import random
from dataclasses import replace

import numpy as np
import pandas as pd

from tests.conftest import SF_SMALL
from tests.llm.helpers import write_docs
from veracorp.llm import suffix_dedup as S


def brute(rows):
    texts = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(texts):
        for k in range(len(texts[i]) - 99):
            first.setdefault(texts[i][k:k + 100], (i, k))
    out = {}
    for i, t in texts.items():
        gone = bytearray(len(t))
        for k in range(len(t) - 99):
            if first[t[k:k + 100]] < (i, k):
                gone[k:k + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, n=80):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choices("abc dé", k=k))
    passages = [make(rng.randrange(90, 260)) for _ in range(6)]
    texts = ["".join(rng.choice(passages) if rng.random() < 0.4 else make(rng.randrange(150)) for _ in range(rng.randrange(1, 5)))
             for _ in range(n)]
    texts += [texts[0], texts[1], "", None, "x" * 99, "x" * 100, "x" * 101, "ab" * 200, "ba" * 300, "a" * 3000, "abc" * 60 + make(30) + "abc" * 60,
              "long " + make(20000)]
    ids = list(range(10, 10 + len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def run(spark, path, rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
            for r in S.op4_suffix_dedup(spark, write_docs(spark, path, rows)).collect()}


def test_against_brute_force(spark, tmp_path):
    rows = corpus(1)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_hot_anchors_take_the_exact_way_round(spark, tmp_path, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(S, "SPEC", replace(S.SPEC, hot_tokens=150))
    assert run(spark, tmp_path, rows) == brute(rows)


def test_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.op4_suffix_dedup(spark, SF_SMALL).collect()}
    assert got == brute(rows)


def test_empty_null_and_repeated_ids(spark, tmp_path):
    assert S.op4_suffix_dedup(spark, write_docs(spark, tmp_path / "a", [])).count() == 0
    text = "".join(random.Random(1).choices("abcdef", k=150))
    got = S.op4_suffix_dedup(spark, write_docs(spark, tmp_path / "b", [(1, text), (1, text), (None, text), (None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in got) == [("1", 150, 0), ("1", 150, 0), ("None", 0, 0), ("None", 150, 150)]


def test_suffix_array_against_sorting():
    rng = random.Random(6)
    cases = [[], [1], [1, 1, 1, 1], [2, 1, 2, 1, 2, 1], list(b"mississippi"), list(b"abcabcabcab"), [3, 2, 1], [1, 2, 3]]
    cases += [[rng.randrange(a) for _ in range(rng.randrange(1, 60))] for a in (1, 2, 3, 5, 30) for _ in range(80)]
    for t in cases:
        assert list(S.suffix_array(t)) == sorted(range(len(t)), key=lambda i: t[i:])


def test_equal_windows_come_from_the_suffix_order_not_from_hashes(monkeypatch):
    """A shard solved with a hash that gives every window the same value."""
    rng = random.Random(3)
    shared = [bytes(rng.choices(b"abc", k=130)) for _ in range(3)]
    parts = [bytes(rng.choices(b"abcd", k=rng.randint(100, 260))) + rng.choice(shared) + bytes(rng.choices(b"ab", k=rng.randint(0, 40))) for _ in range(12)]
    group = pd.DataFrame({"anchor": 1, "phash": range(12), "doc": range(12), "th": 0, "start": 0, "n": [len(p) - S.WIDTH + 1 for p in parts], "part": parts})

    def windows(frame):
        return {(p, lo + i): (r["doc"], r["start"] + i) for p, runs in zip(frame["phash"], frame["runs"]) for r in runs
                for lo in [r["lo"]] for i in range(r["hi"] - r["lo"])}
    want = {}
    for d, p in enumerate(parts):
        for i in range(len(p) - S.WIDTH + 1):
            w = p[i:i + S.WIDTH]
            want[d, i] = next((e, q.find(w)) for e, q in enumerate(parts) if w in q)
    assert windows(S._solve(None, group)) == want
    monkeypatch.setattr(S.H, "grams", lambda sums, k: np.zeros(len(sums) - k, np.uint64))
    assert windows(S._solve(None, group)) == want
