import hashlib

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm.helpers import write_docs
from veracorp.llm import fingerprint as P


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        e = t[:len(t) - cut] + nxt[:cut]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), e, nxt)
    return out


def exact_likeness(a, b):
    (ka, _), (kb, _) = P.paragraph_keys([a.encode()]), P.paragraph_keys([b.encode()])
    x, y = set(ka.tolist()), set(kb.tolist())
    return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0


def check(rows, got):
    want = expected(rows)
    texts = {i: t or "" for i, t in rows}
    assert sorted(g.doc_id for g in got) == sorted(want)
    for g in got:
        n, sha, e, nxt = want[g.doc_id]
        assert (g.n_chars, g.edited_sha256) == (n, sha)
        assert abs(g.near_edited - exact_likeness(texts[g.doc_id], e)) < 1e-9
        assert abs(g.near_next - exact_likeness(texts[g.doc_id], nxt)) < 1e-9
    by_text = {}
    for g in got:
        assert by_text.setdefault(texts[g.doc_id], g.fingerprint) == g.fingerprint
    return got


def test_small_cases(spark, tmp_path):
    rows = [(3, "one two three four five six seven eight nine"), (10, None), (11, ""), (4, "é\né\né " * 500),
            (40, "a " * 30000), (41, "a " * 30000), (2, "x"), (900, "same line\n" * 40), (5, " \n ")]
    check(rows, P.op10_fingerprints(spark, write_docs(spark, tmp_path, rows)).collect())


def test_single_row_and_empty(spark, tmp_path):
    got = P.op10_fingerprints(spark, write_docs(spark, tmp_path / "a", [(1, "alone in the table")])).collect()
    check([(1, "alone in the table")], got)
    assert P.op10_fingerprints(spark, write_docs(spark, tmp_path / "b", [])).count() == 0


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "g h i j"), (7, "k l m")]
    assert P.op10_fingerprints(spark, write_docs(spark, tmp_path, rows)).count() == 4


def test_whole_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = check(rows, P.op10_fingerprints(spark, SF_SMALL).collect())
    assert np.mean([g.near_edited for g in got]) > np.mean([g.near_next for g in got]) + 0.3


def test_peeling_recovers_the_differing_digests():
    a = P.paragraph_keys([b"\n".join(b"line %d" % i for i in range(200))])
    b = P.paragraph_keys([b"\n".join(b"line %d" % i for i in range(100, 300))])
    rows, keys, done = P.Sketch(*a, 600).minus(P.Sketch(*b, 600)).peel()
    assert done.all() and set(keys.tolist()) == set(a[0].tolist()) ^ set(b[0].tolist())
    assert not P.Sketch(*a, 24).minus(P.Sketch(*b, 24)).peel()[2].all()
