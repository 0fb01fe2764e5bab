import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from veracorp.llm import pii as P

# The contract's patterns, read literally.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def accepts(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else True,
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def brute(text):
    out = [(m.start(), i, m.end(), k) for i, k in enumerate(P.BASE) for m in re.finditer(PLAIN[k], text) if accepts(k, m[0])]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def check(rows, got):
    assert sorted(g.doc_id for g in got) == sorted(i for i, _ in rows)
    texts = {i: t or "" for i, t in rows}
    for g in got:
        spans = brute(texts[g.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert g.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (texts[g.doc_id][:200], said, g.spans)
        assert tuple(g[f"n_{k}"] for k in P.BASE) == tuple(sum(x == k for x, _, _ in spans) for k in P.BASE)
        assert set(filter(None, said.split(","))) <= set(g.spans.split(","))


HARD = ["", None, "a@b.c.d@e.f", "a@b.c_d@e.f x", "..%a@b-.c. é@x.y", "1.2.3.4.5.6.7.8", "0001.02.3.255 256.1.1.1 1.1.1.99999999999999999999999999999999999999999",
        "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111 1111 1111", "+1 (988) 555-2485", "+1 2", "+49 ((((((", "++12345678901",
        "é🙂 x@y.zz 🙂 +33 123456789 é", "\x01\x02a@b.cc\x01", "9" * 40000, "a" * 60000, "x@y" + ".z" * 20000, "1 " * 30000, "1." * 20000]


def test_hard_cases(spark, tmp_path):
    rows = list(enumerate(HARD))
    check(rows, P.op3_pii(spark, write_docs(spark, tmp_path, rows)).collect())


def test_random_texts_against_brute_force(spark, tmp_path):
    rng = random.Random(11)
    parts = ["a", "B9", "@", ".", "-", " ", "+", "1", "25", "255", "4111", "(", ")", "%", "_", "é", "\n", "com"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(50)))) for i in range(3000)]
    check(rows, P.op3_pii(spark, write_docs(spark, tmp_path, rows)).collect())


def test_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, P.op3_pii(spark, SF_SMALL).collect())


def test_weak_labelers_find_reliabilities_and_further_kinds(spark):
    good = [(i, f"please call John Smith, phone (212) 555-{1000 + i} or mail a{i}@site.com") for i in range(60)]
    bad = [(100 + i, f"version 10{i % 10}-22-{3000 + i}x1 and order 000-00-0000 0{i % 10}3 444-555{i % 10}") for i in range(60)]
    got = {r.row.doc_id: [x.kind for x in r.found] for r in P.find(docs_df(spark, good + bad), ["doc_id"]).collect()}
    assert sum("local" in got[i] for i in range(60)) >= 55 and sum("name" in got[i] for i in range(60)) >= 55
    assert sum("ssn" in got[100 + i] for i in range(60)) <= 5


def test_empty_null_and_repeated(spark, tmp_path):
    assert P.op3_pii(spark, write_docs(spark, tmp_path / "a", [])).count() == 0
    assert P.op3_pii(spark, write_docs(spark, tmp_path / "b", [(None, "a@b.cc"), (1, "x"), (1, "x")])).count() == 3


def test_main_path_runs_no_python(spark):
    plan = P.candidates(docs_df(spark, [(1, "x")]).withColumn("t", F.lit(1)), ["doc_id", "t"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
