import hashlib
import re

import duckdb

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from tools.oracle_check import rows_of
from veracorp.llm import exact_dedup as X
from veracorp.llm.common import shared_path


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    out = {}
    for i, n in norm.items():
        same = [j for j, m in norm.items() if m == n]
        out[i] = (min(same), len(same), i == min(same), hashlib.sha256(n.encode()).hexdigest())
    return out


def test_edge_cases_against_brute_force(spark, tmp_path):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (7, " "), (8, "\n\r"), (4, "é" * 50000), (6, "é" * 50000)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256)
           for r in X.op7_exact_dedup(spark, write_docs(spark, tmp_path, rows)).collect()}
    assert got == brute(rows)


def test_empty_table(spark, tmp_path):
    assert X.op7_exact_dedup(spark, write_docs(spark, tmp_path, [])).count() == 0


def test_stage_keeps_one_row_of_repeated_and_null_ids(spark):
    docs = docs_df(spark, [(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y"), (2, None)])
    docs = docs.selectExpr("*", "'d' AS digest", "7 AS row", "true AS kept")
    got = X.stage_exact_dedup(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got.collect()) == [
        (False, 1, "x"), (False, 2, None), (True, None, "y")]


def test_index_persists_across_instances(spark):
    where = shared_path(spark, "test-index")
    first = X.DigestIndex(spark, where, buckets=4)
    X.annotate(docs_df(spark, [(1, "a"), (2, "b")]), first, ["doc_id"]).count()
    first.close()
    again = X.DigestIndex(spark, where, buckets=4)
    out = {r.doc.doc_id: (r.keep_id, r.kept) for r in
           X.annotate(docs_df(spark, [(10, "b"), (11, "c"), (12, "c")]), again, ["doc_id"]).collect()}
    assert out[10][0] == 2 and out[10][1] is False
    assert out[11] == (11, True) and out[12] == (11, False)
    assert again.table().count() == 3
    plan = again.unseen(again.table())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BatchEvalPython" not in plan


def test_oracle(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = rows_of(X.op7_exact_dedup(spark, SF_SMALL).toPandas())
    assert got == rows_of(c.execute(X.SQL["op7_exact_dedup"]).df())


def test_ids_near_the_ends_of_the_long_range(spark, tmp_path):
    for k, ids in enumerate([(0, 5, 2**53, 2**54), (-2**63, -1, 0, 2**63 - 1), (2**63 - 2, 2**63 - 1)]):
        rows = [(i, f"text {i}") for i in ids] + [(ids[-1] - 1, f"text {ids[0]}")] * (len(ids) > 2)
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256)
               for r in X.op7_exact_dedup(spark, write_docs(spark, tmp_path / str(k), rows)).collect()}
        assert got == brute(rows)
