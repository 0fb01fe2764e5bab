import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS
from tools.oracle_check import rows_of
from veracorp.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    cells = [row[0], row[3], row[2], row[4], text]
    return H(*("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def tree(nodes):
    """Every node's proof by plain recursion over whole levels; the root."""
    proofs = [[] for _ in nodes]
    own = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(own):
            run = at // 3 * 3
            proofs[leaf].append("".join(nodes[run:at]))
            proofs[leaf].append("".join(nodes[at + 1:run + 3]))
        proofs = [p[:-2] + [(p[-2], p[-1])] for p in proofs]
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        own = [i // 3 for i in own]
    return nodes[0], proofs


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = []
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        subs.append(tree([leaf_of(r, r[1]) for r in by[s]]))
    root, above = tree([x[0] for x in subs])
    out = []
    for s, (sub, proofs), up in zip(sources, subs, above):
        for r, p in zip(by[s], proofs):
            steps = p + up
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            h = leaf_of(r, r[1].replace("\n", "") if cut else r[1])
            for left, right in steps:
                h = H(left, h, right)
            out.append((r[0], leaf_of(r, r[1]), sub, root, H(*(x + y for x, y in steps)), h, h == root))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        df = df.selectExpr("*", "1 AS tree", "'x' AS leaf", "2 AS pos", "3 AS _row", "4 AS size", "5 AS root")
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = M.op11_merkle_manifest(spark, str(tmp_path))
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def some_rows(n, sources, seed=1):
    r = random.Random(seed)
    return [(i, "\n".join(r.choice("abcdé") * r.randint(0, 9) for _ in range(r.randint(1, 4))), r.choice(["en", None, ""]),
             r.choice(sources), r.choice([None, 3, 400])) for i in r.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 28, 300])
def test_sizes_against_brute_force(spark, tmp_path, n):
    rows = some_rows(n, ["b", "a", None, "", "ä", "z"], n)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_one_source_of_many_lots_and_many_small_sources(spark, tmp_path):
    rows = some_rows(1500, ["hot"], 3) + some_rows(60, [f"s{i}" for i in range(40)], 4)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_more_sources_than_a_lot_holds(spark, tmp_path):
    rows = [(i, f"t\n{i}", "en", f"s{i:04d}", i) for i in range(800)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_nulls_repeats_ties_long_text_and_clashing_columns(spark, tmp_path):
    rows = ([(None, None, None, None, None)] * 3 + [(7, "x\ny", "en", "s", 3)] * 5 + [(7, "other", "en", "s", 5), (8, "", "", "", 0)]
            + [(-4, "long\n" * 100000, "en", "s", None), (2**62, "\n", "en", None, 1)])
    assert run(spark, tmp_path, rows, extra=True) == brute(rows)


def test_a_repeated_row_fills_more_than_one_lot(spark, tmp_path):
    rows = [(5, "same\ntext", "en", "s", 9)] * 600 + some_rows(20, ["s", "t"], 5)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_missing_nodes_are_minimal_and_suffice():
    r = random.Random(2)
    for size in (1, 2, 3, 5, 9, 10, 26, 81, 100):
        leaves = [H(str(i)) for i in range(size)]
        root, proofs = tree(leaves)
        full, nodes, level = {}, leaves, 0
        while True:
            full.update({(level, i): h for i, h in enumerate(nodes)})
            if len(nodes) == 1:
                break
            nodes, level = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], level + 1
        for _ in range(20):
            a = r.randrange(size)
            b = r.randint(a + 1, size)
            need = M.missing(a, b, size)
            assert len(need) == len(set(need)) and all(p < a // 3**lv or p > (b - 1) // 3**lv for lv, p in need)
            levels, got = M.derive(a, leaves[a:b], size, {k: full[k] for k in need})
            assert got == root
            assert [M.siblings(levels, p) for p in range(a, b)] == proofs[a:b]
            if need:  # none can be spared
                left_out = r.choice(need)
                with pytest.raises(KeyError):
                    M.derive(a, leaves[a:b], size, {k: full[k] for k in need if k != left_out})


def test_derived_root_equals_the_manifest_and_hot_source_is_split(spark):
    m = M.Manifest(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert [r[0] for r in m.proofs().select("derived_root").distinct().collect()] == [m.root]
    lots = m.leaves.selectExpr("tree", M._LOT_OF).groupBy("tree", "lot").agg(F.count("*").alias("n"))
    assert lots.agg(F.max("n")).first()[0] <= M.LOT


def test_oracle(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = rows_of(M.op11_merkle_manifest(spark, SF_SMALL).toPandas())
    assert got == rows_of(c.execute(M.SQL["op11_merkle_manifest"]).df())
