import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from veracorp.llm import prefix_trie as P

DDL = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(t):
    return hashlib.sha256(f"{len(t[0].encode())}:{t[0]}{t[1]}".encode()).digest()


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, (role or "", text or "")))
    for c, ts in convs.items():
        convs[c] = [t for _, t in sorted(ts, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1])))]
    full = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        full[c] = tuple(convs.get(base, [])[:h] + convs[c][h:])
    members = {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    out = []
    for node, ms in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) == len(x) + 1 for y in below)]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below)
        ends = ",".join(str(m) for m in sorted(ms) if full[m] == node)
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows, extra=False):
    df = spark.createDataFrame(rows, DDL)
    if extra:
        df = df.selectExpr("*", "1 AS depth", "'k' AS key", "2 AS p", "3 AS pos", "4 AS _row", "5 AS h", "6 AS n", "7 AS digest")
    df.write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return sorted(map(tuple, P.op13_prefix_trie(spark, str(tmp_path)).select(*COLS).collect()), key=repr)


def some(n, longest, seed, vocabulary="abc"):
    r, rows = random.Random(seed), []
    for c in r.sample(range(4 * n), n):
        rows += [(c, t, r.choice(["user", "assistant", None]), r.choice([*vocabulary, "", None])) for t in range(r.randint(1, longest))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,longest,seed", [(1, 1, 1), (12, 3, 2), (60, 9, 3), (40, 30, 4)])
def test_against_brute_force(spark, tmp_path, n, longest, seed):
    rows = some(n, longest, seed)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_copies_shared_beginnings_and_turnless_conversations(spark, tmp_path):
    rows = [(c, t, "u", f"t{t}") for c in range(200, 260) for t in range(12)]          # copies
    rows += [(c, t, "u", f"t{t}" if t < 7 else f"{c}") for c in range(300, 330) for t in range(9)]  # leave after 7 turns
    rows += [(c, 0, "u", "x") for c in range(1001, 1060)]                              # mostly turnless: no base, one turn
    assert run(spark, tmp_path, rows) == brute(rows)


def test_nulls_ties_repeats_negative_ids_and_clashing_columns(spark, tmp_path):
    rows = [(None, 1, "u", "lost"), (None, None, None, None), (5, None, "u", "first"), (5, None, "u", "also first"), (5, 3, "u", "same"), (5, 3, "u", "same"),
            (-7, 0, None, None), (-7, 1, "", ""), (-107, 0, "u", "é😀"), (-100, 0, "u", "base"), (-100, 0, "u", "base"), (-100, 2, "a", "base"),
            (2**62, 0, "u", "y" * 200000), (0, 0, "u", "same"), (100, 9, None, "z"), (104, 9, None, "z"), (150, 1, None, "z")]
    rows += [(c, t, "u", "r") for c in (105, 106, 107, 108) for t in (1, 1, 1, None)]
    assert run(spark, tmp_path, rows, extra=True) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_more_ids_end_at_a_node_than_one_chunk_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "ENDS", 7)
    rows = [(c, t, "u", str(t)) for c in range(100, 180) for t in range(2)] + some(20, 4, 8)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_deep_conversations_take_several_rounds_and_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 16)
    r = random.Random(9)
    rows = [(c, t, "u", "s" if t < 100 - c % 7 * 9 else r.choice("ab")) for c in (0, 1, 2, 3, 200, 201, 405) for t in range(150)]
    want = brute(rows)
    assert run(spark, tmp_path, rows) == want
    turns, lengths = P.rebuilt(spark.read.parquet(f"{tmp_path}/conversations.parquet"))
    for band in (2, 3):
        assert sorted(map(tuple, P.trie(turns, lengths, band).select(*COLS).collect()), key=repr) == want


def test_no_row_explodes_beyond_a_band(spark):
    chain = spark.range(1000).selectExpr("1L AS conv_id", "id AS depth", "CAST(CAST(id AS STRING) AS BINARY) AS key")
    values = chain.select("conv_id", "depth", F.lit(1).cast("long").alias("x"))
    got = {int(bytes(r["key"])): r["x"] for r in P.subtree_sums(chain, values, ("x",), 999).collect()}
    assert got == {d: 1000 - d for d in range(1000)}


def test_oracle(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    got = sorted(map(tuple, P.op13_prefix_trie(spark, SF_SMALL).select(*COLS).collect()), key=repr)
    assert got == sorted(c.execute(f"SELECT {', '.join(COLS)} FROM ({P.SQL['op13_prefix_trie']})").fetchall(), key=repr)
