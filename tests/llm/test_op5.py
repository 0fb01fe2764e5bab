import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.helpers import write_docs
from veracorp.llm import packing as P
from veracorp.llm.word_bpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", None, " \n", "İstanbul ΣΑΣ ς", "don't we'll I'm 'S", "a b  c\x1cd", "x<|endoftext|>y", "éte été", "naïve,café.",
        "...,, ., a.b,c", "日本語 テスト", "🙂🙂", "123 4567", "x" * 5000, "Ænß ĳ ǅ", "﻿bom", "ab,", ",", "key=\"v\""]


def reference_pieces(rows):
    tk = Tokenizer.from_file(PATH)
    out = {}
    for i, t in rows:
        ids = tk.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4")
            out[i, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    return out


def check(rows, got):
    assert {(g.doc_id, g.piece): (g.start, g.length, g.ids_crc32) for g in got} == reference_pieces(rows)
    bins = {}
    for g in got:
        bins.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins)


def test_words_one_by_one_equal_the_library():
    tk, coder = Tokenizer.from_file(PATH), WordBpe(PATH)
    texts = [t for t in HARD if t]
    for t, blob in zip(texts, coder.encode([t.encode() for t in texts])):
        assert np.frombuffer(blob, "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids, t


def test_edge_cases(spark, tmp_path):
    rows = list(enumerate(HARD)) + [(100, "long words here " * 6000)]
    check(rows, P.op5_packing(spark, write_docs(spark, tmp_path, rows)).collect())


def test_empty_table_null_and_repeated_ids(spark, tmp_path):
    assert P.op5_packing(spark, write_docs(spark, tmp_path / "a", [])).count() == 0
    assert P.op5_packing(spark, write_docs(spark, tmp_path / "b", [(1, "a"), (1, "a"), (None, None)])).count() == 3


def test_small_table_packs_near_the_bound(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = P.op5_packing(spark, SF_SMALL).collect()
    assert check(rows, got) <= 1.03 * sum(g.length for g in got) / 2048 + 2


def test_each_step_takes_the_smallest_sum_of_squares():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 17, 300)
    seq, offset = P.sum_of_squares(lengths, 16)
    fill = {}
    for s, q, o in zip(lengths.tolist(), seq.tolist(), offset.tolist()):
        def cost(state):
            gaps = [16 - f for f in state.values() if f < 16]
            return sum(gaps.count(g) ** 2 for g in set(gaps))
        choices = [cost({**fill, k: f + s}) for k, f in fill.items() if f + s <= 16] + [cost({**fill, "new": s})]
        assert fill.get(q, 0) == o
        fill[q] = o + s
        assert cost(fill) == min(choices)


def test_rows_that_share_an_id_spread_over_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 50)
    rows = [(None, "the same text")] * 200 + [(7, f"text {i}") for i in range(200)] + [(1000 + i, f"other {i}") for i in range(200)]
    got = P.op5_packing(spark, write_docs(spark, tmp_path, rows)).collect()
    assert len(got) == 600
    groups = {}
    for g in got:
        groups[g.sequence_id >> 40] = groups.get(g.sequence_id >> 40, 0) + 1
    assert len(groups) >= 10 and max(groups.values()) <= 100
