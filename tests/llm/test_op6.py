import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from veracorp.llm import piece_units as U
from veracorp.llm import sentencepiece_lattice as L

PATH = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["Hello world  two   spaces ", "thhand the erly\n\nnew\tline", "日本語 🙂 é", "a", "", None, " ", "    ", "don't stop", "x" * 3000,
        "▁ odd ▁▁mark", "\x00\x01", "tail ", "ab" * 20 + " " + "9" * 31, "mixed漢字テスト words", "𝒳𝒴 unknown "]


def as_unigram(path):
    """The same pieces and scores under the library's unigram rule: trainer_spec.model_type = 1."""
    data = bytearray(open(path, "rb").read())

    def number(i):
        value = shift = 0
        while True:
            c = data[i]
            value |= (c & 127) << shift
            shift, i = shift + 7, i + 1
            if c < 128:
                return value, i

    def fields(i, end):
        while i < end:
            tag, i = number(i)
            if tag & 7 == 0:
                at = i
                _, i = number(i)
                yield tag >> 3, at, i
            elif tag & 7 == 2:
                size, i = number(i)
                yield tag >> 3, i, i + size
                i += size
            else:
                i += 8 if tag & 7 == 1 else 4

    for name, a, b in list(fields(0, len(data))):
        if name == 2:
            for inner, at, _ in fields(a, b):
                if inner == 3:
                    data[at] = 1
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(data))


def test_documents_equal_the_library_and_round_trip(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = list(enumerate(HARD))
    coded = L.encode(docs_df(spark, rows)).cache()
    got = {r.doc_id: r.ids for r in coded.collect()}
    back = {r.doc_id: r.text for r in L.decode(coded).collect()}
    for i, t in rows:
        assert got[i] == sp.encode((t or "").replace("▁", " ")), (i, t)
        assert back[i] == (t or "").replace("▁", " ")


def test_viterbi_rule_finds_the_best_scored_path(spark):
    uni = as_unigram(PATH)
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdehilnorst", k=rng.randrange(1, 14))) for _ in range(300)] + ["日本", "é🙂"]
    pieces = L.Pieces(PATH)
    table = {p: s for p, _, s in pieces.plain}
    vocab = spark.createDataFrame([(L.SPACE + w, 1) for w in sorted(set(words))], "unit string, n long")

    def value(ids):
        return sum(pieces.lowest - 10 if i < 259 else table[uni.id_to_piece(i)] for i in ids)

    for r in L.encode_units(vocab, pieces, "viterbi").collect():
        want = uni.encode(r.unit[1:])
        assert r.ids == want or value(r.ids) == value(want), r.unit


def test_small_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = L.op6_sentencepiece(spark, SF_SMALL).collect()
    assert {g.doc_id: g.n_pieces for g in got} == {i: len(sp.encode(t)) for i, t in rows.items()}
    assert all(g.round_trip for g in got)


def test_few_frequent_units_give_the_same(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(HARD)]
    want = sorted((r.doc_id, r.ids) for r in L.encode(docs_df(spark, rows)).collect())
    monkeypatch.setattr(L, "FREQUENT", 1)
    assert sorted((r.doc_id, r.ids) for r in L.encode(docs_df(spark, rows)).collect()) == want


def test_empty_null_and_repeated_ids(spark, tmp_path):
    assert L.op6_sentencepiece(spark, write_docs(spark, tmp_path / "a", [])).count() == 0
    got = L.op6_sentencepiece(spark, write_docs(spark, tmp_path / "b", [(None, "a b"), (1, None), (2, "")])).collect()
    assert sorted((str(r.doc_id), r.n_units, r.n_pieces, r.round_trip) for r in got) == [("1", 0, 0, True), ("2", 0, 0, True), ("None", 2, 2, True)]


def test_bpe_fold_equals_the_library_on_many_words(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    words = {w for r in texts[:300] for w in r.text.split(" ") if 0 < len(w) < L.LONGEST and "▁" not in w}
    vocab = spark.createDataFrame([(L.SPACE + w, 1) for w in sorted(words)], "unit string, n long")
    for r in L.encode_units(vocab, L.Pieces(PATH)).collect():
        assert r.ids == sp.encode(r.unit[1:]), r.unit


def test_query_returns_whole_documents_and_compares_them_with_their_text(spark, tmp_path):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [*enumerate(HARD), (100, "one row"), (100, "another row"), (100, "one row"), (None, "a b"), (None, "c"), (0, "c")]
    got = L.op6_sentencepiece(spark, write_docs(spark, tmp_path, rows)).collect()
    want = [(str(i), sp.encode((t or "").replace("▁", " ")), "▁" not in (t or "")) for i, t in rows]
    assert sorted((str(g.doc_id), g.ids, g.round_trip) for g in got) == sorted(want)
    assert all(g.n_pieces == len(g.ids) for g in got)


def test_documents_are_encoded_where_they_are(spark, tmp_path, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(L, "FREQUENT", 3)
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choices("aehinrst.,7é", k=rng.randrange(1, 12))) for _ in range(60))) for i in range(50)]
    query = L.op6_sentencepiece(spark, write_docs(spark, tmp_path, rows))
    assert {r.doc_id: r.ids for r in query.collect()} == {i: sp.encode(t) for i, t in rows}
    assert not re.search(r"Exchange hash|Exchange range|SortMergeJoin", query._jdf.queryExecution().executedPlan().toString())


def test_units_are_cut_where_no_piece_holds_the_pair(spark):
    texts = ["the cat, 12 cats. the", "the 日本 x=1", "", None, "a  b", "y" * 40 + ",the"]
    units = {r.unit: r.n for r in L.vocabulary(docs_df(spark, list(enumerate(texts))), L.Pieces(PATH)).collect()}
    assert units["▁the"] == 3 and units["▁cat"] == 1 and units["▁cats"] == 1 and units["2"] == 1 and units["1"] == 2
    assert not any("," in u and len(u) > 1 for u in units) and max(map(len, units)) <= L.LONGEST


def test_documents_in_many_chunks_and_without_rare_units(spark, monkeypatch):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    monkeypatch.setattr(U, "CHUNK", 40)
    texts = [t or "" for t in HARD] + ["the the the"] * 5 + [f"rare{c} the" for c in "qwxz"]
    pieces = L.Pieces(PATH)
    table = U.known_units([(" the", sp.encode("the"))])

    class Held:
        value = table

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    rows = list(U.cutting(pieces.cut, L.LONGEST, Held, lambda words: sp.encode(words))([batch]))
    assert sum(len(r) for r in rows if r.column("k").null_count == len(r) and len(r)) == len(texts)
    assert len(rows) > 10
    for far, own in zip(rows[::2], rows[1::2], strict=True):
        assert far.column("k").to_pylist() == list(range(len(far)))
        units = far.column("unit").to_pylist()
        for text, code in zip(own.column("text").to_pylist(), own.column("code").to_pylist(), strict=True):
            numbers = np.frombuffer(code, np.int32).tolist()
            parts = [i if i >= 0 else units[-2 - i] for i in numbers[:-1]]
            assert numbers[-1] == -1
            back = "".join(p if isinstance(p, str) else sp.id_to_piece(p).replace("▁", " ") for p in parts)
            assert back == (" " + text.replace("▁", " ") if text else "")
