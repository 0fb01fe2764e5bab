import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.test_op2 import brute as secret_spans
from tests.llm.test_op8 import brute as near_groups
from veracorp.llm import secrets as S


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secrets", "packing"]


def test_each_stage_against_brute_force(spark, tmp_path):
    """Every stage is judged on its own input: what the stage before it wrote."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tables = [docs]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        step(spark, tables[-1], SF_SMALL).write.parquet(path)
        tables.append(spark.read.parquet(path))
    assert all(t.columns == docs.columns for t in tables[:-1])
    rows = [{r.doc_id: r for r in t.collect()} for t in tables[:-1]]
    start, clean, unique, apart, safe = rows
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = [labels[i] for i in clean if i in labels]
    gone = [labels[i] for i in start if i in labels and i not in clean]
    assert kept.count(0) >= 0.97 * (kept.count(0) + gone.count(0))
    first = {}
    for i in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", clean[i].text), i)
    assert set(unique) == set(first.values())
    assert set(apart) == {i for i, (_, _, keep) in near_groups([(i, r.text) for i, r in unique.items()], width=5).items() if keep}
    assert set(safe) == set(apart)
    for i, r in safe.items():
        assert r.text == apart[i].text or secret_spans(apart[i].text) or S.novel_spans(apart[i].text, apart[i].text.encode(), [], S._compressor())
        assert not [s for s in secret_spans(r.text) if "[SECRET]" not in r.text[s[0]:s[2] + 8]]
        assert r.n_chars == len(r.text) or r.text == apart[i].text
    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {(r.doc_id, r.piece): r for r in tables[-1].collect()}
    for i, r in safe.items():
        ids = np.array(tk.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            assert pieces.pop((i, k // 2048)).ids_crc32 == zlib.crc32(ids[k:k + 2048].tobytes())
    assert not pieces


def test_run_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
