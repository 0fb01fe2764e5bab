import hashlib
import random
from dataclasses import replace

from tests.llm.helpers import write_docs
from veracorp.llm import substring_dedup as S


def brute(rows):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(40)] + ["é", "the"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randrange(10, 40))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choices(vocabulary, k=rng.randrange(30))))
        texts.append((" " if rng.random() < 0.5 else "\n ").join(parts))
    texts += [texts[0], texts[1], "", None, " ", "a " * 400, "a " * 900, "b a " * 50, "one two three", " ".join(f"u{k}" for k in range(20000))]
    ids = list(range(10, 10 + len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def run(spark, path, rows):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op9_substring_dedup(spark, write_docs(spark, path, rows)).collect()}


def test_against_brute_force(spark, tmp_path):
    rows = corpus(1)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_hot_anchors_take_the_exact_way_round(spark, tmp_path, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(S, "SPEC", replace(S.SPEC, hot_tokens=40))
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_null_and_repeated_ids(spark, tmp_path):
    assert S.op9_substring_dedup(spark, write_docs(spark, tmp_path / "a", [])).count() == 0
    text = " ".join(f"w{k}" for k in range(30))
    got = S.op9_substring_dedup(spark, write_docs(spark, tmp_path / "b", [(1, text), (1, text), (None, text), (None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == [("1", 30, 0), ("1", 30, 0), ("None", 0, 0), ("None", 30, 30)]


def test_automaton_holds_every_substring_with_its_smallest_document():
    rng = random.Random(4)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    auto = S.SuffixAutomaton()
    for doc, t in enumerate(texts):
        auto.add(t, doc)
    auto.close()
    for t in texts:
        want = [min(d for d, u in enumerate(texts) if any(u[j:j + 4] == t[k:k + 4] for j in range(len(u) - 3))) for k in range(len(t) - 3)]
        assert auto.first_documents(t, 4) == want
