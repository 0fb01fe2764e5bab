import random
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from veracorp.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(3))
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def counted(spark, rows):
    got = Q.statistics(docs_df(spark, rows)).withColumn("base_failed", Q.base_failed())
    return sorted(tuple(r) for r in got.select("doc_id", *Q.COUNTS, "base_failed").collect())


def test_counts_against_brute_force(spark):
    r = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \t\n\x0b\x0c\r"), (3, "one"), (4, "a b"), (5, "a a a"), (6, "a a a a"), (7, "a b c a b c"),
            (8, "x\ny\nx\n \n \nx "), (9, "| | |\n| | |"), (10, "é😀 ü x   é😀 ü x  "), (11, "#*$%&|<>" * 3), (12, "a" * 200000)]
    for i in range(13, 80):
        vocabulary = ["a", "b", "cc", "d#", "é", "\n", "x\ny", "<b>"][:r.randint(1, 8)]
        rows.append((i, r.choice([" ", "  ", "\t"]).join(r.choice(vocabulary) for _ in range(r.randint(0, 120)))))
    assert counted(spark, rows) == sorted((i, *brute(t)) for i, t in rows)


def test_very_long_texts(spark):
    r = random.Random(6)
    rows = [(1, " ".join(f"w{r.randint(0, 40)}" for _ in range(60000))), (2, "a " * 100000), (3, " ".join(map(str, range(100000))))]
    assert counted(spark, rows) == sorted((i, *brute(t)) for i, t in rows)


def labelled(spark, rows):
    """rows: (bad, prune, values of FEATURES)."""
    ddl = "bad boolean, prune boolean, " + ", ".join(f"{f} double" for f in Q.FEATURES)
    return spark.createDataFrame([(b, p, *map(float, v)) for b, p, v in rows], ddl)


def planted(n=900, seed=1, noise=0.0):
    """Low quality: symbol_share > 0.3, or upper_share > 0.5 and mark_share > 0.2."""
    r, out = random.Random(seed), []
    at = {f: i for i, f in enumerate(Q.FEATURES)}
    for k in range(n):
        v = [r.random() for _ in Q.FEATURES]
        v[at["symbol_share"]] = r.choice([0.35, 0.5, 0.9]) if k % 10 == 0 else r.uniform(0, 0.25)
        bad = v[at["symbol_share"]] > 0.3 or v[at["upper_share"]] > 0.5 and v[at["mark_share"]] > 0.2
        out.append((bad != (r.random() < noise), k % 3 == 0, v))
    return out


def test_learns_planted_conjunctions_in_order(spark):
    rows = planted()
    rules = Q.learn(labelled(spark, rows))
    sets = [{c.feature for c in x.conditions} for x in rules.rules]
    assert {"upper_share", "mark_share"} in sets and any("symbol_share" in s for s in sets)
    got = labelled(spark, planted(seed=2)).select("bad", (rules.rule_number() > 0).alias("hit")).collect()
    hits = [r.bad for r in got if r.hit]
    assert sum(hits) / len(hits) > 0.95 and sum(hits) > 0.85 * sum(r.bad for r in got)
    assert all(x.bad >= Q.MIN_PRECISION * (x.bad + x.good) for x in rules.rules)


def test_list_is_ordered_and_equals_its_text(spark):
    rules = Q.learn(labelled(spark, planted()))
    rows = labelled(spark, planted(seed=3))
    want = rows.select(rules.rule_number().alias("n"), *Q.FEATURES).collect()
    for r in want:
        first = next((k for k, x in enumerate(rules.rules, 1)
                      if all(eval(str(c), {}, {c.feature: r[c.feature]}) for c in x.conditions)), 0)
        assert r.n == first


def test_conditions_on_cells_equal_conditions_on_values(spark):
    rows = labelled(spark, planted(200))
    cuts = Q.thresholds(rows)
    for f, above in (("symbol_share", True), ("mark_share", False)):
        for k in (0, len(cuts[f]) // 2, len(cuts[f]) - 1):
            c = Q.Condition(f, above, k, cuts[f][k])
            cells = Q._cells(rows, cuts).where(c.on_cells()).agg(F.sum(F.col("bad") + F.col("good"))).first()[0] or 0
            assert cells == rows.where(c.column()).count()


def test_noise_alone_gives_no_rule(spark):
    r = random.Random(4)
    rows = [(r.random() < 0.3, k % 3 == 0, [r.random() for _ in Q.FEATURES]) for k in range(600)]
    assert Q.learn(labelled(spark, rows)).rules == []


def test_pruning_cuts_conditions_that_only_fit_the_growing_part(spark):
    at = Q.FEATURES.index("digit_share")
    rows = planted(noise=0.03)
    rules = Q.learn(labelled(spark, rows)).rules
    assert rules and all(len(x.conditions) <= Q.MAX_CONDITIONS for x in rules)
    assert sum(c.feature == Q.FEATURES[at] for x in rules for c in x.conditions) <= 2


def test_query_on_nulls_repeats_labels_and_extra_columns(spark, tmp_path):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(None, clean), (None, None), (1, clean), (1, clean), (1, "short"), (2, ""), (3, "a b c " * 40)]
    df = docs_df(spark, rows).selectExpr("*", "1 AS n_words", "true AS kept", "'x' AS rule", "0 AS bad", "0 AS quality")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 1, 0), (1, 0, 0), (None, 0, 0), (2, None, 0), (9, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted(map(repr, Q.op12_quality_rules(spark, str(tmp_path)).select("doc_id", *Q.COUNTS, "base_failed", "kept").collect()))
    from pyspark.sql import Row
    want = [Row(doc_id=i, **dict(zip((*Q.COUNTS, "base_failed"), brute(t))), kept=not brute(t)[-1]) for i, t in rows]
    assert got == sorted(map(repr, want))


def test_empty_tables(spark, tmp_path):
    write_docs(spark, tmp_path, [])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = Q.op12_quality_rules(spark, str(tmp_path))
    assert out.count() == 0 and "kept" in out.columns


def test_native_plan_and_whole_table(spark):
    out = Q.op12_quality_rules(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert out.count() == docs.count()
    for df in (out, Q.statistics(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("Python", "Arrow", "Pandas"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.rule == 0)
