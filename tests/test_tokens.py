"""Sentences with learnt abbreviations, and keyword tables."""

import random

from pyspark.sql import functions as F

from veracorp.operators import keywords as KW
from veracorp.operators import sentences as SE


def learnt(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return df, SE.abbreviations(df)


def split(spark, text, known):
    return spark.createDataFrame([(text,)], "text string").select(SE.sentences(F.col("text"), known)).first()[0]


PROSE = ["Dr. Smith met Mr. Jones at the house. They spoke of the house and the road to the sea.",
         "He saw Dr. Brown. The road was long and the house was far. Mr. Green came too.",
         "In the U.S. they met again near the sea. The sea was calm. Dr. Smith left the house with Mr. Jones.",
         "Far too calm a road, said Brown again, and far too long."] * 6


def test_abbreviations_are_learnt_and_ordinary_words_are_not(spark):
    _, known = learnt(spark, *PROSE)
    assert {"dr", "mr", "u.s"} <= set(known) and not {"house", "sea", "again", "calm", "far"} & set(known)


def test_sentences_end_at_periods_but_not_at_abbreviations(spark):
    _, known = learnt(spark, *PROSE)
    assert split(spark, PROSE[0], known) == ["Dr. Smith met Mr. Jones at the house.", "They spoke of the house and the road to the sea."]
    assert split(spark, "Is it?  Yes! (It is.) \"So.\" J. Smith says so", known) == ["Is it?", "Yes!", "(It is.)", '"So."', "J. Smith says so"]
    assert split(spark, "Wait ... what? Wait... Now. No end", known) == ["Wait ... what?", "Wait...", "Now.", "No end"]
    assert split(spark, "", known) == split(spark, None, known) == split(spark, " \n ", known) == []


def test_tokens_go_by_sentences(spark):
    df, known = learnt(spark, *PROSE)
    got = spark.createDataFrame([("Dr. Smith can't go. He said no.",)], "text string").select(SE.word_tokens(F.col("text"), known)).first()[0]
    assert got == ["Dr.", "Smith", "ca", "n't", "go", ".", "He", "said", "no", "."]


def test_no_text_no_abbreviations(spark):
    assert learnt(spark, None, "")[1] == []


def brute(docs, words):
    ks = {w.lower() for w in words if w}
    out = {i: sorted(k for k in ks if k in (t or "").lower()) for i, t in docs}
    return {i: k for i, k in out.items() if k}


def matches(spark, docs, words, gram=KW.GRAM):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    k = spark.createDataFrame([(w,) for w in words], "keyword string")
    return {r.doc_id: r.keywords for r in KW.keyword_matches(d, k, gram=gram).collect()}


def test_keyword_tables_against_brute_force(spark):
    r = random.Random(3)
    docs = [(i, "".join(r.choice("abcÉé ß😀") for _ in range(r.randint(0, 60)))) for i in range(60)] + [(100, None), (101, ""), (102, "ABC" * 5000)]
    words = ["".join(r.choice("abcé ß😀") for _ in range(r.randint(1, 9))) for _ in range(200)] + ["", None, "A", "abcabcabcabc"]
    for gram in (1, 3, 5):
        assert matches(spark, docs, words, gram) == brute(docs, words)


def test_no_keywords(spark):
    assert matches(spark, [(1, "a")], []) == matches(spark, [(1, "a")], [None, ""]) == matches(spark, [], ["a"]) == {}
