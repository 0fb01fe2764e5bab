"""Goldens for the Column text operators (hand-made rows, FIXTURES.md section 5)."""

from pyspark.sql import functions as F

from veracorp.functions import lexicon as L
from veracorp.functions import text as T


def one(spark, s, expr):
    return spark.createDataFrame([(s,)], "t string").select(expr(F.col("t")).alias("o")).first()["o"]


def test_clean_golden(spark):
    s = "Été!!! go... #café @josé a.b@x.com http://x.y/z www.q.org <b>hi</b> 😀漢字 اردو OK"
    assert one(spark, s, T.clean_text) == "été! go. café [mention] [email] [url] [url] hi اردو ok"


def test_clean_null(spark):
    assert one(spark, None, T.clean_text) == ""


def test_regex_tokens_golden(spark):
    assert one(spark, "don't say [URL] 12 naïve", T.regex_tokens) == ["don't", "say", "[URL]", "12", "na", "ve"]


def test_two_plus_char_words(spark):
    got = one(spark, "don't say [URL] 12 naïve", lambda c: T.word_tokens_2plus(c, lowercase=False))
    assert got == ["don", "say", "URL", "12", "naïve"]


def test_whitespace_tokens_unicode_spaces(spark):
    assert one(spark, "A b　 C\n", T.whitespace_tokens) == ["a", "b", "c"]


def test_strip_is_python_strip(spark):
    s = "  x y \n\t"
    assert one(spark, s, T.strip_edges) == s.strip()


def test_stopwords_kept_and_removed_partition(spark):
    toks = ["The", "news", "is", "not", "fake", "said", "she"]
    df = spark.createDataFrame([(toks,)], "t array<string>")
    r = df.select(T.kept_tokens("t", True).alias("k"), T.removed_tokens("t", True).alias("r"),
                  T.kept_tokens("t", False).alias("k0"), T.removed_tokens("t", False).alias("r0")).first()
    assert sorted(r["k"] + r["r"]) == sorted(toks)
    assert r["k"] == ["not", "fake"] and r["r"] == ["The", "news", "is", "said", "she"]
    assert r["k0"] == ["news", "fake", "said"]


def test_stopword_lists():
    assert len(L.ENGLISH_STOPWORDS) == 179
    assert "never" not in L.DOMAIN_STOPWORDS and "news" in L.DOMAIN_STOPWORDS
    assert len(L.DOMAIN_STOPWORDS) == 179 - len(set(L.KEEP_WORDS) & set(L.ENGLISH_STOPWORDS)) + 15


def test_keyword_and_markers(spark):
    assert one(spark, "New COVID-19 rules", lambda c: T.any_keyword(c, L.TOPIC_KEYWORDS)) is True
    assert one(spark, "Yeh sach hai, bilkul", lambda c: T.marker_words(c, L.CODE_SWITCH_MARKERS)) == \
        ["yeh", "sach", "hai", "bilkul"]


def test_treebank_tokens(spark):
    got = one(spark, "i can't believe it's true (really).", T.treebank_tokens)
    assert got == ["i", "ca", "n't", "believe", "it", "'s", "true", "(", "really", ")", "."]
