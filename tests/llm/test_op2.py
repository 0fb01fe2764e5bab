import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_df, write_docs
from veracorp.llm import secrets as S

HARD = ["", None, "password = hunter22", "Password:'abc' secret=token : abcdef", "token=secret=abcdef99", "API_KEY = \"sk-12.34/56=\"",
        "apikey:12345", "AKIA" + "A" * 16, "AKIA123 AKIAAKIA" + "B2" * 9, "deadbeef" * 3, "g" + "0" * 23, "é password=éabcdef x",
        "paſſword=abcdefgh", "toKen=abcdefgh", "secret '  : 'x1x1x1", "0123456789abcdef" * 3000, "tokentoken=abcdef", "passwd==abcdef",
        "auth header q9Zx7LmP2vTb8KwR4nYc next", "auth header configuration_directory_listener next"]


def brute(text):
    """The contract, read literally: all matches, failing ones dropped."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def check(rows, got):
    assert sorted(g.doc_id for g in got) == sorted(i for i, _ in rows)
    texts = {i: t or "" for i, t in rows}
    for g in got:
        spans = brute(texts[g.doc_id])
        said = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert g.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert set(filter(None, said.split(","))) <= set(g.spans.split(","))


def test_hard_cases(spark, tmp_path):
    rows = list(enumerate(HARD))
    got = S.op2_secrets(spark, write_docs(spark, tmp_path, rows)).collect()
    check(rows, got)
    by = {g.doc_id: g for g in got}
    assert by[len(HARD) - 2].n_novel == 1 and by[len(HARD) - 1].n_novel == 0


def test_random_texts_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    parts = ["password", "Token", "secret", "api_key", "APIKEY", "=", ":", " ", "'", '"', "abc", "AKIA", "Z9Z9Z9Z9", "0af", "deadbeef", "é", "\n", "."]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(60)))) for i in range(800)]
    check(rows, S.op2_secrets(spark, write_docs(spark, tmp_path, rows)).collect())


def test_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, S.op2_secrets(spark, SF_SMALL).collect())


def test_novelty_is_low_for_what_the_surroundings_hold():
    z = S._compressor()
    name = "q9Zx7LmP2vTb8KwR4nYc"
    assert S.novelty(z, "auth ", name, " end") > 0.8
    assert S.novelty(z, f"auth {name} again ", name, " end") < 0.4
    assert S.novelty(z, "auth ", "authorization backend base64", " end") < 0.4


def test_stage_redacts_and_keeps_rows(spark):
    docs = docs_df(spark, [(1, "x password=abcdefgh y"), (1, "x password=abcdefgh y"), (None, None), (3, "clean")]).withColumn("spans", F.lit(1))
    got = S.stage_secrets(spark, docs, "")
    assert got.schema == docs.schema or got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in got.collect()) == [
        ("1", "x [SECRET] y", 12), ("1", "x [SECRET] y", 12), ("3", "clean", 5), ("None", None, None)]


def test_empty_table(spark, tmp_path):
    assert S.op2_secrets(spark, write_docs(spark, tmp_path, [])).count() == 0


ORDINARY = """accountAddressConfig2 backendConnection1 credential_container2 defaultDirectory3 environment_endpoint1 fileFormatFunction2
    gatewayHandler_header1 identifierInstance2 javascript_keyword1 libraryListener_load2 messageMethodModule1 networkNotification2
    object_operation_option1 parameterPasswordPath2 query_queue_random1 requestResponse_result2 sessionStringStorage1 token_timestamp_type2
    user_username_update1 validateValue_version2 workspaceWriter_worker1""".split()


def test_ordinary_identifiers_of_the_whole_alphabet_are_not_novel():
    z = S._compressor()
    high = {w: round(S.novelty(z, "auth header ", w, " next"), 2) for w in ORDINARY if S.novelty(z, "auth header ", w, " next") >= S.MIN_NOVELTY}
    assert not high
    for word in ORDINARY:
        text = f"auth header {word} next"
        assert S.novel_spans(text, text.encode(), [], z) == []
