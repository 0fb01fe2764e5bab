"""Registered source / sink queries.

The driver tables are landed as the reference's source layouts (headerless
TSV, CSV pairs named by label, COVID-style CSVs, a self-built Parquet file)
below the shared checkpoint folder, then read back through the loaders.
Every landed file is derived from the driver tables, so the work grows with
them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veracorp.functions import patterns as P
from veracorp.operators import corpus as C
from veracorp.plans.base import combined
from veracorp.plans.queries import q_a3
from veracorp.session import shared_dir
from veracorp.sources import feeds as FD
from veracorp.sources import files as FS

REGISTRY = {}


def query(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _collapsed(c="text"):
    return F.trim(F.regexp_replace(F.col(c), P.WS_RUN, " "))


def _first_line(c="text"):
    return F.substring_index(F.col(c), "\n", 1)


def _rest(c="text"):
    return F.expr(f"substring({c}, length(substring_index({c}, '\\n', 1)) + 2)")


def land_sources(spark, sf: str) -> str:
    """Write the four source layouts derived from the corpus; return the root folder."""
    root = shared_dir(spark, "landed")
    df = combined(spark, sf)
    hex0 = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    liar = df.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("id"),
        F.when(F.col("label") == "Real", "half-true").when(F.col("label") == "Fake", "barely-true")
        .otherwise("satire").alias("label"),
        _collapsed().alias("statement"), F.col("year").cast("string").alias("subject"),
        F.col("source_id").alias("speaker"), F.lit("none").alias("job_title"), F.lit("none").alias("state"),
        F.lit("none").alias("party"), *[F.lit(0).alias(c) for c in ("barely_true", "false_count", "half_true",
                                                                     "mostly_true", "pants_fire")],
        F.lit("none").alias("context"), hex0.alias("_h"))
    for name, digits in (("train", "01234"), ("valid", "56789"), ("test", "abcdef")):
        part = liar.where(F.col("_h").isin(*list(digits))).drop("_h")
        FS.write_table(part, f"{root}/liar/{name}.tsv")
    date = F.date_format(F.make_date(F.col("year"), (F.col("doc_id") % 12 + 1).cast("int"),
                                     (F.col("doc_id") % 28 + 1).cast("int")), "MMMM d, yyyy")
    isot = df.select("label", _first_line().alias("title"), _rest().alias("text"), date.alias("date"))
    FS.write_table(isot.where(F.col("label") == "Real").drop("label"), f"{root}/isot/True.csv")
    FS.write_table(isot.where(F.col("label") == "Fake").drop("label"), f"{root}/isot/Fake.csv")
    covid = df.select("label", _first_line().alias("title"), _rest().alias("content"),
                      F.when(F.col("label") == "Fake", "1").otherwise("0").alias("target"))
    FS.write_table(covid.where(F.col("label") == "Fake").drop("label"), f"{root}/covid/ClaimFakeCOVID-19.csv")
    FS.write_table(covid.where(F.col("label") == "Real").drop("label"), f"{root}/covid/NewsRealCOVID-19_5.csv")
    selfb = df.select("text", F.lower("label").alias("label"),
                      F.date_format(F.make_date(F.col("year"), F.lit(3), F.lit(15)), "yyyy-MM-dd").alias("date"))
    FS.write_table(selfb, f"{root}/selfbuilt/dataset.parquet")
    return root


def _out(df):
    return df.select("label", F.col("year").cast("long").alias("year"), F.md5("text").alias("text_md5"))


@query("S1_csv_scan")
def q_s1(spark, sf):
    root = shared_dir(spark, "csv")
    src = combined(spark, sf).select("doc_id", "text", "label")
    FS.write_table(src, f"{root}/corpus.csv")
    back = FS.read_table(spark, f"{root}/corpus.csv", "doc_id long, text string, label string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "label")


@query("S2_tsv_scan")
def q_s2(spark, sf):
    root = land_sources(spark, sf)
    return _out(FS.load_liar(spark, FS.source_configs(root)["liar"]))


@query("S3_parquet_scan")
def q_s3(spark, sf):
    root = shared_dir(spark, "parquet")
    FS.write_table(combined(spark, sf).select("doc_id", "label"), f"{root}/corpus.parquet")
    return FS.read_table(spark, f"{root}/corpus.parquet")


@query("S4_json_scan")
def q_s4(spark, sf):
    root = shared_dir(spark, "json")
    FS.write_table(combined(spark, sf).select("doc_id", "text", "label"), f"{root}/corpus.jsonl")
    back = FS.read_table(spark, f"{root}/corpus.jsonl", "doc_id long, text string, label string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "label")


@query("S5_existing_paths")
def q_s5(spark, sf):
    root = land_sources(spark, sf)
    cfgs = FS.source_configs(root)
    rows = [(n, len(c.paths), len(FS.existing_paths(spark, c.paths))) for n, c in cfgs.items()]
    return spark.createDataFrame(rows, "source string, expected_paths long, existing_paths long")


@query("S6_file_name_labels")
def q_s6(spark, sf):
    root = land_sources(spark, sf)
    return _out(FS.load_isot(spark, FS.source_configs(root)["isot"]))


@query("S7_covid_labels")
def q_s7(spark, sf):
    root = land_sources(spark, sf)
    return _out(FS.load_covid(spark, FS.source_configs(root)["covid"]))


@query("S8_first_existing_file")
def q_s8(spark, sf):
    root = land_sources(spark, sf)
    return _out(FS.load_selfbuilt(spark, FS.source_configs(root)["selfbuilt"]))


@query("S9_load_report")
def q_s9(spark, sf):
    root = land_sources(spark, sf)
    _, report = FS.load_sources(spark, root, ("liar", "isot", "covid", "selfbuilt", "missing"))
    return report.select("source", "status")


@query("S9_combined_sources")
def q_s9c(spark, sf):
    root = land_sources(spark, sf)
    frames, _ = FS.load_sources(spark, root)
    union = FS.union_sources(frames)
    return (C.combine(union).groupBy("source_id", "label").agg(F.count(F.lit(1)).alias("cnt")))


@query("S10_feed_items")
def q_s10(spark, sf):
    root = shared_dir(spark, "feeds")
    FD.land_feed(combined(spark, sf), f"{root}/items")
    return FD.feed_records(spark, f"{root}/items", limit=20).select(
        "source", "text", "label", "date", "url", F.col("year").cast("long").alias("year"))


@query("S11_search_posts")
def q_s11(spark, sf):
    root = shared_dir(spark, "posts")
    FD.land_posts(spark, sf, f"{root}/posts.jsonl")
    return FD.search_records(spark, f"{root}/posts.jsonl", limit=200, label="Fake")


@query("S12_timeline_posts")
def q_s12(spark, sf):
    root = shared_dir(spark, "posts")
    FD.land_posts(spark, sf, f"{root}/posts.jsonl")
    return FD.timeline_records(spark, f"{root}/posts.jsonl", limit=200, label="Satire")


@query("S13_csv_sink_no_overwrite")
def q_s13(spark, sf):
    root = shared_dir(spark, "sink")
    df = combined(spark, sf).select("doc_id", "text", "label")
    FS.write_table(df, f"{root}/dataset.csv")
    refused = False
    try:
        FS.write_table(df, f"{root}/dataset.csv")
    except Exception:  # noqa: BLE001  (AnalysisException: path already exists)
        refused = True
    back = FS.read_table(spark, f"{root}/dataset.csv", "doc_id long, text string, label string")
    return back.select("doc_id", "label", F.md5("text").alias("text_md5"), F.lit(refused).alias("refused_overwrite"))


@query("S15_json_report")
def q_s15(spark, sf):
    root = shared_dir(spark, "report")
    rep = q_a3(spark, sf)
    rep.select(F.to_json(F.struct(*rep.columns)).alias("value")).write.text(f"{root}/reliability_report.json")
    back = spark.read.schema(rep.schema).json(f"{root}/reliability_report.json")
    return back
