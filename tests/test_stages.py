"""Observed writes, the guard, file digests of lake versions, and the stage graph."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from veracorp.operators import corpus as C
from veracorp.operators import lake as LK
from veracorp.operators import observed as OB
from veracorp.plans.graph import Stage, StageGraph


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.when(F.col("id") % 4 == 0, F.col("id")))
    got = OB.observed_write(df, lambda d: d.write.parquet(f"{tmp_path}/t"), nulls=F.count_if(F.col("x").isNull()), top=F.max("id"))
    assert got == {"n": 100, "nulls": 75, "top": 99}
    assert OB.observed_write(df.limit(0), lambda d: d.write.parquet(f"{tmp_path}/e"))["n"] == 0
    assert OB.observed_write(spark.createDataFrame([], "a int"), lambda d: d.write.parquet(f"{tmp_path}/f"))["n"] == 0


def jobs_of(spark, group, work):
    """Jobs that ``work`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    work()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return n


def test_a_guarded_write_is_one_pass(spark, tmp_path):
    df = spark.range(50)
    plain = jobs_of(spark, "plain", lambda: df.write.parquet(f"{tmp_path}/a"))
    assert jobs_of(spark, "guarded", lambda: OB.write_guarded(df, f"{tmp_path}/b", 50)) == plain


def test_short_corpora_fail_and_leave_nothing(spark, tmp_path):
    with pytest.raises(OB.TooFewRows, match="fewer than"):
        OB.write_guarded(spark.range(3), f"{tmp_path}/c", 4)
    assert not os.path.exists(f"{tmp_path}/c")
    assert OB.write_guarded(spark.range(3), f"{tmp_path}/c", 3) == 3 == spark.read.parquet(f"{tmp_path}/c").count()


def test_duplicate_rate_without_deduplicating(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("",)], "text string")
    assert tuple(C.duplicate_stats(df).first()) == (5, 3, 40.0)
    assert tuple(C.duplicate_stats(df.limit(0)).first()) == (0, 0, 0.0)


# --- L9 ---------------------------------------------------------------------------------

def lake(spark, tmp_path, n=300):
    lk = LK.Lake(spark, str(tmp_path / "lake"))
    rec = lk.upload("raw/x/dataset", spark.range(n).withColumn("t", F.lit("text")).repartition(4), {"a": 1})
    return lk, rec


def data_files(rec):
    return sorted(f for f in os.listdir(rec["file_path"]) if f.startswith("part-"))


def test_file_digests_are_those_of_the_files(spark, tmp_path):
    lk, rec = lake(spark, tmp_path)
    want = {}
    for f in data_files(rec):
        raw = open(f"{rec['file_path']}/{f}", "rb").read()
        want[f] = (len(raw), hashlib.sha256(raw).hexdigest())
    got = {r.file: (r.length, r.sha256) for r in lk.files(rec["versioned_key"]).collect()}
    assert got == want and len(got) == 4 and rec["row_count"] == 300
    assert lk.intact("raw/x/dataset") and lk.verify_files("raw/x/dataset").count() == 0


def test_a_changed_byte_is_found_and_named(spark, tmp_path):
    lk, rec = lake(spark, tmp_path)
    first, second, third, _ = data_files(rec)
    path = f"{rec['file_path']}/{first}"
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 1
    open(path, "wb").write(raw)
    os.remove(f"{rec['file_path']}/.{first}.crc")        # the local file system's own checksum, which would not let it be read
    os.remove(f"{rec['file_path']}/{second}")
    open(f"{rec['file_path']}/part-new.parquet", "wb").write(b"x")
    assert {r.file: r.status for r in lk.verify_files("raw/x/dataset").collect()} == {first: "changed", second: "missing", "part-new.parquet": "added"}
    assert not lk.intact("raw/x/dataset")


def test_root_covers_names_and_contents(spark):
    rows = [(f"f{i}", 1, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(500)]

    def root(rows):
        return LK.files_root(spark.createDataFrame(rows, "file string, length long, sha256 string"))
    base = root(rows)
    assert base == root(rows[::-1])
    swapped = [("f0", 1, rows[1][2]), ("f1", 1, rows[0][2]), *rows[2:]]
    assert len({base, root(rows[1:]), root(swapped), root([])}) == 4


def test_profiles_are_taken_in_the_upload(spark, tmp_path):
    lk = LK.Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(1, None, 0.0), (0, "a", 2.0), (0, None, 0.0)], "i int, s string, d double")
    info = lk.upload_raw(df, "src")
    assert info["metadata"]["row_count"] == "3" and info["metadata"]["missing_values"] == '{"i": 0, "s": 2, "d": 0}'
    assert info["hash"] == LK.table_digest(df).first()["digest"]
    done = lk.upload_processed(df, "p")
    assert float(done["metadata"]["sparsity"]) == pytest.approx(LK.processed_profile(df).first()["sparsity"])


# --- R1 ---------------------------------------------------------------------------------

def graph(spark, root, source="v1", k=2, built=None, **versions):
    built = [] if built is None else built

    def made(name, body):
        def build(read):
            built.append(name)
            return body(read)
        return build
    return built, StageGraph(spark, str(root), source, [
        Stage("a", made("a", lambda r: spark.range(10)), version=versions.get("a", 1)),
        Stage("b", made("b", lambda r: r["a"].where(F.col("id") % k == 0)), ("a",), {"k": k}),
        Stage("c", made("c", lambda r: r["a"].limit(3)), ("a",)),
        Stage("d", made("d", lambda r: r["b"].unionAll(r["c"])), ("b", "c"), instead={"b": "a"}),
        Stage("e", made("e", lambda r: r["b"]), ("b",)),
    ])


def test_restart_builds_nothing(spark, tmp_path):
    built, g = graph(spark, tmp_path)
    tables, report = g.run()
    assert report == [("a", "built", 10), ("b", "built", 5), ("c", "built", 3), ("d", "built", 8), ("e", "built", 5)]
    assert tables["d"].count() == 8
    again, g = graph(spark, tmp_path)
    assert g.run()[1] == [(n, "reused", k) for n, _, k in report] and again == []


def test_a_changed_parameter_rebuilds_the_stages_below_alone(spark, tmp_path):
    graph(spark, tmp_path)[1].run()
    built, g = graph(spark, tmp_path, k=5)
    assert g.run()[1][1] == ("b", "built", 2) and built == ["b", "d", "e"]
    built, g = graph(spark, tmp_path)                    # back again: the old tables are still there
    g.run()
    assert built == []


def test_changed_input_or_version_rebuilds_all_that_rests_on_it(spark, tmp_path):
    graph(spark, tmp_path)[1].run()
    built, g = graph(spark, tmp_path, source="v2")
    g.run()
    assert built == ["a", "b", "c", "d", "e"]
    built, g = graph(spark, tmp_path, a=2)
    g.run()
    assert built == ["a", "b", "c", "d", "e"]


def test_skipped_stages(spark, tmp_path):
    built, g = graph(spark, tmp_path)
    assert g.run(skip=("b",))[1] == [("a", "built", 10), ("b", "skipped", 0), ("c", "built", 3), ("d", "built", 13), ("e", "skipped", 0)]
    built, g = graph(spark, tmp_path)
    g.run()
    assert built == ["b", "d", "e"]                      # d rests on other tables now, so it is another table


def test_a_broken_build_is_built_again(spark, tmp_path):
    _, g = graph(spark, tmp_path)
    g.run()
    OB.remove(spark, f"{g.path('c')}/rows")              # the table was written, its end was not
    built, g = graph(spark, tmp_path)
    g.run()
    assert built == ["c"]


def test_stages_must_come_after_what_they_need(spark, tmp_path):
    with pytest.raises(ValueError, match="do not come before"):
        StageGraph(spark, str(tmp_path), "", [Stage("x", lambda r: r["y"], ("y",)), Stage("y", lambda r: spark.range(1))])
