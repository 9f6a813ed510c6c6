import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators import maintain, quality
from twinproof.operators.content import content_hash
from twinproof.operators.logs import stage_timeline
from twinproof.operators.scope import Scope
from twinproof.plans import copy as copying
from twinproof.plans.offline import Checks, copy_offline, run_offline
from twinproof.plans.verify import VerifyFailed
from twinproof.sinks.archive import load_table, parse_compression, write_archive
from twinproof.sources import generate, snapshot
from twinproof.sources.logs import read_bad_progress, read_progress, read_restore_log


@pytest.mark.parametrize(
    "spec, parsed",
    [(None, None), ("none", ("none", None)), ("0", ("none", None)), ("6", ("gzip", 6)), ("gzip:9", ("gzip", 9)), ("lz4:1", ("lz4", 1)), ("zstd", ("zstd", None)), ("zstd:3", ("zstd", 3))],
)
def test_compression_spec(spec, parsed):
    assert parse_compression(spec) == parsed


@pytest.mark.parametrize("spec", ["brotli", "zstd:99", "gzip:x", "none:1"])
def test_bad_compression(spec):
    with pytest.raises(ValueError):
        parse_compression(spec)


@pytest.mark.parametrize("spec", [None, "none", "gzip:9", "1", "lz4", "zstd:3"])
def test_archive_round_trip(spark, tmp_path, spec):
    df = spark.range(1000).withColumn("v", F.md5(F.col("id").cast("string")))
    path = str(tmp_path / "t")
    write_archive(df, path, spec)
    assert spark.read.parquet(path).exceptAll(df).count() == 0
    load_table(df, path)
    assert spark.read.parquet(path).count() == 2000
    load_table(df, path, replace=True)
    assert spark.read.parquet(path).count() == 1000


def tables(spark):
    return {("app", "a"): spark.range(10), ("app", "b"): spark.range(0), ("pg", "c"): spark.range(5)}


def test_copy_and_resume(spark, tmp_path):
    target, source = str(tmp_path / "out"), tables(spark)

    class Lost(Exception):
        pass

    def lose():
        raise Lost

    broken = dict(source)
    broken["app", "b"] = property(lose)  # a table that cannot be written
    with pytest.raises(Exception):
        copying.copy_tables(spark, broken, "src", target, jobs=1)
    done = {r["table_name"] for r in copying.read_manifest(spark, target).collect()}
    assert "b" not in done
    manifest = copying.copy_tables(spark, source, "src", target, resume=True)
    assert rows(manifest.select("schema_name", "table_name", "state", "rows")) == [("app", "a", "done", 10), ("app", "b", "done", 0), ("pg", "c", "done", 5)]
    assert copying.pending_tables(spark, list(source), manifest).count() == 0
    with pytest.raises(copying.ResumeRefused):
        copying.copy_tables(spark, source, "src", target, Scope(exclude_schemas=["pg"]), resume=True)
    with pytest.raises(copying.ResumeRefused):
        copying.copy_tables(spark, source, "elsewhere", target, resume=True)


@pytest.mark.parametrize("what", ["all", "data-only"])
@pytest.mark.parametrize("jobs", [1, 3])
def test_resume_after_a_table_failed_part_way(spark, tmp_path, what, jobs):
    target = str(tmp_path / "out")
    source = {("app", n): spark.range(1000, numPartitions=4).withColumn("v", F.lit(n)) for n in "abc"}
    broken = dict(source)
    late = F.when(F.col("id") > 900, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    broken["app", "b"] = source["app", "b"].withColumn("v", late.cast("string"))
    with pytest.raises(Exception, match="lost"):
        copying.copy_tables(spark, broken, "src", target, Scope(what=what), jobs=jobs)
    assert {r["table_name"] for r in copying.read_manifest(spark, target).collect()} == {"a", "c"}
    for _ in range(2):
        manifest = copying.copy_tables(spark, source, "src", target, Scope(what=what), jobs=jobs, resume=True)
    assert rows(manifest.select("table_name", "rows")) == [("a", 1000), ("b", 1000), ("c", 1000)]
    for name, df in copying.copied_tables(spark, target, list(source)).items():
        digest = lambda x: content_hash(x, ["id"], ["id", "v"]).first()
        assert digest(df) == digest(source[name])


def test_added_rows_moved_but_not_noted_are_not_doubled(spark, tmp_path):
    target, source = str(tmp_path / "out"), {("app", "a"): spark.range(10)}
    source["app", "a"].write.parquet(copying.table_path(target, "app", "a"))
    for _ in range(2):  # the second as if the note of the first was lost
        copying.copy_tables(spark, source, "s", target, Scope(what="data-only"))
    assert spark.read.parquet(copying.table_path(target, "app", "a")).count() == 20


def test_resume_at_another_cut_is_refused(spark, tmp_path):
    source = {("app", "a"): spark.range(10).withColumnRenamed("id", "lsn")}
    copying.copy_tables(spark, source, "s", str(tmp_path), cut_lsn=3)
    with pytest.raises(copying.ResumeRefused):
        copying.copy_tables(spark, source, "s", str(tmp_path), cut_lsn=7, resume=True)


@pytest.mark.parametrize("moved", [False, True])
def test_killed_between_move_and_note(spark, tmp_path, monkeypatch, moved):
    """Nothing is noted yet, but whose rows these are is known: no other cut can be mixed in, and the same one ends as if never killed."""
    source, target, data = {("app", "a"): spark.range(10).selectExpr("id AS lsn", "id AS k")}, str(tmp_path / "out"), Scope(what="data-only")
    spark.range(100, 103).selectExpr("id AS lsn", "id AS k").write.parquet(copying.table_path(target, "app", "a"))
    move = copying.move_files

    def killed(*args):
        if moved:
            move(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(copying, "move_files", killed)
    with pytest.raises(KeyboardInterrupt):
        copying.copy_tables(spark, source, "s", target, data, cut_lsn=4)
    monkeypatch.setattr(copying, "move_files", move)
    assert copying.read_manifest(spark, target).count() == 0
    for resume in (True, False):
        with pytest.raises(copying.ResumeRefused):
            copying.copy_tables(spark, source, "s", target, data, cut_lsn=7, resume=resume)
    manifest = copying.copy_tables(spark, source, "s", target, data, cut_lsn=4, resume=True)
    assert [(r["table_name"], r["rows"]) for r in manifest.collect()] == [("a", 5)]
    read = spark.read.parquet(copying.table_path(target, "app", "a"))
    assert sorted(r["k"] for r in read.collect()) == [0, 1, 2, 3, 4, 100, 101, 102]
    # a copy that ended leaves nothing that keeps the next one out
    copying.copy_tables(spark, source, "s", target, data, cut_lsn=7)
    assert spark.read.parquet(copying.table_path(target, "app", "a")).count() == 16


def test_killed_before_the_first_table(spark, tmp_path, monkeypatch):
    source, target = {("app", "a"): spark.range(10).withColumnRenamed("id", "lsn")}, str(tmp_path / "out")
    monkeypatch.setattr(copying, "_copy_one", lambda *args: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        copying.copy_tables(spark, source, "s", target, cut_lsn=4)
    monkeypatch.undo()
    with pytest.raises(copying.ResumeRefused):
        copying.copy_tables(spark, source, "s", target, cut_lsn=7, resume=True)
    assert copying.copy_tables(spark, source, "s", target, cut_lsn=4, resume=True).select("rows").first()[0] == 5


def test_copies_are_verified_at_their_cut(spark, tmp_path):
    source = {("app", "a"): spark.range(10).selectExpr("id AS lsn", "id AS k"), ("app", "fixed"): spark.range(3).withColumnRenamed("id", "k")}
    cut = {"cut_lsn": 4, "immutable": [("app", "fixed")]}
    manifest, report = copy_offline(spark, source, "s", str(tmp_path / "one"), mode="strict", **cut)
    assert rows(report.select("table_name", "source", "target")) == [("a", 5, 5), ("fixed", 3, 3)]
    checks = {name: Checks(["k"]) for name in source}
    for mode in ("strict", "off"):
        report = run_offline(spark, source, "s", str(tmp_path / mode), checks, mode=mode, **cut)
        assert rows(report.select("table_name", "source", "target", "broken", "analyzed", "equal")) == [("a", 5, 5, 0, True, True), ("fixed", 3, 3, 0, True, True)]
    spark.range(9, 10).selectExpr("id AS lsn", "id AS k").write.mode("append").parquet(copying.table_path(str(tmp_path / "one"), "app", "a"))
    with pytest.raises(VerifyFailed):
        copy_offline(spark, source, "s", str(tmp_path / "one"), mode="strict", resume=True, **cut)


def test_whole_run_with_any_names(spark, tmp_path):
    names = [("ten.ant", "t"), ("public", "Orders"), ("public", "order's"), ("a__b", "c"), ("a", "b__c")]
    source = {n: spark.range(i + 2).withColumnRenamed("id", "k") for i, n in enumerate(names)}
    report = run_offline(spark, source, "s", str(tmp_path), {n: Checks(["k"]) for n in names})
    got = {(r["schema_name"], r["table_name"]): (r["source"], r["target"], r["broken"], r["analyzed"], r["equal"]) for r in report.collect()}
    assert got == {n: (i + 2, i + 2, 0, True, True) for i, n in enumerate(names)}


def test_offline_copy_is_verified(spark, tmp_path):
    manifest, report = copy_offline(spark, tables(spark), "s", str(tmp_path / "a"), Scope(schemas=["app"]), mode="strict")
    assert manifest.count() == 2 and rows(report) == [("app", "a", 10, 10), ("app", "b", 0, 0)]
    assert copy_offline(spark, tables(spark), "s", str(tmp_path / "b"), Scope(what="schema-only"))[1] is None


def test_fingerprint_ignores_order_and_sees_excludes():
    a = copying.fingerprint("s", "t", Scope(schemas=["x", "y"], tables=[("p", "q"), ("a", "b")]))
    assert a == copying.fingerprint("s", "t", Scope(schemas=["y", "x"], tables=[("a", "b"), ("p", "q")]))
    assert a != copying.fingerprint("s", "t", Scope(schemas=["x", "y"], tables=[("p", "q"), ("a", "b")], exclude_tables=[("x", "z")]))
    assert a != copying.fingerprint("s", "t", Scope(schemas=["x", "y"], tables=[("p", "q"), ("a", "b")], what="data-only"))


def test_copy_kinds_and_scope(spark, tmp_path):
    target, source = str(tmp_path / "out"), tables(spark)
    only = Scope(schemas=["app"], what="schema-only")
    assert rows(copying.copy_tables(spark, source, "s", target, only).select("table_name", "rows")) == [("a", 0), ("b", 0)]
    copied = copying.copied_tables(spark, target, [("app", "a")])["app", "a"]
    assert copied.count() == 0 and copied.columns == ["id"]
    copying.copy_tables(spark, source, "s", target, Scope(schemas=["app"], what="data-only"))
    assert copying.copied_tables(spark, target, [("app", "a")])["app", "a"].count() == 10


def test_sections(spark, tmp_path):
    df = spark.createDataFrame([(2, "x"), (1, None), (2, "y")], "k int, v string")
    path = str(tmp_path / "t")
    report = copying.copy_in_sections(df, path, keys=["k"], rules=[quality.not_null("v")], cluster=True)
    assert rows(report) == [("not-null:v", 1), ("unique:k", 2)]
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError, match="unique:k"):
        copying.copy_in_sections(df, path, keys=["k"], tolerate=False)


def test_clustering_splits_a_key_that_repeats(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(7).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = copying.cluster_rows(df, ["k"]).select("k", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.createDataFrame(placed, "k bigint, p int")
    assert parts.count() == 4000
    assert parts.filter("k = 7").select("p").distinct().count() > 1
    ranges = parts.filter("k <> 7").groupBy("p").agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))


def test_snapshot_cut(spark):
    log = spark.createDataFrame([(1, "a"), (5, "b"), (6, "c")], "lsn bigint, v string")
    both = {("s", "log"): log, ("s", "plain"): spark.range(2)}
    with pytest.raises(ValueError, match="s.plain"):
        snapshot.read_snapshot(both, Scope(schemas=["s"]), cut_lsn=5)
    with pytest.raises(ValueError, match="split column"):
        snapshot.jdbc_options("jdbc:x", "t", "id")
    got = snapshot.read_snapshot(both, Scope(schemas=["s"]), cut_lsn=5, immutable=[("s", "plain")])
    assert got["s", "log"].count() == 2 and got["s", "plain"].count() == 2
    assert snapshot.jdbc_options("jdbc:x", "t", "id", 0, 9, 3)["numPartitions"] == "3"
    assert "partitionColumn" not in snapshot.jdbc_options("jdbc:x", "t")


def test_generators(spark):
    made = generate.generate_benchmark(spark, 100, 3)
    assert list(made) == ["benchmark_data_01", "benchmark_data_02", "benchmark_data_03"]
    one = made["benchmark_data_01"]
    assert one.count() == 33 and one.filter(F.length("payload") != 992).count() == 0
    assert one.exceptAll(generate.generate_benchmark(spark, 100, 3)["benchmark_data_01"]).count() == 0
    assert one.filter((F.col("val") < 0) | (F.col("val") >= 1)).count() == 0
    full = generate.topped_up(one, "benchmark_data_01", 50)
    assert full.count() == 50 and full.agg(F.max("id")).first()[0] == 50
    assert full.exceptAll(generate.benchmark_table(spark, "benchmark_data_01", 1, 50)).count() == 0
    assert generate.top_up(full, "benchmark_data_01", 50).count() == 0
    assert generate.top_up(one.limit(0), "benchmark_data_01", 3).agg(F.min("id")).first()[0] == 1


def test_restore_log_lines_in_order(spark, tmp_path):
    for name, n in (("one.log", 3000), ("two.log", 10)):
        (tmp_path / name).write_text("\n".join(f"{name} line {i}" for i in range(n)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # several tasks per file
    try:
        got = read_restore_log(spark, str(tmp_path)).orderBy("log_id", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["line"] for r in got] == [f"one.log line {i}" for i in range(3000)] + [f"two.log line {i}" for i in range(10)]
    assert len({(r["log_id"], r["line_no"]) for r in got}) == 3010


def test_progress_log(spark, tmp_path):
    events = [
        {"stage": "Validate", "message": "m", "detail": None},
        {"stage": "Lag", "message": "m", "detail": {"lag_bytes": 5, "source_lsn": 2**64 - 1, "engine": "native"}},
    ]
    (tmp_path / "run.json").write_text("\n".join(map(json.dumps, events)) + "\nnot json\n")
    got = read_progress(spark, str(tmp_path)).orderBy("stage").collect()
    assert [r["stage"] for r in got] == ["Lag", "Validate"]
    assert int(got[0]["detail"]["source_lsn"]) == 2**64 - 1 and got[0]["run_id"].endswith("run.json") and got[0]["ts"] is None
    assert [r["line"] for r in read_bad_progress(spark, str(tmp_path)).collect()] == ["not json"]
    order = stage_timeline(read_progress(spark, str(tmp_path)).withColumn("run_id", F.lit("r"))).collect()
    assert [(r["stage"], r["seconds"]) for r in order] == [("Validate", None), ("Lag", None)]


def test_analyze_goes_on_after_a_failure(spark, tmp_path):
    for name in ("good_t", "bad_t"):
        spark.range(5).write.parquet(str(tmp_path / name))
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{tmp_path / name}'")
    spark.sql("CREATE VIEW view_t AS SELECT 1 AS x")
    found = snapshot.catalog_tables(spark, Scope(tables=[("default", "good_t")]))
    assert [n for n in found] == [("default", "good_t")] and found["default", "good_t"].count() == 5
    report = {r["table_name"]: r["status"] for r in maintain.analyze_all(spark, Scope(schemas=["default"])).collect()}
    assert report["good_t"] == "analyzed" and report["view_t"] == "failed"
    for name in ("good_t", "bad_t"):
        spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP VIEW view_t")
