import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators import catalog, logs, marks, quality, sketches, stats
from twinproof.sinks.archive import write_split


def test_row_checks(spark):
    df = spark.createDataFrame([(1, "1", None), (2, "x", "long text"), (2, "99999999999", "ok"), (None, None, "ok")], "k int, n string, t string")
    assert rows(quality.check_not_null(df, ["k", "t"])) == [("k", 1), ("t", 1)]
    assert quality.check_predicate(df, F.col("k") < 2).count() == 2
    assert [r["t"] for r in quality.check_length(df, "t", 4).collect()] == ["long text"]
    assert sorted(r["n"] for r in quality.check_castable(df, "n", "int").collect()) == ["99999999999", "x"]
    assert [r["n"] for r in quality.check_castable(df, "n", "bigint").collect()] == ["x"]
    assert rows(quality.check_unique(df, ["k"])) == [(2, 2)]


TEXTS = ["0", "-5", "+7", " 8 ", "12.5", "", " ", "1e3", "abc", "2147483647", "2147483648", "-2147483648", "-2147483649",
         "9223372036854775807", "9223372036854775808", "0000000000000000000000000000000000000000000000012", "9" * 60, "٣", "--1", "+"]


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "date", "double"])
def test_castable_agrees_with_try_cast(spark, kind):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r["t"] for r in quality.check_castable(df, "t", kind).collect()}
    want = {r["t"] for r in df.filter(F.col("t").try_cast(kind).isNull()).collect()}
    assert got == want


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(quality.check_foreign_key(child, parent, [("p", "id")])) == [(9, 3)]


def test_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "1", 5), (2, None, 5), (3, "x", 5), (3, "4", 7), (4, "8", None)], "k int, n string, p int")
    parent = spark.createDataFrame([(5,)], "id int")
    rules = [quality.not_null("n"), quality.castable("n", "int"), quality.predicate("k", F.col("k") < 4)]
    keys = {"unique": [["k"]], "foreign": [(parent, [("p", "id")])]}
    good, bad = quality.split_valid(df, rules, **keys)
    assert rows(good) == [(1, "1", 5)]
    assert {(r["k"], r["n"]): r["violations"] for r in bad.collect()} == {
        (2, None): ["not-null:n"],
        (3, "x"): ["invalid-int:n", "unique:k"],
        (3, "4"): ["unique:k", "foreign-key:p"],
        (4, "8"): ["check:k"],
    }
    tagged = quality.tag_violations(df, rules, **keys)
    assert tagged.count() == 5
    write_split(tagged, str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split")).filter("quarantined = 'true'").count() == 4
    strict, _ = quality.split_valid(df, rules, tolerate=False, **keys)
    with pytest.raises(PySparkException, match="row breaks"):
        strict.collect()
    assert quality.split_valid(df.filter("k = 1"), rules, tolerate=False)[0].count() == 1


def test_missing_objects(spark):
    a, b = spark.range(1), spark.range(1).withColumn("v", F.lit("x"))
    source = catalog.catalog_columns(spark, {("s", "same"): a, ("s", "gone"): b, ("s", "narrow"): b, ("s", "typed"): a})
    target = catalog.catalog_columns(spark, {("s", "same"): a, ("s", "narrow"): a, ("s", "typed"): a.select(F.col("id").cast("int"))})
    assert rows(catalog.missing_objects(source, target)) == [
        ("s", "gone", None, "missing-table", True),
        ("s", "narrow", "v", "missing-column", True),
        ("s", "typed", "id", "type-change", True),
    ]
    assert not catalog.missing_objects(source, target, tolerate=True).filter("fatal").count()


E = "pg_restore: error: "


def restore(spark, lines):
    return spark.createDataFrame([("l", i, text) for i, text in enumerate(lines)], "log_id string, line_no bigint, line string")


def test_error_summary(spark):
    lines = [f"{E}must be owner of {i}" for i in range(7)] + [f"{E}ERROR:  COPY t, line 1", "pg_restore: processing", "pg_restore: warning: errors ignored on restore: 3",
             "pg_restore: warning: errors ignored on restore: 16"]
    log = restore(spark, lines)
    assert rows(logs.summarise_errors(log)) == [("l", "data-loss", 1), ("l", "privilege", 7), ("l", "total", 8)]
    samples = logs.error_samples(log).filter("category = 'privilege'").orderBy("nth").collect()
    assert [r["message"] for r in samples] == [f"must be owner of {i}" for i in range(5)]
    assert tuple(logs.restore_verdict(log).first()) == ("l", 8, 1, 16, "REVIEW REQUIRED")
    assert logs.restore_verdict(restore(spark, lines[:7])).first()["verdict"] == "likely safe"
    assert logs.restore_verdict(restore(spark, lines[8:])).first()["verdict"] == "no errors captured"
    ordered = logs.order_by_severity(logs.summarise_errors(log).filter("category <> 'total'"))
    assert [r["category"] for r in ordered.collect()] == ["data-loss", "privilege"]
    plan = logs.error_samples(log)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stage_times(spark):
    data = [("r", 0, "Validate"), ("r", 2, "Dump"), ("r", 3, "Dump"), ("r", 10, "CaughtUp"), ("r", 14, "CaughtUp")]
    df = spark.createDataFrame(data, "run_id string, s int, stage string")
    df = df.withColumn("ts", F.expr("timestampadd(SECOND, s, timestamp_ntz'2024-01-01 00:00:00')"))
    got = [(r["stage"], r["events"], r["seconds"]) for r in logs.stage_timeline(df).orderBy("started").collect()]
    assert got == [("Validate", 1, 2.0), ("Dump", 2, 8.0), ("CaughtUp", 2, 4.0)]
    assert tuple(logs.caught_up_time(df).first()) == ("r", 10.0, 14.0)
    assert tuple(logs.caught_up_time(df.filter("stage = 'Dump'")).first()) == ("r", None, None)


def test_heartbeats_by_position(spark):
    rng = random.Random(3)
    beats = [(log, line, line * 10, line * 10 - rng.randint(0, 60)) for log in ("a", "b") for line in sorted(rng.sample(range(400), 120))]
    marks = [(rng.choice(["a", "b", "none"]), rng.randint(0, 420), rng.randint(0, 4300)) for _ in range(150)]
    b = spark.createDataFrame(beats, "log_id string, line_no bigint, source_lsn bigint, applied_lsn bigint")
    m = spark.createDataFrame(marks, "log_id string, line_no bigint, target_lsn bigint")

    as_of = {(r["log_id"], r["line_no"]): r["beat_line"] for r in logs.heartbeat_as_of(b, m, chunk=16).collect()}
    assert as_of == {(g, n): max((x[1] for x in beats if x[0] == g and x[1] <= n), default=None) for g, n, _ in marks}

    want = {(g, n, t): min((x[1] for x in beats if x[0] == g and x[1] > n and x[3] >= t), default=None) for g, n, t in marks}
    for bits in (1, 2, 3, 8):
        got = logs.first_reaching(b, m, bits).collect()
        assert {(r["log_id"], r["line_no"], r["target_lsn"]): r["reached_line"] for r in got} == want


def test_first_reaching_at_the_edges(spark):
    beats = [("a", 0, 5), ("a", 7, 5), ("a", 8, 9), ("a", 1 << 20, 20), ("b", 3, None)]
    marks = [("a", -1, 5), ("a", 0, 5), ("a", 7, 5), ("a", 8, 9), ("a", 8, 21), ("a", 1 << 20, 1), ("a", 1 << 40, 1), ("b", 0, 0), ("c", 0, 0), (None, 0, 0), ("a", None, 0), ("a", 0, None), ("a", 0, 5)]
    b = spark.createDataFrame([(g, n, x) for g, n, x in beats], "log_id string, line_no bigint, applied_lsn bigint")
    m = spark.createDataFrame(marks, "log_id string, line_no bigint, target_lsn bigint")
    fits = lambda x, g, n, t: None not in (g, n, t, x[2]) and x[0] == g and x[1] > n and x[2] >= t
    want = {k: min(((x[1], x[2]) for x in beats if fits(x, *k)), default=(None, None)) for k in marks}
    for bits in (2, 4, 8, 21):
        got = logs.first_reaching(b, m, bits).collect()
        assert len(got) == len(want) and {(r["log_id"], r["line_no"], r["target_lsn"]): (r["reached_line"], r["reached_lsn"]) for r in got} == want
    assert logs.first_reaching(b.limit(0), m).filter("reached_line IS NOT NULL").count() == 0
    assert logs.first_reaching(b, m.limit(0)).count() == 0


def test_first_reaching_moves_open_marks_only(spark, tmp_path):
    """Few exchanges, all by log and block; none by a key that is NULL for the marks that are answered."""
    spark.range(1 << 18).selectExpr("'a' AS log_id", "id AS line_no", "id AS applied_lsn").write.parquet(f"{tmp_path}/b")
    # a mark in a thousand is answered past its block
    spark.range(1 << 18).selectExpr("'a' AS log_id", "id AS line_no", "id + if(id % 1000 = 0, 5000, 1) AS target_lsn").write.parquet(f"{tmp_path}/m")
    df = logs.first_reaching(spark.read.parquet(f"{tmp_path}/b"), spark.read.parquet(f"{tmp_path}/m"))
    df.filter("reached_line IS NOT NULL").agg(F.sum("reached_line")).collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
    read = spark.read.parquet(f"{tmp_path}/b")
    blocks = logs._blocks(read, 8)
    assert len(blocks) == 3 and [x.count() for x in blocks] == [1024, 4, 1]
    assert blocks[2].select(F.size("_kids")).first()[0] == 4
    got = df.selectExpr("count(reached_line)", "sum(reached_line - target_lsn)", "count_if(reached_line IS NULL)").first()
    late = sum(1 for i in range(1 << 18) if i + (5000 if i % 1000 == 0 else 1) >= 1 << 18)
    assert tuple(got) == ((1 << 18) - late, 0, late)


def test_heartbeats_from_text(spark):
    line = "replication lag 5 bytes, source LSN 105 [0/69], received LSN 100 [0/64], applied LSN 100 [0/64]"
    log = restore(spark, [line, "something else"])
    assert [(r["line_no"], int(r["source_lsn"]), int(r["applied_lsn"])) for r in logs.heartbeats(log).collect()] == [(0, 105, 100)]


def test_common_and_missing_keys_are_spread(spark):
    """A third of the rows has one valid key, a third a repeated and unknown one, a sixth none; no task of the joins gets them all."""
    n = 60000
    key = "CASE WHEN id % 6 < 2 THEN 1 WHEN id % 6 < 4 THEN 2 WHEN id % 6 = 4 THEN NULL ELSE id END"
    df = spark.range(n).selectExpr("id", f"{key} AS k")
    parent = spark.createDataFrame([(1,)], "k bigint").unionByName(spark.range(n).selectExpr("id AS k").filter("k % 4 = 1"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        tagged = quality.tag_violations(df, unique=[["k"]], foreign=[(parent, [("k", "k")])])
        # the names are read too, or the joins would be left out
        sizes = [r["n"] for r in tagged.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("violations"))).collect()]
        got = {(r["kind"], *r["violations"]): r["n"] for r in tagged.groupBy(F.expr("CASE WHEN k IS NULL THEN 0 WHEN k < 3 THEN k ELSE 3 END AS kind"), "violations").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(sizes) == 8 and sum(sizes) == n and max(sizes) < n / 4
    assert got == {(0,): n // 6, (1, "unique:k"): n // 3, (2, "unique:k", "foreign-key:k"): n // 3, (3,): n // 12, (3, "foreign-key:k"): n // 12}


def test_one_shuffle_for_all_tables(spark):
    tables = {("s", f"t{i}"): spark.range(i).selectExpr("id", "repeat('x', cast(id as int)) AS t") for i in range(6)}
    for df in (marks.max_key(tables, dict.fromkeys(tables, "id")), stats.db_size(tables)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(_at") <= 2  # the tables' rows, and the short list of names
    assert [r["last_value"] for r in marks.max_key(tables, dict.fromkeys(tables, "id")).orderBy("name").collect()] == [None, 0, 1, 2, 3, 4]
    assert {r["table_name"]: r["rows"] for r in stats.db_size(tables).collect() if r["table_name"]} == {f"t{i}": i for i in range(6)}


def test_exact_distinct_without_expand(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.0, [1, 2], None), (1, "A", -0.0, [1, 2], None), (2, None, float("nan"), [2, 1], None), (None, "a", float("nan"), None, None)],
        "k bigint, t string, d double, a array<int>, n string",
    )
    got = {r["column_name"]: r["ndv"] for r in stats.distinct_counts(df).collect()}
    assert got == {"k": 2, "t": 2, "d": 2, "a": 2, "n": 0}
    plan = stats.table_stats(df, ["k", "t"], exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_profiles_of_parts_add_up(spark, tmp_path):
    df = spark.range(20000).selectExpr(
        "id", "cast(id % 700 as int) AS few", "concat('t', id % 5000) AS text", "IF(id % 3 = 0, NULL, id / 7.0) AS d", "date_add(DATE '2024-01-01', cast(id % 90 as int)) AS day",
        "array(cast(id % 10 as int)) AS a", "cast(NULL AS string) AS nothing",
    )
    path = str(tmp_path / "profile")
    parts = [df.filter("id < 1500"), df.filter("id >= 1500 AND id < 9000"), df.filter("id >= 9000"), df.filter("false")]
    for i, part in enumerate(parts):
        sketches.store(part, path, f"p{i}")
    sketches.store(parts[1], path, "p1")  # again: no double
    got = {r["column_name"]: r for r in sketches.stored(spark, path, df.schema).collect()}
    for r in stats.table_stats(df, [c for c in df.columns if c != "a"], exact=True).collect():
        have = got[r["column_name"]]
        for c in ("rows", "nulls", "min_value", "max_value", "max_width"):
            assert have[c] == r[c], (r["column_name"], c)
        assert abs(have["ndv"] - r["ndv"]) <= 0.06 * r["ndv"]
        assert have["avg_width"] == pytest.approx(r["avg_width"])
    assert got["a"]["ndv"] == 10 and got["nothing"]["ndv"] == 0 and got["text"]["quantiles"] is None
    assert [abs(q - 20000 * p) < 20000 * 0.03 for q, p in zip(got["id"]["quantiles"], sketches.QUANTILES)] == [True] * 3
    # a top-up reads its own rows only
    files = sketches.stored(spark, path, df.schema).inputFiles()
    assert files and all(f"{path}/part=" in f for f in files)


def test_stats(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "ccc")], "k bigint, t string")
    for exact in (True, False):
        got = {r["column_name"]: r for r in stats.table_stats(df, exact=exact).collect()}
        assert (got["k"]["rows"], got["k"]["nulls"], got["k"]["ndv"], got["k"]["min_value"], got["k"]["max_value"]) == (3, 0, 2, "1", "2")
        assert (got["t"]["nulls"], got["t"]["ndv"], got["t"]["max_width"], got["t"]["avg_width"]) == (1, 2, 3, 2.0)
    assert rows(stats.db_size({("s", "t"): df})) == [("s", "t", 3, 28), ("s", None, 3, 28), (None, None, 3, 28)]
    runs = spark.createDataFrame([("a", 11 * 2**30, 240.0), ("b", 2**30, None)], "run_id string, bytes bigint, seconds double")
    assert [(r["gb_per_min"], r["label"]) for r in stats.throughput(runs).orderBy("run_id").collect()] == [(2.75, "2.75 GB/min"), (None, "-")]
