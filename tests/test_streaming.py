import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_changes import START, log, replay, table
from twinproof.operators import changes as c
from twinproof.operators.lag import lag_states
from twinproof.operators.scope import Scope
from twinproof.plans.online import copy_online
from twinproof.sources.changes import change_schema, read_changes
from twinproof.sources.logs import LAG_SCHEMA, read_lag_samples
from twinproof.streaming.apply import apply_stream
from twinproof.streaming.cutover import NotConverged, cutover, drain_and_stop, run_for
from twinproof.streaming.lag_monitor import lag_monitor, progress_events, read_states
from twinproof.streaming.target import KeyedTable, LostBatch, TargetMismatch


def make_records(n, seed=1):
    rng = random.Random(seed)
    return [(100 + i // 3, i % 3, rng.choice("IUD"), str(rng.randint(0, 12)), rng.randint(0, 99)) for i in range(n)]


def start(spark, path, buckets=4):
    target = KeyedTable(f"{path}/target", ["id"], table(spark, START).schema, buckets)
    target.create(table(spark, START), c.cut_position(log(spark, []), 99))
    return target


def put(spark, path, records):
    log(spark, records).coalesce(1).write.mode("append").parquet(f"{path}/changes")


def stream(spark, path):
    return read_changes(spark, f"{path}/changes", log(spark, []).schema, files_per_batch=1)


def test_restarts_late_files_and_compaction(spark, tmp_path):
    """Three runs from one checkpoint, files out of order, compaction in between: the state of the replay."""
    records = make_records(60)
    target = start(spark, tmp_path)
    pieces = [records[40:], records[:20], records[20:40]]
    seen = []
    for i, piece in enumerate(pieces):
        put(spark, tmp_path, piece)
        seen += piece
        apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99).awaitTermination()
        assert rows(target.read(spark)) == replay(START, seen)
        if i < 2:
            target.compact(spark)
            assert rows(target.read(spark)) == replay(START, seen)
    assert target.compact(spark, safe_position=2**62)
    assert rows(target.read(spark)) == replay(START, records)
    assert target.state(spark).filter("_deleted").count() == 0
    assert target.drop_superseded(spark)
    assert rows(target.read(spark)) == replay(START, records)
    assert target.compact(spark) == []  # nothing new


def test_new_checkpoint_and_replayed_batches_change_nothing(spark, tmp_path):
    records = make_records(30, 2)
    target = start(spark, tmp_path)
    for piece in (records[:15], records[15:]):
        put(spark, tmp_path, piece)
    apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp1", cut_lsn=99).awaitTermination()
    target.compact(spark)
    apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp2", cut_lsn=99).awaitTermination()
    assert rows(target.read(spark)) == replay(START, records)
    delta = c.changes_as_delta(log(spark, records[:15]), ["id"], ["id", "name", "qty"])
    target.put_batch(delta, 0)
    target.put_batch(delta, 0, run="other")
    assert rows(target.read(spark)) == replay(START, records)


def test_failed_batch_is_taken_up_again(spark, tmp_path):
    records = make_records(30, 3)
    target = start(spark, tmp_path)
    put(spark, tmp_path, records[:15])
    put(spark, tmp_path, records[15:])
    whole, calls = target.put_batch, []

    def failing(delta, batch_id, run=""):
        whole(delta, batch_id, run)
        calls.append(batch_id)
        if batch_id == 1 and calls.count(1) == 1:
            raise RuntimeError("lost after the write, before the checkpoint")

    target.put_batch = failing
    with pytest.raises(Exception):
        apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99).awaitTermination()
    apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99).awaitTermination()
    assert calls == [0, 1, 1]
    assert rows(target.read(spark)) == replay(START, records)


def test_cut_and_scope_hold_on_the_stream(spark, tmp_path):
    records = make_records(30, 4)
    target = start(spark, tmp_path)
    put(spark, tmp_path, records)
    apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=104).awaitTermination()
    assert rows(target.read(spark)) == replay(START, [r for r in records if r[0] > 104])
    other = start(spark, tmp_path / "o")
    apply_stream(stream(spark, tmp_path), other, f"{tmp_path}/cp2", cut_lsn=99, scope=Scope(exclude_schemas=["app"])).awaitTermination()
    assert rows(other.read(spark)) == replay(START, [])


def test_compaction_touches_changed_buckets_only(spark, tmp_path):
    target = KeyedTable(f"{tmp_path}/t", ["id"], table(spark, START).schema, buckets=64)
    target.create(table(spark, START), c.cut_position(log(spark, []), 99))
    delta = c.changes_as_delta(log(spark, [(200, 0, "U", "3", 7)]), ["id"], ["id", "name", "qty"])
    target.put_batch(delta, 0)
    assert len(target.compact(spark)) == 1
    assert rows(target.read(spark)) == replay(START, [(200, 0, "U", "3", 7)])
    with pytest.raises(ValueError):
        KeyedTable("x", ["id"], target.schema, buckets=0)


def test_batches_of_every_run_outlive_compaction(spark, tmp_path):
    records = make_records(60, 7)
    target, cp = start(spark, tmp_path), f"{tmp_path}/cp"
    for i, checkpoint in enumerate([cp + "1", cp + "2", cp + "1", cp + "2"]):  # two feeds in turn, folded after each
        put(spark, f"{tmp_path}/{checkpoint[-1]}", records[i * 15 : i * 15 + 15])
        apply_stream(stream(spark, f"{tmp_path}/{checkpoint[-1]}"), target, checkpoint, cut_lsn=99).awaitTermination()
        target.compact(spark)
        assert rows(target.read(spark)) == replay(START, records[: i * 15 + 15])


def test_a_batch_that_would_be_lost_is_refused(spark, tmp_path):
    target = start(spark, tmp_path)
    one = c.changes_as_delta(log(spark, [(200, 0, "U", "3", 7)]), ["id"], ["id", "name", "qty"])
    target.put_batch(one, 5)
    target.compact(spark)
    target.put_batch(one, 5)  # again, as after a lost commit of the checkpoint
    with pytest.raises(LostBatch):
        target.put_batch(c.changes_as_delta(log(spark, [(201, 0, "U", "3", 8)]), ["id"], ["id", "name", "qty"]), 4)
    assert rows(target.read(spark)) == replay(START, [(200, 0, "U", "3", 7)])


def test_table_checkpoint_and_cut_belong_together(spark, tmp_path):
    target = start(spark, tmp_path)
    put(spark, tmp_path, make_records(6))
    apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99).awaitTermination()
    with pytest.raises(TargetMismatch):
        target.create(table(spark, START), c.cut_position(log(spark, []), 99))
    target.create(table(spark, START), c.cut_position(log(spark, []), 99), replace=True)
    with pytest.raises(TargetMismatch):
        apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99)
    with pytest.raises(TargetMismatch):
        copy_online(table(spark, START), stream(spark, tmp_path), target, f"{tmp_path}/cp3", cut_lsn=98, source_now=lambda: None, cols=["id"])


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["_write_base", "_commit", "bind", "put_batch", "compact"])
@pytest.mark.parametrize("after", [False, True])
def test_online_copy_killed_anywhere_goes_on(spark, tmp_path, step, after):
    records = make_records(40, 8)
    for i in range(0, 20, 10):
        put(spark, tmp_path, records[i : i + 10])
    snapshot = table(spark, START)
    seen = {"n": 20}

    def run(target):
        now = lambda: c.apply_changes(snapshot, log(spark, records[: seen["n"]]), ["id"])
        return copy_online(
            snapshot, stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99, source_at=lambda _: now(), cols=snapshot.columns, fold_every=2
        )

    fresh = lambda: KeyedTable(f"{tmp_path}/target", ["id"], snapshot.schema, 4)
    hurt = fresh()
    whole = getattr(hurt, step)

    def killed(*args, **kwargs):
        if after:
            whole(*args, **kwargs)
        raise Killed(step)

    setattr(hurt, step, killed)
    with pytest.raises(Exception, match=step):
        run(hurt)
    assert run(fresh()).converged
    assert rows(fresh().read(spark)) == replay(START, records[:20])
    fresh().compact(spark)
    put(spark, tmp_path, records[20:])
    seen["n"] = 40
    assert run(fresh()).converged
    assert rows(fresh().read(spark)) == replay(START, records)


def test_online_copy_ends_while_changes_keep_arriving(spark, tmp_path):
    records = sorted(make_records(60, 10))
    put(spark, tmp_path, records[:21])  # whole commits: three changes have one position
    snapshot, position = table(spark, START), []
    target = KeyedTable(f"{tmp_path}/target", ["id"], snapshot.schema, 4)
    whole, later = target.put_batch, iter([records[21:42], records[42:]])

    def arriving(delta, batch_id, run=""):
        whole(delta, batch_id, run)
        if (more := next(later, None)) is not None:
            put(spark, tmp_path, more)

    target.put_batch = arriving

    def source_at(lsn):
        position.append(lsn)
        return c.apply_changes(snapshot, log(spark, [r for r in records if r[0] <= lsn]), ["id"])

    result = copy_online(snapshot, stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99, source_at=source_at, cols=snapshot.columns)
    assert result.converged and position[0] < records[-1][0]


def test_online_copy_and_cutover(spark, tmp_path):
    records = make_records(30, 5)
    put(spark, tmp_path, records[:10])
    put(spark, tmp_path, records[10:])
    snapshot = table(spark, START)
    marks = spark.createDataFrame([("app", "m", 9)], "schema_name string, name string, last_value bigint")
    target = KeyedTable(f"{tmp_path}/target", ["id"], snapshot.schema, 4)
    now = lambda: c.apply_changes(snapshot, log(spark, records), ["id"])
    result = copy_online(
        snapshot, stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99, source_now=now, cols=snapshot.columns,
        source_marks=marks, target_marks=marks.withColumn("last_value", F.lit(1).cast("bigint")),
    )
    assert result.converged and result.source_digest == result.target_digest
    assert rows(result.marks) == [("app", "m", 1, 9, "applied")]
    assert rows(target.read(spark)) == replay(START, records)


def test_cutover_keeps_the_stream_of_a_copy_that_differs(spark, tmp_path):
    records = make_records(9, 6)
    put(spark, tmp_path, records)
    target = start(spark, tmp_path)
    query = apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99, trigger={"processingTime": "0 seconds"})
    with pytest.raises(NotConverged):
        cutover(query, table(spark, {"zz": ("a", "b")}), lambda: target.read(spark), ["id"], ["id", "name", "qty"])
    assert query.isActive
    assert cutover(query, target.read(spark), lambda: target.read(spark), ["id"], ["id", "name", "qty"]).converged
    assert not query.isActive
    drain_and_stop(query)  # again: nothing happens


def test_bounded_run(spark, tmp_path):
    put(spark, tmp_path, make_records(3))
    target = start(spark, tmp_path)
    query = apply_stream(stream(spark, tmp_path), target, f"{tmp_path}/cp", cut_lsn=99, trigger={"processingTime": "1 seconds"})
    assert run_for(query, 3) is False and not query.isActive


@pytest.mark.parametrize("files", [1, 3])
def test_lag_monitor_equals_batch(spark, tmp_path, files):
    rng, applied, data = random.Random(9), {}, []
    for i in range(90):
        slot = rng.choice("ab")
        applied[slot] = applied.get(slot, 0) + rng.choice([0, 0, 0, 40])
        data.append((slot, i, None, applied[slot] + rng.choice([0, 5, 50]), applied[slot]))
    samples = spark.createDataFrame(data, "slot string, sample_no bigint, ts timestamp_ntz, source_lsn bigint, confirmed_lsn bigint").selectExpr(
        "slot", "sample_no", "ts", "cast(source_lsn as decimal(20,0)) source_lsn", "cast(confirmed_lsn as decimal(20,0)) confirmed_lsn"
    )
    size = 90 // files
    for i in range(files):
        part = samples.filter(F.col("sample_no").between(i * size, (i + 1) * size - 1))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = read_lag_samples(spark, f"{tmp_path}/in", stream=True, files_per_batch=1)
    lag_monitor(source, f"{tmp_path}/out", f"{tmp_path}/cp", threshold=10).awaitTermination()
    columns = ["slot", "sample_no", "state", "stale_run", "stall"]
    got = read_states(spark, f"{tmp_path}/out")
    assert rows(got.select(*columns)) == rows(lag_states(samples, 10).select(*columns))

    events = progress_events(got).orderBy("slot", "sample_no", "seq").collect()
    crossings = got.filter("state IN ('JustCaughtUp', 'FellBehind')").count()
    assert len(events) == 90 + crossings and all(e["message"].startswith("replication lag") for e in events if e["seq"] == 0)
    assert LAG_SCHEMA.startswith("slot")


def test_change_schema_matches(spark):
    one = log(spark, [])
    made = change_schema(one.schema["key"].dataType, one.schema["after"].dataType)
    assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in one.schema]


def test_one_stream_into_many_tables(spark, tmp_path):
    from twinproof.streaming.apply_tables import RECORD, Reports, UnfitImage, apply_tables

    schema = table(spark, START).schema
    names = [("app", "a"), ("app", "b")]
    targets = {n: KeyedTable(f"{tmp_path}/{n[1]}", ["id"], schema, 2) for n in names}
    for t in targets.values():
        t.create(table(spark, START), 99 - (1 << 63))

    def send(*changes):
        rows = [(lsn, 0, "app", name, op, image) for lsn, name, op, image in changes]
        spark.createDataFrame(rows, RECORD.replace("decimal(20,0)", "long")).withColumn("lsn", F.col("lsn").cast("decimal(20,0)")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in")
        apply_tables(stream, targets, f"{tmp_path}/cp", f"{tmp_path}/work", cut_lsn=99).awaitTermination()

    row = '{"id": "%s", "name": %s, "qty": "%s"}'
    send((100, "a", "I", row % ("n", '"x"', 1)), (101, "b", "U", row % ("3", "null", 2)), (102, "a", "D", '{"id": "3"}'), (103, "zzz", "I", "{}"), (50, "a", "I", "bad, but before the cut"))
    run()
    was = {r["id"]: (r["name"], r["qty"]) for r in table(spark, START).collect()}
    got = {n[1]: {r["id"]: (r["name"], r["qty"]) for r in t.read(spark).collect()} for n, t in targets.items()}
    assert got["a"] == {k: v for k, v in was.items() if k != "3"} | {"n": ("x", "1")}
    assert got["b"] == was | {"3": (None, "2")}
    reports = Reports(f"{tmp_path}/work")
    assert [(r["table_name"], r["changes"]) for r in reports.unknown(spark).collect()] == [("zzz", 1)]
    assert reports.conflicts(spark).agg(F.sum("inserts")).first()[0] == 0
    send((110, "b", "I", '{"id": "5", "name": "no qty"}'))
    with pytest.raises(Exception, match="does not fit"):
        run()
    assert got["b"] == {r["id"]: (r["name"], r["qty"]) for r in targets["app", "b"].read(spark).collect()}
    assert UnfitImage.__doc__


def files_read(spark, df):
    """Files that the scans of a query opened."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves, total = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
        for i in range(leaves.size()):
            found = leaves.apply(i).metrics().get("numFiles")
            total += found.get().value() if found.isDefined() else 0
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    schema = table(spark, START).schema
    target = KeyedTable(f"{tmp_path}/t", ["id"], schema, buckets=16)
    wide = spark.range(400).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("name"), F.lit("1").alias("qty"))
    target.create(wide.select(*[F.col(f.name).cast(f.dataType) for f in schema]), c.cut_position(log(spark, []), 99))
    put_delta = lambda records, i: target.put_batch(c.changes_as_delta(log(spark, records), ["id"], schema.names), i)
    for i in range(3):
        put_delta([(200 + i, k, "U", str(k), i) for k in range(300)], i)
    one = log(spark, [(300, 0, "U", "7", 9)]).select("key.*")
    few, before = files_read(spark, target.state_of(one)), files_read(spark, target.state(spark))
    assert few * 8 <= before and target.state_of(one).filter("id = '7'").count() == 1
    for i in range(3, 6):  # batches of one other bucket each: nothing more is opened for this key
        other = next(k for k in range(300) if target.buckets_of(log(spark, [(1, 0, "U", str(k), 0)]).select("key.*")) != target.buckets_of(one))
        put_delta([(200 + i, 0, "U", str(other), i)], i)
    assert files_read(spark, target.state_of(one)) == few
    assert files_read(spark, target.state_of(one.limit(0))) == 0


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path):
    import os

    target = start(spark, tmp_path)
    delta = c.changes_as_delta(log(spark, [(200, i, "U", str(i), 7) for i in range(8)]), ["id"], ["id", "name", "qty"])
    target.put_batch(delta, 0, run="r")
    mark = f"{tmp_path}/target/delta/_run=r/_batch=0/_SUCCESS"
    os.remove(mark)  # as after a kill before the job's end
    assert rows(target.read(spark)) == replay(START, []) and target.compact(spark) == [] and target.last_position(spark) is None
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        target.put_batch(delta, 0, run="r")
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(target.read(spark)) == replay(START, [(200, i, "U", str(i), 7) for i in range(8)])
    with pytest.raises(LostBatch):
        target.put_batch(c.changes_as_delta(log(spark, [(201, 0, "U", "3", 8)]), ["id"], ["id", "name", "qty"]), 0, run="r")


def test_online_copy_of_tables_folds_cleans_up_and_compares_at_its_position(spark, tmp_path):
    import os

    from twinproof.plans.online import copy_online_tables
    from twinproof.streaming.apply_tables import RECORD, folder_of

    names = [("a.b", "c"), ("a", "b.c"), ("a", "Empty")]
    assert len({folder_of(n).lower() for n in [*names, ("a", "empty"), ("..", "x"), ("a-2e-b", "c")]}) == 6
    first = table(spark, START)
    snapshot = {n: first if n[1] != "Empty" else first.limit(0) for n in names}
    sent = []

    def send(*changes):
        sent.extend(changes)
        data = [(lsn, 0, *names[i], op, image) for lsn, i, op, image in changes]
        made = spark.createDataFrame(data, RECORD.replace("decimal(20,0)", "long")).withColumn("lsn", F.col("lsn").cast("decimal(20,0)"))
        made.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def want(i, position):
        had = {r["id"]: (r["name"], r["qty"]) for r in snapshot[names[i]].collect()}
        for lsn, at, op, image in sent:
            if at == i and lsn <= position:
                had[image.split('"')[3]] = ("x", str(lsn))
        return had

    def source_at(position):
        return {n: spark.createDataFrame([(k, *v) for k, v in want(i, position).items()], first.schema) for i, n in enumerate(names)}

    targets = {n: KeyedTable(f"{tmp_path}/t{i}", ["id"], first.schema, 2) for i, n in enumerate(names)}
    row = '{"id": "%s", "name": "x", "qty": "%s"}'

    def run(source=source_at):
        stream = spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in")
        return copy_online_tables(snapshot, stream, targets, f"{tmp_path}/cp", f"{tmp_path}/work", cut_lsn=99, source_at=source, fold_every=2)

    for i in range(3):
        send((110 + i, 0, "U", row % ("3", 110 + i)), (110 + i, 1, "I", row % (f"n{i}", 110 + i)))
        assert run().position == 110 + i
        assert os.listdir(f"{tmp_path}/work/staged") == [f"batch={i}"]
    for i, (n, t) in enumerate(targets.items()):
        assert {r["id"]: (r["name"], r["qty"]) for r in t.read(spark).collect()} == want(i, 200)
        assert sum(map(len, t.open_batches(spark).values())) == (1 if i < 2 else 0)
    with pytest.raises(NotConverged, match="a.b.c differ"):
        run(lambda position: {**source_at(position), names[0]: first})
    with pytest.raises(TargetMismatch):
        copy_online_tables(snapshot, spark.readStream.schema(RECORD).parquet(f"{tmp_path}/in"), targets, f"{tmp_path}/cp9", f"{tmp_path}/w9", cut_lsn=98, source_at=source_at)


def test_each_image_is_parsed_once_by_the_fit_check_and_in_one_look(spark):
    from twinproof.streaming import apply_tables as a

    target = KeyedTable("/nowhere", ["id"], table(spark, START).schema)
    image = "concat('{', " + ", ', ', ".join(f"""'"{c}": "', id, '"'""" for c in target.columns) + ", '}')"
    place = ["cast(id AS decimal(20,0)) AS lsn", "0 AS seq", "'public' AS schema_name", "'t' AS table_name", "'U' AS op"]
    good = spark.range(0, 400, 1, 40).selectExpr(*place, f"{image} AS image")
    plan = a.unfit(good, target)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    spark.sparkContext.setJobGroup("fit", "fit")
    try:
        assert a.first_unfit(good, target) is None
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    wrong = [F.lit(x).alias("image") for x in ("{}", "[]", "nope", '{"no such": 1}')]
    for x in [*wrong, F.lit(None).cast("string").alias("image")]:
        odd = good.withColumn("image", F.when(F.col("lsn") >= 7, x).otherwise(F.col("image")))
        assert tuple(a.first_unfit(odd, target))[:2] == (7, 0) and a.unfit(odd, target).count() == 393
