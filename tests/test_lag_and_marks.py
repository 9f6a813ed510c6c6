import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators import lag, marks
from twinproof.operators.ordered import Running, running
from twinproof.operators.scope import Scope

SCHEMA = "slot string, sample_no bigint, ts timestamp_ntz, source_lsn bigint, confirmed_lsn bigint"
PRIOR = "slot string, sample_no bigint, caught_up boolean, confirmed_lsn bigint, stale_run bigint"


def samples(spark, pairs, slot="s"):
    return spark.createDataFrame([(slot, i, None, s, a) for i, (s, a) in enumerate(pairs)], SCHEMA)


@pytest.mark.parametrize("chunk", [1, 2, 1000])
@pytest.mark.parametrize(
    "threshold, pairs, states",
    [
        (8, [(1000, 500), (1000, 995)], [("StillBehind", 500), ("JustCaughtUp", 5)]),
        (8, [(1000, 500), (1000, 1000), (1010, 1005)], [("StillBehind", 500), ("JustCaughtUp", 0), ("StillCaughtUp", 5)]),
        (8, [(1000, 1000), (2000, 1000)], [("JustCaughtUp", 0), ("FellBehind", 1000)]),
        (8, [(108, 100)], [("JustCaughtUp", 8)]),
        (0, [(100, 100), (101, 100)], [("JustCaughtUp", 0), ("FellBehind", 1)]),
        (8, [(100, 200)], [("JustCaughtUp", 0)]),
        (8, [(1000, 1000), (None, None), (1000, 1000)], [("JustCaughtUp", 0), ("StillCaughtUp", 0)]),
    ],
)
def test_transitions(spark, threshold, pairs, states, chunk):
    got = lag.lag_transitions(samples(spark, pairs), threshold, chunk).orderBy("sample_no")
    assert [(r["state"], r["lag"]) for r in got.collect()] == states


def simulate(pairs, threshold):
    """Both state machines step by step."""
    caught, previous, run, out = False, None, 0, []
    for i, (source, applied) in enumerate(pairs):
        if source is None or applied is None:
            continue
        behind = max(source - applied, 0)
        now = behind <= threshold
        state = {(False, True): "JustCaughtUp", (True, False): "FellBehind", (True, True): "StillCaughtUp", (False, False): "StillBehind"}[caught, now]
        run = run + 1 if previous == applied and behind > 0 else 0
        out.append((i, state, run, run > 0 and run % 3 == 0))
        caught, previous = now, applied
    return out


@pytest.mark.parametrize("chunk", [1, 3, 7, 1 << 18])
def test_states_equal_simulation(spark, chunk):
    rng = random.Random(chunk)
    data, want = [], []
    for slot in ("a", "b", "c"):
        applied, pairs = 0, []
        for _ in range(120):
            applied += rng.choice([0, 0, 0, 5])
            pairs.append((None, None) if rng.random() < 0.1 else (applied + rng.choice([0, 3, 20]), applied))
        data += [(slot, i, None, s, a) for i, (s, a) in enumerate(pairs)]
        want += [(slot, *row) for row in simulate(pairs, 5)]
    df = spark.createDataFrame(data, SCHEMA)
    got = lag.lag_states(df, 5, chunk=chunk).select("slot", "sample_no", "state", "stale_run", "stall")
    assert rows(got) == sorted(want)

    # the same in two batches, the second continuing from the state of the first, part of it sent twice
    first = lag.lag_states(df.filter("sample_no < 50"), 5, chunk=chunk)
    last = first.groupBy("slot").agg(F.max_by(F.struct("sample_no", "caught_up", "confirmed_lsn", "stale_run"), "sample_no").alias("s"))
    prior = spark.createDataFrame(last.select("slot", "s.*").collect(), PRIOR)
    second = lag.lag_states(df.filter("sample_no >= 40"), 5, prior, chunk=chunk)
    both = first.unionByName(second).select("slot", "sample_no", "state", "stale_run", "stall")
    assert rows(both) == sorted(want)


def test_stalls_fire_on_every_third(spark):
    pairs = [(100, 10)] * 8 + [(100, 50)] + [(100, 50)] * 3
    got = lag.stalls(samples(spark, pairs), chunk=4).orderBy("sample_no")
    assert [r["sample_no"] for r in got.collect()] == [3, 6, 11]
    assert lag.stalls(samples(spark, [(10, 10)] * 9)).count() == 0


def test_cadence(spark):
    data = [("s", i, 1000 + (0 if i < 10 else 500), 1000, i) for i in range(20)]
    df = spark.createDataFrame(data, "slot string, sample_no bigint, source_lsn bigint, confirmed_lsn bigint, n int")
    df = df.withColumn("ts", F.expr("timestampadd(MILLISECOND, n * 500, timestamp_ntz'2024-01-01 00:00:00')"))
    for windows in (1, 1024):
        got = lag.cadence(df, 8, 0.2, 10.0, chunk_windows=windows).orderBy("sample_no").collect()
        assert [r["beats"] for r in got] == [min(i + 1, 7) for i in range(20)]
        assert [r["next_wait"] for r in got] == [0.2] * 10 + [10.0] * 10
        assert got[0]["stage"] == "CaughtUp" and got[-1]["stage"] == "Lag" and got[-1]["fast_enough"]


def test_apply_stats(spark):
    got = lag.apply_stats(samples(spark, [(10, 5), (20, 18), (None, None)])).first()
    assert tuple(got) == ("s", 1, 18, 2)


def test_running_over_many_chunks(spark):
    rng = random.Random(1)
    data = [(k, p, rng.randint(-5, 5)) for k in ("x", "y") for p in sorted(rng.sample(range(-300, 300), 150))]
    df = spark.createDataFrame(data, "k string, p bigint, v bigint")
    got = running(df, ["k"], "p", {"total": Running("sum", F.col("v")), "top": Running("max", F.col("v"), inclusive=False)}, chunk=16)
    want = []
    for key in ("x", "y"):
        total, top = 0, None
        for k, p, v in data:
            if k == key:
                total += v
                want.append((k, p, v, total, top))
                top = v if top is None else max(top, v)
    assert rows(got, 0, 1) == want


def test_marks(spark):
    schema = "schema_name string, name string, last_value bigint"
    source = spark.createDataFrame([("app", "a", 300), ("app", "b", None), ("app", "c", 7), ("app", "d", 5)], schema)
    target = spark.createDataFrame([("app", "a", 100), ("app", "b", 9), ("app", "d", 50), ("app", "own", 1)], schema)
    assert rows(marks.sync_marks(source, target)) == [
        ("app", "a", 100, 300, "applied"),
        ("app", "b", 9, 9, "skipped"),
        ("app", "c", None, None, "failed"),
        ("app", "d", 50, 5, "applied"),
    ]
    assert rows(marks.marks_after_sync(source, target)) == [("app", "a", 300), ("app", "b", 9), ("app", "d", 5), ("app", "own", 1)]
    more = source.unionByName(spark.createDataFrame([("pg_catalog", "x", 1), ("public", "y", 1)], schema))
    assert marks.marks_in_scope(more, Scope()).filter("schema_name = 'pg_catalog'").count() == 0
    assert [r["name"] for r in marks.marks_in_scope(more, Scope(schemas=["public"])).collect()] == ["y"]


def test_max_key(spark):
    tables = {("p", "t"): spark.range(5), ("p", "none"): spark.range(0)}
    assert rows(marks.max_key(tables, {("p", "t"): "id", ("p", "none"): "id"})) == [("p", "none", None), ("p", "t", 4)]
