from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators import changes as c
from twinproof.sources.generate import generate_mutations

SCHEMA = (
    "lsn decimal(20,0), seq int, schema_name string, table_name string, op string, "
    "key struct<id:string>, after struct<name:string,qty:string>, ts timestamp_ntz"
)


def log(spark, records):
    """``records``: (lsn, seq, op, id, value)."""
    data = [
        (Decimal(lsn), seq, "app", "widgets", op, (key,), None if op == "D" else (f"n{value}", str(value)), None)
        for lsn, seq, op, key, value in records
    ]
    return spark.createDataFrame(data, SCHEMA)


def replay(state, records):
    """One change after the other, in plain Python."""
    state = dict(state)
    for _, _, op, key, value in sorted(records, key=lambda r: r[:2]):
        if op == "D":
            state.pop(key, None)
        else:
            state[key] = (f"n{value}", str(value))
    return sorted((k, *v) for k, v in state.items())


def table(spark, state):
    return spark.createDataFrame([(k, *v) for k, v in state.items()], "id string, name string, qty string")


START = {str(i): (f"w{i}", str(i)) for i in range(6)}

change = st.tuples(st.sampled_from("IUD"), st.integers(0, 9).map(str), st.integers(0, 99))
logs = st.lists(change, max_size=25).map(lambda ops: [(100 + i // 3, i % 3, *op) for i, op in enumerate(ops)])
quick = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@quick
@given(records=logs)
def test_batch_apply_equals_replay(spark, records):
    got = c.apply_changes(table(spark, START), log(spark, records), ["id"])
    assert rows(got) == replay(START, records)


@quick
@given(records=logs, order=st.randoms(), parts=st.integers(1, 3))
def test_merge_any_split_any_order_any_repeat(spark, records, order, parts):
    """Batches in any order, one sent twice, give the state of the sequential replay."""
    pieces = [records[i::parts] for i in range(parts)]
    order.shuffle(pieces)
    pieces.append(pieces[0])
    state = c.snapshot_as_state(table(spark, START), c.cut_position(log(spark, []), 99))
    for piece in pieces:
        delta = c.changes_as_delta(log(spark, piece), ["id"], ["id", "name", "qty"])
        merged = c.merge_by_position(state, delta, ["id"])
        state = spark.createDataFrame(merged.collect(), merged.schema)  # as if written and read again
    assert rows(c.live_rows(state)) == replay(START, records)


def test_mixed_workload(spark):
    """Ticks against the seeded table, by the rules of the statements themselves."""
    state = {str(g): (f"widget-{g}", str(2 * g)) for g in range(1, 501)}
    seeded = table(spark, state)
    for i in range(700):
        state.setdefault(str(10000 + i), (f"ins-{10000 + i}", str(7 * i)))
        if str(1 + i % 500) in state:
            state[str(1 + i % 500)] = (f"upd-{i}", str(11 * i))
        state.pop(str(451 + i % 50), None)
    got = c.apply_changes(seeded, generate_mutations(spark, 700), ["id"])
    assert rows(got) == sorted((k, *v) for k, v in state.items())


def test_burst(spark):
    """500 rows, 100,000 inserts, then deletion of ids 1 to 1000: 99,500 rows."""
    seeded = spark.range(1, 501).select(F.col("id").cast("string"), F.lit("w").alias("name"), F.lit("0").alias("qty"))

    def made(df, op, lsn):
        image = F.struct(F.concat(F.lit("streamed-"), "id").alias("name"), (F.col("id") * 3).cast("string").alias("qty"))
        return df.select(
            F.lit(lsn).alias("lsn"), F.col("id").cast("int").alias("seq"), F.lit("app").alias("schema_name"), F.lit("widgets").alias("table_name"),
            F.lit(op).alias("op"), F.struct(F.col("id").cast("string").alias("id")).alias("key"), F.when(F.lit(op == "I"), image).alias("after"),
        )

    changes = made(spark.range(501, 100501), "I", 1).unionByName(made(spark.range(1, 1001), "D", 2))
    assert c.apply_changes(seeded, changes, ["id"]).count() == 99_500


def test_after_compares_the_pair(spark):
    df = log(spark, [(5, 0, "I", "a", 1), (5, 1, "I", "b", 1), (6, 0, "I", "c", 1), (2**64 - 1, 0, "I", "d", 1)])
    assert [r["key"]["id"] for r in c.after(df, 5).collect()] == ["c", "d"]
    assert [r["key"]["id"] for r in c.after(df, 5, 0).collect()] == ["b", "c", "d"]
    assert c.after(df, 2**64 - 1).count() == 0


def test_latest_is_limited_before_the_shuffle(spark):
    plan = c.latest_per_key(log(spark, []))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_conflicts_and_unknown_tables(spark):
    changes = log(spark, [(1, 0, "I", "1", 1), (2, 0, "I", "77", 1), (3, 0, "U", "2", 1)])
    assert [r["id"] for r in c.find_apply_conflicts(table(spark, START), changes, ["id"]).collect()] == ["1"]
    catalog = spark.createDataFrame([("app", "other")], "schema_name string, table_name string")
    assert rows(c.unknown_tables(changes, catalog)) == [("app", "widgets", 3, Decimal(1))]
    assert c.unknown_tables(changes, catalog.unionByName(changes.select("schema_name", "table_name"))).count() == 0
