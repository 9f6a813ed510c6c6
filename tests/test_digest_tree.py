"""The digest tree against full hashes and full comparisons."""

import random

import pytest

from tests.conftest import rows
from twinproof.operators.content import content_hash, locate_drift
from twinproof.plans.digest_tree import DigestTree, differing_leaves, drift_by_tree

COLUMNS = "k bigint, name string, v double"


def made(n, seed=1):
    rnd = random.Random(seed)
    return [(i if i % 50 else None if i % 100 else 7, rnd.choice(["a", None, "bb"]), float(i % 9)) for i in range(n)]


def tree(path, **options):
    return DigestTree(str(path), ["k"], ["k", "name", "v"], **options)


@pytest.mark.parametrize("portable", [False, True])
@pytest.mark.parametrize("bits, fan", [(18, 6), (5, 2), (1, 1)])
def test_root_is_the_content_hash(spark, tmp_path, portable, bits, fan):
    df, t = spark.createDataFrame(made(500), COLUMNS), tree(tmp_path, portable=portable, bits=bits, fan=fan)
    t.build(df)
    assert t.digest(spark).collect() == content_hash(df, ["k"], t.cols, portable=portable).collect()
    assert {r["parent"] for r in spark.read.parquet(f"{tmp_path}/sums").where(f"_level = {t.top}").collect()} == {0}


def test_updates_give_what_a_full_hash_gives(spark, tmp_path):
    now, t, rnd = made(300), tree(tmp_path), random.Random(5)
    t.build(spark.createDataFrame(now, COLUMNS))
    for batch in range(4):
        old = rnd.sample(now, 20)
        new = [(k, "new", v) for k, _, v in old[:12]] + [(1000 + batch, None, None)]
        for row in old:
            now.remove(row)
        now += new
        for _ in range(1 + batch % 2):  # a batch that is written again changes nothing
            t.update(batch, spark.createDataFrame(old, COLUMNS), spark.createDataFrame(new, COLUMNS))
        df = spark.createDataFrame(now, COLUMNS)
        assert t.digest(spark).collect() == content_hash(df, ["k"], t.cols).collect()
        other = tree(f"{tmp_path}/other{batch}")
        other.build(df)
        assert differing_leaves(t, other, spark) == []
    everything = spark.createDataFrame(now, COLUMNS)
    t.update(9, everything, everything.limit(0))
    assert tuple(t.digest(spark).first()) == (0, None)
    with pytest.raises(ValueError):
        t.update(-1, everything, everything)


@pytest.mark.parametrize("most", [4096, 2])
def test_drift(spark, tmp_path, most):
    """Found by descent, or by comparing all where too many nodes differ: the same keys."""
    here = made(600)
    there = [r for r in here if r[0] not in (11, 13)] + [(5000, "x", 0.0), (17, "again", 1.0), (None, "n", None)]
    a, b = tree(tmp_path / "a", bits=10, fan=3), tree(tmp_path / "b", bits=10, fan=3)
    s, t = spark.createDataFrame(here, COLUMNS), spark.createDataFrame(there, COLUMNS)
    a.build(s)
    b.build(t)
    want = rows(locate_drift(s, t, ["k"], a.cols))
    assert (differing_leaves(a, b, spark, most) is None) == (most == 2) and len(want) == 5
    assert rows(drift_by_tree(a, b, a.rows(spark), b.rows(spark), most)) == want
    assert rows(drift_by_tree(a, b, s, t, most)) == want
    assert rows(drift_by_tree(a, a, s, s, most)) == []


def test_few_keys_adrift_read_few_rows(spark, tmp_path):
    n = 200_000
    df = spark.range(n).selectExpr("id AS k", "uuid() AS name", "0D AS v")
    df.write.parquet(f"{tmp_path}/given")
    df = spark.read.parquet(f"{tmp_path}/given")
    off = df.selectExpr("k", "if(k IN (5, 777, 123456), 'off', name) AS name", "v")
    a, b = tree(tmp_path / "a"), tree(tmp_path / "b")
    a.build(df, row_group_bytes=1 << 16)
    b.build(off, row_group_bytes=1 << 16)
    assert len(differing_leaves(a, b, spark)) == 3
    found = drift_by_tree(a, b, a.rows(spark), b.rows(spark))
    assert sorted(r["k"] for r in found.collect()) == [5, 777, 123456]
    leaves = differing_leaves(a, b, spark)
    from twinproof.plans.digest_tree import _among

    near = a.rows(spark).where(_among("_leaf", leaves))
    plan = near._jdf.queryExecution().executedPlan()
    near.collect()
    scans, todo = [], [plan]
    while todo:
        node = todo.pop()
        if "Scan parquet" in node.nodeName():
            scans.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert scans and sum(scans) < n / 10


def test_shapes_and_no_rows(spark, tmp_path):
    a, b = tree(tmp_path / "a"), tree(tmp_path / "b", bits=8)
    empty = spark.createDataFrame([], COLUMNS)
    a.build(empty)
    b.build(empty)
    assert tuple(a.digest(spark).first()) == (0, None)
    assert rows(drift_by_tree(a, a, empty, empty)) == []
    with pytest.raises(ValueError):
        differing_leaves(a, b, spark)
    with pytest.raises(ValueError):
        tree(tmp_path, bits=40)
