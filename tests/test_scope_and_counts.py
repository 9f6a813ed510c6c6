import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from twinproof.operators import counts
from twinproof.operators.scope import Scope, filter_changes, select_tables, user_tables
from twinproof.plans.verify import VerifyFailed, verify

CANDIDATES = [("app", "a"), ("app", "b"), ("public", "users"), ("other", "x")]


@pytest.mark.parametrize(
    "scope, kept",
    [
        (Scope(), CANDIDATES),
        (Scope(schemas=["app"]), [("app", "a"), ("app", "b")]),
        (Scope(tables=[("public", "users")]), [("public", "users")]),
        (Scope(schemas=["app"], tables=[("public", "users")]), [("app", "a"), ("app", "b"), ("public", "users")]),
        (Scope(schemas=["app"], tables=[("public", "users")], exclude_tables=[("app", "b")]), [("app", "a"), ("public", "users")]),
        (Scope(schemas=["app"], tables=[("public", "users")], exclude_schemas=["public"]), [("app", "a"), ("app", "b")]),
        (Scope(schemas=["app"], exclude_schemas=["app"]), []),  # nothing left is nothing, not everything
    ],
)
def test_select_tables(spark, scope, kept):
    catalog = spark.createDataFrame(CANDIDATES, "schema_name string, table_name string")
    assert rows(select_tables(catalog, scope)) == sorted(kept)
    assert rows(filter_changes(catalog, scope)) == sorted(kept)
    assert sorted(counts.in_scope(dict.fromkeys(CANDIDATES), scope)) == sorted(kept)


def test_dots_in_names(spark):
    catalog = spark.createDataFrame([("ten.ant", "t"), ("ten", "ant.t")], "schema_name string, table_name string")
    assert rows(select_tables(catalog, Scope(exclude_schemas=["ten.ant"]))) == [("ten", "ant.t")]
    assert rows(select_tables(catalog, Scope(tables=[("ten", "ant.t")]))) == [("ten", "ant.t")]


def test_user_tables(spark):
    catalog = spark.createDataFrame(
        [("pg_catalog", "a", False), ("pg_temp_1", "b", False), ("pg_toast_temp_2", "c", False), ("app", "child", True), ("app", "parent", False)],
        "schema_name string, table_name string, is_partition boolean",
    )
    assert [r["table_name"] for r in user_tables(catalog).collect()] == ["parent"]


def test_bad_scope():
    with pytest.raises(ValueError):
        Scope(what="everything")


def test_verify_cases(spark):
    def ids(n):
        return spark.range(n)

    source = {("p", "match"): ids(3), ("d", "drift"): ids(2), ("m", "missing"): ids(2), ("m", "empty"): ids(0), ("ten.ant", "t"): ids(3)}
    target = {("p", "match"): ids(3), ("d", "drift"): ids(3), ("ten.ant", "t"): ids(3), ("x", "target_only"): ids(9)}
    report = counts.verify_row_counts(source, target)
    assert rows(report) == [
        ("d", "drift", 2, 3),
        ("m", "empty", 0, -1),
        ("m", "missing", 2, -1),
        ("p", "match", 3, 3),
        ("ten.ant", "t", 3, 3),
    ]
    assert counts.mismatches(report).count() == 3
    assert verify(source, target, mode="off") is None
    assert verify(source, target, mode="warn").count() == 5
    with pytest.raises(VerifyFailed, match="3/5"):
        verify(source, target)
    assert verify(source, target, Scope(schemas=["p", "ten.ant"])).count() == 2
    assert rows(counts.verify_row_counts(source, target, Scope(schemas=["m"]))) == [("m", "empty", 0, -1), ("m", "missing", 2, -1)]


def test_summary_text(spark):
    schema = "schema_name string, table_name string, source long, target long"
    good = spark.createDataFrame([("s", "a", 5, 5), ("s", "b", 0, 0)], schema)
    bad = spark.createDataFrame([("s", "a", 5, 5), ("s", "b", 7, 3)], schema)
    assert counts.verify_summary(good).first()["message"] == "verify: 2 table(s) matched"
    first = counts.verify_summary(bad, "strict").first()
    assert (first["message"], first["outcome"]) == ("verify: 1/2 table(s) MISMATCHED", "failed")
    assert counts.verify_summary(bad, "off").first()["outcome"] == "skipped"
    with pytest.raises(ValueError):
        counts.verify_summary(bad, "loud")
    assert counts.verify_summary(bad.filter(F.lit(False))).first()["message"] == "verify: 0 table(s) matched"
