"""Row counts per table, their comparison and the verdict."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinproof.operators.scope import Scope, keeps

TableMap = Mapping[tuple[str, str], DataFrame]
MISSING = -1  # never a real count, so a missing table always differs

VERIFY_MODES = ("off", "warn", "strict")


def in_scope(tables: TableMap, scope: Scope | None) -> dict[tuple[str, str], DataFrame]:
    """The entries a scope keeps. Works on names only, before any plan is built."""
    return dict(tables) if scope is None else {name: df for name, df in tables.items() if keeps(scope, *name)}


def table_counts(tables: TableMap) -> DataFrame:
    """``schema_name, table_name, n`` for every table in one job; an empty table counts 0."""
    if not tables:
        raise ValueError("no table in scope")
    names = list(tables)
    # one shuffle for all: a task sends one row per table it read, and tables without rows come from the list
    tagged = reduce(DataFrame.unionByName, [df.select(F.lit(i).alias("_at")) for i, df in enumerate(tables.values())])
    listed = tagged.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], "_at int, schema_name string, table_name string")
    counted = tagged.groupBy("_at").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(counted, "_at", "left").select("schema_name", "table_name", F.coalesce("n", F.lit(0)).alias("n"))


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source tables with both counts; a table the target lacks gets -1. Target-only tables are not listed."""
    return source.withColumnRenamed("n", "source").join(
        target.withColumnRenamed("n", "target"), ["schema_name", "table_name"], "left"
    ).select("schema_name", "table_name", "source", F.coalesce("target", F.lit(MISSING)).alias("target"))


def verify_row_counts(source: TableMap, target: TableMap, scope: Scope | None = None) -> DataFrame:
    """Count report ``schema_name, table_name, source, target`` over both copies."""
    source, target = in_scope(source, scope), in_scope(target, scope)
    if not target:
        return table_counts(source).select(
            "schema_name", "table_name", F.col("n").alias("source"), F.lit(MISSING).cast("bigint").alias("target")
        )
    return compare_counts(table_counts(source), table_counts(target))


def mismatches(report: DataFrame) -> DataFrame:
    return report.filter(F.col("source") != F.col("target"))


def verify_summary(report: DataFrame, mode: str = "warn") -> DataFrame:
    """One row ``total, bad, message, outcome``; outcome is skipped, ok, warned or failed."""
    if mode not in VERIFY_MODES:
        raise ValueError(f"mode must be one of {VERIFY_MODES}")
    on_bad = {"off": "skipped", "warn": "warned", "strict": "failed"}[mode]
    on_good = "skipped" if mode == "off" else "ok"
    bad = F.count_if(F.col("source") != F.col("target"))
    return (
        report.agg(F.count(F.lit(1)).alias("total"), bad.alias("bad"))
        .withColumn(
            "message",
            F.when(F.col("bad") == 0, F.format_string("verify: %d table(s) matched", "total")).otherwise(
                F.format_string("verify: %d/%d table(s) MISMATCHED", "bad", "total")
            ),
        )
        .withColumn("outcome", F.when(F.col("bad") == 0, F.lit(on_good)).otherwise(F.lit(on_bad)))
    )
