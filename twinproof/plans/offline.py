"""One-shot copy: load, then verify; and the whole run, with checks, digests and statistics."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.operators.content import content_hash
from twinproof.operators.counts import TableMap, verify_row_counts
from twinproof.operators.maintain import analyze_all
from twinproof.operators.quality import Rule, check_unique, tag_violations
from twinproof.operators.scope import Scope
from twinproof.plans.copy import copied_tables, copy_tables, table_path
from twinproof.plans.verify import verify
from twinproof.sources.snapshot import read_snapshot


def _copied_of(tables: TableMap, scope: Scope, options: Mapping) -> TableMap:
    """What a copy with these options has to hold: the tables in scope, at its cut."""
    return read_snapshot(tables, scope, options.get("cut_lsn"), options.get("immutable", ()))


def copy_offline(
    spark: SparkSession,
    tables: TableMap,
    source: str,
    target: str,
    scope: Scope | None = None,
    *,
    mode: str = "warn",
    **options,
) -> tuple[DataFrame, DataFrame | None]:
    """``(manifest, count report)``. ``mode`` says what a mismatch does; ``options`` go to ``copy_tables``.

    Counts are compared with the source as it was at the cut of the copy, if it has one. A schema-only copy is not counted: its tables are empty on purpose.
    """
    scope = scope or Scope()
    manifest = copy_tables(spark, tables, source, target, scope, **options)
    if scope.what == "schema-only":
        return manifest, None
    kept = _copied_of(tables, scope, options)
    return manifest, verify(kept, copied_tables(spark, target, list(kept)), mode=mode)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Checks:
    """What holds for a table's rows after the load: unique ``keys`` and row rules."""

    keys: Sequence[str]
    rules: Sequence[Rule] = ()


def digests(tables: TableMap, keys: Mapping[tuple[str, str], Sequence[str]]) -> DataFrame:
    """``schema_name, table_name, n, digest`` of every table over all its columns."""
    parts = [
        content_hash(df, list(keys[name]), df.columns).select(F.lit(name[0]).alias("schema_name"), F.lit(name[1]).alias("table_name"), "n", "digest")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def broken_rows(tables: TableMap, checks: Mapping[tuple[str, str], Checks]) -> DataFrame:
    """``schema_name, table_name, broken``: rows that break a rule, and keys that repeat, of every table."""
    parts = []
    for name, df in tables.items():
        check = checks[name]
        bad = tag_violations(df, check.rules).where(F.size("violations") > 0).select(F.lit(1).alias("x")) if check.rules else None
        twice = check_unique(df, list(check.keys)).select(F.lit(1).alias("x"))
        rows = twice if bad is None else bad.unionByName(twice)
        parts.append(rows.agg(F.count("*").alias("broken")).select(F.lit(name[0]).alias("schema_name"), F.lit(name[1]).alias("table_name"), "broken"))
    return reduce(DataFrame.unionByName, parts)


def run_offline(
    spark: SparkSession,
    tables: TableMap,
    source: str,
    target: str,
    checks: Mapping[tuple[str, str], Checks],
    scope: Scope | None = None,
    *,
    mode: str = "strict",
    **options,
) -> DataFrame:
    """The whole run in its order: load, check, analyze, verify counts, compare contents.

    One row ``schema_name, table_name, source, target, broken, analyzed, equal`` per table in scope, all against the source at the cut of
    the copy. The copied files are analyzed as numbered tables of a database made for that and dropped at the end,
    whatever happens, so names may hold any character and differ in case only.
    """
    scope = scope or Scope()
    copy_tables(spark, tables, source, target, scope, **options)
    kept = _copied_of(tables, scope, options)
    copied = copied_tables(spark, target, list(kept))
    broken = broken_rows(copied, checks)
    database = f"offline_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{database}`")
    try:
        names = {f"t{i}": name for i, name in enumerate(kept)}
        for alias, name in names.items():
            spark.sql(f"CREATE TABLE `{database}`.`{alias}` USING parquet LOCATION {_quoted(table_path(target, *name))}")
        report = analyze_all(spark, Scope(schemas=[database])).collect()  # a row per table
    finally:
        spark.sql(f"DROP DATABASE `{database}` CASCADE")
    status = spark.createDataFrame([(*names[r["table_name"]], r["status"] == "analyzed") for r in report], "schema_name string, table_name string, analyzed boolean")
    counted = verify(kept, copied, mode=mode)
    counted = verify_row_counts(kept, copied) if counted is None else counted
    keys = {n: checks[n].keys for n in kept}
    theirs = digests(copied, keys).select("schema_name", "table_name", F.col("digest").alias("theirs"))
    same = digests(kept, keys).join(theirs, ["schema_name", "table_name"]).select("schema_name", "table_name", F.col("digest").eqNullSafe(F.col("theirs")).alias("equal"))
    out = counted
    for part in (broken, status, same):
        out = out.join(part, ["schema_name", "table_name"])
    return out.select("schema_name", "table_name", "source", "target", "broken", "analyzed", "equal")
