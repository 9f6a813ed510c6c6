"""Copying a set of tables, in sections, resumable per table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twinproof.operators.counts import TableMap
from twinproof.operators.quality import Rule, check_unique, tag_violations
from twinproof.operators.scope import Scope
from twinproof.sinks.archive import write_archive
from twinproof.sinks.files import exists, folders, move_files, remove
from twinproof.sources.snapshot import read_snapshot

MANIFEST_SCHEMA = "fingerprint string, schema_name string, table_name string, state string, rows bigint, finished timestamp"
STARTED, DONE = "started", "done"


class ResumeRefused(RuntimeError):
    """What is in the target comes from a copy that was started with another scope, cut or other endpoints."""


def fingerprint(source: str, target: str, scope: Scope, cut_lsn: int | None = None) -> str:
    """Hash of everything that defines a copy, whatever the order of the lists."""
    fields = {
        "source": source,
        "target": target,
        "what": scope.what,
        "cut_lsn": cut_lsn,
        "schemas": sorted(scope.schemas),
        "tables": sorted(map(list, scope.tables)),
        "exclude_schemas": sorted(scope.exclude_schemas),
        "exclude_tables": sorted(map(list, scope.exclude_tables)),
    }
    return hashlib.sha256(json.dumps(fields, sort_keys=True).encode()).hexdigest()


def table_path(target: str, schema: str, table: str) -> str:
    return f"{target}/{schema}/{table}"


def _manifest_path(target: str) -> str:
    return f"{target}/_manifest"


def _staging_path(target: str) -> str:
    return f"{target}/_staging"


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    """The tables that a copy has noted as done."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest_path(target)).filter(F.col("state") == DONE)


def _begin(spark: SparkSession, target: str, mark: str, resume: bool) -> bool:
    """Store whose copy this is before its first byte is written; True if that copy goes on.

    A copy is known by its mark from then on, whether or not a table was noted, so rows of two cuts never meet: a resumed copy must
    have the mark that was stored, and a new one finds no rows that another left half way.
    """
    path = _manifest_path(target)
    if resume and exists(spark, path):
        marks = {r[0] for r in spark.read.schema(MANIFEST_SCHEMA).parquet(path).select("fingerprint").distinct().collect()}
        if marks != {mark}:
            raise ResumeRefused("scope, endpoints or cut changed since this copy was started")
        return True
    others = [m for m in folders(spark, _staging_path(target)) if m != mark[:16]] if exists(spark, _staging_path(target)) else []
    if others:
        raise ResumeRefused("rows of an unfinished copy of another scope or cut are in the target: resume that copy, or remove them")
    now = datetime.now(timezone.utc)
    spark.createDataFrame([(mark, None, None, STARTED, None, now)], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return False


def pending_tables(spark: SparkSession, names: Sequence[tuple[str, str]], manifest: DataFrame) -> DataFrame:
    """Listed tables the manifest does not have as done."""
    wanted = spark.createDataFrame(list(names), "schema_name string, table_name string")
    return wanted.join(manifest.filter(F.col("state") == DONE), ["schema_name", "table_name"], "left_anti")


def _copy_one(df: DataFrame, path: str, what: str, compress: str | None, mark: str, staging: str) -> int:
    """Write one table and return its row count, counted by the write itself.

    Rows that are added to a table are written beside it first. Their files then move in under names that begin
    with the run's mark, in place of files of that mark: done twice, it gives what it gives once.
    """
    if what == "schema-only":
        write_archive(df.sparkSession.createDataFrame([], df.schema), path, compress, mode="overwrite")
        return 0
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    write_archive(counted, staging if what == "data-only" else path, compress, mode="overwrite")
    if what == "data-only":
        move_files(df.sparkSession, staging, path, mark)
    return counter.get["rows"]


def copy_tables(
    spark: SparkSession,
    tables: TableMap,
    source: str,
    target: str,
    scope: Scope | None = None,
    *,
    compress: str | None = None,
    cut_lsn: int | None = None,
    immutable: Sequence[tuple[str, str]] = (),
    jobs: int = 8,
    resume: bool = False,
) -> DataFrame:
    """Copy the tables in scope to ``target/<schema>/<table>`` and return the manifest.

    ``jobs`` tables are written at a time; each write is spread over the cluster, so one large table
    does not hold the others up. With ``resume``, tables already done are left alone. An unfinished
    table is written again from the start, in place of what it left behind. A table that fails does not stop
    the others: all that end well are noted before its error is raised. What the target holds of another copy is refused.
    """
    scope = scope or Scope()
    mark = fingerprint(source, target, scope, cut_lsn)
    kept = read_snapshot(tables, scope, cut_lsn, immutable)
    names = list(kept)
    if _begin(spark, target, mark, resume):
        # one row per table of the copy
        names = [(r["schema_name"], r["table_name"]) for r in pending_tables(spark, names, read_manifest(spark, target)).collect()]
    staging = f"{_staging_path(target)}/{mark[:16]}"

    def run(name: tuple[str, str]) -> int:
        return _copy_one(kept[name], table_path(target, *name), scope.what, compress, mark[:16], f"{staging}/{name[0]}/{name[1]}")

    failed: list[BaseException] = []
    with ThreadPoolExecutor(max(jobs, 1)) as pool:
        waiting = {pool.submit(run, n): n for n in names}
        while waiting:
            # all that ended meanwhile are noted in one go; appends to one folder must not overlap
            ended, _ = wait(waiting, return_when=FIRST_COMPLETED)
            failed += [f.exception() for f in ended if f.exception()]
            now = datetime.now(timezone.utc)
            entries = [(mark, *waiting[f], DONE, f.result(), now) for f in ended if not f.exception()]
            if entries:
                spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(_manifest_path(target))
            waiting = {f: n for f, n in waiting.items() if f not in ended}
    if failed:
        raise failed[0]
    remove(spark, staging)
    return read_manifest(spark, target)


def cluster_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in key ranges, sorted inside each file: what an index gives a reader, row groups that can be skipped.

    The row's number in its input task is the last part of the range, so a key that very many rows
    share, copies of one row included, is spread over several files.
    """
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(1024)))
    return salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys).drop("_salt")


def copy_in_sections(
    df: DataFrame,
    path: str,
    *,
    keys: list[str] | None = None,
    rules: Sequence[Rule] = (),
    tolerate: bool = True,
    cluster: bool = False,
    compress: str | None = None,
) -> DataFrame:
    """Create, bulk load without constraints, then check; always in that order.

    Returns ``rule, rows`` for every rule that rows break, duplicate keys included. Not tolerating
    them raises after the load, so the rows can be looked at.
    """
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    rows = cluster_rows(df, keys) if cluster and keys else df
    write_archive(rows, path, compress, mode="append")

    loaded = spark.read.schema(df.schema).parquet(path)
    found = [tag_violations(loaded, rules).select(F.explode("violations").alias("rule"), F.lit(1).alias("n"))]
    if keys:
        found.append(check_unique(loaded, keys).select(F.lit(f"unique:{','.join(keys)}").alias("rule"), "n"))
    report = reduce(DataFrame.unionByName, found).groupBy("rule").agg(F.sum("n").alias("rows"))
    if not tolerate and (broken := report.collect()):  # one row per rule
        raise ValueError("rows break " + ", ".join(f"{r['rule']} ({r['rows']})" for r in broken))
    return report


def copied_tables(spark: SparkSession, target: str, names: Sequence[tuple[str, str]]) -> Mapping[tuple[str, str], DataFrame]:
    return {n: spark.read.parquet(table_path(target, *n)) for n in names}
