"""Reading the tables of one copy, at one position."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.functions.lsn import lsn_literal
from twinproof.operators.counts import in_scope
from twinproof.operators.maintain import list_tables
from twinproof.operators.scope import Scope


def parquet_tables(spark: SparkSession, root: str, names: Iterable[str], schema: str = "public") -> dict[tuple[str, str], DataFrame]:
    """Tables kept as ``root/<name>.parquet``. Their footers are read side by side."""
    names = list(names)
    with ThreadPoolExecutor(8) as pool:
        read = pool.map(lambda name: spark.read.parquet(f"{root}/{name}.parquet"), names)
        return {(schema, name): df for name, df in zip(names, read, strict=True)}


def catalog_tables(spark: SparkSession, scope: Scope | None = None) -> dict[tuple[str, str], DataFrame]:
    """Tables of the session's catalog that are in scope."""
    names = in_scope(dict.fromkeys(list_tables(spark, scope.schemas if scope and not scope.tables else ())), scope)
    return {(schema, table): spark.table(f"`{schema}`.`{table}`") for schema, table in names}


def read_snapshot(
    tables: dict[tuple[str, str], DataFrame],
    scope: Scope | None = None,
    cut_lsn: int | None = None,
    immutable: Iterable[tuple[str, str]] = (),
) -> dict[tuple[str, str], DataFrame]:
    """Tables in scope as of ``cut_lsn``: rows of a versioned table past the cut are left out.

    The cut is a filter on a stored column, so it reaches the Parquet scan. A table without a position column
    cannot be cut; it is read as it is if it is listed as ``immutable``, and refused otherwise.
    """
    kept = in_scope(tables, scope)
    if cut_lsn is None:
        return kept
    uncut = [n for n, df in kept.items() if "lsn" not in df.columns and n not in set(immutable)]
    if uncut:
        raise ValueError(f"no position column to cut at: {', '.join('.'.join(n) for n in sorted(uncut))}")
    return {
        name: df.filter(F.col("lsn") <= lsn_literal(cut_lsn, df.schema["lsn"].dataType)) if "lsn" in df.columns else df
        for name, df in kept.items()
    }


def jdbc_options(
    url: str, table: str, split_column: str | None = None, lower: int = 0, upper: int = 0, jobs: int = 8, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC read, split into ``jobs`` key ranges when there is a numeric key.

    The ranges are read in separate transactions: take them from a standby or a quiesced source,
    or filter on a position column, when one consistent cut is needed.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), "pushDownAggregate": "true"}
    if split_column:
        if lower >= upper:
            raise ValueError("a split column needs its lowest and highest value: without them all rows go to one task")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(jobs),
        }
    return options


def jdbc_table(spark: SparkSession, **kwargs) -> DataFrame:
    """One table over JDBC; needs the driver jar of the database on the class path."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()
