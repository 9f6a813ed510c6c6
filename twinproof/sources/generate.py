"""Benchmark tables and change workloads, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Shape of a benchmark row and of the mutation workload.
TABLES = 8
PAYLOAD_BLOCKS = 31
CREATED_AT = "2026-01-01 00:00:00"
FIRST_INSERT_ID = 10_000
UPDATED_IDS = 500
FIRST_DELETED_ID = 451
DELETED_IDS = 50


def table_name(index: int) -> str:
    """Name of benchmark table ``index``, counted from 1."""
    return f"benchmark_data_{index:02d}"


def _row(table: Column, row_id: Column) -> list[Column]:
    seed = F.concat_ws(":", table, row_id.cast("string"))
    blocks = F.transform(F.sequence(F.lit(1), F.lit(PAYLOAD_BLOCKS)), lambda i: F.md5(F.concat_ws(":", seed, i.cast("string"))))
    # 48 random bits: exactly representable as a double
    uniform = F.conv(F.substring(F.md5(F.concat_ws(":", seed, F.lit("val"))), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return [
        row_id.alias("id"),
        F.array_join(blocks, "").alias("payload"),
        F.lit(CREATED_AT).cast("timestamp_ntz").alias("created_at"),
        uniform.alias("val"),
    ]


def benchmark_table(spark: SparkSession, name: str, first_id: int, rows: int) -> DataFrame:
    """``rows`` rows from ``first_id`` on. A row depends on table and id only."""
    return spark.range(first_id, first_id + rows).select(*_row(F.lit(name), F.col("id")))


def generate_benchmark(spark: SparkSession, total_rows: int, tables: int = TABLES) -> dict[str, DataFrame]:
    """``tables`` tables of ``total_rows // tables`` rows each."""
    return {table_name(i): benchmark_table(spark, table_name(i), 1, total_rows // tables) for i in range(1, tables + 1)}


def top_up(existing: DataFrame, name: str, rows: int) -> DataFrame:
    """The rows that bring a table to ``rows``: none when it is full; new ids follow the highest one.

    Only the count and the highest id, one row, come to the driver.
    """
    have = existing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()
    return benchmark_table(existing.sparkSession, name, have["top"] + 1, max(rows - have["n"], 0))


def topped_up(existing: DataFrame, name: str, rows: int) -> DataFrame:
    return existing.unionByName(top_up(existing, name, rows))


def mutations(ticks: DataFrame, tick: str, first_lsn: int = 1) -> DataFrame:
    """Change records of the mixed workload: each tick inserts one id, updates one and deletes one.

    A statement that hits no row leaves no change. Every seeded id of the deleted range goes within
    the first ``DELETED_IDS`` ticks and before its first update, so later deletes change nothing and
    updates change only the ids below that range.
    """
    i = F.col(tick).cast("bigint")

    def change(seq: int, op: str, row_id: Column, name: Column, qty: Column, hits: Column) -> Column:
        image = F.struct(name.alias("name"), qty.cast("string").alias("qty"))
        record = F.struct(
            F.lit(seq).alias("seq"),
            F.lit(op).alias("op"),
            F.struct(row_id.cast("string").alias("id")).alias("key"),
            F.when(F.lit(op != "D"), image).alias("after"),
        )
        return F.when(hits, record)

    inserted = i + FIRST_INSERT_ID
    updated = i % UPDATED_IDS + 1
    null = F.lit(None).cast("string")
    changes = F.array_compact(
        F.array(
            change(0, "I", inserted, F.concat(F.lit("ins-"), inserted.cast("string")), i * 7, F.lit(True)),
            change(1, "U", updated, F.concat(F.lit("upd-"), i.cast("string")), i * 11, updated < FIRST_DELETED_ID),
            change(2, "D", i % DELETED_IDS + FIRST_DELETED_ID, null, null, i < DELETED_IDS),
        )
    )
    return ticks.select((i + first_lsn).alias("lsn"), F.explode(changes).alias("c")).select(
        "lsn", "c.seq", F.lit("app").alias("schema_name"), F.lit("widgets").alias("table_name"), "c.op", "c.key", "c.after"
    )


def generate_mutations(spark: SparkSession, n_ticks: int, first_lsn: int = 1) -> DataFrame:
    return mutations(spark.range(n_ticks), "id", first_lsn)
