"""Inputs derived from the given tables: a second copy, change records, lag samples, logs.

There is one copy of the data only, so the other side and the streams are made from it by rule.
Each rule is written for both engines: a DataFrame here, a SQL text in the matching constant.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinproof.functions.logtext import ERROR_PREFIX, IGNORED_PREFIX
from twinproof.sources.snapshot import parquet_tables

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SCHEMA = "public"

SNAPSHOT_BEFORE = "2024-01-13 00:00:00"


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def source_tables(spark: SparkSession, sf: str, names: Iterable[str] = TABLES) -> dict[tuple[str, str], DataFrame]:
    return parquet_tables(spark, sf, names, SCHEMA)


# --- the other copy: orders lacks rows, customer has changed values, part is missing ------------

TARGET_ORDERS = "(SELECT * FROM orders WHERE o_orderkey % 100 <> 7)"
TARGET_CUSTOMER = (
    "(SELECT * REPLACE (CASE WHEN c_custkey % 50 = 3 THEN 'X' ELSE c_mktsegment END AS c_mktsegment) FROM customer)"
)


def target_of(source: Mapping[tuple[str, str], DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """The other side of these tables."""
    changed = F.when(F.expr("c_custkey % 50 = 3"), F.lit("X")).otherwise(F.col("c_mktsegment"))
    differ = {
        "orders": lambda df: df.filter("o_orderkey % 100 <> 7"),
        "customer": lambda df: df.withColumn("c_mktsegment", changed),
    }
    return {(s, t): differ.get(t, lambda df: df)(df) for (s, t), df in source.items() if t != "part"}


# --- table listing ------------------------------------------------------------------------------

LISTING = """
    SELECT DISTINCT
        CASE WHEN user_id % 11 = 0 THEN 'pg_catalog' WHEN user_id % 11 = 1 THEN 'pg_temp_3' ELSE event_type END AS schema_name,
        'user_' || (user_id % 40) AS table_name,
        user_id % 40 >= 36 AS is_partition
    FROM events"""


def listing(spark: SparkSession, sf: str) -> DataFrame:
    schema = F.when(F.expr("user_id % 11 = 0"), "pg_catalog").when(F.expr("user_id % 11 = 1"), "pg_temp_3")
    return (
        load(spark, sf, "events")
        .select(
            schema.otherwise(F.col("event_type")).alias("schema_name"),
            F.concat(F.lit("user_"), F.expr("user_id % 40").cast("string")).alias("table_name"),
            F.expr("user_id % 40 >= 36").alias("is_partition"),
        )
        .distinct()
    )


# --- change records -----------------------------------------------------------------------------

CHANGES = """
    SELECT event_id // 4 AS lsn, CAST(event_id % 4 AS INTEGER) AS seq,
        event_type AS schema_name, 'user_' || (user_id % 40) AS table_name,
        CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
        user_id, value, props, ts
    FROM events"""
CUT = f"(SELECT max(event_id) // 4 FROM events WHERE ts < TIMESTAMP '{SNAPSHOT_BEFORE}')"


def changes(spark: SparkSession, sf: str) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return load(spark, sf, "events").select(
        F.expr("event_id div 4").alias("lsn"),
        F.expr("cast(event_id % 4 AS int)").alias("seq"),
        F.col("event_type").alias("schema_name"),
        F.concat(F.lit("user_"), F.expr("user_id % 40").cast("string")).alias("table_name"),
        op.alias("op"),
        F.struct("user_id").alias("key"),
        F.struct("value", "props").alias("after"),
        "ts",
    )


def cut_lsn(spark: SparkSession, sf: str) -> int:
    """Position of the snapshot, one number."""
    before = load(spark, sf, "events").filter(F.col("ts") < F.lit(SNAPSHOT_BEFORE).cast("timestamp_ntz"))
    return before.agg(F.expr("max(event_id) div 4")).first()[0]


ROW_COLUMNS = ["user_id", "value", "props"]


# --- lag samples --------------------------------------------------------------------------------

LAG_SAMPLES = """
    SELECT event_type AS slot, event_id AS sample_no, ts, event_id * 100 AS source_lsn,
        CASE WHEN event_id % 17 = 5 THEN NULL
             ELSE greatest(event_id * 100 - CAST(floor(value * 10) AS BIGINT), 0) END AS confirmed_lsn
    FROM events"""
HELD_SAMPLES = """
    SELECT event_type AS slot, event_id AS sample_no, ts, event_id * 100 AS source_lsn,
        CASE WHEN event_id % 17 = 5 THEN NULL ELSE (event_id - event_id % 40) * 100 END AS confirmed_lsn
    FROM events"""


def _samples(spark: SparkSession, sf: str, confirmed: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("event_type").alias("slot"),
        F.col("event_id").alias("sample_no"),
        "ts",
        F.expr("event_id * 100").alias("source_lsn"),
        F.expr(f"CASE WHEN event_id % 17 = 5 THEN NULL ELSE {confirmed} END").alias("confirmed_lsn"),
    )


def lag_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples whose lag varies; every 17th poll failed."""
    return _samples(spark, sf, "greatest(event_id * 100 - CAST(floor(value * 10) AS BIGINT), 0L)")


def held_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples whose confirmed position stands still for a while, so that stalls occur."""
    return _samples(spark, sf, "(event_id - event_id % 40) * 100")


# --- logs ---------------------------------------------------------------------------------------

# first the line template per event_id % 7, then the same in SQL
_LINES = [
    (ERROR_PREFIX + "step ", " found that its index already exists"),
    (ERROR_PREFIX + "row ", " holds a number that is out of range"),
    (ERROR_PREFIX + "grant ", " stopped, permission denied  "),
    (ERROR_PREFIX + "the extension geo", " could not be made"),
    (ERROR_PREFIX + "worker ", " ran into a wall"),
    (IGNORED_PREFIX, " "),
    ("part no. ", " goes to postgresql://worker:open@sesame/7@store/db"),
]


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SQL_LINE = " ".join(
    f"WHEN {i} THEN {_sql_text(start)} || event_id || {_sql_text(end)}" for i, (start, end) in enumerate(_LINES)
)
RESTORE_LOG = f"SELECT 'log_' || (user_id % 4) AS log_id, event_id AS line_no, CASE event_id % 7 {_SQL_LINE} END AS line FROM events"


def restore_log(spark: SparkSession, sf: str) -> DataFrame:
    line: Column = F.lit(None)
    for i, (start, end) in enumerate(_LINES):
        text = F.concat(F.lit(start), F.col("event_id").cast("string"), F.lit(end))
        line = F.when(F.col("event_id") % 7 == i, text).otherwise(line)
    return load(spark, sf, "events").select(
        F.concat(F.lit("log_"), F.expr("user_id % 4").cast("string")).alias("log_id"),
        F.col("event_id").alias("line_no"),
        line.alias("line"),
    )


_STAGE_OF = {"view": "Dump", "click": "Restore", "signup": "Lag", "purchase": "CaughtUp", "error": "StreamApply"}
_SQL_STAGE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _STAGE_OF.items())
PROGRESS = f"SELECT 'run_' || (user_id % 8) AS run_id, ts, CASE event_type {_SQL_STAGE} END AS stage FROM events"


def progress(spark: SparkSession, sf: str) -> DataFrame:
    stage: Column = F.lit(None)
    for kind, name in _STAGE_OF.items():
        stage = F.when(F.col("event_type") == kind, name).otherwise(stage)
    return load(spark, sf, "events").select(
        F.concat(F.lit("run_"), F.expr("user_id % 8").cast("string")).alias("run_id"), "ts", stage.alias("stage")
    )


BEATS = f"SELECT slot AS log_id, sample_no AS line_no, source_lsn, confirmed_lsn AS applied_lsn FROM ({LAG_SAMPLES}) WHERE confirmed_lsn IS NOT NULL"
MARKS = """
    SELECT DISTINCT
        CASE o_custkey % 5 WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'signup' WHEN 3 THEN 'purchase' ELSE 'error' END AS log_id,
        o_orderkey AS line_no, o_orderkey * 100 + (o_custkey % 7) * 300 AS target_lsn
    FROM orders"""


def beats(spark: SparkSession, sf: str) -> DataFrame:
    return (
        lag_samples(spark, sf)
        .filter(F.col("confirmed_lsn").isNotNull())
        .select(
            F.col("slot").alias("log_id"),
            F.col("sample_no").alias("line_no"),
            "source_lsn",
            F.col("confirmed_lsn").alias("applied_lsn"),
        )
    )


def marks(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of interest in the heartbeat logs, one per order."""
    names = ["view", "click", "signup", "purchase", "error"]
    log_id = F.get(F.array(*[F.lit(n) for n in names]), F.expr("cast(o_custkey % 5 AS int)"))
    return (
        load(spark, sf, "orders")
        .select(
            log_id.alias("log_id"),
            F.col("o_orderkey").alias("line_no"),
            F.expr("o_orderkey * 100 + (o_custkey % 7) * 300").alias("target_lsn"),
        )
        .distinct()
    )


def micros(ts: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(ts))
