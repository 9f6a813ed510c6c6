"""Text and JSON logs of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "stage string, message string, detail string, ts timestamp_ntz, run_id string"
LAG_SCHEMA = "slot string, sample_no bigint, ts timestamp_ntz, source_lsn decimal(20,0), confirmed_lsn decimal(20,0)"

# Keys of the heartbeat detail.
DETAIL_SCHEMA = (
    "lag_bytes decimal(20,0), source_lsn decimal(20,0), source_lsn_text string, received_lsn decimal(20,0), "
    "received_lsn_text string, applied_lsn decimal(20,0), applied_lsn_text string, target_lsn decimal(20,0), engine string"
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, value``: the number is the byte offset of the read split plus the order inside it.

    It rises with the lines of a file however many tasks read that file.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    in_task = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select("file", (F.col("_start") * 2 + in_task).alias("line_no"), "value")


def _events(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).select(
        "file", "line_no", "value", F.from_json("value", EVENT_SCHEMA).alias("e"), F.get_json_object("value", "$.detail").alias("detail")
    )


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, line_no, ts, stage, message, detail`` from one JSON event per line.

    The writer stamps no time: ``ts`` is NULL unless ingestion added one, and ``line_no`` gives the order. The
    file's path stands in for a missing ``run_id``. Lines that are no event are in ``read_bad_progress``.
    """
    return _events(spark, path).filter(F.col("e.stage").isNotNull()).select(
        F.coalesce("e.run_id", "file").alias("run_id"),
        "line_no",
        "e.ts",
        "e.stage",
        "e.message",
        F.from_json("detail", DETAIL_SCHEMA).alias("detail"),
    )


def read_bad_progress(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of the lines that are no event; blank lines do not count."""
    bad = _events(spark, path).filter(F.col("e.stage").isNull() & (F.trim("value") != ""))
    return bad.select("file", "line_no", F.col("value").alias("line"))


def read_restore_log(spark: SparkSession, path: str) -> DataFrame:
    """``log_id, line_no, line`` of text logs; ``log_id`` is the path of the file."""
    return _lines(spark, path).select(F.col("file").alias("log_id"), "line_no", F.col("value").alias("line"))


def read_lag_samples(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Lag samples as a table or a stream."""
    reader = (spark.readStream if stream else spark.read).schema(LAG_SCHEMA)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)
