"""The change stream: row changes after the snapshot position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twinproof.operators.changes import after
from twinproof.operators.scope import Scope, filter_changes


def change_schema(key: T.StructType, row: T.StructType, lsn: str = "decimal(20,0)") -> T.StructType:
    """Schema of a change record for tables with this key and these other columns."""
    return (
        T.StructType()
        .add("lsn", T._parse_datatype_string(lsn))
        .add("seq", T.IntegerType())
        .add("schema_name", T.StringType())
        .add("table_name", T.StringType())
        .add("op", T.StringType())
        .add("key", key)
        .add("after", row)
        .add("ts", T.TimestampNTZType())
    )


def read_changes(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    scope: Scope | None = None,
    after_lsn: int | None = None,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    stream: bool = True,
) -> DataFrame:
    """Change records in scope and past the position, as a stream or as a table.

    The schema is fixed for the run. ``files_per_batch`` bounds a micro-batch.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).schema(schema)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    changes = reader.load(path)
    if scope is not None:
        changes = filter_changes(changes, scope)
    return changes if after_lsn is None else after(changes, after_lsn)
