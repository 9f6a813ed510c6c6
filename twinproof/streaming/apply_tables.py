"""Continuous apply of one change stream into many tables.

A record is ``lsn, seq, schema_name, table_name, op, image``: the image is the row as JSON, for a delete its key.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinproof.functions.lsn import sortable_position
from twinproof.operators.changes import POSITION, after, find_apply_conflicts, last_by_position, live_rows, unknown_tables
from twinproof.operators.scope import Scope, filter_changes
from twinproof.sinks.files import exists, folders, remove
from twinproof.streaming.target import KeyedTable

Name = tuple[str, str]
RECORD = "lsn decimal(20,0), seq int, schema_name string, table_name string, op string, image string"


class UnfitImage(RuntimeError):
    """A change whose image is not a row of its table."""


def folder_of(name: Name) -> str:
    """A table's own folder name, of small letters, digits, ``_`` and ``-`` on any file system."""
    schema, table = (re.sub("[^a-z0-9_]", lambda m: f"-{ord(m[0]):x}-", part) for part in name)
    return f"{schema}/{table}"


def _image(table: KeyedTable) -> Column:
    return F.from_json("image", table.schema.simpleString(), {"mode": "PERMISSIVE"})


def unfit(changes: DataFrame, table: KeyedTable) -> DataFrame:
    """Changes whose image lacks a column of the table, has one more, or holds a value of another type.

    Inserts and updates name all columns, deletes at least the key. A field that is JSON null is a NULL value.
    """
    wanted = F.array(*[F.lit(c) for c in table.columns])
    keys = F.array(*[F.lit(k) for k in table.keys])

    def bad(read: Column) -> Column:
        fields, row = read["fields"], read["row"]
        missing = F.when(F.col("op") == "D", F.size(F.array_except(keys, fields)) > 0).otherwise(F.size(F.array_except(wanted, fields)) > 0)
        lost = F.lit(False)
        for f in table.schema.fields:
            lost = lost | (row[f.name].isNull() & F.get_json_object("image", f"$['{f.name}']").isNotNull())
        return fields.isNull() | missing | (F.size(F.array_except(fields, wanted)) > 0) | lost

    # as a variable: a column would be replaced by its expression, and the image parsed anew for each field
    read = F.array(F.struct(F.json_object_keys("image").alias("fields"), _image(table).alias("row")))
    return changes.filter(F.coalesce(F.exists(read, bad), F.lit(True)))


def first_unfit(changes: DataFrame, table: KeyedTable) -> Row | None:
    """``lsn, seq, image`` of the first change that does not fit, None if all do.

    The minimum of all looks at all partitions at once; to ask for any row looks at one, then at four more, and so on, and
    as a rule there is none to be found.
    """
    return unfit(changes, table).agg(F.min(F.struct("lsn", "seq", "image")).alias("bad")).first()["bad"]


def table_delta(changes: DataFrame, table: KeyedTable) -> DataFrame:
    """Last image per key of one table's changes."""
    position = sortable_position(F.col("lsn"), changes.schema["lsn"].dataType)
    flat = changes.select(_image(table).alias("_row"), "op", position.alias("_pos"), F.col("seq").alias("_seq")).select("_row.*", "op", *POSITION)
    return last_by_position(flat, table.keys).select(*table.columns, (F.col("op") == "D").alias("_deleted"), *POSITION)


@dataclass(frozen=True)
class Reports:
    """Where a stream leaves what it could not apply or found odd, a partition per batch."""

    root: str

    def unknown(self, spark) -> DataFrame:
        """``schema_name, table_name, changes, first_lsn`` per batch, for changed tables without a target."""
        return spark.read.schema("schema_name string, table_name string, changes bigint, first_lsn decimal(20,0), batch bigint").parquet(f"{self.root}/unknown")

    def conflicts(self, spark) -> DataFrame:
        """``schema_name, table_name, inserts, batch``: inserts whose key the table had."""
        schema = "schema_name string, table_name string, inserts bigint, batch bigint, part string"
        return spark.read.schema(schema).parquet(f"{self.root}/conflicts").drop("part")


def _conflicts(part: DataFrame, table: KeyedTable, name: Name) -> DataFrame:
    keyed = part.select("lsn", "seq", "schema_name", "table_name", "op", F.struct(*[_image(table)[k].alias(k) for k in table.keys]).alias("key"))
    inserted = keyed.filter(F.col("op") == "I").select("key.*")
    found = find_apply_conflicts(live_rows(table.state_of(inserted)).select(*table.keys), keyed, table.keys)
    return found.agg(F.count("*").alias("inserts")).select(F.lit(name[0]).alias("schema_name"), F.lit(name[1]).alias("table_name"), "inserts")


def apply_tables(
    changes: DataFrame,
    tables: dict[Name, KeyedTable],
    checkpoint: str,
    work: str,
    *,
    cut_lsn: int,
    scope: Scope | None = None,
    trigger: dict | None = None,
    fold_every: int = 0,
    at_once: int = 8,
) -> StreamingQuery:
    """Apply one stream of changes to all ``tables``, restartable from its checkpoint.

    A micro-batch is written once, partitioned by table, and each table merges its own partition, ``at_once`` of them
    side by side; the stream is read once whatever the number of tables. Every step puts its output in place of what it left
    before, so a batch that broke off is done again. An image that does not fit its table stops the stream before any table
    takes the batch. The staged batch goes when the next one begins; a table is compacted as soon as ``fold_every`` batches
    are open in it, so a long run lists few files. Of the tables only buckets are read that hold keys of the batch.
    """
    spark = changes.sparkSession
    runs = {name: table.bind(spark, f"{checkpoint}/tables/{folder_of(name)}") for name, table in tables.items()}
    known = spark.createDataFrame(list(tables), "schema_name string, table_name string")
    changes = after(filter_changes(changes, scope) if scope else changes, cut_lsn)

    def check(name: Name, part: DataFrame) -> None:
        if (bad := first_unfit(part, tables[name])) is not None:
            raise UnfitImage(f"{'.'.join(name)}: change {bad['lsn']}/{bad['seq']} does not fit: {bad['image']}")

    def take(name: Name, part: DataFrame, batch_id: int) -> None:
        noted, table = f"{work}/conflicts/batch={batch_id}/part={folder_of(name).replace('/', '.')}", tables[name]
        if not exists(spark, f"{noted}/_SUCCESS"):  # once the batch is in, all its inserts would look like conflicts
            _conflicts(part, table, name).write.mode("overwrite").parquet(noted)
        table.put_batch(table_delta(part, table), batch_id, runs[name])
        if fold_every and sum(map(len, table.open_batches(spark).values())) >= fold_every:
            table.compact(spark)

    def put(batch: DataFrame, batch_id: int) -> None:
        staging = f"{work}/staged"
        if exists(spark, staging):
            for old in folders(spark, staging):
                remove(spark, f"{staging}/{old}")
        here = f"{staging}/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("schema_name", "table_name").parquet(here)
        staged = spark.read.schema(batch.schema).parquet(here)
        unknown_tables(staged, known).write.mode("overwrite").parquet(f"{work}/unknown/batch={batch_id}")
        present = {tuple(r) for r in staged.select("schema_name", "table_name").distinct().collect()}  # names of tables
        parts = {n: staged.filter((F.col("schema_name") == n[0]) & (F.col("table_name") == n[1])) for n in tables if n in present}
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(check, parts, parts.values()))
            list(pool.map(lambda name: take(name, parts[name], batch_id), parts))

    return (
        changes.writeStream.foreachBatch(put)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
