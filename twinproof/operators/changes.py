"""Row changes: last image per key, merge into a table, and changes that cannot apply.

A change record is ``lsn, seq, schema_name, table_name, op ('I','U','D'), key STRUCT, after STRUCT, ts``.
Order is ``(lsn, seq)``: one commit carries many changes at the same position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinproof.functions.lsn import lsn_literal, sortable_literal, sortable_position

POSITION = ["_pos", "_seq"]
LAST_SEQ = 2**31 - 1


def after(changes: DataFrame, lsn: int, seq: int | None = None) -> DataFrame:
    """Changes strictly past a position; without ``seq`` past the whole commit at ``lsn``."""
    at = lsn_literal(lsn, changes.schema["lsn"].dataType)
    later = F.col("lsn") > at
    return changes.filter(later if seq is None else later | ((F.col("lsn") == at) & (F.col("seq") > seq)))


def flatten(changes: DataFrame) -> DataFrame:
    """``keys, values, _op, _pos, _seq``: the row image with its sortable position."""
    return changes.select(
        "key.*",
        "after.*",
        F.col("op").alias("_op"),
        sortable_position(F.col("lsn"), changes.schema["lsn"].dataType).alias("_pos"),
        F.col("seq").alias("_seq"),
    )


def last_by_position(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the highest ``(_pos, _seq)`` of every key.

    ``row_number() = 1`` is planned as a per-task group limit before the shuffle, so a key with a
    third of all changes sends one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in POSITION])
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_per_key(changes: DataFrame) -> DataFrame:
    """Latest change record of every key of every table."""
    rows = changes.withColumn("_pos", sortable_position(F.col("lsn"), changes.schema["lsn"].dataType)).withColumn(
        "_seq", F.col("seq")
    )
    return last_by_position(rows, ["schema_name", "table_name", "key"]).drop(*POSITION)


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot with all changes applied, for changes that are later than the whole snapshot.

    Insert and update both put the row, delete removes it if there. The snapshot is never shuffled
    while the changed keys are few: AQE turns the anti join into a broadcast from measured size.
    """
    latest = last_by_position(flatten(changes), keys).drop(*POSITION)
    # the keys alone need no ranking: they are collapsed map-side
    untouched = snapshot.join(changes.select("key.*").select(*keys).distinct(), keys, "left_anti")
    return untouched.unionByName(latest.filter(F.col("_op") != "D").drop("_op").select(*snapshot.columns))


def merge_by_position(state: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, the later position winning per key. Deleted keys stay as ``_deleted`` rows.

    Merging is idempotent and does not depend on the order of deltas. ``state`` has unique keys. Its
    rows are read once and, while the changed keys are few, never shuffled; a second look at its key
    columns alone tells which keys are new.
    """
    latest = last_by_position(delta, keys)
    values = [c for c in state.columns if c not in keys]
    newer = latest.select(*keys, F.struct(*values).alias("_new"))
    later = (F.col("_new._pos") > F.col("_pos")) | ((F.col("_new._pos") == F.col("_pos")) & (F.col("_new._seq") > F.col("_seq")))
    picked = [F.when(later, F.col(f"_new.`{c}`")).otherwise(F.col(c)).alias(c) for c in values]
    kept = state.join(newer, keys, "left").select(*keys, *picked)
    known = state.select(*keys).join(delta.select(*keys).distinct(), keys, "left_semi")
    return kept.unionByName(latest.join(known, keys, "left_anti"))


def snapshot_as_state(snapshot: DataFrame, cut: int | Column) -> DataFrame:
    """Snapshot rows stamped with the position of the cut, in the form ``merge_by_position`` needs."""
    pos = F.lit(cut) if isinstance(cut, int) else cut
    return snapshot.select(
        "*", F.lit(False).alias("_deleted"), pos.cast("bigint").alias("_pos"), F.lit(LAST_SEQ).alias("_seq")
    )


def changes_as_delta(changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Last image per key of a set of changes, deletes as ``_deleted`` rows."""
    latest = last_by_position(flatten(changes), keys)
    return latest.select(*columns, (F.col("_op") == "D").alias("_deleted"), *POSITION)


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("_deleted")).drop("_deleted", *POSITION)


def cut_position(changes: DataFrame, cut_lsn: int) -> int:
    """``cut_lsn`` as ``_pos`` of these changes."""
    return sortable_literal(cut_lsn, changes.schema["lsn"].dataType)


def find_apply_conflicts(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Inserts whose key the snapshot already has, as happens when applied changes are sent again."""
    inserts = changes.filter(F.col("op") == "I").select("lsn", "seq", "schema_name", "table_name", "key.*")
    return inserts.join(snapshot.select(*keys), keys, "left_semi").select(
        "lsn", "seq", "schema_name", "table_name", *keys
    )


def unknown_tables(changes: DataFrame, target_catalog: DataFrame) -> DataFrame:
    """``schema_name, table_name, changes, first_lsn`` for changed tables the target does not have."""
    # grouped first: the join then sees one row per table instead of one per change
    per_table = changes.groupBy("schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("changes"), F.min("lsn").alias("first_lsn")
    )
    return per_table.join(target_catalog.select("schema_name", "table_name"), ["schema_name", "table_name"], "left_anti")
