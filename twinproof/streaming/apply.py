"""Continuous change apply into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from twinproof.operators.changes import after, changes_as_delta
from twinproof.operators.scope import Scope, filter_changes
from twinproof.streaming.target import KeyedTable


def apply_stream(
    changes: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    cut_lsn: int,
    scope: Scope | None = None,
    trigger: dict | None = None,
    fold_every: int = 0,
) -> StreamingQuery:
    """Apply every change past ``cut_lsn`` to the table, restartable from its checkpoint.

    The filter compares with the snapshot's cut and never with the highest position seen, so a file
    that arrives late is still merged by position. A micro-batch that runs again after a failure
    overwrites its own part. ``trigger`` defaults to all available data, then stop. ``fold_every``
    compacts the table after that many batches, so that a long stream's readers list few of them.
    """
    run = table.bind(changes.sparkSession, checkpoint)
    if scope is not None:
        changes = filter_changes(changes, scope)
    changes = after(changes, cut_lsn)

    def put(batch: DataFrame, batch_id: int) -> None:
        table.put_batch(changes_as_delta(batch, table.keys, table.columns), batch_id, run)
        if fold_every and (batch_id + 1) % fold_every == 0:
            table.compact(batch.sparkSession)

    return (
        changes.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
