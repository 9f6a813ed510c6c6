"""Snapshot copy plus change apply: the whole run for one table, and for a set of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

from twinproof.functions.lsn import lsn_of_sortable
from twinproof.operators.changes import cut_position
from twinproof.operators.content import is_converged
from twinproof.operators.counts import TableMap
from twinproof.operators.marks import sync_marks
from twinproof.operators.scope import Scope
from twinproof.streaming.apply import apply_stream
from twinproof.streaming.apply_tables import Name, apply_tables
from twinproof.streaming.cutover import Cutover, NotConverged
from twinproof.streaming.target import KeyedTable, TargetMismatch


def copy_online(
    snapshot: DataFrame,
    changes: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    *,
    cut_lsn: int,
    source_now: Callable[[], DataFrame] | None = None,
    source_at: Callable[[int], DataFrame] | None = None,
    cols: list[str],
    scope: Scope | None = None,
    source_marks: DataFrame | None = None,
    target_marks: DataFrame | None = None,
    fold_every: int = 0,
) -> Cutover:
    """Load the snapshot at ``cut_lsn``, apply the changes there are, prove equality, cut over.

    The cut is fixed before anything is read: rows up to it come from the snapshot, rows past
    it from the stream, so there is neither a gap nor a double. Run again after it broke off anywhere, it
    goes on: a table with a commit is never created anew, and its checkpoint carries on. A table of another cut, or
    a checkpoint of another table, is refused.

    The stream ends by itself once it has taken what was there when it began, however much keeps arriving.
    The copy then stands at the last position it took. ``source_at(position)`` is the source as of that position;
    ``source_now`` may be given instead when the source is at rest. Marks are moved last.
    """
    spark, cut = snapshot.sparkSession, cut_position(changes, cut_lsn)
    have = table.identity(spark)
    if have is None:
        table.create(snapshot, cut)
    elif have[1] != cut:
        raise TargetMismatch(f"{table.path} was created at another cut than {cut_lsn}")
    query = apply_stream(changes, table, checkpoint, cut_lsn=cut_lsn, scope=scope, fold_every=fold_every)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    last = table.last_position(spark)
    position = lsn_of_sortable(last[0] if last else cut, changes.schema["lsn"].dataType)
    source = source_at(position) if source_at else source_now()
    gate = is_converged(source, table.read(spark), table.keys, cols).first()
    if not gate["converged"]:
        raise NotConverged(f"source {gate['source_digest']}, target {gate['target_digest']} at {position}")
    marks = sync_marks(source_marks, target_marks) if source_marks is not None and target_marks is not None else None
    return Cutover(gate["source_digest"], gate["target_digest"], True, marks)


@dataclass(frozen=True)
class CutoverOfTables:
    """``position`` all tables stand at, the digest each has in common with its source, and the marks that were moved."""

    position: int
    digests: Mapping[Name, str]
    marks: DataFrame | None


def copy_online_tables(
    snapshot: TableMap,
    changes: DataFrame,
    tables: Mapping[Name, KeyedTable],
    checkpoint: str,
    work: str,
    *,
    cut_lsn: int,
    source_at: Callable[[int], TableMap],
    scope: Scope | None = None,
    source_marks: DataFrame | None = None,
    target_marks: DataFrame | None = None,
    fold_every: int = 16,
    at_once: int = 8,
) -> CutoverOfTables:
    """``copy_online`` for a set of tables that share one change stream.

    All snapshots are of the same cut. A table with a commit is not loaded again, so a run that broke off between two tables
    loads the rest. After the stream all tables stand at one position, the highest any of them took, and each is
    compared with its source as of that position; marks are moved only if all are equal. Tables outside ``tables`` show up in
    ``Reports(work).unknown``.
    """
    spark, cut = changes.sparkSession, cut_position(changes, cut_lsn)

    def load(name: Name) -> None:
        have = tables[name].identity(spark)
        if have is None:
            tables[name].create(snapshot[name], cut)
        elif have[1] != cut:
            raise TargetMismatch(f"{tables[name].path} was created at another cut than {cut_lsn}")

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(load, tables))
    query = apply_tables(changes, dict(tables), checkpoint, work, cut_lsn=cut_lsn, scope=scope, fold_every=fold_every, at_once=at_once)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    with ThreadPoolExecutor(at_once) as pool:
        reached = [last[0] for last in pool.map(lambda t: t.last_position(spark), tables.values()) if last]
        position = lsn_of_sortable(max(reached, default=cut), changes.schema["lsn"].dataType)
        source = source_at(position)

        def gate(name: Name):
            return is_converged(source[name], tables[name].read(spark), tables[name].keys, tables[name].columns).first()

        gates = dict(zip(tables, pool.map(gate, tables)))
    # unlike the gate of one table, two empty ones are equal here: a set may well have some
    if differ := [".".join(name) for name, found in gates.items() if found["source_digest"] != found["target_digest"]]:
        raise NotConverged(f"{', '.join(differ)} differ at {position}")
    marks = sync_marks(source_marks, target_marks) if source_marks is not None and target_marks is not None else None
    return CutoverOfTables(position, {name: found["target_digest"] for name, found in gates.items()}, marks)
