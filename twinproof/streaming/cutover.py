"""Ending a run: drain, prove equal, stop, move the marks."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from twinproof.operators.content import is_converged
from twinproof.operators.marks import sync_marks


class NotConverged(RuntimeError):
    """The copy differs from its source, so the stream was left running."""


@dataclass(frozen=True)
class Cutover:
    source_digest: str | None
    target_digest: str | None
    converged: bool
    marks: DataFrame | None


def wait_until_idle(query: StreamingQuery, seconds: float = 600) -> None:
    """Wait until the stream has nothing to do, for at most ``seconds``. For sources that are at rest."""
    deadline = time.monotonic() + seconds
    idle = 0
    while query.isActive and idle < 2:
        if time.monotonic() > deadline:
            raise TimeoutError(f"changes still arrive after {seconds} s: stop at a position instead")
        status = query.status
        # a trigger that found no data, seen twice, with at least one trigger behind it
        busy = status["isDataAvailable"] or status["isTriggerActive"] or query.lastProgress is None
        idle = 0 if busy else idle + 1
        time.sleep(0.2)
    if error := query.exception():
        raise error


def drain_and_stop(query: StreamingQuery, wait: bool = True) -> None:
    """Take in all data there is, then stop. Calling it again does nothing."""
    if query.isActive:
        if wait:
            wait_until_idle(query)
        query.stop()


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Bounded run: stop after ``seconds`` unless the query ended by itself; true when it did."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


def cutover(
    query: StreamingQuery,
    source: DataFrame,
    target,
    keys: list[str],
    cols: list[str],
    source_marks: DataFrame | None = None,
    target_marks: DataFrame | None = None,
    strict: bool = True,
) -> Cutover:
    """Operator's switch; low lag alone never stops a stream.

    ``target`` is a function that reads the copy, called once the stream is drained. Equality is
    checked before the stop; when strict, a copy that differs keeps its stream.
    """
    if query.isActive:
        wait_until_idle(query)
    gate = is_converged(source, target(), keys, cols).first()
    if strict and not gate["converged"]:
        raise NotConverged(f"source {gate['source_digest']}, target {gate['target_digest']}")
    drain_and_stop(query, wait=False)
    marks = sync_marks(source_marks, target_marks) if source_marks is not None and target_marks is not None else None
    return Cutover(gate["source_digest"], gate["target_digest"], gate["converged"], marks)
