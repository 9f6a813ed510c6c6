"""Running aggregates along an integer position, without one task per group.

A plain window over ``partitionBy(slot)`` sorts all rows of a slot in one task. Here a slot is cut
into chunks of the position; windows run inside a chunk, and one summary row per chunk carries the
running value over to the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 18


@dataclass(frozen=True)
class Running:
    """``sum`` or ``max`` of ``value`` over the rows up to here, with or without the current row."""

    how: Literal["sum", "max"]
    value: Column
    inclusive: bool = True


def running(df: DataFrame, by: list[str], position: str, columns: dict[str, Running], chunk: int = CHUNK) -> DataFrame:
    """Add the running columns. ``by`` must not be NULL, ``position`` is an integer unique within ``by``.

    A chunk spans ``chunk`` positions and so holds at most that many rows (twice that around zero).
    The summaries are aggregated on the map side; their own window sees one row per chunk.
    """
    fold = {"sum": F.sum, "max": F.max}
    inputs = {name: f"_in_{name}" for name in columns}
    rows = df.select(
        "*",
        F.expr(f"`{position}` div {chunk}").alias("_chunk"),
        *[spec.value.alias(inputs[name]) for name, spec in columns.items()],
    )

    inside = Window.partitionBy(*by, "_chunk").orderBy(position)
    local = rows
    for name, spec in columns.items():
        frame = inside.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
        local = local.withColumn(f"_loc_{name}", fold[spec.how](inputs[name]).over(frame))

    totals = rows.groupBy(*by, "_chunk").agg(*[fold[s.how](inputs[n]).alias(f"_tot_{n}") for n, s in columns.items()])
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by, "_chunk", *[fold[s.how](f"_tot_{n}").over(before).alias(f"_car_{n}") for n, s in columns.items()]
    )

    # windows and join share the (by, _chunk) partitioning, so the rows are shuffled once
    joined = local.join(carried, [*by, "_chunk"], "left")
    out: list[Column] = [F.col(c) for c in df.columns]
    for name, spec in columns.items():
        here, past = F.col(f"_loc_{name}"), F.col(f"_car_{name}")
        if spec.how == "max":
            value = F.greatest(here, past)
        else:
            value = F.coalesce(here + past, here, past)
        out.append(value.alias(name))
    return joined.select(*out)
