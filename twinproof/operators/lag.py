"""Replication lag: states, stalls, polling cadence.

A sample is ``slot, sample_no, ts, source_lsn, confirmed_lsn``. Samples of a failed poll have a NULL
position and are ignored everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinproof.functions.logtext import heartbeat_stage
from twinproof.functions.lsn import lag_bytes
from twinproof.operators.ordered import CHUNK

STALL_EVERY = 3


def _good(samples: DataFrame) -> DataFrame:
    return samples.filter(F.col("source_lsn").isNotNull() & F.col("confirmed_lsn").isNotNull()).withColumn(
        "lag", lag_bytes(F.col("source_lsn"), F.col("confirmed_lsn"))
    )


def transition(before: Column, now: Column) -> Column:
    return (
        F.when(~before & now, "JustCaughtUp")
        .when(before & ~now, "FellBehind")
        .when(now, "StillCaughtUp")
        .otherwise("StillBehind")
    )


def lag_states(
    samples: DataFrame, threshold: int, prior: DataFrame | None = None, every: int = STALL_EVERY, chunk: int = CHUNK
) -> DataFrame:
    """Both state machines, caught-up and stalled, along the samples of every slot.

    ``slot, sample_no, source_lsn, confirmed_lsn, lag, caught_up, state, stale_run, stall``. ``prior``,
    one row per slot ``slot, sample_no, caught_up, confirmed_lsn, stale_run``, continues earlier
    samples; those not later than it are dropped, so sending a batch twice changes nothing.

    A slot is cut into chunks of ``chunk`` positions. Windows run inside a chunk; what crosses a
    border (last sample, rows so far, last fresh row) goes over one summary row per chunk. Rows and
    summaries share one shuffle, and no task needs a whole slot.
    """
    rows = _good(samples).withColumn("caught_up", F.col("lag") <= threshold)
    prior_columns = {"_p_no": "sample_no", "_p_caught": "caught_up", "_p_conf": "confirmed_lsn", "_p_run": "stale_run"}
    if prior is None:
        kinds = {"_p_caught": "boolean", "_p_conf": "decimal(20,0)", "_p_run": "bigint"}
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()})
    else:
        before = prior.select("slot", *[F.col(c).alias(p) for p, c in prior_columns.items()])
        rows = rows.join(before, "slot", "left")
        rows = rows.filter(F.col("_p_no").isNull() | (F.col("sample_no") > F.col("_p_no")))

    inside = Window.partitionBy("slot", "_chunk").orderBy("sample_no")
    local = rows.withColumn("_chunk", F.expr(f"sample_no div {chunk}")).select(
        "*",
        F.row_number().over(inside).alias("_i"),
        F.lag(F.struct("confirmed_lsn", "caught_up")).over(inside).alias("_before"),
    )
    same = F.coalesce((F.col("_before.confirmed_lsn") == F.col("confirmed_lsn")) & (F.col("lag") > 0), F.lit(False))
    # the first row of a chunk is judged by its summary
    fresh_here = F.max(F.when((F.col("_i") > 1) & ~F.col("_same"), F.col("_i"))).over(inside)
    local = local.withColumn("_same", same).withColumn("_fresh", fresh_here)

    along = Window.partitionBy("slot").orderBy("_chunk")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        local.groupBy("slot", "_chunk")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("_fresh").alias("_fresh_in"),
            F.min(F.struct("sample_no", "confirmed_lsn", "lag")).alias("_first"),
            F.max(F.struct("sample_no", "confirmed_lsn", "caught_up")).alias("_last"),
            *[F.any_value(c).alias(c) for c in ("_p_caught", "_p_conf")],
        )
        .select(
            "*",
            F.lag("_last").over(along).alias("_prev"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    last_confirmed = F.coalesce("_prev.confirmed_lsn", "_p_conf")
    first_stale = F.coalesce((last_confirmed == F.col("_first.confirmed_lsn")) & (F.col("_first.lag") > 0), F.lit(False))
    ends = ends.withColumn("_first_stale", first_stale)
    newest_in = F.coalesce(F.col("_offset") + F.col("_fresh_in"), F.when(~F.col("_first_stale"), F.col("_offset") + 1))
    ends = ends.withColumn("_newest_in", newest_in).select(
        "slot",
        "_chunk",
        "_offset",
        "_first_stale",
        F.coalesce("_prev.caught_up", "_p_caught", F.lit(False)).alias("_was"),
        F.max("_newest_in").over(earlier).alias("_newest_before"),
    )

    first = F.col("_i") == 1
    newest = F.coalesce(
        F.col("_offset") + F.col("_fresh"), F.when(~F.col("_first_stale"), F.col("_offset") + 1), F.col("_newest_before")
    )
    nth = F.col("_offset") + F.col("_i")
    # without a fresh row so far, the run began in an earlier batch
    run = F.coalesce(nth - newest, nth + F.coalesce("_p_run", F.lit(0)))
    was = F.when(first, F.col("_was")).otherwise(F.col("_before.caught_up"))
    stale = F.when(first, F.col("_first_stale")).otherwise(F.col("_same"))
    return local.join(ends, ["slot", "_chunk"], "left").select(
        "slot",
        "sample_no",
        "source_lsn",
        "confirmed_lsn",
        "lag",
        "caught_up",
        transition(was, F.col("caught_up")).alias("state"),
        run.alias("stale_run"),
        (stale & (run % every == 0)).alias("stall"),
    )


def lag_transitions(samples: DataFrame, threshold: int, chunk: int = CHUNK) -> DataFrame:
    """``slot, sample_no, lag, state``. A lag equal to the threshold counts as caught up; a slot starts behind."""
    return lag_states(samples, threshold, chunk=chunk).select("slot", "sample_no", "lag", "state")


def stalls(samples: DataFrame, every: int = STALL_EVERY, chunk: int = CHUNK) -> DataFrame:
    """``slot, sample_no, lag, stale_run`` where an alarm fires: each ``every``-th sample in a row
    with lag and no progress of the confirmed position."""
    states = lag_states(samples, 0, every=every, chunk=chunk)
    return states.filter("stall").select("slot", "sample_no", "lag", "stale_run")


def cadence(
    samples: DataFrame,
    threshold: int,
    fast_seconds: float,
    normal_seconds: float,
    window_seconds: int = 3,
    min_beats: int = 5,
    chunk_windows: int = 1024,
) -> DataFrame:
    """``slot, sample_no, stage, next_wait, beats, fast_enough``.

    ``beats`` counts the slot's samples in the window that ends at this one. Time is cut into
    chunks of ``chunk_windows`` windows; samples near the end of a chunk are repeated in the next
    one as history, so no task needs the whole slot.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts").cast("timestamp_ntz"))
    span = window_seconds * 1_000_000
    width = span * chunk_windows
    rows = _good(samples).select("slot", "sample_no", "lag", micros.alias("_us"))
    rows = rows.withColumn("_chunk", F.expr(f"floor(_us / {width})").cast("bigint"))
    reaches = F.expr(f"floor((_us + {span}) / {width})").cast("bigint")
    copies = rows.withColumn("_in", F.explode(F.sequence(F.col("_chunk"), reaches)))
    frame = Window.partitionBy("slot", "_in").orderBy("_us").rangeBetween(-span, 0)
    counted = copies.withColumn("beats", F.count(F.lit(1)).over(frame)).filter(F.col("_in") == F.col("_chunk"))
    wait = F.when(F.col("lag") <= threshold, F.lit(float(fast_seconds))).otherwise(F.lit(float(normal_seconds)))
    return counted.select(
        "slot",
        "sample_no",
        heartbeat_stage(F.col("lag")).alias("stage"),
        wait.alias("next_wait"),
        "beats",
        (F.col("beats") >= min_beats).alias("fast_enough"),
    )


def apply_stats(samples: DataFrame) -> DataFrame:
    """``slot, last_sample, last_applied_lsn, last_lag``: what the last good sample of a slot saw."""
    last = F.max_by(F.struct("confirmed_lsn", "lag"), "sample_no")
    return (
        _good(samples)
        .groupBy("slot")
        .agg(F.max("sample_no").alias("last_sample"), last.alias("_last"))
        .select("slot", "last_sample", F.col("_last.confirmed_lsn").alias("last_applied_lsn"), F.col("_last.lag").alias("last_lag"))
    )
