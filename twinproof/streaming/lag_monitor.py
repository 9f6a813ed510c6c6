"""Lag states and stall alarms over a stream of lag samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from twinproof.functions.logtext import heartbeat_stage
from twinproof.functions.lsn import format_lsn
from twinproof.operators.lag import STALL_EVERY, lag_states
from twinproof.operators.ordered import CHUNK
from twinproof.sinks.files import exists, remove

_PRIOR = "slot string, sample_no bigint, caught_up boolean, confirmed_lsn decimal(20,0), stale_run bigint"


def _carried(path: str, batch_id: int) -> str:
    return f"{path}/carried/{batch_id}"


def _prior(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """State after the batch before this one; batch numbers have no gaps, restarts included."""
    before = _carried(path, batch_id - 1)
    return spark.read.schema(_PRIOR).parquet(before) if exists(spark, before) else spark.createDataFrame([], _PRIOR)


def lag_monitor(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    *,
    threshold: int,
    every: int = STALL_EVERY,
    chunk: int = CHUNK,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write ``lag_states`` of every sample to ``path/states``, one part per micro-batch.

    A per-slot state function would run all samples of a slot one by one in one task. Here each
    batch runs the chunked window jobs, and one row per slot goes on to the next batch. Both are
    named by the batch, so a batch that runs again reads the same state and writes the same.
    """
    states = f"{path}/states"

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        prior = _prior(session, path, batch_id)
        found = lag_states(batch, threshold, prior, every, chunk)
        # the batch's own folder: earlier batches are neither listed nor opened
        here = f"{states}/_batch={batch_id}"
        found.write.mode("overwrite").parquet(here)
        done = session.read.schema(found.schema).parquet(here)
        after = F.struct("caught_up", F.col("confirmed_lsn").cast("decimal(20,0)").alias("confirmed_lsn"), "stale_run")
        last = done.groupBy("slot").agg(F.max("sample_no").alias("sample_no"), F.max_by(after, "sample_no").alias("s"))
        moved = last.select("slot", "sample_no", "s.*")
        everything = moved.unionByName(prior.join(moved, "slot", "left_anti"))
        everything.write.mode("overwrite").parquet(_carried(path, batch_id))
        # a batch that runs again needs the one before it and nothing older
        remove(session, _carried(path, batch_id - 2))

    return (
        samples.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/states").drop("_batch")


def progress_events(states: DataFrame, engine: str = "spark") -> DataFrame:
    """``slot, sample_no, seq, stage, message, detail``: one heartbeat per sample, and an event after it
    when the slot caught up or fell behind."""
    # The words of the heartbeat message, which ``heartbeat_fields`` reads, and the keys of its detail.
    lag, source, applied = F.col("lag"), F.col("source_lsn"), F.col("confirmed_lsn")
    n = {name: c.cast("string") for name, c in (("lag", lag), ("source", source), ("applied", applied))}
    source_text, applied_text = format_lsn(source), format_lsn(applied)
    beat = F.struct(
        F.lit(0).alias("seq"),
        heartbeat_stage(lag).alias("stage"),
        F.concat(
            F.lit("replication lag "), n["lag"], F.lit(" bytes, source LSN "), n["source"], F.lit(" ["), source_text,
            F.lit("], received LSN "), n["applied"], F.lit(" ["), applied_text,
            F.lit("], applied LSN "), n["applied"], F.lit(" ["), applied_text, F.lit("]"),
        ).alias("message"),
        F.to_json(
            F.struct(
                lag.alias("lag_bytes"),
                source.alias("source_lsn"),
                source_text.alias("source_lsn_text"),
                applied.alias("received_lsn"),
                applied_text.alias("received_lsn_text"),
                applied.alias("applied_lsn"),
                applied_text.alias("applied_lsn_text"),
                F.lit(engine).alias("engine"),
            )
        ).alias("detail"),
    )
    detail = F.to_json(
        F.struct(lag.alias("lag_bytes"), source.alias("source_lsn"), applied.alias("target_lsn"), F.lit(engine).alias("engine"))
    )

    def crossing(stage: str, start: str, end: str):
        text = F.concat(F.lit(start), n["lag"], F.lit(end))
        return F.struct(F.lit(1).alias("seq"), F.lit(stage).alias("stage"), text.alias("message"), detail.alias("detail"))

    crossed = (
        F.when(F.col("state") == "JustCaughtUp", crossing("CaughtUp", "target caught up with source (lag ", " bytes)"))
        .when(F.col("state") == "FellBehind", crossing("StreamApply", "target fell behind (lag ", " bytes)"))
    )
    return states.select("slot", "sample_no", F.explode(F.array_compact(F.array(beat, crossed))).alias("e")).select("slot", "sample_no", "e.*")
