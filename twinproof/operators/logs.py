"""Reading a run from its own logs: error summaries, stage times, heartbeats by position.

A restore log is ``log_id, line_no, line``; progress events are ``run_id, ts, stage``; heartbeats are
``log_id, line_no, source_lsn, applied_lsn``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinproof.functions.logtext import (
    CATEGORIES,
    ERROR_PREFIX,
    classify_lowered,
    heartbeat_fields,
    reported_ignored,
    severity_rank,
    strip_error_prefix,
)
from twinproof.operators.ordered import CHUNK, Running, running

SAMPLES_PER_CATEGORY = 5

# Verdict of a restore log.
REVIEW = "REVIEW REQUIRED"
NO_ERRORS = "no errors captured"
LIKELY_SAFE = "likely safe"


def error_lines(log: DataFrame) -> DataFrame:
    """``log_id, line_no, message, category`` of the error lines."""
    # the prefix test reaches the scan; text is converted once per line, in a projection of its own
    found = log.filter(F.col("line").startswith(ERROR_PREFIX)).select(
        "log_id", "line_no", strip_error_prefix(F.col("line")).alias("message")
    )
    lowered = found.filter(F.col("message").isNotNull()).withColumn("_lowered", F.lower("message"))
    return lowered.select("log_id", "line_no", "message", classify_lowered(F.col("_lowered")).alias("category"))


def summarise_errors(log: DataFrame) -> DataFrame:
    """``log_id, category, errors`` per category and, with category ``total``, per log."""
    counted = error_lines(log).rollup("log_id", "category").agg(F.count(F.lit(1)).alias("errors"))
    return counted.filter(F.col("log_id").isNotNull()).select(
        "log_id", F.coalesce("category", F.lit("total")).alias("category"), "errors"
    )


def order_by_severity(df: DataFrame) -> DataFrame:
    """Most severe category first."""
    return df.orderBy(severity_rank(F.col("category")).asc_nulls_last())


def error_samples(log: DataFrame, n: int = SAMPLES_PER_CATEGORY) -> DataFrame:
    """``log_id, category, nth, line_no, message``: the first ``n`` lines per category, in log order.

    The rank filter is pushed below the shuffle as a group limit: each task sends at most ``n`` rows
    per category.
    """
    first = Window.partitionBy("log_id", "category").orderBy("line_no")
    ranked = error_lines(log).withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= n)
    return ranked.select("log_id", "category", "nth", "line_no", "message")


def restore_verdict(log: DataFrame) -> DataFrame:
    """``log_id, errors, data_loss, reported, verdict``; the last reported number wins."""
    text = log.select(
        "log_id",
        "line_no",
        F.lower(strip_error_prefix(F.col("line"))).alias("_lowered"),
        reported_ignored(F.col("line")).alias("_n"),
    )
    rows = text.select("log_id", "line_no", "_n", classify_lowered(F.col("_lowered")).alias("category"))
    totals = rows.groupBy("log_id").agg(
        F.count("category").alias("errors"),
        F.count_if(F.col("category") == CATEGORIES[0]).alias("data_loss"),
        F.max(F.when(F.col("_n").isNotNull(), F.struct("line_no", F.col("_n").alias("n")))).alias("_last"),
    )
    verdict = F.when(F.col("data_loss") > 0, REVIEW).when(F.col("errors") == 0, NO_ERRORS).otherwise(LIKELY_SAFE)
    return totals.select("log_id", "errors", "data_loss", F.col("_last.n").alias("reported"), verdict.alias("verdict"))


def stage_timeline(events: DataFrame) -> DataFrame:
    """``run_id, stage, events, started, ended, seconds``: a stage ends where the next one starts.

    Stages come in the order of their first event: by time, then by ``line_no`` where there is one, then by name.
    Without times there are no durations. Events are reduced to one row per stage first; the window then sees a
    handful of rows per run.
    """
    line = F.col("line_no") if "line_no" in events.columns else F.lit(None).cast("bigint")
    stages = events.groupBy("run_id", "stage").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("ts").alias("started"),
        F.max("ts").alias("_last"),
        F.min(F.struct("ts", line.alias("line_no"))).alias("_first"),
    )
    order = Window.partitionBy("run_id").orderBy("_first", "stage")
    ended = F.coalesce(F.lead("started").over(order), F.col("_last"))
    seconds = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("ended")) / F.lit(1e6)
    return stages.withColumn("ended", ended).select("run_id", "stage", "events", "started", "ended", seconds.alias("seconds"))


def caught_up_time(events: DataFrame) -> DataFrame:
    """``run_id, first_seconds, last_seconds`` from the first event to the first and the last CaughtUp."""
    caught = F.when(F.col("stage") == "CaughtUp", F.col("ts"))
    times = events.groupBy("run_id").agg(
        F.min("ts").alias("_start"), F.min(caught).alias("_first"), F.max(caught).alias("_last")
    )

    def seconds(col: str):
        return F.timestamp_diff("MICROSECOND", F.col("_start"), F.col(col)) / F.lit(1e6)

    return times.select("run_id", seconds("_first").alias("first_seconds"), seconds("_last").alias("last_seconds"))


def heartbeats(log: DataFrame) -> DataFrame:
    """Heartbeat lines of a text log as rows."""
    found = log.select("log_id", "line_no", heartbeat_fields(F.col("line")).alias("h")).filter(F.col("h").isNotNull())
    return found.select("log_id", "line_no", "h.*")


def heartbeat_as_of(beats: DataFrame, marks: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``log_id, line_no, beat_line, source_lsn, applied_lsn``: the latest heartbeat at or before each mark.

    Marks and heartbeats are merged into one ordered stream and the heartbeat is carried forward;
    nothing is paired, so the cost is one sort whatever the number of marks.
    """
    value = F.struct(F.col("line_no").alias("beat_line"), "source_lsn", "applied_lsn")
    # even positions for heartbeats, odd ones for marks: a heartbeat on the mark's own line counts
    left = beats.select("log_id", "line_no", (F.col("line_no") * 2).alias("_at"), value.alias("_beat"))
    right = marks.select("log_id", "line_no").distinct().select("log_id", "line_no", (F.col("line_no") * 2 + 1).alias("_at"))
    rows = left.unionByName(right, allowMissingColumns=True)
    carried = running(rows, ["log_id"], "_at", {"_last": Running("max", F.col("_beat"))}, chunk)
    return carried.filter(F.col("_at") % 2 == 1).select("log_id", "line_no", "_last.*")


_BITS = 8


def _blocks(beats: DataFrame, bits: int) -> list[DataFrame]:
    """Per level ``log_id, _b, _kids, _max``: blocks of ``2^bits`` members of the level below, lines first, with their highest position.

    There are as many levels as the largest line number has groups of ``bits`` bits, so the last has one block per log. Each is
    built from the one below it; only the first reads lines.
    """
    most = beats.agg(F.max("line_no")).first()[0] or 0
    levels, members = [], beats.select("log_id", F.col("line_no").alias("pos"), F.col("applied_lsn").alias("top"))
    for _ in range(max(1, -(-int(most).bit_length() // bits))):
        kids = F.sort_array(F.collect_list(F.struct("pos", "top"))).alias("_kids")  # 2^bits at most
        levels.append(members.groupBy("log_id", F.shiftright("pos", bits).alias("_b")).agg(kids, F.max("top").alias("_max")))
        members = levels[-1].select("log_id", F.col("_b").alias("pos"), F.col("_max").alias("top"))
    return levels


def first_reaching(beats: DataFrame, marks: DataFrame, bits: int = _BITS) -> DataFrame:
    """``log_id, line_no, target_lsn, reached_line, reached_lsn``: the first heartbeat strictly after
    ``line_no`` whose applied position is at least ``target_lsn``; NULL when there is none.

    An inequality join on two columns would pair every mark with every later line. Here lines are in blocks, blocks in larger
    blocks, each with its highest position. A mark looks for the first fitting member of its own block; only marks that
    are still open look into the enclosing one. Marks that found a block walk down to the line. Each step is an equi-join with
    one block of at most ``2^bits`` members, and a mark that is answered takes part in none of those that follow.

    Lines are numbered from 0 or above, each number once in a log; marks may stand before the first or after the last line.
    """
    open_ = marks.select("log_id", "line_no", "target_lsn").distinct()
    levels = _blocks(beats, bits)
    hits: list[DataFrame] = []

    def look(cursor: DataFrame, level: int, block: Column, behind: Column) -> DataFrame:
        """First member past ``behind`` that reaches the target, as ``_hit``."""
        found = cursor.withColumn("_b", block).join(levels[level], ["log_id", "_b"], "left")
        fits = F.filter("_kids", lambda k: (k["pos"] > behind) & (k["top"] >= F.col("target_lsn")))
        hit = F.when(F.col("_max") >= F.col("target_lsn"), F.get(fits, F.lit(0))).alias("_hit")
        return found.select("log_id", "line_no", "target_lsn", hit)

    for level in range(len(levels)):
        own = F.shiftright(F.greatest("line_no", F.lit(0)), bits * (level + 1))
        found = look(open_, level, own, F.shiftright("line_no", bits * level))
        hits.append(found.filter(F.col("_hit").isNotNull()))
        open_ = found.filter(F.col("_hit").isNull()).drop("_hit")
    reached = hits.pop()
    while hits:
        below = look(reached, len(hits) - 1, F.col("_hit.pos"), F.lit(-1))
        reached = hits.pop().unionByName(below)
    none = reached.schema["_hit"].dataType
    answers = reached.unionByName(open_.withColumn("_hit", F.lit(None).cast(none)))
    return answers.select("log_id", "line_no", "target_lsn", F.col("_hit.pos").alias("reached_line"), F.col("_hit.top").alias("reached_lsn"))
