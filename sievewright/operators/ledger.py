"""The outcome ledger: latest entries, failure-inclusive cost, failure runs, active time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators.ordered import lookback, scan

#: The closed set of a ledger entry's keys, fixed values.
KEYS = ("candidate_id", "source_id", "attempt_index", "sequence", "outcome", "error_code", "attempt_elapsed_seconds", "stage_seconds", "timing_complete", "cleanup_state", "accepted_cost_seconds", "accepted_active_watermark")
FATAL_ERRORS = 3


def unknown_keys(columns: list[str]) -> list[str]:
    return sorted(set(columns) - set(KEYS))


def costs(attempts: DataFrame, order: str, spent: str, is_accepted: Column) -> DataFrame:
    """Accepted attempts with watermark (all that was spent so far) and cost (since the accepted one before)."""
    marked = scan(attempts, order, {"watermark": F.col(spent)}, {"before": ("watermark", is_accepted)})
    return marked.where(is_accepted).withColumn("cost", F.col("watermark") - F.coalesce("before", F.lit(0))).drop("before")


def pending(attempts: DataFrame, order: str, spent: str, is_accepted: Column) -> DataFrame:
    """One row: total, allocated (the last accepted watermark), pending."""
    last = attempts.where(is_accepted).agg(F.max(order).alias("last"))
    sums = attempts.join(F.broadcast(last), F.lit(True), "left").agg(F.sum(spent).alias("total"), F.sum(F.when(F.col(order) <= F.col("last"), F.col(spent)).otherwise(0)).alias("allocated"))
    return sums.select("total", "allocated", F.greatest(F.lit(0), F.col("total") - F.col("allocated")).alias("pending"))


def failure_runs(attempts: DataFrame, order: str, failed: Column) -> DataFrame:
    """Failed attempts with run (a number that counts the successes before) and nth (position within the run).

    The place in a run is the number of failures so far less that at the last success, in one scan: a run may be as long
    as the ledger.
    """
    counts = {"run": F.when(failed, 0).otherwise(1), "_fails": F.when(failed, 1).otherwise(0)}
    marked = scan(attempts, order, counts, {"_before": ("_fails", ~failed)}).where(failed)
    return marked.withColumn("nth", (F.col("_fails") - F.coalesce("_before", F.lit(0))).cast("int")).drop("_fails", "_before")


def fatal_at(attempts: DataFrame, order: str, failed: Column, limit: int = FATAL_ERRORS) -> DataFrame:
    """One row: where the first run of ``limit`` failures is complete; null if there is none."""
    return failure_runs(attempts, order, failed).where(F.col("nth") == limit).agg(F.min(order).alias("fatal_at"))


def active_segments(marks: DataFrame, key: str, order: str, is_start: Column, at: str) -> DataFrame:
    """Time from each start to the mark after it, by key: segments, active, timing_complete (every start has an end)."""
    of = Window.partitionBy(key).orderBy(order)
    rows = marks.withColumn("_start", is_start).withColumn("_next", F.lead(at).over(of)).withColumn("_next_start", F.lead("_start").over(of))
    ended = F.col("_next").isNotNull() & ~F.col("_next_start")
    return rows.where("_start").groupBy(key).agg(F.count("*").alias("segments"), F.coalesce(F.sum(F.when(ended, F.col("_next") - F.col(at))), F.lit(0)).alias("active"), F.bool_and(ended).alias("timing_complete"))


def active_clock(marks: DataFrame, key: str, at: str, tie: str, bucket: Column) -> DataFrame:
    """The active time of each key's runs, over pauses, restarts and crashes.

    ``marks``: key, ``at``, ``tie`` (orders equal times), kind (start, checkpoint, end), overhead (of starts; null: none). While
    a clock runs, from a start to an end, each mark adds the time since the mark before; a start adds its overhead. A start
    while the clock runs means a crash: what came after the last mark is lost, and timing isn't complete. Result: segments,
    overhead, active (with overhead), crashes, timing_complete, running (the last start has no end). ``bucket`` cuts the
    times of a key, so a hot key is split.
    """
    state = F.when(F.col("kind") != "checkpoint", F.col("kind"))
    rows = lookback(marks, key, [at, tie], {"_state": state, "_before": F.col(at)}, bucket)
    runs = F.coalesce(F.col("_state") == "start", F.lit(False))
    start = F.col("kind") == "start"
    spent = F.when(runs & ~start, F.greatest(F.lit(0), F.col(at) - F.col("_before"))).otherwise(F.lit(0))
    over = F.when(start, F.coalesce("overhead", F.lit(0))).otherwise(F.lit(0))
    by = rows.groupBy(key).agg(
        F.count_if(start).alias("segments"),
        F.sum(over).alias("overhead"),
        F.sum(spent + over).alias("active"),
        F.count_if(start & runs).alias("crashes"),
        F.coalesce(F.max_by(state, F.when(state.isNotNull(), F.struct(at, tie))) == "start", F.lit(False)).alias("running"),
    )
    return by.withColumn("timing_complete", F.col("crashes") == 0)
