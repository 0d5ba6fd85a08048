"""A shared quota over a stream of completions.

Each key's first artifact is keyed state (:class:`attempts.FirstOfKey`), which tells a batch only what fell. The quota keeps
the ``quota`` first of these in order of sequence: a minimum only falls, so one that has left this list never comes back,
and the list needs no more than its last version and the batch. So the result depends neither on how completions are cut
into batches nor on their order. Versions are named by their batch: a batch that is replayed after a failure writes the same
version again, and only the version before it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.acceptance import first_by_key, first_n
from sievewright.streaming.attempts import firsts, run_to_end, shared_folder

_LEADERS = "key long, sequence long"


class QuotaSink:
    """foreachBatch function; the accepted rows after batch n are in ``path``/batch=n."""

    def __init__(self, path: str, quota: int) -> None:
        self.path, self.quota = path, quota

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("key", "sequence")
        if number:
            rows = rows.unionByName(spark.read.schema(_LEADERS).parquet(f"{self.path}/batch={number - 1}"))
        kept = first_n(first_by_key(rows, "key", "sequence"), self.quota, "sequence")
        # One file, written by a task of its own: coalesce() would have that task rank all keys.
        kept.select("key", "sequence").repartition(1).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def accepted(self, spark: SparkSession) -> DataFrame:
        """(key, sequence) after the last batch."""
        every = spark.read.schema(_LEADERS).parquet(self.path)
        last = every.agg(F.max("batch")).first()[0]
        return every.where(F.col("batch") == F.lit(-1 if last is None else last)).select("key", "sequence")


def accept(stream: DataFrame, base: str, quota: int) -> QuotaSink:
    """Run a stream of (key, sequence) to its end, from where it stopped before, with its state below ``base``."""
    sink = QuotaSink(f"{base}/accepted", quota)
    run_to_end(firsts(stream), f"{base}/state", sink)
    return sink


def replay(spark: SparkSession, folder: str, name: str, quota: int) -> DataFrame:
    """Run a table of events through the stream to its end and return what was accepted."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/{name[:-1]}[{name[-1]}]")  # a pattern, as a stream's plain path must be a folder
    passed = stream.where("event_type = 'purchase'").select(F.col("user_id").alias("key"), F.col("event_id").alias("sequence"))
    rows = accept(passed, shared_folder(spark, "quota"), quota).accepted(spark)
    return first_n(rows, quota, "sequence").select(F.col("sequence").alias("event_id"), F.col("key").alias("user_id"), F.col("rank").cast("long").alias("nth"))


def windowed_outcomes(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Outcome counts by event time, with a watermark; works on streams and tables."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("seconds")).select(F.col("window.start").alias("start"), "event_type", "n", "seconds")
