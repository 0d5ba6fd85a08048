"""Queries over published tables: refreshed by a stream, compacted, migrated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.joins import dealt, tasks
from sievewright.operators.published import Published, migrate
from sievewright.plans.catalog import cents, load, query
from sievewright.streaming.attempts import run_to_end, shared_folder
from sievewright.streaming.refresh import RefreshSink

#: Rows of a bucket, which a task writes.
BUCKET_ROWS = 250_000

_LEDGER = "event_id long, source_id long, outcome string, spent long"


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("source_id"), F.col("event_type").alias("outcome"), cents("value").alias("spent"))


def per_source(entries: DataFrame) -> DataFrame:
    return entries.groupBy("source_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "purchase").alias("accepted"), F.sum("spent").alias("spent"))


@query("""SELECT user_id AS source_id, count(*) AS attempts, count(*) FILTER (WHERE event_type = 'purchase') AS accepted, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spent
FROM events WHERE event_type <> 'signup' GROUP BY user_id""")
def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report by source that a stream of ledger entries keeps up, batch by batch; signups take their entry back."""
    base = shared_folder(spark, "report")
    _ledger(spark, sf_dir).repartition(2, F.xxhash64("event_id")).write.parquet(f"{base}/in")
    ledger = Published(spark, f"{base}/ledger", "event_id", _LEDGER, buckets=4, by="source_id")
    view = Published(spark, f"{base}/view", "source_id", "source_id long, attempts long, accepted long, spent long", buckets=4)
    stream = spark.readStream.schema(_LEDGER).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    run_to_end(stream, f"{base}/state", RefreshSink(ledger, view, per_source, F.col("outcome") == "signup"))
    return view.read()


@query("""SELECT l_orderkey * 8 + l_linenumber AS id, max(l_quantity) AS quantity FROM lineitem GROUP BY ALL HAVING max(l_returnflag) <> 'R'""")
def compacted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written, those that were returned taken back, and the table compacted."""
    source = load(spark, sf_dir, "lineitem")
    table = Published(spark, shared_folder(spark, "ledger"), "id", "id long, quantity double", buckets=max(8, tasks(source, BUCKET_ROWS)))
    lines = source.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_quantity").alias("quantity"), "l_returnflag")
    lines = dealt(lines, "id", each=BUCKET_ROWS)
    lines = lines.groupBy("id").agg(F.max("quantity").alias("quantity"), F.max("l_returnflag").alias("flag"))
    table.upsert(lines, "lines")
    table.upsert(lines.where("flag = 'R'"), "returns", F.lit(True))
    table.compact("compacted")
    return table.read()


@query("""SELECT page_id AS id, CASE WHEN page_id % 3 = 0 THEN 'archive/' || page_id ELSE 'pages/' || page_id END AS path, sha256(coalesce(html, '')) AS content FROM pages""")
def migrated_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third page's artifact moved to an archive, with the records that refer to it; records joined with what they refer to."""
    base = shared_folder(spark, "migration")
    pages = load(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("pages/"), F.col("page_id").cast("string")).alias("path"), F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("content"))
    artifacts = Published(spark, f"{base}/artifacts", "path", "path string, content string", buckets=4)
    records = Published(spark, f"{base}/records", "id", "id long, path string", buckets=4)
    artifacts.refresh(pages, "start")
    records.refresh(pages.select(F.col("page_id").alias("id"), "path"), "start")
    number = F.regexp_extract("path", r"^pages/(\d+)$", 1)
    migrate(artifacts, records, lambda p: F.when(p.startswith("pages/") & (F.try_to_number(number, F.lit("9" * 18)) % 3 == 0), F.concat(F.lit("archive/"), number)).otherwise(p), "archive")
    return records.read().join(artifacts.read(), "path").select("id", "path", "content")
