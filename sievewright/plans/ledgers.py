"""Ledger, cost, reporting and scheduling queries. Events are attempts, in order of event_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import acceptance, ledger, lifecycle, reporting
from sievewright.operators.ordered import latest, ranked, ranked_by
from sievewright.plans.catalog import cents, load, query

#: Event types as outcomes, fixed values.
OUTCOMES = {"purchase": "accepted", "view": "rejected", "click": "duplicate", "error": "error", "signup": "interrupted"}
_OUTCOME = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OUTCOMES.items()) + " END"


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*(F.lit(x) for pair in OUTCOMES.items() for x in pair))
    rows = load(spark, sf_dir, "events")
    return rows.select("event_id", F.col("user_id").alias("source_id"), names[F.col("event_type")].alias("outcome"), cents("value").alias("spent"), "ts")


_SPENT = "CAST(round(value * 100) AS BIGINT)"


@query(f"SELECT {_OUTCOME} AS outcome, count(*) AS n FROM events GROUP BY 1")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.outcome_counts(_attempts(spark, sf_dir))


@query("""SELECT c_custkey AS source_id, count(o_orderkey) AS attempts, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS accepted
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def per_source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("outcome"))
    return reporting.per_source(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id")), attempts)


@query(f"""SELECT count(*) AS attempts, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS accepted,
  round(CAST(sum({_SPENT}) AS DOUBLE) / nullif(count(CASE WHEN event_type = 'purchase' THEN 1 END), 0), 6) AS mean_seconds FROM events""")
def mean_cost_per_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.mean_cost(_attempts(spark, sf_dir), "spent").withColumn("mean_seconds", F.round("mean_seconds", 6))


@query(f"""WITH w AS (SELECT event_id, event_type, CAST(sum({_SPENT}) OVER (ORDER BY event_id) AS BIGINT) AS watermark FROM events)
SELECT event_id, watermark, watermark - coalesce(lag(watermark) OVER (ORDER BY event_id), 0) AS cost FROM w WHERE event_type = 'purchase'""")
def failure_inclusive_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.costs(_attempts(spark, sf_dir), "event_id", "spent", F.col("outcome") == "accepted").select("event_id", "watermark", "cost")


@query(f"""WITH l AS (SELECT max(event_id) AS last FROM events WHERE event_type = 'purchase')
SELECT CAST(sum({_SPENT}) AS BIGINT) AS total, CAST(sum(CASE WHEN event_id <= last THEN {_SPENT} ELSE 0 END) AS BIGINT) AS allocated,
  greatest(0, CAST(sum({_SPENT}) - sum(CASE WHEN event_id <= last THEN {_SPENT} ELSE 0 END) AS BIGINT)) AS pending FROM events, l""")
def pending_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.pending(_attempts(spark, sf_dir), "event_id", "spent", F.col("outcome") == "accepted")


_RUNS = """r AS (SELECT event_id, event_type, CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (ORDER BY event_id) AS BIGINT) AS run FROM events),
e AS (SELECT event_id, run, CAST(row_number() OVER (PARTITION BY run ORDER BY event_id) AS INTEGER) AS nth FROM r WHERE event_type = 'error')"""


@query(f"WITH {_RUNS} SELECT event_id, run, nth FROM e")
def error_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.failure_runs(_attempts(spark, sf_dir), "event_id", F.col("outcome") == "error").select("event_id", "run", "nth")


@query(f"WITH {_RUNS}, f AS (SELECT min(event_id) AS fatal_at FROM e WHERE nth = 3) SELECT fatal_at, (SELECT count(*) FROM events WHERE event_id <= fatal_at) AS attempts_kept FROM f")
def fatal_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attempts(spark, sf_dir)
    cut = ledger.fatal_at(rows, "event_id", F.col("outcome") == "error")
    return rows.join(F.broadcast(cut), F.col("event_id") <= F.col("fatal_at")).groupBy("fatal_at").agg(F.count("*").alias("attempts_kept"))


@query("""WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer), n AS (SELECT count(*) AS n FROM s)
SELECT o_orderkey, c_custkey AS source_id FROM orders, n JOIN s ON s.pos = (o_orderkey + 5) % n""")
def round_robin_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = ranked(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id")), "source_id", "place").select("source_id", (F.col("place") - 1).alias("pos"))
    return acceptance.round_robin(load(spark, sf_dir, "orders").select("o_orderkey"), sources, "o_orderkey", 5).select("o_orderkey", "source_id")


@query("SELECT o_custkey AS source_id, max(o_orderkey) + 1 AS next_sequence, count(*) AS next_attempt FROM orders GROUP BY o_custkey")
def source_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each customer goes on, over finished orders and those in progress."""
    rows = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderkey").alias("sequence"), "o_orderstatus")
    rows = ranked_by(rows, "source_id", "sequence", "place").withColumn("attempt_index", F.col("place") - 1)
    return lifecycle.cursor(rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'"))


@query("""SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS BIGINT) AS "A", CAST(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS BIGINT) AS "N",
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS BIGINT) AS "R" FROM lineitem GROUP BY l_orderkey""")
def stage_seconds_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("stage"), F.col("l_quantity").cast("long").alias("seconds"))
    return reporting.stage_seconds(rows, "l_orderkey", ["A", "N", "R"])


@query(f"SELECT user_id AS source_id, event_id, {_OUTCOME} AS outcome, {_SPENT} AS spent FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def latest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(_attempts(spark, sf_dir).select("source_id", "event_id", "outcome", "spent"), "source_id", "event_id")


@query("""WITH m AS (SELECT user_id, event_id, event_type IN ('signup', 'view') AS st, epoch_us(ts) AS us FROM events),
n AS (SELECT *, lead(us) OVER w AS nx, lead(st) OVER w AS ns FROM m WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT user_id, count(*) AS segments, CAST(coalesce(sum(CASE WHEN nx IS NOT NULL AND NOT ns THEN nx - us END), 0) AS BIGINT) AS active, bool_and(nx IS NOT NULL AND NOT ns) AS timing_complete
FROM n WHERE st GROUP BY user_id""")
def active_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    marks = load(spark, sf_dir, "events").select("user_id", F.struct(at.alias("at"), F.col("event_id")).alias("order"), at.alias("at"), F.col("event_type").isin("signup", "view").alias("starts"))
    return ledger.active_segments(marks, "user_id", "order", F.col("starts"), "at")


@query(f"""WITH m AS (SELECT user_id, event_id, epoch_us(ts) AS us, CASE event_type WHEN 'signup' THEN 'start' WHEN 'purchase' THEN 'end' ELSE 'checkpoint' END AS kind, {_SPENT} * 10000 AS overhead FROM events WHERE event_type <> 'error'),
n AS (SELECT *, lag(us) OVER w AS pus, last_value(CASE WHEN kind <> 'checkpoint' THEN kind END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS st FROM m WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
r AS (SELECT *, coalesce(st = 'start', false) AS runs FROM n)
SELECT user_id, count(*) FILTER (WHERE kind = 'start') AS segments, CAST(coalesce(sum(overhead) FILTER (WHERE kind = 'start'), 0) AS BIGINT) AS overhead,
  CAST(coalesce(sum(overhead) FILTER (WHERE kind = 'start'), 0) + coalesce(sum(us - pus) FILTER (WHERE runs AND kind <> 'start'), 0) AS BIGINT) AS active,
  count(*) FILTER (WHERE kind = 'start' AND runs) AS crashes, coalesce(arg_max(kind, (us, event_id)) FILTER (WHERE kind <> 'checkpoint') = 'start', false) AS running,
  count(*) FILTER (WHERE kind = 'start' AND runs) = 0 AS timing_complete FROM r GROUP BY user_id""")
def restart_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active time of each user, from starts, checkpoints and ends, with overhead of starts and marks of crashes."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    kind = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "purchase", "end").otherwise("checkpoint")
    marks = load(spark, sf_dir, "events").where("event_type <> 'error'").select("user_id", "event_id", at.alias("at"), kind.alias("kind"), (cents("value") * 10000).alias("overhead"))
    return ledger.active_clock(marks, "user_id", "at", "event_id", F.floor(F.col("at") / 3_600_000_000))


@query("""SELECT count(DISTINCT k) AS attempts FROM (SELECT o_orderkey AS k FROM orders UNION ALL SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def distinct_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and pending entries together, each attempt once."""
    both = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).unionByName(load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")))
    return both.agg(F.count_distinct("k").alias("attempts"))


@query("""WITH p AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events WHERE event_type = 'purchase'),
r AS (SELECT event_id, user_id, CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS nth FROM p WHERE rn = 1) SELECT event_id, user_id, nth FROM r WHERE nth <= 100""")
def stream_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quota replayed as a stream: accepted, unique by user, the first hundred in order of sequence."""
    from sievewright.streaming.quota import replay

    return replay(spark, sf_dir, "events.parquet", quota=100)


@query(f"""WITH c AS (SELECT user_id AS s, event_id AS q, {_OUTCOME} AS outcome FROM events),
g AS (SELECT *, count(*) FILTER (WHERE outcome <> 'error') OVER (PARTITION BY s ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run FROM c),
n AS (SELECT *, count(*) FILTER (WHERE outcome = 'error') OVER (PARTITION BY s, run ORDER BY q ROWS UNBOUNDED PRECEDING) AS fails FROM g),
e AS (SELECT *, outcome <> 'error' OR fails % 2 = 0 AS ends, CASE WHEN outcome = 'error' THEN 2 ELSE fails % 2 END AS failures FROM n)
SELECT s AS source_id, CAST(row_number() OVER (PARTITION BY s ORDER BY q) - 1 AS BIGINT) AS attempt_index, q AS sequence, outcome, CAST(failures AS BIGINT) AS failures FROM e WHERE ends""")
def stream_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions streamed in batches that are in no order; each user's attempts come out in order, with their retries."""
    from sievewright.streaming.attempts import replay_attempts

    rows = _attempts(spark, sf_dir).select("source_id", F.col("event_id").alias("sequence"), "outcome")
    rows = ranked_by(rows, "source_id", "sequence", "place").select("source_id", (F.col("place") - 1).alias("step"), "sequence", "outcome")
    return replay_attempts(rows, parts=3)
