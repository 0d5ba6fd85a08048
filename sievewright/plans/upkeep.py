"""Export, gallery, path and cleanup queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import maintenance, recovery, reporting
from sievewright.plans.catalog import load, query

_EXPORT = """x AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '1.1' ELSE '2.0' END AS schema_version, CASE WHEN doc_id % 5 = 0 THEN 'rejected' ELSE 'eligible' END AS export_status,
  CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS presentation_complete, source, n_chars FROM documents),
y AS (SELECT * FROM x WHERE export_status = 'eligible' AND (schema_version <> '2.0' OR coalesce(presentation_complete, false)))"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(key % 3 == 0, "1.1").otherwise("2.0").alias("schema_version"),
        F.when(key % 5 == 0, "rejected").otherwise("eligible").alias("export_status"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(key % 7 != 1).alias("presentation_complete"),
        "source",
        "n_chars",
    )


@query(f"WITH {_EXPORT} SELECT doc_id, source, n_chars, CAST(NULL AS VARCHAR) AS label FROM y WHERE schema_version <> '1.1'")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, _ = reporting.split_export(_records(spark, sf_dir).where(reporting.is_exportable()))
    return current.select("doc_id", "source", "n_chars", F.lit(None).cast("string").alias("label"))


@query(f"WITH {_EXPORT} SELECT doc_id, source, n_chars FROM y WHERE schema_version = '1.1'")
def legacy_split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, legacy = reporting.split_export(_records(spark, sf_dir).where(reporting.is_exportable()))
    return legacy.select("doc_id", "source", "n_chars")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'duplicate' WHEN o_orderstatus IN ('F', 'P') THEN 'rejected' ELSE 'error' END AS outcome FROM orders""")
def legacy_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "rejected").when(F.col("o_orderstatus") == "P", "uncertain").otherwise("failed")
    export = F.when(F.col("o_orderpriority") == "1-URGENT", "duplicate").otherwise("none")
    rows = load(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), export.alias("export_status"))
    return rows.select("o_orderkey", maintenance.legacy_outcome().alias("outcome"))


@query("""WITH r AS (SELECT s_suppkey, s_nationkey, CAST(row_number() OVER (ORDER BY s_nationkey, s_suppkey) AS INTEGER) AS index, count(*) OVER () AS n FROM supplier),
c AS (SELECT *, CAST(ceil(sqrt(CASE WHEN n <= 16 THEN n ELSE n * 0.65 END)) AS BIGINT) AS columns FROM r)
SELECT s_suppkey, index, columns, (index - 1) // columns AS row, (index - 1) % columns AS col FROM c""")
def gallery_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reporting.gallery(load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_nationkey", "s_suppkey")
    return rows.select("s_suppkey", "index", "columns", "row", "col")


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path for each order, by customer and order; accepted orders refer to files below their path."""
    c, o = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    return load(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("runs/"), c).alias("folder"), F.concat(F.lit("runs/"), c, F.lit("/"), o).alias("path"), F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("rejected").alias("outcome"))


def _references(rows: DataFrame) -> DataFrame:
    return rows.where("outcome = 'accepted'").select(F.concat("path", F.lit("/image.png")).alias("reference"))


_PATHS = """o AS (SELECT o_orderkey, 'runs/' || o_custkey AS folder, 'runs/' || o_custkey || '/' || o_orderkey AS path, o_orderstatus = 'F' AS ok FROM orders),
f AS (SELECT path || '/image.png' AS reference FROM o WHERE ok)"""


@query(f"""WITH {_PATHS} SELECT DISTINCT folder AS path FROM o WHERE folder IN (SELECT regexp_replace(reference, '/[^/]+/image.png$', '') FROM f)""")
def protected_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _paths(spark, sf_dir)
    return maintenance.protected(rows.select(F.col("folder").alias("path")).distinct(), _references(rows))


@query(f"""WITH {_PATHS}, c AS (SELECT DISTINCT folder AS path FROM o WHERE NOT ok UNION SELECT path FROM o WHERE NOT ok)
SELECT path FROM c WHERE path NOT IN (SELECT regexp_replace(reference, '/[^/]+/image.png$', '') FROM f) AND path NOT IN (SELECT regexp_replace(reference, '/image.png$', '') FROM f)""")
def cleanup_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _paths(spark, sf_dir)
    wanted = rows.select("path", "outcome").unionByName(rows.select(F.col("folder").alias("path"), "outcome")).where("outcome <> 'accepted'").distinct()
    return maintenance.cleanup_plan(wanted, _references(rows)).select("path")


@query("SELECT event_id FROM events WHERE event_type = 'signup' AND event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def pending_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending entries without a committed record."""
    journal = load(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "signup", "pending").otherwise("cleaned").alias("state"))
    committed = load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"))
    return maintenance.pending_journal(journal).join(committed, "event_id", "left_anti").select("event_id")


@query(f"""WITH {_PATHS} SELECT o_orderkey, CASE WHEN folder = 'runs/7' THEN 'archive/seven' || substr(path, length('runs/7') + 1) ELSE path END AS path FROM o""")
def relocate_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).select("o_orderkey", maintenance.relocate(F.col("path"), "runs/7", "archive/seven").alias("path"))


@query("""WITH m AS (SELECT 'src' || i AS old, 'moved/' || i AS new FROM (SELECT unnest(range(0, 5)) AS i))
SELECT doc_id, coalesce(new, source) AS source, replace('see [it](' || source || ')', '](src3)', '](moved/3)') AS link FROM documents LEFT JOIN m ON source = old""")
def path_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", "source", maintenance.rewrite_links(F.concat(F.lit("see [it]("), "source", F.lit(")")), "src3", "moved/3").alias("link"))
    mapping = spark.range(5).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("old"), F.concat(F.lit("moved/"), F.col("id").cast("string")).alias("new"))
    return maintenance.rewrite(rows, "source", mapping).select("doc_id", "source", "link")


_RUNS_OF_ORDERS = """o AS (SELECT c_nationkey AS run, o_orderkey AS k, o_custkey AS source_id, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN CASE o_orderkey % 4 WHEN 0 THEN 'rejected' WHEN 1 THEN 'generation_error' WHEN 2 THEN 'accepted' ELSE 'uncertain' END ELSE 'half' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN 'eligible' WHEN o_orderkey % 3 = 0 THEN 'duplicate' END AS export_status FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 6 <> 0),
l AS (SELECT l_orderkey AS k, CASE min(l_returnflag) WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'rejected' ELSE 'error' END AS outcome, CASE WHEN max(l_linenumber) % 2 = 0 THEN 'cleaned' ELSE 'pending' END AS cleanup_state FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY 1),
x AS (SELECT o.*, l.outcome AS was, l.cleanup_state, coalesce(export_status = 'eligible', false) AS committed, l.k IS NULL AS new FROM o LEFT JOIN l USING (k)),
y AS (SELECT *, CASE WHEN committed THEN 'accepted' WHEN new THEN CASE WHEN export_status = 'duplicate' THEN 'duplicate' WHEN status IN ('rejected', 'uncertain') THEN 'rejected' ELSE 'error' END ELSE was END AS outcome,
  NOT committed AND (status = 'half' OR status = 'accepted' AND coalesce(export_status, '') <> 'duplicate') AS blocked FROM x),
z AS (SELECT *, CASE WHEN blocked THEN ['blocked'] ELSE list_filter([CASE WHEN k % 7 = 0 THEN 'finish' END, CASE WHEN committed AND coalesce(was, '') <> 'accepted' THEN 'replay' END, CASE WHEN NOT committed AND new THEN 'convert' END,
  CASE WHEN outcome IN ('rejected', 'duplicate', 'error') AND coalesce(cleanup_state, '') <> 'cleaned' THEN 'cleanup' END], lambda a: a IS NOT NULL) END AS actions FROM y)"""


def _runs_of_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Runs, records, ledger and journals: nations are runs, orders are candidates, lines say what the ledger knows of them."""
    runs = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("run"), F.when(F.col("n_nationkey") % 6 == 0, "active").otherwise("ready").alias("status"))
    k = F.col("o_orderkey")
    candidates = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    told = F.element_at(F.array(*(F.lit(s) for s in ("rejected", "generation_error", "accepted", "uncertain"))), (k % 4 + 1).cast("int"))
    status = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", told).otherwise("half")
    export = F.when(F.col("o_orderstatus") == "F", "eligible").when(k % 3 == 0, "duplicate")
    place = [F.col("o_custkey").alias("source_id"), k.alias("attempt_index"), k.alias("sequence")]
    records = candidates.select(F.col("c_nationkey").alias("run"), k.alias("candidate_id"), status.alias("status"), export.alias("export_status"), *place)
    lines = load(spark, sf_dir, "lineitem").where("l_orderkey % 5 <> 0").groupBy(F.col("l_orderkey").alias("candidate_id")).agg(F.min("l_returnflag").alias("flag"), F.max("l_linenumber").alias("last"))
    outcome = F.when(F.col("flag") == "A", "accepted").when(F.col("flag") == "N", "rejected").otherwise("error")
    entries = lines.select("candidate_id", outcome.alias("outcome"), F.when(F.col("last") % 2 == 0, "cleaned").otherwise("pending").alias("cleanup_state"))
    ledger = entries.join(records.select("run", "candidate_id", "source_id", "attempt_index", "sequence"), "candidate_id")
    journals = records.where("candidate_id % 7 = 0").select("run", "candidate_id", F.lit("pending").alias("state"))
    return runs, records, ledger, journals


@query(f"WITH {_RUNS_OF_ORDERS} SELECT run, k AS candidate_id, array_to_string(actions, ',') AS actions, outcome FROM z WHERE len(actions) > 0")
def recovery_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is to be done for each candidate of all runs that nobody writes."""
    plan = recovery.recovery_plan(*_runs_of_orders(spark, sf_dir))
    return plan.select("run", "candidate_id", F.concat_ws(",", "actions").alias("actions"), "outcome")


@query(f"""WITH {_RUNS_OF_ORDERS}, n AS (SELECT run, k, source_id, was AS outcome FROM (SELECT c_nationkey AS run, l.k, o_custkey AS source_id, l.outcome AS was FROM l JOIN orders ON l.k = o_orderkey JOIN customer ON o_custkey = c_custkey)
  WHERE k NOT IN (SELECT k FROM z WHERE list_has_any(actions, ['replay', 'convert'])) UNION ALL SELECT run, k, source_id, outcome FROM z WHERE list_has_any(actions, ['replay', 'convert']))
SELECT run, source_id, max(k) + 1 AS next_sequence, count(*) FILTER (WHERE outcome = 'accepted') AS accepted FROM n GROUP BY run, source_id""")
def recovered_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each source of each run goes on after recovery, and what it has accepted."""
    runs, records, ledger, journals = _runs_of_orders(spark, sf_dir)
    after = recovery.recovered_ledger(ledger, recovery.recovery_plan(runs, records, ledger, journals))
    accepted = after.groupBy("run", "source_id").agg(F.count_if(F.col("outcome") == "accepted").alias("accepted"))
    return recovery.cursors(after).join(accepted, ["run", "source_id"]).select("run", "source_id", "next_sequence", "accepted")
