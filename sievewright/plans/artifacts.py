"""Export, selection, snapshot and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import geometry, texts, vectors
from sievewright.operators import acceptance, exports, ingest, integrity, reporting, scoring, selection
from sievewright.operators.joins import tasks
from sievewright.plans.catalog import load, query
from sievewright.plans.curation import _PAIRS, CAPTIONS, SOURCES, _pairs
from sievewright.plans.geometry import _SPANS, _spans

_NEW = "CASE WHEN doc_id % 19 = 0 THEN sha256('x') ELSE sha256(text) END"


@query(f"""WITH {_PAIRS}, n AS (SELECT count(*) AS n FROM embeddings),
s AS (SELECT doc_id AS source_id, CASE doc_id % 4 WHEN 0 THEN 'source' WHEN 1 THEN 'train' WHEN 2 THEN 'val' ELSE 'test' END AS split, sha256(text) AS px FROM documents WHERE doc_id < 100),
r AS (SELECT doc_id, doc_id % 100 AS source_id, CASE WHEN doc_id % 17 = 0 THEN 'made_up' ELSE 'local' END AS backend, sha256(text) AS px, {_NEW} AS now,
  CASE WHEN doc_id % 23 = 0 THEN 'other' ELSE 'criteria' END AS criteria, 10 + n_chars % (n - 10) AS vec_id FROM documents, n WHERE doc_id >= 100),
f AS (SELECT px, min(doc_id) AS first FROM r GROUP BY px)
SELECT r.doc_id AS candidate_id, CASE WHEN backend <> 'local' THEN 'backend' WHEN split NOT IN ('source', 'train') THEN 'split' WHEN NOT (physical_pass_count >= 3 AND accident_passed) THEN 'decision'
  WHEN criteria <> 'criteria' THEN 'criteria' WHEN now <> r.px THEN 'hash' WHEN r.px IN (SELECT px FROM s) THEN 'source' WHEN f.first < r.doc_id THEN 'repeated' END AS error
FROM r JOIN s USING (source_id) JOIN v USING (vec_id) JOIN f ON f.px = r.px""")
def export_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why documents as artifacts may not be exported: decided, hashed and compared again."""
    n = load(spark, sf_dir, "embeddings").count()
    docs = load(spark, sf_dir, "documents").withColumn("px", F.sha2(F.col("text").cast("binary"), 256))
    key = F.col("doc_id")
    split = F.element_at(F.array(*(F.lit(s) for s in ("source", "train", "val", "test"))), (key % 4 + 1).cast("int"))
    sources = docs.where(key < SOURCES).select(key.alias("source_id"), split.alias("split"), F.col("px").alias("pixel_sha256"))
    rows = docs.where(key >= SOURCES)
    path = F.concat(F.lit("images/"), key.cast("string"))
    backend = F.when(key % 17 == 0, "made_up").otherwise("local")
    criteria = F.when(key % 23 == 0, "other").otherwise("criteria")
    records = rows.select(key.alias("candidate_id"), key.alias("sequence"), (key % 100).alias("source_id"), backend.alias("backend"), path.alias("image_path"), F.col("px").alias("pixel_sha256"), F.col("px").alias("file_sha256"), criteria.alias("criteria_sha256"))
    now = F.when(key % 19 == 0, F.sha2(F.lit("x").cast("binary"), 256)).otherwise(F.col("px"))
    files = rows.select(path.alias("image_path"), now.alias("pixel_sha256"), F.col("px").alias("file_sha256"))
    scored = rows.select(key.alias("candidate_id"), (CAPTIONS + F.col("n_chars") % (n - CAPTIONS)).alias("vec_id"))
    pairs = scored.join(_pairs(spark, sf_dir), "vec_id").select("candidate_id", "id", "passed")
    return exports.export_errors(records, sources, files, pairs, "local", "criteria").select("candidate_id", "error")


_SCORES = "[((g * 7 + view * 3 + i * 5 + l_orderkey) % 21 - 10) / 10.0::DOUBLE FOR i IN range(4)]"


@query(f"""WITH RECURSIVE {_SPANS}, e AS (SELECT a.l_orderkey, a.l_linenumber AS a, b.l_linenumber AS b FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND abs(a.y - b.y) <= 1 AND a.x0 <= b.x1 AND b.x0 <= a.x1),
c AS (SELECT l_orderkey, l_linenumber AS a, l_linenumber AS b FROM s UNION SELECT c.l_orderkey, c.a, e.b FROM c JOIN e ON c.l_orderkey = e.l_orderkey AND c.b = e.a),
p AS (SELECT l_orderkey, a, min(b) AS g FROM c GROUP BY 1, 2), m AS (SELECT l_orderkey, g, count(*) AS members FROM p GROUP BY 1, 2),
w AS (SELECT l_orderkey, g, members, unnest([0, 1]) AS view FROM m), x AS (SELECT *, {_SCORES} AS sc FROM w),
j AS (SELECT l_orderkey, g, members, bool_and(CASE WHEN members = 1 THEN sc[2] - sc[1] ELSE sc[4] - sc[3] END > 0) AS selected FROM x GROUP BY 1, 2, 3)
SELECT p.l_orderkey, p.a AS l_linenumber, p.g AS "group", CASE WHEN members = 1 THEN 'single' ELSE 'contact_group' END AS caption_pair, selected FROM p JOIN j ON p.l_orderkey = j.l_orderkey AND p.g = j.g""")
def vehicle_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of an order's frame, grouped where they touch, and selected by two views of each group."""
    masks = _spans(spark, sf_dir)
    grouped = selection.groups(masks, "l_orderkey", "l_linenumber")
    views = grouped.where(F.col("l_linenumber") == F.col("group")).select("l_orderkey", "group").withColumn("view", F.explode(F.array(F.lit(0), F.lit(1))))
    scores = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: ((F.col("group") * 7 + F.col("view") * 3 + i * 5 + F.col("l_orderkey")) % 21 - 10) / F.lit(10.0))
    return selection.decisions(masks, views.withColumn("scores", scores), "l_orderkey", "l_linenumber", tasks(load(spark, sf_dir, "lineitem"))).drop("error")


@query("""SELECT doc_id AS source_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 7 = 0 THEN 'pixels' ELSE 'file' END AS error FROM documents WHERE doc_id % 11 = 0 OR doc_id % 7 = 0 OR n_chars % 5 = 0""")
def snapshot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a snapshot: some are gone, some changed since."""
    key = F.col("doc_id")
    px, file = F.sha2(F.col("text").cast("binary"), 256), F.sha2(F.col("n_chars").cast("string").cast("binary"), 256)
    saved = load(spark, sf_dir, "documents").select(key.alias("source_id"), F.coalesce(px, F.lit("none")).alias("pixel_sha256"), file.alias("file_sha256"), "n_chars")
    now = saved.where(F.col("source_id") % 11 != 0).withColumn("pixel_sha256", F.when(F.col("source_id") % 7 == 0, "other").otherwise(F.col("pixel_sha256")))
    now = now.withColumn("file_sha256", F.when(F.col("n_chars") % 5 == 0, "other").otherwise(F.col("file_sha256")))
    return integrity.changed_sources(saved, now)


@query("""SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))), 6)) AS unit FROM embeddings""")
def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings")
    return rows.select("vec_id", F.transform(vectors.unit(F.col("embedding")), lambda x: vectors.rounded(x, 6)).alias("unit"))


@query("""SELECT p_partkey, printf('#%03d', p_size) || '  ' || p_name AS label, CASE WHEN length(p_name) > 12 THEN substr(p_name, 1, 11) || '…' ELSE p_name END AS short,
  (p_size - 25) * 1920.0::DOUBLE / 120 AS x FROM part""")
def tile_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of tiles, shortened names, and grid columns as columns of the original."""
    x = geometry.to_original(F.col("p_size") - 25, F.lit(120), F.lit(1920))
    return load(spark, sf_dir, "part").select("p_partkey", texts.tile_label(F.col("p_size"), F.col("p_name")).alias("label"), texts.shortened(F.col("p_name"), 12).alias("short"), x.alias("x"))


@query("""SELECT event_id, coalesce(value, 0.0) AS attempt, 0.0::DOUBLE AS cost FROM events""")
def record_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing of records, zero where a key is absent."""
    timing = F.create_map(F.lit("attempt_elapsed_seconds"), F.col("value").cast("double"))
    filled = texts.with_defaults(timing, {"attempt_elapsed_seconds": 0.0, "accepted_cost_seconds": 0.0})
    return load(spark, sf_dir, "events").select("event_id", filled["attempt_elapsed_seconds"].alias("attempt"), filled["accepted_cost_seconds"].alias("cost"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'transformation' WHEN o_orderkey % 3 = 1 THEN 'deformation' ELSE 'rotation' END AS task, ' ' || o_orderstatus AS editing_prompt FROM orders""")
def generator_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    operation = F.when(k % 3 == 0, "relocation").when(k % 3 == 1, "deformation").otherwise("rotation")
    at = F.array(k.cast("double"), F.lit(1.0))
    told = integrity.instruction(operation, at, at, F.lit(None).cast("array<double>"), F.lit("before"), F.col("o_orderstatus"))
    return load(spark, sf_dir, "orders").select("o_orderkey", told.alias("i")).select("o_orderkey", "i.region.task", "i.editing_prompt")


@query("""SELECT o_custkey AS source_id, greatest(0, least(4 - count(CASE WHEN o_orderstatus = 'P' THEN 1 END), 6 - count(CASE WHEN o_orderstatus = 'F' THEN 1 END) - count(CASE WHEN o_orderstatus = 'P' THEN 1 END))) AS slots
FROM orders GROUP BY o_custkey""")
def reservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that may start for each customer's quota of six on four lanes; orders in progress are in flight."""
    status = F.col("o_orderstatus")
    counts = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("source_id")).agg(F.count_if(status == "F").alias("done"), F.count_if(status == "P").alias("flying"))
    return counts.select("source_id", acceptance.open_slots(F.lit(4).cast("long"), F.lit(6).cast("long"), F.col("done"), F.col("flying")).alias("slots"))


@query(f"""WITH {_PAIRS}, d AS (SELECT vec_id, CAST(physical_pass_count AS BIGINT) AS n, physical_pass_count >= 3 AND accident_passed AS passed FROM v)
SELECT vec_id FROM d WHERE vec_id % 9 = 0 OR vec_id % 11 = 0""")
def decision_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored decisions that scores don't give again: every ninth verdict and every eleventh count was changed."""
    pairs = _pairs(spark, sf_dir)
    key = F.col("vec_id")
    stored = scoring.decisions(pairs, "vec_id")
    stored = stored.withColumn("passed", F.when(key % 9 == 0, ~F.col("passed")).otherwise(F.col("passed"))).withColumn("physical_pass_count", F.col("physical_pass_count") + (key % 11 == 0).cast("int"))
    return scoring.tampered(stored, pairs, "vec_id").select("vec_id")


@query("""WITH r AS (SELECT CASE WHEN p_partkey % 50 = 1 THEN p_partkey - 1 ELSE p_partkey END AS id, p_size * 3 AS w, p_size * 2 AS h, CASE WHEN p_partkey % 7 = 0 THEN '  ' WHEN p_partkey % 7 = 1 THEN p_name END AS hint,
  CASE WHEN p_partkey % 31 = 0 THEN 'else' ELSE 'train' END AS split FROM part)
SELECT id, 'repeated' AS error FROM r GROUP BY id HAVING count(*) > 1 UNION ALL SELECT id, 'small' FROM r WHERE least(w, h) < 32
UNION ALL SELECT id, 'hint' FROM r WHERE hint IS NOT NULL AND trim(hint) = '' UNION ALL SELECT id, 'split' FROM r WHERE split NOT IN ('source', 'train', 'val', 'test')""")
def ingest_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops an ingest: repeated ids, small images, blank hints, unknown splits."""
    k = F.col("p_partkey")
    hint = F.when(k % 7 == 0, "  ").when(k % 7 == 1, F.col("p_name"))
    rows = load(spark, sf_dir, "part").select(F.when(k % 50 == 1, k - 1).otherwise(k).alias("source_id"), (F.col("p_size") * 3).alias("width"), (F.col("p_size") * 2).alias("height"), hint.alias("preserve_hint"), F.when(k % 31 == 0, "else").otherwise("train").alias("split"))
    found = [(ingest.repeated_ids(rows), "repeated"), (ingest.too_small(rows), "small"), (ingest.blank_hints(rows), "hint"), (ingest.unknown_splits(rows), "split")]
    parts = [v.select(F.col("source_id").alias("id"), F.lit(name).alias("error")) for v, name in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""SELECT user_id AS source_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0) GROUP BY user_id""")
def unknown_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of users that aren't among the run's sources."""
    sources = load(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("source_id"))
    return reporting.unknown_sources(sources, load(spark, sf_dir, "events").select(F.col("user_id").alias("source_id")))
