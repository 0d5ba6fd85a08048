"""Integrity, lifecycle and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import geometry as geo
from sievewright.functions import nested, schemas
from sievewright.operators import integrity, lifecycle
from sievewright.operators import spans as sp
from sievewright.operators.joins import dealt
from sievewright.plans.catalog import load, query
from sievewright.plans.geometry import _SPANS, _UNION, HEIGHT, WIDTH, _spans


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber + 1 IN (3, 4, 6, 8) AND l_discount * 10 >= 0.5 AND l_quantity >= 32""")
def detector_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") + 1).alias("class_id"), (F.col("l_discount") * 10).alias("score"), F.col("l_quantity").alias("area"))
    return integrity.detected(rows).select("l_orderkey", "l_linenumber")


@query("""WITH s AS (SELECT l_orderkey AS source_id, l_linenumber AS segment_id, l_linenumber + 1 AS class_id, l_quantity FROM lineitem)
SELECT source_id, segment_id, 'repeated' AS error FROM s GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT source_id, segment_id, 'class' FROM s WHERE class_id NOT IN (3, 4, 6, 8)
UNION ALL SELECT source_id, segment_id, 'empty' FROM (SELECT source_id, segment_id FROM s GROUP BY 1, 2 HAVING max(l_quantity) <= 5)""")
def segment_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("segment_id"), (F.col("l_linenumber") + 1).alias("class_id"), "l_quantity")
    return integrity.segment_errors(rows, rows.where("l_quantity > 5"))


@query("""WITH m AS (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) FILTER (WHERE l_returnflag = 'R') AS n FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT k AS source_id, 'missing' AS error FROM m WHERE k % 11 = 0
UNION ALL SELECT k, 'digest' FROM m WHERE k % 11 <> 0 AND k % 5 = 0 UNION ALL SELECT k, 'members' FROM m WHERE k % 11 <> 0 AND k % 7 = 0 AND n > 1""")
def selection_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of returned lines against selection records: some records are lost or changed since, some members out of order."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    decision = F.struct(F.col("l_linenumber").alias("place"), F.concat(F.lit("seg_"), F.col("l_linenumber").cast("string")).alias("segment_id"), (F.col("flag") == "R").alias("selected"))
    rows = lines.groupBy(F.col("l_orderkey").alias("source_id")).agg(F.sort_array(F.collect_list(decision)).alias("d"))
    plain = F.transform("d", lambda d: F.struct(d["segment_id"].alias("segment_id"), d["selected"].alias("selected")))
    changed = F.to_json(F.struct(plain.alias("decisions"), F.when(F.col("source_id") % 5 == 0, 1).alias("revision")))
    ids = F.transform(F.filter("d", lambda d: d["selected"]), lambda d: d["segment_id"])
    ids = F.when(F.col("source_id") % 7 == 0, F.reverse(ids)).otherwise(ids)
    groups = rows.select("source_id", ids.alias("member_ids"), F.sha2(F.to_json(F.struct(plain.alias("decisions"))).cast("binary"), 256).alias("selection_sha256"))
    return integrity.selection_errors(groups, rows.where("source_id % 11 <> 0").select("source_id", changed.alias("record")))


@query(f"""WITH {_SPANS}, {_UNION}, a AS (SELECT l_orderkey, CAST(sum(x1 - x0) AS BIGINT) AS area FROM u GROUP BY l_orderkey)
SELECT l_orderkey AS source_id, 'area' AS error FROM a WHERE l_orderkey % 10 = 0 UNION ALL SELECT DISTINCT l_orderkey, 'mask' FROM u WHERE l_orderkey % 7 = 0 AND y = 0""")
def group_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored areas are wrong for every tenth order; stored masks lack row 0 for every seventh."""
    masks = _spans(spark, sf_dir).select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("segment_id"), "y", "x0", "x1")
    union = sp.union(masks, "source_id")
    areas = union.groupBy("source_id").agg(F.sum(F.col("x1") - F.col("x0")).alias("area")).withColumn("area", F.col("area") + (F.col("source_id") % 10 == 0).cast("int"))
    stored = union.where(~((F.col("source_id") % 7 == 0) & (F.col("y") == 0)))
    return integrity.group_errors(areas, masks.select("source_id", "segment_id").distinct(), masks, stored)


@query("""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_custkey END AS o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_orderkey IS NULL THEN 'added' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def member_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    cached = rows.where(key % 7 != 0).withColumns({"o_custkey": F.when(key % 11 == 0, F.lit(-1).cast("long")).otherwise(F.col("o_custkey")), "o_orderstatus": F.when(key % 13 != 0, F.col("o_orderstatus"))})
    return integrity.member_changes(rows.where(key % 5 != 0), cached, ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@query(f"""WITH {_SPANS}, {_UNION}, m AS (SELECT l_orderkey AS k, CAST(sum(x1 - x0) AS BIGINT) AS area FROM u GROUP BY 1)
SELECT k AS l_orderkey, CASE WHEN k % 12 IN (0, 8) OR k % 35 = 0 THEN 'schema' WHEN k % 12 = 1 THEN 'point' WHEN k % 12 = 2 THEN 'outside' WHEN k % 13 = 0 THEN 'selection' WHEN k % 12 = 9 THEN 'identity'
  WHEN EXISTS (SELECT 1 FROM u WHERE u.l_orderkey = k AND u.y = k % 29) THEN 'mask' WHEN k % 12 = 3 THEN 'centroid' WHEN k % 12 = 4 THEN 'displacement' WHEN k % 12 = 5 THEN 'geometry' WHEN k % 12 = 6 THEN 'area' END AS error FROM m""")
def plan_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of all masks, broken in many ways; the planned mask lacks one row, which some masks don't have."""
    group = sp.union(_spans(spark, sf_dir), "l_orderkey")
    planned = group.where(F.col("y") != F.col("l_orderkey") % 29)
    unequal = sp.differs(group, planned, "l_orderkey").select("l_orderkey").distinct().withColumn("unequal", F.lit(True))
    m = sp.measures(group, "l_orderkey").join(unequal, "l_orderkey", "left")
    key = F.col("l_orderkey")
    k = key % 12
    plans = m.select(
        "l_orderkey",
        F.when(k == 8, -1).otherwise(key).alias("source_id"),
        key.alias("of_source"),
        F.when(key % 35 == 0, 1.0).alias("anchor"),
        (key % 13 != 0).alias("chosen"),
        F.when(k == 9, -1).otherwise(key).alias("segment_id"),
        key.alias("group_id"),
        *(F.lit("x").alias(c) for c in ("mask_path", "group_path", "mask_sha256", "group_sha256")),
        F.col("unequal").isNull().alias("same_mask"),
        F.when(k == 0, "1.1").otherwise("2.0").alias("schema_version"),
        F.lit(integrity.OPERATION).alias("operation"),
        F.lit(integrity.SAMPLER).alias("sampler"),
        F.when(k == 1, F.lit(float("nan"))).when(k == 3, F.col("cx") + 1e-6).otherwise(F.col("cx")).alias("sx"),
        F.col("cy").alias("sy"),
        F.when(k == 2, F.lit(1e6)).otherwise(F.col("cx") + 0.0).alias("tx"),
        F.when(k == 4, F.col("cy") + 0.5).otherwise(F.col("cy") + 1.0).alias("ty"),
        F.lit(0).alias("dx"),
        F.lit(1).alias("dy"),
        F.when(k == 6, F.col("area") + 1).otherwise(F.col("area")).alias("area"),
        (F.col("area") / (WIDTH * HEIGHT)).alias("fraction"),
        F.when(k == 5, 0).otherwise(1).alias("grid"),
        F.lit(WIDTH).alias("width"),
        F.lit(HEIGHT).alias("height"),
        "cx",
        "cy",
        F.col("area").alias("true_area"),
        F.lit(1).alias("true_grid"),
    )
    return plans.select("l_orderkey", integrity.plan_error().alias("error"))


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'empty' WHEN p_size >= 40 THEN 'outside' WHEN p_size % 3 = 0 THEN 'points' WHEN p_size % 2 = 0 THEN 'region' END AS error FROM part""")
def effective_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("p_size")
    rows = load(spark, sf_dir, "part").select(
        "p_partkey", (s % 5).alias("drag_pixels"), F.lit(40).alias("grid_w"), F.lit(60).alias("grid_h"),
        s.alias("sx"), s.alias("sy"), s.alias("tx"), s.alias("ty"), s.alias("e_sx"), s.alias("e_sy"), F.when(s % 3 == 0, F.greatest(s - 1, F.lit(0))).otherwise(s).alias("e_tx"), s.alias("e_ty"),
        F.lit(0.5).alias("region"), F.when(s % 2 == 0, 0.6).otherwise(0.50005).alias("e_region"),
    )
    return rows.select("p_partkey", integrity.geometry_error().alias("error"))


@query("""WITH b AS (SELECT doc_id // 4096 AS block, sha256(string_agg(CAST(n_chars AS VARCHAR), ',' ORDER BY doc_id)) AS d FROM documents GROUP BY 1)
SELECT sha256(string_agg(d, ',' ORDER BY block)) AS digest FROM b""")
def collection_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("string").alias("v"))
    return integrity.collection_digest(rows, ["doc_id"], "v")


@query("""WITH c AS (SELECT event_id AS sequence, CAST(user_id % 40 AS VARCHAR) AS hash, event_type = 'error' AS failed, event_type <> 'view' AS passed FROM events),
s AS (SELECT CAST(c_custkey AS VARCHAR) AS hash FROM customer WHERE c_custkey < 10),
g AS (SELECT hash, min(sequence) AS sequence FROM c WHERE NOT failed AND passed AND hash NOT IN (SELECT hash FROM s) GROUP BY hash),
w AS (SELECT hash, sequence FROM g QUALIFY row_number() OVER (ORDER BY sequence) <= 20)
SELECT c.sequence, c.hash, c.failed, c.passed, CASE WHEN failed THEN 'error' WHEN NOT passed THEN 'rejected' WHEN c.hash IN (SELECT hash FROM s) OR w.sequence < c.sequence THEN 'duplicate'
  WHEN w.sequence = c.sequence THEN 'accepted' ELSE 'interrupted' END AS outcome FROM c LEFT JOIN w ON c.hash = w.hash""")
def completion_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(F.col("event_id").alias("sequence"), (F.col("user_id") % 40).cast("string").alias("hash"), (F.col("event_type") == "error").alias("failed"), (F.col("event_type") != "view").alias("passed"))
    sources = load(spark, sf_dir, "customer").where("c_custkey < 10").select(F.col("c_custkey").cast("string").alias("hash"))
    return lifecycle.completion_outcomes(rows, sources, 20)


@query("SELECT o_orderkey AS request_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def receipt_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests still to be scored: those without a successful receipt."""
    receipts = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("request_id"), (F.col("l_returnflag") == "R").alias("ok"))
    return lifecycle.unscored(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_id")), receipts)


@query("""SELECT user_id AS candidate_id, CAST(event_id % 4 AS BIGINT) AS stage, count(*) FILTER (WHERE event_type = 'error') AS failures, bool_or(event_type = 'error' AND value > 180) AS fatal
FROM events GROUP BY 1, 2 HAVING bool_or(event_type = 'error' AND value > 180) OR count(*) FILTER (WHERE event_type = 'error') > 1""")
def stage_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("event_type") == "error"
    rows = load(spark, sf_dir, "events").select(F.col("user_id").alias("candidate_id"), (F.col("event_id") % 4).alias("stage"), (~bad).alias("ok"), (bad & (F.col("value") > 180)).alias("fatal"))
    return lifecycle.exhausted(rows)


@query("""SELECT o_orderkey AS candidate_id, 'interrupted' AS outcome FROM orders WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT event_id FROM events)""")
def interrupted_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = load(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("candidate_id"))
    return lifecycle.interrupted(pending, load(spark, sf_dir, "events").select(F.col("event_id").alias("candidate_id")))


@query("""SELECT s_nationkey // 2 AS lane, count(*) AS workers FROM supplier GROUP BY 1""")
def worker_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("pos"), F.col("s_suppkey").alias("worker"))
    return lifecycle.lanes(rows).select("lane", F.size("workers").cast("long").alias("workers"))


@query("""WITH f AS (SELECT p_partkey, p_size AS lo, p_size + CAST(p_partkey % 50 AS INT) + 1 AS hi FROM part)
SELECT p_partkey, greatest(0, lo - CAST(ceil((hi - lo) * 0.25) AS BIGINT)) AS lo, least(120, hi + CAST(ceil((hi - lo) * 0.25) AS BIGINT)) AS hi FROM f""")
def context_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("lo"), (F.col("p_size") + F.col("p_partkey") % 50 + 1).alias("hi"))
    lo, hi = geo.padded(F.col("lo"), F.col("hi"), F.lit(WIDTH), 0.25)
    return rows.select("p_partkey", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))


@query("""SELECT c_custkey, 'Street scene.' || CASE WHEN c_custkey % 3 = 0 THEN ' Source description: ' || c_name ELSE '' END AS source_prompt FROM customer""")
def source_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hint = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))
    text = F.concat(F.lit("Street scene."), F.coalesce(F.concat(F.lit(" Source description: "), hint), F.lit("")))
    return load(spark, sf_dir, "customer").select("c_custkey", text.alias("source_prompt"))


@query("""SELECT o_orderkey, p AS path FROM (SELECT o_orderkey, unnest(['.staging/' || o_orderkey, 'candidates/' || o_orderkey, 'records/' || o_orderkey || '.json']) AS p FROM orders WHERE o_orderstatus = 'O')""")
def artifact_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    paths = F.array(F.concat(F.lit(".staging/"), key), F.concat(F.lit("candidates/"), key), F.concat(F.lit("records/"), key, F.lit(".json")))
    return load(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", F.explode(paths).alias("path"))


@query("""SELECT vec_id, vec_id // 2 + 1 AS id, CASE WHEN vec_id % 2 = 0 THEN 'undesired' ELSE 'preferred' END AS side FROM embeddings WHERE vec_id < 10""")
def caption_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").where("vec_id < 10").select("vec_id")
    return integrity.interleaved(rows, "vec_id").select("vec_id", F.col("id").cast("long").alias("id"), "side")


@query("""SELECT event_id, event_type AS value FROM events UNION ALL SELECT event_id, 'runs/' || user_id FROM events""")
def string_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings inside nested JSON records, one row each; keys and numbers are none."""
    record = F.to_json(F.struct(F.struct("event_type", "value").alias("what"), F.array(F.concat(F.lit("runs/"), F.col("user_id").cast("string"))).alias("paths")))
    return load(spark, sf_dir, "events").select("event_id", F.explode(nested.string_leaves(record)).alias("value"))


@query("""SELECT o_orderkey, '{"image":"old/7/' || o_orderkey || '","more":["old/7","runs/70"]}' AS record FROM orders""")
def nested_relocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records whose paths move with their folder."""
    rows = load(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.concat(F.lit("runs/7/"), F.col("o_orderkey").cast("string")).alias("image"), F.array(F.lit("runs/7"), F.lit("runs/70")).alias("more"))).alias("record"))
    return rows.select("o_orderkey", nested.relocated(F.col("record"), "runs/7", "old/7").alias("record"))


#: What props must be: a number from 10 to 90 and nothing else.
_PROPS = {"type": "object", "required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 90}}}


@query("""WITH e AS (SELECT event_id, props, event_type, CAST(props->>'k' AS INT) AS k FROM events)
SELECT event_id, CASE WHEN NOT json_valid(props) THEN 'syntax' WHEN k IS NULL THEN '$: required k' WHEN len(json_keys(props)) > 1 THEN '$: additionalProperties' WHEN k < 10 THEN '$.k: minimum' WHEN k > 90 THEN '$.k: maximum' END AS props_error,
  CASE WHEN k % 11 = 0 THEN '$: required reason' WHEN k % 13 = 0 THEN '$: additionalProperties' WHEN event_type NOT IN ('purchase', 'error', 'view') THEN '$.answer: enum' WHEN k % 7 = 0 THEN '$.reason: pattern'
    WHEN length(event_type) * k > 500 THEN '$.reason: maxLength' END AS answer_error FROM e""")
def completion_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each event's props, and with an answer made from its type and number, by their schemas."""
    k = F.get_json_object("props", "$.k").cast("int")
    answer = F.coalesce(F.create_map(F.lit("purchase"), F.lit("YES"), F.lit("error"), F.lit("NO"), F.lit("view"), F.lit("UNCERTAIN"))[F.col("event_type")], F.col("event_type"))
    reason = F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, " \t ").otherwise(F.repeat(F.col("event_type"), k * 2))
    text = F.to_json(F.struct(answer.alias("answer"), reason.alias("reason"), F.when(k % 13 == 0, k).alias("more")))
    errors = {"props_error": schemas.completion_error(F.col("props"), _PROPS), "answer_error": schemas.completion_error(text, schemas.ANSWER)}
    return dealt(load(spark, sf_dir, "events").select("event_id", "event_type", "props"), "event_id").select("event_id", *(e.alias(n) for n, e in errors.items()))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'repeated key' WHEN 1 THEN 'number' WHEN 2 THEN 'syntax' END AS error FROM events""")
def completion_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why completions aren't strict JSON."""
    k = F.col("event_id") % 4
    text = F.when(k == 0, '{"a": 1, "a": 2}').when(k == 1, '{"a": NaN}').when(k == 2, "{a}").otherwise(F.col("props"))
    return load(spark, sf_dir, "events").select("event_id", nested.json_error(text).alias("error"))


@query(f"""WITH RECURSIVE {_SPANS}, {_UNION}, n AS (SELECT l_orderkey, y, x0, x1, y * 1000 + x0 AS id FROM u),
e AS (SELECT a.l_orderkey, a.id AS a, b.id AS b FROM n a JOIN n b ON a.l_orderkey = b.l_orderkey AND abs(a.y - b.y) = 1 AND a.x0 < b.x1 AND b.x0 < a.x1),
c AS (SELECT l_orderkey, id, id AS seen FROM n UNION SELECT c.l_orderkey, c.id, e.b FROM c JOIN e ON c.l_orderkey = e.l_orderkey AND c.seen = e.a),
m AS (SELECT l_orderkey, id, min(seen) AS root FROM c GROUP BY 1, 2) SELECT l_orderkey, count(DISTINCT root) AS n_parts FROM m GROUP BY 1""")
def mask_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a mask that hang together side by side."""
    runs = sp.union(_spans(spark, sf_dir), "l_orderkey").withColumn("run", F.col("y") * 1000 + F.col("x0"))
    labels = sp.together(runs, "l_orderkey", "run", diagonal=False)
    return labels.groupBy("l_orderkey").agg(F.count_distinct("group").alias("n_parts"))


@query("""SELECT o_orderkey, o_orderkey // 100 AS batch, CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) AS INTEGER) AS place FROM orders""")
def completion_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lifecycle.batches(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sequence")), 100)
    return rows.select(F.col("sequence").alias("o_orderkey"), "batch", "place")
