"""Scoring, acceptance, ingest and contact queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import identity
from sievewright.operators import acceptance, contacts, ingest, scoring
from sievewright.plans.catalog import load, query

#: Roles of the tables: ten caption vectors, a hundred source documents.
CAPTIONS, SOURCES = 10, 100


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").where(F.col("vec_id") < CAPTIONS)
    pick = lambda odd: F.max(F.when(F.col("vec_id") % 2 == odd, F.col("embedding")))
    return rows.groupBy(F.expr("vec_id div 2 + 1").alias("id")).agg(pick(0).alias("undesired_v"), pick(1).alias("preferred_v"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = load(spark, sf_dir, "embeddings").where(F.col("vec_id") >= CAPTIONS).select("vec_id", F.col("embedding").alias("feature"))
    return scoring.caption_pairs(features, _captions(spark, sf_dir), "vec_id")


_PAIRS = """c AS (SELECT vec_id // 2 + 1 AS id, max(CASE WHEN vec_id % 2 = 0 THEN embedding END) AS u, max(CASE WHEN vec_id % 2 = 1 THEN embedding END) AS p
  FROM embeddings WHERE vec_id < 10 GROUP BY 1),
p AS (SELECT vec_id, id, list_cosine_similarity(embedding::DOUBLE[], u::DOUBLE[]) AS undesired, list_cosine_similarity(embedding::DOUBLE[], p::DOUBLE[]) AS preferred
  FROM embeddings, c WHERE vec_id >= 10),
v AS (SELECT vec_id, count(*) FILTER (WHERE id <= 4 AND preferred - undesired > 0) AS physical_pass_count,
  bool_or(id = 5 AND preferred - undesired > 0) AS accident_passed FROM p GROUP BY vec_id)"""


@query(f"WITH {_PAIRS} SELECT vec_id, id, round(undesired, 6) AS undesired, round(preferred, 6) AS preferred, round(preferred - undesired, 6) AS margin, preferred - undesired > 0 AS passed FROM p")
def clip_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _pairs(spark, sf_dir)
    return rows.select("vec_id", "id", *(F.round(c, 6).alias(c) for c in ("undesired", "preferred", "margin")), "passed")


@query(f"WITH {_PAIRS} SELECT vec_id, physical_pass_count, accident_passed, physical_pass_count >= 3 AND accident_passed AS passed FROM v")
def clip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.decisions(_pairs(spark, sf_dir), "vec_id")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as artifacts: equal lengths share a feature, so exact copies get equal scores."""
    n = load(spark, sf_dir, "embeddings").count()
    passed = scoring.decisions(_pairs(spark, sf_dir), "vec_id").select("vec_id", "passed")
    docs = load(spark, sf_dir, "documents").where(F.col("doc_id") >= SOURCES)
    rows = docs.select(F.col("doc_id").alias("sequence"), F.sha2(F.col("text").cast("binary"), 256).alias("hash"), (CAPTIONS + F.col("n_chars") % (n - CAPTIONS)).alias("vec_id"))
    return rows.join(passed, "vec_id").select("sequence", "hash", "passed")


def _source_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(F.col("doc_id") < SOURCES).select(F.sha2(F.col("text").cast("binary"), 256).alias("hash"))


@query(f"""WITH {_PAIRS},
n AS (SELECT count(*) AS n FROM embeddings), q AS (SELECT count(*) // 10 AS q FROM documents),
d AS (SELECT doc_id AS sequence, sha256(text) AS hash, 10 + n_chars % (n - 10) AS vec_id FROM documents, n WHERE doc_id >= 100),
a AS (SELECT sequence, hash FROM d JOIN v USING (vec_id) WHERE physical_pass_count >= 3 AND accident_passed AND hash NOT IN (SELECT sha256(text) FROM documents WHERE doc_id < 100)),
f AS (SELECT hash, min(sequence) AS sequence FROM a GROUP BY hash),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY sequence) AS INTEGER) AS rank FROM f)
SELECT hash, sequence, rank FROM r, q WHERE rank <= q""")
def accepted_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    quota = load(spark, sf_dir, "documents").count() // 10
    return acceptance.accepted(_candidates(spark, sf_dir), _source_hashes(spark, sf_dir), quota)


@query("""SELECT i AS code, bit_count(i & 15) AS physical_pass_count, i & 16 > 0 AS accident_passed, bit_count(i & 15) >= 3 AND i & 16 > 0 AS passed
FROM (SELECT DISTINCT o_orderkey % 32 AS i FROM orders)""")
def policy_truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy's decision for every combination of passed pairs that the orders' numbers show."""
    codes = load(spark, sf_dir, "orders").select((F.col("o_orderkey") % 32).alias("code")).distinct()
    bits = codes.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(5))))
    pairs = bits.withColumn("passed", F.expr("shiftright(code, id - 1) & 1") == 1)
    return scoring.decisions(pairs, "code")


_BENT = """CASE vec_id % 6 WHEN 0 THEN list_concat(e[1:9], ['nan'::DOUBLE]) WHEN 1 THEN e[1:9] WHEN 2 THEN list_concat(e[1:9], [2.0::DOUBLE]) WHEN 3 THEN list_concat(e[1:9], ['-infinity'::DOUBLE])
  WHEN 4 THEN list_concat(e[1:9], [1.000005::DOUBLE]) ELSE e[1:10] END"""


@query(f"""WITH b AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT vec_id, {_BENT} AS s FROM b)
SELECT vec_id, CASE WHEN len(s) <> 10 THEN 'count' WHEN list_bool_or(list_transform(s, lambda x: x IS NULL OR NOT isfinite(x))) THEN 'not_finite'
  WHEN list_bool_or(list_transform(s, lambda x: abs(x) > 1.00001)) THEN 'out_of_bounds' END AS decision_error,
  CASE WHEN len(s) <> 10 THEN 'count' WHEN list_bool_or(list_transform(s, lambda x: x IS NULL OR NOT isfinite(x))) THEN 'not_finite'
  WHEN list_bool_or(list_transform(s, lambda x: abs(x) > 1)) THEN 'out_of_bounds' END AS selector_error FROM s""")
def score_validity_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.transform("embedding", lambda x: x.cast("double"))
    nine = F.slice(e, 1, 9)
    kinds = [float("nan"), None, 2.0, float("-inf"), 1.000005]
    scores = F.slice(e, 1, 10)
    for k, value in enumerate(kinds):
        bent = nine if value is None else F.concat(nine, F.array(F.lit(value)))
        scores = F.when(F.col("vec_id") % 6 == k, bent).otherwise(scores)
    rows = load(spark, sf_dir, "embeddings").select("vec_id", scores.alias("s"))
    return rows.select("vec_id", scoring.score_error(F.col("s"), 10, scoring.SCORE_BOUND).alias("decision_error"), scoring.score_error(F.col("s"), 10, scoring.SELECTOR_BOUND).alias("selector_error"))


@query("""SELECT doc_id, doc_id = first AS kept, CASE WHEN doc_id <> first THEN first END AS duplicate_of
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first FROM documents)""")
def source_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("hash"))
    return ingest.keep_first(rows, "hash", "doc_id", "doc_id").select("doc_id", "kept", "duplicate_of")


@query("SELECT doc_id FROM documents WHERE doc_id >= 100 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id < 100)")
def source_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").where(F.col("doc_id") >= SOURCES).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("hash"))
    return acceptance.not_in_sources(rows, _source_hashes(spark, sf_dir), "hash").select("doc_id")


@query("""SELECT c_nationkey, CAST(floor(c_acctbal / 100) AS BIGINT) AS band, count(DISTINCT c_mktsegment) AS n_splits FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_mktsegment) > 1""")
def split_leakage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").withColumn("band", F.floor(F.col("c_acctbal") / 100))
    return ingest.leaks(rows, "c_nationkey", "band", split="c_mktsegment")


@query("SELECT sha256(text) AS hash, count(DISTINCT source) AS n_splits FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def split_leakage_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.leaks(load(spark, sf_dir, "documents"), F.sha2(F.col("text").cast("binary"), 256).alias("hash"), split="source")


_SPLIT = "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_custkey % 4 = 0 THEN 'source' WHEN c_custkey % 4 = 1 THEN 'train' WHEN c_custkey % 4 = 2 THEN 'val' ELSE 'test' END"


@query(f"""WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS source_id, coalesce({_SPLIT}, 'source') AS split, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_name END AS g FROM customer)
SELECT source_id, split, coalesce(nullif(g, ''), source_id) AS group_id, nullif(g, '') IS NULL AS group_inferred FROM r WHERE split IN ('source', 'train')""")
def eligible_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    split = F.when(F.col("c_mktsegment") != "MACHINERY", F.element_at(F.array(*(F.lit(s) for s in ingest.SPLITS)), (key % 4 + 1).cast("int")))
    group = F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("c_name"))
    rows = load(spark, sf_dir, "customer").select(key.cast("string").alias("source_id"), split.alias("split"), group.alias("group_id"))
    return ingest.eligible(ingest.with_defaults(rows)).select("source_id", "split", "group_id", "group_inferred")


@query(r"""WITH p AS (SELECT page_id, split_part(url, '://', 2) AS path, split_part(url, '/', -1) AS name FROM pages)
SELECT page_id, regexp_full_match(name, '[A-Za-z0-9][A-Za-z0-9_.-]{0,127}') AS safe, NOT starts_with(path, '/') AND NOT list_contains(string_split(path, '/'), '..') AS inside FROM p""")
def safe_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("://"), F.lit(2)).alias("path"), F.split_part("url", F.lit("/"), F.lit(-1)).alias("name"))
    return rows.select("page_id", identity.is_safe_id(F.col("name")).alias("safe"), identity.is_within(F.col("path")).alias("inside"))


@query("""SELECT c_custkey, c_nationkey || '_' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '_' ||
  substr(sha256('[7,"' || c_nationkey || '","' || c_name || '"]'), 1, 10) AS candidate_id,
  CAST('0x' || substr(sha256('[7,"' || c_nationkey || '","' || c_name || '",' || c_custkey || ']'), 1, 8) AS BIGINT) AS seed FROM customer""")
def candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.col("c_nationkey").cast("string")
    return load(spark, sf_dir, "customer").select(
        "c_custkey",
        identity.candidate_id(source, F.col("c_custkey"), 7, F.col("c_name")).alias("candidate_id"),
        identity.attempt_seed(source, F.col("c_custkey"), 7, F.col("c_name")).alias("seed"),
    )


@query("""SELECT event_id, sha256('{"k":' || json_extract_string(props, '$.k') || '}') AS digest FROM events""")
def canonical_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digests of the events' JSON; Python, as key order and nulls matter."""
    return load(spark, sf_dir, "events").select("event_id", identity.canonical_digest("props").alias("digest"))


#: Boxes from the first two components: corners at 100 times them, six wide.
SIDE = 6.0


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = (F.get("embedding", F.lit(i)).cast("double") * 100 for i in (0, 1))
    return load(spark, sf_dir, "embeddings").select("label", "vec_id", x.alias("x0"), y.alias("y0"), (x + SIDE).alias("x1"), (y + SIDE).alias("y1"))


_EDGES = """b AS (SELECT label, vec_id, embedding[1]::DOUBLE * 100 AS x, embedding[2]::DOUBLE * 100 AS y FROM embeddings),
e AS (SELECT a.label, a.vec_id, b.vec_id AS vec_id2 FROM b a JOIN b ON a.label = b.label AND a.vec_id < b.vec_id AND a.x <= b.x + 6 AND b.x <= a.x + 6 AND a.y <= b.y + 6 AND b.y <= a.y + 6)"""


@query(f"WITH {_EDGES} SELECT label, vec_id, vec_id2 FROM e")
def contact_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contacts.touching_boxes(_boxes(spark, sf_dir), "label", "vec_id", SIDE * 2)


@query(f"""WITH RECURSIVE {_EDGES}, s AS (SELECT vec_id AS a, vec_id2 AS b FROM e UNION ALL SELECT vec_id2, vec_id FROM e),
c AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT c.node, s.b FROM c JOIN s ON c.seen = s.a)
SELECT node AS vec_id, min(seen) AS component FROM c GROUP BY node""")
def contact_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contacts.box_components(_boxes(spark, sf_dir), "label", "vec_id", SIDE * 3 / 4)


@query("""WITH s AS (SELECT vec_id, unnest(range(2)) AS view, embedding FROM embeddings),
m AS (SELECT vec_id, view, round(embedding[2 * view + 1]::DOUBLE, 1) AS u, round(embedding[2 * view + 2]::DOUBLE, 1) AS i FROM s)
SELECT vec_id, bool_and(i - u > 0) AS selected, count(*) AS views, round(min(i - u), 6) + 0.0::DOUBLE AS least_margin FROM m GROUP BY vec_id""")
def both_views_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.round(F.get("embedding", i).cast("double"), 1)
    rows = load(spark, sf_dir, "embeddings").withColumn("view", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.select("vec_id", "view", at(F.col("view") * 2).alias("uninvolved"), at(F.col("view") * 2 + 1).alias("involved"))
    return contacts.both_views(rows, "vec_id").withColumn("least_margin", F.round("least_margin", 6) + F.lit(0.0))


@query("""WITH t AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' AND length(text) < 200 THEN 1 ELSE 0 END AS bad FROM conversations)
SELECT conv_id, CAST(sum(bad) AS BIGINT) AS failures, sum(bad) > 2 AS exhausted FROM t GROUP BY conv_id""")
def retry_exhausted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short answers as failed tries: a candidate is given up after two retries."""
    failed = (F.col("role") == "assistant") & (F.length("text") < 200)
    return load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count_if(failed).alias("failures")).withColumn("exhausted", F.col("failures") > 2)


@query("""SELECT quality, toxic, count(*) AS n, quality = 1 AND toxic = 0 AS kept FROM labels GROUP BY quality, toxic""")
def label_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return load(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n")).withColumn("kept", kept)


@query("""WITH s AS (SELECT sha256(text) AS hash, doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents)
SELECT hash, doc_id AS first_id FROM s WHERE rn = 1""")
def seen_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of sources and accepted artifacts together, each with where it was seen first."""
    rows = load(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("hash"), "doc_id")
    both = rows.where(F.col("doc_id") < SOURCES).unionByName(rows.where(F.col("doc_id") >= SOURCES))
    return acceptance.first_by_key(both, "hash", "doc_id").select("hash", F.col("doc_id").alias("first_id"))
