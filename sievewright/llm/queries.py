"""The registered queries of the training-data operators, and SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import aq_search, chat, embeddup, filter_audit, langid, licenses, mixing, packing, periodic, phrases, secret_scan, simhash, warc
from sievewright.llm.common import table

#: The conversation that op1 adds: control strings inside texts.
PLANTED = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest columns of formatted conversations, from their text and spans alone."""
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = row["formatted"]
            turns = [turn for s in row["turn_spans"] for turn in chat.parse(text[s["start"] : s["end"]])]
            loss = "".join(chat.unescape(text[s["start"] : s["end"]]) for s in row["loss_spans"])
            rows.append((row["conv_id"], len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql("SELECT -1L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role FROM range(2)").withColumn("text", F.lit(PLANTED))
    formatted = chat.format_conversations(rows.unionByName(more))
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"), count("random"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), tokenizer_path())


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.fold(F.col("doc_id")) == 2
    model = langid.fit(docs.where(~out).select("doc_id", "text", "lang"))
    answers = langid.identify(docs.select("doc_id", "text"), model)
    return answers.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = phrases.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aq_search.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op11_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "labels"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda c: F.concat_ws(",", c).alias(c)
    return rows.select("doc_id", "n_words", F.col("places").alias("n_base"), "first_word", "last_word", joined("base_labels"), joined("labels"), "score")


def planted(doc_id: int | None, ids: np.ndarray) -> np.ndarray:
    """op13's repetitions: the words of about one document in ten, from some word on, repeat a stretch of them."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ids)
    if doc_id is None or h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([ids[:a], ids[a + np.arange(n - a) % p]])


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_chat, op2_secrets, op3_mixing, op4_packing, op5_langid, op6_simhash, op7_phrases, op8_embeddings, op9_warc, op10_search, op11_filters, op12_licenses, op13_runs)
    return {f.__name__: f for f in found}


_ESCAPED = r"""regexp_replace({}, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g')"""

OP1 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PLANTED}' UNION ALL SELECT -1, 1, 'assistant', '{PLANTED}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(length('<|im_start|><|im_end|>') + 2 + length({_ESCAPED.format("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

OP3 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap,
  1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS total FROM r),
f AS (SELECT *, sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
  coalesce(sum(cap) OVER (ORDER BY cap / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before FROM w),
g AS (SELECT *, (total - caps_before) * w >= cap * w_left AS capped FROM f),
h AS (SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0) AS caps, sum(CASE WHEN NOT capped THEN w END) OVER () AS free_w FROM g),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE (total - caps) * w / free_w END AS target FROM h),
c AS (SELECT d.*, source_size, target, CASE WHEN size > 0 THEN (length(bin(size)) - 1) // 2 ELSE -1 END AS class
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT source, class, CAST(sum(size) AS BIGINT) AS words, any_value(source_size) AS source_size, any_value(target) AS target FROM c GROUP BY source, class),
l AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole, CASE WHEN class >= 0 THEN pow(2.0::DOUBLE, class) ELSE 0.0::DOUBLE END AS x FROM k),
m AS (SELECT *, target - whole * source_size AS extra, coalesce(CAST(sum(words) OVER (PARTITION BY source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS larger,
  sum(x * words) OVER (PARTITION BY source ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weighed FROM l),
n AS (SELECT *, x > 0 AND (extra - larger) * x >= weighed AS certain FROM m),
o AS (SELECT *, extra - coalesce(CAST(sum(CASE WHEN certain THEN words END) OVER (PARTITION BY source) AS BIGINT), 0) AS rest, sum(CASE WHEN NOT certain THEN x * words END) OVER (PARTITION BY source) AS free FROM n),
p AS (SELECT source, class, rest, whole + CAST(certain AS INT) AS base, CASE WHEN NOT certain AND x > 0 AND rest > 0 THEN rest * x / free END AS p FROM o),
q AS (SELECT c.*, rest, base, (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) AS q FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source AND c.class = p.class),
b AS (SELECT *, row_number() OVER v AS rk, CAST(sum(size) OVER (v ROWS UNBOUNDED PRECEDING) AS BIGINT) AS past FROM q WHERE q IS NOT NULL WINDOW v AS (PARTITION BY source ORDER BY q, doc_id NULLS LAST, size)),
a AS (SELECT source, max(rest) - coalesce(max(past) FILTER (WHERE past <= rest), 0) AS gap, coalesce(max(rk) FILTER (WHERE past <= rest), 0) AS rk FROM b GROUP BY source),
z AS (SELECT b.*, length(bin(size)) AS bits, CAST(sum(size) OVER (PARTITION BY b.source, length(bin(size)) ORDER BY size, q, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM b JOIN a ON b.source IS NOT DISTINCT FROM a.source WHERE b.rk > a.rk AND size <= gap),
e AS (SELECT source, gap, 64 AS bits FROM a
  UNION ALL SELECT e.source, e.gap - coalesce(max(z.upto), 0), e.bits - 1 FROM e LEFT JOIN z ON e.source IS NOT DISTINCT FROM z.source AND z.bits = e.bits - 1 AND z.upto <= e.gap WHERE e.bits > 0 GROUP BY e.source, e.gap, e.bits),
o2 AS (SELECT z.doc_id, z.source, z.rk FROM z JOIN e ON z.source IS NOT DISTINCT FROM e.source AND e.bits = z.bits + 1 AND z.upto <= e.gap),
y AS (SELECT b.doc_id, b.source, b.rk FROM b JOIN a ON b.source IS NOT DISTINCT FROM a.source WHERE b.rk <= a.rk UNION ALL SELECT * FROM o2),
x AS (SELECT b.source, arg_min(b.doc_id, (b.size, b.q, b.doc_id)) AS doc_id FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source AND e.bits = 0 ANTI JOIN y ON b.source IS NOT DISTINCT FROM y.source AND b.rk = y.rk
  WHERE b.size > e.gap AND b.size - e.gap < e.gap GROUP BY b.source),
t2 AS (SELECT doc_id FROM y UNION ALL SELECT doc_id FROM x)
SELECT q.doc_id, size, source_size, target, CAST((base + CAST(t2.doc_id IS NOT NULL AS INT)) * size AS BIGINT) AS taken FROM q LEFT JOIN t2 ON q.doc_id = t2.doc_id"""

OP7 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM w)),
f AS (SELECT p, min(doc_id) AS first FROM s GROUP BY p HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, i + k AS i FROM (SELECT s.doc_id, i, unnest(range(0, 13)) AS k FROM s JOIN f USING (p) WHERE first < doc_id)),
x AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
k AS (SELECT x.doc_id, count(r.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE r.i IS NULL), '') AS kept
  FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.i = r.i GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
c AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM c GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, e.vec_id = m.component_id AS kept
FROM embeddings e JOIN m ON e.vec_id = m.a LEFT JOIN n ON e.vec_id = n.a"""

OP9 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS h FROM p),
k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS keep FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keep THEN keep END AS refers_to FROM k"""

OP10 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10"""


OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
  + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT) + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
  + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
b AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS b(f, bit)),
o AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits FROM b p JOIN b q ON p.f <> q.f JOIN b r ON r.f NOT IN (p.f, q.f) JOIN b s ON s.f NOT IN (p.f, q.f, r.f) JOIN b t ON t.f NOT IN (p.f, q.f, r.f, s.f)),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1 : step - 1]), 0) AS INT) AS earlier FROM (SELECT *, unnest(range(1, 6)) AS step FROM o))
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (WHERE mask & (earlier | bit) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (WHERE mask & earlier > 0 AND mask & bit > 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (WHERE mask & bit > 0), 0) AS BIGINT) AS shapley
FROM c, s GROUP BY part, filter_order, step"""

_TEMPLATES = ", ".join(f"({i}, '{t.label}', {str(t.phrase).lower()}, '{t.text}')" for i, t in enumerate((*licenses.PHRASES, *licenses.NOTICES)))

OP12 = r"""
WITH t AS (SELECT id, label, phrase, string_split(x, ' ') AS w, CASE WHEN phrase THEN 2 ELSE 4 END AS k FROM (VALUES {templates}) AS t(id, label, phrase, x)),
tg AS (SELECT id, label, phrase, k, spot, len(w) AS size, len(w) - k + 1 AS grams, array_to_string(w[spot + 1 : spot + k], ' ') AS gram FROM (SELECT *, unnest(range(0, len(w) - k + 1)) AS spot FROM t)),
d AS MATERIALIZED (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT uid, k, pos, array_to_string(w[pos + 1 : pos + k], ' ') AS gram FROM (SELECT uid, k, w, unnest(range(0, greatest(len(w) - k + 1, 0))) AS pos FROM d, (VALUES (2), (4)) AS n(k))),
v AS MATERIALIZED (SELECT uid, id, label, phrase, size, grams, spot, pos - spot AS diagonal FROM g JOIN tg USING (k, gram)),
p AS (SELECT uid, label, diagonal AS start, 1.0::DOUBLE AS similarity, true AS base FROM v WHERE phrase GROUP BY uid, id, label, diagonal, grams HAVING count(*) = grams),
y AS (SELECT uid, id, label, size, diagonal, list(DISTINCT spot) AS ats, list(DISTINCT spot + diagonal) AS placed FROM v WHERE NOT phrase GROUP BY uid, id, label, size, diagonal),
m AS (SELECT *, flatten(list(ats) OVER near) AS theirs, flatten(list(placed) OVER near) AS ours FROM y WINDOW near AS (PARTITION BY uid, id ORDER BY diagonal RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
c AS (SELECT uid, id, label, size, diagonal, least(len(list_distinct(flatten(list_transform(theirs, lambda a: range(a, a + 4))))), len(list_distinct(flatten(list_transform(ours, lambda a: range(a, a + 4)))))) AS common,
  list_max(ours) + 4 - list_min(ours) AS long FROM m),
s AS (SELECT *, common::DOUBLE / (size + long - common) AS similarity FROM c),
b AS (SELECT *, max((similarity, -diagonal)) OVER (PARTITION BY uid, id ORDER BY diagonal RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS best FROM s),
a AS (SELECT * FROM p UNION ALL SELECT uid, label, NULL, similarity, false FROM b WHERE similarity >= 0.8 AND best = (similarity, -diagonal)),
r AS (SELECT uid, count(*) FILTER (WHERE base) AS n, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(similarity) AS score FROM a GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN r USING (uid)""".replace("{templates}", _TEMPLATES)


def oracle_sql() -> dict[str, str]:
    return {"op1_chat": OP1, "op3_mixing": OP3, "op7_phrases": OP7, "op8_embeddings": OP8, "op9_warc": OP9, "op10_search": OP10, "op11_filters": OP11, "op12_licenses": OP12}
