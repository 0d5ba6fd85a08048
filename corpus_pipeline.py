"""A pipeline from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs; tables that a stage writes for itself are removed when the next one begins. All but the last return the columns of ``documents``; row order and extra columns of the input don't
matter. An empty table, or one that a stage empties, gives an empty result. Very long texts go through whole. A null
source is a source of its own in mixing and packing; a null lang is never learned from and stays null.

1. language_id: documents without letters, and those whose language stays ambiguous, go. lang is not changed.
2. near_duplicates: the SimHash operator groups fingerprints of 5-word shingles; as two bits of 64 find only texts that
   are nearly equal, MinHash bands add candidates. Texts of one group or band are linked if their sets of 5-word
   shingles have a Jaccard similarity of 0.8 or more, exactly; of each component one document stays, the one with the
   smallest doc_id (null ones last, and of those one).
3. secret_scan: secrets are replaced by a mark, n_chars follows the text. No document goes.
4. mixing: documents are taken as often as the mix of sources says: not at all, once or twice. Copies are rows that
   repeat the document.
5. packing: the result is one row a piece of a sequence.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import jaccard, langid, mixing, packing, secret_scan
from sievewright.llm.common import drop_unread, materialise, recording
from sievewright.llm.queries import tokenizer_path
from sievewright.session import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose language is ambiguous at a score below this go.
LEAST_SCORE = 0.4


#: What the stages have written for themselves; it goes when the next stage begins, whose docs no longer read it.
_tables: list[str] = []


def _stage(run: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @wraps(run)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_unread(_tables, docs)
        with recording(_tables):
            return run(spark, docs, sf_dir)

    return stage


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 2).select("doc_id", "text", "lang"))
    rows = langid.identify(docs.select(*COLUMNS), model)
    unsure = F.col("ambiguous") & (F.col("score") < LEAST_SCORE)
    return rows.where((F.col("lang_pred") != langid.UNKNOWN) & ~unsure).select(*COLUMNS)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """The documents with ``row``, a number that tells them apart, written once so that it stays theirs."""
    return materialise(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), label)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs, "numbered")
    found = jaccard.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "of")
    # The first of a component: the smallest doc_id, null ones last.
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    first = rows.select("row", "doc_id").join(found, F.col("row") == F.col("of")).groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(first.select(F.col("first.row").alias("of")), F.col("row") == F.col("of")).select(*COLUMNS)


@_stage
def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = secret_scan.redact(docs.select(*COLUMNS))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs, "numbered")
    taken = mixing.mix(rows, keep=("row",)).where("copies > 0").select(F.col("row").alias("of"), "copies")
    met = rows.join(taken.hint("merge"), F.col("row") == F.col("of"))  # no broadcast: taken grows with the documents
    return met.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan_stage),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the language classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
