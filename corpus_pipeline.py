"""From raw documents to a training mixture, in stages that each write Parquet.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statloom.llm import langid, pii
from statloom.llm.decontaminate import decontaminate
from statloom.llm.mixing import mix
from statloom.llm.neardup import near_duplicates
from statloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Mean over words of the largest language share; a text that switches between languages has a high one.
LEAST_CERTAINTY = 0.45


def hashed(docs: DataFrame) -> DataFrame:
    """The documents with `text_hash`; with the id it tells rows apart that are not repeated."""
    return docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))


def same_row(other: DataFrame) -> Column:
    return F.col("doc_id").eqNullSafe(other["of_doc"]) & (F.col("text_hash") == other["of_hash"])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letter, or words that are in doubt one by one."""
    guess = langid.classify(docs, langid.fit(docs), "text")
    named = docs.select(*COLUMNS, guess.alias("guess"))
    return named.where((F.col("guess.lang_pred") != langid.UNKNOWN) & (F.col("guess.certainty") >= LEAST_CERTAINTY)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, that with the smallest id.

    Of repeated rows with an id one stays; rows without an id stay if their group has none.
    """
    found = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_hash")).distinct()
    joined = hashed(docs).join(found, same_row(found))
    copy = F.row_number().over(W.partitionBy("doc_id", "text_hash").orderBy("lang", "source", "n_chars"))
    return joined.withColumn("copy", copy).where("copy = 1 or doc_id is null").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold most of a benchmark item."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_hash")).distinct()
    return hashed(docs).join(found, same_row(found), "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; `n_chars` follows the new text."""
    found = pii.detect(docs, "text", tuple(COLUMNS)).select("carried.*", "spans")
    text = pii.redact(F.col("text"), F.col("spans"))
    changed = found.withColumn("text", text)
    length = F.when(F.size("spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", length).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take sources at their target weights: documents of no copies go, others appear once per copy."""
    mixed = mix(docs, carry=COLUMNS).where("copies > 0")
    copies = mixed.select("carried.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return copies.select(*COLUMNS, "copy")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

# A conditional random field, MinHash, tilings and a trained classifier are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
