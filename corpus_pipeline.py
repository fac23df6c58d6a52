"""The corpus pipeline: stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All
but the last return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelattice.llm import decontaminate, language_id, packing, pii, simhash
from carelattice.llm.common import ship_package, table, unused_name, written
from carelattice.llm.queries import tokenizer_path

# The stages learn, link and pack whole corpora; no SQL expresses them.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is found; texts that are NULL or have no letter go."""
    ship_package(spark)
    known = language_id.profiles(language_id.training_rows(docs))
    return language_id.identified(docs, known)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash class the row with the smallest id, NULL ids last.

    Rows that share an id or have none are told apart by their texts; of rows equal in
    id and text one stays.
    """
    ship_package(spark)
    kept = simhash.class_leaders(docs, shingle=4, max_bits=4).select(F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    key, number = unused_name(docs, "text_key"), unused_name(docs, "row")
    keyed = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    order = Window.partitionBy("doc_id", key).orderBy(F.xxhash64(*docs.columns))
    return (
        keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["kept_id"]) & (keyed[key] == kept["kept_key"]), "left_semi")
        .withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).select(*docs.columns)
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without enough words of benchmark passages, those of items without an id included."""
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), unnamed=True)
    bad = judged.where("contaminated").select(F.col("doc_id").alias("bad_id"), "text_key").distinct()
    return docs.join(
        bad, docs.doc_id.eqNullSafe(bad.bad_id) & (F.xxhash64(docs.text) == bad.text_key), "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind."""
    ship_package(spark)
    clean = pii.mask(docs, pii.accepted_patterns(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path(), keep_words=False).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
