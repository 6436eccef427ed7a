"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept and returns documents with
the same columns, the last one the packed pieces.  ``run`` writes every stage as
Parquet to the shared folder and reads it back, so a lost executor costs the running
stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.llm import packing, pseudonyms, quality_rules, simhash, staging, winnowing

#: The key of the pseudonyms; a deployment sets its own.
PSEUDONYM_KEY = "corpus-pipeline"
SHINGLE_WORDS, RADIUS = 3, 2
CAPACITY, END_ID = 2048, 0

#: The stages have no SQL form: tokenizers, keyed permutations and components are not
#: expressible; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy does not reject."""
    ledger = staging.unused(docs, "quality")
    judged = quality_rules.with_ledger(docs, out=ledger)
    rejected = quality_rules.rejected(F.col(f"{ledger}.failed"), quality_rules.POLICIES["v1"])
    return judged.where(~rejected).drop(ledger)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines; those that lose all their words go."""
    deleted = staging.unused(docs, "deleted_lines")
    left = winnowing.deduplicated(docs, staging.run_folder(spark, "lines"), deleted_col=deleted)
    words = F.translate("text", quality_rules.BLANKS, "") != ""
    return _counted(left.where(words | (F.col(deleted) == 0)).drop(deleted))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, staging.run_folder(spark, "simhash"), SHINGLE_WORDS, RADIUS)


def replace_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for private values."""
    return _counted(pseudonyms.pseudonymized(docs, PSEUDONYM_KEY))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in training sequences."""
    return packed(spark, docs)


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    cut, placed = packing.packed(
        docs,
        staging.run_folder(spark, "packing"),
        public_tokenizers.path("word_bpe_49k.json"),
        CAPACITY,
        END_ID,
    )
    digests = cut.select("uid", "piece", F.crc32("ids").alias("ids_crc32"))
    return placed.join(digests, ["uid", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def _counted(docs: DataFrame) -> DataFrame:
    """Keeps the stored number of characters true to the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("private values", replace_private_values),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = staging.run_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = staging.stored(stage(spark, docs, sf_dir), f"{folder}/{i}")
    return docs
