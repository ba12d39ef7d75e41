"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the shared
folder and reads it back as the next stage's documents. All stages but the last return the columns of
documents. Stages see every row their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import decontaminate, jaccard, langid, packing, suffixes, tokens
from orderlake.llm.common import settle
from orderlake.llm.queries import PACK_END, PACK_TOKENIZER, SEQUENCE

#: The last stage's tokenizer has no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those it rejects go."""
    model = langid.fit(docs.where(F.col("doc_id").isNotNull()))
    return langid.predict(docs, model).where("accepted").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least key."""
    return jaccard.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that an earlier document has; n_chars follows the text.

    A null text stays null, and a text of which all goes becomes empty.
    """
    cut = suffixes.dedupe(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens, each with its ids."""
    return packing.pack(docs, tokens.public_path(PACK_TOKENIZER), PACK_END, SEQUENCE, keep_ids=True)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
          ("decontamination", decontamination), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
