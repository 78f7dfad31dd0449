"""From raw documents to packed training sequences: five stages, each one operator over all rows its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; :func:`run` writes each to the shared folder and reads it
back, so a lost executor costs part of a stage. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.llm import mixing, packing, quality, simhash, toxicity
from delayworks.llm.common import stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the operator's threshold go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier poor than good go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies stays."""
    return simhash.one_of_each(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document holds the words that the mix takes of it, repeated passes included; untaken documents go."""
    mixed = mixing.texts(docs, mixing.mix(docs))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it stands in which sequence, with the checksum of its ids."""
    pieces = packing.stored_pieces(docs)
    digests = pieces.select("id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place(digests).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]
#: The fitted chains and the packing program cannot be said in SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
