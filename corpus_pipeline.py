"""The corpus pipeline: quality rules, language, near duplicates, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
run() writes each stage's result as Parquet in the folder that spark.checkpoint.dir names and reads it again as
the next stage's docs.

Edge cases of the stages: documents with null text go in the first stage (the later ones, by themselves, take null for
empty; language lets it go); empty texts and texts under 20 words fail the base rules; repeated rows stay as they are until the third
stage keeps one of each class, the one with the least doc_id (null last); texts of any length are whole in every stage;
further columns, whatever their names, are carried along to the last stage but one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytolake.llm import langid, minhash, packing, quality, suffix
from cytolake.llm.common import shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fitted verdict; null text goes."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one language that was learned; mixtures, gibberish, other languages and texts without a letter go."""
    return langid.keep(docs, langid.fit(langid.may_learn(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least doc_id, of each class."""
    return minhash.keep(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of suffix.PASSAGE_LEN bytes or more that occur twice or more, in a document or across them; all copies go."""
    return suffix.strip(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a sequence."""
    return packing.pack(docs).drop("ids")


STAGES = [("quality", quality_rules), ("language", language), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("packing", pack)]

#: The fitted verdicts, the language model and the hashing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = shared_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
