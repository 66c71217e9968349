"""A corpus pipeline over `documents`: each stage reads all that its predecessor kept, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, decontaminate, language, linedup, neardup
from tidelog.llm._shared import drop_path, new_path, read
from tidelog.llm.queries import vocabulary

#: Documents of less of their language than this are none of the languages learned.
LEAST_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: not `und`, and with enough of it."""
    model = language.train(docs)
    columns = docs.columns
    found = language.predict(docs, model, keep=columns).filter((F.col("lang_pred") != language.UND) & (F.col("score") >= LEAST_SCORE))
    return found.select(*[F.col(f"kept_{c}").alias(c) for c in columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words; those of which nothing stays go. Own columns named n_lines or n_deleted stay as they are."""
    columns = docs.columns
    own = {c: f"__own_{c}" for c in ("n_lines", "n_deleted") if c in columns}
    found = linedup.deduplicate_lines(docs.withColumnsRenamed(own), min_words=50).filter((F.col("n_deleted") == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*[F.col(own.get(c, c)).alias(c) for c in columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its runs of five words."""
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by `benchmark`."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), window=13, share=20)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, with their digests."""
    return bpe.encode(docs, vocabulary("word_bpe_49k.json"), ids=True).drop("decoded")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup), ("benchmark_decontamination", benchmark_decontamination), ("bpe_encoding", bpe_encoding)]

#: SQL can express neither the language model nor the encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written to the shared folder and reread, and go when the next one's are there."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            drop_path(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
