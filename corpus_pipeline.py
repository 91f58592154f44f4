"""A training corpus from raw documents, in five stages.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the next documents.  ``run`` applies them to ``documents`` and
keeps each stage's result as a table in the shared folder, so that a lost
executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import decontaminate, jaccard_forest, langid, sentencepiece_backend, stages, substring
from clinlake.llm.queries import PIECES

#: A fitted model and trained dictionaries have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is rejected as unsure, go."""
    model = langid.fit(docs.where(langid.fold(F.col("doc_id")) != 0), order=F.xxhash64("doc_id"))
    return langid.identify(docs, model).where("not rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id."""
    return jaccard_forest.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of twenty words that occurred earlier go, with the
    white space behind them; what else a text holds, and texts without such a
    passage, stay as they are.  ``n_chars`` follows."""
    cut = substring.remove_repeats(docs)
    new = {"text": F.coalesce("rest", "row.text"), "n_chars": F.coalesce(F.length("rest").cast("long"), "row.n_chars")}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as piece ids, with the text they decode to."""
    coded = sentencepiece_backend.encode_decode(docs, PIECES)
    return coded.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded",
                        "round_trip", "parity")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stages.store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
