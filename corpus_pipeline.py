"""The corpus pipeline: language, repeated lines, near duplicates, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns documents with the columns it was given; the last returns the pieces of
the packed sequences. ``run`` writes each stage's result to the shared folder and reads it back for the next, so a lost
executor costs one stage at most. Documents that share an id are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettrage.llm import decontaminate, jaccard_join, language, line_dedup, packing
from lettrage.llm.shared import stored, without

#: Texts of which less than this share is known in any language are rejected.
LEAST_KNOWN = 0.02
WORDS, PERCENT = 5, 80
#: Neither SimHash filters nor learned language models nor a tokenizer can be written in SQL.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without text or letters go, and those of unknown windows."""
    judged = language.predict(docs, language.fit(docs))
    return without(docs, judged.filter((F.col("lang_pred") == language.UNKNOWN) | (F.col("known") < LEAST_KNOWN)).select("doc_id", "body"))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; ``n_chars`` follows the text. A document that loses all
    its lines stays, with empty text."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    return kept.select(*[
        (F.when(changed, new[c].cast(kind)).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c) for c, kind in docs.dtypes
    ])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near duplicates."""
    groups = jaccard_join.similar_groups(docs, WORDS, PERCENT)
    return without(docs, groups.filter("component_id <> doc_id").select("doc_id"))


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, leaks.select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", known_language), ("line_dedup", unrepeated_lines), ("near_duplicates", one_of_each_group),
    ("decontamination", free_of_benchmark), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
