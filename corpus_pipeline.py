"""Corpus preparation from documents to packed sequences: each stage calls one operator of the subpackage.

A stage takes (spark, docs, sf_dir) and returns documents with the same columns; the last returns
packed pieces. Texts are judged and cut whole, and every stage works on all rows its predecessor kept.

Results for odd input: null texts count as empty; rows with null ids are judged like any other;
repeated rows pass until the near-duplicate stage, which keeps one; empty tables give no rows; extra
columns pass through up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm import lines, packing, quality, simhash, toxicity
from vitalframe.llm.common import share_code, table, written
from vitalframe.llm.queries import tokenizer_file

SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose clauses score below the threshold."""
    share_code(spark)
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("words")), grammar, text="words", keep=("row",))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and are more likely good than bad."""
    share_code(spark)
    judged = quality.judge_documents(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("words")), keep=("row",), text="words")
    return judged.where("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without long lines that others hold too."""
    share_code(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.col("text").alias("words"))
    cleaned = lines.drop_repeated(rows, keep=("row",), text="words")
    changed = {"text": F.col("kept_text")} | ({"n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cleaned.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    share_code(spark)
    return simhash.one_per_group(docs, SHINGLE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence."""
    share_code(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("line-dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("packing", pack),
]

# Learned weights, automata and genetic search are not SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
