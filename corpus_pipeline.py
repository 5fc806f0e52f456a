"""The corpus pipeline: documents, cleaned stage by stage, to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a stage
returns as Parquet to shared storage and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import common
from millrace.llm.decontaminate import decontaminate
from millrace.llm.line_dedup import count_names, line_dedup
from millrace.llm.ngram_join import drop_near_copies
from millrace.llm.packing import best_fit_packing
from millrace.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model learns from the stage's own input and `labels`."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are cut; a document that loses its last line that is not blank goes.

    n_chars follows the text that stays.
    """
    out, gone = line_dedup(docs), F.col(count_names(docs.columns)[1])
    left = (gone == 0) | (F.length(F.trim("text")) > 0)
    cols = [F.when(gone > 0, F.length("text")).otherwise(F.col(c)).cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c, t in docs.dtypes]
    return out.where(left).select(*cols)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or edited, go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every text in the packed sequences."""
    return best_fit_packing(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("ngram_jaccard_join", near_copies), ("benchmark_decontamination", benchmark), ("best_fit_packing", pack)]

#: SQL can express neither the trained model nor the packing; tests/llm/test_pipeline.py compares each stage with a brute-force version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
