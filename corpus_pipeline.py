"""From raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lookfuse.llm import decontamination, line_dedup, mixture, ngram_join, quality
from lookfuse.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules judge good; the others go."""
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that many sites share, or three if they are long; one left without a word goes, unless it had none before."""
    cleaned = line_dedup.drop_boilerplate(docs, long_sites=line_dedup.LONG_SITES, min_chars=line_dedup.LINE_CHARS, long_chars=line_dedup.LONG_CHARS)
    return cleaned.where("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles, similarity 0.8, the one with the smallest id."""
    return ngram_join.keep_first(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken, in the order of training."""
    return mixture.mixed_order(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", mix_sources),
]

# The quality stage's verdicts come from expectation-maximisation, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
