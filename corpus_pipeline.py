"""The corpus pipeline: rules, line dedup, document dedup, decontamination, packing.

Each stage works on all rows that the stage before it kept. Null and empty texts,
repeated rows, ties, long texts, empty tables and further columns are handled as the
operators state: quality rules drop rows without text; line dedup drops a document
when every word of it stood in earlier lines; document dedup keeps one document of each
component; decontamination drops contaminated rows; packing returns
the pieces of all that is left.
"""

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontaminate, line_dedup, packing, parity_join, quality_rules
from corpusloom.sources.workdir import fresh_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(docs, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return parity_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark),
    ("packing", packed),
]

# Rarity order, sketches and best-fit packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
