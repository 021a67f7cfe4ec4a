"""Chunks: half-open row ranges of a corpus, their plan, checks and manifest.

A row's chunk follows from its ordinal by division, so chunking moves no data.
The plan, the manifest and the summary hold one row per chunk.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.numeric import ratio
from corpusloom.functions.text import chunk_path
from corpusloom.sources.scan import ORDINAL
from corpusloom.sources.tables import write_table

CHUNK_KEYS = ("dataset_key", "chunk_index")


def assign_chunks(df: DataFrame, size: int) -> DataFrame:
    """Add chunk_index and start_idx from the row ordinal."""
    index = F.floor(F.col(ORDINAL) / size).cast("long")
    return df.withColumn("chunk_index", index).withColumn(
        "start_idx", F.col("chunk_index") * F.lit(size).cast("long")
    )


def chunk_plan(
    totals: DataFrame, size: int, dataset: str, config: str, key: str, batch_size: int = 500
) -> DataFrame:
    """All chunks of a corpus from its row count (a frame with column `total`).

    The total is one number; the chunks are a range of numbers spread over tasks.
    """
    total = totals.agg(F.max("total")).first()[0] or 0
    start = F.col("chunk_index") * F.lit(size).cast("long")
    end = F.least(start + size, F.lit(total).cast("long"))
    indexes = totals.sparkSession.range(-(-total // size)).withColumnRenamed("id", "chunk_index")
    return indexes.select(
        F.lit(key).alias("dataset_key"),
        "chunk_index",
        start.alias("start_idx"),
        end.alias("end_idx"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(config).alias("config_name"),
        F.lit(batch_size).cast("long").alias("batch_size"),
        (end - start).alias("expected_size"),
    )


def row_total(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame; for Parquet this reads footers only."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def declared_total(spark: SparkSession, rows: int) -> DataFrame:
    """A corpus size that is announced rather than counted."""
    return spark.range(1).select(F.lit(rows).cast("long").alias("total"))


def limit_chunks(df: DataFrame, max_chunks: int) -> DataFrame:
    """The first chunks of every dataset. On a chunk table this prunes folders."""
    return df.filter(F.col("chunk_index") < max_chunks)


def cap_rows(df: DataFrame, cap: int) -> DataFrame:
    """The first `cap` rows of every chunk."""
    return df.filter(F.col(ORDINAL) - F.col("start_idx") < cap)


def validate_chunks(df: DataFrame, keys=("chunk_index",), min_records: int = 1) -> DataFrame:
    """One verdict per chunk: enough rows and a text column; a warning when
    more than half of the texts are NULL."""
    has_text = "text" in df.columns
    nulls = F.count_if(F.col("text").isNull()) if has_text else F.count(F.lit(1))
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("actual_records"), nulls.alias("null_texts")
    )
    return counted.withColumns(
        {
            "valid": (F.col("actual_records") >= min_records) & F.lit(has_text),
            "warn_null_text": F.col("null_texts") > F.col("actual_records") * F.lit(0.5),
        }
    )


def stamp_metadata(df: DataFrame, dataset: str, config: str, size: int, total=None) -> DataFrame:
    """Add the chunk bookkeeping columns to every row."""
    end = F.col("start_idx") + F.lit(size).cast("long")
    if total is not None:
        end = F.least(end, F.lit(total).cast("long"))
    return df.withColumns(
        {
            "_meta_dataset_name": F.lit(dataset),
            "_meta_config_name": F.lit(config),
            "_meta_chunk_index": F.col("chunk_index"),
            "_meta_start_idx": F.col("start_idx"),
            "_meta_end_idx": end,
        }
    )


def with_chunk_path(plan: DataFrame, prefix: str = "raw") -> DataFrame:
    path = chunk_path(
        F.col("dataset_name"),
        F.col("config_name"),
        F.col("chunk_index"),
        F.col("start_idx"),
        F.col("end_idx"),
        prefix,
    )
    return plan.withColumn("parquet_path", path)


def write_chunks(df: DataFrame, path: str) -> None:
    """Store rows by dataset and chunk. Rows of a chunk already sit together in
    the scan, so no shuffle precedes the write; rewriting a chunk replaces it."""
    write_table(df, path, "overwrite", CHUNK_KEYS, balance=False)


def pending_chunks(plan: DataFrame, stored: DataFrame) -> DataFrame:
    """Planned chunks that are not stored yet."""
    return plan.join(stored.select(*CHUNK_KEYS).distinct(), list(CHUNK_KEYS), "left_anti")


def stored_counts(chunks: DataFrame) -> DataFrame:
    """Rows per stored chunk; reads footers only."""
    return chunks.groupBy(*CHUNK_KEYS).agg(F.count(F.lit(1)).alias("records"))


def chunk_manifest(
    plan: DataFrame,
    written: DataFrame,
    source: DataFrame | None = None,
    max_chunks=None,
    root: str | None = None,
    min_records: int = 1,
) -> DataFrame:
    """One status record per planned chunk.

    `written` holds records per stored chunk, and may hold `null_texts`. `source` may
    hold the records each chunk should have had: a chunk with source rows but another
    number of written ones is `write_failed`, and one with fewer than `min_records` is
    `failed`; `error` says why. Chunks beyond `max_chunks` are `skipped`. With `root`,
    the folder of the chunk table, `parquet_path` is where the chunk lies.
    """
    if "null_texts" not in written.columns:
        written = written.withColumn("null_texts", F.lit(0).cast("long"))
    joined = plan.join(written, list(CHUNK_KEYS), "left")
    if source is not None:
        expected = source.select(*CHUNK_KEYS, F.col("records").alias("_source"))
        joined = joined.join(expected, list(CHUNK_KEYS), "left")
    else:
        joined = joined.withColumn("_source", F.col("records"))
    actual = F.coalesce(F.col("records"), F.lit(0).cast("long"))
    wanted = F.coalesce(F.col("_source"), F.lit(0).cast("long"))
    skipped = F.lit(False) if max_chunks is None else F.col("chunk_index") >= max_chunks
    status = (
        F.when(skipped, "skipped")
        .when(actual != wanted, "write_failed")
        .when(actual == 0, "no_data")
        .when(actual < min_records, "failed")
        .otherwise("success")
    )
    counts = F.concat(F.lit("stored "), actual.cast("string"), F.lit(" of "), wanted.cast("string"), F.lit(" records"))
    few = F.concat(F.lit("fewer than "), F.lit(min_records).cast("string"), F.lit(" records"))
    error = F.when(status == "write_failed", counts).when(status == "failed", few)
    located = with_chunk_path(joined)
    if root is not None:
        folder = [F.lit(f"{root}/dataset_key="), "dataset_key", F.lit("/chunk_index="), F.col("chunk_index").cast("string")]
        located = located.withColumn("parquet_path", F.concat(*folder))
    return located.select(
        "dataset_key",
        "chunk_index",
        "start_idx",
        "end_idx",
        "expected_size",
        status.alias("status"),
        actual.alias("records"),
        F.when(status == "success", F.col("parquet_path")).alias("parquet_path"),
        error.alias("error"),
        F.coalesce(F.col("null_texts") * 2 > actual, F.lit(False)).alias("warn_null_text"),
    )


FAILED = ("failed", "error", "write_failed")


def failed_chunks(manifest: DataFrame) -> DataFrame:
    """The chunks that failed, each with its dataset and the reason."""
    return manifest.filter(F.col("status").isin(*FAILED)).select("dataset_key", "chunk_index", "status", "error")


def run_summary(manifest: DataFrame) -> DataFrame:
    """Chunk counts by status, records and mean fill of successful chunks, per dataset
    and overall (dataset_key 'TOTAL').

    The total comes from the same pass: every manifest row counts once for its
    dataset and once for the total.
    """
    success = F.col("status") == "success"
    both = manifest.withColumn("_key", F.explode(F.array("dataset_key", F.lit("TOTAL"))))
    return both.groupBy(F.col("_key").alias("dataset_key")).agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.count_if(success).alias("successful"),
        F.count_if(F.col("status").isin(*FAILED)).alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "no_data").alias("no_data"),
        F.coalesce(F.sum(F.when(success, F.col("records"))), F.lit(0)).alias("total_records"),
        F.coalesce(
            F.avg(F.when(success, ratio("records", "expected_size"))), F.lit(0.0)
        ).alias("average_efficiency"),
    )
