"""Structured Streaming jobs. Each drains the available files and stops, so a
scheduler can rerun it; the checkpoint folder keeps what is already done."""

import hashlib
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import digest
from corpusloom.operators.chunks import validate_chunks
from corpusloom.operators.dedup import latest_rows
from corpusloom.sources.scan import FILE, ORDINAL, ROW, FileOrder
from corpusloom.sources.tables import PARTITIONS, read_table, upsert_latest, write_table
from corpusloom.sources.workdir import folder_names, is_folder, mark, partition_values, path_exists, remove


def file_stream(
    spark: SparkSession, folder: str, schema, name_glob: str | None = None, files_per_batch: int = 64
) -> DataFrame:
    """A Parquet folder as a stream, a bounded number of files per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files or a single file (which a file
    stream reads by its name from the folder around it)."""
    if is_folder(spark, path):
        return file_stream(spark, path, schema, files_per_batch=files_per_batch)
    folder, name = path.rstrip("/").rsplit("/", 1)
    return file_stream(spark, folder, schema, name, files_per_batch)


def drain(query) -> None:
    """Wait until the stream has processed what was available."""
    query.awaitTermination()


def ingest_chunks(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    chunk_size: int,
    dataset: str,
    config: str,
    run_ts: str,
    cap: int | None = None,
    order: FileOrder | None = None,
):
    """Store a file stream in chunks of `chunk_size` rows per source file.

    With the `order` of the whole source, chunks are those of the batch path instead: rows
    are numbered over all its files, and a file that is not in it is refused. A chunk that
    crosses the end of a file then lies in two partitions.

    A row's chunk comes from the full path of its file (partitions carry a digest of
    it) and its position in that file, never from the batch number. A replayed batch
    therefore overwrites the partitions it wrote before, and the table holds every row
    once. A batch holds whole files, so the end of a file's last chunk is known there.
    """
    path = F.col("_metadata.file_path")
    positioned = stream.select(
        "*",
        path.alias("source_file"),
        F.left(digest(path), F.lit(32)).alias("source_key"),
        F.col("_metadata.row_index").cast("long").alias(ROW),
    )
    if order is not None:
        keyed = positioned.withColumn(FILE, F.col("source_file"))
        positioned = order.number(keyed, strict=True).withColumnRenamed(ORDINAL, ROW)
    index = F.floor(F.col("_row") / chunk_size).cast("long")
    rows = positioned.withColumns(
        {
            "_meta_dataset_name": F.lit(dataset),
            "_meta_config_name": F.lit(config),
            "_meta_chunk_index": index,
            "_meta_start_idx": index * F.lit(chunk_size).cast("long"),
            "_meta_end_idx": (index + 1) * F.lit(chunk_size).cast("long"),
            "chunk_index": index,
        }
    )

    def store(batch: DataFrame, _batch_id: int) -> None:
        if order is not None:
            sized = batch.withColumn("_length", F.lit(order.rows).cast("long"))
        else:
            lengths = batch.groupBy("source_key").agg((F.max("_row") + 1).alias("_length"))
            # One row per file of the batch, whose number the stream bounds.
            sized = batch.join(F.broadcast(lengths), "source_key")
        clamped = sized.withColumn("_meta_end_idx", F.least("_meta_end_idx", "_length"))
        if cap is not None:
            clamped = clamped.filter(F.col("_row") - F.col("_meta_start_idx") < cap)
        write_table(
            clamped.drop("_row", "_length"),
            table,
            "overwrite",
            ["source_key", "chunk_index"],
            run_ts=run_ts,
            balance=False,
        )

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested_verdicts(table: DataFrame) -> DataFrame:
    """Validation verdict per stored chunk."""
    return validate_chunks(table, ["source_key", "chunk_index"])


def append_files(stream: DataFrame, path: str, checkpoint: str):
    """Write a stateless stream to Parquet; the sink's log makes it exactly-once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


DEDUP_KEYS = ["_digest", "url"]
STREAM, STREAM_BATCH = "_stream", "_batch"


def stream_key(checkpoint: str) -> str:
    """Short name of the stream that keeps its progress in this checkpoint folder."""
    return "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:15]


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that a stream has finished, -1 if there is none."""
    names = folder_names(spark, f"{checkpoint.rstrip('/')}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def latest_wins(stream: DataFrame, log: str, checkpoint: str, order):
    """Log the latest row per (text, url) of every batch.

    The stream's own duplicate removal keeps the first row it sees, so this
    keeps all batch winners and `read_latest` picks the newest of them. A batch
    costs what it holds, however large the log is. A replayed batch overwrites
    its own partition. Several streams may share a log.
    """
    keyed = stream.withColumn("_digest", digest("text"))
    name = F.lit(stream_key(checkpoint))

    def store(batch: DataFrame, batch_id: int) -> None:
        winners = latest_rows(batch, DEDUP_KEYS, order).withColumns({STREAM: name, STREAM_BATCH: F.lit(batch_id)})
        write_table(winners, log, "overwrite", [STREAM, STREAM_BATCH], balance=False)

    return (
        keyed.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _logged_batches(spark: SparkSession, log: str) -> dict[str, list[int]]:
    """Numbers of the logged batches of each stream, from the log's folders."""
    streams = partition_values(spark, log, STREAM)
    return {s: [int(b) for b in partition_values(spark, f"{log}/{STREAM}={s}", STREAM_BATCH)] for s in streams}


def merged_marks(spark: SparkSession, table: str) -> dict[str, int]:
    """For each stream, the last batch that the table holds: the names of the folders in
    `<table>.merged`, which appear whole or not at all."""
    marks: dict[str, int] = {}
    for name in folder_names(spark, f"{table.rstrip('/')}.merged"):
        stream, batch = name.rsplit("-", 1)
        marks[stream] = max(marks.get(stream, -1), int(batch))
    return marks


def _log_rows(spark: SparkSession, log: str, wanted: dict[str, list[int]]) -> DataFrame | None:
    """Logged rows of some batches; only their folders are read."""
    picked = [
        (F.col(STREAM) == s) & F.col(STREAM_BATCH).between(min(bs), max(bs)) for s, bs in wanted.items() if bs
    ]
    if not picked:
        return None
    return read_table(spark, log).where(reduce(or_, picked)).drop(STREAM, STREAM_BATCH)


def read_latest(spark: SparkSession, log: str, order, table: str | None = None) -> DataFrame:
    """The latest row per (text, url) over all logged batches and, if it is named, the
    table that earlier batches were merged into. Batches that the table holds are not read
    again from the log."""
    marks = merged_marks(spark, table) if table else {}
    logged = {s: [b for b in bs if b > marks.get(s, -1)] for s, bs in _logged_batches(spark, log).items()}
    parts = [p for p in [_log_rows(spark, log, logged)] if p is not None]
    if table and path_exists(spark, table):
        parts.append(read_table(spark, table).drop(*PARTITIONS))
    if not parts:
        raise ValueError(f"nothing is stored in {log}" + (f" or {table}" if table else ""))
    return latest_rows(reduce(DataFrame.unionByName, parts), DEDUP_KEYS, order).drop("_digest")


def compact_latest(
    spark: SparkSession, log: str, table: str, order, buckets: int | None = None, checkpoints=None
) -> None:
    """Merge logged batches into a keyed table, mark them as merged, then drop them.

    With `checkpoints`, only batches that those streams have committed are merged, so it
    may run beside them; otherwise all logged ones are, while the streams stand still. If
    it fails before the mark, merging the same batches again changes nothing; batches that
    are marked but not dropped yet are dropped by the next call.
    """
    marks, last = merged_marks(spark, table), None
    if checkpoints is not None:
        last = {stream_key(c): committed_batch(spark, c) for c in checkpoints}
    logged = _logged_batches(spark, log)
    new = {
        s: [b for b in bs if b > marks.get(s, -1) and (last is None or b <= last.get(s, -1))] for s, bs in logged.items()
    }
    rows = _log_rows(spark, log, new)
    if rows is not None:
        upsert_latest(latest_rows(rows, DEDUP_KEYS, order), table, DEDUP_KEYS, order, buckets)
        for stream, batches in new.items():
            if batches:
                mark(spark, f"{table.rstrip('/')}.merged/{stream}-{max(batches)}")
    marks = merged_marks(spark, table)
    for stream, batches in logged.items():
        for batch in batches:
            if batch <= marks.get(stream, -1):
                remove(spark, f"{log}/{STREAM}={stream}/{STREAM_BATCH}={batch}")


def quality_counters(stream: DataFrame) -> DataFrame:
    """Running counts per dataset. State is one row per dataset; medians need
    all values and stay with the batch summary."""
    return stream.groupBy(F.col("_meta_dataset_name").alias("dataset_name")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("quality_class") == "high").alias("high_quality_count"),
        F.count_if(F.col("quality_class") == "medium").alias("medium_quality_count"),
        F.count_if(F.col("quality_class") == "low").alias("low_quality_count"),
        F.count_if(F.col("quality_class") == "poor").alias("poor_quality_count"),
        F.sum("is_anomaly").alias("anomaly_count"),
        F.sum("text_length").alias("total_characters"),
        F.min("text_length").alias("min_text_length"),
        F.max("text_length").alias("max_text_length"),
        F.min("quality_score").alias("min_quality_score"),
        F.max("quality_score").alias("max_quality_score"),
    )


def publish_counters(counters: DataFrame, path: str, checkpoint: str):
    """Replace the published counters after every batch."""

    def publish(batch: DataFrame, _batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(path)

    return (
        counters.writeStream.outputMode("complete")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def table_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table a stream may not have written yet."""
    if path_exists(spark, path):
        return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)
