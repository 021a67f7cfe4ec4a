import pytest
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.plans import staging
from corpusloom.sources import scan, tables
from corpusloom.sources.workdir import fresh_dir
from corpusloom.streaming import jobs
from verification import queries as Q

FOLDER = "/root/testdata/sf0.001"
RUN = "2024-01-01 00:00:00"


def split_documents(spark, path, parts=4):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.repartitionByRange(parts, "doc_id").write.parquet(path)
    return spark.read.parquet(path).schema


def test_ingest_resumes_and_replays_without_duplicates(spark):
    source, table, ckpt = (fresh_dir(spark, n) for n in ("src", "table", "ckpt"))
    schema = split_documents(spark, source)

    def ingest(checkpoint):
        stream = jobs.file_stream(spark, source, schema, files_per_batch=1)
        jobs.drain(
            jobs.ingest_chunks(stream, table, checkpoint, 20, V.WEB_DATASET, V.WEB_CONFIG, RUN)
        )
        return tables.read_table(spark, table)

    assert ingest(ckpt).count() == 200
    # More files arrive: the same checkpoint takes only the new ones.
    extra = spark.read.schema(schema).parquet(source).limit(5).withColumn("doc_id", F.col("doc_id") + 1000)
    extra.coalesce(1).write.mode("append").parquet(source)
    assert ingest(ckpt).count() == 205
    # A lost checkpoint replays everything onto the same partitions.
    again = ingest(fresh_dir(spark, "ckpt"))
    assert again.count() == 205 and again.select("doc_id").distinct().count() == 205
    verdicts = jobs.ingested_verdicts(again)
    assert verdicts.filter("NOT valid").count() == 0
    assert verdicts.agg(F.max("actual_records")).first()[0] <= 20


def test_stream_results_equal_batch(spark):
    batch = staging.clean_web(staging.web_rows(Q.raw_web(spark, FOLDER)), keep=["_row_key"])
    streamed = Q.stream_staging(spark, FOLDER)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    deduped = Q.REGISTRY["dedup_latest"](spark, FOLDER)
    merged = Q.stream_dedup(spark, FOLDER)
    assert merged.exceptAll(deduped).count() == 0 and deduped.exceptAll(merged).count() == 0


def test_dedup_over_many_batches(spark):
    """Copies of one text arrive in different batches; the latest one stays."""
    source = fresh_dir(spark, "src")
    rows = [("hot", None, i) for i in range(30)] + [(f"t{i}", "u", i) for i in range(10)]
    schema = "text string, url string, ts long"
    for part in range(4):
        spark.createDataFrame(rows[part::4], schema).coalesce(1).write.mode("append").parquet(source)
    stream = jobs.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    log, table, order = fresh_dir(spark, "log"), fresh_dir(spark, "table"), [F.col("ts").desc()]
    jobs.drain(jobs.latest_wins(stream, log, fresh_dir(spark, "ckpt"), order))
    expected = sorted([("hot", 29)] + [(f"t{i}", i) for i in range(10)])
    pairs = lambda df: sorted((r["text"], r["ts"]) for r in df.collect())
    assert pairs(jobs.read_latest(spark, log, order)) == expected
    for _ in range(2):
        jobs.compact_latest(spark, log, table, order, buckets=4)
        assert pairs(tables.read_table(spark, table)) == expected


def test_streams_go_on_after_a_merge(spark):
    """Rows of table and log together, whatever was merged, dropped or replayed."""
    source, base = fresh_dir(spark, "src"), fresh_dir(spark, "merge")
    schema = "text string, url string, ts long"
    order = [F.col("ts").desc()]
    log, table, checkpoint = f"{base}/log", f"{base}/table", f"{base}/checkpoint"
    latest = {}

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        latest.update({k: max(latest.get(k, t), t) for k, _, t in rows})
        stream = jobs.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
        jobs.drain(jobs.latest_wins(stream, log, checkpoint, order))

    def seen():
        return {r["text"]: r["ts"] for r in jobs.read_latest(spark, log, order, table).collect()}

    arrive([("a", "u", 5), ("b", "u", 1)])
    assert seen() == latest
    jobs.compact_latest(spark, log, table, order, checkpoints=[checkpoint])
    assert seen() == latest and not [b for bs in jobs._logged_batches(spark, log).values() for b in bs]
    # A newer and an older copy, and a new text.
    arrive([("a", "u", 3), ("b", "u", 2), ("c", None, 1)])
    assert seen() == latest == {"a": 5, "b": 2, "c": 1}
    # A batch that is not committed is left for later.
    jobs.compact_latest(spark, log, table, order, checkpoints=[f"{base}/other"])
    assert jobs.merged_marks(spark, table) == {jobs.stream_key(checkpoint): 0}
    assert jobs.committed_batch(spark, checkpoint) == 1 and jobs.committed_batch(spark, f"{base}/other") == -1
    jobs.compact_latest(spark, log, table, order)
    arrive([("c", None, 9)])
    assert seen() == latest


def test_merge_that_failed_before_its_mark_is_repeated(spark, monkeypatch):
    base, order = fresh_dir(spark, "merge"), [F.col("ts").desc()]
    log, table, source = f"{base}/log", f"{base}/table", f"{base}/source"
    spark.createDataFrame([("a", "u", 1), ("a", "u", 2)], "text string, url string, ts long").write.parquet(source)
    stream = jobs.file_stream(spark, source, spark.read.parquet(source).schema)
    jobs.drain(jobs.latest_wins(stream, log, f"{base}/checkpoint", order))
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "mark", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            jobs.compact_latest(spark, log, table, order)
    assert [r["ts"] for r in jobs.read_latest(spark, log, order, table).collect()] == [2]
    jobs.compact_latest(spark, log, table, order)
    assert [r["ts"] for r in jobs.read_latest(spark, log, order, table).collect()] == [2]
    with pytest.raises(ValueError, match="nothing is stored"):
        jobs.read_latest(spark, f"{base}/none", order, f"{base}/nowhere")


def test_counters_and_missing_table(spark):
    counts = {r["dataset_name"]: r for r in Q.stream_quality_counts(spark, FOLDER).collect()}
    assert counts[V.WEB_DATASET]["total_records"] == Q.raw_web(spark, FOLDER).count()
    empty = jobs.table_or_empty(spark, fresh_dir(spark, "none"), "a long")
    assert empty.count() == 0


def test_equal_file_names_in_two_folders(spark):
    source, table = fresh_dir(spark, "src"), fresh_dir(spark, "table")
    for day in (1, 2):
        frame = spark.range(10 * day, 10 * day + 10).coalesce(1)
        frame.write.parquet(f"{source}/d={day}")
    schema = "id long, d int"
    for ckpt in ("ckpt", "again"):
        stream = jobs.file_stream(spark, source, schema, files_per_batch=1)
        jobs.drain(jobs.ingest_chunks(stream, table, fresh_dir(spark, ckpt), 4, "d", "c", RUN))
        rows = tables.read_table(spark, table)
        assert rows.count() == 20 and rows.select("source_key").distinct().count() == 2
        assert rows.agg(F.max("_meta_end_idx")).first()[0] == 10


def test_tables_that_are_folders(spark, tmp_path):
    """The stream queries over tables of several files give what they give over one file."""
    for name in ("documents", "pages"):
        rows = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        rows.repartitionByRange(3, rows.columns[0]).sortWithinPartitions(rows.columns[0]).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("stream_ingest", "stream_staging", "stream_dedup", "stream_dedup_compacted", "stream_quality_counts"):
        one, many = (Q.REGISTRY[name](spark, folder) for folder in (FOLDER, str(tmp_path)))
        assert many.count() == one.count() > 0, name
        assert many.exceptAll(one).count() == 0, name


def test_ingest_refuses_a_file_that_its_order_lacks(spark):
    source = fresh_dir(spark, "src")
    schema = split_documents(spark, source, 2)
    order = scan.file_order_of(spark.read.parquet(source))
    spark.read.parquet(source).limit(5).coalesce(1).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="not in the order"):
        stream = jobs.file_stream(spark, source, schema)
        jobs.drain(jobs.ingest_chunks(stream, fresh_dir(spark, "t"), fresh_dir(spark, "c"), 20, "d", "c", RUN, order=order))
