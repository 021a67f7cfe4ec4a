import pytest
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.operators import chunks as C
from corpusloom.plans import run
from corpusloom.sources import scan
from corpusloom.sources.workdir import fresh_dir


@pytest.fixture
def files(spark):
    """Ten files with rows 0..999 in file order and one column beside."""
    path = fresh_dir(spark, "files")
    spark.range(0, 1000, 1, 10).select(
        "id", F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("x").alias("other")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_ordinals_follow_file_order_without_shuffle(files, plan_of):
    numbered = scan.scan_with_ordinal(files)
    assert numbered.filter(F.col("id") != F.col(scan.ORDINAL)).count() == 0
    assert numbered.select(scan.ORDINAL).distinct().count() == 1000
    plan = plan_of(numbered)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_ordinals_survive_projection(files):
    numbered = scan.scan_with_ordinal(scan.project_fields(files))
    assert numbered.columns == ["text", "id", scan.ORDINAL]
    assert numbered.filter(F.col("id") != F.col(scan.ORDINAL)).count() == 0


@pytest.mark.parametrize("threshold", ["-1", "1"])
def test_texts_are_never_shuffled_by_file(spark, files, plan_of, threshold):
    """Whatever the planner's own broadcast limit, only the list of files is moved."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        numbered = scan.scan_with_ordinal(files)
        assert numbered.filter(F.col("id") != F.col(scan.ORDINAL)).count() == 0
        plan = plan_of(numbered)
        assert "SortMergeJoin" not in plan
        assert not [x for x in plan.splitlines() if "Exchange" in x and "text" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_planner_chooses_the_join_of_a_huge_file_list(spark, files, plan_of, monkeypatch):
    monkeypatch.setattr(scan, "BROADCAST_FILES", 9)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = scan.scan_with_ordinal(files)
        assert numbered.filter(F.col("id") != F.col(scan.ORDINAL)).count() == 0
        assert "BroadcastHashJoin" not in plan_of(numbered)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_order_is_computed_once_and_knows_gaps(files):
    order = scan.file_order_of(files)
    assert (order.files, order.rows, order.dense) == (10, 1000, True)
    gaps = scan.file_order_of(files.filter("id % 100 <> 99 AND id % 100 <> 5"))
    assert (gaps.rows, gaps.dense) == (990, False)


def test_filtered_source_keeps_places_over_several_files(spark, files):
    """Files lose their last rows or all rows, and the others stay where they are."""
    where = "id % 100 < 50 AND NOT id BETWEEN 200 AND 399"
    kept = [k for k in range(1000) if k % 100 < 50 and not 200 <= k <= 399]
    picked = run.article_corpus(files, {"title": "other"}, where=where)
    rows = run.numbered(picked)
    assert rows.filter(F.col("id") != F.col(scan.ORDINAL)).count() == 0 and rows.count() == len(kept)
    stored, manifest = run.ingest(picked, fresh_dir(spark, "picked"), 100)
    assert stored.count() == len(kept)
    assert stored.filter("id DIV 100 <> chunk_index").count() == 0
    records = {r["chunk_index"]: r["records"] for r in manifest.collect()}
    assert records == {k: 0 if k in (2, 3) else 50 for k in range(10)}


def test_counts_of_a_dense_source_are_those_of_its_rows(files):
    dense, scanned = corpus(files), corpus(files)
    scanned.__dict__["order"] = scan.FileOrder(dense.order.entries, 10, 1000, False)
    for cap in (None, 70):
        counts = [sorted(run.source_counts(c, 300, cap).select("chunk_index", "records", "last", "dataset_key").collect()) for c in (dense, scanned)]
        assert counts[0] == counts[1]


def test_part_numbers_of_six_digits(spark):
    names = ["s/part-100000-a.parquet", "s/part-99999-a.parquet", "s/part-00002-a.parquet", "s/x.parquet", "r/part-7.parquet"]
    rows = [(name, k) for k, name in enumerate(names) for k in range(3)]
    offsets = scan.file_offsets(spark.createDataFrame(rows, f"{scan.FILE} string, {scan.ROW} long"))
    order = [r[0] for r in offsets.orderBy("_first").select(scan.FILE).collect()]
    assert order == ["r/part-7.parquet", "s/x.parquet", "s/part-00002-a.parquet", "s/part-99999-a.parquet", "s/part-100000-a.parquet"]
    assert sorted(r[0] for r in offsets.select("_first").collect()) == [0, 3, 6, 9, 12]


def test_filtered_rows_keep_their_places(files):
    numbered = scan.scan_with_ordinal(files.filter("id % 10 <> 3"))
    ordinals = [r[0] for r in numbered.select(scan.ORDINAL).collect()]
    assert len(set(ordinals)) == 900


def test_order_by_key(spark):
    df = spark.range(500).select((F.lit(499) - F.col("id")).alias("k"))
    numbered = scan.order_by_key(df, "k", partitions=7)
    assert numbered.count() == 500
    assert numbered.filter(F.col("k") != F.col(scan.ORDINAL)).count() == 0


@pytest.mark.parametrize("start, size", [(0, 10), (95, 10), (350, 300), (990, 50), (1000, 5), (5000, 1)])
def test_range_slice(files, start, size):
    expected = list(range(1000))[start : start + size]
    assert sorted(r["id"] for r in scan.range_slice(files, start, size).collect()) == expected


def files_read(df):
    """Files opened by an executed scan of the texts."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = plan.collectLeaves()
    total = 0
    for i in range(found.length()):
        metrics = found.apply(i).metrics()
        if "id#" in found.apply(i).simpleString(100) and metrics.contains("numFiles"):
            total += metrics.apply("numFiles").value()
    return total


def test_range_slice_opens_overlapping_files_only(spark, files):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files_read(files.select("id")) == 10
        assert files_read(scan.range_slice(files, 250, 100)) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_plan_covers_the_corpus_once(spark):
    plan = C.chunk_plan(C.declared_total(spark, 1050), 100, "o/n", "c", "k")
    rows = [r.asDict() for r in plan.orderBy("chunk_index").collect()]
    assert len(rows) == 11
    assert [r["start_idx"] for r in rows] == list(range(0, 1050, 100))
    assert rows[-1]["end_idx"] == 1050 and rows[-1]["expected_size"] == 50
    assert sum(r["expected_size"] for r in rows) == 1050
    empty = C.chunk_plan(C.declared_total(spark, 0), 100, "o/n", "c", "k")
    assert empty.count() == 0


def test_declared_corpora_have_the_published_chunk_counts(spark):
    for mode, web, articles in (
        ("test", 38_000, 1_000), ("memory_optimized", 3_800, 200), ("conservative", 760, 100),
        ("balanced", 380, 40), ("aggressive", 190, 20),
    ):
        p = V.preset(mode)
        count = lambda rows, size: C.chunk_plan(C.declared_total(spark, rows), size, "d", "c", "k").count()
        assert count(V.WEB_TOTAL_ROWS, p["web_chunk_size"]) == web
        assert count(V.ARTICLE_TOTAL_ROWS, p["article_chunk_size"]) == articles
    assert V.preset("nonsense") == V.PRESETS["balanced"]


def corpus(frame):
    return run.article_corpus(frame, {"title": "other"})


def test_ingest_stores_every_row_once_and_reruns_cleanly(spark, files):
    base = fresh_dir(spark, "ingest")
    for _ in range(2):
        stored, manifest = run.ingest(corpus(files), base, 300)
    assert stored.count() == 1000 and stored.select("id").distinct().count() == 1000
    assert stored.groupBy("chunk_index").count().filter("count > 300").count() == 0
    rows = {r["chunk_index"]: r for r in manifest.collect()}
    assert [rows[i]["records"] for i in range(4)] == [300, 300, 300, 100]
    assert all(r["status"] == "success" for r in rows.values())
    assert spark.read.parquet(rows[1]["parquet_path"]).count() == 300
    meta = stored.select("_meta_chunk_index", "_meta_start_idx", "_meta_end_idx").distinct()
    assert sorted(tuple(r) for r in meta.collect())[1] == (1, 300, 600)


def test_limits_leave_skipped_and_pending_chunks(spark, files):
    base = fresh_dir(spark, "limited")
    stored, manifest = run.ingest(corpus(files), base, 300, max_chunks=2, cap=100)
    assert stored.count() == 200
    assert sorted(r["id"] for r in stored.select(F.col("id").cast("int")).collect()) == [
        *range(100), *range(300, 400),
    ]
    status = {r["chunk_index"]: r["status"] for r in manifest.collect()}
    assert status == {0: "success", 1: "success", 2: "skipped", 3: "skipped"}
    plan = C.chunk_plan(C.row_total(files), 300, V.ARTICLE_DATASET, V.ARTICLE_CONFIG, V.ARTICLE_KEY)
    pending = C.pending_chunks(plan, stored)
    assert sorted(r["chunk_index"] for r in pending.collect()) == [2, 3]


def test_resume_writes_only_missing_chunks(spark, files):
    base = fresh_dir(spark, "resume")
    run.store_chunks(corpus(files), base, 300, max_chunks=2)
    changed = corpus(files.withColumn("text", F.concat(F.lit("new "), "text")))
    stored = run.store_chunks(changed, base, 300, resume=True)
    got = stored.groupBy("chunk_index").agg(F.count_if(F.col("text").startswith("new")).alias("n"))
    assert {r["chunk_index"]: r["n"] for r in got.collect()} == {0: 0, 1: 0, 2: 300, 3: 100}
    assert stored.count() == 1000


def test_manifest_statuses(spark):
    plan = C.chunk_plan(C.declared_total(spark, 400), 100, "o/n", "c", "k")
    frame = lambda rows: spark.createDataFrame(rows, "dataset_key string, chunk_index long, records long")
    written = frame([("k", 0, 100), ("k", 1, 60)])
    source = frame([("k", 0, 100), ("k", 1, 100), ("k", 2, 0), ("k", 3, 100)])
    manifest = C.chunk_manifest(plan, written, source, max_chunks=3)
    assert {r["chunk_index"]: r["status"] for r in manifest.collect()} == {
        0: "success", 1: "write_failed", 2: "no_data", 3: "skipped",
    }


def test_run_summary(spark):
    rows = [
        ("a", 0, 10, "success", 10), ("a", 1, 10, "success", 5), ("a", 2, 10, "error", 0),
        ("a", 3, 10, "failed", 0), ("b", 0, 10, "no_data", 0), ("b", 1, 10, "skipped", 0),
    ]
    df = spark.createDataFrame(
        rows, "dataset_key string, chunk_index long, expected_size long, status string, records long"
    )
    got = {r["dataset_key"]: r for r in C.run_summary(df).collect()}
    assert got["a"]["average_efficiency"] == 0.75
    failed = C.failed_chunks(df.withColumn("error", F.lit(None).cast("string"))).collect()
    assert sorted((r["dataset_key"], r["chunk_index"]) for r in failed) == [("a", 2), ("a", 3)]
    assert (got["a"]["total_chunks"], got["a"]["successful"], got["a"]["failed"]) == (4, 2, 2)
    assert got["b"]["average_efficiency"] == 0.0 and got["b"]["total_records"] == 0
    assert (got["TOTAL"]["total_chunks"], got["TOTAL"]["skipped"], got["TOTAL"]["no_data"]) == (6, 1, 1)
    assert got["TOTAL"]["total_records"] == 15


def test_chunk_validation(spark):
    rows = [(0, "a"), (0, None), (0, None), (1, "a"), (1, None)]
    df = spark.createDataFrame(rows, "chunk_index long, text string")
    got = {r["chunk_index"]: r for r in C.validate_chunks(df, min_records=3).collect()}
    assert (got[0]["valid"], got[0]["warn_null_text"]) == (True, True)
    assert (got[1]["valid"], got[1]["warn_null_text"]) == (False, False)
    no_text = C.validate_chunks(df.drop("text")).collect()
    assert not any(r["valid"] for r in no_text)


def test_defaults_fill_missing_columns_only(spark, files):
    numbered = scan.scan_with_ordinal(files.select(F.lit(None).cast("string").alias("title"), "text"))
    filled = scan.field_defaults(numbered, scan.ARTICLE_DEFAULTS)
    row = filled.filter(F.col(scan.ORDINAL) == 7).first()
    assert row["id"] == "wp_7" and row["title"] is None and row["text"] == "text 7"


def test_fallback_row_only_for_an_empty_frame(spark, files):
    base = corpus(files)
    raw = run.align(files.select(F.col("id"), F.col("other").alias("title"), "text"), base.schema)
    assert run.load_or_fallback(raw, base, "2024-01-01 00:00:00").count() == 1000
    empty = run.load_or_fallback(raw.filter("id < 0"), base, "2024-01-01 00:00:00").collect()
    assert [r["id"] for r in empty] == [V.ARTICLE_FALLBACK["id"]]


def test_source_contract(files):
    contract = scan.source_contract(files, ["text", "url"])
    assert contract["missing"] == ["url"] and contract["sample"].count() == 3


def test_read_source_formats(spark, files, tmp_path):
    files.write.json(str(tmp_path / "j"))
    back = scan.read_source(spark, str(tmp_path / "j"), "json", files.schema)
    assert back.count() == 1000


def test_schema_drift_over_files(spark):
    """A column that one of many files has, and a type that is not the declared one."""
    path = fresh_dir(spark, "drift")
    spark.range(5).select("id", F.lit("t").alias("text")).coalesce(1).write.parquet(path)
    spark.range(7).select("id", F.lit("t").alias("text"), F.lit(1).alias("late")).coalesce(1).write.mode("append").parquet(path)
    source = spark.read.option("mergeSchema", "true").parquet(path)
    expected = spark.createDataFrame([], "id string, text string, url string").schema
    got = {r["column_name"]: tuple(r)[2:] for r in scan.schema_drift(source, "s", expected).collect()}
    assert got == {
        "id": ("string", "bigint", "type", 12, 2),
        "text": ("string", "string", None, 12, 2),
        "url": ("string", None, "missing", 12, 2),
        "late": (None, "int", "extra", 12, 2),
    }


def test_schema_drift_reads_no_column(spark, files, plan_of):
    plan = plan_of(scan.schema_drift(files, "s", files.schema))
    assert "ReadSchema: struct<>" in plan


def test_direct_load_takes_the_first_rows(spark, files):
    rows = run.direct_load(corpus(files), "2024-01-01 00:00:00", limit=120).collect()
    assert sorted(int(r["id"]) for r in rows) == list(range(120))
