import pytest
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.plans import checks, run
from corpusloom.sources import raw_views
from corpusloom.sources.workdir import fresh_dir, materialize, shared_dir
from verification import queries as Q

FOLDER = "/root/testdata/sf0.001"
RUN = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def sources(spark):
    web, articles = fresh_dir(spark, "web"), fresh_dir(spark, "articles")
    Q.raw_web(spark, FOLDER).select("text", "url").write.parquet(web)
    raw_views.raw_articles(Q.table(spark, FOLDER, "documents")).select("id", "title", "text").write.parquet(articles)
    return run.web_corpus(spark.read.parquet(web)), run.article_corpus(spark.read.parquet(articles))


def test_whole_run(spark, sources):
    base = fresh_dir(spark, "whole")
    for _ in range(2):  # a rerun replaces every table
        out = run.run_corpora(spark, *sources, base, RUN, "b", mode="test")
    manifest = {r["dataset_key"]: r for r in out["chunk_manifest"].collect()}
    assert manifest["fineweb"]["records"] == 300 and manifest["wikipedia"]["records"] == 200
    assert out["stg_web"].count() == Q.web(spark, FOLDER).count()
    assert out["stg_articles"].count() == Q.articles(spark, FOLDER).count()
    assert out["stg_web"].filter("content_timestamp IS NOT NULL").count() == 0
    bad = out["check_suite"].filter("status <> 'pass'").collect()
    assert [r["test_name"] for r in bad] == []
    assert out["dataset_quality_summary"].count() == 3
    # Marts from the fact tables equal marts from the staged texts.
    from corpusloom.plans import marts

    staged = marts.content_quality_metrics(out["stg_web"], out["stg_articles"], "b", RUN)
    assert staged.exceptAll(out["content_quality_metrics"]).count() == 0
    assert out["processing_summary"].first()["analysis_reliability"] == "full_real_analysis"
    assert {r["dataset_key"] for r in out["run_summary"].collect()} == {"fineweb", "wikipedia", "TOTAL"}


def test_empty_corpora_leave_fallback_rows(spark, sources):
    base = fresh_dir(spark, "empty")
    empty = [
        run.web_corpus(sources[0].frame.filter("false")),
        run.article_corpus(sources[1].frame.filter("false")),
    ]
    out = run.run_corpora(spark, *empty, base, RUN, mode="test")
    assert out["chunk_manifest"].count() == 0
    assert out["content_summary"].count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert V.preset("TEST") == V.PRESETS["test"]


def test_source_without_text_stores_nothing(spark, sources):
    frame = sources[0].frame.select("url")
    stored, manifest = run.ingest(run.web_corpus(frame), fresh_dir(spark, "no-text"), 100)
    assert stored.count() == 0
    assert {r["status"] for r in manifest.collect()} == {"no_data"}


def test_direct_load_limits_and_fills(spark, sources):
    corpus = run.article_corpus(sources[1].frame.select("text"))
    loaded = run.direct_load(corpus, RUN, limit=5)
    assert sorted(r["id"] for r in loaded.collect()) == [f"wp_{i}" for i in range(5)]


def test_resume_completes_capped_chunks(spark, sources):
    base = fresh_dir(spark, "resume")
    corpus = sources[1]
    _, capped = run.ingest(corpus, base, 50, cap=30)
    assert {r["status"] for r in capped.collect()} == {"success"} and capped.agg({"records": "sum"}).first()[0] == 120
    for _ in range(2):
        stored, manifest = run.ingest(corpus, base, 50, resume=True)
        rows = run.load_raw(stored, manifest, corpus.schema, RUN)
        assert rows.count() == 200 and rows.select("id").distinct().count() == 200
    # Another chunk size makes other chunks, and none of the old ones is taken for one.
    stored, manifest = run.ingest(corpus, base, 80, resume=True)
    assert sorted((r["start_idx"], r["end_idx"], r["records"]) for r in manifest.collect()) == [
        (0, 80, 80), (80, 160, 80), (160, 200, 40),
    ]
    assert run.load_raw(stored, manifest, corpus.schema, RUN).count() == 200
    ends = stored.filter("chunk_index = 2").select("_meta_end_idx").distinct().collect()
    assert [r[0] for r in ends] == [200]
    path = manifest.filter("chunk_index = 2").first()["parquet_path"]
    assert spark.read.parquet(path).count() == 40


def test_filtered_source_keeps_all_rows(spark):
    docs = Q.table(spark, FOLDER, "documents").filter("doc_id >= 100")
    corpus = run.article_corpus(docs, {"id": "doc_id", "title": "source"})
    stored, manifest = run.ingest(corpus, fresh_dir(spark, "filtered"), 50)
    assert run.load_raw(stored, manifest, corpus.schema, RUN).count() == 100
    assert sorted(r["status"] for r in manifest.collect()) == ["no_data", "no_data", "success", "success"]


def test_failed_chunks_stop_a_run(spark, sources, monkeypatch):
    """A run whose chunks lost rows stops; it does not go on to a fallback row."""
    whole = run.source_counts

    def more(corpus, size, cap=None):
        return whole(corpus, size, cap).withColumn("records", F.col("records") + 1)

    monkeypatch.setattr(run, "source_counts", more)
    with pytest.raises(RuntimeError, match="stored 300 of 301 records"):
        run.run_corpora(spark, sources[0], sources[1], fresh_dir(spark, "broken"), RUN, mode="test")


def test_chunks_need_enough_records_and_warn_of_null_texts(spark):
    docs = Q.table(spark, FOLDER, "documents")
    path = fresh_dir(spark, "nulls")
    docs.select("doc_id", F.when(F.col("doc_id") < 20, F.col("text")).alias("text")).coalesce(1).write.parquet(path)
    corpus = run.article_corpus(spark.read.parquet(path), {"id": "doc_id"})
    _, manifest = run.ingest(corpus, fresh_dir(spark, "few"), 150, min_records=100)
    first, last = manifest.orderBy("chunk_index").collect()
    assert (first["status"], first["warn_null_text"]) == ("success", True)
    assert (last["status"], last["error"]) == ("failed", "fewer than 100 records")


def test_contracts_of_marts_are_checked(spark):
    rows = [(None, 10.0), (5, 200_000.0), (5, 50.0)]
    contents = spark.createDataFrame(rows, "total_records long, avg_content_length double")
    metrics = spark.createDataFrame([("web", "no such tier"), (None, None)], "source string, quality_tier string")
    marts = {"content_summary": contents, "content_quality_metrics": metrics}
    found = checks.failures(checks.graded(checks.union_checks(*checks.mart_checks(marts)))).collect()
    failing = {(r.test_name, r.failing_records) for r in found}
    for model in marts:
        assert any(model in name for name, _ in failing)
    assert len(found) == 5


def test_observed_suite_equals_the_plain_one(spark):
    """Facts with broken rows: counts taken during the write are those of a later read."""
    staged_web, staged_articles = Q.both(spark, FOLDER, (Q.CHUNK,))
    web, articles = run.web_facts(staged_web), run.article_facts(staged_articles)
    web = web.withColumns(
        {
            "quality_score": F.when(F.col("content_length") % 3 == 0, 120).otherwise(F.col("quality_score")),
            "source_dataset": F.when(F.col("content_length") % 5 != 0, F.col("source_dataset")),
            "is_too_short": F.when(F.col("content_length") % 7 == 0, 1).otherwise(0),
        }
    )
    articles = articles.withColumn("article_id", F.when(F.col("text_length") % 2 == 0, F.lit("7")).otherwise(F.col("article_id")))
    facts = checks.watched_facts(web, articles, RUN)
    stored = [materialize(facts.web, "w"), materialize(facts.articles, "a")]
    records = run.facts_as_records(*stored)
    summary = materialize(Q.marts.dataset_quality_summary(records, RUN, stored=True), "s")
    summary = summary.withColumn("total_records", F.col("total_records") + 1)
    plain = checks.suite(*stored, records, summary, RUN)
    seen = checks.observed_suite(facts, stored[1], summary)
    pick = lambda df: {(r.test_name, r.failing_records, r.severity, r.status) for r in df.collect()}
    assert pick(plain) == pick(seen)
    failing = {r.test_name for r in checks.failures(seen).collect()}
    assert {"quality_checks_structure", "foreign_key_integrity", "aggregation_consistency", "primary_key_uniqueness"} <= failing
    assert "unique_stg_articles_article_id" in failing and "text_length_validation" in failing
