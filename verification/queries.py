"""Every operator as a query over the test tables: name -> (spark, folder) -> frame."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import values as V
from corpusloom.functions import numeric as N
from corpusloom.functions import text as X
from corpusloom.operators import aggregates as A
from corpusloom.operators import chunks as C
from corpusloom.operators import dedup, sketches
from corpusloom.operators.dedup import dedup_latest
from corpusloom.plans import checks as K
from corpusloom.plans import marts, quality, run, staging
from corpusloom.sources import fields as S
from corpusloom.sources import raw_views, scan, tables
from corpusloom.sources.workdir import fresh_dir, materialize
from corpusloom.streaming import jobs

BATCH = "batch-1"
RUN_TS = "2024-01-08 00:08:20"
SIZE = raw_views.CHUNK_ROWS
CAP = 200
MAX_CHUNKS = 2
CHUNK = "_meta_chunk_index"

REGISTRY = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


# ---- inputs ---------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_web(spark, folder):
    return raw_views.raw_web(table(spark, folder, "documents"), table(spark, folder, "pages"))


def raw_articles(spark, folder):
    return raw_views.raw_articles(table(spark, folder, "documents"))


def web(spark, folder, keep=()):
    return staging.stg_web(raw_web(spark, folder), BATCH, RUN_TS, tie=["_row_key"], keep=keep)


def articles(spark, folder, keep=()):
    return staging.stg_articles(raw_articles(spark, folder), BATCH, RUN_TS, keep=keep)


def both(spark, folder, keep=()):
    return web(spark, folder, keep), articles(spark, folder, keep)


def measured(spark, folder):
    """Measured rows without text, with the chunk number."""
    return quality.measured_rows(*both(spark, folder, (CHUNK,))).drop("text")


def unfiltered(spark, folder):
    """Cleaned rows of both corpora before any validity or script filter."""
    return (
        staging.clean_web(raw_web(spark, folder)),
        staging.clean_articles(raw_articles(spark, folder)),
    )


def document_corpus(spark, folder):
    return run.article_corpus(
        table(spark, folder, "documents"), {"id": "doc_id", "title": "source"}
    )


def page_corpus(spark, folder):
    return run.web_corpus(table(spark, folder, "pages"), {"text": "html"})


def document_plan(spark, folder, total=None):
    total = total or C.row_total(table(spark, folder, "documents"))
    return C.chunk_plan(total, SIZE, V.ARTICLE_DATASET, V.ARTICLE_CONFIG, V.ARTICLE_KEY)


# ---- scans, chunks, tables ------------------------------------------------


@query
def scan_project(spark, folder):
    return scan.project_fields(
        table(spark, folder, "documents"), {"id": "doc_id", "title": "source"}
    )


@query
def range_slice(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return scan.range_slice(docs, start=50, size=100).withColumnRenamed(scan.ORDINAL, "ordinal")


@query
def chunk_plan(spark, folder):
    return document_plan(spark, folder)


@query
def chunk_limit(spark, folder):
    rows = C.assign_chunks(scan.scan_with_ordinal(table(spark, folder, "documents")), SIZE)
    return C.limit_chunks(rows, MAX_CHUNKS).select("doc_id", "chunk_index", "text")


@query
def chunk_row_cap(spark, folder):
    rows = C.assign_chunks(scan.scan_with_ordinal(table(spark, folder, "documents")), SIZE)
    return C.cap_rows(rows, CAP).select("doc_id", "chunk_index", "start_idx", "n_chars")


@query
def chunk_validate(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.when(F.col("lang") != "en", F.col("text")).alias("text")
    )
    rows = C.assign_chunks(scan.scan_with_ordinal(docs), SIZE)
    return C.validate_chunks(rows)


@query
def stamp_metadata(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = C.assign_chunks(scan.scan_with_ordinal(docs), SIZE)
    total = docs.count()
    return C.stamp_metadata(rows, V.ARTICLE_DATASET, V.ARTICLE_CONFIG, SIZE, total).drop(
        "chunk_index", "start_idx", scan.ORDINAL
    )


@query
def chunk_key(spark, folder):
    return C.with_chunk_path(document_plan(spark, folder)).select("chunk_index", "parquet_path")


@query
def pending_chunks(spark, folder):
    """Every third chunk is missing from the stored ones."""
    base = fresh_dir(spark, "pending")
    corpus = document_corpus(spark, folder)
    stored = run.store_chunks(corpus, base, SIZE).filter("chunk_index % 3 <> 0")
    return C.pending_chunks(document_plan(spark, folder), stored).select(
        "dataset_key", "chunk_index", "start_idx", "end_idx", "expected_size"
    )


@query
def table_write_roundtrip(spark, folder):
    path = fresh_dir(spark, "roundtrip")
    orders = table(spark, folder, "orders")
    # The second write replaces the partitions of the first.
    for _ in range(2):
        tables.write_table(orders, path, "overwrite", ["o_orderstatus"], run_ts=RUN_TS)
    schema = orders.withColumn("_processing_timestamp", F.lit(RUN_TS).cast("timestamp_ntz")).schema
    return tables.read_table(spark, path, schema)


@query
def upsert(spark, folder):
    """A small table grows more than ten-fold, then gets updates and further rows at once;
    its buckets split as they fill."""
    path = fresh_dir(spark, "upsert")
    orders = table(spark, folder, "orders")
    changed = orders.filter("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("REVISED"))
    added = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    for updates in (orders.filter("o_orderstatus = 'P'"), orders, changed.union(added)):
        tables.upsert(updates, path, ["o_orderkey"], rows_per_bucket=10_000)
    return tables.read_table(spark, path).select(*orders.columns)


@query
def chunk_replace(spark, folder):
    path = fresh_dir(spark, "replace")
    orders = table(spark, folder, "orders").withColumn("chunk", F.col("o_orderpriority"))
    tables.replace_chunks(orders, path, ["chunk"], balance=True)
    again = orders.filter("chunk = '1-URGENT'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    tables.replace_chunks(again, path, ["chunk"], balance=True)
    return tables.read_table(spark, path, orders.schema)


@query
def chunk_manifest(spark, folder):
    """Chunks of the documents for an announced size that is larger than the
    table: full, last, empty and skipped chunks all occur."""
    base = fresh_dir(spark, "manifest")
    corpus = document_corpus(spark, folder)
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    stored = run.store_chunks(corpus, base, SIZE)
    announced = C.row_total(docs.select("text").union(docs.select("text")).union(pages.select("html")))
    plan = document_plan(spark, folder, announced)
    return C.chunk_manifest(plan, C.stored_counts(stored))


def _manifests(spark, folder):
    """All chunks of both corpora, where every fifth document chunk lost its first row
    and every seventh was left out."""
    base = fresh_dir(spark, "run")
    docs = document_corpus(spark, folder)
    counts = run.source_counts(docs, SIZE)
    stored = run.store_chunks(docs, base, SIZE, counts=counts)
    hurt = (F.col("chunk_index") % 5 == 1) & (F.col("_meta_row_index") == F.col("_meta_start_idx"))
    gone = F.col("chunk_index") % 7 == 3
    written = C.stored_counts(stored.filter(~hurt & ~gone))
    plan = document_plan(spark, folder)
    manifest = C.chunk_manifest(plan, written, counts.filter(~gone))
    _, pages = run.ingest(page_corpus(spark, folder), base, SIZE)
    return manifest.unionByName(pages)


@query
def run_summary(spark, folder):
    summary = C.run_summary(_manifests(spark, folder))
    return summary.withColumn("average_efficiency", N.round_to("average_efficiency", 6))


@query
def failed_chunks(spark, folder):
    return C.failed_chunks(_manifests(spark, folder))


@query
def chunk_resume(spark, folder):
    """A run that stored too few rows per chunk is completed by a second one."""
    base = fresh_dir(spark, "resume")
    corpus = document_corpus(spark, folder)
    run.ingest(corpus, base, SIZE, cap=CAP)
    stored, manifest = run.ingest(corpus, base, SIZE, resume=True)
    return run.load_raw(stored, manifest, S.RAW_ARTICLES, RUN_TS)


@query
def filtered_ingest(spark, folder):
    """Documents of one language; rows keep their places, so chunks have gaps."""
    base = fresh_dir(spark, "filtered")
    docs = table(spark, folder, "documents")
    corpus = run.article_corpus(docs, {"id": "doc_id", "title": "source"}, where="lang = 'de'")
    stored, manifest = run.ingest(corpus, base, SIZE)
    return run.load_raw(stored, manifest, S.RAW_ARTICLES, RUN_TS, [run.CHUNK_FIELD])


@query
def load_raw(spark, folder):
    base = fresh_dir(spark, "load")
    corpus = document_corpus(spark, folder)
    stored, manifest = run.ingest(corpus, base, SIZE)
    return run.load_raw(stored, manifest, S.RAW_ARTICLES, RUN_TS)


@query
def fallback_row(spark, folder):
    """A filled corpus stays as it is; an empty one becomes its fallback row."""
    corpus = document_corpus(spark, folder)
    raw = run.align(scan.project_fields(corpus.frame, corpus.mapping), S.RAW_ARTICLES)
    filled = run.load_or_fallback(raw, corpus, RUN_TS)
    empty = run.load_or_fallback(raw.filter("text IS NULL"), corpus, RUN_TS)
    return filled.unionByName(empty)


@query
def field_defaults(spark, folder):
    """Direct loads: pages lack title and text, documents lack url."""
    pages = run.article_corpus(table(spark, folder, "pages"), {"id": "page_id"})
    docs = run.web_corpus(table(spark, folder, "documents"))
    return run.direct_load(pages, RUN_TS).unionByName(
        run.direct_load(docs, RUN_TS), allowMissingColumns=True
    )


@query
def direct_load_limited(spark, folder):
    """The first records of two sources, without chunk files."""
    docs = run.direct_load(document_corpus(spark, folder), RUN_TS, limit=150)
    pages = run.direct_load(page_corpus(spark, folder), RUN_TS, limit=75)
    return docs.unionByName(pages, allowMissingColumns=True)


@query
def catalog_tables(spark, folder):
    """A table is created, replaced and read by name; the same rows are read back from
    files of other formats by the same switch; another table is dropped."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name = f"orders_{uuid.uuid4().hex}"
    tables.save_table(orders.withColumn("o_totalprice", F.lit(0.0)), name, fresh_dir(spark, "created"))
    tables.save_table(orders, name, fresh_dir(spark, "replaced"))
    tables.save_table(orders, f"{name}_old", fresh_dir(spark, "dropped"))
    tables.drop_table(spark, f"{name}_old")
    read = {"table": scan.read_source(spark, name, "table")}
    for fmt in ("parquet", "orc", "json"):
        path = fresh_dir(spark, fmt)
        orders.write.format(fmt).save(path)
        read[fmt] = scan.read_source(spark, path, fmt, orders.schema)
    left = spark.catalog.tableExists(f"{name}_old")
    parts = [rows.select(F.lit(fmt).alias("format"), "*", F.lit(left).alias("old_exists")) for fmt, rows in read.items()]
    return reduce(DataFrame.union, parts)


@query
def source_contract(spark, folder):
    """Columns and types of every given source against what the corpora need."""
    wanted = {
        "documents": "doc_id long, text string, lang string, source string, n_chars int, url string",
        "pages": "page_id long, url string, html string, fetched timestamp",
        "conversations": "conv_id string, turn long, role string, text string",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double",
    }
    found = []
    for name, schema in wanted.items():
        source = spark.read.option("mergeSchema", "true").parquet(f"{folder}/{name}.parquet")
        found.append(scan.schema_drift(source, name, T.StructType.fromDDL(schema)))
    return reduce(DataFrame.union, found).drop("files")


@query
def example_models(spark, folder):
    """Ids of the documents plus one literal NULL id, tested for not_null and
    unique before and after dropping the NULL."""
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    first = ids.union(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))
    second = first.filter("id IS NOT NULL")
    checks = []
    for name, model in (("first_model", first), ("second_model", second)):
        checks.append(K.run_rules(model, K.not_null_rules(name, ["id"])))
        checks.append(K.unique(model, name, "id"))
    return K.union_checks(*checks)


@query
def preview(spark, folder):
    return scan.latest_preview(table(spark, folder, "documents"), "doc_id")


@query
def union_by_name(spark, folder):
    docs = scan.project_fields(
        table(spark, folder, "documents"), {"id": "doc_id", "title": "source"}
    )
    pages = scan.project_fields(table(spark, folder, "pages"), {"id": "page_id", "text": "html"})
    return docs.unionByName(pages, allowMissingColumns=True)


@query
def union_positional(spark, folder):
    """The second branch's columns land in the first one's by position."""
    first = raw_web(spark, folder).groupBy("url").agg(
        F.count(F.lit(1)).alias("records"), F.max("_row_key").alias("last_key")
    )
    second = raw_articles(spark, folder).groupBy("title").agg(
        F.count(F.lit(1)).alias("articles"), F.max(F.col("id").cast("long")).alias("last_id")
    )
    return first.union(second)


# ---- projections, filters, functions --------------------------------------


@query
def filter_not_null(spark, folder):
    return (
        raw_articles(spark, folder)
        .filter(F.col("id").isNotNull() & F.col("title").isNotNull() & F.col("text").isNotNull())
        .select("id", "title")
    )


@query
def length_category(spark, folder):
    rows = staging.clean_web(raw_web(spark, folder), keep=["_row_key"])
    return rows.select("_row_key", "content_length", "content_length_category")


@query
def article_size(spark, folder):
    return unfiltered(spark, folder)[1].select("article_id", "text_length", "article_size_category")


@query
def article_type(spark, folder):
    return unfiltered(spark, folder)[1].select("article_id", "article_title", "article_type")


@query
def valid_content(spark, folder):
    rows = staging.clean_web(raw_web(spark, folder), keep=["_row_key"])
    return rows.select("_row_key", "content_length", "is_valid_content")


@query
def valid_article(spark, folder):
    return unfiltered(spark, folder)[1].select("article_id", "text_length", "is_valid_article")


@query
def text_functions(spark, folder):
    text, url = F.col("text"), F.col("url")
    return raw_web(spark, folder).select(
        X.trim_spaces("text").alias("trimmed"),
        X.length_of("text").alias("n_chars"),
        F.coalesce(url, F.lit("unknown")).alias("source_url"),
        X.has_script("text").alias("narrow_script"),
        X.has_script("text", "full").alias("full_script"),
        X.has_script("text", "äöüß").alias("umlauts"),
        X.url_domain("url").alias("url_domain"),
        url.like("https:%").alias("is_https"),
        F.col("_row_key").cast("string").alias("row_key"),
        X.first_paragraph("text", "\n").alias("first_line"),
        X.section_count("text", "##").alias("hash_marks"),
        F.left(text, F.lit(50)).alias("start_50"),
        X.upper(X.trim_spaces("text")).alias("upper_text"),
        X.preview("text").alias("preview"),
        X.last_segment("_meta_dataset_name").alias("dataset_short"),
        X.chunk_path(
            F.col("_meta_dataset_name"),
            F.lit(None).cast("string"),
            F.col(CHUNK),
            F.col(CHUNK) * SIZE,
            (F.col(CHUNK) + 1) * SIZE,
        ).alias("path"),
    )


@query
def rounding(spark, folder):
    lines = table(spark, folder, "lineitem")
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        N.round_to(price / 7, 2).alias("price_2"),
        N.round_to(price * F.col("l_discount"), 3).alias("discount_3"),
        N.round_to(price, 0).alias("price_0"),
        F.least(F.lit(100.0), N.round_to(price / 500, 2)).alias("capped"),
        N.percent(qty, F.col("l_linenumber") - 1).alias("share"),
        N.chunks_of(qty, 7).alias("chunks"),
    )


# ---- joins, aggregates, windows -------------------------------------------


@query
def global_summary(spark, folder):
    rows, _ = unfiltered(spark, folder)
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("content_length").alias("total_characters"),
        N.round_to(F.avg("content_length"), 2).alias("avg_length"),
        F.min("content_length").alias("min_length"),
        F.max("content_length").alias("max_length"),
        F.min("dbt_extracted_timestamp").alias("earliest_extraction"),
        F.max("dbt_extracted_timestamp").alias("latest_extraction"),
    )


@query
def group_summary(spark, folder):
    rows, _ = unfiltered(spark, folder)
    return rows.groupBy("url_domain", "source_dataset").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum("content_length").alias("total_characters"),
        N.round_to(F.avg("content_length"), 2).alias("avg_length"),
        F.max("content_length").alias("max_length"),
    )


@query
def conditional_counts(spark, folder):
    rows, _ = unfiltered(spark, folder)
    category = F.col("content_length_category")
    return rows.groupBy("source_url").agg(
        *[N.count_where(category == c).alias(f"{c}_count") for c in V.LENGTH_CATEGORIES],
        N.count_where("contains_japanese_chars").alias("script_count"),
        F.sum(F.when(F.col("is_valid_content"), 0).otherwise(1)).alias("invalid_count"),
    )


@query
def distinct_counts(spark, folder):
    rows, _ = unfiltered(spark, folder)
    return A.distinct_per_group(rows, "url_domain", "source_url", "content_length_category")


@query
def content_diversity(spark, folder):
    rows, _ = unfiltered(spark, folder)
    return rows.groupBy("source_url").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count_distinct(F.left("content_text", F.lit(50))).alias("unique_starts"),
    )


@query
def exact_median(spark, folder):
    rows = quality.measured_rows(*unfiltered(spark, folder)).select(
        F.col("_meta_dataset_name").alias("dataset_name"), "text_length", "japanese_ratio"
    )
    names = ("median_text_length", "median_japanese_ratio")
    stored = materialize(rows, "measures")
    medians = A.exact_medians(stored, ["dataset_name"], marts.median_measures(*names))
    return medians.withColumn(
        "median_japanese_ratio", N.round_to("median_japanese_ratio", 6)
    )


@query
def rollup_total(spark, folder):
    level = (
        table(spark, folder, "documents")
        .groupBy("lang")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("n_chars").alias("characters"),
            F.min("n_chars").alias("shortest"),
            F.max("n_chars").alias("longest"),
            F.max("source").alias("last_source"),
        )
    )
    rolled = marts.with_total(
        level, "lang", ["records", "characters"], ["shortest"], ["longest"], ["last_source"]
    )
    return rolled.withColumn("avg_chars", N.round_to(N.ratio("characters", "records"), 2))


@query
def chunk_sketches(spark, folder):
    """Different texts and median lengths per dataset from sketches stored per chunk, held
    against exact figures: estimates must be within four standard errors, and within the
    stated rank error, of them."""
    rows = quality.measured_rows(*both(spark, folder, (CHUNK,)))
    rows = rows.select("_meta_dataset_name", CHUNK, X.digest("text").alias("text_digest"), "text_length", "japanese_ratio")
    rows = materialize(rows.withColumnRenamed("_meta_dataset_name", "dataset_name"), "measures")
    stored = materialize(
        sketches.chunk_sketches(rows, ["dataset_name", CHUNK], ["text_digest"], ["text_length", "japanese_ratio"]), "sketches"
    )
    merged = sketches.merged_sketches(stored, ["dataset_name"]).select(
        "dataset_name", "records", "chunks",
        sketches.distinct_estimate("text_digest").alias("texts"),
        *[sketches.quantile_estimate(c).alias(c) for c in ("text_length", "japanese_ratio")],
    )
    # The estimates are one row for each dataset.
    held = rows.join(materialize(merged, "estimates").withColumnsRenamed({"text_length": "length_at", "japanese_ratio": "ratio_at"}), "dataset_name")
    off = lambda c, at: F.greatest(
        F.lit(0.5) - F.count_if(F.col(c) <= F.col(at)) / F.count(c), F.count_if(F.col(c) < F.col(at)) / F.count(c) - F.lit(0.5)
    )
    exact = F.count_distinct("text_digest")
    return held.groupBy("dataset_name", "records", "chunks", "texts").agg(
        exact.alias("distinct_texts"),
        off("text_length", "length_at").alias("length_off"),
        off("japanese_ratio", "ratio_at").alias("ratio_off"),
    ).select(
        "dataset_name", "records", "chunks", "distinct_texts",
        (F.abs(F.col("texts") - F.col("distinct_texts")) <= 4 * sketches.DISTINCT_ERROR * F.col("distinct_texts")).alias("distinct_ok"),
        ((F.col("length_off") <= sketches.RANK_ERROR) & (F.col("ratio_off") <= sketches.RANK_ERROR)).alias("medians_ok"),
    )


@query
def rollup_total_median(spark, folder):
    """The full summary with true medians in its TOTAL row, and exact medians of document
    lengths per language and over all languages."""
    summary = marts.dataset_quality_summary(measured(spark, folder), RUN_TS, total_medians=True)
    docs = table(spark, folder, "documents").select("lang", F.col("n_chars").alias("text_length"))
    lengths = A.exact_medians(docs, ["lang"], marts.median_measures("median_text_length"), marts.TOTAL)
    none = F.lit(None).cast("double")
    lengths = lengths.select(
        F.concat(F.lit("lang "), "lang").alias("dataset_name"), "median_text_length",
        none.alias("median_japanese_ratio"), none.alias("median_quality_score"),
    )
    return summary.select(*lengths.columns).union(lengths)


@query
def dedup_latest_rows(spark, folder):
    rows = dedup_latest(
        raw_web(spark, folder),
        "text",
        "url",
        [F.col("_dbt_extracted_at").desc(), F.col("_row_key").desc()],
    )
    return rows.select("text", "url", "_dbt_extracted_at", "_row_key")


REGISTRY["dedup_latest"] = REGISTRY.pop("dedup_latest_rows")


@query
def dedup_latest_by_row(spark, folder):
    """The same rows, where texts are fetched by the winners' row numbers."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    visits = [
        raw_views.web_from_documents(docs), raw_views.web_from_pages(pages), raw_views.web_from_pages(pages, hours=1)
    ]
    numbered = [rows.withColumn("_row", F.col("_row_key") * len(visits) + k) for k, rows in enumerate(visits)]
    rows = dedup.dedup_latest_by_row(
        numbered[0].union(numbered[1]).union(numbered[2]),
        "text",
        "url",
        [F.col("_dbt_extracted_at").desc(), F.col("_row_key").desc()],
        "_row",
    )
    return rows.select("text", "url", "_dbt_extracted_at", "_row_key")


# ---- models and marts -----------------------------------------------------


@query
def stg_web(spark, folder):
    return web(spark, folder)


@query
def stg_articles(spark, folder):
    return articles(spark, folder)


@query
def quality_checks(spark, folder):
    return quality.quality_checks(*both(spark, folder))


@query
def quality_checks_unfiltered(spark, folder):
    return quality.quality_checks(*unfiltered(spark, folder))


def _rounded_ratios(df):
    names = ("japanese_ratio", "ascii_ratio", "whitespace_ratio", "symbol_ratio")
    return df.withColumns({c: N.round_to(c, 6) for c in names})


@query
def quality_checks_full(spark, folder):
    return _rounded_ratios(quality.quality_checks_full(*both(spark, folder)))


@query
def dataset_quality_summary(spark, folder):
    return marts.dataset_quality_summary(quality.quality_checks(*both(spark, folder)), RUN_TS)


@query
def dataset_quality_summary_full(spark, folder):
    return marts.dataset_quality_summary(measured(spark, folder), RUN_TS)


@query
def content_quality_metrics(spark, folder):
    return marts.content_quality_metrics(*both(spark, folder), BATCH, RUN_TS)


@query
def content_summary(spark, folder):
    return marts.content_summary(*both(spark, folder), BATCH, RUN_TS)


@query
def anomaly_report(spark, folder):
    return quality.anomaly_report(quality.quality_checks(*unfiltered(spark, folder)))


@query
def quality_report(spark, folder):
    return quality.quality_report(anomaly_report(spark, folder))


@query
def processing_summary(spark, folder):
    return marts.processing_summary(anomaly_report(spark, folder), BATCH, RUN_TS)


# ---- data tests -----------------------------------------------------------


@query
def check_not_null(spark, folder):
    w, a = both(spark, folder)
    return K.union_checks(
        K.run_rules(raw_web(spark, folder), K.not_null_rules("raw_web", ["text", "url"])),
        K.run_rules(
            raw_articles(spark, folder),
            K.not_null_rules("raw_articles", S.NOT_NULL["raw_articles"]),
        ),
        K.run_rules(w, K.not_null_rules("stg_web", S.NOT_NULL["stg_web"])),
        K.run_rules(a, K.not_null_rules("stg_articles", S.NOT_NULL["stg_articles"])),
    )


@query
def check_unique(spark, folder):
    return K.union_checks(
        K.unique(raw_articles(spark, folder), "raw_articles", "id"),
        K.unique(raw_articles(spark, folder), "raw_articles", "title"),
        K.unique(raw_web(spark, folder), "raw_web", "url"),
    )


@query
def check_accepted_values(spark, folder):
    w, a = unfiltered(spark, folder)
    q = quality.quality_checks(w, a)
    return K.union_checks(
        K.run_rules(w, K.accepted_rules("stg_web", S.ACCEPTED["stg_web"])),
        K.run_rules(
            a,
            K.accepted_rules("stg_articles", S.ACCEPTED["stg_articles"])
            + K.accepted_rules("plain_articles", {"article_type": ("article",)}),
        ),
        K.run_rules(q, K.accepted_rules("quality_checks", S.ACCEPTED["quality_checks"])),
    )


@query
def check_accepted_range(spark, folder):
    w, a = unfiltered(spark, folder)
    q = quality.quality_checks(w, a)
    web_ranges = {"content_length": S.RANGES["stg_web"]["content_length"]}
    return K.union_checks(
        K.run_rules(w, K.range_rules("stg_web", web_ranges)),
        K.run_rules(
            a,
            K.range_rules("stg_articles", S.RANGES["stg_articles"])
            + [K.not_empty_rule("stg_articles", "article_title")],
        ),
        K.run_rules(q, K.range_rules("quality_checks", S.RANGES["quality_checks"])),
    )


def measured_unfiltered(spark, folder):
    return quality.measured_rows(*unfiltered(spark, folder)).drop("text")


@query
def check_high_quality_ratio(spark, folder):
    """On the full model, and on the simple one with the ratio bound at 0.85,
    where web rows fail."""
    simple = quality.quality_checks(*unfiltered(spark, folder))
    return K.union_checks(
        K.run_rules(measured_unfiltered(spark, folder), [K.high_quality_ratio()]),
        K.run_rules(simple, [K.high_quality_ratio(0.85)]),
    )


@query
def check_content_type(spark, folder):
    return K.run_rules(measured_unfiltered(spark, folder), [K.content_type_rule()])


def _stored_measures(spark, folder, *columns):
    """Measures as a written table: the rule then reads stored flags instead of
    being folded into their definition."""
    return materialize(measured_unfiltered(spark, folder).select(*columns), "measures")


@query
def check_encoding(spark, folder):
    rows = _stored_measures(spark, folder, "has_encoding_issues", "has_replacement_char")
    return K.run_rules(rows, [K.encoding_rule()])


@query
def check_score_band(spark, folder):
    return K.run_rules(measured_unfiltered(spark, folder), [K.score_band_rule()])


@query
def check_length_flags(spark, folder):
    return K.run_rules(measured_unfiltered(spark, folder), [K.length_flags_rule()])


@query
def check_char_count(spark, folder):
    return K.run_rules(measured_unfiltered(spark, folder), [K.char_count_rule()])


@query
def check_ratios(spark, folder):
    return K.run_rules(measured_unfiltered(spark, folder), [K.ratios_rule()])


@query
def check_anomaly_flag(spark, folder):
    rows = _stored_measures(
        spark,
        folder,
        "is_anomaly",
        "is_too_short",
        "is_too_long",
        "has_encoding_issues",
        "content_type",
        "japanese_ratio",
        "has_repetition",
    )
    return K.run_rules(rows, [K.anomaly_flag_rule()])


@query
def check_summary(spark, folder):
    return K.run_rules(
        marts.dataset_quality_summary(measured(spark, folder), RUN_TS), [K.summary_rule()]
    )


@query
def check_completeness(spark, folder):
    summary = marts.dataset_quality_summary(measured(spark, folder), RUN_TS)
    return K.completeness(summary, [V.WEB_DATASET, V.ARTICLE_DATASET])


@query
def check_freshness(spark, folder):
    w, a = both(spark, folder)
    return K.union_checks(
        K.run_rules(w, [K.freshness_rule(V.WEB_KEY, "FineWeb", RUN_TS)]),
        K.run_rules(a, [K.freshness_rule(V.ARTICLE_KEY, "Wikipedia", RUN_TS)]),
    )


@query
def check_source_ref(spark, folder):
    return K.run_rules(web(spark, folder), [K.source_rule()])


@query
def check_pk_unique(spark, folder):
    return K.primary_key(articles(spark, folder))


@query
def check_required_columns(spark, folder):
    return K.required_columns(web(spark, folder))


@query
def check_type_consistency(spark, folder):
    return K.type_consistency(*both(spark, folder))


@query
def check_total_consistency(spark, folder):
    records = measured(spark, folder)
    # Written once, with what the summary looks at; nothing else is measured.
    rows = materialize(records.select(*marts.summary_columns(records)), "measures")
    return K.total_consistency(rows, marts.dataset_quality_summary(rows, RUN_TS, stored=True))


@query
def check_suite(spark, folder):
    """All tests, counted while staging facts are written, and the contracts of marts."""
    staged_web, staged_articles = both(spark, folder, (CHUNK,))
    facts = K.watched_facts(run.web_facts(staged_web), run.article_facts(staged_articles), RUN_TS)
    web_rows, article_rows = materialize(facts.web, "web-facts"), materialize(facts.articles, "article-facts")
    rows = run.facts_as_records(web_rows, article_rows)
    summary = materialize(marts.dataset_quality_summary(rows, RUN_TS, stored=True), "summary")
    checked = {
        "content_summary": marts.content_summary(web_rows, article_rows, BATCH, RUN_TS),
        "content_quality_metrics": marts.content_quality_metrics(web_rows, article_rows, BATCH, RUN_TS),
    }
    return K.observed_suite(facts, article_rows, summary, checked)


@query
def check_broken_records(spark, folder):
    """Every record rule over measured rows in which values are falsified by rule."""
    n = F.col("text_length")
    every = lambda k, value, column: F.when(n % k == 0, value).otherwise(F.col(column)).alias(column)
    falsified = {
        "quality_class": every(3, "high", "quality_class"),
        "content_type": every(5, "content", "content_type"),
        "is_nav_word": every(7, True, "is_nav_word"),
        "has_replacement_char": every(7, False, "has_replacement_char"),
        "has_encoding_issues": every(2, 0, "has_encoding_issues"),
        "quality_score": F.when(n % 31 == 0, 150).otherwise(every(11, 95, "quality_score")),
        "is_too_short": every(13, 1, "is_too_short"),
        "is_too_long": every(17, 1, "is_too_long"),
        "total_japanese_chars": every(19, n + 1, "total_japanese_chars"),
        "whitespace_ratio": every(23, 1.5, "whitespace_ratio"),
        "is_anomaly": every(29, 1 - F.col("is_anomaly"), "is_anomaly"),
    }
    # Written, so that the rules read the falsified values and are not folded into them.
    rows = materialize(measured_unfiltered(spark, folder), "measures").withColumns(falsified)
    return K.run_rules(rows, K.record_rules())


@query
def check_broken_models(spark, folder):
    """Checks of models, keys, schemas and totals over models with falsified rows,
    columns and sums."""
    w, a = both(spark, folder, (CHUNK,))
    w, a = materialize(w, "web"), materialize(a, "articles")
    blank = F.when(F.col("content_length") % 3 == 0, "").otherwise(F.col("source_dataset"))
    short = a.withColumn("article_id", F.left("article_id", F.lit(1)))
    rows = quality.measured_rows(w, a).drop("text")
    summary = materialize(marts.dataset_quality_summary(rows, RUN_TS), "summary")
    wrong = summary.withColumn("avg_quality_score", F.col("avg_quality_score") + 100)
    more = summary.withColumn("total_records", F.col("total_records") + 1)
    kinds = [w.withColumn("content_length", F.col("content_length").cast("string")).schema["content_length"], a.schema["text_length"]]
    return K.union_checks(
        K.run_rules(w.withColumn("source_dataset", blank), [K.source_rule()]),
        K.keys_unique(short, "stg_articles", "article_id", "primary_key_uniqueness", "Wikipedia article IDs should be unique"),
        K.missing_in_schema(spark, w.drop("contains_japanese_chars", "source_dataset").columns),
        K.types_in_schema(spark, [k.dataType.simpleString() for k in kinds]),
        K.run_rules(wrong, [K.summary_rule()]),
        K.completeness(summary.filter(F.col("dataset_name") != V.ARTICLE_DATASET), [V.WEB_DATASET, V.ARTICLE_DATASET]),
        K.total_consistency(rows, more),
    )


@query
def check_contracts(spark, folder):
    """Declared contracts of sources and marts, over sources and marts in which rows are
    broken by rule: texts of one language, ids of one source, and what marts make of them."""
    docs = raw_articles(spark, folder)
    broken = docs.withColumn("id", F.when(~F.col("title").startswith("src9-"), F.col("id")))
    w, a = both(spark, folder)
    contents = marts.content_summary(w, a, BATCH, RUN_TS)
    contents = contents.withColumn("avg_content_length", F.when(F.col("source_type") == V.WEB_KEY, -1.0))
    metrics = marts.content_quality_metrics(w, a, BATCH, RUN_TS)
    metrics = metrics.withColumn("quality_tier", F.when(F.col("total_items") > 1, F.upper("quality_tier")))
    return K.union_checks(
        K.run_rules(raw_web(spark, folder), K.contract_rules("raw_web", raw_web(spark, folder))),
        K.run_rules(broken, K.contract_rules("raw_articles", broken)),
        K.unique(broken, "raw_articles", "id"),
        *K.mart_checks({"content_summary": contents, "content_quality_metrics": metrics}),
    )


# ---- streams --------------------------------------------------------------


def _stream(spark, folder, name):
    schema = table(spark, folder, name).schema
    return jobs.table_stream(spark, f"{folder}/{name}.parquet", schema, files_per_batch=1)


@query
def stream_ingest(spark, folder):
    base = fresh_dir(spark, "stream-ingest")
    docs = _stream(spark, folder, "documents")
    order = scan.file_order_of(table(spark, folder, "documents"))
    stored, ckpt = f"{base}/table", f"{base}/checkpoint"
    jobs.drain(
        jobs.ingest_chunks(
            docs, stored, ckpt, SIZE, V.ARTICLE_DATASET, V.ARTICLE_CONFIG, RUN_TS, order=order
        )
    )
    return tables.read_table(spark, stored).select(
        "doc_id",
        "text",
        "_meta_dataset_name",
        "_meta_config_name",
        "_meta_chunk_index",
        "_meta_start_idx",
        "_meta_end_idx",
        "_processing_timestamp",
    )


def _web_stream(spark, folder):
    return raw_views.raw_web(
        _stream(spark, folder, "documents"), _stream(spark, folder, "pages")
    )


@query
def stream_staging(spark, folder):
    base = fresh_dir(spark, "stream-staging")
    rows = staging.clean_web(
        staging.web_rows(_web_stream(spark, folder)), keep=["_row_key"]
    )
    jobs.drain(jobs.append_files(rows, f"{base}/table", f"{base}/checkpoint"))
    return tables.read_table(spark, f"{base}/table", rows.schema)


@query
def stream_dedup(spark, folder):
    base = fresh_dir(spark, "stream-dedup")
    order = [F.col("_dbt_extracted_at").desc(), F.col("_row_key").desc()]
    stream = _web_stream(spark, folder)
    jobs.drain(jobs.latest_wins(stream, f"{base}/log", f"{base}/checkpoint", order))
    return jobs.read_latest(spark, f"{base}/log", order).select(
        "text", "url", "_dbt_extracted_at", "_row_key"
    )


@query
def stream_dedup_compacted(spark, folder):
    """Documents and pages arrive as streams of one log, which is merged into a table in
    between; a later visit stays in the log. The result is that of table and log."""
    base = fresh_dir(spark, "stream-compact")
    order = [F.col("_dbt_extracted_at").desc(), F.col("_row_key").desc()]
    log, stored = f"{base}/log", f"{base}/table"
    docs, pages = _stream(spark, folder, "documents"), _stream(spark, folder, "pages")
    visits = [
        raw_views.web_from_documents(docs), raw_views.web_from_pages(pages), raw_views.web_from_pages(pages, hours=1)
    ]
    for number, rows in enumerate(visits):
        checkpoint = f"{base}/checkpoint-{number}"
        jobs.drain(jobs.latest_wins(rows, log, checkpoint, order))
        if number < len(visits) - 1:
            jobs.compact_latest(spark, log, stored, order, checkpoints=[checkpoint])
    return jobs.read_latest(spark, log, order, stored).select("text", "url", "_dbt_extracted_at", "_row_key")


@query
def stream_quality_counts(spark, folder):
    base = fresh_dir(spark, "stream-counts")
    cleaned = staging.clean_web(_web_stream(spark, folder))
    docs = staging.clean_articles(raw_views.raw_articles(_stream(spark, folder, "documents")))
    counters = jobs.quality_counters(quality.quality_checks(cleaned, docs))
    jobs.drain(jobs.publish_counters(counters, f"{base}/table", f"{base}/checkpoint"))
    return tables.read_table(spark, f"{base}/table", counters.schema)
