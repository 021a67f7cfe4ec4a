"""A whole run: ingest, load, stage, score, summarise, test, report.

Plain function calls. Frames that several steps read are written as tables
first; everything else stays lazy.
"""

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import values as V
from corpusloom.functions.text import digest
from corpusloom.operators import chunks as C
from corpusloom.plans import checks, marts, quality, staging
from corpusloom.sources import fields as S
from corpusloom.sources import scan
from corpusloom.sources.tables import read_table, write_table
from corpusloom.sources.workdir import materialize, path_exists


CHUNK_FIELD = T.StructField("_meta_chunk_index", T.LongType(), True)
ROW_FIELD = T.StructField("_meta_row_index", T.LongType(), True)


@dataclass(frozen=True)
class Corpus:
    """A source frame (a whole Parquet scan) and how it maps to corpus fields.

    `where` picks the rows to take; they keep the places they have in the whole source.
    """

    key: str
    dataset: str
    config: str
    frame: DataFrame
    schema: T.StructType
    defaults: dict
    fallback: dict
    mapping: dict = field(default_factory=dict)
    where: Column | str | None = None

    @cached_property
    def order(self) -> scan.FileOrder:
        """The order of the source's files, computed once for all steps."""
        return scan.file_order_of(self.frame)

    def taken(self) -> DataFrame:
        return self.frame if self.where is None else self.frame.filter(self.where)


def web_corpus(frame: DataFrame, mapping=None, where=None) -> Corpus:
    return Corpus(
        V.WEB_KEY, V.WEB_DATASET, V.WEB_CONFIG, frame, S.RAW_WEB,
        scan.WEB_DEFAULTS, V.WEB_FALLBACK, mapping or {}, where,
    )


def article_corpus(frame: DataFrame, mapping=None, where=None) -> Corpus:
    return Corpus(
        V.ARTICLE_KEY, V.ARTICLE_DATASET, V.ARTICLE_CONFIG, frame, S.RAW_ARTICLES,
        scan.ARTICLE_DEFAULTS, V.ARTICLE_FALLBACK, mapping or {}, where,
    )


def numbered(corpus: Corpus) -> DataFrame:
    """The corpus fields with a row ordinal."""
    return scan.scan_with_ordinal(scan.project_fields(corpus.taken(), corpus.mapping), corpus.order)


def chunked(corpus: Corpus, size: int, max_chunks=None, cap=None, total=None) -> DataFrame:
    """Rows with chunk columns and metadata, limited as asked. A source without
    a text column has no valid chunk and gives no rows."""
    rows = C.assign_chunks(numbered(corpus), size)
    if "text" not in rows.columns:
        rows = rows.filter(F.lit(False))
    if max_chunks is not None:
        rows = C.limit_chunks(rows, max_chunks)
    if cap is not None:
        rows = C.cap_rows(rows, cap)
    stamped = C.stamp_metadata(rows, corpus.dataset, corpus.config, size, total)
    stamped = stamped.withColumn(ROW_FIELD.name, F.col(scan.ORDINAL))
    return stamped.withColumn("dataset_key", F.lit(corpus.key)).drop("start_idx", scan.ORDINAL)


def source_counts(corpus: Corpus, size: int, cap=None) -> DataFrame:
    """Per chunk, the rows of the source that it should store and the last ordinal.

    Where every place of the source has a row, this follows from the number of rows;
    otherwise row positions are counted (and what the filter needs is read).
    """
    key = F.lit(corpus.key).alias("dataset_key")
    if corpus.where is None and corpus.order.dense:
        start = F.col("id") * F.lit(size).cast("long")
        end = F.least(start + size, F.lit(corpus.order.rows).cast("long"))
        records = end - start if cap is None else F.least(end - start, F.lit(cap).cast("long"))
        chunks = corpus.frame.sparkSession.range(-(-corpus.order.rows // size))
        return chunks.select(F.col("id").alias("chunk_index"), records.alias("records"), (end - 1).alias("last"), key)
    rows = C.assign_chunks(scan.scan_with_ordinal(corpus.taken(), corpus.order), size)
    kept = F.lit(True) if cap is None else F.col(scan.ORDINAL) - F.col("start_idx") < cap
    counted = rows.groupBy("chunk_index").agg(F.count_if(kept).alias("records"), F.max(scan.ORDINAL).alias("last"))
    return materialize(counted.select("*", key), "counts")


def complete_chunks(stored: DataFrame, plan: DataFrame, wanted: DataFrame) -> DataFrame:
    """Keys of stored chunks with the planned bounds and all of their records."""
    ends = [F.min("_meta_start_idx"), F.max("_meta_start_idx"), F.min("_meta_end_idx"), F.max("_meta_end_idx")]
    names = ("low_start", "high_start", "low_end", "high_end")
    found = stored.groupBy(*C.CHUNK_KEYS).agg(
        F.count(F.lit(1)).alias("have"), *[e.alias(n) for e, n in zip(ends, names, strict=True)]
    )
    planned = plan.join(wanted.select(*C.CHUNK_KEYS, "records"), list(C.CHUNK_KEYS))
    same = (F.col("have") == F.col("records")) & (F.col("low_start") == F.col("high_start"))
    same &= (F.col("low_start") == F.col("start_idx")) & (F.col("low_end") == F.col("high_end"))
    same &= F.col("low_end") == F.col("end_idx")
    return found.join(planned, list(C.CHUNK_KEYS)).filter(same).select(*C.CHUNK_KEYS)


def chunk_root(base: str, corpus: Corpus) -> str:
    return f"{base}/chunks/{corpus.key}"


def store_chunks(
    corpus: Corpus,
    base: str,
    size: int,
    max_chunks=None,
    cap=None,
    resume: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Write the chunks of a corpus in one pass over it and read them back.

    `resume` keeps stored chunks that have the planned bounds and all records, and
    writes all others again.
    """
    spark = corpus.frame.sparkSession
    counts = source_counts(corpus, size, cap) if counts is None else counts
    total = last_ordinal(counts)
    rows = chunked(corpus, size, max_chunks, cap, total.first()["total"])
    path = chunk_root(base, corpus)
    pending = rows
    if resume and path_exists(spark, path):
        plan = C.chunk_plan(total, size, corpus.dataset, corpus.config, corpus.key)
        done = complete_chunks(read_table(spark, path, rows.schema), plan, counts)
        # Written first: the chunks it is read from are about to be replaced.
        done = materialize(done, "done")
        pending = rows.join(done, list(C.CHUNK_KEYS), "left_anti").select(*rows.columns)
    C.write_chunks(pending, path)
    return read_table(spark, path, rows.schema)


def last_ordinal(counts: DataFrame) -> DataFrame:
    return counts.agg((F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("total"))


def ingest(
    corpus: Corpus,
    base: str,
    size: int,
    max_chunks=None,
    cap=None,
    batch_size: int = 500,
    resume: bool = False,
    min_records: int = 1,
):
    """Write the chunks of a corpus and return (stored chunks, manifest).

    Every chunk is validated: the stored number of rows must be that of the source,
    at least `min_records`, and chunks with mostly NULL texts are marked. Row counts come
    from footers; only row groups that hold NULL texts are looked into.
    """
    counts = source_counts(corpus, size, cap)
    stored = store_chunks(corpus, base, size, max_chunks, cap, resume, counts)
    plan = C.chunk_plan(last_ordinal(counts), size, corpus.dataset, corpus.config, corpus.key, batch_size)
    wanted = counts if max_chunks is None else C.limit_chunks(counts, max_chunks)
    written = C.stored_counts(stored)
    if "text" in stored.columns:
        nulls = stored.filter("text IS NULL").groupBy(*C.CHUNK_KEYS).agg(F.count(F.lit(1)).alias("null_texts"))
        written = written.join(nulls, list(C.CHUNK_KEYS), "left")
    else:
        wanted = wanted.filter(F.lit(False))
    manifest = C.chunk_manifest(plan, written, wanted, max_chunks, chunk_root(base, corpus), min_records)
    path = f"{base}/manifest/{corpus.key}"
    manifest.write.mode("overwrite").parquet(path)
    return stored, read_table(stored.sparkSession, path, manifest.schema)


def direct_load(corpus: Corpus, run_ts: str, limit: int | None = None) -> DataFrame:
    """The raw table straight from the source, without chunk files: the first
    `limit` rows, with defaults for fields the source does not have."""
    rows = scan.field_defaults(numbered(corpus), corpus.defaults)
    if limit is not None:
        rows = rows.filter(F.col(scan.ORDINAL) < limit)
    stamped = rows.withColumns(
        {
            "timestamp": F.lit(run_ts).cast("timestamp_ntz"),
            "_meta_dataset_name": F.lit(corpus.dataset),
            "_dbt_extracted_at": F.lit(run_ts).cast("timestamp_ntz"),
            "_dbt_source_table": F.lit(V.SOURCE_TABLE),
        }
    )
    return align(stamped, corpus.schema)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the shape of a schema; absent columns become typed NULLs."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def load_raw(stored: DataFrame, manifest: DataFrame, schema, run_ts: str, extra=()) -> DataFrame:
    """Rows of the successfully stored chunks in the raw table's shape."""
    good = manifest.filter("status = 'success'").select("dataset_key", "chunk_index")
    rows = stored.join(good, ["dataset_key", "chunk_index"], "left_semi").withColumns(
        {
            "_dbt_extracted_at": F.lit(run_ts).cast("timestamp_ntz"),
            "_dbt_source_table": F.lit(V.SOURCE_TABLE),
        }
    )
    wide = T.StructType([*schema.fields, *extra])
    return align(rows, wide)


def load_or_fallback(raw: DataFrame, corpus: Corpus, run_ts: str) -> DataFrame:
    """The loaded rows, or the corpus' one fallback row when nothing was stored."""
    row = {
        **corpus.fallback,
        "timestamp": run_ts,
        "_meta_dataset_name": corpus.dataset,
        "_dbt_extracted_at": run_ts,
        "_dbt_source_table": V.SOURCE_TABLE,
        ROW_FIELD.name: 0,
    }
    return scan.with_fallback(raw, row)


def web_facts(web: DataFrame, script: str = "narrow") -> DataFrame:
    """Staged web rows with their measures, without long texts.

    Texts are replaced by their digests: tests need to know that a text is
    there, and everything that is read from its characters is measured here or
    kept as `content_start`. Write it once; all later steps read only this.
    """
    measured = quality.measure(web, "content_text", "content_length", script)
    return measured.withColumn("content_start", marts.content_start()).withColumn(
        "content_text", digest("content_text")
    )


def article_facts(articles: DataFrame, script: str = "narrow") -> DataFrame:
    """Staged articles with their measures, without long texts."""
    measured = quality.measure(articles, "article_text", "text_length", script)
    return measured.withColumn("article_text", digest("article_text")).drop("first_paragraph")


def facts_as_records(web: DataFrame, articles: DataFrame) -> DataFrame:
    """The two fact tables in the shape of the full quality model."""
    skip = {"text", "text_length", "_meta_dataset_name"}
    measures = [c for c in quality.FULL_COLUMNS if c not in skip]
    carried = [*measures, "is_nav_word", "has_replacement_char", CHUNK_FIELD.name]
    shape = lambda df, text, length: df.select(
        F.col(text).alias("text"),
        F.col(length).alias("text_length"),
        F.col("source_dataset").alias("_meta_dataset_name"),
        *carried,
    )
    return shape(web, "content_text", "content_length").unionByName(
        shape(articles, "article_text", "text_length")
    )


def run_corpora(
    spark: SparkSession,
    web: Corpus,
    articles: Corpus,
    base: str,
    run_ts: str,
    batch_id: str = "unknown",
    mode: str = V.DEFAULT_PRESET,
    script: str = "narrow",
    max_chunks: int | None = None,
    cap: int | None = None,
    resume: bool = False,
) -> dict:
    """Run everything below `base` and return the resulting tables by name.

    `mode` picks chunk sizes. All rows are processed unless `max_chunks` or `cap` limit
    the chunks per corpus or the rows per chunk. `resume=True` keeps the complete chunks
    that an earlier run stored. A run with failed chunks stops before anything is loaded.
    """
    settings = V.preset(mode)
    out = {}

    def table(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/tables/{name}"
        write_table(df, path, "overwrite")
        out[name] = read_table(spark, path, df.schema)
        return out[name]

    manifests, raw = [], {}
    for corpus, size in ((web, "web_chunk_size"), (articles, "article_chunk_size")):
        stored, manifest = ingest(
            corpus, base, settings[size], max_chunks, cap, settings["batch_size"], resume
        )
        manifests.append(manifest)
        failed = C.failed_chunks(manifest).first()
        if failed is not None:
            raise RuntimeError(f"chunk {failed['chunk_index']} of {corpus.key}: {failed['error']}")
        loaded = load_raw(stored, manifest, corpus.schema, run_ts, [CHUNK_FIELD, ROW_FIELD])
        raw[corpus.key] = load_or_fallback(loaded, corpus, run_ts)
    manifest = table("chunk_manifest", manifests[0].unionByName(manifests[1]))
    table("run_summary", C.run_summary(manifest))

    keep = (CHUNK_FIELD.name,)
    number = ROW_FIELD.name
    stg_web = table("stg_web", staging.stg_web(raw[web.key], batch_id, run_ts, script, (number,), keep, row=number))
    stg_articles = table(
        "stg_articles", staging.stg_articles(raw[articles.key], batch_id, run_ts, script, keep=keep)
    )
    # The last reads of the texts. Everything below works on the fact tables.
    # The rules of the suite are counted while the fact tables are written.
    facts = checks.watched_facts(web_facts(stg_web, script), article_facts(stg_articles, script), run_ts)
    web_rows, article_rows = table("web_facts", facts.web), table("article_facts", facts.articles)
    simple = quality.quality_checks(web_rows, article_rows)
    records = facts_as_records(web_rows, article_rows)
    anomalies = table("anomaly_report", quality.anomaly_report(simple))
    table("quality_report", quality.quality_report(anomalies))
    table("dataset_quality_summary", marts.dataset_quality_summary(simple, run_ts, stored=True))
    summary = table("dataset_quality_summary_full", marts.dataset_quality_summary(records, run_ts, stored=True))
    metrics = table(
        "content_quality_metrics",
        marts.content_quality_metrics(web_rows, article_rows, batch_id, run_ts),
    )
    contents = table("content_summary", marts.content_summary(web_rows, article_rows, batch_id, run_ts))
    table("processing_summary", marts.processing_summary(anomalies, batch_id, run_ts))
    checked = {"content_summary": contents, "content_quality_metrics": metrics}
    table("check_suite", checks.observed_suite(facts, article_rows, summary, checked))
    return out
