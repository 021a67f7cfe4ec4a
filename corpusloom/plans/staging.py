"""Staging models: cleaned, classified and filtered corpora.

Each model is a projection plus filters, so it also runs on a stream; only the
web model's deduplication needs a shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import rules as R
from corpusloom.functions import text as X
from corpusloom.operators.dedup import dedup_latest, dedup_latest_by_row


def _run_columns(batch_id: str, run_ts: str) -> dict:
    return {
        "dbt_updated_at": F.lit(run_ts).cast("timestamp_ntz"),
        "dbt_batch_id": F.lit(batch_id),
    }


def clean_web(raw: DataFrame, script: str = "narrow", keep=()) -> DataFrame:
    """Rename and derive the web columns; rows without text are dropped."""
    trimmed = raw.filter(F.col("text").isNotNull()).select(
        "*",
        X.trim_spaces("text").alias("content_text"),
    )
    measured = trimmed.withColumn("content_length", X.length_of("content_text"))
    return measured.select(
        "content_text",
        F.coalesce("url", F.lit("unknown")).alias("source_url"),
        F.col("timestamp").alias("content_timestamp"),
        F.col("_meta_dataset_name").alias("source_dataset"),
        F.col("_dbt_extracted_at").alias("dbt_extracted_timestamp"),
        F.col("_dbt_source_table").alias("dbt_source_table"),
        "content_length",
        R.length_category("content_length").alias("content_length_category"),
        X.has_script("text", script).alias("contains_japanese_chars"),
        X.url_domain("url").alias("url_domain"),
        R.valid_content("content_text").alias("is_valid_content"),
        *keep,
    )


def web_rows(raw: DataFrame, script: str = "narrow") -> DataFrame:
    """Raw web rows that pass the validity and script rules.

    Both rules depend on the text alone, which is part of the dedup key, so
    applying them first drops whole groups and never changes a winner. It
    keeps rejected texts out of the shuffle. NULL texts fail the first rule.
    """
    return raw.filter(
        X.has_script("text", script) & R.valid_content(X.trim_spaces("text"))
    )


def stg_web(
    raw: DataFrame, batch_id: str, run_ts: str, script: str = "narrow", tie=(), keep=(), row: str | None = None
) -> DataFrame:
    """Web staging: valid rows of the script, the latest per (text, url).

    `tie` names columns that decide between rows extracted at the same time,
    `keep` names further raw columns to carry. `row` names a column that numbers the
    rows of a stored table, if there is one; texts are then fetched by it.
    """
    order = [F.col("_dbt_extracted_at").desc(), *[F.col(c).desc() for c in tie]]
    rows = web_rows(raw, script)
    latest = (
        dedup_latest(rows, "text", "url", order)
        if row is None
        else dedup_latest_by_row(rows, "text", "url", order, row)
    )
    return clean_web(latest, script, keep).withColumns(
        {
            # Every remaining row passed both rules; no need to test it again.
            "contains_japanese_chars": F.lit(True),
            "is_valid_content": F.lit(True),
            "row_rank": F.lit(1),
            **_run_columns(batch_id, run_ts),
        }
    )


def clean_articles(
    raw: DataFrame,
    script: str = "narrow",
    paragraph: str = "\n\n",
    heading: str = "\n==",
    keep=(),
) -> DataFrame:
    """Rename and derive the article columns; incomplete rows are dropped."""
    complete = raw.filter(
        F.col("id").isNotNull() & F.col("title").isNotNull() & F.col("text").isNotNull()
    )
    trimmed = complete.select(
        "*",
        F.col("id").cast("string").alias("article_id"),
        X.trim_spaces("title").alias("article_title"),
        X.trim_spaces("text").alias("article_text"),
    )
    measured = trimmed.withColumns(
        {
            "text_length": X.length_of("article_text"),
            "title_length": X.length_of("article_title"),
        }
    )
    return measured.select(
        "article_id",
        "article_title",
        "article_text",
        F.col("_meta_dataset_name").alias("source_dataset"),
        F.col("_dbt_extracted_at").alias("dbt_extracted_timestamp"),
        F.col("_dbt_source_table").alias("dbt_source_table"),
        "text_length",
        "title_length",
        R.article_size("text_length").alias("article_size_category"),
        R.article_type("title").alias("article_type"),
        X.has_script("text", script).alias("contains_japanese_chars"),
        R.valid_article("title", "text").alias("is_valid_article"),
        X.first_paragraph("text", paragraph).alias("first_paragraph"),
        X.section_count("text", heading).alias("section_count_estimate"),
        *keep,
    )


def stg_articles(
    raw: DataFrame,
    batch_id: str,
    run_ts: str,
    script: str = "narrow",
    paragraph: str = "\n\n",
    heading: str = "\n==",
    keep=(),
) -> DataFrame:
    """Article staging: valid plain articles of the script. No dedup."""
    return (
        clean_articles(raw, script, paragraph, heading, keep)
        .filter("is_valid_article AND contains_japanese_chars AND article_type = 'article'")
        .withColumns(
            {
                "article_type": F.lit("article"),
                "contains_japanese_chars": F.lit(True),
                "is_valid_article": F.lit(True),
                **_run_columns(batch_id, run_ts),
            }
        )
    )
