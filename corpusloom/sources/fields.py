"""Schemas of the raw corpora and the declared contracts of every model."""

from pyspark.sql import types as T

from corpusloom import values as V

STRING, LONG, TIME = T.StringType(), T.LongType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_WEB = _schema(
    ("text", STRING),
    ("url", STRING),
    ("timestamp", TIME),
    ("_meta_dataset_name", STRING),
    ("_dbt_extracted_at", TIME),
    ("_dbt_source_table", STRING),
)

RAW_ARTICLES = _schema(
    ("id", STRING),
    ("title", STRING),
    ("text", STRING),
    ("_meta_dataset_name", STRING),
    ("_dbt_extracted_at", TIME),
    ("_dbt_source_table", STRING),
)

CHUNK_META = _schema(
    ("_meta_dataset_name", STRING),
    ("_meta_config_name", STRING),
    ("_meta_chunk_index", LONG),
    ("_meta_start_idx", LONG),
    ("_meta_end_idx", LONG),
)

# Columns that must not be NULL, per model.
NOT_NULL = {
    "raw_web": ("text",),
    "raw_articles": ("id", "title", "text"),
    "stg_web": (
        "content_text",
        "source_url",
        "source_dataset",
        "content_length",
        "content_length_category",
        "contains_japanese_chars",
        "is_valid_content",
        "row_rank",
        "dbt_updated_at",
        "dbt_batch_id",
        "dbt_extracted_timestamp",
    ),
    "stg_articles": (
        "article_id",
        "article_title",
        "article_text",
        "source_dataset",
        "text_length",
        "title_length",
        "article_size_category",
        "article_type",
        "contains_japanese_chars",
        "is_valid_article",
        "section_count_estimate",
    ),
    "quality_checks": (
        "text",
        "text_length",
        "japanese_ratio",
        "ascii_ratio",
        "quality_score",
        "quality_class",
        "content_type",
        "is_anomaly",
        "_meta_dataset_name",
    ),
    "dataset_quality_summary": (
        "dataset_name",
        "total_records",
        "high_quality_pct",
        "medium_quality_pct",
        "low_quality_pct",
        "poor_quality_pct",
        "anomaly_rate_pct",
        "avg_japanese_ratio",
        "avg_quality_score",
        "overall_quality_assessment",
        "quality_recommendation",
        "summary_generated_at",
    ),
    "content_summary": ("total_records", "avg_content_length"),
    "content_quality_metrics": ("source", "quality_tier"),
}

# Columns restricted to a list of values, per model.
ACCEPTED = {
    "stg_web": {
        "source_dataset": (V.WEB_DATASET,),
        "content_length_category": V.LENGTH_CATEGORIES,
        "contains_japanese_chars": (True, False),
        "is_valid_content": (True, False),
    },
    "stg_articles": {
        "source_dataset": (V.ARTICLE_DATASET,),
        "article_size_category": V.ARTICLE_SIZES,
        "article_type": V.ARTICLE_TYPES,
        "contains_japanese_chars": (True, False),
        "is_valid_article": (True, False),
    },
    "quality_checks": {
        "quality_class": V.QUALITY_CLASSES,
        "content_type": V.CONTENT_TYPES,
        "is_anomaly": (0, 1),
        "_meta_dataset_name": (V.WEB_DATASET, V.ARTICLE_DATASET),
    },
    "dataset_quality_summary": {
        "dataset_name": (V.WEB_DATASET, V.ARTICLE_DATASET, "TOTAL"),
        "overall_quality_assessment": V.ASSESSMENTS,
    },
    "content_quality_metrics": {"quality_tier": V.QUALITY_TIERS},
}

# Columns restricted to a closed range, per model.
RANGES = {
    "stg_web": {"content_length": (10, V.MAX_LENGTH), "row_rank": (1, 100)},
    "stg_articles": {
        "text_length": (50, 2_000_000),
        "title_length": (1, 500),
        "section_count_estimate": (0, 1_000),
    },
    "quality_checks": {
        "text_length": (1, 2_000_000),
        "japanese_ratio": (0.0, 1.0),
        "ascii_ratio": (0.0, 1.0),
        "quality_score": (0, 100),
    },
    "dataset_quality_summary": {
        "total_records": (0, None),
        "high_quality_pct": (0.0, 100.0),
        "medium_quality_pct": (0.0, 100.0),
        "low_quality_pct": (0.0, 100.0),
        "poor_quality_pct": (0.0, 100.0),
        "anomaly_rate_pct": (0.0, 100.0),
        "avg_japanese_ratio": (0.0, 1.0),
        "avg_quality_score": (0.0, 100.0),
    },
    "content_summary": {
        "total_records": (0, None),
        "avg_content_length": (0, 100_000),
    },
}

REQUIRED_WEB_COLUMNS = (
    "content_text",
    "source_dataset",
    "content_length",
    "contains_japanese_chars",
)
