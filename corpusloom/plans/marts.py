"""Marts: dataset quality, content quality, content and processing summaries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions import rules as R
from corpusloom.functions.numeric import percent, ratio, round_to
from corpusloom.functions.text import digest
from corpusloom.operators.aggregates import exact_medians
from corpusloom.sources.workdir import materialize

TOTAL = "TOTAL"

CLASS_COUNTS = {
    "high_quality": ("quality_class", "high"),
    "medium_quality": ("quality_class", "medium"),
    "low_quality": ("quality_class", "low"),
    "poor_quality": ("quality_class", "poor"),
}
TYPE_COUNTS = {
    "content": ("content_type", "content"),
    "navigation": ("content_type", "navigation"),
    "ui_element": ("content_type", "ui_element"),
}
# Counts that the simple model cannot provide and reports as zero.
FULL_TYPE_COUNTS = {
    "date_only": ("content_type", "date_only"),
    "punctuation_only": ("content_type", "punctuation_only"),
}
FLAG_COUNTS = {"encoding_issues": "has_encoding_issues", "repetition": "has_repetition"}

# Cells of the median search: lengths in steps of 1024 characters; ratios in 2**12 steps
# and each of those in 2**20, where few fractions of text lengths share one; scores as
# they are.
LENGTH_CELL, RATIO_CELLS, RATIO_SUBCELLS = 1024, 1 << 12, 1 << 32


SUMMARY_COLUMNS = ("text_length", "japanese_ratio", "quality_score", "quality_class", "content_type", "is_anomaly")


def summary_columns(quality: DataFrame) -> list[str]:
    """What the summary looks at of every record: numbers, flags and short labels."""
    optional = [c for c in (*FLAG_COUNTS.values(), "_meta_chunk_index") if c in quality.columns]
    return ["_meta_dataset_name", *SUMMARY_COLUMNS, *optional]


def _narrow(quality: DataFrame) -> DataFrame:
    return quality.select(*summary_columns(quality)).withColumnRenamed("_meta_dataset_name", "dataset_name")


def _dataset_level(records: DataFrame) -> DataFrame:
    """Counts, sums and bounds per dataset. Tasks add up their records per chunk, whose
    rows sit together, so that the shuffle carries about one row for each chunk."""
    where = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    equals = {**CLASS_COUNTS, **TYPE_COUNTS}
    full = set(FLAG_COUNTS.values()) <= set(records.columns)
    if full:
        equals.update(FULL_TYPE_COUNTS)
    counts = {f"{name}_count": where(F.col(c) == v) for name, (c, v) in equals.items()}
    zero = F.lit(0).cast("long")
    for name in FULL_TYPE_COUNTS:
        counts.setdefault(f"{name}_count", F.max(zero))
    for name, flag in FLAG_COUNTS.items():
        counts[f"{name}_count"] = F.sum(flag) if full else F.max(zero)
    chunk = "_meta_chunk_index"
    chunked = chunk in records.columns
    sums = {
        "total_records": F.count(F.lit(1)),
        **counts,
        "anomaly_count": F.sum("is_anomaly"),
        "too_short_count": where(F.col("text_length") < V.TOO_SHORT),
        "too_long_count": where(F.col("text_length") > V.TOO_LONG),
        "length_sum": F.sum("text_length"),
        "ratio_sum": F.sum("japanese_ratio"),
        "score_sum": F.sum("quality_score"),
    }
    ends = ("text_length", "japanese_ratio", "quality_score")
    by_chunk = records.groupBy("dataset_name", *([chunk] if chunked else [])).agg(
        *[expr.alias(name) for name, expr in sums.items()],
        *[F.min(c).alias(f"min_{c}") for c in ends],
        *[F.max(c).alias(f"max_{c}") for c in ends],
    )
    chunks = F.count(chunk) if chunked else F.max(F.lit(1).cast("long"))
    return by_chunk.groupBy("dataset_name").agg(
        *[F.sum(name).alias(name) for name in sums],
        *[F.min(f"min_{c}").alias(f"min_{c}") for c in ends],
        *[F.max(f"max_{c}").alias(f"max_{c}") for c in ends],
        chunks.alias("unique_chunks"),
    )


def with_total(level: DataFrame, name: str, sums=(), lows=(), highs=(), only_groups=()) -> DataFrame:
    """Add a TOTAL row to a grouped frame in the same pass.

    Each group row counts once under its own name and once under TOTAL. An
    all-NULL row joins the total, so that it exists even without groups.
    Columns in `only_groups` cannot be combined and are NULL in the total.
    """
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in level.schema]
    seed = level.sparkSession.range(1).select(*nulls, F.lit(TOTAL).alias("_name"))
    both = level.withColumn("_name", F.explode(F.array(F.col(name), F.lit(TOTAL)))).union(seed)
    own = F.col("_name") != TOTAL
    return both.groupBy(F.col("_name").alias(name)).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.min(c).alias(c) for c in lows],
        *[F.max(c).alias(c) for c in highs],
        *[F.max(F.when(own, F.col(c))).alias(c) for c in only_groups],
    )


MEDIAN_COLUMNS = {
    "median_text_length": "text_length",
    "median_japanese_ratio": "japanese_ratio",
    "median_quality_score": "quality_score",
}


def median_measures(*names) -> dict:
    """Result name -> (column, cells coarse to fine) for the median search."""
    ratio_cell = lambda steps: F.floor(F.col("japanese_ratio") * steps)
    cells = {
        "text_length": [F.floor(F.col("text_length") / LENGTH_CELL)],
        "japanese_ratio": [ratio_cell(RATIO_CELLS), ratio_cell(RATIO_SUBCELLS)],
        "quality_score": [F.col("quality_score")],
    }
    return {n: (MEDIAN_COLUMNS[n], cells[MEDIAN_COLUMNS[n]]) for n in names or MEDIAN_COLUMNS}


def dataset_quality_summary(
    quality: DataFrame, run_ts: str, stored: bool = False, total_medians: bool = False
) -> DataFrame:
    """Quality per dataset and in total, from either quality model.

    With the full model the encoding, repetition, date and punctuation counts
    are real; with the simple one they are zero. The medians of the TOTAL row are NULL
    unless `total_medians` asks for those over all records. The records are read several
    times: `stored` says that they are a written table, otherwise what the summary looks
    at is written first, by the tasks that compute it.
    """
    records = _narrow(quality) if stored else materialize(_narrow(quality), "records")
    medians = exact_medians(records, ["dataset_name"], median_measures(), TOTAL if total_medians else None)
    medians = materialize(medians, "medians") if total_medians else medians
    level = _dataset_level(records).join(medians, "dataset_name", "left")
    counts = [c for c in level.columns if c.endswith("_count")]
    table = with_total(
        level,
        "dataset_name",
        sums=["total_records", *counts, "length_sum", "ratio_sum", "score_sum", "unique_chunks"],
        lows=["min_text_length", "min_japanese_ratio", "min_quality_score"],
        highs=["max_text_length", "max_japanese_ratio", "max_quality_score"],
        only_groups=list(MEDIAN_COLUMNS),
    )
    if total_medians:
        table = table.drop(*MEDIAN_COLUMNS).join(medians, "dataset_name", "left")
    mean = lambda c: ratio(c, "total_records")
    run = F.lit(run_ts).cast("timestamp_ntz")
    shares = [
        ("high_quality_pct", "high_quality_count"),
        ("medium_quality_pct", "medium_quality_count"),
        ("low_quality_pct", "low_quality_count"),
        ("poor_quality_pct", "poor_quality_count"),
        ("anomaly_rate_pct", "anomaly_count"),
        ("too_short_pct", "too_short_count"),
        ("too_long_pct", "too_long_count"),
        ("encoding_issues_pct", "encoding_issues_count"),
        ("repetition_pct", "repetition_count"),
        ("content_pct", "content_count"),
        ("navigation_pct", "navigation_count"),
        ("ui_element_pct", "ui_element_count"),
        ("date_only_pct", "date_only_count"),
        ("punctuation_only_pct", "punctuation_only_count"),
    ]
    summary = table.select(
        "dataset_name",
        "total_records",
        *[percent(count, "total_records").alias(name) for name, count in shares],
        round_to(mean("length_sum"), 0).alias("avg_text_length"),
        "min_text_length",
        "max_text_length",
        "median_text_length",
        round_to(mean("ratio_sum"), 3).alias("avg_japanese_ratio"),
        round_to("min_japanese_ratio", 3).alias("min_japanese_ratio"),
        round_to("max_japanese_ratio", 3).alias("max_japanese_ratio"),
        round_to("median_japanese_ratio", 3).alias("median_japanese_ratio"),
        round_to(mean("score_sum"), 1).alias("avg_quality_score"),
        "min_quality_score",
        "max_quality_score",
        round_to("median_quality_score", 1).alias("median_quality_score"),
        run.alias("earliest_processed_at"),
        run.alias("latest_processed_at"),
        "unique_chunks",
    )
    return summary.withColumns(
        {
            "overall_quality_assessment": R.quality_assessment("high_quality_pct"),
            "quality_recommendation": R.quality_recommendation(
                "anomaly_rate_pct", "poor_quality_pct", "avg_japanese_ratio", "content_pct"
            ),
            "summary_generated_at": run,
        }
    ).orderBy(F.when(F.col("dataset_name") == TOTAL, 1).otherwise(0), "dataset_name")


def content_start(prefix: int | None = None):
    """What stands for a text when counting how many different ones a group holds: the
    digest of the whole text, or its first `prefix` characters."""
    return digest("content_text") if prefix is None else F.left("content_text", F.lit(prefix))


def _content_group(df: DataFrame, source, keys, group, length, floor, unique) -> DataFrame:
    n = F.col(length)
    return df.groupBy(*keys).agg(
        F.min("source_dataset").alias("processing_source"),
        F.count(F.lit(1)).alias("total_items"),
        F.avg(n).alias("avg_length"),
        F.count_if(n >= floor).alias("substantial_content_count"),
        F.count_if(n < floor).alias("minimal_content_count"),
        F.count_distinct(unique).alias("unique_content_starts"),
        F.min("dbt_extracted_timestamp").alias("first_processed"),
        F.max("dbt_extracted_timestamp").alias("last_processed"),
    ).select(
        F.lit(source).alias("source"),
        F.col(group).alias("content_group"),
        "processing_source",
        "total_items",
        "avg_length",
        "substantial_content_count",
        "minimal_content_count",
        "unique_content_starts",
        "first_processed",
        "last_processed",
    )


def content_quality_metrics(
    web: DataFrame, articles: DataFrame, batch_id: str, run_ts: str
) -> DataFrame:
    """Quality score and tier per web domain and per article type."""
    groups = _content_group(
        web.withColumnRenamed("source_dataset", "_dataset").withColumn(
            "source_dataset", F.col("_dataset")
        ),
        V.WEB_KEY,
        ["url_domain", "_dataset"],
        "url_domain",
        "content_length",
        V.WEB_MEDIUM,
        F.col("content_start") if "content_start" in web.columns else content_start(),
    ).union(
        _content_group(
            articles,
            V.ARTICLE_KEY,
            ["article_type"],
            "article_type",
            "text_length",
            V.ARTICLE_STANDARD,
            F.col("article_id"),
        )
    )
    scored = (
        groups.filter("total_items > 0")
        .withColumn("avg_content_length", round_to("avg_length", 2))
        .withColumn("substantial_content_pct", percent("substantial_content_count", "total_items"))
        .withColumn("content_diversity_pct", percent("unique_content_starts", "total_items"))
        .withColumn(
            "quality_score",
            F.least(
                F.lit(100.0),
                round_to(
                    F.col("substantial_content_pct") * 0.6 + F.col("content_diversity_pct") * 0.4, 2
                ),
            ),
        )
        .withColumn("metrics_generated_at", F.lit(run_ts).cast("timestamp_ntz"))
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("quality_tier", R.quality_tier("quality_score"))
        .drop("avg_length")
    )
    return scored.orderBy("source", F.col("quality_score").desc_nulls_last())


def _web_totals(web: DataFrame) -> DataFrame:
    """Web totals over rows pre-grouped by domain and dataset, so that the two
    distinct counts see one row per combination."""
    category = F.col("content_length_category")
    combos = web.groupBy("url_domain", "source_dataset").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("content_length").alias("chars"),
        F.min("dbt_extracted_timestamp").alias("first"),
        F.max("dbt_extracted_timestamp").alias("last"),
        *[F.count_if(category == c).alias(c) for c in V.LENGTH_CATEGORIES],
    )
    none = F.lit(0).cast("long")
    return combos.agg(
        F.coalesce(F.sum("n"), none).alias("total_records"),
        F.sum("chars").alias("total_characters"),
        F.count_distinct("url_domain").alias("unique_domains"),
        F.count_distinct("source_dataset").alias("processing_sources"),
        F.min("first").alias("earliest_extraction"),
        F.max("last").alias("latest_extraction"),
        *[F.coalesce(F.sum(c), none).alias(f"{c}_content_count") for c in V.LENGTH_CATEGORIES],
    ).select(F.lit(V.WEB_KEY).alias("source_type"), "*")


def _article_totals(articles: DataFrame) -> DataFrame:
    size = F.col("article_size_category")
    return articles.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("text_length").alias("total_characters"),
        F.count_distinct("article_id").alias("unique_articles"),
        F.min("dbt_extracted_timestamp").alias("earliest_extraction"),
        F.max("dbt_extracted_timestamp").alias("latest_extraction"),
        F.count_if(size == "stub").alias("stubs"),
        F.count_if(size == "standard").alias("standards"),
        F.count_if(size.isin("detailed", "comprehensive")).alias("long_articles"),
    ).select(
        F.lit(V.ARTICLE_KEY).alias("source_type"),
        "total_records",
        "total_characters",
        "unique_articles",
        F.lit(1).cast("long").alias("processing_chunks"),
        "earliest_extraction",
        "latest_extraction",
        "stubs",
        "standards",
        "long_articles",
    )


def content_summary(web: DataFrame, articles: DataFrame, batch_id: str, run_ts: str) -> DataFrame:
    """One row per source. The two inputs line up by position, not by name."""
    combined = _web_totals(web).union(_article_totals(articles))
    return combined.select(
        "source_type",
        "total_records",
        "total_characters",
        round_to(ratio("total_characters", "total_records"), 2).alias("avg_content_length"),
        F.col("unique_domains").alias("unique_items"),
        "processing_sources",
        "earliest_extraction",
        "latest_extraction",
        *[f"{c}_content_count" for c in V.LENGTH_CATEGORIES],
        *[
            percent(f"{c}_content_count", "total_records").alias(f"{c}_content_pct")
            for c in V.LENGTH_CATEGORIES
        ],
        F.lit(run_ts).cast("timestamp_ntz").alias("summary_generated_at"),
        F.lit(batch_id).alias("batch_id"),
    )


def processing_summary(
    anomalies: DataFrame, batch_id: str, run_ts: str, used_delta_lake: bool = False
) -> DataFrame:
    """One row that sets the two datasets side by side and rates the run.

    A dataset that is absent counts as zero records with an unavailable,
    mocked analysis.
    """
    parts = []
    for key, dataset in ((V.WEB_KEY, V.WEB_DATASET), (V.ARTICLE_KEY, V.ARTICLE_DATASET)):
        here = F.col("dataset_name") == dataset
        take = lambda column, default, here=here: F.coalesce(
            F.max(F.when(here, F.col(column))), F.lit(default)
        )
        parts += [
            take("total_records", 0).alias(f"{key}_total_records"),
            take("avg_japanese_ratio", 0.0).alias(f"{key}_japanese_ratio"),
            take("overall_anomaly_rate", 0.0).alias(f"{key}_anomaly_rate"),
            take("analysis_method", "not_available").alias(f"{key}_analysis_method"),
            take("mock_mode", True).alias(f"{key}_mock_mode"),
        ]
    web, art = V.WEB_KEY, V.ARTICLE_KEY
    row = anomalies.agg(*parts)
    mocked = F.col(f"{web}_mock_mode"), F.col(f"{art}_mock_mode")
    compared = row.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(run_ts).cast("timestamp_ntz").alias("report_generated_at"),
        F.lit(used_delta_lake).alias("used_delta_lake"),
        "*",
        *[
            round_to(F.col(f"{key}_{name}") * 100, 2).alias(f"{key}_{label}_percentage")
            for key in (web, art)
            for name, label in (("japanese_ratio", "japanese"), ("anomaly_rate", "anomaly"))
        ],
        round_to(
            F.col(f"{web}_japanese_ratio") * 0.4
            + F.col(f"{art}_japanese_ratio") * 0.4
            + (1 - F.col(f"{web}_anomaly_rate")) * 0.1
            + (1 - F.col(f"{art}_anomaly_rate")) * 0.1,
            3,
        ).alias("overall_quality_score"),
        R.ladder(
            [
                (~mocked[0] & ~mocked[1], "full_real_analysis"),
                (~mocked[0] | ~mocked[1], "partial_real_analysis"),
            ],
            "mock_analysis_only",
        ).alias("analysis_reliability"),
        F.lit("delta_lake_processed" if used_delta_lake else "parquet_fallback").alias(
            "data_source_type"
        ),
    )
    return compared.select(
        "*",
        R.run_assessment("overall_quality_score").alias("quality_assessment"),
        R.run_recommendation(
            f"{web}_anomaly_percentage", f"{art}_anomaly_percentage", "analysis_reliability"
        ).alias("processing_recommendation"),
        (F.col(f"{web}_total_records") + F.col(f"{art}_total_records")).alias(
            "total_records_analyzed"
        ),
        round_to((F.col(f"{web}_japanese_ratio") + F.col(f"{art}_japanese_ratio")) / 2, 3).alias(
            "avg_japanese_ratio"
        ),
        round_to((F.col(f"{web}_anomaly_rate") + F.col(f"{art}_anomaly_rate")) / 2, 3).alias(
            "avg_anomaly_rate"
        ),
    )
