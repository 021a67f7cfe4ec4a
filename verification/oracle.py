"""The same results as plain SQL for DuckDB, written independently of the jobs.

Queries are assembled from named common table expressions; a query lists only
the ones it reads.
"""

from corpusloom import values as V
from corpusloom.sources.raw_views import (
    CHUNK_ROWS,
    FILL_EVERY,
    LONG_EVERY,
    LONG_TIMES,
    PREFIX,
)
from verification.queries import BATCH, CAP, MAX_CHUNKS, RUN_TS, SIZE

RUN = f"TIMESTAMP '{RUN_TS}'"
NARROW = "[ひらがな-んカタカナ-ヶ一-龯]"
FULL = r"[\p{Han}\p{Hiragana}\p{Katakana}]"
NL = "chr(10)"


def rnd(x, n):
    return f"round(({x})::DOUBLE, {n})"


def pct(a, b, n=2):
    return f"round(100.0::DOUBLE * ({a}) / nullif({b}, 0), {n})"


def marked(text):
    return f"CASE WHEN source = 'src5' THEN replace({text}, '|', chr(65533)) ELSE {text} END"


def script_text(text):
    m = marked(text)
    return f"""CASE lang WHEN 'es' THEN {m}
      WHEN 'fr' THEN ({m}) || repeat('{PREFIX}', n_chars // {FILL_EVERY['fr']})
      WHEN 'de' THEN chr(12288) || ({m}) || repeat('{PREFIX}', n_chars // {FILL_EVERY['de']}) || ' '
      ELSE '{PREFIX}' || ({m}) END"""


def stamp(key, hours=0):
    return f"(TIMESTAMP '2024-01-01' + to_seconds({key}) + INTERVAL {hours} HOUR)"


def web_part(text, url, key, table, hours=0):
    return f"""SELECT {text} AS text, {url} AS url, {stamp(key, hours)} AS "timestamp",
      '{V.WEB_DATASET}' AS _meta_dataset_name, {stamp(key, hours)} AS _dbt_extracted_at,
      '{V.SOURCE_TABLE}' AS _dbt_source_table, {key} // {CHUNK_ROWS} AS _meta_chunk_index,
      {key} AS _row_key FROM {table}"""


LONG_TEXT = f"(CASE WHEN doc_id % {LONG_EVERY} = 0 THEN repeat(text, {LONG_TIMES}) ELSE text END)"
PAGE_TEXT = f"'{PREFIX}' || html"

CTES = {
    "raw_web": (
        (),
        " UNION ALL ".join(
            [
                web_part(script_text(LONG_TEXT), "CAST(NULL AS VARCHAR)", "doc_id", "documents"),
                web_part(PAGE_TEXT, "url", "page_id", "pages"),
                web_part(PAGE_TEXT, "url", "page_id", "pages", 1),
            ]
        ),
    ),
    "raw_articles": (
        (),
        f"""SELECT doc_id::VARCHAR AS id,
      CASE source WHEN 'src0' THEN source || 'の一覧'
        WHEN 'src1' THEN '（' || source || ' disambiguation）'
        WHEN 'src2' THEN 'カテゴリ:' || source
        WHEN 'src3' THEN NULL
        ELSE source || '-' || doc_id::VARCHAR || chr(12288) END AS title,
      CASE WHEN source = 'src4' THEN '日本の redirect ' || ({script_text('text')})
        WHEN source = 'src6' THEN 'リダイレクト ' || ({script_text('text')})
        WHEN lang = 'fr' THEN '概要' || {NL} || {NL} || '== 一 ==' || {NL} || ({script_text('text')})
          || {NL} || '== 二 =='
        ELSE {script_text('text')} END AS text,
      '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {stamp('doc_id')} AS _dbt_extracted_at,
      '{V.SOURCE_TABLE}' AS _dbt_source_table, doc_id // {CHUNK_ROWS} AS _meta_chunk_index
    FROM documents""",
    ),
    "web_all": (
        ("raw_web",),
        f"""SELECT trim(text) AS content_text, coalesce(url, 'unknown') AS source_url,
      "timestamp" AS content_timestamp, _meta_dataset_name AS source_dataset,
      _dbt_extracted_at AS dbt_extracted_timestamp, _dbt_source_table AS dbt_source_table,
      length(trim(text)) AS content_length,
      CASE WHEN length(trim(text)) <= 100 THEN 'short' WHEN length(trim(text)) <= 1000 THEN 'medium'
        ELSE 'long' END AS content_length_category,
      regexp_matches(text, '{NARROW}') AS contains_japanese_chars,
      CASE WHEN url LIKE 'http%' THEN regexp_extract(url, 'https?://([^/]+)', 1) END AS url_domain,
      length(trim(text)) >= 10 AS is_valid_content,
      text AS raw_text, url AS raw_url, _row_key, _meta_chunk_index
    FROM raw_web WHERE text IS NOT NULL""",
    ),
    "web": (
        ("web_all",),
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_text, raw_url
        ORDER BY dbt_extracted_timestamp DESC, _row_key DESC) AS row_rank,
        {RUN} AS dbt_updated_at, '{BATCH}' AS dbt_batch_id FROM web_all) r
      WHERE row_rank = 1 AND is_valid_content AND contains_japanese_chars""",
    ),
    "articles_all": (
        ("raw_articles",),
        f"""SELECT id AS article_id, trim(title) AS article_title, trim(text) AS article_text,
      _meta_dataset_name AS source_dataset, _dbt_extracted_at AS dbt_extracted_timestamp,
      _dbt_source_table AS dbt_source_table, length(trim(text)) AS text_length,
      length(trim(title)) AS title_length,
      CASE WHEN length(trim(text)) <= 500 THEN 'stub' WHEN length(trim(text)) <= 2000 THEN 'standard'
        WHEN length(trim(text)) <= 10000 THEN 'detailed' ELSE 'comprehensive' END
        AS article_size_category,
      CASE WHEN title LIKE '%（%disambiguation%）' THEN 'disambiguation'
        WHEN title LIKE '%の一覧' THEN 'list' WHEN title LIKE 'カテゴリ:%' THEN 'category'
        ELSE 'article' END AS article_type,
      regexp_matches(text, '{NARROW}') AS contains_japanese_chars,
      (length(trim(text)) >= 50 AND trim(title) <> '' AND NOT contains(text, 'redirect')
        AND NOT contains(text, 'リダイレクト')) AS is_valid_article,
      split_part(text, {NL} || {NL}, 1) AS first_paragraph,
      (length(text) - length(replace(text, {NL} || '==', ''))) // 3 AS section_count_estimate,
      _meta_chunk_index
    FROM raw_articles WHERE id IS NOT NULL AND title IS NOT NULL AND text IS NOT NULL""",
    ),
    "articles": (
        ("articles_all",),
        f"""SELECT *, {RUN} AS dbt_updated_at, '{BATCH}' AS dbt_batch_id FROM articles_all
      WHERE is_valid_article AND contains_japanese_chars AND article_type = 'article'""",
    ),
}


def simple_rows(web, articles):
    return f"""SELECT content_text AS text, content_length AS text_length,
      CASE WHEN contains_japanese_chars THEN 0.8::DOUBLE ELSE 0.1::DOUBLE END AS japanese_ratio,
      CASE WHEN contains_japanese_chars THEN 0.2::DOUBLE ELSE 0.8::DOUBLE END AS ascii_ratio,
      source_dataset AS _meta_dataset_name FROM {web}
    UNION ALL SELECT article_text, text_length,
      CASE WHEN contains_japanese_chars THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END,
      CASE WHEN contains_japanese_chars THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END,
      source_dataset FROM {articles}"""


SCORE = """CASE WHEN text_length < 10 THEN 0 WHEN text_length > 50000 THEN 10
        WHEN japanese_ratio < 0.1::DOUBLE THEN 30 WHEN japanese_ratio < 0.3::DOUBLE THEN 50
        WHEN japanese_ratio < 0.5::DOUBLE THEN 70 ELSE 90 END"""
CLASS = """CASE WHEN text_length NOT BETWEEN 10 AND 50000 THEN 'poor'
        WHEN japanese_ratio < 0.3::DOUBLE THEN 'low' WHEN japanese_ratio < 0.5::DOUBLE THEN 'medium'
        ELSE 'high' END"""


def simple_model(rows):
    return f"""SELECT *, {SCORE} AS quality_score, {CLASS} AS quality_class,
      CASE WHEN text_length < 10 THEN 'ui_element' WHEN japanese_ratio < 0.1::DOUBLE THEN 'navigation'
        ELSE 'content' END AS content_type,
      CASE WHEN text_length NOT BETWEEN 10 AND 50000 OR japanese_ratio < 0.3::DOUBLE THEN 1 ELSE 0 END
        AS is_anomaly FROM ({rows}) s"""


def full_rows(web, articles):
    return f"""SELECT content_text AS text, content_length AS text_length,
      source_dataset AS _meta_dataset_name, _meta_chunk_index FROM {web}
    UNION ALL SELECT article_text, text_length, source_dataset, _meta_chunk_index FROM {articles}"""


def in_class(char_class):
    return f"length(regexp_replace(text, '[^{char_class}]+', '', 'g'))"


NAV = ", ".join(f"'{w}'" for w in V.NAV_WORDS)


def full_model(rows):
    return rf"""SELECT *, CASE WHEN is_too_short = 1 OR is_too_long = 1 OR has_encoding_issues = 1
        OR content_type <> 'content' OR japanese_ratio < 0.3::DOUBLE OR has_repetition = 1
        THEN 1 ELSE 0 END AS is_anomaly
    FROM (SELECT *, {SCORE} AS quality_score, {CLASS} AS quality_class,
      CASE WHEN text_length < 10 THEN 'ui_element'
        WHEN regexp_matches(text, '^[0-9年月日/.:\- ]+\z') THEN 'date_only'
        WHEN regexp_matches(text, '^[\p{{P}}\p{{S}} ]+\z') THEN 'punctuation_only'
        WHEN is_nav_word OR japanese_ratio < 0.1::DOUBLE THEN 'navigation'
        ELSE 'content' END AS content_type
    FROM (SELECT *, total_japanese_chars / nullif(text_length, 0) AS japanese_ratio,
      {in_class(r'\x00-\x7F')} / nullif(text_length, 0) AS ascii_ratio,
      {in_class(r' \t\r\n　')} / nullif(text_length, 0) AS whitespace_ratio,
      {in_class(r'\p{P}\p{S}')} / nullif(text_length, 0) AS symbol_ratio,
      CASE WHEN text_length < 10 THEN 1 ELSE 0 END AS is_too_short,
      CASE WHEN text_length > 50000 THEN 1 ELSE 0 END AS is_too_long,
      contains(text, chr(65533)) AS has_replacement_char,
      CASE WHEN contains(text, chr(65533)) THEN 1 ELSE 0 END AS has_encoding_issues,
      CASE WHEN len(lines) >= 4 AND len(list_distinct(lines)) / len(lines) < 0.7::DOUBLE THEN 1
        ELSE 0 END AS has_repetition,
      upper(trim(text)) IN ({NAV}) AS is_nav_word
    FROM (SELECT *, {in_class(V.SCRIPTS['narrow'])} AS total_japanese_chars,
      string_split(text, {NL}) AS lines FROM ({rows}) s0) s1) s2) s3"""


CTES.update(
    {
        "simple": (("web", "articles"), simple_model(simple_rows("web", "articles"))),
        "simple_all": (
            ("web_all", "articles_all"),
            simple_model(simple_rows("web_all", "articles_all")),
        ),
        "full_": (("web", "articles"), full_model(full_rows("web", "articles"))),
        "full_all": (
            ("web_all", "articles_all"),
            full_model(full_rows("web_all", "articles_all")),
        ),
    }
)

# ---- marts ----------------------------------------------------------------

COUNT_COLUMNS = [
    ("high_quality", "quality_class = 'high'"),
    ("medium_quality", "quality_class = 'medium'"),
    ("low_quality", "quality_class = 'low'"),
    ("poor_quality", "quality_class = 'poor'"),
    ("anomaly", "is_anomaly = 1"),
    ("too_short", "text_length < 10"),
    ("too_long", "text_length > 50000"),
    ("encoding_issues", "has_encoding_issues = 1"),
    ("repetition", "has_repetition = 1"),
    ("content", "content_type = 'content'"),
    ("navigation", "content_type = 'navigation'"),
    ("ui_element", "content_type = 'ui_element'"),
    ("date_only", "content_type = 'date_only'"),
    ("punctuation_only", "content_type = 'punctuation_only'"),
]


def summary_model(quality, full):
    zero = () if full else ("encoding_issues", "repetition", "date_only", "punctuation_only")
    counts = ", ".join(
        f"{'0' if n in zero else f'count(*) FILTER (WHERE {c})'}::BIGINT AS {n}"
        for n, c in COUNT_COLUMNS
    )
    stats = ", ".join(
        f"min({c}) AS min_{s}, max({c}) AS max_{s}, median({c}::DOUBLE) AS med_{s}, sum({c}::DOUBLE) AS sum_{s}"
        for s, c in (("len", "text_length"), ("ratio", "japanese_ratio"), ("score", "quality_score"))
    )
    chunks = "count(DISTINCT _meta_chunk_index)" if full else "1::BIGINT"
    names = [n for n, _ in COUNT_COLUMNS]
    folded = ", ".join(f"sum({n})::BIGINT" for n in names)
    stat_fold = ", ".join(
        f"min(min_{s}), max(max_{s}), NULL::DOUBLE, sum(sum_{s})" for s in ("len", "ratio", "score")
    )
    label = {"anomaly": "anomaly_rate_pct"}
    shares = ", ".join(f"{pct(n, 'n')} AS {label.get(n, n + '_pct')}" for n in names)
    return f"""SELECT *, CASE WHEN high_quality_pct >= 70 THEN 'Excellent'
        WHEN high_quality_pct >= 50 THEN 'Good' WHEN high_quality_pct >= 30 THEN 'Fair'
        ELSE 'Poor' END AS overall_quality_assessment,
      CASE WHEN anomaly_rate_pct > 30 THEN 'High anomaly rate - Review data sources'
        WHEN poor_quality_pct > 20 THEN 'High poor quality rate - Enhance filtering'
        WHEN avg_japanese_ratio < 0.5::DOUBLE
          THEN 'Low Japanese content - Review language detection'
        WHEN content_pct < 80 THEN 'High non-content ratio - Improve content extraction'
        ELSE 'Data quality is acceptable' END AS quality_recommendation,
      {RUN} AS summary_generated_at
    FROM (SELECT dataset_name, n AS total_records, {shares},
      {rnd('sum_len / n', 0)} AS avg_text_length, min_len AS min_text_length,
      max_len AS max_text_length, med_len AS median_text_length,
      {rnd('sum_ratio / n', 3)} AS avg_japanese_ratio,
      {rnd('min_ratio', 3)} AS min_japanese_ratio, {rnd('max_ratio', 3)} AS max_japanese_ratio,
      {rnd('med_ratio', 3)} AS median_japanese_ratio,
      {rnd('sum_score / n', 1)} AS avg_quality_score, min_score AS min_quality_score,
      max_score AS max_quality_score, {rnd('med_score', 1)} AS median_quality_score,
      {RUN} AS earliest_processed_at, {RUN} AS latest_processed_at, unique_chunks
    FROM (SELECT _meta_dataset_name AS dataset_name, count(*) AS n, {counts}, {stats},
        {chunks} AS unique_chunks FROM {quality} GROUP BY 1
      UNION ALL SELECT 'TOTAL', sum(n)::BIGINT, {folded}, {stat_fold}, sum(unique_chunks)::BIGINT
      FROM (SELECT _meta_dataset_name, count(*) AS n, {counts}, {stats},
        {chunks} AS unique_chunks FROM {quality} GROUP BY 1) g) t) u"""


CTES["summary"] = (("simple",), summary_model("simple", False))
CTES["summary_full"] = (("full_",), summary_model("full_", True))

CTES["anomalies"] = (
    ("simple_all",),
    f"""SELECT _meta_dataset_name AS dataset_name, 1::BIGINT AS tables_processed,
      count(*) AS total_records, sum(is_anomaly)::BIGINT AS total_anomalies,
      {rnd('sum(is_anomaly) / count(*)', 6)} AS overall_anomaly_rate,
      {rnd('avg(japanese_ratio)', 6)} AS avg_japanese_ratio, 'parquet_analysis' AS format,
      'full_scan' AS analysis_method, false AS mock_mode,
      {rnd('avg(japanese_ratio) * 0.6::DOUBLE + (1.0::DOUBLE - sum(is_anomaly)::DOUBLE / count(*)) * 0.4::DOUBLE', 6)}
        AS quality_score
    FROM simple_all GROUP BY 1""",
)


def web_group():
    return """SELECT 'fineweb' AS source, url_domain AS content_group, source_dataset AS processing_source,
      count(*) AS total_items, sum(content_length) AS chars,
      count(*) FILTER (WHERE content_length >= 100) AS substantial_content_count,
      count(*) FILTER (WHERE content_length < 100) AS minimal_content_count,
      count(DISTINCT content_text) AS unique_content_starts,
      min(dbt_extracted_timestamp) AS first_processed, max(dbt_extracted_timestamp) AS last_processed
    FROM web GROUP BY url_domain, source_dataset"""


def article_group():
    return """SELECT 'wikipedia', article_type, min(source_dataset), count(*), sum(text_length),
      count(*) FILTER (WHERE text_length >= 500), count(*) FILTER (WHERE text_length < 500),
      count(DISTINCT article_id), min(dbt_extracted_timestamp), max(dbt_extracted_timestamp)
    FROM articles GROUP BY article_type"""


def summary_counts(table, length, category, labels, unique, sources, source):
    tail = ", ".join(
        f"count(*) FILTER (WHERE {category} IN ({v})) AS {n}_content_count" for n, v in labels
    )
    return f"""SELECT '{source}' AS source_type, count(*) AS total_records,
      sum({length})::BIGINT AS total_characters, count(DISTINCT {unique}) AS unique_items,
      {sources} AS processing_sources, min(dbt_extracted_timestamp) AS earliest_extraction,
      max(dbt_extracted_timestamp) AS latest_extraction, {tail} FROM {table}"""


# ---- checks ---------------------------------------------------------------


def check(name, description, failing, source):
    return f"""SELECT '{name}' AS test_name, ({failing})::BIGINT AS failing_records,
      '{description}' AS test_description FROM {source}"""


def rows_where(condition):
    return f"count(*) FILTER (WHERE {condition})"


def not_null(model, source, columns):
    return [
        check(f"not_null_{model}_{c}", f"{c} must not be NULL", rows_where(f"{c} IS NULL"), source)
        for c in columns
    ]


def accepted(model, source, column, values):
    shown = ", ".join(v if v in ("true", "false") or str(v).isdigit() else f"'{v}'" for v in values)
    return check(
        f"accepted_values_{model}_{column}",
        f"{column} must be a listed value",
        rows_where(f"{column} NOT IN ({shown})"),
        source,
    )


def in_range(model, source, column, low, high):
    text = f"be at least {low}" if high is None else f"be between {low} and {high}"
    wrong = f"{column} < {low}" if high is None else f"{column} NOT BETWEEN {low} AND {high}"
    return check(f"accepted_range_{model}_{column}", f"{column} must {text}", rows_where(wrong), source)


def uniq(model, source, key):
    return f"""SELECT 'unique_{model}_{key}' AS test_name, count(*) AS failing_records,
      '{key} must be unique' AS test_description
    FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1) d"""


BANDS = """(quality_class = 'high' AND quality_score < 70)
  OR (quality_class = 'medium' AND quality_score NOT BETWEEN 50 AND 89)
  OR (quality_class = 'low' AND quality_score NOT BETWEEN 30 AND 69)
  OR (quality_class = 'poor' AND quality_score >= 50)"""

RECORD_CHECKS = {
    "check_high_quality_ratio": (
        "high_quality_japanese_ratio",
        "High quality records should have Japanese ratio >= 0.5",
        "quality_class = 'high' AND japanese_ratio < 0.5::DOUBLE",
    ),
    "check_content_type": (
        "content_type_classification",
        "Navigation elements should not be classified as content",
        f"content_type = 'content' AND upper(trim(text)) IN ({NAV})",
    ),
    "check_encoding": (
        "encoding_issues_detection",
        "Replacement characters should be flagged as encoding issues",
        "has_encoding_issues = 0 AND contains(text, chr(65533))",
    ),
    "check_score_band": (
        "quality_score_consistency",
        "Quality scores should align with quality classifications",
        BANDS,
    ),
    "check_length_flags": (
        "text_length_validation",
        "Text length flags should match actual lengths",
        "(is_too_short = 1 AND text_length >= 10) OR (is_too_long = 1 AND text_length <= 50000)",
    ),
    "check_char_count": (
        "japanese_character_counting",
        "Japanese character count cannot exceed total text length",
        "total_japanese_chars > text_length",
    ),
    "check_ratios": (
        "ratio_calculations",
        "All ratios should be between 0 and 1",
        " OR ".join(
            f"{c}_ratio NOT BETWEEN 0 AND 1" for c in ("japanese", "ascii", "symbol", "whitespace")
        ),
    ),
    "check_anomaly_flag": (
        "anomaly_detection_consistency",
        "Anomaly flag should match individual quality flags",
        """(is_anomaly = 1) <> (is_too_short = 1 OR is_too_long = 1 OR has_encoding_issues = 1
          OR content_type <> 'content' OR japanese_ratio < 0.3::DOUBLE OR has_repetition = 1)""",
    ),
}

STRUCTURE = check(
    "quality_checks_structure",
    "Quality score should be between 0 and 100",
    rows_where("quality_score NOT BETWEEN 0 AND 100"),
    "full_",
)
SUMMARY_CHECK = check(
    "summary_data_integrity",
    "Summary percentages and totals should be valid",
    rows_where(
        """total_records <= 0
      OR high_quality_pct + medium_quality_pct + low_quality_pct + poor_quality_pct > 100.1
      OR anomaly_rate_pct NOT BETWEEN 0 AND 100 OR avg_japanese_ratio NOT BETWEEN 0 AND 1
      OR avg_quality_score NOT BETWEEN 0 AND 100"""
    ),
    "summary_full",
)
COMPLETENESS = f"""SELECT 'dataset_completeness' AS test_name, count(*) AS failing_records,
  'All expected datasets should have records' AS test_description
FROM (VALUES ('{V.WEB_DATASET}'), ('{V.ARTICLE_DATASET}')) e(name)
WHERE NOT EXISTS (SELECT 1 FROM summary_full s WHERE s.dataset_name = e.name AND s.total_records > 0)"""
FRESH = [
    check(
        f"data_freshness_{key}",
        f"{title} data should be processed within last 7 days",
        rows_where(f"dbt_extracted_timestamp < {RUN} - INTERVAL 7 DAY"),
        source,
    )
    for key, title, source in (("fineweb", "FineWeb", "web"), ("wikipedia", "Wikipedia", "articles"))
]
SOURCE_REF = check(
    "foreign_key_integrity",
    "Source dataset references should be valid",
    rows_where("source_dataset IS NULL OR source_dataset = ''"),
    "web",
)
PRIMARY_KEY = check(
    "primary_key_uniqueness",
    "Wikipedia article IDs should be unique",
    "count(*) - count(DISTINCT article_id)",
    "articles",
)
TYPES = """SELECT 'data_type_consistency' AS test_name, count(DISTINCT t) - 1 AS failing_records,
  'Common columns should have consistent data types' AS test_description
FROM (SELECT typeof(content_length) AS t FROM web UNION ALL SELECT typeof(text_length) FROM articles) x"""
TOTALS = """SELECT 'aggregation_consistency' AS test_name,
  (CASE WHEN (SELECT count(*) FROM full_) <>
    (SELECT sum(total_records) FROM summary_full WHERE dataset_name <> 'TOTAL') THEN 1 ELSE 0 END)::BIGINT
  AS failing_records, 'Summary totals should match individual record counts' AS test_description"""
WEB_SHAPE = [
    check(
        "timestamp_validity",
        "Processing timestamps should not be null",
        rows_where("dbt_extracted_timestamp IS NULL OR dbt_updated_at IS NULL"),
        "web",
    ),
    check(
        "numeric_range_validation",
        "Content length should be positive and reasonable",
        rows_where("content_length NOT BETWEEN 0 AND 1000000"),
        "web",
    ),
    check(
        "boolean_validation",
        "Boolean flags should have valid values",
        rows_where("contains_japanese_chars IS NULL OR is_valid_content IS NULL"),
        "web",
    ),
    SOURCE_REF,
    check(
        "categorical_validation",
        "Content length categories should have valid values",
        rows_where("content_length_category NOT IN ('short', 'medium', 'long')"),
        "web",
    ),
]

NOT_NULL_WEB = [
    "content_text", "source_url", "source_dataset", "content_length", "content_length_category",
    "contains_japanese_chars", "is_valid_content", "row_rank", "dbt_updated_at", "dbt_batch_id",
    "dbt_extracted_timestamp",
]
NOT_NULL_ARTICLES = [
    "article_id", "article_title", "article_text", "source_dataset", "text_length", "title_length",
    "article_size_category", "article_type", "contains_japanese_chars", "is_valid_article",
    "section_count_estimate",
]
NOT_NULL_QUALITY = [
    "text", "text_length", "japanese_ratio", "ascii_ratio", "quality_score", "quality_class",
    "content_type", "is_anomaly", "_meta_dataset_name",
]
NOT_NULL_SUMMARY = [
    "dataset_name", "total_records", "high_quality_pct", "medium_quality_pct", "low_quality_pct",
    "poor_quality_pct", "anomaly_rate_pct", "avg_japanese_ratio", "avg_quality_score",
    "overall_quality_assessment", "quality_recommendation", "summary_generated_at",
]
BOOLS = ["true", "false"]


def web_accepted(source):
    return [
        accepted("stg_web", source, "source_dataset", [V.WEB_DATASET]),
        accepted("stg_web", source, "content_length_category", ["short", "medium", "long"]),
        accepted("stg_web", source, "contains_japanese_chars", BOOLS),
        accepted("stg_web", source, "is_valid_content", BOOLS),
    ]


def article_accepted(source):
    return [
        accepted("stg_articles", source, "source_dataset", [V.ARTICLE_DATASET]),
        accepted(
            "stg_articles", source, "article_size_category",
            ["stub", "standard", "detailed", "comprehensive"],
        ),
        accepted(
            "stg_articles", source, "article_type",
            ["article", "disambiguation", "list", "category"],
        ),
        accepted("stg_articles", source, "contains_japanese_chars", BOOLS),
        accepted("stg_articles", source, "is_valid_article", BOOLS),
    ]


def quality_accepted(source):
    return [
        accepted("quality_checks", source, "quality_class", ["poor", "low", "medium", "high"]),
        accepted(
            "quality_checks", source, "content_type",
            ["content", "navigation", "ui_element", "date_only", "punctuation_only"],
        ),
        accepted("quality_checks", source, "is_anomaly", ["0", "1"]),
        accepted("quality_checks", source, "_meta_dataset_name", [V.WEB_DATASET, V.ARTICLE_DATASET]),
    ]


def article_ranges(source):
    return [
        in_range("stg_articles", source, "text_length", 50, 2000000),
        in_range("stg_articles", source, "title_length", 1, 500),
        in_range("stg_articles", source, "section_count_estimate", 0, 1000),
    ]


def quality_ranges(source):
    return [
        in_range("quality_checks", source, "text_length", 1, 2000000),
        in_range("quality_checks", source, "japanese_ratio", 0.0, 1.0),
        in_range("quality_checks", source, "ascii_ratio", 0.0, 1.0),
        in_range("quality_checks", source, "quality_score", 0, 100),
    ]


def union(*parts):
    flat = []
    for p in parts:
        flat.extend(p if isinstance(p, list) else [p])
    return " UNION ALL ".join(f"({p})" for p in flat)


SUITE_ROWS = union(
    [check(n, d, rows_where(c), "full_") for n, d, c in RECORD_CHECKS.values()],
    STRUCTURE,
    not_null("quality_checks", "full_", NOT_NULL_QUALITY),
    quality_accepted("full_"),
    quality_ranges("full_"),
    SUMMARY_CHECK,
    not_null("dataset_quality_summary", "summary_full", NOT_NULL_SUMMARY),
    accepted(
        "dataset_quality_summary", "summary_full", "dataset_name",
        [V.WEB_DATASET, V.ARTICLE_DATASET, "TOTAL"],
    ),
    accepted(
        "dataset_quality_summary", "summary_full", "overall_quality_assessment",
        ["Excellent", "Good", "Fair", "Poor"],
    ),
    [in_range("dataset_quality_summary", "summary_full", "total_records", 0, None)],
    [
        in_range("dataset_quality_summary", "summary_full", c, 0.0, 100.0)
        for c in (
            "high_quality_pct", "medium_quality_pct", "low_quality_pct", "poor_quality_pct",
            "anomaly_rate_pct",
        )
    ],
    in_range("dataset_quality_summary", "summary_full", "avg_japanese_ratio", 0.0, 1.0),
    in_range("dataset_quality_summary", "summary_full", "avg_quality_score", 0.0, 100.0),
    WEB_SHAPE,
    FRESH,
    not_null("stg_web", "web", NOT_NULL_WEB),
    web_accepted("web"),
    in_range("stg_web", "web", "content_length", 10, 1000000),
    in_range("stg_web", "web", "row_rank", 1, 100),
    not_null("stg_articles", "articles", NOT_NULL_ARTICLES),
    article_accepted("articles"),
    article_ranges("articles"),
    COMPLETENESS,
    check("missing_required_columns", "Required columns must be present in staging models", "0", "(SELECT 1) one"),
    TYPES,
    PRIMARY_KEY,
    uniq("stg_articles", "articles", "article_id"),
    TOTALS,
    not_null("content_summary", "mart_contents", ["total_records", "avg_content_length"]),
    in_range("content_summary", "mart_contents", "total_records", 0, None),
    in_range("content_summary", "mart_contents", "avg_content_length", 0, 100000),
    not_null("content_quality_metrics", "mart_metrics", ["source", "quality_tier"]),
    accepted("content_quality_metrics", "mart_metrics", "quality_tier", ["high", "medium", "low", "poor"]),
)
WARNING = [n for n, _, _ in RECORD_CHECKS.values()] + [
    "summary_data_integrity", "dataset_completeness", "data_freshness_fineweb",
    "data_freshness_wikipedia",
]
SUITE = f"""SELECT *, CASE WHEN failing_records = 0 THEN 'pass' ELSE severity END AS status
FROM (SELECT *, CASE WHEN test_name IN ({', '.join(f"'{w}'" for w in WARNING)}) THEN 'warn'
  ELSE 'error' END AS severity FROM ({SUITE_ROWS}) a) b"""

# ---- sources --------------------------------------------------------------


def drift(source, columns):
    """Expected and found types of a table; `!` marks columns that it does not have."""
    rows = []
    for column in columns.split():
        name, expected = column.rstrip("!").split(":")
        want = f"'{expected}'" if expected else "NULL"
        have = "NULL" if column.endswith("!") else f"typeof(any_value({name}))"
        rows.append(f"SELECT '{name}' AS column_name, {want}::VARCHAR AS expected_type, {have}::VARCHAR AS kind, count(*) AS records FROM {source}")
    return f"""SELECT '{source}' AS source, column_name, expected_type, found_type, records,
      CASE WHEN found_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'extra'
        WHEN found_type <> expected_type THEN 'type' END AS problem
    FROM (SELECT *, CASE kind WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS found_type FROM ({' UNION ALL '.join(rows)}) r) t"""


# ---- chunks ---------------------------------------------------------------

ARTICLE_SHORT = "wikipedia_20231101.ja"


def plan(total):
    return f"""SELECT 'wikipedia' AS dataset_key, i AS chunk_index, i * {SIZE} AS start_idx,
      least((i + 1) * {SIZE}, n) AS end_idx, '{V.ARTICLE_DATASET}' AS dataset_name,
      '{V.ARTICLE_CONFIG}' AS config_name, 500::BIGINT AS batch_size,
      least((i + 1) * {SIZE}, n) - i * {SIZE} AS expected_size
    FROM (SELECT n, unnest(range(0, (n + {SIZE - 1}) // {SIZE})) AS i FROM ({total}) t) u"""


CTES["plan"] = ((), plan("SELECT count(*) AS n FROM documents"))
CTES["ordered"] = ((), "SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents")
CTES["pages_ordered"] = ((), "SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS ordinal FROM pages")
PATH = f"'raw/{ARTICLE_SHORT}/chunk_' || lpad(chunk_index::VARCHAR, 6, '0') || '_' || start_idx || '_' || end_idx || '.parquet'"
ANNOUNCED = """SELECT 2 * (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS n"""
CTES["big_plan"] = ((), plan(ANNOUNCED))

SUMMARY_COLUMNS = """count(*) AS total_chunks, count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status = 'write_failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped,
  count(*) FILTER (WHERE status = 'no_data') AS no_data,
  coalesce(sum(records) FILTER (WHERE status = 'success'), 0)::BIGINT AS total_records,
  round(coalesce(avg(records / expected_size) FILTER (WHERE status = 'success'), 0.0)::DOUBLE, 6)
    AS average_efficiency"""
CTES["manifest"] = (
    ("plan",),
    f"""SELECT 'wikipedia' AS dataset_key, chunk_index, expected_size,
      CASE WHEN chunk_index % 7 = 3 THEN 'no_data' WHEN chunk_index % 5 = 1 THEN 'write_failed'
        ELSE 'success' END AS status,
      CASE WHEN chunk_index % 7 = 3 THEN 0 WHEN chunk_index % 5 = 1 THEN expected_size - 1
        ELSE expected_size END AS records FROM plan
    UNION ALL SELECT 'fineweb', i, least({SIZE}, n - i * {SIZE}), 'success',
      least({SIZE}, n - i * {SIZE})
    FROM (SELECT n, unnest(range(0, (n + {SIZE - 1}) // {SIZE})) AS i
      FROM (SELECT count(*) AS n FROM pages) c) d""",
)

# ---- all queries ----------------------------------------------------------

CHANGED = "CASE WHEN o_orderstatus = 'O' THEN 'REVISED' ELSE o_orderpriority END"

QUERIES = {
    "scan_project": ((), "SELECT text, doc_id AS id, source AS title FROM documents"),
    "range_slice": (
        ("ordered",),
        "SELECT doc_id, lang, text, ordinal FROM ordered ORDER BY ordinal LIMIT 100 OFFSET 50",
    ),
    "chunk_plan": (("plan",), "SELECT * FROM plan"),
    "chunk_limit": (
        ("ordered",),
        f"SELECT doc_id, ordinal // {SIZE} AS chunk_index, text FROM ordered WHERE ordinal < {SIZE * MAX_CHUNKS}",
    ),
    "chunk_row_cap": (
        ("ordered",),
        f"""SELECT doc_id, ordinal // {SIZE} AS chunk_index, ordinal // {SIZE} * {SIZE} AS start_idx,
          n_chars FROM ordered WHERE ordinal % {SIZE} < {CAP}""",
    ),
    "chunk_validate": (
        ("ordered",),
        f"""SELECT ordinal // {SIZE} AS chunk_index, count(*) AS actual_records,
          count(*) FILTER (WHERE lang = 'en') AS null_texts, count(*) >= 1 AS valid,
          count(*) FILTER (WHERE lang = 'en') > count(*) / 2 AS warn_null_text
        FROM ordered GROUP BY 1""",
    ),
    "stamp_metadata": (
        ("ordered",),
        f"""SELECT doc_id, text, '{V.ARTICLE_DATASET}' AS _meta_dataset_name,
          '{V.ARTICLE_CONFIG}' AS _meta_config_name, ordinal // {SIZE} AS _meta_chunk_index,
          ordinal // {SIZE} * {SIZE} AS _meta_start_idx,
          least((ordinal // {SIZE} + 1) * {SIZE}, (SELECT count(*) FROM documents)) AS _meta_end_idx FROM ordered""",
    ),
    "chunk_key": (("plan",), f"SELECT chunk_index, {PATH} AS parquet_path FROM plan"),
    "pending_chunks": (
        ("plan",),
        f"""SELECT dataset_key, chunk_index, start_idx, end_idx, expected_size FROM plan
        WHERE chunk_index % 3 = 0""",
    ),
    "table_write_roundtrip": ((), f"SELECT *, {RUN} AS _processing_timestamp FROM orders"),
    "upsert": (
        (),
        f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          {CHANGED} AS o_orderpriority FROM orders
        UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "chunk_replace": (
        (),
        """SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
          ELSE o_totalprice END AS o_totalprice), o_orderpriority AS chunk FROM orders""",
    ),
    "chunk_manifest": (
        ("big_plan",),
        f"""SELECT dataset_key, chunk_index, start_idx, end_idx, expected_size,
          CASE WHEN records > 0 THEN 'success' ELSE 'no_data' END AS status, records,
          CASE WHEN records > 0 THEN {PATH} END AS parquet_path, NULL::VARCHAR AS error,
          false AS warn_null_text
        FROM (SELECT *, greatest(0, least(start_idx + {SIZE}, (SELECT count(*) FROM documents))
          - start_idx) AS records FROM big_plan) m""",
    ),
    "run_summary": (
        ("manifest",),
        f"""SELECT dataset_key, {SUMMARY_COLUMNS} FROM manifest GROUP BY 1
        UNION ALL SELECT 'TOTAL', {SUMMARY_COLUMNS} FROM manifest""",
    ),
    "load_raw": (
        ("ordered",),
        f"""SELECT doc_id::VARCHAR AS id, source AS title, text,
          '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {RUN} AS _dbt_extracted_at,
          '{V.SOURCE_TABLE}' AS _dbt_source_table FROM ordered""",
    ),
    "chunk_resume": (
        ("ordered",),
        f"""SELECT doc_id::VARCHAR AS id, source AS title, text,
          '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {RUN} AS _dbt_extracted_at,
          '{V.SOURCE_TABLE}' AS _dbt_source_table FROM ordered""",
    ),
    "filtered_ingest": (
        ("ordered",),
        f"""SELECT doc_id::VARCHAR AS id, source AS title, text,
          '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {RUN} AS _dbt_extracted_at,
          '{V.SOURCE_TABLE}' AS _dbt_source_table, ordinal // {SIZE} AS _meta_chunk_index
        FROM ordered WHERE lang = 'de'""",
    ),
    "failed_chunks": (
        ("manifest",),
        """SELECT dataset_key, chunk_index, status,
          'stored ' || records || ' of ' || expected_size || ' records' AS error
        FROM manifest WHERE status = 'write_failed'""",
    ),
    "fallback_row": (
        (),
        f"""SELECT doc_id::VARCHAR AS id, source AS title, text,
          CAST(NULL AS VARCHAR) AS _meta_dataset_name, CAST(NULL AS TIMESTAMP) AS _dbt_extracted_at,
          CAST(NULL AS VARCHAR) AS _dbt_source_table FROM documents
        UNION ALL SELECT '{V.ARTICLE_FALLBACK['id']}', '{V.ARTICLE_FALLBACK['title']}',
          '{V.ARTICLE_FALLBACK['text']}', '{V.ARTICLE_DATASET}', {RUN}, '{V.SOURCE_TABLE}'
        WHERE NOT EXISTS (SELECT 1 FROM documents WHERE text IS NULL)""",
    ),
    "field_defaults": (
        ("ordered", "pages_ordered"),
        f"""SELECT page_id::VARCHAR AS id, 'Title ' || ordinal AS title, 'Content ' || ordinal AS text,
          CAST(NULL AS VARCHAR) AS url, CAST(NULL AS TIMESTAMP) AS "timestamp",
          '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {RUN} AS _dbt_extracted_at,
          '{V.SOURCE_TABLE}' AS _dbt_source_table FROM pages_ordered
        UNION ALL SELECT NULL, NULL, text, 'https://example.com/' || ordinal, {RUN},
          '{V.WEB_DATASET}', {RUN}, '{V.SOURCE_TABLE}' FROM ordered""",
    ),
    "direct_load_limited": (
        ("ordered", "pages_ordered"),
        f"""SELECT doc_id::VARCHAR AS id, source AS title, text, NULL::VARCHAR AS url, NULL::TIMESTAMP AS "timestamp",
          '{V.ARTICLE_DATASET}' AS _meta_dataset_name, {RUN} AS _dbt_extracted_at,
          '{V.SOURCE_TABLE}' AS _dbt_source_table FROM ordered WHERE ordinal < 150
        UNION ALL SELECT NULL, NULL, html, url, {RUN}, '{V.WEB_DATASET}', {RUN}, '{V.SOURCE_TABLE}'
          FROM pages_ordered WHERE ordinal < 75""",
    ),
    "catalog_tables": (
        (),
        """SELECT format, o_orderkey, o_orderstatus, o_totalprice, false AS old_exists
          FROM orders, (VALUES ('table'), ('parquet'), ('orc'), ('json')) f(format)""",
    ),
    "source_contract": (
        (),
        " UNION ALL ".join(
            drift(source, columns)
            for source, columns in (
                ("documents", "doc_id:bigint text:string lang:string source:string n_chars:int url:string!"),
                ("pages", "page_id:bigint url:string html:string fetched:timestamp!"),
                ("conversations", "conv_id:string turn:bigint role:string text:string"),
                (
                    "orders",
                    "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double"
                    " o_orderdate: o_orderpriority:",
                ),
            )
        ),
    ),
    "example_models": (
        (),
        union(
            not_null("first_model", "(SELECT doc_id AS id FROM documents UNION ALL SELECT NULL) m", ["id"]),
            uniq("first_model", "(SELECT doc_id AS id FROM documents UNION ALL SELECT NULL) m", "id"),
            not_null("second_model", "(SELECT doc_id AS id FROM documents) m", ["id"]),
            uniq("second_model", "(SELECT doc_id AS id FROM documents) m", "id"),
        ),
    ),
    "preview": (
        (),
        "SELECT doc_id, left(text, 80) || '...' AS text_preview FROM documents ORDER BY doc_id LIMIT 3",
    ),
    "union_by_name": (
        (),
        """SELECT text, doc_id AS id, source AS title, CAST(NULL AS VARCHAR) AS url FROM documents
        UNION ALL SELECT html, page_id, NULL, url FROM pages""",
    ),
    "union_positional": (
        ("raw_web", "raw_articles"),
        """SELECT url, count(*) AS records, max(_row_key) AS last_key FROM raw_web GROUP BY 1
        UNION ALL SELECT title, count(*), max(id::BIGINT) FROM raw_articles GROUP BY 1""",
    ),
    "filter_not_null": (
        ("raw_articles",),
        "SELECT id, title FROM raw_articles WHERE NOT (id IS NULL OR title IS NULL OR text IS NULL)",
    ),
    "length_category": (
        ("web_all",),
        "SELECT _row_key, content_length, content_length_category FROM web_all",
    ),
    "article_size": (
        ("articles_all",),
        "SELECT article_id, text_length, article_size_category FROM articles_all",
    ),
    "article_type": (
        ("articles_all",),
        "SELECT article_id, article_title, article_type FROM articles_all",
    ),
    "valid_content": (("web_all",), "SELECT _row_key, content_length, is_valid_content FROM web_all"),
    "valid_article": (
        ("articles_all",),
        "SELECT article_id, text_length, is_valid_article FROM articles_all",
    ),
    "text_functions": (
        ("raw_web",),
        f"""SELECT trim(text) AS trimmed, length(text) AS n_chars, coalesce(url, 'unknown') AS source_url,
          regexp_matches(text, '{NARROW}') AS narrow_script, regexp_matches(text, '{FULL}') AS full_script,
          regexp_matches(text, '[äöüß]') AS umlauts,
          CASE WHEN url LIKE 'http%' THEN regexp_extract(url, 'https?://([^/]+)', 1) END AS url_domain,
          url LIKE 'https:%' AS is_https, _row_key::VARCHAR AS row_key,
          split_part(text, {NL}, 1) AS first_line,
          (length(text) - length(replace(text, '##', ''))) // 2 AS hash_marks,
          left(text, 50) AS start_50, upper(trim(text)) AS upper_text,
          left(text, 80) || '...' AS preview, 'fineweb-2' AS dataset_short,
          'raw/fineweb-2/chunk_' || lpad(_meta_chunk_index::VARCHAR, 6, '0') || '_' ||
            _meta_chunk_index * {SIZE} || '_' || (_meta_chunk_index + 1) * {SIZE} || '.parquet' AS path
        FROM raw_web""",
    ),
    "rounding": (
        (),
        f"""SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS price_2,
          round(l_extendedprice * l_discount, 3) AS discount_3, round(l_extendedprice, 0) AS price_0,
          least(100.0::DOUBLE, round(l_extendedprice / 500, 2)) AS capped,
          {pct('l_quantity', 'l_linenumber - 1')} AS share, ceil(l_quantity / 7)::BIGINT AS chunks
        FROM lineitem""",
    ),
    "global_summary": (
        ("web_all",),
        f"""SELECT count(*) AS total_records, sum(content_length)::BIGINT AS total_characters,
          {rnd('avg(content_length)', 2)} AS avg_length, min(content_length) AS min_length,
          max(content_length) AS max_length, min(dbt_extracted_timestamp) AS earliest_extraction,
          max(dbt_extracted_timestamp) AS latest_extraction FROM web_all""",
    ),
    "group_summary": (
        ("web_all",),
        f"""SELECT url_domain, source_dataset, count(*) AS total_items,
          sum(content_length)::BIGINT AS total_characters, {rnd('avg(content_length)', 2)} AS avg_length,
          max(content_length) AS max_length FROM web_all GROUP BY 1, 2""",
    ),
    "conditional_counts": (
        ("web_all",),
        """SELECT source_url, count(CASE WHEN content_length <= 100 THEN 1 END) AS short_count,
          count(CASE WHEN content_length BETWEEN 101 AND 1000 THEN 1 END) AS medium_count,
          count(CASE WHEN content_length > 1000 THEN 1 END) AS long_count,
          count(CASE WHEN contains_japanese_chars THEN 1 END) AS script_count,
          sum(CASE WHEN is_valid_content THEN 0 ELSE 1 END)::BIGINT AS invalid_count
        FROM web_all GROUP BY 1""",
    ),
    "distinct_counts": (
        ("web_all",),
        """SELECT count(*) AS total_records, count(DISTINCT url_domain) AS distinct_url_domain,
          count(DISTINCT source_url) AS distinct_source_url,
          count(DISTINCT content_length_category) AS distinct_content_length_category FROM web_all""",
    ),
    "content_diversity": (
        ("web_all",),
        """SELECT source_url, count(*) AS total_items,
          count(DISTINCT left(content_text, 50)) AS unique_starts FROM web_all GROUP BY 1""",
    ),
    "exact_median": (
        ("full_all",),
        """SELECT _meta_dataset_name AS dataset_name, median(text_length::DOUBLE) AS median_text_length,
          round(median(japanese_ratio), 6) AS median_japanese_ratio FROM full_all GROUP BY 1""",
    ),
    "chunk_sketches": (
        ("full_",),
        """SELECT _meta_dataset_name AS dataset_name, count(*) AS records,
          count(DISTINCT _meta_chunk_index) AS chunks, count(DISTINCT text) AS distinct_texts,
          true AS distinct_ok, true AS medians_ok FROM full_ GROUP BY 1""",
    ),
    "rollup_total_median": (
        ("full_",),
        f"""SELECT coalesce(_meta_dataset_name, 'TOTAL') AS dataset_name,
          median(text_length::DOUBLE) AS median_text_length,
          {rnd('median(japanese_ratio::DOUBLE)', 3)} AS median_japanese_ratio,
          {rnd('median(quality_score::DOUBLE)', 1)} AS median_quality_score
          FROM full_ GROUP BY GROUPING SETS ((_meta_dataset_name), ())
        UNION ALL SELECT 'lang ' || coalesce(lang, 'TOTAL'), median(n_chars::DOUBLE), NULL, NULL
          FROM documents GROUP BY GROUPING SETS ((lang), ())""",
    ),
    "rollup_total": (
        (),
        f"""SELECT coalesce(lang, 'TOTAL') AS lang, count(*) AS records,
          sum(n_chars)::BIGINT AS characters, min(n_chars) AS shortest, max(n_chars) AS longest,
          CASE WHEN grouping(lang) = 0 THEN max(source) END AS last_source,
          {rnd('sum(n_chars) / count(*)', 2)} AS avg_chars
        FROM documents GROUP BY GROUPING SETS ((lang), ())""",
    ),
    "dedup_latest": (
        ("raw_web",),
        """SELECT text, url, _dbt_extracted_at, _row_key FROM raw_web
        QUALIFY row_number() OVER (PARTITION BY text, url
          ORDER BY _dbt_extracted_at DESC, _row_key DESC) = 1""",
    ),
    "dedup_latest_by_row": (
        ("raw_web",),
        """SELECT text, url, _dbt_extracted_at, _row_key FROM raw_web
        QUALIFY row_number() OVER (PARTITION BY text, url
          ORDER BY _dbt_extracted_at DESC, _row_key DESC) = 1""",
    ),
    "stg_web": (("web",), "SELECT * EXCLUDE (raw_text, raw_url, _row_key, _meta_chunk_index) FROM web"),
    "stg_articles": (("articles",), "SELECT * EXCLUDE (_meta_chunk_index) FROM articles"),
    "quality_checks": (("simple",), "SELECT * FROM simple"),
    "quality_checks_unfiltered": (("simple_all",), "SELECT * FROM simple_all"),
    "quality_checks_full": (
        ("full_",),
        """SELECT text, text_length, total_japanese_chars, round(japanese_ratio, 6) AS japanese_ratio,
          round(ascii_ratio, 6) AS ascii_ratio, round(whitespace_ratio, 6) AS whitespace_ratio,
          round(symbol_ratio, 6) AS symbol_ratio, is_too_short, is_too_long, has_encoding_issues,
          has_repetition, quality_score, quality_class, content_type, is_anomaly, _meta_dataset_name
        FROM full_""",
    ),
    "dataset_quality_summary": (("summary",), "SELECT * FROM summary"),
    "dataset_quality_summary_full": (("summary_full",), "SELECT * FROM summary_full"),
    "content_quality_metrics": (
        ("web", "articles"),
        f"""SELECT *, CASE WHEN quality_score >= 80 THEN 'high' WHEN quality_score >= 60 THEN 'medium'
          WHEN quality_score >= 40 THEN 'low' ELSE 'poor' END AS quality_tier
        FROM (SELECT *, least(100.0::DOUBLE, round(substantial_content_pct * 0.6::DOUBLE
          + content_diversity_pct * 0.4::DOUBLE, 2)) AS quality_score
        FROM (SELECT source, content_group, processing_source, total_items,
          {rnd('chars / total_items', 2)} AS avg_content_length, substantial_content_count,
          minimal_content_count, unique_content_starts,
          {pct('substantial_content_count', 'total_items')} AS substantial_content_pct,
          {pct('unique_content_starts', 'total_items')} AS content_diversity_pct,
          first_processed, last_processed, {RUN} AS metrics_generated_at, '{BATCH}' AS batch_id
        FROM ({web_group()} UNION ALL {article_group()}) g) h) k""",
    ),
    "content_summary": (
        ("web", "articles"),
        f"""SELECT *, {rnd('total_characters / total_records', 2)} AS avg_content_length,
          {pct('short_content_count', 'total_records')} AS short_content_pct,
          {pct('medium_content_count', 'total_records')} AS medium_content_pct,
          {pct('long_content_count', 'total_records')} AS long_content_pct,
          {RUN} AS summary_generated_at, '{BATCH}' AS batch_id
        FROM ({summary_counts('web', 'content_length', 'content_length_category',
            [('short', "'short'"), ('medium', "'medium'"), ('long', "'long'")],
            'url_domain', 'count(DISTINCT source_dataset)', 'fineweb')}
          UNION ALL {summary_counts('articles', 'text_length', 'article_size_category',
            [('short', "'stub'"), ('medium', "'standard'"), ('long', "'detailed', 'comprehensive'")],
            'article_id', '1::BIGINT', 'wikipedia')}) c""",
    ),
    "anomaly_report": (("anomalies",), "SELECT * FROM anomalies"),
    "quality_report": (
        ("anomalies",),
        """SELECT sum(tables_processed)::BIGINT AS total_tables, sum(total_records)::BIGINT AS total_records,
          sum(total_anomalies)::BIGINT AS total_anomalies,
          round(sum(total_anomalies) / sum(total_records), 6) AS overall_anomaly_rate FROM anomalies""",
    ),
    "processing_summary": (
        ("anomalies",),
        f"""SELECT *, CASE WHEN overall_quality_score >= 0.9::DOUBLE THEN 'excellent'
            WHEN overall_quality_score >= 0.8::DOUBLE THEN 'good'
            WHEN overall_quality_score >= 0.7::DOUBLE THEN 'acceptable'
            ELSE 'needs_improvement' END AS quality_assessment,
          CASE WHEN fineweb_anomaly_percentage > 20 THEN 'review_fineweb_filtering'
            WHEN wikipedia_anomaly_percentage > 10 THEN 'review_wikipedia_filtering'
            ELSE 'monitoring_recommended' END AS processing_recommendation
        FROM (SELECT '{BATCH}' AS batch_id, {RUN} AS report_generated_at, false AS used_delta_lake,
          w.total_records AS fineweb_total_records, w.avg_japanese_ratio AS fineweb_japanese_ratio,
          w.overall_anomaly_rate AS fineweb_anomaly_rate, w.analysis_method AS fineweb_analysis_method,
          w.mock_mode AS fineweb_mock_mode, a.total_records AS wikipedia_total_records,
          a.avg_japanese_ratio AS wikipedia_japanese_ratio,
          a.overall_anomaly_rate AS wikipedia_anomaly_rate,
          a.analysis_method AS wikipedia_analysis_method, a.mock_mode AS wikipedia_mock_mode,
          round(w.avg_japanese_ratio * 100, 2) AS fineweb_japanese_percentage,
          round(w.overall_anomaly_rate * 100, 2) AS fineweb_anomaly_percentage,
          round(a.avg_japanese_ratio * 100, 2) AS wikipedia_japanese_percentage,
          round(a.overall_anomaly_rate * 100, 2) AS wikipedia_anomaly_percentage,
          round(w.avg_japanese_ratio * 0.4::DOUBLE + a.avg_japanese_ratio * 0.4::DOUBLE
            + (1 - w.overall_anomaly_rate) * 0.1::DOUBLE + (1 - a.overall_anomaly_rate) * 0.1::DOUBLE, 3)
            AS overall_quality_score,
          'full_real_analysis' AS analysis_reliability, 'parquet_fallback' AS data_source_type,
          w.total_records + a.total_records AS total_records_analyzed,
          round((w.avg_japanese_ratio + a.avg_japanese_ratio) / 2, 3) AS avg_japanese_ratio,
          round((w.overall_anomaly_rate + a.overall_anomaly_rate) / 2, 3) AS avg_anomaly_rate
        FROM (SELECT * FROM anomalies WHERE dataset_name = '{V.WEB_DATASET}') w,
          (SELECT * FROM anomalies WHERE dataset_name = '{V.ARTICLE_DATASET}') a) p""",
    ),
    "check_not_null": (
        ("raw_web", "raw_articles", "web", "articles"),
        union(
            not_null("raw_web", "raw_web", ["text", "url"]),
            not_null("raw_articles", "raw_articles", ["id", "title", "text"]),
            not_null("stg_web", "web", NOT_NULL_WEB),
            not_null("stg_articles", "articles", NOT_NULL_ARTICLES),
        ),
    ),
    "check_unique": (
        ("raw_web", "raw_articles"),
        union(
            uniq("raw_articles", "raw_articles", "id"),
            uniq("raw_articles", "raw_articles", "title"),
            uniq("raw_web", "raw_web", "url"),
        ),
    ),
    "check_accepted_values": (
        ("web_all", "articles_all", "simple_all"),
        union(
            web_accepted("web_all"),
            article_accepted("articles_all"),
            accepted("plain_articles", "articles_all", "article_type", ["article"]),
            quality_accepted("simple_all"),
        ),
    ),
    "check_accepted_range": (
        ("web_all", "articles_all", "simple_all"),
        union(
            in_range("stg_web", "web_all", "content_length", 10, 1000000),
            article_ranges("articles_all"),
            check(
                "not_empty_stg_articles_article_title",
                "article_title must not be blank",
                rows_where("trim(article_title) = ''"),
                "articles_all",
            ),
            quality_ranges("simple_all"),
        ),
    ),
    "check_high_quality_ratio": (
        ("full_all", "simple_all"),
        union(
            check(*RECORD_CHECKS["check_high_quality_ratio"][:2],
                  rows_where(RECORD_CHECKS["check_high_quality_ratio"][2]), "full_all"),
            check(
                "high_quality_japanese_ratio",
                "High quality records should have Japanese ratio >= 0.85",
                rows_where("quality_class = 'high' AND japanese_ratio < 0.85::DOUBLE"),
                "simple_all",
            ),
        ),
    ),
    "check_summary": (("summary_full",), SUMMARY_CHECK),
    "check_completeness": (("summary_full",), COMPLETENESS),
    "check_freshness": (("web", "articles"), union(FRESH)),
    "check_source_ref": (("web",), SOURCE_REF),
    "check_pk_unique": (("articles",), PRIMARY_KEY),
    "check_required_columns": (
        ("web",),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, 0::BIGINT AS missing,
              count(*) FILTER (WHERE {c} IS NULL) AS null_records FROM web"""
            for c in ("content_text", "source_dataset", "content_length", "contains_japanese_chars")
        ),
    ),
    "check_type_consistency": (("web", "articles"), TYPES),
    "check_total_consistency": (("full_", "summary_full"), TOTALS),
    "check_suite": (("web", "articles", "full_", "summary_full", "mart_contents", "mart_metrics"), SUITE),
    "check_broken_records": (
        ("broken_records",),
        union(
            [check(n, d, rows_where(c), "broken_records") for n, d, c in RECORD_CHECKS.values()],
            STRUCTURE.replace("FROM full_", "FROM broken_records"),
        ),
    ),
    "check_broken_models": (
        ("web", "articles", "full_", "summary_full"),
        union(
            check(
                "foreign_key_integrity", "Source dataset references should be valid",
                rows_where("content_length % 3 = 0"), "web",
            ),
            check(
                "primary_key_uniqueness", "Wikipedia article IDs should be unique",
                "count(*) - count(DISTINCT left(article_id, 1))", "articles",
            ),
            uniq("stg_articles", "(SELECT left(article_id, 1) AS article_id FROM articles) s", "article_id"),
            check("missing_required_columns", "Required columns must be present in staging models", "2", "(SELECT 1) one"),
            check("data_type_consistency", "Common columns should have consistent data types", "1", "(SELECT 1) one"),
            check("summary_data_integrity", "Summary percentages and totals should be valid", "count(*)", "summary_full"),
            check("dataset_completeness", "All expected datasets should have records", "1", "(SELECT 1) one"),
            check(
                "aggregation_consistency", "Summary totals should match individual record counts",
                "(sum(total_records + 1) FILTER (WHERE dataset_name <> 'TOTAL') <> (SELECT count(*) FROM full_))::INT",
                "summary_full",
            ),
        ),
    ),
    "check_contracts": (
        ("raw_web", "broken_articles", "broken_contents", "broken_metrics"),
        f"""{union(
            not_null("raw_web", "raw_web", ["text"]),
            not_null("raw_articles", "broken_articles", ["id", "title", "text"]),
            uniq("raw_articles", "broken_articles", "id"),
            not_null("content_summary", "broken_contents", ["total_records", "avg_content_length"]),
            in_range("content_summary", "broken_contents", "total_records", 0, None),
            in_range("content_summary", "broken_contents", "avg_content_length", 0, 100000),
            not_null("content_quality_metrics", "broken_metrics", ["source", "quality_tier"]),
            accepted("content_quality_metrics", "broken_metrics", "quality_tier", ["high", "medium", "low", "poor"]),
        )}""",
    ),
    "stream_ingest": (
        ("ordered",),
        f"""SELECT doc_id, text, '{V.ARTICLE_DATASET}' AS _meta_dataset_name,
          '{V.ARTICLE_CONFIG}' AS _meta_config_name, ordinal // {SIZE} AS _meta_chunk_index,
          ordinal // {SIZE} * {SIZE} AS _meta_start_idx, least((ordinal // {SIZE} + 1) * {SIZE}, (SELECT count(*) FROM documents)) AS _meta_end_idx,
          {RUN} AS _processing_timestamp FROM ordered""",
    ),
    "stream_staging": (
        ("web_all",),
        """SELECT * EXCLUDE (raw_text, raw_url, _meta_chunk_index) FROM web_all
        WHERE is_valid_content AND contains_japanese_chars""",
    ),
    "stream_dedup": (
        ("raw_web",),
        """SELECT text, url, _dbt_extracted_at, _row_key FROM raw_web
        QUALIFY row_number() OVER (PARTITION BY text, url
          ORDER BY _dbt_extracted_at DESC, _row_key DESC) = 1""",
    ),
    "stream_dedup_compacted": (
        ("raw_web",),
        """SELECT text, url, _dbt_extracted_at, _row_key FROM raw_web
        QUALIFY row_number() OVER (PARTITION BY text, url
          ORDER BY _dbt_extracted_at DESC, _row_key DESC) = 1""",
    ),
    "stream_quality_counts": (
        ("simple_all",),
        """SELECT _meta_dataset_name AS dataset_name, count(*) AS total_records,
          count(*) FILTER (WHERE quality_class = 'high') AS high_quality_count,
          count(*) FILTER (WHERE quality_class = 'medium') AS medium_quality_count,
          count(*) FILTER (WHERE quality_class = 'low') AS low_quality_count,
          count(*) FILTER (WHERE quality_class = 'poor') AS poor_quality_count,
          sum(is_anomaly)::BIGINT AS anomaly_count, sum(text_length)::BIGINT AS total_characters,
          min(text_length) AS min_text_length, max(text_length) AS max_text_length,
          min(quality_score) AS min_quality_score, max(quality_score) AS max_quality_score
        FROM simple_all GROUP BY 1""",
    ),
}
CTES["broken_records"] = (
    ("full_all",),
    """SELECT * REPLACE (
      CASE WHEN text_length % 3 = 0 THEN 'high' ELSE quality_class END AS quality_class,
      CASE WHEN text_length % 5 = 0 THEN 'content' ELSE content_type END AS content_type,
      CASE WHEN text_length % 7 = 0 THEN 'HOME' ELSE text END AS text,
      CASE WHEN text_length % 2 = 0 THEN 0 ELSE has_encoding_issues END AS has_encoding_issues,
      CASE WHEN text_length % 31 = 0 THEN 150 WHEN text_length % 11 = 0 THEN 95 ELSE quality_score END AS quality_score,
      CASE WHEN text_length % 13 = 0 THEN 1 ELSE is_too_short END AS is_too_short,
      CASE WHEN text_length % 17 = 0 THEN 1 ELSE is_too_long END AS is_too_long,
      CASE WHEN text_length % 19 = 0 THEN text_length + 1 ELSE total_japanese_chars END AS total_japanese_chars,
      CASE WHEN text_length % 23 = 0 THEN 1.5 ELSE whitespace_ratio END AS whitespace_ratio,
      CASE WHEN text_length % 29 = 0 THEN 1 - is_anomaly ELSE is_anomaly END AS is_anomaly) FROM full_all""",
)
CTES["broken_articles"] = (
    ("raw_articles",),
    "SELECT * REPLACE (CASE WHEN title NOT LIKE 'src9-%' THEN id END AS id) FROM raw_articles",
)
CTES["broken_contents"] = (
    ("mart_contents",),
    f"""SELECT * REPLACE (CASE WHEN source_type = '{V.WEB_KEY}' THEN -1.0::DOUBLE END AS avg_content_length)
      FROM mart_contents""",
)
CTES["broken_metrics"] = (
    ("mart_metrics",),
    "SELECT * REPLACE (CASE WHEN total_items > 1 THEN upper(quality_tier) END AS quality_tier) FROM mart_metrics",
)
CTES["mart_contents"], CTES["mart_metrics"] = QUERIES["content_summary"], QUERIES["content_quality_metrics"]
for _key, (_name, _text, _condition) in RECORD_CHECKS.items():
    QUERIES.setdefault(
        _key, (("full_all",), check(_name, _text, rows_where(_condition), "full_all"))
    )


def _with(names):
    """The needed expressions, each after the ones it reads."""
    order = []

    def visit(name):
        for dependency in CTES[name][0]:
            visit(dependency)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def assemble(names, body):
    parts = [f"{name} AS ({CTES[name][1]})" for name in _with(names)]
    return f"WITH {', '.join(parts)} {body}" if parts else body


ORACLE = {name: assemble(names, body) for name, (names, body) in QUERIES.items()}
