"""Data tests. A check is a row (test_name, failing_records, test_description).

All rules on one frame are evaluated in a single aggregation over it. Rules
with zero failures stay in the result; `failures` drops them.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions.rules import full_anomaly
from corpusloom.functions.text import trim_spaces
from corpusloom.operators.aggregates import uniqueness_deficit
from corpusloom.plans.marts import TOTAL
from corpusloom.sources import fields as S

RESULT = ("test_name", "failing_records", "test_description")


@dataclass(frozen=True)
class Rule:
    """`failing` is true for a row that breaks the rule; NULL counts as kept."""

    name: str
    failing: Column
    description: str


def run_rules(df: DataFrame, rules) -> DataFrame:
    """Failing rows per rule, all in one pass over the frame."""
    counted = df.agg(*[F.count_if(r.failing).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.name).alias("test_name"),
            F.col(f"r{i}").alias("failing_records"),
            F.lit(r.description).alias("test_description"),
        )
        for i, r in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def watched(df: DataFrame, rules, aliases=None) -> tuple[DataFrame, Observation]:
    """The frame with its rules and rows counted while some action reads it, such as the
    write that the frame is made for. `aliases` gives columns the names that rules use."""
    seen = Observation()
    extra = {new: F.col(old) for new, old in (aliases or {}).items() if new != old}
    counts = [F.count_if(r.failing).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = df.withColumns(extra).observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    return rows.select(*df.columns), seen


def observed(spark: SparkSession, found) -> DataFrame:
    """Failing rows per rule, from (rules, observation) pairs; a rule that was watched on
    several frames is summed. One number per rule is all that reaches the driver."""
    rows: dict[tuple[str, str], int] = {}
    for rules, seen in found:
        counts = seen.get
        for i, r in enumerate(rules):
            rows[r.name, r.description] = rows.get((r.name, r.description), 0) + counts[f"r{i}"]
    data = [(name, n, text) for (name, text), n in rows.items()]
    return spark.createDataFrame(data, "test_name string, failing_records long, test_description string")


def union_checks(*frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def named(df: DataFrame, name: str, description: str) -> DataFrame:
    """Label a one-row frame that already holds failing_records."""
    return df.select(
        F.lit(name).alias("test_name"),
        F.col("failing_records").cast("long"),
        F.lit(description).alias("test_description"),
    )


# ---- generic rules --------------------------------------------------------


def not_null_rules(model: str, columns) -> list:
    return [
        Rule(f"not_null_{model}_{c}", F.col(c).isNull(), f"{c} must not be NULL") for c in columns
    ]


def accepted_rules(model: str, accepted: dict) -> list:
    return [
        Rule(f"accepted_values_{model}_{c}", ~F.col(c).isin(*values), f"{c} must be a listed value")
        for c, values in accepted.items()
    ]


def range_rules(model: str, ranges: dict) -> list:
    """One rule per column; a range without an upper end is open there."""
    return [
        Rule(
            f"accepted_range_{model}_{c}",
            F.col(c) < low if high is None else ~F.col(c).between(low, high),
            f"{c} must be at least {low}" if high is None else f"{c} must be between {low} and {high}",
        )
        for c, (low, high) in ranges.items()
    ]


def not_empty_rule(model: str, column: str) -> Rule:
    return Rule(
        f"not_empty_{model}_{column}", trim_spaces(column) == "", f"{column} must not be blank"
    )


def contract_rules(model: str, df: DataFrame) -> list:
    """Every declared rule of a model whose column the frame has."""
    present = lambda names: [c for c in names if c in df.columns]
    accepted = S.ACCEPTED.get(model, {})
    ranges = S.RANGES.get(model, {})
    return (
        not_null_rules(model, present(S.NOT_NULL.get(model, ())))
        + accepted_rules(model, {c: accepted[c] for c in present(accepted)})
        + range_rules(model, {c: ranges[c] for c in present(ranges)})
    )


def unique(df: DataFrame, model: str, *key) -> DataFrame:
    """Number of key values held by more than one row; NULL keys are ignored.

    Copies are counted per task before the shuffle, so a key held by a third of
    all rows costs one row per task.
    """
    repeated = (
        df.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("failing_records"))
    )
    label = "_".join(key)
    return named(repeated, f"unique_{model}_{label}", f"{label} must be unique")


def keys_unique(df: DataFrame, model: str, key: str, deficit: str, description: str) -> DataFrame:
    """Both uniqueness checks of a key from one grouping: rows beyond one for each value
    (NULL keys are all beyond), and values that occur repeatedly."""
    copies = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    one = copies.agg(
        F.coalesce(F.sum("n") - F.count("_key"), F.lit(0)).alias("deficit"),
        F.count_if(F.col("_key").isNotNull() & (F.col("n") > 1)).alias("repeated"),
    )
    row = lambda name, n, text: F.struct(
        F.lit(name).alias("test_name"), F.col(n).alias("failing_records"), F.lit(text).alias("test_description")
    )
    repeated = row(f"unique_{model}_{key}", "repeated", f"{key} must be unique")
    return one.select(F.inline(F.array(row(deficit, "deficit", description), repeated)))


# ---- rules on scored records ----------------------------------------------


def high_quality_ratio(minimum: float = 0.5) -> Rule:
    return Rule(
        "high_quality_japanese_ratio",
        (F.col("quality_class") == "high") & (F.col("japanese_ratio") < minimum),
        f"High quality records should have Japanese ratio >= {minimum}",
    )


def content_type_rule() -> Rule:
    return Rule(
        "content_type_classification",
        (F.col("content_type") == "content") & F.col("is_nav_word"),
        "Navigation elements should not be classified as content",
    )


def encoding_rule() -> Rule:
    return Rule(
        "encoding_issues_detection",
        (F.col("has_encoding_issues") == 0) & F.col("has_replacement_char"),
        "Replacement characters should be flagged as encoding issues",
    )


def score_band_rule(medium_below: int = 90) -> Rule:
    label, score = F.col("quality_class"), F.col("quality_score")
    # --- fixed values: allowed score band [low, high) of each class
    bands = {"high": (70, None), "medium": (50, medium_below), "low": (30, 70), "poor": (None, 50)}
    outside = []
    for name, (low, high) in bands.items():
        if low is not None:
            outside.append((label == name) & (score < low))
        if high is not None:
            outside.append((label == name) & (score >= high))
    return Rule(
        "quality_score_consistency",
        reduce(lambda a, b: a | b, outside),
        "Quality scores should align with quality classifications",
    )


def length_flags_rule() -> Rule:
    n = F.col("text_length")
    return Rule(
        "text_length_validation",
        ((F.col("is_too_short") == 1) & (n >= V.TOO_SHORT))
        | ((F.col("is_too_long") == 1) & (n <= V.TOO_LONG)),
        "Text length flags should match actual lengths",
    )


def char_count_rule() -> Rule:
    return Rule(
        "japanese_character_counting",
        F.col("total_japanese_chars") > F.col("text_length"),
        "Japanese character count cannot exceed total text length",
    )


def ratios_rule() -> Rule:
    names = ("japanese_ratio", "ascii_ratio", "symbol_ratio", "whitespace_ratio")
    return Rule(
        "ratio_calculations",
        reduce(lambda a, b: a | b, [~F.col(c).between(0.0, 1.0) for c in names]),
        "All ratios should be between 0 and 1",
    )


def anomaly_flag_rule() -> Rule:
    expected = full_anomaly(
        "is_too_short",
        "is_too_long",
        "has_encoding_issues",
        "content_type",
        "japanese_ratio",
        "has_repetition",
    )
    return Rule(
        "anomaly_detection_consistency",
        F.col("is_anomaly") != expected,
        "Anomaly flag should match individual quality flags",
    )


def score_range_rule() -> Rule:
    return Rule(
        "quality_checks_structure",
        ~F.col("quality_score").between(0, 100),
        "Quality score should be between 0 and 100",
    )


def record_rules() -> list:
    return [
        high_quality_ratio(),
        content_type_rule(),
        encoding_rule(),
        score_band_rule(),
        length_flags_rule(),
        char_count_rule(),
        ratios_rule(),
        anomaly_flag_rule(),
        score_range_rule(),
    ]


# ---- rules on the quality summary -----------------------------------------


def summary_rule() -> Rule:
    classes = ("high", "medium", "low", "poor")
    shares = reduce(lambda a, b: a + b, [F.col(f"{c}_quality_pct") for c in classes])
    return Rule(
        "summary_data_integrity",
        (F.col("total_records") <= 0)
        | (shares > 100.1)
        | ~F.col("anomaly_rate_pct").between(0.0, 100.0)
        | ~F.col("avg_japanese_ratio").between(0.0, 1.0)
        | ~F.col("avg_quality_score").between(0.0, 100.0),
        "Summary percentages and totals should be valid",
    )


def completeness(summary: DataFrame, expected) -> DataFrame:
    """Expected datasets that are missing from the summary or hold no records."""
    filled = summary.agg(
        *[
            F.count_if((F.col("dataset_name") == name) & (F.col("total_records") > 0)).alias(f"e{i}")
            for i, name in enumerate(expected)
        ]
    )
    missing = reduce(
        lambda a, b: a + b, [F.when(F.col(f"e{i}") == 0, 1).otherwise(0) for i in range(len(expected))]
    )
    return named(
        filled.select(missing.alias("failing_records")),
        "dataset_completeness",
        "All expected datasets should have records",
    )


def total_consistency(records: DataFrame, summary: DataFrame) -> DataFrame:
    """1 when the summary's dataset totals do not add up to the record count."""
    counted = records.agg(F.count(F.lit(1)).alias("records"), F.lit(0).cast("long").alias("totals"))
    listed = summary.filter(F.col("dataset_name") != TOTAL).agg(
        F.lit(0).cast("long").alias("records"), F.sum("total_records").alias("totals")
    )
    both = counted.unionByName(listed).agg(
        F.sum("records").alias("records"), F.sum("totals").alias("totals")
    )
    return named(
        both.select(F.when(F.col("records") != F.col("totals"), 1).otherwise(0).alias("failing_records")),
        "aggregation_consistency",
        "Summary totals should match individual record counts",
    )


def totals_equal(summary: DataFrame, records: int) -> DataFrame:
    """`total_consistency` for a number of records that is known already."""
    listed = F.coalesce(F.sum(F.when(F.col("dataset_name") != TOTAL, F.col("total_records"))), F.lit(0))
    return named(
        summary.agg(F.when(listed != records, 1).otherwise(0).alias("failing_records")),
        "aggregation_consistency",
        "Summary totals should match individual record counts",
    )


# ---- rules on the staging models ------------------------------------------


def freshness_rule(label: str, title: str, run_ts: str, days: int = 7) -> Rule:
    limit = F.lit(run_ts).cast("timestamp_ntz") - F.expr(f"INTERVAL '{days}' DAY")
    return Rule(
        f"data_freshness_{label}",
        F.col("dbt_extracted_timestamp") < limit,
        f"{title} data should be processed within last {days} days",
    )


def timestamp_rule() -> Rule:
    return Rule(
        "timestamp_validity",
        F.col("dbt_extracted_timestamp").isNull() | F.col("dbt_updated_at").isNull(),
        "Processing timestamps should not be null",
    )


def numeric_range_rule() -> Rule:
    return Rule(
        "numeric_range_validation",
        ~F.col("content_length").between(0, V.MAX_LENGTH),
        "Content length should be positive and reasonable",
    )


def boolean_rule() -> Rule:
    return Rule(
        "boolean_validation",
        F.col("contains_japanese_chars").isNull() | F.col("is_valid_content").isNull(),
        "Boolean flags should have valid values",
    )


def source_rule() -> Rule:
    source = F.col("source_dataset")
    return Rule(
        "foreign_key_integrity",
        source.isNull() | (source == ""),
        "Source dataset references should be valid",
    )


def category_rule() -> Rule:
    return Rule(
        "categorical_validation",
        ~F.col("content_length_category").isin(*V.LENGTH_CATEGORIES),
        "Content length categories should have valid values",
    )


def web_rules(run_ts: str) -> list:
    return [
        timestamp_rule(),
        numeric_range_rule(),
        boolean_rule(),
        source_rule(),
        category_rule(),
        freshness_rule(V.WEB_KEY, "FineWeb", run_ts),
    ]


def article_rules(run_ts: str) -> list:
    return [freshness_rule(V.ARTICLE_KEY, "Wikipedia", run_ts)]


def primary_key(articles: DataFrame, key: str = "article_id") -> DataFrame:
    return named(uniqueness_deficit(articles, key), "primary_key_uniqueness", "Wikipedia article IDs should be unique")


def required_columns(df: DataFrame, required=S.REQUIRED_WEB_COLUMNS) -> DataFrame:
    """Per required column: 1 when it is missing, and its NULL count if present."""
    present = [c for c in required if c in df.columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in present]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(0 if c in present else 1).cast("long").alias("missing"),
            (F.col(c) if c in present else F.col("rows")).alias("null_records"),
        )
        for c in required
    ]
    return counted.select(F.inline(F.array(*rows)))


def missing_in_schema(spark: SparkSession, columns, required=S.REQUIRED_WEB_COLUMNS) -> DataFrame:
    """`missing_columns` for known column names: no row is read."""
    gone = len([c for c in required if c not in columns])
    data = [("missing_required_columns", gone, "Required columns must be present in staging models")]
    return spark.createDataFrame(data, "test_name string, failing_records long, test_description string")


def types_in_schema(spark: SparkSession, kinds) -> DataFrame:
    """`type_consistency` for known column types: no row is read."""
    data = [("data_type_consistency", len(set(kinds)) - 1, "Common columns should have consistent data types")]
    return spark.createDataFrame(data, "test_name string, failing_records long, test_description string")


def missing_columns(df: DataFrame, required=S.REQUIRED_WEB_COLUMNS) -> DataFrame:
    total = required_columns(df, required).agg(F.sum("missing").alias("failing_records"))
    return named(total, "missing_required_columns", "Required columns must be present in staging models")


def type_consistency(web: DataFrame, articles: DataFrame) -> DataFrame:
    """Extra types among columns that should agree: 0 when there is one type."""
    types = web.select(F.typeof("content_length").alias("t")).union(
        articles.select(F.typeof("text_length").alias("t"))
    )
    extra = types.agg((F.count_distinct("t") - 1).alias("failing_records"))
    return named(extra, "data_type_consistency", "Common columns should have consistent data types")


# ---- the suite ------------------------------------------------------------

WARN, ERROR = "warn", "error"

# --- fixed values: tests that only warn ------------------------------------
WARN_TESTS = (
    "high_quality_japanese_ratio",
    "content_type_classification",
    "encoding_issues_detection",
    "quality_score_consistency",
    "text_length_validation",
    "japanese_character_counting",
    "ratio_calculations",
    "anomaly_detection_consistency",
    "summary_data_integrity",
    "dataset_completeness",
    "data_freshness_fineweb",
    "data_freshness_wikipedia",
)


def graded(checks: DataFrame) -> DataFrame:
    severity = F.when(F.col("test_name").isin(*WARN_TESTS), WARN).otherwise(ERROR)
    return checks.withColumn("severity", severity).withColumn(
        "status", F.when(F.col("failing_records") == 0, "pass").otherwise(F.col("severity"))
    )


def failures(checks: DataFrame) -> DataFrame:
    return checks.filter("failing_records > 0")


def mart_checks(marts: dict[str, DataFrame]) -> list[DataFrame]:
    """The declared contracts of marts, by model name."""
    return [run_rules(frame, contract_rules(name, frame)) for name, frame in marts.items()]


def suite(
    web: DataFrame,
    articles: DataFrame,
    measured: DataFrame,
    summary: DataFrame,
    run_ts: str,
    marts: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All singular tests plus the declared contracts, with severity and status.

    `marts` are further tables whose contracts are checked, by model name.
    The inputs should be written tables (see `plans.run`): each is read by one
    pass for its row rules and by a few key or total checks.
    """
    return graded(
        union_checks(
            run_rules(measured, record_rules() + contract_rules("quality_checks", measured)),
            run_rules(
                summary, [summary_rule()] + contract_rules("dataset_quality_summary", summary)
            ),
            run_rules(web, web_rules(run_ts) + contract_rules("stg_web", web)),
            run_rules(articles, article_rules(run_ts) + contract_rules("stg_articles", articles)),
            completeness(summary, [V.WEB_DATASET, V.ARTICLE_DATASET]),
            missing_columns(web),
            type_consistency(web, articles),
            primary_key(articles),
            unique(articles, "stg_articles", "article_id"),
            total_consistency(measured, summary),
            *mart_checks(marts or {}),
        )
    )


WEB_AS_RECORD = {"text": "content_text", "text_length": "content_length", "_meta_dataset_name": "source_dataset"}
ARTICLE_AS_RECORD = {"text": "article_text", "_meta_dataset_name": "source_dataset"}


def fact_rules(model: str, facts: DataFrame, aliases: dict, own_rules) -> list:
    """Rules of a fact table: those of its staging model and those of its records."""
    shaped = facts.withColumns({new: F.col(old) for new, old in aliases.items()})
    return (
        own_rules + contract_rules(model, facts) + record_rules() + contract_rules("quality_checks", shaped)
    )


@dataclass(frozen=True)
class WatchedFacts:
    """Fact tables to be written, their rules and what was counted on the way."""

    web: DataFrame
    articles: DataFrame
    rules: tuple
    seen: tuple

    def records(self) -> int:
        return sum(s.get["rows"] for s in self.seen)


def watched_facts(web: DataFrame, articles: DataFrame, run_ts: str) -> WatchedFacts:
    rules = (
        fact_rules("stg_web", web, WEB_AS_RECORD, web_rules(run_ts)),
        fact_rules("stg_articles", articles, ARTICLE_AS_RECORD, article_rules(run_ts)),
    )
    web, web_seen = watched(web, rules[0], WEB_AS_RECORD)
    articles, article_seen = watched(articles, rules[1], ARTICLE_AS_RECORD)
    return WatchedFacts(web, articles, rules, (web_seen, article_seen))


def observed_suite(
    facts: WatchedFacts, articles: DataFrame, summary: DataFrame, marts: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The suite after the watched facts were written: their row rules are counted
    already, so only article keys (one column) and the small marts are read. `articles`
    is the written table."""
    spark = articles.sparkSession
    kinds = [facts.web.schema["content_length"].dataType, facts.articles.schema["text_length"].dataType]
    return graded(
        union_checks(
            observed(spark, zip(facts.rules, facts.seen, strict=True)),
            run_rules(summary, [summary_rule()] + contract_rules("dataset_quality_summary", summary)),
            completeness(summary, [V.WEB_DATASET, V.ARTICLE_DATASET]),
            missing_in_schema(spark, facts.web.columns),
            types_in_schema(spark, [k.simpleString() for k in kinds]),
            keys_unique(
                articles, "stg_articles", "article_id",
                "primary_key_uniqueness", "Wikipedia article IDs should be unique",
            ),
            totals_equal(summary, facts.records()),
            *mart_checks(marts or {}),
        )
    )
