"""Per-record quality scores and the per-dataset anomaly analysis."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions import rules as R
from corpusloom.functions import text as X
from corpusloom.functions.numeric import ratio, round_to

SIMPLE_COLUMNS = (
    "text",
    "text_length",
    "japanese_ratio",
    "ascii_ratio",
    "quality_score",
    "quality_class",
    "content_type",
    "is_anomaly",
    "_meta_dataset_name",
)

FULL_COLUMNS = (
    "text",
    "text_length",
    "total_japanese_chars",
    "japanese_ratio",
    "ascii_ratio",
    "whitespace_ratio",
    "symbol_ratio",
    "is_too_short",
    "is_too_long",
    "has_encoding_issues",
    "has_repetition",
    "quality_score",
    "quality_class",
    "content_type",
    "is_anomaly",
    "_meta_dataset_name",
)


def _flagged(df: DataFrame, text: str, length: str, ratios: dict) -> DataFrame:
    flag = F.col("contains_japanese_chars")
    pick = lambda pair: F.when(flag, F.lit(pair[0])).otherwise(F.lit(pair[1]))
    return df.select(
        F.col(text).alias("text"),
        F.col(length).alias("text_length"),
        pick(ratios["script"]).alias("japanese_ratio"),
        pick(ratios["ascii"]).alias("ascii_ratio"),
        F.col("source_dataset").alias("_meta_dataset_name"),
    )


def quality_checks(web: DataFrame, articles: DataFrame) -> DataFrame:
    """Simple model: ratios are constants chosen by the script flag."""
    rows = _flagged(web, "content_text", "content_length", V.WEB_RATIOS).union(
        _flagged(articles, "article_text", "text_length", V.ARTICLE_RATIOS)
    )
    return rows.withColumns(
        {
            "quality_score": R.quality_score("text_length", "japanese_ratio"),
            "quality_class": R.quality_class("text_length", "japanese_ratio"),
            "content_type": R.simple_content_type("text_length", "japanese_ratio"),
            "is_anomaly": R.simple_anomaly("text_length", "japanese_ratio"),
        }
    ).select(*SIMPLE_COLUMNS)


# White space that ratios count, and characters that are certainly no symbols: what a text
# mostly consists of is told apart by a table lookup, and only the rest by its category.
SPACES, WIDE_SPACE = (" ", "\t", "\r", "\n"), "\u3000"
NO_SYMBOL = r"0-9A-Za-z\s[^\p{P}\p{S}]"


def with_character_counts(df: DataFrame, text: str, length: str, script: str = "narrow") -> DataFrame:
    """Add the characters of the script, of ASCII, white space and symbols of a text.

    One pass takes out ASCII in long runs; the script, which lies beyond ASCII, is
    counted on what is left. White space is taken out by byte search, one character at a
    time, and symbols are counted without it. A script given as a class may hold anything
    and is counted on the whole text. What nobody reads is not counted.
    """
    bare = reduce(lambda left, s: F.replace(left, F.lit(s), F.lit("")), SPACES, F.col(text))
    pieces = df.withColumn("_bare", bare).withColumn("_beyond", X.without(F.col(text), r"\x00-\x7F"))
    own = F.col("_beyond" if script in V.SCRIPTS else text)
    wide = F.length("_bare") - F.length(F.replace(F.col("_bare"), F.lit(WIDE_SPACE), F.lit("")))
    spaces = F.length(text) - F.length("_bare")
    return pieces.withColumns(
        {
            "total_japanese_chars": X.count_class(own, X.script_class(script)),
            "_ascii": F.col(length) - X.length_of("_beyond"),
            "_space": (spaces + wide).cast("long"),
            "_symbol": X.length_of(X.without(F.col("_bare"), NO_SYMBOL)),
        }
    ).drop("_bare", "_beyond")


def measure(df: DataFrame, text: str, length: str, script: str = "narrow") -> DataFrame:
    """Add measured ratios, flags, score, class, type and anomaly to a frame.

    Beside the model columns it adds `is_nav_word` and
    `has_replacement_char`, so that data tests need no text afterwards.
    """
    n = F.col(length)
    body = F.col(text)
    counted = with_character_counts(df, text, length, script)
    measured = counted.withColumns(
        {
            "japanese_ratio": ratio("total_japanese_chars", n),
            "ascii_ratio": ratio("_ascii", n),
            "whitespace_ratio": ratio("_space", n),
            "symbol_ratio": ratio("_symbol", n),
            "is_too_short": F.when(n < V.TOO_SHORT, 1).otherwise(0),
            "is_too_long": F.when(n > V.TOO_LONG, 1).otherwise(0),
            "has_replacement_char": body.contains(X.REPLACEMENT_CHAR),
            "has_encoding_issues": F.when(body.contains(X.REPLACEMENT_CHAR), 1).otherwise(0),
            "has_repetition": X.line_repetition(body),
            "is_nav_word": R.is_nav_word(body),
        }
    ).drop("_ascii", "_space", "_symbol")
    scored = measured.withColumns(
        {
            "quality_score": R.quality_score(length, "japanese_ratio"),
            "quality_class": R.quality_class(length, "japanese_ratio"),
            "content_type": R.full_content_type(text, length, "japanese_ratio", "is_nav_word"),
        }
    )
    return scored.withColumn(
        "is_anomaly",
        R.full_anomaly(
            "is_too_short",
            "is_too_long",
            "has_encoding_issues",
            "content_type",
            "japanese_ratio",
            "has_repetition",
        ),
    )


def measured_rows(web: DataFrame, articles: DataFrame, script: str = "narrow") -> DataFrame:
    """Both staged corpora with all measured columns, one row per record.

    A chunk number that both corpora carry is kept.
    """
    carried = [c for c in ("_meta_chunk_index",) if c in web.columns and c in articles.columns]
    narrow = lambda df, text, length: df.select(
        F.col(text).alias("text"),
        F.col(length).alias("text_length"),
        F.col("source_dataset").alias("_meta_dataset_name"),
        *carried,
    )
    rows = narrow(web, "content_text", "content_length").union(
        narrow(articles, "article_text", "text_length")
    )
    return measure(rows, "text", "text_length", script)


def quality_checks_full(web: DataFrame, articles: DataFrame, script: str = "narrow") -> DataFrame:
    """Full model: every ratio is counted from the characters of the text."""
    return measured_rows(web, articles, script).select(*FULL_COLUMNS)


def anomaly_report(quality: DataFrame) -> DataFrame:
    """Records, anomalies, script ratio and combined score per dataset."""
    counted = quality.groupBy(F.col("_meta_dataset_name").alias("dataset_name")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("is_anomaly").alias("total_anomalies"),
        F.avg("japanese_ratio").alias("_ratio"),
    )
    rate = ratio("total_anomalies", "total_records")
    return counted.select(
        "dataset_name",
        F.lit(1).cast("long").alias("tables_processed"),
        "total_records",
        "total_anomalies",
        round_to(rate, 6).alias("overall_anomaly_rate"),
        round_to("_ratio", 6).alias("avg_japanese_ratio"),
        F.lit("parquet_analysis").alias("format"),
        F.lit("full_scan").alias("analysis_method"),
        F.lit(False).alias("mock_mode"),
        round_to(F.col("_ratio") * 0.6 + (F.lit(1.0) - rate) * 0.4, 6).alias("quality_score"),
    )


def quality_report(anomalies: DataFrame) -> DataFrame:
    """Totals over all datasets; the rate of an empty run is 0."""
    return anomalies.agg(
        F.coalesce(F.sum("tables_processed"), F.lit(0)).alias("total_tables"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("total_anomalies"), F.lit(0)).alias("total_anomalies"),
    ).withColumn(
        "overall_anomaly_rate",
        F.coalesce(round_to(ratio("total_anomalies", "total_records"), 6), F.lit(0.0)),
    )
