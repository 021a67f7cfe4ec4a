"""Raw corpora derived from plain document and page tables.

The test tables hold no Japanese, so the views put it in: French and German
texts get a run of Japanese characters as long as a set share of the text, other
texts a short Japanese prefix, and Spanish ones stay as they are. Every row of
the tables is used, in full. Nothing depends on a clock or on chance.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions.text import REPLACEMENT_CHAR

PREFIX = "日本の"

# One PREFIX per this many characters: about 60 % and 33 % Japanese.
FILL_EVERY = {"fr": 2, "de": 6}

EPOCH = "2024-01-01"
CHUNK_ROWS = 300

# Every so many-th document, by its number, is repeated to pass the limit for too long
# texts.
LONG_EVERY, LONG_TIMES = 97, 60


def _seconds(key: str, hours: int = 0):
    base = F.lit(EPOCH).cast("timestamp_ntz")
    return base + F.make_dt_interval(hours=F.lit(hours), secs=F.col(key).cast("decimal(18,6)"))


def _by(column, cases: dict, default):
    """A literal per value of a column."""
    case = None
    for value, result in cases.items():
        case = (F if case is None else case).when(column == value, F.lit(result))
    return case.otherwise(F.lit(default))


def _script_text(text, lang, source, n_chars):
    """The text in a Japanese guise. The text appears once in the expression, so
    filters on the result stay cheap."""
    marked = F.replace(text, _by(source, {"src5": "|"}, ""), F.lit(REPLACEMENT_CHAR))
    every = _by(lang, FILL_EVERY, None)
    fill = F.repeat(F.lit(PREFIX), F.coalesce(F.floor(n_chars / every), F.lit(0)).cast("int"))
    before = _by(lang, {"es": "", "fr": "", "de": "　"}, PREFIX)
    return F.concat(before, marked, fill, _by(lang, {"de": " "}, ""))


def _web_columns(text, url, stamp, key):
    return [
        text.alias("text"),
        url.alias("url"),
        stamp.alias("timestamp"),
        F.lit(V.WEB_DATASET).alias("_meta_dataset_name"),
        stamp.alias("_dbt_extracted_at"),
        F.lit(V.SOURCE_TABLE).alias("_dbt_source_table"),
        F.floor(F.col(key) / CHUNK_ROWS).cast("long").alias("_meta_chunk_index"),
        F.col(key).alias("_row_key"),
    ]


def web_from_documents(documents: DataFrame) -> DataFrame:
    """Documents as web texts without an address."""
    times = F.when(F.col("doc_id") % LONG_EVERY == 0, LONG_TIMES).otherwise(1)
    body = F.repeat(F.col("text"), times)
    text = _script_text(body, F.col("lang"), F.col("source"), F.col("n_chars"))
    return documents.select(
        *_web_columns(text, F.lit(None).cast("string"), _seconds("doc_id"), "doc_id")
    )


def web_from_pages(pages: DataFrame, hours: int = 0) -> DataFrame:
    """Pages as web texts with their address, extracted `hours` later."""
    text = F.concat(F.lit(PREFIX), F.col("html"))
    return pages.select(*_web_columns(text, F.col("url"), _seconds("page_id", hours), "page_id"))


def raw_web(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents, pages, and all pages again from a second visit an hour later
    (exact duplicates for the dedup)."""
    return (
        web_from_documents(documents)
        .unionByName(web_from_pages(pages))
        .unionByName(web_from_pages(pages, hours=1))
    )


def raw_articles(documents: DataFrame) -> DataFrame:
    """Documents as articles: titles of every type, redirects, NULL titles."""
    source, lang, key = F.col("source"), F.col("lang"), F.col("doc_id")
    title = (
        F.when(source == "src0", F.concat(source, F.lit("の一覧")))
        .when(source == "src1", F.concat(F.lit("（"), source, F.lit(" disambiguation）")))
        .when(source == "src2", F.concat(F.lit("カテゴリ:"), source))
        .when(source == "src3", F.lit(None).cast("string"))
        .otherwise(F.concat(source, F.lit("-"), key.cast("string"), F.lit("　")))
    )
    marks = {"src4": "日本の redirect ", "src6": "リダイレクト "}
    sections = (lang == "fr") & ~source.isin(*marks)
    text = F.concat(
        F.when(sections, "概要\n\n== 一 ==\n").otherwise(_by(source, marks, "")),
        _script_text(F.col("text"), lang, source, F.col("n_chars")),
        F.when(sections, "\n== 二 ==").otherwise(""),
    )
    stamp = _seconds("doc_id")
    return documents.select(
        key.cast("string").alias("id"),
        title.alias("title"),
        text.alias("text"),
        F.lit(V.ARTICLE_DATASET).alias("_meta_dataset_name"),
        stamp.alias("_dbt_extracted_at"),
        F.lit(V.SOURCE_TABLE).alias("_dbt_source_table"),
        F.floor(key / CHUNK_ROWS).cast("long").alias("_meta_chunk_index"),
    )
