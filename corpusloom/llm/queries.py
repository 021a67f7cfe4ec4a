"""The operators as queries over whole tables, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    decontaminate,
    filter_audit,
    html_text,
    licenses,
    line_dedup,
    ordinal_quality,
    packing,
    parity_join,
    prefix_trie,
    quality_rules,
    similarity_sketch,
    token_counts,
    url_filter,
)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    REGISTRY[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op4_best_fit_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query
def op5_license_scan(spark, folder):
    return licenses.licenses(table(spark, folder, "documents")).drop("expressions")


@query
def op6_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"))


@query
def op9_benchmark_decontamination(spark, folder):
    found = decontaminate.judged(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op10_quality_rules(spark, folder):
    source = table(spark, folder, "documents").select("doc_id", "text", "lang")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality_rules.verdicts(source).select(
        "doc_id", *[F.col(f"quality.{n}") for n in (*names, "char_distance", "word_distance")]
    )


@query
def op2_parity_jaccard_join(spark, folder):
    return parity_join.join(table(spark, folder, "documents"))


@query
def op1_url_filter(spark, folder):
    return url_filter.verdicts(table(spark, folder, "pages"))


@query
def op3_main_text(spark, folder):
    return html_text.main_text(table(spark, folder, "pages"))


@query
def op7_ordinal_quality(spark, folder):
    ratings = ordinal_quality.graded(table(spark, folder, "labels"))
    return ordinal_quality.assessed(table(spark, folder, "documents"), ratings)


@query
def op8_line_dedup(spark, folder):
    return line_dedup.report(table(spark, folder, "documents"))


@query
def op11_filter_interactions(spark, folder):
    path = f"{folder}/documents.parquet"
    stream = filter_audit.document_files(spark, path, spark.read.parquet(path).schema)
    return filter_audit.audit(stream, table(spark, folder, "labels"))


@query
def op13_similarity_sketch_dedup(spark, folder):
    return similarity_sketch.deduplicated(table(spark, folder, "documents"))


@query
def op12_prefix_trie(spark, folder):
    ordered = prefix_trie.turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(ordered))
