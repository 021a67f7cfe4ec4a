"""Corpus scans: field whitelist, row positions, defaults, fallback rows."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.text import preview
from corpusloom.sources.workdir import fresh_dir, materialize
from corpusloom.values import CORPUS_FIELDS

FILE, ROW, ORDINAL = "_file", "_row", "_ordinal"

def read_source(spark: SparkSession, location: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A path in any installed format, or a catalog table with fmt='table'."""
    if fmt == "table":
        return spark.read.table(location)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(location)


def project_fields(df: DataFrame, mapping=None, fields=CORPUS_FIELDS, keep=()) -> DataFrame:
    """Keep the corpus fields a source has; `mapping` names where others live.

    A pure projection, so the scan reads only these columns.
    """
    mapping = mapping or {}
    picked = []
    for field in fields:
        origin = mapping.get(field, field)
        if origin in df.columns:
            picked.append(F.col(origin).alias(field))
    return df.select(*picked, *keep)


def with_position(df: DataFrame) -> DataFrame:
    """Add the file and the row number inside the file (Parquet sources)."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.row_index").cast("long").alias(ROW),
    )


def file_order(file: str = FILE):
    """Files sort by folder, then by part number where the name has one, then by name,
    so `part-100000` follows `part-99999`."""
    path = F.col(file)
    number = F.coalesce(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("long"), F.lit(-1))
    return F.struct(F.regexp_extract(path, "^(.*/)", 1).alias("folder"), number.alias("number"), path.alias("path"))


def file_offsets(positions: DataFrame) -> DataFrame:
    """First ordinal of every file: running total of file lengths in file order.

    A file is as long as its last row that is left says, so rows of a filtered scan keep
    their places inside a file and never overlap; `_left` tells how many are left. Files
    are summed per range of paths first; only one row per range meets in the last window.
    """
    lengths = positions.groupBy(FILE).agg((F.max(ROW) + 1).alias("_rows"), F.count(ROW).alias("_left"))
    ranged = lengths.withColumn("_order", file_order()).repartitionByRange("_order")
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()).drop("_order"), "files")
    sums = ranged.groupBy("_range").agg(F.sum("_rows").alias("_sum"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("_range").orderBy(file_order()).rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    first = (F.col("_start") + F.col("_inside")).alias("_first")
    return placed.join(starts, "_range").select(FILE, "_rows", "_left", first)


# Up to so many files (of 16 bytes each) the list of files is sent to every executor.
BROADCAST_FILES = 4_000_000


@dataclass(frozen=True)
class FileOrder:
    """Where every file of a source begins: a written table of path hashes and first
    ordinals, made once and handed to whoever numbers rows of that source.

    `rows` is the number of places, `dense` tells whether each of them has a row.
    """

    entries: DataFrame
    files: int
    rows: int
    dense: bool

    def number(self, positions: DataFrame, strict: bool = False) -> DataFrame:
        """Add the ordinal to rows of the source that carry file and row number. Rows of files
        that are not listed are left out, or with `strict` refused.

        The list of files is broadcast while its counted size allows; texts are then never
        shuffled, whatever the planner's own limit. Beyond that the planner chooses.
        """
        entries = F.broadcast(self.entries) if self.files <= BROADCAST_FILES else self.entries
        keyed = positions.withColumn(FILE, F.xxhash64(FILE))
        unknown = F.raise_error(F.lit("a file is not in the order of its source")).cast("long")
        first = F.coalesce(F.col("_first"), unknown) if strict else F.col("_first")
        joined = keyed.join(entries, FILE, "left" if strict else "inner")
        return joined.withColumn(ORDINAL, first + F.col(ROW)).drop(FILE, ROW, "_first")


def file_order_of(df: DataFrame) -> FileOrder:
    """The order of the files of a Parquet scan. For a source that will be filtered, take
    it from the whole scan: then every row has the same ordinal as without the filter."""
    offsets = file_offsets(with_position(df).select(FILE, ROW))
    entries = materialize(offsets.select(F.xxhash64(FILE).alias(FILE), "_first", "_rows", "_left"), "entries")
    files, different, rows, left = entries.agg(
        F.count(FILE), F.count_distinct(FILE), F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.sum("_left"), F.lit(0))
    ).first()
    if files != different:
        raise ValueError("two file paths have the same hash; rename one of the files")
    return FileOrder(entries.select(FILE, "_first"), files, rows, rows == left)


def scan_with_ordinal(df: DataFrame, order: FileOrder | None = None) -> DataFrame:
    """Number the rows of a Parquet scan 0, 1, 2, ... in file order.

    Ordinal = rows in earlier files + row number in this file. No data row is sorted or
    shuffled, a lost task recomputes the same numbers, and a filtered scan has gaps where
    rows are missing. `order` is that of the source, if it is known already; without it,
    rows behind the last one that a filter leaves in a file are not counted.
    """
    return (order or file_order_of(df)).number(with_position(df))


def order_by_key(df: DataFrame, *keys, partitions: int | None = None) -> DataFrame:
    """Number the rows of any frame in key order.

    Range-partitions and sorts once, writes that order to the shared folder,
    then numbers the written rows by position. The keys must be unique for the
    numbering to be repeatable.
    """
    spark = df.sparkSession
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    ranged = (
        df.repartitionByRange(partitions, *columns)
        if partitions
        else df.repartitionByRange(*columns)
    )
    path = fresh_dir(spark, "ordered")
    ranged.sortWithinPartitions(*columns).write.parquet(path)
    return scan_with_ordinal(spark.read.schema(df.schema).parquet(path))


def range_slice(df: DataFrame, start: int, size: int) -> DataFrame:
    """Rows [start, start + size) of a Parquet scan in file order.

    The files that overlap the slice lie side by side in file order, so two literals
    bound them and prune the listing; a start beyond the end gives no rows.
    """
    positions = with_position(df)
    offsets = materialize(file_offsets(positions), "offsets")
    overlap = (F.col("_first") < start + size) & (F.col("_first") + F.col("_rows") > start)
    ends = offsets.filter(overlap).agg(F.min(file_order()).alias("low"), F.max(file_order()).alias("high")).first()
    if ends["low"] is None:
        return df.limit(0).withColumn(ORDINAL, F.lit(None).cast("long"))
    kinds = {"folder": "string", "number": "long", "path": "string"}
    low, high = (F.struct(*[F.lit(ends[e][k]).cast(t).alias(k) for k, t in kinds.items()]) for e in ("low", "high"))
    rows = positions.filter((file_order() >= low) & (file_order() <= high))
    inside = (F.col(ORDINAL) >= start) & (F.col(ORDINAL) < start + size)
    first = offsets.filter(overlap).select(FILE, "_first")
    numbered = rows.join(first, FILE).withColumn(ORDINAL, F.col("_first") + F.col(ROW))
    return numbered.filter(inside).drop(FILE, ROW, "_first")


def field_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill fields the source does not have from prefix + ordinal.

    Only a missing column gets the default. A NULL in a present column stays.
    """
    missing = {
        name: F.concat(F.lit(prefix), F.col(ORDINAL).cast("string"))
        for name, prefix in defaults.items()
        if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


# --- fixed values: prefixes of the field defaults --------------------------
ARTICLE_DEFAULTS = {"id": "wp_", "title": "Title ", "text": "Content "}
WEB_DEFAULTS = {"text": "Content ", "url": "https://example.com/"}


def with_fallback(df: DataFrame, row: dict) -> DataFrame:
    """The frame itself, or one literal row when it is empty.

    Emptiness is a count over at most one row; no join is needed.
    """
    empty = df.limit(1).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0")
    cells = [
        F.lit(row.get(field.name)).cast(field.dataType).alias(field.name) for field in df.schema
    ]
    return df.unionByName(empty.select(*cells))


def latest_preview(df: DataFrame, order: str, n: int = 3, width: int = 80) -> DataFrame:
    """First n rows in key order with shortened text (a top-n, not a full sort)."""
    return df.select(order, preview("text", width).alias("text_preview")).orderBy(order).limit(n)


def source_contract(df: DataFrame, required) -> dict:
    """Column names, missing columns and a three-row sample of a source."""
    missing = [c for c in required if c not in df.columns]
    return {"columns": df.columns, "missing": missing, "sample": df.limit(3)}


def schema_drift(df: DataFrame, name: str, expected) -> DataFrame:
    """One row for each column that a source should have or has: expected and found type,
    and what is wrong (`missing`, `type`, `extra`; NULL if nothing is), with the number of
    records and files that this concerns.

    Types come from the schema. Read a source of many files with the option `mergeSchema`
    and the schema is that of all footers; a column that only some files have is there.
    Records and files are counted from footers, so no column is read.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = []
    for column in [*wanted, *[c for c in found if c not in wanted]]:
        want, have = wanted.get(column), found.get(column)
        wrong = "missing" if have is None else "extra" if want is None else "type" if want != have else None
        values = {"column_name": column, "expected_type": want, "found_type": have, "problem": wrong}
        rows.append(F.struct(*[F.lit(v).cast("string").alias(k) for k, v in values.items()]))
    files = df.select(F.col("_metadata.file_path").alias(FILE)).groupBy(FILE).agg(F.count(F.lit(1)).alias("n"))
    counted = files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.count(FILE).alias("files"))
    return counted.select(F.lit(name).alias("source"), F.inline(F.array(*rows)), "records", "files")
