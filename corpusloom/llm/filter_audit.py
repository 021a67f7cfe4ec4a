"""Audit of how document filters interact, by incremental retraction streaming.

All files are processed as available-now micro-batches. A row's failed filters are a bit
mask. Four filters look at the row alone; the fifth, E, fails a row whose text some
smaller doc_id has anywhere in the table, which a batch cannot know yet. So every row is
first counted as failing E, and a keyed state holds the rows with the smallest id of each
text seen so far: they are moved to their mask without E. When a later batch brings a
smaller id, the earlier holders' masks are retracted. The counters, one for each
combination of part, mask and label, are sums of such signed changes, and everything in
the report (kept, removed, redundant, Shapley sums) is a sum over masks.

State and changes are tables in the shared folder with one partition for each batch; a
batch that is run again reads only the state of earlier batches and writes the same
partitions again, so lost executors or a restarted stream change nothing. Texts are
compared by the first 128 bits of their SHA-256 and never shuffled; a text that a third
of all rows share is reduced to one minimum a task before it is shuffled, and joins are
keyed on text and id together.

Defined results: a null text is empty, a null lang the part ''. Words are runs of anything
but space and 0x09 to 0x0D. A row without an id never fails E and makes no other row fail
it; repeated rows of one id are counted each and do not fail E because of each other. A
document is good or toxic if any of its label rows says so; label rows without an id say
nothing. An empty table gives an empty report. Only doc_id, text and lang are read, so
further columns cannot clash.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.tables import write_table
from corpusloom.sources.workdir import fresh_dir, materialize, path_exists

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 100, 80, 10
MARKS = "[#$%&*|]"
# All files are taken in about so many batches, so the state is read so many times.
BATCHES = 4

_SPACE = r"[ \t-\r]+"
_E = 1 << FILTERS.index("E")
_CELL = ("part", "mask", "good", "toxic")
# Tables of a base folder; a batch without rows leaves one without files.
_CHANGES = "part string, mask int, good boolean, toxic boolean, n long, _batch int"
_STATE = "text_key binary, doc_id long, part string, mask int, good boolean, toxic boolean, _batch int"


def document_files(spark: SparkSession, path: str, schema, batches: int = BATCHES) -> DataFrame:
    """A Parquet file or folder as a stream of about so many batches."""
    files = spark.read.schema(schema).parquet(path).select("_metadata.file_path").distinct().count()
    # The last letter as a pattern: a stream takes a single file by pattern only.
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-files // batches)))
    return reader.parquet(pattern)


def failed(text) -> Column:
    """Bit mask of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = (
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS_PERCENT * F.length(text),
        text.rlike(MARKS),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def labelled(labels: DataFrame) -> DataFrame:
    """`good` and `toxic` for each labelled id."""
    return labels.dropna(subset=["doc_id"]).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )


def marked(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Text key, id, part, mask without E and labels of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        F.unhex(F.left(F.sha2(text, 256), F.lit(32))).alias("text_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        failed(text).alias("mask"),
    )
    said = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return rows.join(labelled(labels), "doc_id", "left").select("text_key", "doc_id", "part", "mask", *said)


def _counted(rows: DataFrame, mask, sign: int) -> DataFrame:
    cells = rows.select("part", mask.alias("mask"), "good", "toxic")
    return cells.groupBy(*_CELL).agg((F.count(F.lit(1)) * sign).alias("n"))


def _moved(rows: DataFrame, sign: int) -> DataFrame:
    """The change when rows stop failing E (sign 1) or fail it after all (sign -1)."""
    mask = F.col("mask")
    return _counted(rows, mask, sign).union(_counted(rows, mask.bitwiseOR(_E), -sign))


def take_batch(batch: DataFrame, number: int, base: str) -> None:
    """Count a batch's rows, and move the rows with the smallest ids of their texts."""
    rows = materialize(batch, "audit-rows")
    unnamed, named = rows.where("doc_id is null"), rows.where("doc_id is not null")
    lows = named.groupBy("text_key").agg(F.min("doc_id").alias("new"))
    lows = lows.withColumn("old", F.lit(None).cast("long"))
    state = None
    if path_exists(rows.sparkSession, f"{base}/state"):
        state = rows.sparkSession.read.schema(_STATE).parquet(f"{base}/state").where(F.col("_batch") < number)
        held = state.groupBy("text_key").agg(F.min("doc_id").alias("old"))
        held = held.select("text_key", F.lit(None).cast("long").alias("new"), "old")
        lows = lows.union(held).groupBy("text_key").agg(F.min("new").alias("new"), F.min("old").alias("old"))
    lows = lows.where("new is not null and (old is null or new <= old)")
    gained = named.join(lows.select("text_key", F.col("new").alias("doc_id")), ["text_key", "doc_id"])
    gained = materialize(gained, "audit-gained")
    every = _counted(named, F.col("mask").bitwiseOR(_E), 1).union(_counted(unnamed, F.col("mask"), 1))
    changes = every.union(_moved(gained, 1))
    if state is not None:
        passed = lows.where("new < old").select("text_key", F.col("old").alias("doc_id"))
        changes = changes.union(_moved(state.join(passed, ["text_key", "doc_id"]), -1))
    changes = changes.groupBy(*_CELL).agg(F.sum("n").alias("n"))
    at = F.lit(number).alias("_batch")
    write_table(changes.select("*", at), f"{base}/changes", "overwrite", ["_batch"], balance=False)
    write_table(gained.select("*", at), f"{base}/state", "overwrite", ["_batch"], balance=False)


def counters(stream: DataFrame, labels: DataFrame, base: str) -> DataFrame:
    """Rows for each part, mask of failed filters and labels, after the whole stream."""
    query = (
        marked(stream, labels)
        .writeStream.foreachBatch(lambda batch, number: take_batch(batch, number, base))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = stream.sparkSession
    if not path_exists(spark, f"{base}/changes"):
        return spark.createDataFrame([], "part string, mask int, good boolean, toxic boolean, n long")
    return spark.read.schema(_CHANGES).parquet(f"{base}/changes").groupBy(*_CELL).agg(F.sum("n").alias("n"))


def with_steps(parts: DataFrame) -> DataFrame:
    """Every part with every step of every order: its filter's bit and those before it."""
    orders = F.lit(",".join(map("".join, permutations(FILTERS))))
    rows = parts.withColumn("filter_order", F.explode(F.split(orders, ",")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    mask_of = lambda letters: sum(
        (F.when(F.contains(letters, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0)
    )
    order, step = F.col("filter_order"), F.col("step")
    bit, before = mask_of(F.substring(order, step, F.lit(1))), mask_of(F.left(order, step - 1))
    return rows.withColumns({"bit": bit, "before": before})


def _over(name: str, wanted) -> Column:
    """Sum of a part's counts over the masks that `wanted` accepts."""
    counts = F.transform(name, lambda n, mask: F.when(wanted(mask.cast("int")), n).otherwise(0))
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)


def report(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the counters.

    The orders in which a filter is the one to remove a row are those that put it before
    the row's other failed filters: their share of all orders is one by the number of
    failed filters.
    """
    masks = range(1 << len(FILTERS))
    n = F.col("n")
    sums = {"n": n, "good": F.when(F.col("good"), n), "toxic": F.when(F.col("toxic"), n)}
    arrays = [
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, c)), F.lit(0)) for m in masks]).alias(f"_{k}")
        for k, c in sums.items()
    ]
    parts = counts.groupBy("part").agg(*arrays)
    rows = with_steps(parts)
    bit, before = F.col("bit"), F.col("before")
    fails = lambda mask: mask.bitwiseAND(bit) != 0
    earlier = lambda mask: mask.bitwiseAND(before) != 0
    here = lambda mask: fails(mask) & ~earlier(mask)
    orders = factorial(len(FILTERS))
    weighed = F.transform(
        "_n", lambda n, m: F.when(fails(m.cast("int")), n * (orders / F.bit_count(m)).cast("long")).otherwise(0)
    )
    return rows.select(
        "part",
        "filter_order",
        "step",
        _over("_n", lambda mask: mask.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        _over("_n", here).alias("removed"),
        _over("_n", lambda mask: fails(mask) & earlier(mask)).alias("redundant"),
        _over("_n", lambda mask: mask == bit).alias("unique_fails"),
        _over("_good", here).alias("good_lost"),
        _over("_toxic", here).alias("toxic_lost"),
        F.aggregate(weighed, F.lit(0).cast("long"), lambda a, b: a + b).alias("shapley"),
    )


def audit(stream: DataFrame, labels: DataFrame, base: str | None = None) -> DataFrame:
    """The report over a stream of documents. `base` is where state, changes and
    checkpoint live; an audit started there again goes on with the files that are new."""
    return report(counters(stream, labels, base or fresh_dir(stream.sparkSession, "audit")))
