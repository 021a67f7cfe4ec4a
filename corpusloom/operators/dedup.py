"""Latest-wins exact deduplication."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.text import digest
from corpusloom.operators.bitmaps import among, bitmaps
from corpusloom.sources.workdir import materialize

_RANK = "_rank"
# Bitmaps of winners (4096 bytes each) that are sent to every executor at most.
BROADCAST_BITMAPS = 16_384


def latest_rows(df: DataFrame, keys, order) -> DataFrame:
    """The first row of every key group in the given order; NULL keys group.

    Spark reduces each task's rows to one per key before the shuffle (window
    group limit), so a group that holds a third of the input arrives as one row
    per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(f"{_RANK} = 1").drop(_RANK)


def dedup_latest(df: DataFrame, text: str, url: str, order) -> DataFrame:
    """One row per (text, url), the latest. Groups on a digest of the text, so
    texts are neither compared nor kept in the sort key."""
    return latest_rows(
        df.withColumn("_digest", digest(text)), ["_digest", url], order
    ).drop("_digest")


def dedup_latest_by_row(df: DataFrame, text: str, url: str, order, row: str) -> DataFrame:
    """`dedup_latest` that shuffles no text. `row` numbers the rows, each number once.

    Winners are found on digest, address, order and number; then the source is read again
    and rows are kept whose number won. The winners are exact bitmaps, one bit for each
    number up to the largest; while their counted size allows they are broadcast (half a
    thousand million rows in 64 MB). Beyond that the texts go through the shuffle. The
    source must give the same rows each time it is read, as a table of files does.
    """
    winners = latest_rows(df.withColumn("_digest", digest(text)), ["_digest", url], order)
    maps = materialize(bitmaps(winners.select(row), row), "winners")
    if maps.count() > BROADCAST_BITMAPS:
        return dedup_latest(df, text, url, order)
    return among(df, row, maps)
