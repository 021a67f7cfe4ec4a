"""A bitmap of fixed size that keeps most unneeded rows out of a join's shuffle."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits of the bitmap (16 MB), whatever the number of keys: the more keys, the fewer rows
# it holds back. Spark's bitmaps have 4096 bytes, so there are that many of them.
BITS = 1 << 27


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose 64-bit key may be in `wanted`, and certainly all whose key is. The keys'
    places are broadcast as bitmaps; their size is bounded by BITS."""
    # Bucket numbers and bit positions of Spark's bitmap functions start at place 1.
    place = F.pmod(F.col(key), F.lit(BITS)) + 1
    maps = wanted.groupBy(F.bitmap_bucket_number(place).alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = rows.withColumn("_map", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "_map")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1)
    return held.where(bit == 1).select(*rows.columns)


def only_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose 64-bit key is in `wanted`, which has each key once and no other column.

    Not a semi-join: the planner moves one below the join with the bitmaps, and all rows
    are shuffled.
    """
    return maybe_among(rows, key, wanted).join(wanted, key)
