"""Sets of non-negative numbers as bitmaps that a scan can be tested against.

A bitmap holds 32,768 consecutive numbers in 4096 bytes, Spark's own layout.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MAP, _BITS = "_map", "_map_bits"


def _place(number) -> Column:
    # Spark's bitmap functions number buckets from 1 for the places from 1 on.
    return (F.col(number) if isinstance(number, str) else number) + 1


def bitmaps(numbers: DataFrame, number) -> DataFrame:
    """One row of 4096 bytes for each 32,768 numbers of which one occurs."""
    place = _place(number)
    return numbers.groupBy(F.bitmap_bucket_number(place).alias(_MAP)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(_BITS)
    )


def among(rows: DataFrame, number, maps: DataFrame) -> DataFrame:
    """Rows whose number is in the bitmaps. They are broadcast: bound their number first."""
    at = F.bitmap_bit_position(_place(number))
    byte = F.conv(F.hex(F.substring(_BITS, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1)
    held = rows.withColumn(_MAP, F.bitmap_bucket_number(_place(number))).join(F.broadcast(maps), _MAP)
    return held.where(bit == 1).select(*rows.columns)
