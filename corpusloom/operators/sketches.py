"""Approximate counts and quantiles from sketches that are stored with each chunk.

A sketch is made once, where a chunk is read anyway, and merged over any set of chunks
later, so summaries of many chunks need not read texts or records again. Opt-in: the
exact forms are in `aggregates`.

Distinct counts use HyperLogLog sketches with 2**LG_REGISTERS registers: a relative
standard error of 1.04 / sqrt(registers), 0.8 % with 14. Quantiles use KLL sketches: with
QUANTILE_K a rank is off by less than RANK_ERROR of all values, with 99 % confidence.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_REGISTERS, QUANTILE_K = 14, 800
DISTINCT_ERROR, RANK_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2), 0.005

RECORDS, _DISTINCT, _VALUES = "records", "distinct_", "values_"


def chunk_sketches(rows: DataFrame, keys, distinct=(), values=()) -> DataFrame:
    """One row for each chunk: records, and a sketch for each column to count or rank.

    Tasks build sketches of what they read, and only sketches are shuffled. NULLs are
    in none.
    """
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(RECORDS),
        *[F.hll_sketch_agg(c, LG_REGISTERS).alias(f"{_DISTINCT}{c}") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_K).alias(f"{_VALUES}{c}") for c in values],
    )


def merged_sketches(sketches: DataFrame, keys) -> DataFrame:
    """Sketches of chunks merged per key, in the same form, so they can be merged again."""
    merge = {_DISTINCT: F.hll_union_agg, _VALUES: F.kll_merge_agg_double}
    own = [
        fn(c).alias(c) for c in sketches.columns for prefix, fn in merge.items() if c.startswith(prefix) and c not in keys
    ]
    return sketches.groupBy(*keys).agg(F.sum(RECORDS).alias(RECORDS), F.count(F.lit(1)).alias("chunks"), *own)


def distinct_estimate(column: str):
    return F.hll_sketch_estimate(f"{_DISTINCT}{column}")


def quantile_estimate(column: str, share: float = 0.5):
    return F.kll_sketch_get_quantile_double(f"{_VALUES}{column}", F.lit(share))
