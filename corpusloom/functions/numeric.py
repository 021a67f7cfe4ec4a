"""Number expressions with one rounding and division rule for all reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(col, digits: int) -> Column:
    """Round a double on its scaled binary value, half away from zero.

    Spark's own `round(x, n)` works on the decimal text of the double and gives
    0.29 for 0.285; the scaled form gives 0.28.
    """
    scale = float(10**digits)
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def ratio(part, whole) -> Column:
    """part / whole as a double; NULL when the whole is zero."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part, whole, digits: int = 2) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    return round_to(ratio(F.lit(100.0) * part, whole), digits)


def count_where(condition) -> Column:
    return F.count_if(condition)


def weighted_mean(value, weight) -> Column:
    """Mean of per-group means weighted by group size."""
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(value * weight), F.sum(weight).cast("double"))


def chunks_of(total, size: int) -> Column:
    """Number of chunks of `size` rows that cover `total` rows."""
    return F.ceil(total / F.lit(size)).cast("long")
