"""Aggregates that hold up on skewed groups: histograms, medians, distincts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.sources.workdir import materialize

FREQ = "_n"


def histogram(df: DataFrame, *columns) -> DataFrame:
    """Rows per combination of values. Tasks count locally before the shuffle,
    so equal rows travel once per task however large their group is."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(FREQ))


def _entries(rows: DataFrame, keys, measures: dict, total: str | None) -> DataFrame:
    """One row for each record and measure: its value and its cells, coarse to fine."""
    depth = max(len(cells) for _, cells in measures.values())
    weight = F.col(FREQ) if FREQ in rows.columns else F.lit(1).cast("long")
    entries = [
        F.struct(
            F.lit(name).alias("_measure"),
            F.col(column).cast("double").alias("_value"),
            *[(cells[i] if i < len(cells) else F.lit(0)).cast("long").alias(f"_cell{i}") for i in range(depth)],
        )
        for name, (column, cells) in measures.items()
    ]
    found = rows.select(*keys, weight.alias(FREQ), F.inline(F.array(*entries))).filter("_value IS NOT NULL")
    if total is not None:
        (key,) = keys
        found = found.withColumn(key, F.explode(F.array(F.col(key), F.lit(total))))
    return found


def exact_medians(rows: DataFrame, keys, measures: dict, total: str | None = None) -> DataFrame:
    """Exact medians per key by distributed selection, with linear interpolation.

    `measures` maps a result name to (column, cells): one or more coarse to fine,
    order-preserving integers of the value, each with a bounded number of steps inside
    the one before. The rows are counted per cell; the totals show which cells hold the
    two middle ranks. Rows of those cells are counted per finer cell, and in the finest
    ones the values are ranked. So what is shuffled is bounded by the number of cells, and
    no task sees all values of a group. The cells of the middle ranks, two for each key and
    measure, are written, so that the planner broadcasts them if they are small.

    A column `FREQ` gives how often a row counts. With `total`, one key gets a row of that
    name with the medians over all rows. Rows with a NULL key have no median. The rows are
    read once for each level and once for the values, and should be a written table.
    """
    keys = list(keys)
    measures = {m: (c, [x] if isinstance(x, Column) else list(x)) for m, (c, x) in measures.items()}
    depth = max(len(cells) for _, cells in measures.values())
    entries = _entries(rows, keys, measures, total)
    group = [*keys, "_measure"]
    targets = None
    for level in range(depth):
        cell, inside = f"_cell{level}", [f"_cell{i}" for i in range(level)]
        ranked = [] if targets is None else ["_rank", "_before"]
        near = entries if targets is None else entries.join(targets, [*group, *inside])
        counted = near.groupBy(*group, *ranked, *inside, cell).agg(F.sum(FREQ).alias("_in"))
        up_to = W.partitionBy(*group, *ranked, *inside).orderBy(cell)
        counted = counted.withColumn("_until", F.sum("_in").over(up_to))
        if targets is None:
            last = F.sum("_in").over(W.partitionBy(*group)) - 1
            ranks = F.array_distinct(F.array(F.floor(last / 2), F.ceil(last / 2)))
            counted = counted.withColumns({"_before": F.lit(0).cast("long"), "_ranks": ranks})
            counted = counted.withColumn("_rank", F.explode("_ranks"))
        until = F.col("_before") + F.col("_until")
        held = (until > F.col("_rank")) & (until - F.col("_in") <= F.col("_rank"))
        found = counted.filter(held).select(*group, "_rank", (until - F.col("_in")).alias("_before"), *inside, cell)
        targets = materialize(found, "middle-cells")
    cells = [f"_cell{i}" for i in range(depth)]
    values = entries.join(targets, [*group, *cells]).groupBy(*group, "_rank", "_before", "_value")
    values = values.agg(F.sum(FREQ).alias(FREQ))
    upward = W.partitionBy(*group, "_rank").orderBy("_value")
    values = values.withColumn("_until", F.col("_before") + F.sum(FREQ).over(upward))
    middle = values.filter((F.col("_until") > F.col("_rank")) & (F.col("_until") - F.col(FREQ) <= F.col("_rank")))
    return middle.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("_measure") == m, F.col("_value"))).alias(m) for m in measures]
    )


def distinct_per_group(df: DataFrame, *columns) -> DataFrame:
    """Count distinct values of several columns, and rows, in two levels.

    The first level groups by all the columns together and leaves one row per
    combination. Counting each column on that small frame avoids multiplying
    the input rows once per distinct column.
    """
    combos = histogram(df, *columns)
    return combos.agg(
        F.sum(FREQ).alias("total_records"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in columns],
    )


def uniqueness_deficit(df: DataFrame, key: str) -> DataFrame:
    """Rows minus distinct keys."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("failing_records"))
