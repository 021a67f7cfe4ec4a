"""Table writes that can be repeated: modes, chunk replace, keyed upsert."""

from functools import reduce
from math import ceil, log2
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.dedup import latest_rows
from corpusloom.sources.workdir import materialize, move_each, partition_values, path_exists, remove, remove_each

# A row's bucket is the last `_bits` bits of its key's hash. Buckets of a table may differ
# in bits, since a bucket that is full is split into longer ones.
BITS, BUCKET = "_bits", "_bucket"
PARTITIONS = [BITS, BUCKET]
# A bucket with more rows is split.
ROWS_PER_BUCKET = 1_000_000
MOST_BITS = 40


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_cols=(),
    run_ts=None,
    balance: bool = True,
) -> None:
    """Write Parquet; with partition columns an overwrite replaces only the
    partitions present in `df`, so a rerun gives the same table.

    `balance` asks for a rebalance before the write: small partitions share a
    file, a partition that holds a third of all rows is split over many tasks.
    """
    if run_ts is not None:
        df = df.withColumn("_processing_timestamp", F.lit(run_ts).cast("timestamp_ntz"))
    if partition_cols and balance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a written table, with its columns in the order of `schema`."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table from a frame and read it back; with `path` its
    files lie there and stay when the table is dropped."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.read.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_chunks(df: DataFrame, path: str, chunk_cols, balance: bool = False) -> None:
    """Replace whole chunks. Chunks not in `df` stay, and the table is not read."""
    write_table(df, path, "overwrite", chunk_cols, balance=balance)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def merged(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """Target rows whose key has no update, plus all updates.

    Keys compare with plain equality, so a NULL key never matches and is
    inserted.
    """
    condition = reduce(and_, [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys])
    kept = target.alias("t").join(updates.select(*keys).alias("u"), condition, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def bucket_columns(hashed: Column, bits) -> dict[str, Column]:
    """The bucket of a hash, for a number of bits."""
    bits = (F.lit(bits) if isinstance(bits, int) else bits).cast("int")
    number = hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    return {BITS: bits, BUCKET: number}


def match_hash(df: DataFrame, keys) -> Column:
    """Hash of a key that equals no other key if a part of it is NULL: such rows are dealt
    out by all their columns, so they never fill one bucket."""
    plain = [name for name, kind in df.dtypes if "map<" not in kind and name not in PARTITIONS]
    some_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return F.when(some_null, F.xxhash64(*plain)).otherwise(F.xxhash64(*keys))


def group_hash(df: DataFrame, keys) -> Column:
    """Hash of a key whose NULL parts equal each other."""
    return F.xxhash64(*keys)


def table_buckets(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(bits, number) of the buckets of a keyed table, from its folders."""
    found = []
    for bits in partition_values(spark, path, BITS):
        found += [(int(bits), int(n)) for n in partition_values(spark, f"{path.rstrip('/')}/{BITS}={bits}", BUCKET)]
    return found


def is_keyed(spark: SparkSession, path: str) -> bool:
    return bool(partition_values(spark, path, BITS))


def located(rows: DataFrame, hashed: Column, buckets: list[tuple[int, int]]) -> DataFrame:
    """Rows with the bucket of the table that their hash belongs to.

    Each hash ends like one bucket at most. If there is none, since no row came there
    yet, the row starts a bucket of as many bits as the longest ones have. Tables have
    few different numbers of bits; each but the largest is looked up in a join.
    """
    *shorter, longest = sorted({bits for bits, _ in buckets})
    chosen, found = F.lit(longest), rows
    for bits in shorter:
        name = f"_in{bits}"
        there = rows.sparkSession.createDataFrame([(n, True) for b, n in buckets if b == bits], f"_n long, {name} boolean")
        ending = bucket_columns(hashed, bits)[BUCKET]
        found = found.join(there, ending == F.col("_n"), "left").drop("_n")
        chosen = F.when(F.col(name), bits).otherwise(chosen)
    return found.withColumn(BITS, chosen).withColumns(bucket_columns(hashed, F.col(BITS))).drop(*[f"_in{b}" for b in shorter])


def _first_bits(buckets: int | None) -> int:
    return max(0, (buckets or 1) - 1).bit_length()


def _rewrite(updates: DataFrame, path: str, hash_of, buckets: int | None, limit: int, combine) -> None:
    """Combine the buckets that `updates` touches and swap them in, then split full ones.

    The new content is written beside the table first, so the table is never
    overwritten by a job that also reads it, and a failure while swapping leaves a full
    copy of the new buckets in `<path>.staged`, which the next update takes in first.
    Untouched buckets are not read.
    """
    spark, staged = updates.sparkSession, f"{path.rstrip('/')}.staged"
    _swap(spark, path)
    hashed = hash_of(updates)
    if path_exists(spark, path):
        if not is_keyed(spark, path):
            raise ValueError(f"{path} is not a keyed table")
        rows = located(updates, hashed, table_buckets(spark, path)).select(*updates.columns, *PARTITIONS)
        touched = rows.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("_updates"))
        # Written, so that its size is known: it prunes the scan of the table.
        touched = materialize(touched, "touched").where("_updates > 0").drop("_updates")
        target = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
        combined = combine(target.join(touched, PARTITIONS, "left_semi"), rows)
    else:
        rows = updates.withColumns(bucket_columns(hashed, _first_bits(buckets)))
        combined = combine(None, rows)
    write_table(combined, staged, "errorifexists", PARTITIONS)
    if not table_buckets(spark, staged):
        # No updates: nothing was staged, and a table that is not there yet stays so.
        remove(spark, staged)
        return
    new = read_table(spark, staged, rows.schema)
    # Counted from footers; at most one row for each bucket.
    sizes = new.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).collect()
    full = [(bits, n, min(MOST_BITS, bits + ceil(log2(rows_in / limit)))) for bits, n, rows_in in sizes]
    full = [bucket for bucket in full if bucket[2] > bucket[0]]
    _swap(spark, path)
    if full:
        longer = spark.createDataFrame(full, f"{BITS} int, {BUCKET} long, _to int")
        target = spark.read.schema(rows.schema).parquet(path).select(*rows.columns).join(longer, PARTITIONS)
        parts = target.withColumns(bucket_columns(hash_of(target.drop("_to")), F.col("_to"))).drop("_to")
        write_table(parts.select(*rows.columns), staged, "errorifexists", PARTITIONS)
        _swap(spark, path)


def _by_bits(buckets: list[tuple[int, int]]) -> dict[int, set[int]]:
    numbers = {bits: set() for bits, _ in buckets}
    for bits, n in buckets:
        numbers[bits].add(n)
    return numbers


def _swap(spark: SparkSession, path: str) -> None:
    """Take over complete staged buckets: drop the shorter buckets that they were split
    from, move each into its place, and drop what is left of the staged copy.

    No row is read or written. Where all buckets of a length are new, their common folder
    is moved; else as many folders are moved as there are new buckets. A staged bucket is
    there until it is in its place, so a failure at any point is mended by doing this again.
    """
    table, staged = path.rstrip("/"), f"{path.rstrip('/')}.staged"
    if path_exists(spark, f"{staged}/_SUCCESS"):
        new, old = _by_bits(table_buckets(spark, staged)), _by_bits(table_buckets(spark, table))
        for bits, numbers in old.items():
            split = numbers & {n % (1 << bits) for b, longer in new.items() if b > bits for n in longer}
            if split == numbers:
                remove(spark, f"{table}/{BITS}={bits}")
            elif split:
                remove_each(spark, f"{table}/{BITS}={bits}", [f"{BUCKET}={n}" for n in split])
        for bits, numbers in new.items():
            folder = f"{BITS}={bits}"
            if old.get(bits, set()) <= numbers:
                move_each(spark, staged, table, [folder])
            else:
                move_each(spark, f"{staged}/{folder}", f"{table}/{folder}", [f"{BUCKET}={n}" for n in numbers])
    if path_exists(spark, staged):
        remove(spark, staged)


def upsert(
    updates: DataFrame, path: str, keys, buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> None:
    """Update matching rows, insert the others, create the table if missing.

    Rows live in hash buckets of the key; only buckets with updates are read and
    rewritten, and a bucket that gets more than `rows_per_bucket` rows is split. `buckets`
    is how many a new table starts with. Without keys this is a plain append, which a
    keyed table refuses. Two updates for one key have no defined winner and are refused.
    It assumes one writer, and readers that wait for it.
    """
    spark = updates.sparkSession
    if not keys:
        if is_keyed(spark, path):
            raise ValueError(f"{path} is a keyed table; updates need its keys")
        write_table(updates, path, "append")
        return
    if duplicate_keys(updates.dropna(subset=list(keys)), keys).limit(1).count():
        raise ValueError(f"updates hold more than one row for the same {list(keys)}")
    _rewrite(
        updates, path, lambda df: match_hash(df, keys), buckets, rows_per_bucket,
        lambda target, new: new if target is None else merged(target, new, keys),
    )


def upsert_latest(
    updates: DataFrame, path: str, keys, order, buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> None:
    """Keep the latest row per key over the table and the updates.

    NULL keys form one group, as in the batch dedup. Applying the same updates
    again changes nothing.
    """
    _rewrite(
        updates, path, lambda df: group_hash(df, keys), buckets, rows_per_bucket,
        lambda target, new: latest_rows(
            new if target is None else target.unionByName(new), keys, order
        ),
    )
