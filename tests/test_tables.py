import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedup
from corpusloom.operators.dedup import dedup_latest
from corpusloom.sources import tables
from corpusloom.sources.workdir import folder_names, fresh_dir


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data):
    return spark.createDataFrame(data, "k long, v string")


def test_upsert_updates_and_inserts_and_repeats(spark):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, [(i, "old") for i in range(50)]), path, ["k"], 8)
    updates = frame(spark, [(3, "new"), (100, "new")])
    for _ in range(2):
        tables.upsert(updates, path, ["k"], 8)
        got = dict(rows(tables.read_table(spark, path).select("k", "v")))
        assert len(got) == 51 and got[3] == got[100] == "new" and got[4] == "old"


def test_upsert_refuses_two_updates_for_one_key(spark):
    path = fresh_dir(spark, "t")
    with pytest.raises(ValueError, match="more than one row"):
        tables.upsert(frame(spark, [(1, "a"), (1, "b")]), path, ["k"])


def test_lineitem_has_duplicate_keys(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    with pytest.raises(ValueError):
        tables.upsert(lines, fresh_dir(spark, "t"), ["l_orderkey", "l_linenumber"])


def test_null_keys_are_inserted(spark):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, [(None, "a"), (1, "b")]), path, ["k"], 4)
    tables.upsert(frame(spark, [(None, "c")]), path, ["k"], 4)
    got = tables.read_table(spark, path).select("k", "v").collect()
    assert sorted(r["v"] for r in got) == ["a", "b", "c"]


def test_upsert_without_keys_appends(spark):
    path = fresh_dir(spark, "t")
    for _ in range(2):
        tables.upsert(frame(spark, [(1, "a")]), path, [])
    assert tables.read_table(spark, path).count() == 2


def test_overwrite_replaces_only_its_partitions(spark):
    path = fresh_dir(spark, "t")
    tables.write_table(frame(spark, [(1, "a"), (2, "b")]), path, "overwrite", ["v"])
    tables.write_table(frame(spark, [(9, "b")]), path, "overwrite", ["v"], run_ts="2024-01-01 00:00:00")
    got = rows(tables.read_table(spark, path, frame(spark, []).schema))
    assert got == [(1, "a"), (9, "b")]


def test_hot_partition_is_written_by_several_tasks(spark, monkeypatch):
    """A partition with almost all rows is split over files, not one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        path = fresh_dir(spark, "hot")
        df = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
            F.when(F.col("id") < 10, "cold").otherwise("hot").alias("p"),
        )
        tables.write_table(df, path, "overwrite", ["p"])
        hot = tables.read_table(spark, path).filter("p = 'hot'")
        assert hot.count() == 199_990 and len(hot.inputFiles()) > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_chunk_replace_keeps_other_chunks(spark):
    path = fresh_dir(spark, "t")
    data = spark.createDataFrame([("d", 0, "a"), ("d", 1, "b")], "dataset string, c int, v string")
    tables.replace_chunks(data, path, ["dataset", "c"])
    again = spark.createDataFrame([("d", 1, "x"), ("d", 1, "y")], data.schema)
    for _ in range(2):
        tables.replace_chunks(again, path, ["dataset", "c"])
    assert rows(tables.read_table(spark, path, data.schema)) == [
        ("d", 0, "a"), ("d", 1, "x"), ("d", 1, "y"),
    ]


TEXTS = [
    ("same", "u", 1, 1), ("same", "u", 3, 2), ("same", "u", 2, 3),
    ("same", "v", 1, 4),
    ("null url", None, 1, 5), ("null url", None, 2, 6),
    ("tie", "u", 1, 7), ("tie", "u", 1, 8),
]


def texts(spark, data=TEXTS):
    return spark.createDataFrame(data, "text string, url string, ts long, tie long")


def order():
    return [F.col("ts").desc(), F.col("tie").desc()]


def test_dedup_keeps_the_latest_and_is_idempotent(spark):
    once = dedup_latest(texts(spark), "text", "url", order())
    assert sorted(r["tie"] for r in once.collect()) == [2, 4, 6, 8]
    twice = dedup_latest(once, "text", "url", order())
    assert rows(twice.select("tie")) == rows(once.select("tie"))


def test_dedup_reduces_copies_before_the_shuffle(spark, plan_of):
    """One text holds almost all rows; each task sends one of them."""
    plan = plan_of(dedup_latest(texts(spark), "text", "url", order()))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange")


def test_dedup_by_row_moves_no_texts(spark, plan_of, monkeypatch):
    path = fresh_dir(spark, "t")
    rows_of = [(t, u, ts, tie * 40_000) for t, u, ts, tie in TEXTS] + [("x" * 50, "u", 1, 7)]
    texts(spark, rows_of).write.parquet(path)
    stored = spark.read.parquet(path)
    want = rows(dedup_latest(stored, "text", "url", order()).fillna("", ["url"]))
    got = dedup.dedup_latest_by_row(stored, "text", "url", order(), "tie")
    assert rows(got.fillna("", ["url"])) == want
    assert not [x for x in plan_of(got).splitlines() if "Exchange" in x and "text" in x]
    assert "SortMergeJoin" not in plan_of(got)
    # Too many winners to broadcast: the same rows through a shuffle.
    monkeypatch.setattr(dedup, "BROADCAST_BITMAPS", 2)
    assert rows(dedup.dedup_latest_by_row(stored, "text", "url", order(), "tie").fillna("", ["url"])) == want


def test_upsert_latest_equals_batch_dedup(spark):
    path = fresh_dir(spark, "t")
    for part in (TEXTS[:3], TEXTS[3:], TEXTS[:5]):
        tables.upsert_latest(texts(spark, part), path, ["text", "url"], order(), 4)
    got = tables.read_table(spark, path).select("tie")
    assert rows(got) == rows(dedup_latest(texts(spark), "text", "url", order()).select("tie"))


def test_catalog_table(spark):
    saved = tables.save_table(frame(spark, [(1, "a")]), "saved_frame")
    assert saved.count() == 1
    tables.drop_table(spark, "saved_frame")
    assert not spark.catalog.tableExists("saved_frame")


def test_bucket_number_belongs_to_the_table(spark):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, [(i, "old") for i in range(100)]), path, ["k"], 8)
    tables.upsert(frame(spark, [(i, "new") for i in range(10)]), path, ["k"], 16)
    got = tables.read_table(spark, path)
    assert got.count() == 100 and got.filter("v = 'new'").count() == 10
    with pytest.raises(ValueError, match="keyed table"):
        tables.upsert(frame(spark, [(1, "a")]), path, [])


def bucket_sizes(spark, path):
    got = tables.read_table(spark, path)
    return {(r[tables.BITS], r[tables.BUCKET]): r["count"] for r in got.groupBy(tables.BITS, tables.BUCKET).count().collect()}


def test_full_buckets_split_and_others_stay(spark):
    path = fresh_dir(spark, "t")
    keys = lambda n: spark.range(n).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    tables.upsert(keys(50), path, ["k"], rows_per_bucket=100)
    assert bucket_sizes(spark, path) == {(0, 0): 50}
    tables.upsert(keys(1_000), path, ["k"], rows_per_bucket=100)
    sizes = bucket_sizes(spark, path)
    assert sum(sizes.values()) == 1_000 and len(sizes) >= 10
    # Buckets cover every hash once: none is the end of another.
    assert not [1 for b, n in sizes for c, m in sizes if b < c and m % (1 << b) == n]
    before = {f.split("/")[-1] for f in tables.read_table(spark, path).inputFiles()}
    tables.upsert(frame(spark, [(3, "new"), (5_000, "new")]), path, ["k"], rows_per_bucket=100)
    got = tables.read_table(spark, path)
    after = {f.split("/")[-1] for f in got.inputFiles()}
    assert len(before - after) <= 2
    assert got.count() == 1_001 and got.select("k").distinct().count() == 1_001
    assert got.filter("v = 'new'").count() == 2
    # Ten times as many rows; all buckets stay about as small as asked for.
    tables.upsert(keys(10_000), path, ["k"], rows_per_bucket=100)
    assert max(bucket_sizes(spark, path).values()) <= 150
    assert tables.read_table(spark, path).count() == 10_000


def test_rows_without_a_key_do_not_fill_one_bucket(spark):
    path = fresh_dir(spark, "t")
    rows = spark.range(2_000).select(F.lit(None).cast("long").alias("k"), F.col("id").cast("string").alias("v"))
    tables.upsert(rows, path, ["k"], rows_per_bucket=200)
    assert max(bucket_sizes(spark, path).values()) <= 400
    assert tables.read_table(spark, path).count() == 2_000


def test_equal_hashes_cannot_be_split_for_ever(spark):
    path = fresh_dir(spark, "t")
    rows = spark.createDataFrame([(None, "same")] * 30, "k long, v string")
    for _ in range(2):
        tables.upsert(rows, path, ["k"], rows_per_bucket=10)
    assert tables.read_table(spark, path).count() == 60


def test_only_touched_buckets_are_read(spark, plan_of, monkeypatch):
    path = fresh_dir(spark, "t")
    keys = spark.range(1_000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    tables.upsert(keys, path, ["k"], rows_per_bucket=50)
    plans = []
    real = tables.merged
    monkeypatch.setattr(tables, "merged", lambda t, u, k: plans.append(plan_of(t)) or real(t, u, k))
    tables.upsert(frame(spark, [(3, "new")]), path, ["k"], rows_per_bucket=50)
    assert "dynamicpruning" in plans[0]


def test_split_that_was_interrupted_is_finished(spark, monkeypatch):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, [(i, "old") for i in range(20)]), path, ["k"])
    with monkeypatch.context() as patch:
        real, calls = tables._swap, []

        def stop(*args):
            calls.append(args)
            if len(calls) == 3:
                raise RuntimeError("lost")
            real(*args)

        patch.setattr(tables, "_swap", stop)
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert(frame(spark, [(i, "new") for i in range(10, 40)]), path, ["k"], rows_per_bucket=10)
    tables.upsert(frame(spark, [(1, "newer")]), path, ["k"], rows_per_bucket=10)
    got = dict(rows(tables.read_table(spark, path).select("k", "v")))
    assert len(got) == 40 == tables.read_table(spark, path).count()
    assert got[1] == "newer" and got[2] == "old" and got[12] == "new"
    assert len(bucket_sizes(spark, path)) > 2


def test_updates_without_rows(spark):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, []), path, ["k"])
    assert not tables.path_exists(spark, path)
    tables.upsert(frame(spark, [(1, "a")]), path, ["k"])
    tables.upsert(frame(spark, []), path, ["k"])
    assert tables.read_table(spark, path).count() == 1


def test_interrupted_swap_is_finished_by_the_next_update(spark, monkeypatch):
    path = fresh_dir(spark, "t")
    tables.upsert(frame(spark, [(i, "old") for i in range(20)]), path, ["k"], 4)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        real = tables._swap
        calls = []
        patch.setattr(tables, "_swap", lambda *a: stop() if calls else (calls.append(1), real(*a)))
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert(frame(spark, [(3, "new")]), path, ["k"])
    tables.upsert(frame(spark, [(4, "newer")]), path, ["k"])
    got = dict(rows(tables.read_table(spark, path).select("k", "v")))
    assert len(got) == 20 and got[3] == "new" and got[4] == "newer" and got[5] == "old"


def test_update_of_all_buckets_moves_folders_of_buckets(spark, monkeypatch):
    """As many moves as there are lengths of buckets, not one for each bucket; an update
    of a few moves those alone."""
    path, moved = fresh_dir(spark, "table"), []
    real = tables.move_each
    monkeypatch.setattr(tables, "move_each", lambda s, f, t, names: (moved.append(len(names)), real(s, f, t, names)))
    rows = spark.range(4000).select("id", F.lit(0).alias("v"))
    tables.upsert(rows, path, ["id"], buckets=64, rows_per_bucket=1000)
    tables.upsert(rows.withColumn("v", F.lit(1)), path, ["id"], rows_per_bucket=1000)
    assert len(tables.table_buckets(spark, path)) == 64 and moved == [1, 1]
    tables.upsert(spark.createDataFrame([(5, 2)], "id long, v int"), path, ["id"], rows_per_bucket=1000)
    assert moved == [1, 1, 1] and len(tables.table_buckets(spark, path)) == 64
    counts = {r["v"]: r["count"] for r in tables.read_table(spark, path).groupBy("v").count().collect()}
    assert counts == {1: 3999, 2: 1}


def test_names_in_a_folder(spark, tmp_path):
    names = ["a", "b, c", "_bits=1", " d", "[e]", "é"]
    for name in names:
        (tmp_path / name).mkdir()
    assert sorted(folder_names(spark, str(tmp_path))) == sorted(names)
    assert folder_names(spark, f"{tmp_path}/a") == [] and folder_names(spark, f"{tmp_path}/none") == []
