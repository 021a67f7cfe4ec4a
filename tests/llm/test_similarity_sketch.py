"""Sketches, their banding, and the dedup against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F
from test_parity_join import corpus, shingles

from corpusloom.llm import prefilter
from corpusloom.llm import similarity_sketch as S
from corpusloom.llm.components import components

SCHEMA = "doc_id long, text string, node string, keys long"


def expected(rows):
    """doc_id, size, smallest id of the component and kept, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        component = smallest.get(find(i)) if sets[i] else doc_id
        found.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(found, key=str)


def deduplicated(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in S.deduplicated(frame).collect()), key=str)


def test_every_coordinate_is_filled_and_estimates_similarity():
    rnd = np.random.default_rng(4)
    sizes = [1, 2, 3, 7, 20, 190, 700, 5000]
    sets = [np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    table = S.sketches(sets)
    assert (table != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (table == S.sketches(sets[:3] + [np.zeros(0, np.uint64)] + sets[3:])[[0, 1, 2, 4, 5, 6, 7, 8]]).all()
    base = np.unique(rnd.integers(0, 1 << 63, 4000).astype(np.uint64))
    for shared in (0.95, 0.85, 0.6, 0.2):
        n = int(len(base) * shared)
        other = np.unique(np.concatenate([base[:n], rnd.integers(0, 1 << 63, len(base) - n).astype(np.uint64)]))
        true = n / (len(base) + len(other) - n)
        a, b = S.sketches([np.sort(base), other])
        assert abs((a == b).mean() - true) < 5 * (true * (1 - true) / S.COORDINATES) ** 0.5


def test_few_similar_pairs_can_fall_below_the_agreement():
    least = S.least_agreement()
    assert 0.5 * S.COORDINATES < least < 0.7 * S.COORDINATES
    rnd = np.random.default_rng(6)
    agreeing = rnd.binomial(S.COORDINATES, 0.85, 1_000_000)
    assert agreeing.min() >= least
    # All bands missed at the threshold.
    assert (1 - 0.85**S.ROWS) ** S.BANDS < 1e-9


def test_components_against_brute_force(spark):
    rows = corpus(21, 140)
    assert deduplicated(spark, rows) == expected(rows)


def test_groups_that_no_representative_links(spark):
    # A chain of edits: neighbours are similar, ends are not; and many unlike sets that
    # share the larger part of their words, so buckets hold several components.
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for step in range(30):
        words[4 * step % 120] = f"new{step}"
        rows.append((200 - step, " ".join(words)))
    base = [f"b{k}" for k in range(90)]
    for k in range(60):
        own = list(base)
        for at in rnd.sample(range(90), 4):
            own[at] = f"own{k}-{at}"
        rows.append((500 + k, " ".join(own)))
    assert deduplicated(spark, rows) == expected(rows)


def test_blocks_hold_every_pair_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 3)
    nodes = [(node, 100, bytes([7]) * S.COORDINATES, bytes([3]) * 64) for node in range(40)]
    sets = spark.createDataFrame(nodes, "node long, size long, sketch binary, bits binary")
    buckets = spark.createDataFrame([(key, n, 40) for key in (1, 2) for n in range(40)], "key long, node long, n long")
    roots = components(spark.createDataFrame([(0, k) for k in range(1, 25)], "a long, b long"))
    pairs = [tuple(r) for r in S.apart(buckets, roots, sets).collect()]
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if b >= 25}
    assert set(pairs) == want and len(pairs) == len(want)
    # One partner of each set in each group of blocks.
    few = [tuple(r) for r in S.apart(buckets, roots, sets, closest=True).collect()]
    assert set(few) < want and {x for pair in few for x in pair} >= set(range(25, 40))


def test_bitmaps_hold_back_rows_and_lose_none(spark, monkeypatch):
    rows = spark.range(20_000).withColumn("key", F.xxhash64("id"))
    wanted = rows.where("id % 50 = 7").select("key")
    kept = prefilter.maybe_among(rows, "key", wanted)
    assert kept.where("id % 50 = 7").count() == 400 and kept.count() < 410
    # A bitmap that is too small for its keys holds back little, and loses none either.
    monkeypatch.setattr(prefilter, "BITS", 256)
    kept = prefilter.maybe_among(rows, "key", wanted)
    assert kept.where("id % 50 = 7").count() == 400 and kept.columns == rows.columns


def test_nulls_empty_long_and_repeated_rows(spark):
    long = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One\ttwo"), (6, long), (7, long + " end"), (7, long + " end"),
        (None, "one two"), (None, None), (None, "only words without any id"), (8, "one two three four five six"),
    ]
    assert deduplicated(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert deduplicated(spark, []) == []
