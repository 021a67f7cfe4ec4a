"""The Jaccard join against brute force, and its bounds."""

import random

import numpy as np
import pyarrow as pa

from corpusloom.llm import parity_join
from corpusloom.llm.components import components

SCHEMA = "doc_id long, text string, row_key string"


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def expected(rows):
    """Smallest id of each row's component, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), smallest[find(i)]) for i, (doc_id, _) in enumerate(rows))


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["Über", "ÉA", "The"]
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200]
    pool = [[rnd.choice(vocabulary) for _ in range(rnd.choice(sizes))] for _ in range(25)]
    rows = []
    for doc_id in range(n):
        words = list(rnd.choice(pool))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4, 8])):
            kind, at = rnd.random(), rnd.randrange(len(words))
            if kind < 0.5:
                words[at] = rnd.choice(vocabulary)
            elif kind < 0.75:
                words.append(rnd.choice(vocabulary))
            elif len(words) > 1:
                del words[at]
        rows.append((doc_id, rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows


def found(spark, rows):
    frame = spark.createDataFrame([(i, t, "own") for i, t in rows], SCHEMA)
    return sorted(tuple(r) for r in parity_join.join(frame).collect())


def test_join_matches_brute_force(spark):
    """Edited copies, empty texts, and a chain in which each text links with the next."""
    rows = corpus(1, 150) + [(900, ""), (901, None), (902, " \n ")]
    words = [f"v{k}" for k in range(160)]
    rows += [(1000 + i, " ".join(words[3 * i : 3 * i + 60])) for i in range(30)]
    result = found(spark, rows)
    assert result == expected(rows)
    assert {c for i, _, c in result if i >= 1000} == {1000}


def test_bounds_hold_for_random_sets():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 400))
        base = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
        drop = int(rng.integers(0, max(1, size // 4) + 1))
        other = np.concatenate([base[drop:], rng.integers(0, 2**63, drop // 2, dtype=np.int64).astype(np.uint64)])
        a, b = np.unique(base), np.unique(other)
        if not len(b):
            continue
        shared = len(np.intersect1d(a, b))
        differing = len(a) + len(b) - 2 * shared
        assert parity_join.hamming(parity_join.bit_sketch(a), parity_join.bit_sketch(b)) <= differing
        if parity_join.similar(shared, len(a), len(b)):
            assert set(parity_join.part_keys(a)) & set(parity_join.part_keys(b))


def test_whole_short_texts_and_order():
    a, b, c = parity_join.shingles(pa.array(["x y", "y x", "X  y"]))
    assert len(a) == 1 and a[0] == c[0] and a[0] != b[0]


def test_keep_one(spark):
    text = " ".join(f"k{n}" for n in range(40))
    rows = [(5, text), (2, text + " end"), (2, text + " end"), (9, "other words"), (None, text), (7, ""), (7, "")]
    frame = spark.createDataFrame([(i, t, "own") for i, t in rows], SCHEMA)
    kept = sorted((r.doc_id, r.text, r.row_key) for r in parity_join.keep_one(frame).collect())
    assert kept == [(2, text + " end", "own"), (7, "", "own"), (7, "", "own"), (9, "other words", "own")]


def test_missing_ids_and_empty_table(spark):
    assert found(spark, []) == []
    frame = spark.createDataFrame([(None, "a b", "x"), (4, "a b", "x"), (None, "", "x")], SCHEMA)
    result = {(r.doc_id, r.n_shingles, r.component_id) for r in parity_join.join(frame).collect()}
    assert result == {(None, 1, 4), (4, 1, 4), (None, 0, None)}


def test_components(spark):
    links = [(k, k + 1) for k in range(12)] + [(100, 90), (90, 80), (7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{k: 0 for k in range(13)}, 100: 80, 90: 80, 80: 80}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_sets_share_as_many_parts_as_stated():
    rng = np.random.default_rng(8)
    filtered = 0
    for _ in range(800):
        size = int(rng.integers(1, 600))
        base = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
        drop = int(rng.integers(0, max(1, size // 5) + 1))
        new = rng.integers(0, 2**63, int(rng.integers(0, max(1, size // 5) + 1)), dtype=np.int64).astype(np.uint64)
        a, b = np.unique(base), np.unique(np.append(base[drop:], new))
        if not len(b) or not parity_join.similar(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        shared = np.intersect1d(parity_join.part_keys(a), parity_join.part_keys(b))
        last = parity_join.band_of(max(len(a), len(b))) & 1
        for own in (a, b):
            least = parity_join.least_shared(own)[last]
            assert np.count_nonzero(shared & np.uint64(1) == last) >= least
            filtered += least > 1
    assert filtered > 100


def test_sets_that_share_too_little_are_not_compared(spark):
    """A common passage gives shared parts, but too few of them for two similar texts."""
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [f"{passage} " + " ".join(f"d{i}w{k}" for k in range(240)) for i in range(20)]
    rows = [(i, t, "own") for i, t in enumerate([*texts, texts[3] + " end"])]
    frame = spark.createDataFrame(rows, SCHEMA)
    sets = parity_join.members(frame)
    shared = parity_join.shared_parts(frame)
    assert shared.select("node").distinct().count() == 21
    held = parity_join.enough(shared, sets)
    assert held.select("node").distinct().count() == 2
    assert [c for i, _, c in found(spark, [(i, t) for i, t, _ in rows]) if i in (3, 20)] == [3, 3]
