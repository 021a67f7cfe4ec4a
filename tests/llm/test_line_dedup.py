"""Line dedup against brute force over all pairs of lines."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm import line_dedup
from corpusloom.llm.prefilter import only_among

SCHEMA = "doc_id long, text string, number string, n_chars long"


def words(line):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    return frozenset(w for w in lowered.split(" ") if w)


def expected(rows):
    """Line numbers to remove, per (id, text), for rows in the order of ids."""
    seen, out = [], {}
    for doc_id, text in rows:
        gone = out.setdefault((doc_id, text), [])
        for at, line in enumerate((text or "").split("\n")):
            own = words(line)
            if not own:
                continue
            if any(4 * len(own & w) >= 3 * len(own | w) for w in seen):
                gone.append(at)
            seen.append(own)
    return out


def corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Über", "éa", "the", "The"]
    pool = [[rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 5, 8, 12, 30]))] for _ in range(40)]
    rows = []
    for doc_id in range(n):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            line = list(rnd.choice(pool))
            if rnd.random() < 0.6:
                line[rnd.randrange(len(line))] = rnd.choice(vocabulary)
            lines.append(rnd.choice([" ", "  ", "\t"]).join(line))
        lines += [""] * rnd.randint(0, 2)
        rows.append((doc_id, "\n".join(lines)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "own", len(t) if t is not None else None) for i, t in rows], SCHEMA)


def test_removed_lines_match_brute_force(spark):
    long = " ".join(f"t{k}" for k in range(3000))
    rows = [*corpus(1, 60), (100, long), (101, long + " more"), (102, "\n".join(["same"] * 2000))]
    found = line_dedup.report(frame(spark, rows)).collect()
    wanted = expected(rows)
    assert {r.doc_id: list(r.removed_lines) for r in found} == {i: g for (i, _), g in wanted.items()}
    assert all(r.n_removed == len(r.removed_lines) for r in found)


def test_index_alone_finds_every_match(spark, monkeypatch):
    """Without the first round, the prefix index must settle everything."""
    rows = corpus(3, 50)
    monkeypatch.setattr(
        line_dedup, "by_ends", lambda firsts: firsts.select("line", F.col("line").alias("other")).where("1 = 0")
    )
    found = line_dedup.report(frame(spark, rows)).collect()
    assert {r.doc_id: list(r.removed_lines) for r in found} == {i: g for (i, _), g in expected(rows).items()}


def test_texts_and_columns_after_dedup(spark):
    rows = [(3, "a b c d\nx y"), (1, "A B C D\n\nq"), (2, None), (4, ""), (5, "q"), (6, "solo")]
    out = {r.doc_id: r for r in line_dedup.dedup(frame(spark, rows), drop_emptied=True).collect()}
    # Only document 5 had words and has lost them all.
    assert {i: r.text for i, r in out.items()} == {1: "A B C D\n\nq", 2: None, 3: "x y", 4: "", 6: "solo"}
    assert out[3].n_chars == 3 and out[3].number == "own" and out[2].n_chars is None


def test_shared_missing_and_distant_ids(spark):
    rows = [(None, "one two three four"), (7, "one two three four"), (7, "five six"), (7, "five six")]
    found = line_dedup.report(frame(spark, rows)).collect()
    by_id = sorted((r.doc_id is None, r.n_removed) for r in found)
    # The row without an id comes last and loses its line; repeated rows are one document.
    assert by_id == [(False, 0), (False, 0), (False, 0), (True, 1)]
    far = [(-(2**62), "a b c"), (2**62, "a b c")]
    found = {r.doc_id: r.n_removed for r in line_dedup.report(frame(spark, far)).collect()}
    assert found == {-(2**62): 0, 2**62: 1}


def test_empty_table(spark):
    assert line_dedup.dedup(frame(spark, [])).collect() == []


def test_lines_beyond_one_packed_number(monkeypatch):
    """Runs of few lines give what one sort of all lines gives; so does a number above 22 bits."""
    rnd = random.Random(5)
    lines = ["", *(" ".join(rnd.choice("abcdefgh") * 2 for _ in range(rnd.randint(1, 9))) for _ in range(50))]
    texts, numbers = pa.array(["\n".join(lines), None, "", "x y z\nx y"], pa.string()), np.arange(4)
    steps = np.arange(line_dedup.CELLS, dtype=np.uint64) % np.uint64(1024)

    def results():
        line, first, hashes = line_dedup.line_words(numbers, texts)
        sizes = np.diff(np.append(first, len(hashes)))
        return [x.tolist() for x in (line, first, hashes, line_dedup.by_rarity(sizes, hashes, steps))]

    whole = results()
    for size in (1, 3, 52):
        monkeypatch.setattr(line_dedup, "LINES_AT_ONCE", size)
        assert results() == whole
    monkeypatch.undo()
    n = line_dedup.LINES_AT_ONCE + 2
    hashes = np.full(n, 9, np.uint64)
    hashes[0], hashes[-1], hashes[-2] = 1, 2, 3
    ordered = line_dedup.by_rarity(np.ones(n, np.int64), hashes, steps)
    assert ordered[[0, 1, -2, -1]].tolist() == [1, 9, 3, 2]


def test_longer_sketches_never_exceed_the_difference(spark):
    """Folded or not, sketches differ in at most as many bits as sets in words, and rule out strangers."""
    rnd = np.random.default_rng(3)
    base = np.unique(rnd.integers(0, 1 << 40, 140, dtype=np.uint64))
    sets = [base, base[:120], np.append(base, rnd.integers(0, 1 << 40, 40, dtype=np.uint64))]
    sets += [rnd.integers(0, 1 << 40, 130, dtype=np.uint64), base[:40]]
    wide = line_dedup.wide_parity(np.concatenate(sets), np.array([len(s) for s in sets])).to_pylist()
    assert [len(w) for w in wide] == [8, 4, 8, 8, 0]
    rows = [(i, len(s), w) for i, (s, w) in enumerate(zip(sets, wide, strict=True))]
    firsts = spark.createDataFrame(rows, "line long, n long, wide array<long>")
    pairs = spark.createDataFrame([(a, b) for a in range(5) for b in range(a)], "line long, other long")
    found = {(r.line, r.other) for r in line_dedup.plausible(pairs, firsts).collect()}
    for a in range(5):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            union = len(sets[a]) + len(sets[b]) - shared
            if 4 * shared >= 3 * union:
                assert (a, b) in found
    # Without a sketch of one side nothing is ruled out.
    assert found == {(1, 0), (2, 0), (4, 0), (4, 1), (4, 2), (4, 3)}


def test_long_lines_match_brute_force(spark):
    """Lines of 60 to 300 words around the threshold, whose sketches have different lengths."""
    rnd = random.Random(9)
    base = [[f"v{rnd.randrange(900)}" for _ in range(n)] for n in (66, 70, 128, 130, 140, 260, 300)]
    rows = []
    for doc_id in range(60):
        line = list(rnd.choice(base))
        for _ in range(rnd.randrange(len(line) // 4)):
            line[rnd.randrange(len(line))] = f"v{rnd.randrange(900)}"
        rows.append((doc_id, " ".join(line[rnd.randrange(12) :])))
    found = line_dedup.report(frame(spark, rows)).collect()
    assert {r.doc_id: list(r.removed_lines) for r in found} == {i: g for (i, _), g in expected(rows).items()}


def test_one_text_of_many_removed_lines(spark):
    """Removing most of 100,000 lines of one text takes one walk over it."""
    lines = ["same words here" if i % 3 else f"own{i}" for i in range(100_000)]
    out = line_dedup.dedup(frame(spark, [(1, "\n".join(lines))])).collect()
    assert out[0].text.split("\n") == [line for i, line in enumerate(lines) if i % 3 == 0 or i == 1]


def test_texts_of_too_many_lines_are_refused(monkeypatch):
    monkeypatch.setattr(line_dedup, "LINE_BITS", 3)
    text = pa.array(["\n".join("abcdefghi")])
    try:
        line_dedup.line_words(np.arange(1), text)
    except ValueError as refused:
        assert "2**3 lines" in str(refused)
    else:
        raise AssertionError("a ninth line must be refused")


def test_long_unlike_lines_leave_no_candidates(spark):
    """Lines of 150 to 400 words that share a rare word are ruled out in the index."""
    rnd = random.Random(4)
    rows = []
    for i, n in enumerate([150, 160, 200, 256, 257, 300, 390, 400] * 4):
        rows.append((i, " ".join([f"rare{i % 3}", *(f"v{rnd.randrange(100_000)}" for _ in range(n))])))
    rows.append((90, rows[7][1] + " more words"))
    documents = frame(spark, rows).withColumn("number", F.col("doc_id"))
    lines = line_dedup.lines_of(documents, "number")
    near = line_dedup.by_prefix(documents, "number", lines, lines.select("line").where("1 = 0"))
    pairs = [(r.line >> line_dedup.LINE_BITS, r.other >> line_dedup.LINE_BITS) for r in near.collect()]
    assert pairs == [(90, 7)]


def test_only_lines_that_may_be_needed_are_shuffled(spark, plan_of):
    """The bitmaps are looked up below the join with the keys, not above it."""
    keys = spark.range(100).select(F.xxhash64("id").alias("key"))
    wanted = spark.range(5).select(F.xxhash64("id").alias("key")).distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = only_among(keys, "key", wanted)
        plan = plan_of(found)
        assert found.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
