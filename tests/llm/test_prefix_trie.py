"""The prefix trie against a plain tree of tuples."""

import hashlib
import random
import zlib

import numpy as np

from corpusloom.llm import prefix_trie

SCHEMA = "text string, conv_id long, role string, turn long, depth string, node string"


def key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def rebuilt(rows):
    """conv_id -> list of (role, text), by the rules of the query."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, key(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    result = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        result[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    return result


def expected(conversations):
    members, children = {}, {}
    for c, ts in conversations.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
            if d:
                children.setdefault(tuple(ts[: d - 1]), set()).add(tuple(ts[:d]))
    found = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in convs if len(conversations[c]) == len(node))
        found.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, ())),
                sum(n not in children for n in below),
                sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def table(spark, rows):
    frame = spark.createDataFrame([(x, c, r, t, "x", "y") for c, t, r, x in rows], SCHEMA)
    return frame.repartition(3)


def corpus(seed, n):
    rnd = random.Random(seed)
    said = ["", "a", "bc", "Über", "d e f", "g" * 50, None]
    rows = []
    for c in rnd.sample(range(n * 2), n):
        for t in range(rnd.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if rnd.random() < 0.3 else "user", rnd.choice(said[: rnd.choice([1, 2, 7])])))
    # A third of all conversations are the same, and some are very long.
    for c in range(3 * n, 3 * n + n // 2):
        rows += [(c, t, "user", "same") for t in range(9)]
    for c in (7000, 7001):
        rows += [(c, t, "user", f"t{t}") for t in range(150 + c % 7)]
    return rows


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def nodes(spark, rows, **how):
    return got(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns(table(spark, rows))), **how))


def test_nodes_against_plain_tree(spark):
    rows = corpus(3, 120)
    want = expected(rebuilt(rows))
    assert nodes(spark, rows) == want
    # Many shards in a partition, and many blocks of ids.
    assert nodes(spark, rows, shard_turns=20, id_block=7) == want
    assert nodes(spark, rows, shard_turns=1) == want


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"),
        (5, 0, "ab", "c"), (6, 0, "a", "bc"), (100, 0, "user", "x" * 100_000), (103, 0, "user", "own"), (104, 3, "user", ""),
    ]
    assert nodes(spark, rows) == expected(rebuilt(rows))
    assert nodes(spark, rows, shard_turns=1) == expected(rebuilt(rows))


def test_empty_tables_and_turnless_conversations(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, "user", "a")]) == []
    # One turn each, and a donor that is absent: most are left without turns.
    rows = [(c, 0, "user", "only") for c in range(101, 130)]
    want = expected(rebuilt(rows))
    assert any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in want)
    assert nodes(spark, rows) == want


def test_arrays_hold_every_transition():
    rnd = random.Random(1)
    paths = sorted({b"".join(bytes([rnd.randrange(4)]) * 16 for _ in range(rnd.randrange(9))) for _ in range(300)})
    trie, labels, sizes = prefix_trie.packed(paths)
    prefixes = {p[: 16 * d] for p in paths for d in range(len(p) // 16 + 1)}
    used = np.flatnonzero(trie.check > 0)
    # One state for each prefix but the root, each below the state of a shorter one.
    assert len(used) == len(prefixes) - 1
    at = 0
    for path, size in zip(paths, sizes, strict=True):
        state = 1
        for label in labels[at : at + size]:
            state = int(trie.child(np.array([state]), np.array([label]))[0])
        at += size
    assert set(trie.check[used].tolist()) <= {1, *used.tolist()}
    # Breadth-first ids keep the arrays dense.
    assert len(used) > trie.end // 2


def test_donor_turns_are_counted_as_unsigned(spark):
    frame = spark.createDataFrame([(c,) for c in (0, 7, 123456789)], "conv_id long")
    ours = [r[0] for r in frame.select(prefix_trie.shared_turns("conv_id")).collect()]
    assert ours == [zlib.crc32(str(c).encode()) % 6 for c in (0, 7, 123456789)]
