"""Prefix trie of conversations, packed in double arrays shard by shard.

A conversation is the sequence of its turns; a turn is known by a 128-bit digest of its
role and text, so texts are read once and not shuffled. Equal sequences are one entry
with their number, smallest id and ids. Entries are sorted by sequence over the whole
cluster, so a node's members stand together, and a shard is a run of entries with at most
SHARD_TURNS turns (or one entry). For each shard the turns get dense ids, and a trie over
them is packed in BASE and CHECK arrays: the child of state s by turn id c is state
BASE[s] + c, if CHECK there says s. Entries walk the arrays to count members, and a scan
of CHECK gives the nodes.

Only the prefixes that the last entry of one shard and the first of the next have in
common are nodes of both. Those upper nodes leave a shard as parts and are merged
globally; all others are finished in their shard. All that is merged is a sum or a
minimum: members, and over subtrees the leaves and members times length. What depends on
the whole (a node counts once, as a child, as a leaf, and with its own length taken off) is
given to the shard where the node occurs first, so no subtree has to be walked again.

Defined results: rows without conv_id belong to no conversation; a null role or text is
empty; turns are ordered by number, null first, and rows of one number by digest; repeated
rows are turns of their own. The digest of ids is taken over the ids in blocks of ID_BLOCK
numbers, so no list of ids is ever longer. In one task stand at most one conversation's
turn digests (16 bytes each) or one shard. An empty table has no nodes. Only conv_id, turn,
role and text are read, so further columns cannot clash.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.workdir import materialize, shared_dir

# Turns packed in one pair of arrays.
SHARD_TURNS = 100_000
# Conversation numbers whose ids are listed together.
ID_BLOCK = 1 << 16
# Turns that are taken over from the first conversation of a group of so many numbers.
GROUP, MOST_SHARED = 100, 6
# Places tried for a node with several children before the end is taken.
TRIES = 32
# Copies of an upper node, so that its many children do not meet in one task.
COPIES = 64

_KEY = 16


def turns(conversations: DataFrame) -> DataFrame:
    """Each conversation's turns in order, as an array of (turn, key, chars)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
            F.length(text).alias("chars"),
        ).alias("turn"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def shared_turns(conv_id) -> Column:
    """How many turns a conversation takes over."""
    return F.pmod(F.crc32(F.col(conv_id).cast("string").cast("binary")), F.lit(MOST_SHARED)).cast("int")


def rebuilt(ordered: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group."""
    first = ordered.where(F.col("conv_id") % GROUP == 0)
    first = first.select(F.col("conv_id").alias("donor"), F.slice("turns", 1, MOST_SHARED).alias("taken"))
    rows = ordered.withColumn("donor", F.col("conv_id") - F.col("conv_id") % GROUP)
    rows = rows.withColumn("h", shared_turns("conv_id")).join(first, "donor", "left")
    taken = F.coalesce(F.slice("taken", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return rows.select("conv_id", F.concat(taken, own).alias("turns"))


def entries(conversations: DataFrame, id_block: int = ID_BLOCK) -> DataFrame:
    """Different turn sequences with their conversations, in blocks of conv_ids.

    `path` is the turns' keys one after the other, `chars` their lengths, `ids` the
    block's ids, in order, as decimal text.
    """
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""))
    block = F.floor(F.col("conv_id") / id_block).cast("long")
    rows = conversations.select(path.alias("path"), F.col("turns.chars").alias("chars"), block.alias("block"), "conv_id")
    found = rows.groupBy("path", "block").agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"), F.any_value("chars").alias("chars")
    )
    return found.select(
        "path", "block", "chars", F.array_join("ids", ",").alias("ids"),
        F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("low"),
    )


class DoubleArray:
    """BASE and CHECK of one trie. State 0 is not used, state 1 is the root; a free state
    has CHECK 0."""

    def __init__(self, size: int):
        self.base = np.zeros(size + 2, np.int64)
        self.check = np.zeros(size + 2, np.int64)
        self.check[:2] = -1
        # The first free place, and the end of what is in use.
        self.free = self.end = 2

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.zeros(more, np.int64)])

    def place(self, state: int, labels: np.ndarray) -> None:
        """Give a state its children: one of the first free places that fit all of them,
        or the end."""
        while self.free < self.end and self.check[self.free] != 0:
            self.free += 1
        at, offsets = self.free, labels - labels[0]
        if len(labels) > 1:
            for _ in range(TRIES):
                if not self.check[at + offsets[at + offsets < self.end]].any():
                    break
                gaps = np.flatnonzero(self.check[at + 1 : self.end] == 0)[:1]
                at = at + 1 + int(gaps[0]) if len(gaps) else self.end
            else:
                at = self.end
        self._grow(int(at + offsets[-1]) + 1)
        self.base[state] = at - labels[0]
        self.check[at + offsets] = state
        self.end = max(self.end, int(at + offsets[-1]) + 1)

    def child(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of states by labels; they must be there."""
        found = self.base[states] + labels
        if (self.check[found] != states).any():
            raise ValueError("no such child")
        return found


def common(left: bytes, right: bytes) -> int:
    """Turns that two sequences have in common at their start."""
    n = min(len(left), len(right)) // _KEY
    a = np.frombuffer(left, np.uint8)[: n * _KEY].reshape(n, _KEY)
    b = np.frombuffer(right, np.uint8)[: n * _KEY].reshape(n, _KEY)
    differing = np.flatnonzero((a != b).any(axis=1))
    return int(differing[0]) if len(differing) else n


def packed(paths: list[bytes]) -> tuple[DoubleArray, np.ndarray, np.ndarray]:
    """The trie of a shard's sequences, the dense turn ids of all sequences one after the
    other, and their lengths. Ids are given in the order in which breadth-first packing
    meets the turns, so that the children of a node lie close together."""
    sizes = np.array([len(p) // _KEY for p in paths], np.int64)
    keys = np.frombuffer(b"".join(paths), f"S{_KEY}") if sizes.sum() else np.zeros(0, f"S{_KEY}")
    starts = np.cumsum(sizes) - sizes
    _, kind = np.unique(keys, return_inverse=True)
    depth = np.arange(len(keys)) - np.repeat(starts, sizes)
    dense = np.full(int(kind.max()) + 1 if len(kind) else 0, -1, np.int64)
    order = kind[np.argsort(depth, kind="stable")]
    first = np.unique(order, return_index=True)[1]
    dense[order[np.sort(first)]] = np.arange(len(first))
    labels = dense[kind]
    trie = DoubleArray(len(keys))
    state = np.ones(len(paths), np.int64)
    for d in range(int(sizes.max(initial=0))):
        here = np.flatnonzero(sizes > d)
        steps = np.stack([state[here], labels[starts[here] + d]])
        edges = np.unique(steps, axis=1)
        cuts = np.flatnonzero(np.append(True, edges[0, 1:] != edges[0, :-1]))
        for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), edges.shape[1]], strict=True):
            trie.place(int(edges[0, low]), edges[1, low:high])
        state[here] = trie.child(*steps)
    return trie, labels, sizes


_NODES = pa.schema(
    [
        ("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
    ]
)
_NODE_TYPES = (
    "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string"
)


def shard_nodes(paths, chars, counts, lows, ends, before: int, after: int) -> pa.RecordBatch:
    """The nodes of a shard of sequences in order. `before` and `after` are the turns in
    common with the sequence before and the one after the shard, -1 if there is none."""
    trie, labels, sizes = packed(paths)
    starts = np.cumsum(sizes) - sizes
    n = np.zeros(len(trie.check), np.int64)
    low = np.full(len(trie.check), np.iinfo(np.int64).max)
    length, depth = np.zeros_like(n), np.zeros_like(n)
    state = np.ones(len(paths), np.int64)
    n[1], low[1] = counts.sum(), lows.min()
    first, last = [1], [1]
    for d in range(int(sizes.max(initial=0))):
        here = np.flatnonzero(sizes > d)
        state[here] = trie.child(state[here], labels[starts[here] + d])
        np.add.at(n, state[here], counts[here])
        np.minimum.at(low, state[here], lows[here])
        length[state[here]], depth[state[here]] = chars[starts[here] + d], d + 1
        if sizes[0] > d:
            first.append(int(state[0]))
        if sizes[-1] > d:
            last.append(int(state[-1]))
    # Nodes that the shard before has as well were counted there.
    again = np.zeros(len(n), bool)
    again[first[: before + 1]] = True
    states = np.append(1, np.flatnonzero(trie.check > 0))
    parent = np.where(states == 1, 0, trie.check[states])
    new = ~again[states] & (states != 1)
    children, inner = np.zeros_like(n), np.zeros(len(n), bool)
    np.add.at(children, parent[new], 1)
    inner[parent] = True
    if after == sizes[-1]:
        # The next shard goes on below the last sequence.
        inner[last[-1]] = True
    saved = n * length - np.where(again, 0, length)
    leaves = (~inner).astype(np.int64)
    deep = np.argsort(depth[states], kind="stable")[::-1]
    levels = depth[states][deep]
    for d in range(int(levels[0]) if len(levels) else 0, 0, -1):
        some = states[deep[np.searchsorted(-levels, -d, "left") : np.searchsorted(-levels, -d, "right")]]
        np.add.at(saved, trie.check[some], saved[some])
        np.add.at(leaves, trie.check[some], leaves[some])
    names: dict[int, bytes] = {}
    for line, path, shared in ((first, paths[0], before), (last, paths[-1], after)):
        name = hashlib.md5()
        for d in range(shared + 1):
            if d:
                name.update(path[(d - 1) * _KEY : d * _KEY])
            names[line[d]] = name.digest()
    digests = dict(zip(state.tolist(), ends, strict=True))
    above = parent.tolist()
    columns = [
        [names.get(s) for s in states.tolist()],
        [names.get(p) for p in above],
        low[states],
        depth[states],
        pa.array(low[parent], mask=parent == 0),
        n[states],
        children[states],
        leaves[states],
        saved[states],
        [digests.get(s) for s in states.tolist()],
    ]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _NODES, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_NODES)


def _whole_entries(batches):
    """One entry for each sequence: path, lengths, number, smallest id, digest of ids."""
    path = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["path"] != path:
                if path is not None:
                    yield path, chars, n, low, name.hexdigest()
                path, chars, n, low, name = row["path"], row["chars"], 0, row["low"], hashlib.sha256()
            elif n:
                name.update(b",")
            name.update(row["ids"].encode())
            n, low = n + row["n"], min(low, row["low"])
    if path is not None:
        yield path, chars, n, low, name.hexdigest()


def _shards(rows, most: int):
    """Runs of entries with at most so many turns, or one entry."""
    run, total = [], 0
    for row in rows:
        size = len(row[0]) // _KEY
        if run and total + size > most:
            yield run
            run, total = [], 0
        run.append(row)
        total += size
    if run:
        yield run


def nodes_by_shard(ordered: DataFrame, bounds: dict[int, tuple[int, int]], shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of each shard. `bounds` has the turns in common with the partitions
    before and after, by partition number."""

    def packed_shards(batches):
        batches = (b for b in batches if b.num_rows)
        opening = next(batches, None)
        if opening is None:
            return
        before, after = bounds[opening.column("part")[0].as_py()]

        def again():
            yield opening
            yield from batches

        shards = _shards(_whole_entries(again()), shard_turns)
        run = next(shards, None)
        while run is not None:
            coming = next(shards, None)
            shared = after if coming is None else common(run[-1][0], coming[0][0])
            paths, chars, n, low, ends = zip(*run, strict=True)
            flat = np.concatenate([np.asarray(c, np.int64) for c in chars])
            yield shard_nodes(list(paths), flat, np.array(n), np.array(low), ends, before, shared)
            run, before = coming, shared

    return ordered.mapInArrow(packed_shards, _NODE_TYPES)


def sequences_in_order(found: DataFrame) -> DataFrame:
    """The entries sorted over all partitions, kept as they are dealt out."""
    spark = found.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    ordered = found.repartitionByRange("path").sortWithinPartitions("path", "block")
    return ordered.withColumn("part", F.spark_partition_id()).checkpoint()


def shared_bounds(ordered: DataFrame) -> dict[int, tuple[int, int]]:
    """For each partition, the turns its first sequence has in common with the last one
    before, and its last with the next one. Two sequences of each partition come to the
    driver."""
    ends = ordered.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    rows = sorted(ends.collect())
    shared = [-1, *[common(a["high"], b["low"]) for a, b in zip(rows[:-1], rows[1:], strict=True)], -1]
    return {row["part"]: (shared[i], shared[i + 1]) for i, row in enumerate(rows)}


def merged(parts: DataFrame) -> DataFrame:
    """Upper nodes joined from their parts, and every node's parent's smallest id."""
    parts = materialize(parts, "trie-nodes")
    upper = parts.where("node is not null").groupBy("node").agg(
        F.any_value("parent").alias("parent"),
        F.min("conv_id").alias("conv_id"),
        F.any_value("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends").alias("ends"),
    )
    upper = materialize(upper, "upper-nodes")
    every = parts.where("node is null").unionByName(upper)
    below = every.where("parent is not null").withColumn("copy", F.pmod(F.xxhash64("conv_id"), F.lit(COPIES)).cast("int"))
    above = upper.select(
        F.col("node").alias("parent"), F.col("conv_id").alias("above"),
        F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"),
    )
    named = below.join(above, ["parent", "copy"]).withColumn("parent_conv_id", F.col("above"))
    whole = every.where("parent is null").unionByName(named.select(*every.columns))
    nothing = hashlib.sha256().hexdigest()
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
    )


def trie(ordered: DataFrame, shard_turns: int = SHARD_TURNS, id_block: int = ID_BLOCK) -> DataFrame:
    """The nodes of all conversations: `conv_id` and `turns`, arrays of (turn, key, chars)."""
    found = sequences_in_order(entries(ordered, id_block))
    return merged(nodes_by_shard(found, shared_bounds(found), shard_turns))
