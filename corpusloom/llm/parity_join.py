"""Exact Jaccard join of documents by parity sketches of their word shingles.

A document is the set of its distinct shingles. Shingles are spread by hash over parts,
and each part keeps the XOR of its shingles' hashes, so a shingle in only one of two
sets changes one part: the number of parts that differ is at most the number of
differing shingles. Two sets with Jaccard 0.75 or more differ in at most a seventh of
their summed sizes; with more parts than that, one part at least is the same in both
(pigeonhole). The number of parts depends on the size band of the larger set, and a set
takes part in its own band and, near the upper edge, in the next one.

Sets that share a part are candidates. A set is dropped from a band in which it
shares fewer parts with all others than it must share with any similar set. A candidate is dropped if sizes, or the Hamming
distance of bit sketches (one parity bit for each hash slot, which also never exceeds
the number of differing shingles), rule the similarity out, and is verified on the whole
shingle sets otherwise. In a shared part every set is first compared with one
representative; after that only pairs that are not yet connected are compared, so large
groups of copies are never expanded into pairs, and no link between groups is lost.

Shingles, sets and parts are compared by 64-bit hashes. Parts without shingles are not
compared; bands of small sets have so many parts that shared shingles cannot all fall
into differing parts but with a probability below 1e-10.

Defined results: a null or empty text has no shingles, links with nothing and is its
own component; fewer words than a shingle make one shingle; equal texts and repeated
rows are one set; a null id stays null and a component takes its smallest id that is
not null. An empty table gives an empty result. Only id and text are read, so other
columns cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytesets import SPACED, mix, slices, text_bytes, window_hashes, word_bounds, word_hashes
from corpusloom.llm.components import components
from corpusloom.llm.prefilter import only_among
from corpusloom.sources.workdir import materialize

WIDTH = 5
# Similarity as a fraction: 100 * shared >= PERCENT * all.
PERCENT = 75
# Parts of bands of small sets, where a few shingles must not share a part by chance.
SMALL_SET, SMALL_PARTS, LEAST_PARTS = 16, 1 << 14, 64
# Groups that part hashes are dealt into, for each shuffle partition.
GROUPS_PER_PARTITION = 4
# 64-bit words of sketches compared at once.
CELLS_AT_ONCE = 4 << 20

SKETCHED = ["sketch", "short", "even", "odd"]

_TAG = np.uint64(0xD6E8FEB86659FD93)


def shingles(texts, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_bounds(data, offsets, SPACED)
    words = word_hashes(data, starts, ends)
    windows = window_hashes(words, width)
    first = np.cumsum(counts) - counts
    sets = []
    for at, n in zip(first.tolist(), counts.tolist(), strict=True):
        if n >= width:
            sets.append(np.unique(windows[at : at + n - width + 1]))
        elif n:
            whole = np.concatenate([words[at : at + n], np.full(width - n, _TAG, np.uint64)])
            sets.append(window_hashes(whole, width))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def digest(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    total = mix(hashes + _TAG).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total]))[0].astype(np.int64))


def band_of(size: int) -> int:
    return size.bit_length() - 1


def part_count(band: int) -> int:
    """More parts than shingles in which two similar sets up to this band can differ."""
    largest = (2 << band) - 1
    differing = 2 * largest * (100 - PERCENT) // (100 + PERCENT)
    return max(differing + 1, SMALL_PARTS if largest < SMALL_SET else LEAST_PARTS)


def bands_of(size: int) -> list[int]:
    """The bands that a set takes part in: its own, and the next if it has similar sets there."""
    band = band_of(size)
    return [band, band + 1] if 100 * size >= PERCENT * (2 << band) else [band]


def parts_in(hashes: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each shingle, ascending, and where the parts that are not empty begin."""
    parts = ((hashes >> np.uint64(32)) * np.uint64(part_count(band))) >> np.uint64(32)
    return parts, np.flatnonzero(np.append(True, parts[1:] != parts[:-1]))


def part_keys(hashes: np.ndarray) -> np.ndarray:
    """A hash of every non-empty part in every band that the set takes part in; its last
    bit is that of the band."""
    keys = []
    for band in bands_of(len(hashes)):
        parts, cuts = parts_in(hashes, band)
        folded = np.bitwise_xor.reduceat(mix(hashes + _TAG), cuts)
        keys.append(_marked(mix(folded + mix(parts[cuts] + np.uint64(band << 40))), np.uint64(band & 1)))
    return np.concatenate(keys)


def _marked(keys: np.ndarray, last) -> np.ndarray:
    return (keys & ~np.uint64(1)) | last


def least_shared(hashes: np.ndarray) -> dict[int, int]:
    """For the last bit of each band that a set takes part in: how many of its part keys
    every similar set there has too, at least. They can differ in no more parts than in
    shingles, a seventh of the summed sizes."""
    least = {}
    for band in bands_of(len(hashes)):
        largest = min((2 << band) - 1, 100 * len(hashes) // PERCENT)
        differing = (len(hashes) + largest) * (100 - PERCENT) // (100 + PERCENT)
        least[band & 1] = max(1, len(parts_in(hashes, band)[1]) - differing)
    return least


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parity bits of the set, four to eight for each shingle, 256 at least."""
    bits = 256 << max(0, band_of(len(hashes)) - 5)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def short_sketch(sketch: bytes) -> bytes:
    """A quarter of a sketch's bits, one to two for each shingle, 256 at least."""
    return folded(sketch, max(4, len(sketch) // 32)).tobytes()


def folded(sketch: bytes, words: int) -> np.ndarray:
    """A sketch of so many 64-bit words, from one as long or longer."""
    bits = np.frombuffer(sketch, np.uint64)
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def hamming(left: bytes, right: bytes) -> int:
    """The distance of two sketches, the longer one folded to the shorter."""
    words = min(len(left), len(right)) // 8
    return int(np.bitwise_count(folded(left, words) ^ folded(right, words)).sum())


def similar(shared: int, left: int, right: int) -> bool:
    return 100 * shared >= PERCENT * (left + right - shared)


def keyed(documents: DataFrame) -> DataFrame:
    """Id and text with a number for the row's content."""
    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


def members(documents: DataFrame) -> DataFrame:
    """Each row's id, set number (null if empty), size, bit sketches, and how many part
    keys similar sets share at least, in the band of even and of odd number."""

    def measured(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(part.column("text"))
                sketches = [bit_sketch(s) if len(s) else None for s in sets]
                least = [least_shared(s) if len(s) else {} for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(sketches, pa.binary()),
                        pa.array([s and short_sketch(s) for s in sketches], pa.binary()),
                        *(pa.array([x.get(last) for x in least], pa.int64()) for last in (0, 1)),
                    ],
                    ["doc_id", "row_key", "node", "size", *SKETCHED],
                )

    return keyed(documents).mapInArrow(
        measured,
        "doc_id long, row_key long, node long, size long, sketch binary, short binary, even long, odd long",
    )


def shared_parts(documents: DataFrame) -> DataFrame:
    """`key`, `node` and `n`, the number of its sets, for every part of two sets or more.

    Part hashes travel as packed arrays, about 8 bytes each; equal sets of one batch
    are sent once.
    """
    spark = documents.sparkSession
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(batches):
        for batch in batches:
            nodes, keys, owners = [], [], []
            seen = set()
            for part in slices(batch, "text"):
                for hashes in shingles(part.column("text")):
                    node = digest(hashes) if len(hashes) else None
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    own = part_keys(hashes)
                    owners.append(np.full(len(own), len(nodes), np.uint32))
                    nodes.append(node)
                    keys.append(own)
            if not nodes:
                continue
            yield _packed(np.array(nodes, np.int64), np.concatenate(keys), np.concatenate(owners), groups)

    packed = documents.select(F.col("text").cast("string")).mapInArrow(
        dealt, "part int, keys binary, owners binary, nodes binary"
    )
    return packed.groupBy("part").applyInArrow(_shared, "key long, node long, n long")


def _packed(nodes: np.ndarray, keys: np.ndarray, owners: np.ndarray, groups: int) -> pa.RecordBatch:
    """One row for each group: the low 48 bits of its keys, and the sets they belong to."""
    part = ((keys >> np.uint64(40)) % np.uint64(groups)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, keys, owners = part[order], keys[order], owners[order]
    cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    rows = []
    for low, high in zip(cuts, [*cuts[1:], len(part)], strict=True):
        used, local = np.unique(owners[low:high], return_inverse=True)
        own = keys[low:high].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        kind = np.uint16 if len(used) < 1 << 16 else np.uint32
        rows.append((int(part[low]), own.tobytes(), local.astype(kind).tobytes(), nodes[used].tobytes()))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "keys", "owners", "nodes"])


def _shared(table: pa.Table) -> pa.Table:
    """Keys with two different sets at least, of one group."""
    keys, nodes = [], []
    for row in table.to_pylist():
        own = np.zeros((len(row["keys"]) // 6, 8), np.uint8)
        own[:, :6] = np.frombuffer(row["keys"], np.uint8).reshape(-1, 6)
        keys.append(own.view("<u8").ravel())
        named = np.frombuffer(row["nodes"], np.int64)
        kind = np.uint16 if len(named) < 1 << 16 else np.uint32
        nodes.append(named[np.frombuffer(row["owners"], kind)])
    key, node = np.concatenate(keys), np.concatenate(nodes)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    same = key[1:] == key[:-1]
    repeat = np.append(False, same & (node[1:] == node[:-1]))
    key, node = key[~repeat], node[~repeat]
    same = key[1:] == key[:-1]
    held = np.append(same, False) | np.append(False, same)
    # The group number makes a key of this group unique among all groups.
    part = table.column("part")[0].as_py()
    key = _marked(mix(key + np.uint64(part << 48)), key & np.uint64(1)).astype(np.int64)
    key, node = key[held], node[held]
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    return pa.table({"key": key, "node": node, "n": times[which].astype(np.int64)})


def enough(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (`key`, `node`) of sets that have as many part keys among them, in the band
    of the key, as they share with any similar set; `weight`, if there is `n`, is its sum."""
    last = F.col("key").bitwiseAND(1)
    sums = [F.sum("n").alias("weight")] if "n" in parts.columns else []
    counts = parts.groupBy("node").agg(F.count("*").alias("all"), F.sum(last).alias("last"), *sums)
    judged = counts.join(sets.select("node", "even", "odd"), "node").select(
        "node",
        (F.col("all") - F.col("last") >= F.col("even")).alias("even_held"),
        (F.col("last") >= F.col("odd")).alias("odd_held"),
        *(["weight"] if sums else []),
    )
    rows = parts.join(judged.where("even_held or odd_held"), "node")
    return rows.where(F.when(last == 1, F.col("odd_held")).otherwise(F.col("even_held"))).drop("even_held", "odd_held", "n")


def plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (`a`, `b`) whose sizes and sketches allow the similarity."""
    sides = [
        sets.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("size", "sketch")])
        for s in ("a", "b")
    ]
    near = pairs.join(sides[0], "a").join(sides[1], "b")
    small, large = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    near = near.where(100 * small >= PERCENT * large)

    def close(batches):
        for batch in batches:
            names = ("a_size", "b_size", "a_sketch", "b_sketch")
            rows = zip(*(batch.column(n).to_pylist() for n in names), strict=True)
            kept = [hamming(p, q) * (100 + PERCENT) <= (100 - PERCENT) * (m + n) for m, n, p, q in rows]
            pair = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"])
            yield pair.filter(pa.array(kept, pa.bool_()))

    return near.mapInArrow(close, "a long, b long")


def plausible_apart(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """Plausible pairs of sets that share a part (`key`) and have different `root`s.

    Short sketches travel with every key; the whole ones are compared for what they leave.
    Sets of the largest component of a part are compared with the others of that part,
    never with each other, and only pairs that pass the sketches leave a task.
    """
    groups = GROUPS_PER_PARTITION * int(apart.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = apart.join(sets.select("node", "size", F.col("short").alias("sketch")), "node")
    rows = rows.withColumn("part", F.pmod(F.shiftright("key", 1), F.lit(groups)))
    return plausible(rows.groupBy("part").applyInArrow(_apart, "a long, b long").distinct(), sets)


def _apart(table: pa.Table) -> pa.Table:
    key, node, root, size = (np.asarray(table.column(n)) for n in ("key", "node", "root", "size"))
    sketches = table.column("sketch").to_pylist()
    order = np.lexsort((root, key))
    cuts = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    found = [np.zeros((2, 0), np.int64)]
    for low, high in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[low:high]
        kinds, times = np.unique(root[own], return_counts=True)
        if len(kinds) < 2:
            continue
        words = min(len(sketches[i]) for i in own) // 8
        bits = np.stack([folded(sketches[i], words) for i in own])
        smaller = np.flatnonzero(root[own] != kinds[times.argmax()])
        step = max(1, CELLS_AT_ONCE // (words * len(own)))
        for at in range(0, len(smaller), step):
            some = smaller[at : at + step]
            distance = np.bitwise_count(bits[some][:, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
            left, right = size[own[some]][:, None], size[own][None, :]
            near = (100 + PERCENT) * distance <= (100 - PERCENT) * (left + right)
            near &= 100 * np.minimum(left, right) >= PERCENT * np.maximum(left, right)
            near &= root[own[some]][:, None] != root[own][None, :]
            i, j = np.nonzero(near)
            found.append(np.stack([node[own[some[i]]], node[own[j]]]))
    pairs = np.sort(np.concatenate(found, axis=1), axis=0)
    pairs = np.unique(pairs, axis=1)
    return pa.table({"a": pairs[0], "b": pairs[1]})


def verified(pairs: DataFrame, sets: DataFrame, documents: DataFrame) -> DataFrame:
    """The pairs whose whole shingle sets are similar."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("row_key").alias(f"{side}_row_key")), side)
    pairs = materialize(pairs, "pairs")
    needed = pairs.select(F.col("a_row_key").alias("row_key")).union(pairs.select("b_row_key")).distinct()
    needed = materialize(needed, "needed")
    texts = materialize(only_among(keyed(documents).select("row_key", "text"), "row_key", needed), "texts")
    texts = texts.dropDuplicates(["row_key"])
    b_side = texts.select(F.col("row_key").alias("b_row_key"), F.col("text").alias("b_text"))
    a_side = texts.select(F.col("row_key").alias("a_row_key"), F.col("text").alias("a_text"))
    both = pairs.join(b_side, "b_row_key").join(a_side, "a_row_key").select("a", "b", "a_text", "b_text")

    def checked(batches):
        last, left = None, None
        for batch in batches:
            for part in slices(batch, "b_text"):
                kept = []
                rights = shingles(part.column("b_text"))
                for node, text, right in zip(
                    part.column("a").to_pylist(), part.column("a_text"), rights, strict=True
                ):
                    if node != last:
                        last, left = node, shingles(pa.array([text.as_py()], pa.string()))[0]
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    kept.append(similar(shared, len(left), len(right)))
                pair = pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])
                yield pair.filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(checked, "a long, b long")


def links(documents: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (`a`, `b`) that connect all similar sets.

    First every set is compared with one representative: of the sets in a part, the one
    that shares most parts with others stands for it (the original of a group of edited
    copies, since edits are shared with few), and of the representatives of its parts a
    set takes the most frequent one. Then all sets of a part that are still apart are
    compared with each other. Both times, sets go that share fewer parts with all others
    than a similar set must have in common with them.
    """
    shared = materialize(shared_parts(documents), "shared")
    parts = materialize(enough(shared, sets), "parts")
    leaders = parts.groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("a"))
    counted = parts.select("key", F.col("node").alias("b")).join(leaders, "key").where("a <> b").groupBy("a", "b").count()
    best = counted.groupBy("b").agg(F.max_by("a", F.struct("count", F.negate("a"))).alias("a")).select("a", "b")
    near = materialize(verified(plausible(best, sets), sets, documents), "links")

    roots = components(near)
    named = parts.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    apart = materialize(named.join(split.where("low <> high").select("key"), "key", "left_semi"), "apart")
    far = materialize(verified(plausible_apart(enough(apart, sets), sets), sets, documents), "links")
    return near.union(far)


def classed(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, row_key, n_shingles and `root`, one for each component (null
    where there are no shingles)."""
    rows = materialize(members(documents), "members")
    sets = rows.where("node is not null").groupBy("node").agg(
        F.min("row_key").alias("row_key"), *[F.first(c).alias(c) for c in ("size", *SKETCHED)]
    )
    sets = materialize(sets, "sets")
    roots = components(links(documents, sets))
    placed = rows.select("doc_id", "row_key", "node", F.col("size").alias("n_shingles")).join(roots, "node", "left")
    return placed.select("doc_id", "row_key", "n_shingles", F.coalesce("root", "node").alias("root"))


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of `documents`."""
    placed = classed(documents)
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.join(smallest, "root", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each component: the smallest id (null last), then the smallest content
    number. Rows without shingles all stay."""
    placed = materialize(classed(documents).where("root is not null"), "classes")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))
    first = placed.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first.row_key").alias("kept"))
    dropped = placed.join(first, "root").where("row_key <> kept").select("row_key").distinct()
    own = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    name = "row_key"
    while name in documents.columns:
        name += "_"
    rows = documents.withColumn(name, own)
    rows = rows.join(dropped.withColumnRenamed("row_key", name), name, "left_anti")
    repeated = placed.groupBy("row_key").count().where("count > 1").select(F.col("row_key").alias(name))
    if not repeated.isEmpty():
        again = rows.join(repeated, name, "left_semi").dropDuplicates([name])
        rows = rows.join(repeated, name, "left_anti").unionByName(again)
    return rows.select(*[F.col(f"`{c}`") for c in documents.columns])
