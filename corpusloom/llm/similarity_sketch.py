"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct shingles. A sketch has COORDINATES values, made in
rounds. In each of the first COORDINATES rounds every shingle is placed in one bin by that
round's hash; in each of the next COORDINATES rounds all shingles are placed in one bin,
a different one in each round. A bin keeps its smallest (round, hash), and the rounds end
once every bin is filled, so each coordinate is filled for every set that is not empty, a
large set needs one or two rounds, and the share of equal coordinates of two sets is an
estimate of their Jaccard similarity that is as concentrated as that of independent hashes.

BANDS bands of ROWS coordinates are hashed to bucket keys. Two sets at the threshold miss
each other in all bands with a probability of 2e-10. In a bucket every set is first
compared with one representative; sets of a bucket that are then in different components
are compared with each other, those of the largest component never among themselves, in
blocks of bounded size, so groups of copies are not expanded into pairs and a bucket of
any size is spread over tasks. A pair is dropped if sizes rule the similarity out, if so
few coordinates agree that the similarity would show that with a probability below ERROR,
or if parity bits of the sets, whose distance never exceeds the number of differing
shingles, differ in too many places. All others are confirmed on the whole shingle sets:
in SETTLING rounds only the closest partner of each set, since one link settles it, and
then every pair that is still apart.

Shingles and sets are compared by 64-bit hashes. Defined results: a null or empty text has
no shingles, links with nothing and is its own component; fewer words than a shingle make
one shingle; equal texts and repeated rows are one set; a null id stays null, a component
takes its smallest id that is not null, and only rows with that id are kept. An empty table
gives an empty result. Only id and text are read, so other columns cannot clash.
"""

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytesets import mix, slices
from corpusloom.llm.components import components
from corpusloom.llm.parity_join import bit_sketch, digest, folded, keyed, shingles
from corpusloom.llm.prefilter import maybe_among
from corpusloom.sources.workdir import materialize

# Similarity as a fraction: 100 * shared >= PERCENT * all.
PERCENT = 85
ROWS, BANDS = 5, 38
COORDINATES = ROWS * BANDS
# Chance that the sketches of a similar pair agree in fewer coordinates than asked for.
ERROR = 1e-12
# Sets of one bucket that meet in one task: twice as many at most, on average.
BLOCK = 512
# Rounds in which sets of a bucket are verified with their closest partner only.
SETTLING = 1
# Partners of one set that are verified with one copy of its text.
PARTNERS = 64
# Sets of a task whose keys have been sent and are not sent again.
REMEMBERED = 1 << 18

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HASH_BITS = np.uint64(40)


def least_agreement(percent: int = PERCENT, coordinates: int = COORDINATES, error: float = ERROR) -> int:
    """Equal coordinates that a pair at the threshold has but with a chance below `error`
    (relative-entropy bound on the lower tail)."""
    p = percent / 100
    for agree in range(int(p * coordinates), 0, -1):
        q = agree / coordinates
        if coordinates * (q * log(q / p) + (1 - q) * log((1 - q) / (1 - p))) >= -log(error):
            return agree
    return 0


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """The sketch of each set, all rounds for all sets at once."""
    table = np.full(len(sets) * coordinates, _EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    items = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    low = np.uint64((1 << int(_HASH_BITS)) - 1)
    for turn in range(2 * coordinates):
        if not len(items):
            break
        hashes = mix(items + np.uint64(int(_ODD) * (turn + 1) % (1 << 64)))
        if turn < coordinates:
            bins = ((hashes >> _HASH_BITS) * np.uint64(coordinates) >> np.uint64(24)).astype(np.int64)
        else:
            bins = turn - coordinates
        np.minimum.at(table, owners * coordinates + bins, np.uint64(turn << int(_HASH_BITS)) | (hashes & low))
        left = np.unique(owners)
        open_ = (table.reshape(-1, coordinates)[left] == _EMPTY).any(axis=1)
        if not open_.all():
            still = np.zeros(len(sets), bool)
            still[left[open_]] = True
            kept = still[owners]
            items, owners = items[kept], owners[kept]
    return table.reshape(-1, coordinates)


def bucket_keys(table: np.ndarray) -> np.ndarray:
    """One key for each sketch and band."""
    bands = table.reshape(len(table), -1, ROWS)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * _ODD + bands[:, :, k])
    return keys.astype(np.int64)


def short(table: np.ndarray) -> np.ndarray:
    """One byte for each coordinate."""
    return (mix(table) >> np.uint64(56)).astype(np.uint8)


def signed(documents: DataFrame) -> DataFrame:
    """Each row's id, content number, set number (null if empty) and size; with the first
    row of a set that a task sees, its short sketch, parity bits and bucket keys too."""

    def measured(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(part.column("text"))
                nodes = [digest(s) if len(s) else None for s in sets]
                new = {}
                for i, node in enumerate(nodes):
                    if node is not None and node not in seen:
                        new[i] = len(new)
                        seen.add(node)
                if len(seen) > REMEMBERED:
                    seen.clear()
                table = sketches([sets[i] for i in new])
                keys, codes = bucket_keys(table), short(table)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(nodes, pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([codes[new[i]].tobytes() if i in new else None for i in range(len(sets))], pa.binary()),
                        pa.array([bit_sketch(sets[i]) if i in new else None for i in range(len(sets))], pa.binary()),
                        pa.array([keys[new[i]] if i in new else None for i in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "row_key", "node", "size", "sketch", "bits", "keys"],
                )

    return keyed(documents).mapInArrow(
        measured, "doc_id long, row_key long, node long, size long, sketch binary, bits binary, keys array<long>"
    )


def shared_buckets(rows: DataFrame) -> DataFrame:
    """`key`, `node` and `n`, the number of its entries, for buckets of two sets or more."""
    entries = rows.where("keys is not null").select(F.explode("keys").alias("key"), "node")
    held = entries.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("node").alias("n"))
    return entries.join(held.where("low <> high").select("key", "n"), "key")


def representatives(buckets: DataFrame) -> DataFrame:
    """One pair (`a`, `b`) for each set `b` of a bucket: of its buckets' representatives,
    the one it shares most buckets with. A bucket is represented by the set that shares
    most entries with others: of edited copies, the original."""
    weights = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    leaders = buckets.join(weights, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("a"))
    pairs = buckets.withColumnRenamed("node", "b").join(leaders, "key").where("a <> b")
    counted = pairs.groupBy("a", "b").agg(F.count("key").alias("times"))
    return counted.groupBy("b").agg(F.max_by("a", F.struct("times", F.negate("a"))).alias("a")).select("a", "b")


def apart(buckets: DataFrame, roots: DataFrame, sets: DataFrame, closest: bool = False) -> DataFrame:
    """Plausible pairs (`a`, `b`) that share a bucket and are in different components.

    The sets outside a bucket's largest component are cut into blocks, and so are all
    sets of the bucket; each pair of blocks meets in one group. `closest` asks for one
    partner of each set in each group of blocks only.
    """
    placed = buckets.select("key", "node").join(roots, "node", "left")
    placed = placed.select("key", "node", F.coalesce("root", "node").alias("root"))
    ends = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    split = placed.join(ends.where("low <> high").select("key"), "key").distinct()
    split = materialize(split, "split")
    groups = split.groupBy("key", "root").agg(F.count("node").alias("n"))
    bounds = groups.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("large"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("all_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK).cast("int").alias("few_blocks"),
    )
    rows = split.join(bounds, "key").join(sets.select("node", "size", "sketch", "bits"), "node")
    dealt = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ("key", "few", "all", "outside", "node", "root", "size", "sketch", "bits")
    few = rows.where("root <> large").withColumns({"few": dealt("few_blocks"), "outside": F.lit(True)})
    few = few.withColumn("all", every("all_blocks")).select(*columns)
    each = rows.withColumns({"all": dealt("all_blocks"), "outside": F.lit(False)})
    each = each.withColumn("few", every("few_blocks")).select(*columns)
    block = ("key", "few", "all")
    met = few.union(each).repartition(*block).sortWithinPartitions(*block)
    return met.mapInArrow(lambda batches: _block_pairs(batches, closest), "a long, b long").distinct()


def _block_pairs(batches, closest: bool):
    """Plausible pairs of each group of rows that stand together, group by group."""
    agree = least_agreement()
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        block = np.stack([np.asarray(table.column(n)).astype(np.int64) for n in ("key", "few", "all")])
        cuts = np.flatnonzero(np.append(True, (block[:, 1:] != block[:, :-1]).any(axis=0)))
        # The last group may go on in the next batch.
        held = table.slice(int(cuts[-1])).combine_chunks()
        yield from _pairs(table.slice(0, int(cuts[-1])), cuts, agree, closest)
    if held is not None:
        yield from _pairs(held, np.array([0, held.num_rows]), agree, closest)


def _pairs(table: pa.Table, cuts: np.ndarray, agree: int, closest: bool):
    if not table.num_rows:
        return
    outside = np.asarray(table.column("outside").combine_chunks().cast(pa.uint8())).astype(bool)
    node, root, size = (np.asarray(table.column(n)) for n in ("node", "root", "size"))
    codes = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
    parity = table.column("bits").to_pylist()
    found = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        few = low + np.flatnonzero(outside[low:high])
        rest = low + np.flatnonzero(~outside[low:high])
        near = root[few][:, None] != root[rest][None, :]
        left, right = size[few][:, None], size[rest][None, :]
        near &= 100 * np.minimum(left, right) >= PERCENT * np.maximum(left, right)
        i, j = np.nonzero(near)
        if not len(i):
            continue
        # Sizes of plausible pairs differ by less than two, so their parity bits do too.
        words = min(len(parity[k]) for k in range(low, high)) // 8
        own = np.stack([folded(parity[k], words) for k in range(low, high)])
        for at in range(0, len(i), 1 << 16):
            x, y = few[i[at : at + (1 << 16)]], rest[j[at : at + (1 << 16)]]
            same = (codes[x] == codes[y]).sum(axis=1) >= agree
            x, y = x[same], y[same]
            apart_by = np.bitwise_count(own[x - low] ^ own[y - low]).sum(axis=1, dtype=np.int64)
            close = (100 + PERCENT) * apart_by <= (100 - PERCENT) * (size[x] + size[y])
            x, y, apart_by = x[close], y[close], apart_by[close]
            if closest and len(x):
                order = np.lexsort((apart_by, x))
                first = order[np.append(True, x[order][1:] != x[order][:-1])]
                x, y = x[first], y[first]
            found.append(np.sort(np.stack([node[x], node[y]]), axis=0))
    pairs = np.unique(np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1), axis=1)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def with_shares(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs with the `share` of `a`'s partners that `b` is in, and the number of
    shares of each `a`: the text of `a` is sent once for some PARTNERS of its partners."""
    shares = pairs.groupBy("a").agg(F.ceil(F.count("b") / PARTNERS).cast("int").alias("shares"))
    share = F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share")
    return pairs.join(shares, "a").select("a", "b", share), shares


def verified(right: DataFrame, shares: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (`a`, `b`) of `right` (a, b, share, b_text) whose whole shingle sets are
    similar."""
    left = shares.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    left = left.select("a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "a_text")
    both = right.join(left, ["a", "share"]).select("a", "b", "a_text", "b_text")

    def checked(batches):
        last, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, "b_text"):
                kept = []
                others = shingles(part.column("b_text"))
                for node, text, other in zip(part.column("a").to_pylist(), part.column("a_text"), others, strict=True):
                    if node != last:
                        last, own = node, shingles(pa.array([text.as_py()], pa.string()))[0]
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    kept.append(100 * shared >= PERCENT * (len(own) + len(other) - shared))
                pair = pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"])
                yield pair.filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(checked, "a long, b long")


def needed_texts(documents: DataFrame, sets: DataFrame, placed: DataFrame) -> DataFrame:
    """One text of each set (`node`) with what `placed` says of the set. Texts of other
    documents are mostly left out before the shuffle; copies of a row leave a task once."""
    wanted = sets.select("row_key", "node")
    rows = maybe_among(keyed(documents).select("row_key", "text"), "row_key", wanted)
    named = wanted.join(placed.withColumnRenamed("b", "node"), "node", "left")
    return rows.dropDuplicates(["row_key"]).join(named, "row_key").drop("row_key")


def links(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """Verified links (`a`, `b`) between sets that connect all similar sets."""
    buckets = materialize(shared_buckets(rows), "buckets")
    sets = rows.where("sketch is not null").join(buckets.select("node").distinct(), "node", "left_semi")
    sets = sets.groupBy("node").agg(
        F.min("row_key").alias("row_key"), *[F.first(c).alias(c) for c in ("size", "sketch", "bits")]
    )
    sets = materialize(sets, "sets")
    pairs, shares = with_shares(materialize(representatives(buckets), "pairs"))
    texts = materialize(needed_texts(documents, sets, pairs), "texts")
    right = texts.where("a is not null").select("a", F.col("node").alias("b"), "share", F.col("text").alias("b_text"))
    found = materialize(verified(right, shares, texts), "links")
    for turn in range(SETTLING + 1):
        near = apart(buckets, components(found), sets, closest=turn < SETTLING)
        pairs, shares = with_shares(materialize(near, "pairs"))
        right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        found = found.union(materialize(verified(right, shares, texts), "links"))
    return found


def deduplicated(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `documents`."""
    rows = materialize(signed(documents), "signed")
    roots = components(links(documents, rows))
    placed = rows.select("doc_id", "node", F.col("size").alias("n_shingles")).join(roots, "node", "left")
    placed = placed.select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    joined = placed.join(smallest, "root", "left").select("doc_id", "n_shingles", own.alias("component_id"))
    return joined.withColumn("kept", F.equal_null("doc_id", "component_id"))
