"""Remove lines that are similar to an earlier line of the corpus.

A line is the set of its distinct words (A-Z lower-cased). Two lines match when their
Jaccard similarity is `PERCENT` / 100 or more; a line that matches an earlier one (by
document id, then line number) is removed, whatever becomes of the earlier line. Lines
without words stay. The join is exact prefix filtering: words are ordered by rarity,
two matching lines share a word among the rarest of each, and the length filter, the
positional filter and parity bit sketches (their Hamming distance never exceeds the number
of differing words) discard pairs before the Jaccard similarity is verified: 128 bits in
the index, with one to two bits a word (1024 at most) for lines of more than 128 words, and
for longer lines a sketch of two to four bits a word beside the index.

Equal sets are first reduced to their earliest line. Then lines are compared with the
earliest line that has the same two smallest or largest word hashes, which settles most
copies in large groups by one comparison; all lines that are still open go through the
whole prefix index, and there the candidate with the closest sketch is tried first, then
every other one of the lines that it did not settle. Words are cut, hashed and ordered in Arrow batches (a
version with built-in expressions only cost too much, see the README); grouping and
joins are Spark's.

Words are compared by hashes: of 64 bits when a pair is verified, of 40 bits inside a
line, and of 32 bits in the index, where an accidental match only costs a comparison.

Defined results: null or empty texts have no lines to remove and keep their value; an
empty table gives an empty result; rows that repeat id and text are one document and get
the same result; rows that share an id with different texts, or have no id (they come
last), are ordered by content. A text of more than 2**27 lines is refused with an error. Helper columns are named
so that they never clash with columns of the table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.llm.bytesets import SPACED, mix, slices, text_bytes, word_bounds, word_hashes
from corpusloom.llm.prefilter import only_among
from corpusloom.sources.workdir import materialize

PERCENT = 75
LINE_BITS = 27
DOCUMENTS = 1 << (63 - LINE_BITS)
# Hash cells that word frequencies are counted in, for the order by rarity.
CELLS = 1 << 16
# Lines of more words have a longer sketch too.
SHORT_WORDS = 64
# Lines of more words have a sketch of 1 to 2 bits a word in the index, up to so many 64-bit words.
INDEX_SHORT, INDEX_SKETCH = 128, 16

LINE_NAMES = ["line", "lines", "n", "parity0", "parity1", "low", "high"]
# Groups that index rows are dealt into, for each shuffle partition; pairs tried at once.
GROUPS_PER_PARTITION, PAIRS_AT_ONCE = 4, 250_000
PACKED = ["word", "place", "rank", "parity0", "parity1", "n", "wide"]
# Lines that are sorted at once, so that the number of a line and a word fit one number.
LINES_AT_ONCE = 1 << 22
WORD_BITS, WORD_MASK, INDEX_MASK = np.uint64(40), np.uint64((1 << 40) - 1), np.uint64((1 << 32) - 1)

BLANKS = " \t\n\x0b\x0c\r"


def numbered(documents: DataFrame, name: str) -> DataFrame:
    """`documents` and a number `name` that follows the order of ids.

    Unique ids in a range of `DOCUMENTS` need no data to move: the number is the distance
    from the smallest. Otherwise ids and content hashes are sorted and counted through;
    rows that repeat id and text then share a number.
    """
    own = F.col("doc_id").cast("long")
    facts = documents.agg(F.min(own), F.max(own), F.count(own), F.count_distinct(own), F.count("*")).first()
    low, high, known, distinct, rows = facts
    if not rows or (known == distinct == rows and high - low < DOCUMENTS):
        return documents.withColumn(name, own - F.lit(low or 0))
    key = F.xxhash64(own, F.col("text").cast("string"))
    keys = documents.select(own.alias("id"), key.alias("key")).distinct()
    ordered = keys.repartitionByRange(F.col("id").asc_nulls_last(), "key").sortWithinPartitions(
        F.col("id").asc_nulls_last(), "key"
    )
    placed = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftright("at", 33)
    # One row for each partition.
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    numbers = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    number = (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name)
    numbers = numbers.select(F.col("key").alias(f"{name}_key"), number)
    return documents.withColumn(f"{name}_key", key).join(numbers, f"{name}_key").drop(f"{name}_key")


def line_words(numbers: np.ndarray, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every line with words, the start of its words, and the sorted distinct word hashes."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_bounds(data, offsets, SPACED)
    breaks = np.flatnonzero(data == 0x0A)
    at = np.searchsorted(breaks, starts) - np.repeat(np.searchsorted(breaks, offsets[:-1]), counts)
    if len(at) and at.max() >> LINE_BITS:
        raise ValueError(f"a text has more than 2**{LINE_BITS} lines")
    line = (np.repeat(numbers, counts) << LINE_BITS) + at
    hashes = word_hashes(data, starts, ends)
    # Rows are apart even where they repeat a number.
    # One number for line and word, so that one plain sort orders and uncovers repeats.
    fresh = np.append(True, line[1:] != line[:-1])[: len(line)]
    part = np.cumsum(fresh).astype(np.uint64) - np.uint64(1)
    firsts, words, size = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    for low, high, own in runs(part):
        packed = np.sort((own << WORD_BITS) | (hashes[low:high] & WORD_MASK))
        packed = packed[np.append(True, packed[1:] != packed[:-1])]
        own = packed >> WORD_BITS
        firsts.append(size + np.flatnonzero(np.append(True, own[1:] != own[:-1])))
        words.append(packed & WORD_MASK)
        size += len(packed)
    return line[fresh], np.concatenate(firsts), np.concatenate(words)


def runs(owner: np.ndarray):
    """Ascending line numbers cut into runs that can be packed: low, high, and numbers from 0."""
    base = 0
    while len(owner) and base <= int(owner[-1]):
        bounds = np.array([base, base + LINES_AT_ONCE], np.uint64)
        low, high = np.searchsorted(owner, bounds).tolist()
        yield low, high, owner[low:high] - np.uint64(base)
        base += LINES_AT_ONCE


def repeats(documents: DataFrame, number: str) -> bool:
    """Whether rows share a number."""
    counts = documents.agg(F.count(number), F.count_distinct(number)).first()
    return counts[0] != counts[1]


def lines_of(documents: DataFrame, number: str) -> DataFrame:
    """Per line with words: `line`, which orders all lines of the corpus, `lines` (hash of
    its word set), size `n`, `parity0` and `parity1` bits, `low` and `high`, hashes of
    its two smallest and largest words, and `wide`, a longer sketch of longer lines."""

    def measured(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                line, first, hashes = line_words(np.asarray(part.column(0)), part.column(1))
                if not len(line):
                    continue
                sizes = np.diff(np.append(first, len(hashes)))
                last = first + sizes - 1
                sets = mix(np.add.reduceat(mix(hashes), first) + sizes.astype(np.uint64))
                low = mix(hashes[first] + mix(hashes[np.minimum(first + 1, last)]))
                high = ~mix(hashes[last] + mix(hashes[np.maximum(last - 1, first)]))
                numbers = [sets.view(np.int64), sizes, *parity(hashes, first), low.view(np.int64), high.view(np.int64)]
                columns = [*(pa.array(c) for c in (line, *numbers)), wide_parity(hashes, sizes)]
                yield pa.RecordBatch.from_arrays(columns, [*LINE_NAMES, "wide"])

    source = documents.select(F.col(number).alias("number"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(measured, ", ".join(f"{name} long" for name in LINE_NAMES) + ", wide array<long>")


def parity(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """One bit for each of 128 hash slots: whether an odd number of words fell into it."""
    bits = np.uint64(1) << (hashes & np.uint64(63))
    upper = (hashes & np.uint64(64)) > 0
    halves = (np.where(upper, np.uint64(0), bits), np.where(upper, bits, np.uint64(0)))
    return [np.bitwise_xor.reduceat(half, first).view(np.int64) for half in halves]


def wide_parity(hashes: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Parity bits of the lines of more than `SHORT_WORDS` words, empty for others.

    A line of n words has the power of two from 2 n on as its number of slots, so the
    sketch of a line can be folded to the length of a shorter one by XOR of its halves.
    """
    return _sketches(hashes, sizes, np.where(sizes > SHORT_WORDS, _power_of_two(sizes, 32), 0))


def index_words(sizes: np.ndarray) -> np.ndarray:
    """How many 64-bit words the sketch has that a line of so many words takes into the index."""
    return np.where(sizes > INDEX_SHORT, np.minimum(_power_of_two(sizes, 64), INDEX_SKETCH), 0)


def _power_of_two(sizes: np.ndarray, share: int) -> np.ndarray:
    return (2 ** np.ceil(np.log2(np.maximum(sizes, share) / share))).astype(np.int64)


def _sketches(hashes: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> pa.ListArray:
    """Parity bits of each line in so many 64-bit words."""
    ends = np.cumsum(words)
    own = np.repeat(words > 0, sizes)
    slots = np.repeat(64 * words, sizes)[own].astype(np.uint64)
    at = (np.repeat(64 * (ends - words), sizes)[own] + (hashes[own] & (slots - np.uint64(1))).astype(np.int64))
    odd = np.bincount(at, minlength=64 * int(words.sum())).astype(np.uint8) & 1
    bits = np.packbits(odd, bitorder="little").view("<i8")
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(bits))


def within(differing, sizes):
    """Whether sets of so many words together can be similar with so many differing ones."""
    return F.lit(100 + PERCENT) * differing <= F.lit(100 - PERCENT) * sizes


def _bits_apart(a, b):
    """Differing bits of two arrays of equal length."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n.cast("int")
    )


def _folded(longer, size):
    """An array of twice the length `size`, its halves put together by XOR."""
    return F.zip_with(F.slice(longer, 1, size), F.slice(longer, size + 1, size), lambda x, y: x.bitwiseXOR(y))


def plausible(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The pairs that the longer sketches of both lines do not rule out."""
    own = firsts.where(F.size("wide") > 0).select("line", F.col("n").alias("own_n"), F.col("wide").alias("own_wide"))
    other = own.select(F.col("line").alias("other"), F.col("own_n").alias("other_n"), F.col("own_wide").alias("other_wide"))
    both = pairs.join(own, "line", "left").join(other, "other", "left")
    a, b = F.col("own_wide"), F.col("other_wide")
    # Sizes of plausible lines are within a third, so lengths are equal, or one is twice the other.
    apart = (
        F.when(F.size(a) == F.size(b), _bits_apart(a, b))
        .when(F.size(a) == 2 * F.size(b), _bits_apart(_folded(a, F.size(b)), b))
        .when(2 * F.size(a) == F.size(b), _bits_apart(a, _folded(b, F.size(a))))
    )
    return both.where(F.coalesce(within(apart, F.col("own_n") + F.col("other_n")), F.lit(True))).select("line", "other")


def matching(pairs: DataFrame, documents: DataFrame, number: str) -> DataFrame:
    """The pairs (`line`, `other`) whose word sets reach the similarity."""
    pairs = materialize(pairs, "line-pairs")
    needed = pairs.select("line").union(pairs.select("other")).distinct()
    needed = materialize(needed.select(F.xxhash64("line").alias("key")).distinct(), "needed")
    cut = documents.select(F.col(number).alias("number"), F.posexplode(F.split("text", "\n")).alias("at", "content"))
    cut = cut.select((F.shiftleft("number", LINE_BITS) + F.col("at")).alias("line"), "content")
    # Few lines that are not needed get as far as the join.
    found = materialize(only_among(cut.withColumn("key", F.xxhash64("line")), "key", needed).drop("key"), "contents")
    other = found.select(F.col("line").alias("other"), F.col("content").alias("other_content"))
    both = pairs.join(found, "line").join(other, "other").select("line", "other", "content", "other_content")

    def checked(batches):
        for batch in batches:
            for part in slices(batch, "content"):
                kept = similar(part.column("content"), part.column("other_content"))
                pair = pa.RecordBatch.from_arrays([part.column("line"), part.column("other")], ["line", "other"])
                yield pair.filter(pa.array(kept))

    return both.mapInArrow(checked, "line long, other long")


def similar(contents, others) -> np.ndarray:
    """Row by row, whether the word sets of two columns reach the similarity."""
    sets = [_distinct(*_row_words(column)) for column in (contents, others)]
    row, word = (np.concatenate(x) for x in zip(*sets, strict=True))
    both = np.bincount(row, minlength=len(contents))
    order = np.lexsort((word, row))
    row, word = row[order], word[order]
    again = (row[1:] == row[:-1]) & (word[1:] == word[:-1])
    shared = np.bincount(row[1:][again], minlength=len(contents))
    return 100 * shared >= PERCENT * (both - shared)


def _row_words(contents) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(contents)
    starts, ends, counts = word_bounds(data, offsets, SPACED)
    return np.repeat(np.arange(len(counts)), counts), word_hashes(data, starts, ends)


def _distinct(row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((word, row))
    row, word = row[order], word[order]
    fresh = np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1]))[: len(row)]
    return row[fresh], word[fresh]


def by_ends(firsts: DataFrame) -> DataFrame:
    """Candidates by equal smallest or largest words: the earliest such line."""
    rows = firsts.where("n > 1").select(F.explode(F.array("low", "high")).alias("key"), "line", "n", "parity0", "parity1")
    lead = F.min(F.struct("line", "n", "parity0", "parity1")).alias("lead")
    led = rows.join(rows.groupBy("key").agg(lead), "key").where(F.col("lead.line") < F.col("line"))
    n, m = F.col("n"), F.col("lead.n")
    led = led.where(F.lit(100) * F.least(n, m) >= F.lit(PERCENT) * F.greatest(n, m))
    apart = [F.bit_count(F.col(name).bitwiseXOR(F.col(f"lead.{name}"))) for name in ("parity0", "parity1")]
    led = led.where(within(apart[0] + apart[1], n + m))
    return led.groupBy("line").agg(F.min("lead.line").alias("other"))


def word_cells(documents: DataFrame) -> np.ndarray:
    """How many words of all lines fall into each of `CELLS` hash cells."""

    def counted(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                starts, ends, _ = word_bounds(data, offsets, SPACED)
                total += np.bincount(_cell(word_hashes(data, starts, ends)), minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CELLS)), pa.array(total)], ["cell", "n"])

    parts = documents.select(F.col("text").cast("string")).mapInArrow(counted, "cell long, n long")
    sums = parts.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.zeros(CELLS, np.int64)
    cells[sums.cell.to_numpy()] = sums.n.to_numpy()
    return cells


def _cell(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(16)) & np.uint64(CELLS - 1)).astype(np.int64)


def by_rarity(sizes: np.ndarray, hashes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The words of each line, the rarest first, as 32 bits."""
    owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    out = [np.zeros(0, np.uint32)]
    for low, high, own in runs(owner):
        words = hashes[low:high]
        rarity = steps[_cell(words)]
        packed = np.sort((own << np.uint64(42)) | (rarity << np.uint64(32)) | (words & INDEX_MASK))
        out.append((packed & INDEX_MASK).astype(np.uint32))
    return np.concatenate(out)


def prefix_index(documents: DataFrame, number: str, cells: np.ndarray) -> DataFrame:
    """Per line of at least three words, `line`, its rarest words as an array `rarest`, and
    `wide`, the sketch of a line of more than `INDEX_SHORT` words.

    Words are ordered by the logarithm of their cell's count, in 1024 steps, then by
    hash. Sets of one or two words match equal sets only.
    """
    steps = np.minimum(1023, 32 * np.log2(np.maximum(cells, 1))).astype(np.uint64)
    shared = documents.sparkSession.sparkContext.broadcast(steps)

    def ordered(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                line, first, hashes = line_words(np.asarray(part.column(0)), part.column(1))
                sizes = np.diff(np.append(first, len(hashes)))
                packed = by_rarity(sizes, hashes, shared.value)
                place = np.arange(len(hashes)) - np.repeat(first, sizes)
                prefix = np.where(sizes > 2, sizes - -(-PERCENT * sizes // 100) + 1, 0)
                kept = place < np.repeat(prefix, sizes)
                words = pa.array(packed[kept].view(np.int32))
                bounds = np.append(0, np.cumsum(prefix)).astype(np.int32)
                rarest = pa.ListArray.from_arrays(pa.array(bounds), words)
                wide = _sketches(hashes, sizes, np.where(sizes > 2, index_words(sizes), 0))
                yield pa.RecordBatch.from_arrays([pa.array(line), rarest, wide], ["line", "rarest", "wide"])

    source = documents.select(F.col(number).alias("number"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(ordered, "line long, rarest array<int>, wide array<long>")


def dealt(index: DataFrame, groups: int) -> DataFrame:
    """The index rows packed by groups of words, so that they travel as plain numbers."""

    def packed(batches):
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column("rarest").offsets))
            if not sizes.sum():
                continue
            word = np.asarray(batch.column("rarest").flatten()).view(np.uint32)
            rows = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            group = (mix(word.astype(np.uint64)) % np.uint64(groups)).astype(np.int32)
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
            columns = [word, place.astype("<u4")]
            columns += [np.asarray(batch.column(n)).astype("<i8")[rows] for n in ("rank", "parity0", "parity1")]
            columns.append(np.asarray(batch.column("n")).astype("<u4")[rows])
            bits = np.asarray(batch.column("wide").flatten()).astype("<i8")
            starts = np.asarray(batch.column("wide").offsets) - batch.column("wide").offsets[0].as_py()
            parts = [order[low:high] for low, high in zip(cuts, [*cuts[1:], len(order)], strict=True)]
            arrays = [pa.array([int(group[p[0]]) for p in parts], pa.int32())]
            arrays += [pa.array([values[p].tobytes() for p in parts], pa.binary()) for values in columns]
            spans = [_spans(starts[:-1][rows[p]], np.diff(starts)[rows[p]]) for p in parts]
            arrays.append(pa.array([bits[span].tobytes() for span in spans], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["part", *PACKED])

    return index.mapInArrow(packed, ", ".join(["part int", *(f"{name} binary" for name in PACKED)]))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all stretches of so many elements from each start."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _sketches_apart(bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the sketches of rows `a` and `b`, the longer folded; 0 where a row has none."""
    out = np.zeros(len(a), np.int64)
    for pair in {*zip(sizes[a].tolist(), sizes[b].tolist(), strict=True)}:
        if not all(pair):
            continue
        at = np.flatnonzero((sizes[a] == pair[0]) & (sizes[b] == pair[1]))
        sides = [bits[starts[x[at]][:, None] + np.arange(k)] for x, k in zip((a, b), pair, strict=True)]
        sides = [np.bitwise_xor.reduce(s.reshape(len(at), -1, min(pair)), axis=1) for s in sides]
        out[at] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return out


def _near(table: pa.Table) -> pa.Table:
    """Plausible pairs of one group of words: an open line and an earlier one."""

    def joined(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

    word, rank = joined("word", "<u4"), joined("rank", "<i8")
    place, n = joined("place", "<u4").astype(np.int64), joined("n", "<u4").astype(np.int64)
    bits = np.stack([joined(name, "<u8") for name in ("parity0", "parity1")], axis=1)
    wide, lengths = joined("wide", "<u8"), index_words(n)
    starts = np.cumsum(lengths) - lengths
    order = np.lexsort((n, word))
    word, rank, bits, place, n, starts, lengths = (x[order] for x in (word, rank, bits, place, n, starts, lengths))
    line = np.where(rank < 0, -rank - 1, rank)
    # Rows of a word lie together, ordered by size: a row's partners are a range.
    bucket = np.cumsum(np.append(True, word[1:] != word[:-1]))
    width = int(n.max()) * 200 + 1
    key = bucket * width + n
    open_rows = np.flatnonzero(rank >= 0)
    low = np.searchsorted(key, bucket[open_rows] * width + -(-PERCENT * n[open_rows] // 100))
    high = np.searchsorted(key, bucket[open_rows] * width + 100 * n[open_rows] // PERCENT, "right")
    found = []
    sizes = high - low
    done = 0
    while done < len(open_rows):
        upto = done + max(1, int(np.searchsorted(np.cumsum(sizes[done:]), PAIRS_AT_ONCE, "right")))
        own = sizes[done:upto]
        a = np.repeat(open_rows[done:upto], own)
        b = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[done:upto], own)
        done = upto
        kept = line[b] < line[a]
        a, b = a[kept], b[kept]
        both = n[a] + n[b]
        differing = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
        kept_sketch = (100 + PERCENT) * differing <= (100 - PERCENT) * both
        a, b, both = a[kept_sketch], b[kept_sketch], both[kept_sketch]
        # Words before the shared one can agree in the shorter part, words behind it too.
        most = np.minimum(place[a], place[b]) + np.minimum(n[a] - place[a], n[b] - place[b])
        kept = (100 + PERCENT) * most >= PERCENT * both
        a, b, both, differing = a[kept], b[kept], both[kept], differing[kept_sketch][kept]
        differing = np.maximum(differing, _sketches_apart(wide, starts, lengths, a, b))
        kept = (100 + PERCENT) * differing <= (100 - PERCENT) * both
        found.append(np.stack([line[a[kept]], line[b[kept]], differing[kept]]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), np.int64)
    return pa.table({"line": pairs[0], "other": pairs[1], "apart": pairs[2]})


def by_prefix(documents: DataFrame, number: str, firsts: DataFrame, settled: DataFrame) -> DataFrame:
    """Candidates of every open line: earlier lines that share one of the rarest words,
    and in how many bits of the sketches they are apart."""
    spark = documents.sparkSession
    known = settled.select("line", F.lit(True).alias("closed"))
    # A closed line is only an earlier line for others: its number is passed on negative.
    rank = F.when(F.col("closed"), -F.col("line") - 1).otherwise(F.col("line"))
    own = firsts.join(known, "line", "left").select("line", rank.alias("rank"), "n", "parity0", "parity1")
    index = prefix_index(documents, number, word_cells(documents))
    rows = index.join(own, "line").select("rank", "n", "parity0", "parity1", "rarest", "wide")
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = dealt(rows, groups).groupBy("part").applyInArrow(_near, "line long, other long, apart long")
    return pairs.distinct()


def removed_lines(documents: DataFrame, number: str) -> DataFrame:
    """`line` of every line to remove; `documents` has its number in column `number`."""
    lines = materialize(lines_of(documents, number), "lines")
    earliest = lines.groupBy("lines").agg(F.min("line").alias("line")).select("line")
    firsts = materialize(lines.join(earliest, "line", "left_semi").drop("lines"), "firsts")
    ends = plausible(by_ends(firsts), firsts)
    settled = materialize(matching(ends, documents, number).select("line").distinct(), "settled")
    near = materialize(by_prefix(documents, number, firsts, settled), "near")
    # One match settles a line, so the closest candidate is tried before all others are.
    best = near.groupBy("line").agg(F.min(F.struct("apart", "other")).alias("best")).select("line", "best.other")
    close = materialize(matching(plausible(best, firsts), documents, number).select("line"), "close")
    left = near.select("line", "other").join(close, "line", "left_anti").join(best, ["line", "other"], "left_anti")
    late = matching(plausible(left, firsts), documents, number).select("line").distinct()
    late = materialize(late, "late")
    # Joined by line, not by the hash of its words, which many lines may share.
    stay = firsts.select("line")
    for gone in (settled, close, late):
        stay = stay.join(gone, "line", "left_anti")
    return lines.select("line").join(stay, "line", "left_anti")


def _free(documents: DataFrame, name: str) -> str:
    while any(c.startswith(name) for c in documents.columns):
        name += "_"
    return name


def removals(documents: DataFrame, number: str) -> DataFrame:
    """`number` and the sorted line numbers to remove, for documents that lose lines."""
    one = documents.select(number, "text")
    if repeats(documents, number):
        one = materialize(one.dropDuplicates([number]), "documents")
    gone = removed_lines(one, number)
    at = F.col("line").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).cast("int")
    grouped = gone.groupBy(F.shiftright("line", LINE_BITS).alias(number)).agg(F.collect_list(at).alias("gone"))
    return grouped.select(number, F.array_sort("gone").alias(f"{number}_gone"))


def report(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed and the numbers (from 0) of removed lines."""
    rows = numbered(documents.select("doc_id", "text"), "number")
    gone = materialize(removals(rows, "number"), "removals")
    n_lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    counted = rows.select("doc_id", "number", F.when(F.col("text").isNull(), 0).otherwise(n_lines).alias("n_lines"))
    found = counted.join(gone, "number", "left")
    removed = F.coalesce("number_gone", F.array().cast("array<int>"))
    return found.select(
        F.col("doc_id").cast("long"),
        F.col("n_lines").cast("long"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed_lines"),
    )


def _without(lines, gone):
    """The array `lines` without the places `gone`, which ascend: the stretches between
    them, so that each line is looked at once."""

    def stretches(x):
        start = lambda i: F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
        end = lambda i: F.coalesce(F.get(gone, i), F.size(x))
        return F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(x, start(i) + 1, end(i) - start(i)))

    # A variable of the outer lambda, so the text is split once.
    return F.flatten(F.get(F.transform(F.array(lines), stretches), F.lit(0)))


def dedup(documents: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """`documents` without the removed lines; `n_chars`, if there, follows the text.

    With `drop_emptied`, documents go whose every word stood in a removed line; those
    that had no words before stay.
    """
    number = _free(documents, "number")
    rows = numbered(documents, number)
    gone = materialize(removals(rows, number), "removals")
    found = rows.join(gone, number, "left")
    own = F.col(f"{number}_gone")
    kept = _without(F.split(F.col("text").cast("string"), "\n"), own)
    text = F.when(own.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    columns = {"text": text}
    if "n_chars" in documents.columns:
        columns["n_chars"] = F.when(own.isNull(), F.col("n_chars")).otherwise(F.length(text))
    if drop_emptied:
        found = found.where(own.isNull() | (F.trim(text, F.lit(BLANKS)) != ""))
    return found.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in documents.columns])
