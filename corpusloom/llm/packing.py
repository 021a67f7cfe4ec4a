"""Pack tokenised documents into sequences of a fixed size.

Only the counts of piece lengths decide the packing, and there are at most
`capacity` different lengths. The plan is made on that histogram: for each length,
longest first, the gap it leaves is looked up among the sums of one, two and three
available lengths, and every exact combination is consumed as often as counts allow;
what remains is placed best-fit, longest first. A plan is a list of patterns (how many
sequences, of which lengths), so its size follows the number of lengths and not the
number of documents. Pieces then take their places by their rank among pieces of the
same length, which is counted in salted groups and so never needs one large sort.

Defined results: a null or empty text is the end token alone; an empty table packs
into nothing; repeated rows are packed as separate documents; a text longer than a
sequence is cut into full pieces and a last, possibly shorter one. Only the id and the
text are read, so other columns cannot clash.
"""

import re
import zlib
from math import ceil, sqrt

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.bytesets import LOWER, slices, text_bytes
from corpusloom.sources.workdir import materialize

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END = 0
# Pieces of one length that are ranked together at most.
RANK_GROUP = 1 << 16
# Bytes that a Python worker's memory of ids takes at most, about, and what an entry costs
# besides its content.
MEMORY_BYTES, ENTRY_BYTES = 64 << 20, 240
# Bytes of text whose words are looked up together.
SLICE = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# How the tokenizer cuts a lower-cased text of ASCII and Latin-1 letters: blanks, runs
# of letters, single digits, runs of the rest.
_BLANK, _LETTER, _DIGIT, _REST = range(4)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _BLANK
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")
_CONTRACTS = np.isin(np.arange(256), list(b"stmdrvlSTMDRVL"))

# Characters that stand for single bytes in the vocabulary: printable ones for themselves.
_SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
_BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def hard_places(data: np.ndarray) -> np.ndarray:
    """Bytes at which the simple cuts do not hold: special strings, contractions, and
    letters beyond Latin-1."""
    after = np.append(data[1:], np.uint8(0))
    before = np.append(np.uint8(0), data[:-1])
    letter = (data == 0xC3) & (after != 0x97) & (after != 0xB7)
    rest = (before == 0xC3) & (data < 0xC0)
    hard = (data >= 0x80) & ~letter & ~rest
    hard |= (data == 0x3C) & (after == 0x7C)
    hard |= (data == 0x27) & _CONTRACTS[after]
    return np.flatnonzero(hard)


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and Latin-1 letters."""
    out = LOWER[data]
    high = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][high] += 0x20
    return out


class Remembered(dict):
    """Ids worked out once from their key; emptied when keys and ids take too many bytes."""

    def __init__(self, compute, most: int = MEMORY_BYTES):
        self.compute, self.most, self.held = compute, most, 0

    def __missing__(self, key) -> np.ndarray:
        value = self.compute(key)
        # A character takes four bytes at most.
        size = ENTRY_BYTES + 4 * len(key) + value.nbytes
        if self.held + size > self.most:
            self.clear()
            self.held = 0
        if size <= self.most:
            self[key] = value
            self.held += size
        return value


class WordIds:
    """Ids of whole texts, from ids of their parts that were worked out once.

    The tokenizer drops white space and merges nothing across the cuts it makes first,
    so the ids of a text are those of its parts one after the other. Texts with special
    strings, contractions or rarer letters go to the tokenizer word by word.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.part = Remembered(self.of_part)
        self.word = Remembered(self.encode)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def of_part(self, part: bytes) -> np.ndarray:
        """Ids of a part that needs no further cut: only the merges are left to do."""
        if _CLASS[part[0]] == _BLANK:
            return np.zeros(0, "<u4")
        text = part.decode("latin-1").translate(_BYTE_CHARS)
        return np.array([token.id for token in self.model.tokenize(text)], "<u4")

    def by_words(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *map(self.word.__getitem__, _BLANKS.split(text))])

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        data, offsets = text_bytes(texts)
        hard = np.diff(np.searchsorted(hard_places(data), offsets)) > 0
        kind = _CLASS[data]
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(lower(data))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()
        known = list(map(self.part.__getitem__, coded.dictionary.to_pylist()))
        flat = np.concatenate([np.zeros(0, "<u4"), *known])
        sizes = np.fromiter(map(len, known), np.int64, len(known))
        which = np.asarray(coded.indices)
        own = sizes[which]
        ends = np.zeros(len(which) + 1, np.int64)
        np.cumsum(own, out=ends[1:])
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        ids = flat[np.arange(ends[-1]) + np.repeat(shift, own)]
        bounds = ends[np.searchsorted(cuts, offsets)]
        return [
            self.by_words(texts[i].as_py()) if hard[i] else ids[bounds[i] : bounds[i + 1]]
            for i in range(len(texts))
        ]


_encoders: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def tokenised(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of all documents: place, length and checksum of the ids."""
    path = path or public_tokenizers.path(TOKENIZER)
    end = np.array([END], "<u4").tobytes()

    def cut_up(batches):
        encoder = word_ids(path)
        for batch in batches:
            rows = []
            for part in slices(batch, "text", SLICE):
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.ids(part.column(1)), strict=True):
                    own = ids.tobytes() + end
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        cut = own[at : at + 4 * capacity]
                        rows.append((doc_id, piece, at // 4, len(cut) // 4, zlib.crc32(cut)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PIECES.split(", ")])

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(cut_up, PIECES)


def complements(counts: np.ndarray, length: int, gap: int):
    """One, two or three available lengths that sum to `gap`, or None.

    `counts` are what is left after taking one piece of `length`.
    """
    if counts[gap]:
        return (gap,)
    have = counts > 0
    for first in (0, *range(gap - 2, 0, -1)):
        if first:
            if not have[first]:
                continue
            counts[first] -= 1
            have[first] = counts[first] > 0
        rest = gap - first
        low = np.arange(1, (rest + 1) // 2)
        both = np.flatnonzero(have[low] & have[rest - low])
        found = None
        if len(both):
            found = (rest - int(low[both[0]]), int(low[both[0]]))
        elif rest % 2 == 0 and counts[rest // 2] > 1:
            found = (rest // 2, rest // 2)
        if first:
            counts[first] += 1
            have[first] = True
        if found:
            return (first, *found) if first else found
        if first and first * 3 < gap:
            break  # the largest of three is at least a third
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """How many sequences hold which lengths: exact combinations, then best fit."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns: list[tuple[int, tuple[int, ...]]] = []
    if counts[capacity]:
        patterns.append((int(counts[capacity]), (capacity,)))
        counts[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while counts[length]:
            counts[length] -= 1
            found = complements(counts, length, capacity - length)
            counts[length] += 1
            if not found:
                break
            group = (length, *found)
            times = min(int(counts[x]) // group.count(x) for x in set(group))
            for x in group:
                counts[x] -= times
            patterns.append((times, group))
    return patterns + best_fit(counts, capacity)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Longest first into the smallest gap that holds it; equal sequences together."""
    gaps: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    open_gaps = np.zeros(capacity + 1, bool)

    def put(gap: int, times: int, group: tuple[int, ...]):
        gaps.setdefault(gap, []).append((times, group))
        open_gaps[gap] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(open_gaps[length:])
            if not len(fits):
                each = min(left, capacity // length)
                put(capacity - each * length, left // each, (length,) * each)
                left %= each
                continue
            gap = length + int(fits[0])
            times, group = gaps[gap].pop()
            open_gaps[gap] = bool(gaps[gap])
            used = min(left, times)
            if used < times:
                put(gap, times - used, group)
            put(gap - length, used, (*group, length))
            left -= used
    return [x for groups in gaps.values() for x in groups]


def slots(patterns) -> tuple[np.ndarray, ...]:
    """Per length and run of ranks: where the run starts, its sequences and its offset."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for times, group in patterns:
        offset = 0
        for length in group:
            low = used.get(length, 0)
            rows.append((length, low, sequence, offset))
            used[length] = low + times
            offset += length
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Each piece's rank (from 0) among the pieces of its length.

    Pieces of a length are ranked within salted groups, at least as many as a group has
    pieces, so that a group is small; it starts where the groups before it end.
    """
    counts = [histogram.get(n, 0) for n in range(max(histogram, default=0) + 1)]
    groups = [max(1, ceil(sqrt(n)), -(-n // RANK_GROUP)) for n in counts]
    salts = F.split(F.lit(",".join(map(str, groups))), ",")[F.col("length").cast("int")].cast("int")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    placed = salted.withColumn("row", F.row_number().over(own) - 1)
    return placed.join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("row"))


def pack(documents: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    pieces = materialize(tokenised(documents, capacity, path), "pieces")
    # At most `capacity` rows.
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    rows = pieces.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))

    def placed(batches):
        length, low, sequence, offset = rows.value
        key = (length << 44) + low
        for batch in batches:
            own = np.asarray(batch.column("length")).astype(np.int64)
            rank = np.asarray(batch.column("rank")).astype(np.int64)
            at = np.searchsorted(key, (own << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(sequence[at] + rank - low[at]),
                    pa.array(offset[at]),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    places = ranked(pieces, histogram).select(*columns)
    return places.mapInArrow(placed, PIECES + ", sequence_id long, offset long")
