"""Find passages of a benchmark in documents with an Aho-Corasick automaton.

Both sides are lower-cased (A-Z) and cut into words, runs of ASCII letters and
digits and of anything beyond ASCII. Every run of `width` words of a benchmark
item is a pattern (a shorter item is one pattern), and one automaton holds the
patterns of all items. Each text is normalised and scanned once; the ends of
matches are mapped back to words and to character spans of the original text.

Defined results: a null or empty text has no words, no hits and is never
contaminated; an item without words has no pattern; the passages of items with a
null id are hits like all others, add no id to `items`, set `unnamed`, and count as
one item together in `n_items`; items with equal passages are all reported; repeated rows are judged one by one; an empty benchmark or
empty documents give no hits or no rows. Columns other than the id and the text
are neither read nor returned, so their names cannot clash.
"""

from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bytesets import PLAIN_TEXT

WIDTH = 13
# Bytes of benchmark text in one automaton; a larger benchmark is scanned in blocks.
BLOCK_BYTES = 4 << 20

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("chars", SPANS),
        T.StructField("unnamed", T.BooleanType()),
    ]
)


def normalised(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return (text or "").encode().translate(PLAIN_TEXT).split()


def windows(words: list[bytes], width: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def blocks(benchmark: DataFrame, width: int = WIDTH, limit: int = BLOCK_BYTES):
    """Patterns to item ids (None if null), block by block; the driver holds one block at a time."""
    patterns: dict[str, tuple[int, set[str | None]]] = {}
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        words = normalised(text)
        if not words:
            continue
        if size and size + len(text) > limit:
            yield patterns
            patterns, size = {}, 0
        for window in windows(words, width):
            key = f" {window.decode('latin-1')} "
            patterns.setdefault(key, (min(width, len(words)), set()))[1].add(item)
        size += len(text)
    yield patterns


_built: dict[int, ahocorasick.Automaton] = {}


def automaton(broadcast) -> ahocorasick.Automaton:
    """The automaton of a broadcast block; each Python worker keeps the last one."""
    if broadcast.id not in _built:
        _built.clear()
        tree = ahocorasick.Automaton()
        for key, value in broadcast.patterns.value.items():
            tree.add_word(key, value)
        if len(tree):
            tree.make_automaton()
        _built[broadcast.id] = tree
    return _built[broadcast.id]


@dataclass
class Block:
    """The broadcast patterns of a block of the benchmark, and its number."""

    id: tuple[int, int]
    patterns: Broadcast


def flat_text(text: str | None) -> str:
    """The words of a text, each between two blanks, one character for each byte."""
    words = normalised(text)
    return f" {b' '.join(words).decode('latin-1')} " if words else ""


def scan(tree: ahocorasick.Automaton, flat: str) -> tuple[list[tuple[int, int]], set[str | None]]:
    """Word ranges that matches cover, and the items found."""
    found = list(tree.iter(flat)) if flat and len(tree) else []
    if not found:
        return [], set()
    blanks = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 0x20)
    last = np.searchsorted(blanks, [at for at, _ in found]).tolist()
    ranges = [(end - length, end) for end, (_, (length, _)) in zip(last, found, strict=True)]
    return ranges, set().union(*(ids for _, (_, ids) in found))


def merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(low, high) for low, high in out]


def char_spans(text: str, ranges) -> list[tuple[int, int]]:
    """Word ranges as character spans of the original text."""
    if not ranges:
        return []
    raw = text.encode()
    flat = np.frombuffer(b" " + raw.translate(PLAIN_TEXT) + b" ", np.uint8) != 0x20
    starts = np.flatnonzero(flat[1:] & ~flat[:-1])
    ends = np.flatnonzero(~flat[1:] & flat[:-1])
    return [(len(raw[: starts[a]].decode()), len(raw[: ends[b - 1]].decode())) for a, b in ranges]


def find(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of documents: n_words, hit word ranges, items, character spans, whether an item without id hits.

    A benchmark beyond `BLOCK_BYTES` becomes several automata; each batch of texts
    is then scanned with one after the other, and the ranges are merged.
    """
    context = documents.sparkSession.sparkContext
    shared = []
    for patterns in blocks(benchmark, width):
        broadcast = context.broadcast(patterns)
        shared.append(Block((id(context), len(shared) + (broadcast._jbroadcast.id() << 20)), broadcast))

    def scanned(batches):
        for batch in batches:
            texts = batch.column(1)
            flats = [flat_text(text.as_py()) for text in texts]
            ranges: list[list] = [[] for _ in flats]
            items: list[set] = [set() for _ in flats]
            for block in shared:
                tree = automaton(block)
                for i, flat in enumerate(flats):
                    more, ids = scan(tree, flat)
                    ranges[i] += more
                    items[i] |= ids
            joined = [merged(r) for r in ranges]
            spans = [char_spans(texts[i].as_py(), r) if r else [] for i, r in enumerate(joined)]
            counts = [max(0, flat.count(" ") - 1) for flat in flats]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    _spans(joined),
                    pa.array([sorted(i - {None}) for i in items], pa.list_(pa.string())),
                    _spans(spans),
                    pa.array([None in i for i in items], pa.bool_()),
                ],
                FOUND.names,
            )

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(scanned, FOUND)


def _spans(rows) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"start": a, "end": b} for a, b in row] for row in rows], kind)


def judged(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = 20) -> DataFrame:
    """The findings with counts and the verdict: hit words are at least 1/`share` of all."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return (
        find(documents, benchmark, width)
        .withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long") + F.col("unnamed").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))
    )


def clean(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = 20) -> DataFrame:
    """The rows of `documents` that are not contaminated, with their columns.

    Rows are told apart by id and text, so rows that share an id keep their own verdicts.
    """
    name = "row_key"
    while name in documents.columns:
        name += "_"
    rows = documents.withColumn(name, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    keyed = rows.select(F.col(name).alias("doc_id"), "text")
    found = judged(keyed, benchmark, width, share).where("contaminated")
    found = found.select(F.col("doc_id").alias(name)).distinct()
    kept = rows.join(found, name, "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])
