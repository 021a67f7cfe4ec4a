"""Exact token counts at every prefix of a text, for a merge-based piece model.

A text is cut where no piece can reach across (before a blank, and at line ends). The
count of a prefix that ends at a cut is the count at the cut before it plus the tokens
of the part between; each distinct part is solved once and remembered. Inside a part,
a second recursion runs over characters: the tokens of a prefix are those of a shorter
prefix plus one last piece, and the right last piece is the one that forms a stable pair
with the token before it. So a count for every prefix is known, and truncation and
budget questions are answered without encoding any prefix. The count of a part is that of its last prefix;
the library then checks it, once for each distinct part.

Defined results: a null or empty text has no tokens, no bytes, and fits any limit;
repeated rows are counted one by one; very long texts and very long words cost time
in proportion to their length. Only the id and the text are read, so other columns
cannot clash.
"""

import re

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
BLANK = "▁"
# Entries of each memory of solved parts and pairs; a full memory is emptied.
MEMORY = 400_000

# Tokens are numbered from 1; BARE plus a code point is a character without a piece.
BARE = 1 << 20
SHIFT = 1 << 22

_PARTS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("fit_chars", T.LongType()),
    ]
)


class Memory(dict):
    """Values computed once from their key; emptied when it has grown full."""

    def __init__(self, compute, size: int = MEMORY):
        self.compute, self.size = compute, size

    def __missing__(self, key):
        if len(self) >= self.size:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class PieceModel:
    """Pieces and scores of a model file, and prefix counts by its merges."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ids if not special[i]}
        self.names = dict(enumerate(self.scores, 1))
        self.tree: dict = {}
        for number, piece in self.names.items():
            node = self.tree
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = number
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.scores):
            raise ValueError("a piece reaches across a blank")
        self.lines_apart = not any("\n" in p for p in self.scores)
        self.stable = Memory(self.is_stable)
        # The last prefix of a part is the part. The library checks each distinct one; it sets
        # a blank before a text, and a part without one follows a line end.
        line_end = len(model.encode("\n"))
        self.blank_part = Memory(lambda word: self.checked(BLANK + word, len(model.encode(word)) if word else self.cost(BLANK)))
        self.bare_part = Memory(lambda word: self.checked(word, len(model.encode("\n" + word)) - line_end))

    def merge(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def name(self, token: int) -> str:
        """The text of a token; numbers beyond the pieces stand for bare characters."""
        return self.names.get(token) or chr(token - BARE)

    def is_stable(self, pair: int) -> bool:
        """Whether two tokens stay as they are side by side (or one at the start)."""
        tokens = [self.name(t) for t in divmod(pair, SHIFT) if t]
        return self.merge("".join(tokens)) == tokens

    def cost(self, token: str) -> int:
        """One for a piece; a character without one becomes its bytes."""
        return 1 if token in self.scores else len(token.encode())

    def prefixes(self, part: str) -> list[int]:
        """The token count of every prefix of a part, the empty one first."""
        size = len(part)
        counts, last = [0] * (size + 1), [0] * (size + 1)
        tree, stable = self.tree, self.stable
        for start in range(size):
            if start and not last[start]:
                counts[start], last[start] = self.merged(part[:start])
            own, pair = counts[start] + 1, last[start] * SHIFT
            node, end = tree, start
            for char in part[start:]:
                node = node.get(char)
                if node is None:
                    break
                end += 1
                if "" in node and not last[end] and stable[pair + node[""]]:
                    counts[end], last[end] = own, node[""]
            if not last[start + 1] and part[start] not in self.scores:
                bare = BARE + ord(part[start])
                if stable[pair + bare]:
                    counts[start + 1], last[start + 1] = counts[start] + self.cost(part[start]), bare
        if size and not last[size]:
            counts[size], _ = self.merged(part)
        return counts

    def checked(self, part: str, expected: int) -> int:
        """The count of a whole part by the recursion. If the library counts otherwise, its
        count holds."""
        found = self.prefixes(part)[-1]
        return found if found == expected else expected

    def merged(self, prefix: str) -> tuple[int, int]:
        """Count and last token of a prefix that has no stable last piece."""
        tokens = self.merge(prefix)
        final = tokens[-1]
        number = next((n for n, p in self.names.items() if p == final), None) or BARE + ord(final)
        return sum(map(self.cost, tokens)), number

    def lines(self, text: str) -> list[str]:
        text = text.replace(BLANK, " ")
        return text.split("\n") if self.lines_apart else [text]

    def count(self, text: str) -> int:
        """The number of tokens of a whole text."""
        if not text:
            return 0
        lines = self.lines(text)
        total = (len(lines) - 1) * self.cost("\n")
        for number, line in enumerate(lines):
            words = line.split(" ")
            if "" in words:
                total += sum(self.part(p) for p in self.parts(line, number == 0))
            elif number == 0:
                total += sum(map(self.blank_part.__getitem__, words))
            else:
                total += self.bare_part[words[0]] + sum(map(self.blank_part.__getitem__, words[1:]))
        return total

    def parts(self, line: str, first: bool) -> list[str]:
        """Parts of a line that no piece crosses; the first line gets a leading blank."""
        return _PARTS.findall(BLANK * first + line.replace(" ", BLANK))

    def part(self, part: str) -> int:
        if part[0] == BLANK:
            return self.blank_part[part[1:]]
        return self.bare_part[part]

    def table(self, text: str) -> list[int]:
        """The token count of every prefix of a text, the empty one first."""
        counts = [0]
        if not text:
            return counts
        done = 0
        for number, line in enumerate(self.lines(text)):
            if number:
                done += self.cost("\n")
                counts.append(done)
            for k, part in enumerate(self.parts(line, number == 0)):
                own = self.prefixes(part)
                # The blank set before a text belongs to no character of it.
                counts += [done + c for c in own[2 if number == 0 and k == 0 else 1 :]]
                done += own[-1]
        return counts

    def fit(self, text: str, limit: int) -> int:
        """Code points of the longest prefix that has at most `limit` tokens."""
        done = at = 0
        for number, line in enumerate(self.lines(text) if text else []):
            if number:
                if done + self.cost("\n") > limit:
                    return at
                done, at = done + self.cost("\n"), at + 1
            for k, part in enumerate(self.parts(line, number == 0)):
                added = number == 0 and k == 0
                if done + self.part(part) > limit:
                    own = self.prefixes(part)
                    best = max(i for i, c in enumerate(own) if done + c <= limit)
                    return max(0, at + best - added)
                done, at = done + self.part(part), at + len(part) - added
        return at


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model for each file in a Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def count_tokens(documents: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Bytes, tokens and the longest prefix within `limit`, for every row.

    `path` names the model file, which every executor must have.
    """
    path = path or public_tokenizers.path(MODEL)

    def counted(batches):
        model = piece_model(path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            tokens, fits = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                tokens.append(model.count(text))
                fits.append(len(text) if tokens[-1] <= limit else model.fit(text, limit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens, pa.int64()), pa.array(fits, pa.int64())], SCHEMA.names
            )

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(counted, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_tables(documents: DataFrame, path: str | None = None) -> DataFrame:
    """For every row, the token count of each prefix of its text, the empty one first."""
    path = path or public_tokenizers.path(MODEL)

    def tables(batches):
        model = piece_model(path)
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1), strict=True):
                counts = model.table(value.as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), pa.array([counts], pa.list_(pa.int32()))],
                    ["doc_id", "counts"],
                )

    source = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(tables, "doc_id long, counts array<int>")
