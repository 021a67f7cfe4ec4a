"""Find licence tags and notices, and evaluate licence expressions.

One Aho-Corasick automaton over the lower-cased words of a text holds notice
phrases and the words of the identifier tag. After a tag, the licence expression
is read from the original text, turned into postfix order by a shunting-yard
parser (with binds tighter than and, and tighter than or) and evaluated: `or` takes
the most open branch, `and` the least open one, `with` opens a copyleft licence by a
step. The score is the openness of the least open finding, 0 (none or reserved) to 1.

Defined results: a null or empty text has no words, no places, null first and last
word, empty labels and score 0. A malformed expression still gives the labels of the
identifiers in it, and its openness is the least of them. Repeated rows are judged
one by one. Only the id and the text are read, so other names cannot clash.
"""

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.decontaminate import flat_text

# Notice phrases (as words) and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
MORE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "boost software license": "bsl",
    "cc0": "cc0",
    "public domain": "public-domain",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "permission is hereby granted free of charge": "mit",
    "all rights reserved": "reserved",
}
# Beginnings of licence identifiers, longest first where they overlap.
IDENTIFIERS = [
    ("agpl", "agpl"),
    ("lgpl", "lgpl"),
    ("gpl", "gpl"),
    ("apache", "apache"),
    ("mit", "mit"),
    ("bsd", "bsd"),
    ("0bsd", "bsd"),
    ("mpl", "mpl"),
    ("epl", "epl"),
    ("isc", "isc"),
    ("unlicense", "unlicense"),
    ("bsl", "bsl"),
    ("cc0", "cc0"),
    ("cc-by-nc-nd", "cc-by-nc-nd"),
    ("cc-by-nc-sa", "cc-by-nc-sa"),
    ("cc-by-nc", "cc-by-nc"),
    ("cc-by-nd", "cc-by-nd"),
    ("cc-by-sa", "cc-by-sa"),
    ("cc-by", "cc-by"),
]
# Openness of a label; others count as UNKNOWN.
OPENNESS = {
    "cc0": 1.0,
    "public-domain": 1.0,
    "unlicense": 1.0,
    "mit": 0.95,
    "isc": 0.95,
    "bsd": 0.95,
    "bsl": 0.95,
    "apache": 0.9,
    "cc-by": 0.9,
    "mpl": 0.7,
    "epl": 0.7,
    "lgpl": 0.6,
    "cc-by-sa": 0.6,
    "cc": 0.5,
    "gpl": 0.4,
    "agpl": 0.3,
    "cc-by-nd": 0.2,
    "cc-by-nc": 0.2,
    "cc-by-nc-sa": 0.2,
    "cc-by-nc-nd": 0.1,
    "reserved": 0.0,
}
UNKNOWN = 0.3
EXCEPTION_STEP = 0.2
TAG_WORDS = "spdx license identifier"

_TAG = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
_BINDS = {"or": 1, "and": 2, "with": 3}

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expressions", T.ArrayType(T.StringType())),
    ]
)


def automaton() -> ahocorasick.Automaton:
    tree = ahocorasick.Automaton()
    tree.add_word(f" {TAG_WORDS} ", (3, None, False))
    for phrases, base in ((MORE_PHRASES, False), (BASE_PHRASES, True)):
        for phrase, label in phrases.items():
            tree.add_word(f" {phrase} ", (len(phrase.split()), label, base))
    tree.make_automaton()
    return tree


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the tokens in postfix order, or None if malformed.

    Reading stops at the first token that cannot continue the expression, so prose
    after a tag does no harm.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = True  # an operand or an opening parenthesis comes next
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if operand:
            if word == "(":
                stack.append(word)
            elif word in _BINDS or word == ")":
                return None
            else:
                out.append(token)
                operand = False
        elif word in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = True
        elif word == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            break
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


# What may follow a licence's name in an identifier: nothing, a version, or a further part.
_NAME_END = re.compile(r"\Z|[-+_.]|v?[0-9]")


def label_of(identifier: str) -> str:
    """The label of an identifier that has a known name as a whole word; others are
    labels of their own."""
    word = identifier.lower().rstrip(".")
    known = (label for start, label in IDENTIFIERS if word.startswith(start) and _NAME_END.match(word, len(start)))
    return next(known, word)


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels named in an expression, and its openness."""
    order = postfix(expression)
    if order is None:
        labels = {label_of(t) for t in _TOKEN.findall(expression) if label_of(t) in OPENNESS}
        return labels, min((OPENNESS[x] for x in labels), default=UNKNOWN)
    labels: set[str] = set()
    stack: list[tuple[float, str]] = []
    for token in order:
        if token in _BINDS:
            right, left = stack.pop(), stack.pop()
            if token == "or":
                stack.append((max(left[0], right[0]), ""))
            elif token == "and":
                stack.append((min(left[0], right[0]), ""))
            else:  # the right side names an exception, no licence
                labels.discard(right[1])
                stack.append((min(1.0, left[0] + EXCEPTION_STEP), ""))
        else:
            label = label_of(token)
            labels.add(label)
            stack.append((OPENNESS.get(label, UNKNOWN), label))
    return labels, stack[-1][0]


def judge(tree: ahocorasick.Automaton, text: str | None) -> tuple:
    flat = flat_text(text)
    n_words = max(0, flat.count(" ") - 1)
    found = list(tree.iter(flat)) if flat else []
    if not found:
        return n_words, 0, None, None, "", "", 0.0, []
    blanks = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 0x20)
    places, base, notices, tagged = [], set(), [], False
    for at, (length, label, is_base) in found:
        end = int(np.searchsorted(blanks, at))
        if label is None:
            tagged = True
            continue
        notices.append((end - length, end, label))
        if is_base:
            places.append(end - length)
            base.add(label)
    # A notice inside a longer one (cc by in cc by nc) names no licence of its own.
    own = {
        label
        for a, b, label in notices
        if not any(x <= a and b <= y and (x, y) != (a, b) for x, y, _ in notices)
    }
    values = [OPENNESS[x] for x in own]
    expressions = _TAG.findall(text) if tagged else []
    labels = base | own
    for expression in expressions:
        more, value = evaluate(expression)
        labels |= more
        values.append(value)
    first, last = (min(places), max(places)) if places else (None, None)
    score = min(values, default=0.0)
    return n_words, len(places), first, last, _list(base), _list(labels), score, expressions


def _list(labels: set[str]) -> str:
    return ",".join(sorted(labels))


def licenses(documents: DataFrame) -> DataFrame:
    """Word counts, places, labels and openness for every row of `documents`."""

    def judged(batches):
        tree = automaton()
        for batch in batches:
            rows = [judge(tree, text.as_py()) for text in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], SCHEMA.names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(judged, SCHEMA)
