"""Quality rules: fixed counts, and divergence from the usual text of a language.

Per document the counts of character classes and of common words are compared with
those of all documents of its language (base rules passed, enough words), as
Jensen-Shannon distances with base 2, so 0 is the same mix and 1 has nothing in common.
A distance counts only for documents long enough for it. The limit of the word distance
follows the language: a text without any common word is as far from the reference as the
share of common words there allows, and a text with fewer common words than usual fails
once it is nearly that far and farther than chance explains at its length. Common words
are compared lower-cased. Everything is built-in expressions; repeated word windows are
found by hash inside a row, without a shuffle.

Defined results: a null or empty text has no words and fails the base rules. Documents
of null or unlisted language are compared with their own kind on characters only;
where no reference exists, nothing diverges. Repeated rows are judged one by one and an
empty table gives an empty result. Counts live in one struct whose name is
free in the table, so other columns keep their names and values.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.workdir import materialize

MIN_WORDS = 10
REPEAT_PERCENT = 20
# Documents of fewer words are not compared with the reference.
MIN_COMPARED_WORDS = 30
MIN_COMMON_WORDS = 100
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.8
# Of the distance of a text without common words, for texts with fewer than usual.
NO_COMMON_PART = 0.85
# Standard deviations above the mean distance of a text drawn from the reference.
CHANCE_DEVIATIONS = 3
WINDOW = 5

# Frequent function words.
COMMON_WORDS = {
    "en": "the of and to a in is that it for on with as was be by this are from or",
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un une du que est pour qui dans sur pas au avec par",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}

_BLANK = r"[ \t-\r]"
_BLANKS = " \t\n\x0b\x0c\r"
_CLASSES = {
    "upper": "[^A-Z]+",
    "digit": "[^0-9]+",
    "line": "[^\n\r]+",
    "mark": r"[^.,;:!?'\"()\-]+",
    "symbol": "[^#*$%&|<>]+",
    "other": r"[\x00-\x7F]+",
}
_SIZES = ("plain", *_CLASSES)


def _left(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, "")).cast("long")


def _hash(word) -> Column:
    return F.xxhash64(word)


def measured(frame: DataFrame, name: str) -> DataFrame:
    """`frame` (with `text` and `lang`) and one struct of counts called `name`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    trimmed = F.trim(text, F.lit(_BLANKS))
    words = F.when(trimmed != "", F.split(trimmed, f"{_BLANK}+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    common = F.lit(None).cast("array<bigint>")
    for lang, listed in COMMON_WORDS.items():
        hashes = F.array(*[_hash(F.lit(w)) for w in listed.split()])
        common = F.when(F.col("lang") == lang, hashes).otherwise(common)
    # Each step is a column of its own: what a lambda reads again and again must be a
    # finished value and not an expression.
    made = {k: f"{name}_{k}" for k in ("text", "words", "rest", "lines", "common", "hashes", "windows", "ordered")}
    made |= {k: f"{name}_{k}" for k in ("places", "seen")}
    at = {k: F.col(c) for k, c in made.items()}
    step = frame.withColumns({made["text"]: text, made["common"]: common})
    step = step.withColumns(
        {
            made["words"]: words,
            made["rest"]: F.regexp_replace(text, "[a-z ]+", ""),
            made["lines"]: lines,
        }
    )
    step = step.withColumn(made["hashes"], F.transform(at["words"], _hash))
    following = [lambda i, k=k: F.get(at["hashes"], i + k) for k in range(1, WINDOW)]
    windows = F.transform(at["hashes"], lambda h, i: F.xxhash64(h, *[next_at(i) for next_at in following]))
    full = F.greatest(F.size(at["hashes"]) - (WINDOW - 1), F.lit(0))
    lowered = F.transform(at["words"], lambda w: _hash(F.lower(w)))
    seen = F.filter(lowered, lambda h: F.array_contains(at["common"], h))
    step = step.withColumns(
        {
            made["windows"]: F.slice(windows, F.lit(1), full),
            made["seen"]: F.when(at["common"].isNotNull(), seen),
        }
    )
    ordered = F.array_sort(F.transform(at["windows"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct(at["windows"])) < F.size(at["windows"])
    step = step.withColumn(made["ordered"], F.when(repeated, ordered))
    twice = F.filter(
        at["ordered"],
        lambda x, k: F.coalesce(x["h"] == F.get(at["ordered"], k + 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(at["ordered"], k - 1)["h"], F.lit(False)),
    )
    step = step.withColumn(made["places"], F.array_sort(F.transform(twice, lambda x: x["i"])))
    covered = F.transform(
        at["places"],
        lambda i, k: F.least(F.coalesce(F.get(at["places"], k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    counts = F.aggregate(covered, F.lit(0).cast("long"), lambda n, c: n + c)
    tally = F.transform(at["common"], lambda c: F.size(F.filter(at["seen"], lambda h: h == c)).cast("long"))
    n_words = F.size(at["words"]).cast("long")
    return step.withColumn(
        name,
        F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(at["words"], "")).cast("long").alias("word_chars"),
            _left(at["rest"], _CLASSES["symbol"]).alias("n_symbols"),
            (F.size(at["lines"]) - F.size(F.array_distinct(at["lines"]))).cast("long").alias("n_dup_lines"),
            F.coalesce(counts, F.lit(0).cast("long")).alias("n_repeat_words"),
            F.array(
                (F.length(at["text"]) - F.length(at["rest"])).cast("long"),
                *[_left(at["rest"], drop) for drop in _CLASSES.values()],
            ).alias("chars"),
            F.when(
                at["common"].isNotNull(),
                F.concat(tally, F.array(n_words - F.size(at["seen"]).cast("long"))),
            ).alias("common"),
        ),
    ).drop(*made.values())


def base_failed(own: Column) -> Column:
    return (own["n_words"] < MIN_WORDS) | (100 * own["n_repeat_words"] > REPEAT_PERCENT * own["n_words"])


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms; null if one is missing or empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    share = lambda x: F.transform(x, lambda v: v / total(x))

    def part(p, q):
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    sums = total(F.zip_with(share(counts), share(reference), lambda p, q: part(p, q) + part(q, p)))
    return F.when((total(counts) > 0) & (total(reference) > 0), F.sqrt(F.greatest(sums / 2, F.lit(0.0))))


def rest_share(counts: Column) -> Column:
    """The share of words that are not common."""
    return F.element_at(counts, -1) / F.aggregate(counts, F.lit(0.0), lambda s, v: s + v)


def word_limits(reference: Column) -> tuple[Column, Column]:
    """The distance that a text without common words nearly has, and n words x divergence by chance.

    The divergence of n words drawn from the reference is about a chi-square of as many
    degrees as there are free cells, over 8 n ln 2.
    """
    no_common = F.transform(reference, lambda v, i: (i == F.size(reference) - 1).cast("double"))
    free = F.greatest(F.size(F.filter(reference, lambda v: v > 0)) - 1, F.lit(0))
    chance = (free + CHANCE_DEVIATIONS * F.sqrt(2 * free)) / (8 * math.log(2))
    return NO_COMMON_PART * distance(no_common, reference), chance


def references(frame: DataFrame, name: str) -> DataFrame:
    """Per language, the summed histograms of documents that pass the base rules, and word limits."""
    own = F.col(name)
    widest = {"chars": len(_SIZES), "common": 1 + max(len(w.split()) for w in COMMON_WORDS.values())}
    usable = frame.where(~base_failed(own) & (own["n_words"] >= MIN_COMPARED_WORDS))
    sums = [F.sum(F.get(own[k], F.lit(i))).alias(f"{k}{i}") for k, n in widest.items() for i in range(n)]
    grouped = usable.groupBy(F.col("lang").alias(f"{name}_lang")).agg(*sums)
    summed = grouped.select(
        f"{name}_lang",
        *[F.array_compact(F.array(*[f"{k}{i}" for i in range(n)])).alias(f"{name}_{k}") for k, n in widest.items()],
    )
    limit, chance = word_limits(F.col(f"{name}_common"))
    return summed.withColumns({f"{name}_limit": limit, f"{name}_chance": chance})


def judge(rows: DataFrame, name: str) -> DataFrame:
    """Measured rows with distances, base_failed and kept added to the struct `name`.

    The rows are read twice, once for the references, so they should be stored.
    """
    own = F.col(name)
    joined = rows.join(references(rows, name), F.col("lang").eqNullSafe(F.col(f"{name}_lang")), "left")
    chars = F.when(own["n_words"] >= MIN_COMPARED_WORDS, distance(own["chars"], F.col(f"{name}_chars")))
    common = F.when(own["n_words"] >= MIN_COMMON_WORDS, distance(own["common"], F.col(f"{name}_common")))
    judged = joined.withColumn(
        name,
        own.withField("char_distance", chars)
        .withField("word_distance", common)
        .withField("base_failed", base_failed(own)),
    )
    by_chance = F.sqrt(F.col(f"{name}_chance") / own["n_words"])
    fewer = rest_share(own["common"]) > rest_share(F.col(f"{name}_common"))
    word_limit = F.when(fewer, F.greatest(F.col(f"{name}_limit"), by_chance))
    fits = F.coalesce(own["char_distance"] <= MAX_CHAR_DISTANCE, F.lit(True)) & F.coalesce(
        own["word_distance"] <= F.least(F.lit(MAX_WORD_DISTANCE), word_limit), F.lit(True)
    )
    return judged.withColumn(name, own.withField("kept", ~own["base_failed"] & fits)).select(
        *[F.col(f"`{c}`") for c in rows.columns]
    )


def verdicts(documents: DataFrame, name: str = "quality") -> DataFrame:
    """As `assess`, without the texts: only ids, languages and counts are written."""
    rows = measured(documents.select("doc_id", "text", "lang"), name).drop("text")
    return judge(materialize(rows, "quality"), name)


def keep(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that the rules keep, unchanged."""
    name = "quality"
    while any(c.startswith(name) for c in documents.columns):
        name += "_"
    judged = judge(materialize(measured(documents, name), "quality"), name)
    return judged.where(F.col(name)["kept"]).select(*[F.col(f"`{c}`") for c in documents.columns])
