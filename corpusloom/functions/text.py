"""Text expressions. All are built-in, code-generated Spark expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.values import SCRIPTS

# Unicode space separators (category Zs). Tabs and newlines are not among them.
SPACE_SEPARATORS = "".join(
    chr(c) for c in (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
)

REPLACEMENT_CHAR = "�"


def trim_spaces(col) -> Column:
    """Strip every Unicode space separator from both ends.

    `btrim` walks in from the ends, so its cost is linear. An anchored regex is
    quadratic on long inner runs of spaces.
    """
    return F.btrim(col, F.lit(SPACE_SEPARATORS))


def length_of(col) -> Column:
    return F.length(col).cast("long")


# No preset script has a character below this one. Testing one range first
# lets Latin text pass without walking the whole class.
SCRIPT_FLOOR = "\u2e80"


def script_class(script: str) -> str:
    """Body of a regex character class for a preset name, or the given class."""
    if script not in SCRIPTS:
        return script
    return rf"{SCRIPT_FLOOR}-\x{{10FFFF}}&&[{SCRIPTS[script]}]"


def has_script(col, script: str = "narrow") -> Column:
    """Whether the text holds a character of the script; NULL for a NULL text."""
    return (F.col(col) if isinstance(col, str) else col).rlike(f"[{script_class(script)}]")


def count_class(col, char_class: str) -> Column:
    """Number of characters inside a regex class body."""
    return length_of(F.regexp_replace(col, f"[^{char_class}]++", ""))


def without(col, char_class: str) -> Column:
    """The text without the characters of a regex class body, taken out run by run."""
    return F.regexp_replace(col, f"[{char_class}]++", "")


def url_domain(col) -> Column:
    """Host part (with port) of an http(s) address; NULL for other schemes."""
    url = F.col(col) if isinstance(col, str) else col
    return F.when(url.like("http%"), F.regexp_extract(url, r"https?://([^/]+)", 1))


def upper(col) -> Column:
    """Upper case, character by character: a sharp s stays one letter."""
    return F.upper(F.translate(col, "ß", "ẞ"))


def first_paragraph(col, separator: str = "\n\n") -> Column:
    return F.split_part(col, F.lit(separator), F.lit(1))


def section_count(col, marker: str = "\n==") -> Column:
    """Occurrences of a heading marker."""
    without = F.replace(col, F.lit(marker), F.lit(""))
    return F.floor((F.length(col) - F.length(without)) / F.lit(len(marker))).cast("long")


def preview(col, width: int = 80) -> Column:
    return F.concat(F.left(col, F.lit(width)), F.lit("..."))


def line_repetition(col, min_lines: int = 4, ratio: float = 0.7) -> Column:
    """1 when a text of enough lines has too few distinct ones, else 0. A text with fewer
    line breaks than that is not cut into lines."""
    text = F.col(col) if isinstance(col, str) else col
    lines = F.split(text, "\n")
    enough = F.substring_index(text, "\n", min_lines - 1) != text
    repeated = F.size(F.array_distinct(lines)) / F.size(lines) < ratio
    return F.when(enough, F.when(repeated, 1).otherwise(0)).otherwise(0)


def last_segment(col) -> Column:
    """Part of a name after its last slash."""
    return F.substring_index(col, "/", -1)


def chunk_path(dataset, config, index, start, end, prefix: str = "raw") -> Column:
    """Object path of one chunk, for example raw/name_config/chunk_000001_10_20.parquet."""
    suffix = F.when(F.coalesce(config, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit("_"), config)
    )
    return F.concat(
        F.lit(prefix + "/"),
        last_segment(dataset),
        suffix,
        F.format_string("/chunk_%06d_%d_%d.parquet", index, start, end),
    )


def digest(col) -> Column:
    """256-bit content key: grouping on it keeps long texts out of sort keys."""
    return F.sha2(col, 256)
