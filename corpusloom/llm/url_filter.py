"""URL filter: host and path rules, and a character language-model ratio beyond them.

URLs that a rule decides are the training data: variable-order Markov models of the
characters of accepted and of rejected URLs, up to three characters of context, smoothed
by interpolation with the shorter contexts (a context weighs by how many different
characters follow it). A URL without a rule is judged by the difference of its
log-likelihoods under both models, divided by its length and calibrated to a probability
by logistic regression on held-out hosts.

Characters are lower-cased and mapped to a fixed alphabet, so a model has at most
`SYMBOLS ** 4` numbers whatever the corpus holds: counts are summed over all labelled
URLs by Spark, and only this bounded table reaches the driver and the executors.

Defined results: a null URL, or one without `://`, has empty host and path and fits no
rule; a URL without characters has ratio 0; without labelled URLs of both kinds, all URLs
beyond the rules are allowed. Of equally long rules that fit, blocking wins. Repeated
rows are judged one by one. Only page_id and url are read, so other columns cannot clash.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytesets import LOWER, slices, text_bytes
from corpusloom.sources.workdir import materialize

# The rules in force, as (host and path, verdict).
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

# The start of a URL, then these characters, then all others as one.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%:#~+"
START, OTHER = 0, len(ALPHABET) + 1
SYMBOLS = len(ALPHABET) + 2
ORDER = 3
# One host in so many is held out for the calibration.
HELD_OUT = 5
# Cells that ratios are counted in for the calibration, and the range they cover.
CELLS, RANGE = 2_000, 5.0

_SYMBOL = np.full(256, OTHER, np.int64)
_SYMBOL[list(ALPHABET.encode())] = np.arange(1, len(ALPHABET) + 1)
_SYMBOL = _SYMBOL[LOWER]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(host, F.lit("")), upper, upper.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, and the longest rule that fits with its verdict.

    `rules` is a short list, written into the plan; a rule is a host and a path.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    rows = rows.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later conditions are asked first, so the list runs from short to long.
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):
        host, slash, path = text.partition("/")
        own = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = own & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rows.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def symbols(urls) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all URLs, each behind `ORDER` start symbols, and where each begins."""
    data, offsets = text_bytes(urls)
    shifted = offsets + ORDER * np.arange(len(offsets))
    out = np.zeros(len(data) + ORDER * (len(offsets) - 1), np.int64)
    out[np.arange(len(data)) + ORDER * (1 + np.searchsorted(offsets, np.arange(len(data)), "right") - 1)] = _SYMBOL[data]
    return out, shifted


def grams(urls) -> tuple[np.ndarray, np.ndarray]:
    """The number of each symbol with its context, and the URL that it stands in."""
    symbol, bounds = symbols(urls)
    place = np.arange(len(symbol))
    owner = np.searchsorted(bounds, place, "right") - 1
    inside = place - bounds[owner] >= ORDER
    place, owner = place[inside], owner[inside]
    code = np.zeros(len(place), np.int64)
    for back in range(ORDER, -1, -1):
        code = code * SYMBOLS + symbol[place - back]
    return code, owner


def gram_counts(labelled: DataFrame) -> DataFrame:
    """`accepted`, `code` and `n` over all rows (`url`, `accepted`); summed per task first."""

    def counted(batches):
        totals = [np.zeros(SYMBOLS ** (ORDER + 1), np.int32) for _ in range(2)]
        for batch in batches:
            for part in slices(batch, "url"):
                code, owner = grams(part.column("url"))
                accepted = np.asarray(part.column("accepted").cast(pa.int8()))[owner]
                for kind in range(2):
                    codes, n = np.unique(code[accepted == kind], return_counts=True)
                    totals[kind][codes] += n.astype(np.int32)
        for kind, total in enumerate(totals):
            codes = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(codes), kind == 1)), pa.array(codes), pa.array(total[codes].astype(np.int64))],
                ["accepted", "code", "n"],
            )

    parts = labelled.select("url", "accepted").mapInArrow(counted, "accepted boolean, code long, n long")
    return parts.groupBy("accepted", "code").agg(F.sum("n").alias("n"))


def log_likelihoods(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log probability of every symbol after every context, from gram counts."""
    full = np.zeros(SYMBOLS ** (ORDER + 1), np.float64)
    full[codes] = counts
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for order in range(ORDER + 1):
        own = full.reshape(-1, SYMBOLS ** (order + 1)).sum(axis=0).reshape(-1, SYMBOLS)
        shorter = np.tile(p.reshape(-1, SYMBOLS), (len(own) // max(1, p.size // SYMBOLS), 1))
        followers = (own > 0).sum(axis=1, keepdims=True)
        total = own.sum(axis=1, keepdims=True)
        weight = np.where(total > 0, followers, 1.0)
        p = ((own + weight * shorter) / (total + weight)).ravel()
    return np.log(p)


@dataclass
class Model:
    """Log-likelihood ratio of each gram, and the calibration of the mean ratio."""

    ratios: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def score(self, urls) -> np.ndarray:
        """The mean log-likelihood difference of each URL."""
        code, owner = grams(urls)
        sums = np.bincount(owner, self.ratios[code], len(urls))
        return sums / np.maximum(1, np.bincount(owner, minlength=len(urls)))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """`rows` and `ratio`, the mean log-likelihood difference of `url`."""
    shared = rows.sparkSession.sparkContext.broadcast(model.ratios)

    def score(batches):
        own = Model(shared.value)
        for batch in batches:
            for part in slices(batch, "url"):
                yield part.append_column("ratio", pa.array(own.score(part.column("url"))))

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(score, f"{fields}, ratio double")


def calibrated(cells: list[tuple[bool, int, int]]) -> tuple[float, float]:
    """Slope and offset of a logistic regression on counted cells; both kinds weigh alike."""
    x = np.array([(cell + 0.5) / CELLS * 2 * RANGE - RANGE for _, cell, _ in cells])
    y = np.array([float(kind) for kind, _, _ in cells])
    n = np.array([float(count) for _, _, count in cells])
    n = np.where(y == 1, n / max(n[y == 1].sum(), 1), n / max(n[y == 0].sum(), 1))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = n * p * (1 - p)
        gradient = np.array([(n * (y - p) * x).sum() - 1e-3 * slope, (n * (y - p)).sum() - 1e-3 * offset])
        hessian = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope + np.clip(step[0], -5, 5), offset + np.clip(step[1], -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def fitted(labelled: DataFrame) -> Model | None:
    """A model from rows (`url`, `host`, `accepted`), or None if a kind is missing."""
    held = F.pmod(F.xxhash64("host"), F.lit(HELD_OUT)) == 0

    def model_of(rows):
        counts = gram_counts(rows).toPandas()
        sides = [counts[counts.accepted == kind] for kind in (True, False)]
        if any(side.empty for side in sides):
            return None
        good, bad = (log_likelihoods(s.code.to_numpy(), s.n.to_numpy()) for s in sides)
        return Model((good - bad).astype(np.float32))

    model = model_of(labelled.where(~held))
    if model is not None:
        cell = F.floor((F.col("ratio") + RANGE) / (2 * RANGE) * CELLS)
        cell = F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), cell)).alias("cell")
        rows = scored(labelled.where(held).select("url", "accepted"), model).groupBy("accepted", cell).count().collect()
        if len({r[0] for r in rows}) == 2:
            model.slope, model.offset = calibrated([tuple(r) for r in rows])
        return model
    return model_of(labelled)


def verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """Every row with host, path, rule, verdict, ratio and the calibrated probability
    that its URL is acceptable (both null where no model could be made)."""
    rows = materialize(ruled(pages, rules), "urls")
    labelled = rows.where("rule_verdict is not null").withColumn("accepted", F.col("rule_verdict") == "allow")
    model = fitted(labelled.select("url", "host", "accepted"))
    if model is None:
        judged = rows.withColumns({k: F.lit(None).cast("double") for k in ("ratio", "p_accept")})
    else:
        chance = 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("ratio") + F.lit(model.offset))))
        judged = scored(rows, model).withColumn("p_accept", chance)
    own = F.when(F.col("p_accept") < 0.5, "block").otherwise("allow")
    verdict = F.coalesce("rule_verdict", own).alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "ratio", "p_accept")
