"""Classification rules as CASE expressions over text, title, length and ratio."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions.text import trim_spaces, upper


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ladder(steps, default) -> Column:
    """First matching label of (condition, label) steps."""
    (condition, label), *rest = steps
    case = F.when(condition, label)
    for condition, label in rest:
        case = case.when(condition, label)
    return case.otherwise(default)


def length_category(length) -> Column:
    n = _c(length)
    return ladder([(n > V.WEB_LONG, "long"), (n > V.WEB_MEDIUM, "medium")], "short")


def article_size(length) -> Column:
    n = _c(length)
    return ladder(
        [
            (n > V.ARTICLE_COMPREHENSIVE, "comprehensive"),
            (n > V.ARTICLE_DETAILED, "detailed"),
            (n > V.ARTICLE_STANDARD, "standard"),
        ],
        "stub",
    )


def article_type(title) -> Column:
    t = _c(title)
    return ladder(
        [
            (t.like("%（%disambiguation%）"), "disambiguation"),
            (t.like("%の一覧"), "list"),
            (t.like("カテゴリ:%"), "category"),
        ],
        "article",
    )


def valid_content(trimmed) -> Column:
    """Web text is valid from ten characters on; NULL and blank texts are not."""
    return F.coalesce(F.length(_c(trimmed)) >= V.TOO_SHORT, F.lit(False))


def valid_article(title, text) -> Column:
    """Needs a title, fifty characters of text, and no redirect marker."""
    raw = _c(text)
    redirect = reduce(or_, [raw.contains(word) for word in V.REDIRECT_WORDS])
    good = (
        (F.length(trim_spaces(raw)) >= V.ARTICLE_MIN)
        & (trim_spaces(_c(title)) != "")
        & ~redirect
    )
    return F.coalesce(good, F.lit(False))


def quality_score(length, ratio) -> Column:
    n, r = _c(length), _c(ratio)
    return ladder(
        [
            (n < V.TOO_SHORT, 0),
            (n > V.TOO_LONG, 10),
            (r < 0.1, 30),
            (r < 0.3, 50),
            (r < 0.5, 70),
        ],
        90,
    )


def quality_class(length, ratio) -> Column:
    n, r = _c(length), _c(ratio)
    return ladder(
        [
            ((n < V.TOO_SHORT) | (n > V.TOO_LONG), "poor"),
            (r < 0.3, "low"),
            (r < 0.5, "medium"),
        ],
        "high",
    )


def simple_content_type(length, ratio) -> Column:
    return ladder(
        [(_c(length) < V.TOO_SHORT, "ui_element"), (_c(ratio) < 0.1, "navigation")], "content"
    )


def simple_anomaly(length, ratio) -> Column:
    n, r = _c(length), _c(ratio)
    return F.when((n < V.TOO_SHORT) | (n > V.TOO_LONG) | (r < 0.3), 1).otherwise(0)


def is_nav_word(text) -> Column:
    """Whether a text is nothing but a navigation word. Longer texts are not
    even upper-cased."""
    word = trim_spaces(_c(text))
    short = F.length(word) <= max(len(w) for w in V.NAV_WORDS)
    return F.when(short, upper(word).isin(*V.NAV_WORDS)).otherwise(F.lit(False))


def made_of(text, char_class: str) -> Column:
    """Whether a text consists of characters of a regex class body, at least one. The first
    one is looked at alone before the whole text is."""
    t = _c(text)
    return F.left(t, F.lit(1)).rlike(f"^[{char_class}]") & t.rlike(rf"^[{char_class}]+\z")


def full_content_type(text, length, ratio, nav_word=None) -> Column:
    """`nav_word` names a column that tells whether the text is a navigation word, if there
    is one."""
    t = _c(text)
    return ladder(
        [
            (_c(length) < V.TOO_SHORT, "ui_element"),
            (made_of(t, r"0-9年月日/.:\- "), "date_only"),
            (made_of(t, r"\p{P}\p{S} "), "punctuation_only"),
            ((is_nav_word(t) if nav_word is None else _c(nav_word)) | (_c(ratio) < 0.1), "navigation"),
        ],
        "content",
    )


def full_anomaly(too_short, too_long, encoding, content_type, ratio, repetition) -> Column:
    cause = (
        (_c(too_short) == 1)
        | (_c(too_long) == 1)
        | (_c(encoding) == 1)
        | (_c(content_type) != "content")
        | (_c(ratio) < 0.3)
        | (_c(repetition) == 1)
    )
    return F.when(cause, 1).otherwise(0)


def quality_tier(score) -> Column:
    s = _c(score)
    return ladder([(s >= 80, "high"), (s >= 60, "medium"), (s >= 40, "low")], "poor")


def quality_assessment(high_pct) -> Column:
    p = _c(high_pct)
    return ladder([(p >= 70, "Excellent"), (p >= 50, "Good"), (p >= 30, "Fair")], "Poor")


def quality_recommendation(anomaly_pct, poor_pct, mean_ratio, content_pct) -> Column:
    return ladder(
        [
            (_c(anomaly_pct) > 30, "High anomaly rate - Review data sources"),
            (_c(poor_pct) > 20, "High poor quality rate - Enhance filtering"),
            (_c(mean_ratio) < 0.5, "Low Japanese content - Review language detection"),
            (_c(content_pct) < 80, "High non-content ratio - Improve content extraction"),
        ],
        "Data quality is acceptable",
    )


def run_assessment(score) -> Column:
    s = _c(score)
    return ladder(
        [(s >= 0.9, "excellent"), (s >= 0.8, "good"), (s >= 0.7, "acceptable")],
        "needs_improvement",
    )


def run_recommendation(web_anomaly_pct, article_anomaly_pct, reliability) -> Column:
    return ladder(
        [
            (_c(web_anomaly_pct) > 20, "review_fineweb_filtering"),
            (_c(article_anomaly_pct) > 10, "review_wikipedia_filtering"),
            (_c(reliability) == "mock_analysis_only", "implement_real_analysis"),
        ],
        "monitoring_recommended",
    )
