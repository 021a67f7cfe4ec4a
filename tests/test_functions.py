import pytest
from pyspark.sql import functions as F

from corpusloom.functions import numeric as N
from corpusloom.functions import rules as R
from corpusloom.functions import text as X


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, expr):
    return [r[1] for r in sorted(df.select("i", expr.alias("y")).collect())]


def test_trim_strips_space_separators_only(spark):
    df = column(spark, ["　a　b  ", "\t a \n", "　 ", "", None, "a"])
    assert results(df, X.trim_spaces("x")) == ["a　b", "\t a \n", "", "", None, "a"]


def test_narrow_script_is_a_literal_class(spark):
    yes = ["の", "ひ", "カ", "漢", "abcんabc"]
    no = ["あいう", "と", "ア", "ト", "ー", "。", "abc", ""]
    assert all(results(column(spark, yes), X.has_script("x")))
    assert not any(results(column(spark, no), X.has_script("x")))
    assert results(column(spark, [None]), X.has_script("x")) == [None]


def test_full_script_and_custom_class(spark):
    df = column(spark, ["あいう", "ア", "々", "𠮷", "abc", "é"])
    assert results(df, X.has_script("x", "full")) == [True, True, True, True, False, False]
    assert results(df, X.has_script("x", "äöüé"))[-1] is True


def test_class_counts_match_python(spark):
    texts = ["の日本語 abc", "", "ーーー", "漢字\n漢字", "x" * 50 + "ん", "𠮷 が"]
    inside = lambda c: c in "ひらがカタ" or "な" <= c <= "ん" or "ナ" <= c <= "ヶ" or "一" <= c <= "龯"
    expected = [sum(inside(c) for c in t) for t in texts]
    assert results(column(spark, texts), X.count_class("x", X.script_class("narrow"))) == expected


@pytest.mark.parametrize(
    "url, domain",
    [
        ("http://a.b:80?x=1", "a.b:80?x=1"),
        ("https://h/p", "h"),
        ("httpfoo", ""),
        ("HTTP://x", None),
        (None, None),
    ],
)
def test_url_domain(spark, url, domain):
    assert results(column(spark, [url]), X.url_domain("x")) == [domain]


def test_paragraph_sections_and_preview(spark):
    df = column(spark, ["a\n\nb\n== c ==\nd\n== e", "plain"])
    assert results(df, X.first_paragraph("x")) == ["a", "plain"]
    assert results(df, X.section_count("x")) == [2, 0]
    assert results(df, X.section_count("x", r"\n==")) == [0, 0]
    assert results(df, X.preview("x", 3)) == ["a\n\n...", "pla..."]


def test_repetition_needs_four_lines(spark):
    df = column(spark, ["a\na\na", "a\na\na\na", "a\nb\nc\nd", "a\nb\nc\nc", "a\nb\na\nb"])
    assert results(df, X.line_repetition("x")) == [0, 1, 0, 0, 1]


def test_chunk_path(one):
    row = {"d": "owner/name", "c": "cfg", "i": 7, "s": 10, "e": 20}
    path = X.chunk_path(*[F.col(k) for k in row])
    bare = X.chunk_path(F.col("d"), F.lit(None).cast("string"), F.col("i"), F.col("s"), F.col("e"))
    assert one(row, path, bare) == (
        "raw/name_cfg/chunk_000007_10_20.parquet",
        "raw/name/chunk_000007_10_20.parquet",
    )


def test_upper_keeps_one_letter_per_letter(spark):
    assert results(column(spark, ["straße home"]), X.upper("x")) == ["STRAẞE HOME"]


def test_rounding_is_on_the_binary_value(spark):
    df = column(spark, [0.285, 1.005, 2.675, -0.125, None], "double")
    assert results(df, N.round_to("x", 2)) == [0.28, 1.0, 2.68, -0.13, None]


def test_division_by_zero_is_null(one):
    assert one({"a": 3, "b": 0}, N.ratio("a", "b"), N.percent("a", "b")) == (None, None)
    assert one({"a": 1, "b": 3}, N.percent("a", "b"), N.chunks_of(F.col("b"), 2)) == (33.33, 2)


def test_length_ladders(spark):
    n = column(spark, [100, 101, 1000, 1001], "long")
    assert results(n, R.length_category("x")) == ["short", "medium", "medium", "long"]
    n = column(spark, [500, 501, 2000, 2001, 10000, 10001], "long")
    assert results(n, R.article_size("x")) == [
        "stub", "standard", "standard", "detailed", "detailed", "comprehensive",
    ]


def test_article_types(spark):
    titles = ["（x disambiguation）", "東京の一覧", "カテゴリ:x", "東京", "(x disambiguation)"]
    assert results(column(spark, titles), R.article_type("x")) == [
        "disambiguation", "list", "category", "article", "article",
    ]


def test_valid_content(spark):
    texts = ["", "123456789", "1234567890", "          ", "　　　　　　　　　　　", None]
    assert results(column(spark, texts), R.valid_content(X.trim_spaces("x"))) == [
        False, False, True, False, False, False,
    ]


@pytest.mark.parametrize(
    "title, text, valid",
    [
        ("t", "x" * 49, False),
        ("t", "x" * 50, True),
        ("t", "x" * 60 + "redirect", False),
        ("t", "x" * 60 + "Redirect", True),
        ("t", "x" * 60 + "リダイレクト", False),
        ("　 ", "x" * 60, False),
        (None, "x" * 60, False),
        ("t", None, False),
    ],
)
def test_valid_article(one, title, text, valid):
    got = one({"t": title, "x": text}, R.valid_article("t", "x"), schema="t string, x string")
    assert got == (valid,)


@pytest.mark.parametrize(
    "length, ratio, score, label, kind, anomaly",
    [
        (9, 0.9, 0, "poor", "ui_element", 1),
        (10, 0.9, 90, "high", "content", 0),
        (50_000, 0.9, 90, "high", "content", 0),
        (50_001, 0.9, 10, "poor", "content", 1),
        (10, 0.09, 30, "low", "navigation", 1),
        (10, 0.1, 50, "low", "content", 1),
        (10, 0.29, 50, "low", "content", 1),
        (10, 0.3, 70, "medium", "content", 0),
        (10, 0.49, 70, "medium", "content", 0),
        (10, 0.5, 90, "high", "content", 0),
    ],
)
def test_quality_ladders(one, length, ratio, score, label, kind, anomaly):
    rules = (R.quality_score, R.quality_class, R.simple_content_type, R.simple_anomaly)
    got = one({"n": length, "r": ratio}, *[rule("n", "r") for rule in rules])
    assert got == (score, label, kind, anomaly)


def test_full_content_types(spark):
    texts = ["short", "2024年01月02日 12:00", "!!! ... ??? ---", "　ログイン　" + " " * 9, "text " * 5]
    df = column(spark, texts).withColumn("n", F.length("x"))
    assert results(df, R.full_content_type("x", "n", F.lit(0.5))) == [
        "ui_element", "date_only", "punctuation_only", "navigation", "content",
    ]


def test_navigation_words(spark):
    words = ["home", " HOME ", "ホーム", "homepage", "login now", "メニュー", None]
    assert results(column(spark, words), R.is_nav_word("x")) == [
        True, True, True, False, False, True, False,
    ]
