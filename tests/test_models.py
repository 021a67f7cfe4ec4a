import statistics

import pytest
from pyspark.sql import functions as F

from corpusloom import values as V
from corpusloom.functions import rules as R
from corpusloom.functions import text as X
from corpusloom.operators import aggregates as A
from corpusloom.operators import sketches
from corpusloom.plans import checks as K
from corpusloom.plans import marts, quality, staging
from corpusloom.sources import fields as S
from corpusloom.sources.workdir import materialize
from verification import queries as Q

FOLDER = "/root/testdata/sf0.001"
RUN = "2024-02-01 00:00:00"
JP = "日本の文章"


def web_frame(spark, rows):
    """(text, url, extracted second) rows as a raw web table."""
    data = [(t, u, None, V.WEB_DATASET, s, V.SOURCE_TABLE) for t, u, s in rows]
    df = spark.createDataFrame(
        data,
        "text string, url string, timestamp timestamp_ntz, _meta_dataset_name string, "
        "s long, _dbt_source_table string",
    )
    stamp = F.lit("2024-01-30").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s").cast("decimal(18,6)"))
    return df.withColumn("_dbt_extracted_at", stamp).select(*S.RAW_WEB.fieldNames(), "s")


def test_web_staging(spark):
    raw = web_frame(
        spark,
        [
            ("　" + JP * 3 + " ", "http://a.b/c", 1),
            ("　" + JP * 3 + " ", "http://a.b/c", 2),
            (JP * 3, None, 1),
            (JP, "http://a.b/short", 1),
            ("only latin letters here", "http://a.b/latin", 1),
            (None, "http://a.b/null", 1),
        ],
    )
    got = staging.stg_web(raw, "b", RUN, keep=("s",)).orderBy("source_url").collect()
    assert [(r["source_url"], r["s"], r["url_domain"]) for r in got] == [
        ("http://a.b/c", 2, "a.b"), ("unknown", 1, None),
    ]
    assert got[0]["content_text"] == JP * 3 and got[0]["content_length"] == 15
    assert all(r["row_rank"] == 1 and r["dbt_batch_id"] == "b" for r in got)


def test_filter_before_dedup_changes_nothing(spark):
    raw = Q.raw_web(spark, FOLDER)
    early = Q.web(spark, FOLDER)
    from corpusloom.operators.dedup import dedup_latest

    late = staging.clean_web(
        dedup_latest(raw, "text", "url", [F.col("_dbt_extracted_at").desc(), F.col("_row_key").desc()])
    ).filter("is_valid_content AND contains_japanese_chars")
    columns = late.columns
    assert early.select(*columns).exceptAll(late).count() == 0
    assert late.exceptAll(early.select(*columns)).count() == 0


def test_scan_reads_only_needed_columns(spark, plan_of):
    plan = plan_of(Q.scan_project(spark, FOLDER).select("id", "title"))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan


def test_raw_tables_push_not_null_to_the_scan(spark, plan_of):
    path = Q.fresh_dir(spark, "raw")
    Q.raw_articles(spark, FOLDER).write.parquet(path)
    plan = plan_of(staging.stg_articles(spark.read.parquet(path), "b", RUN))
    pushed = plan[plan.index("PushedFilters") :]
    assert all(f"IsNotNull({c})" in pushed for c in ("id", "title", "text"))
    assert "Exchange" not in plan


def test_medians_match_brute_force_on_skewed_values(spark):
    """Half of the rows share one value; groups are odd, even, tiny and NULL."""
    import random

    rng = random.Random(1)
    groups = {
        "hot": [0.25] * 500 + [rng.random() for _ in range(501)],
        "even": [rng.random() for _ in range(1000)],
        "two": [0.1, 0.9],
        "one": [0.5],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, japanese_ratio double")
    hist = materialize(A.histogram(df, "g", "japanese_ratio"), "hist")
    measures = marts.median_measures("median_japanese_ratio")
    got = {r["g"]: r[1] for r in A.exact_medians(hist, ["g"], measures).collect()}
    assert got == {g: pytest.approx(statistics.median(xs), abs=1e-12) for g, xs in groups.items()}


def test_distinct_per_group(spark):
    rows = [("a", 1), ("a", 2), (None, 2), ("b", 2)]
    df = spark.createDataFrame(rows, "x string, y long")
    assert tuple(A.distinct_per_group(df, "x", "y").first()) == (4, 2, 2)
    assert A.uniqueness_deficit(df, "y").first()[0] == 2


def test_measured_ratios_add_up(spark):
    text = "漢字かな ABC! " + JP
    df = spark.createDataFrame([(text, len(text))], "t string, n long")
    row = quality.measure(df, "t", "n", "full").first()
    n = len(text)
    assert row["total_japanese_chars"] == 9
    assert row["japanese_ratio"] == pytest.approx(9 / n)
    assert row["ascii_ratio"] == pytest.approx(6 / n)
    assert row["whitespace_ratio"] == pytest.approx(2 / n)
    assert row["symbol_ratio"] == pytest.approx(1 / n)


@pytest.mark.parametrize("full", [False, True])
def test_summary_totals(spark, full):
    records = Q.measured(spark, FOLDER) if full else quality.quality_checks(*Q.both(spark, FOLDER))
    rows = marts.dataset_quality_summary(records, RUN).collect()
    assert [r["dataset_name"] for r in rows] == [V.WEB_DATASET, V.ARTICLE_DATASET, "TOTAL"]
    assert rows[2]["total_records"] == rows[0]["total_records"] + rows[1]["total_records"]
    assert rows[2]["median_text_length"] is None and rows[0]["median_text_length"] > 0
    for r in rows:
        classes = sum(r[f"{c}_quality_pct"] for c in ("high", "medium", "low", "poor"))
        assert abs(classes - 100) <= 0.05
    if not full:
        assert rows[0]["repetition_pct"] == 0.0 and rows[2]["unique_chunks"] == 2


def test_empty_input(spark):
    web, articles = Q.both(spark, FOLDER)
    web, articles = web.filter("false"), articles.filter("false")
    summary = marts.dataset_quality_summary(quality.quality_checks(web, articles), RUN).collect()
    assert [(r["dataset_name"], r["total_records"], r["high_quality_pct"]) for r in summary] == [
        ("TOTAL", None, None),
    ]
    rows = {r["source_type"]: r for r in marts.content_summary(web, articles, "b", RUN).collect()}
    assert rows["fineweb"]["total_records"] == rows["wikipedia"]["total_records"] == 0
    assert rows["fineweb"]["short_content_pct"] is None
    report = quality.quality_report(quality.anomaly_report(quality.quality_checks(web, articles)))
    assert tuple(report.first()) == (0, 0, 0, 0.0)
    default = marts.processing_summary(
        quality.anomaly_report(quality.quality_checks(web, articles)), "b", RUN
    ).first()
    assert default["analysis_reliability"] == "mock_analysis_only"
    assert default["processing_recommendation"] == "implement_real_analysis"
    assert default["fineweb_analysis_method"] == "not_available"


def anomaly_rows(spark, web, article):
    data = [(V.WEB_DATASET, 20, *web), (V.ARTICLE_DATASET, 10, *article)]
    return spark.createDataFrame(
        data,
        "dataset_name string, total_records long, avg_japanese_ratio double, "
        "overall_anomaly_rate double, analysis_method string, mock_mode boolean",
    )


@pytest.mark.parametrize(
    "web, article, score, assessment, advice, reliability",
    [
        ((0.9, 0.3, "m", False), (1.0, 0.0, "m", False), 0.93, "excellent", "review_fineweb_filtering", "full_real_analysis"),
        ((0.8, 0.1, "m", False), (0.8, 0.2, "m", True), 0.81, "good", "review_wikipedia_filtering", "partial_real_analysis"),
        ((0.7, 0.1, "m", True), (0.7, 0.1, "m", True), 0.74, "acceptable", "implement_real_analysis", "mock_analysis_only"),
        ((0.1, 0.0, "m", False), (0.1, 0.0, "m", False), 0.28, "needs_improvement", "monitoring_recommended", "full_real_analysis"),
    ],
)
def test_processing_summary(spark, web, article, score, assessment, advice, reliability):
    row = marts.processing_summary(anomaly_rows(spark, web, article), "b", RUN).first()
    assert row["overall_quality_score"] == score
    assert row["quality_assessment"] == assessment
    assert row["processing_recommendation"] == advice
    assert row["analysis_reliability"] == reliability
    assert row["total_records_analyzed"] == 30


# ---- data tests on broken rows --------------------------------------------

GOOD = {
    "text_length": 100, "total_japanese_chars": 60, "japanese_ratio": 0.6, "ascii_ratio": 0.2,
    "symbol_ratio": 0.1, "whitespace_ratio": 0.1, "is_too_short": 0, "is_too_long": 0,
    "has_encoding_issues": 0, "has_repetition": 0, "has_replacement_char": False,
    "is_nav_word": False, "quality_score": 90, "quality_class": "high", "content_type": "content",
    "is_anomaly": 0,
}
KINDS = {bool: "boolean", int: "long", float: "double", str: "string"}


def records(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    schema = ", ".join(f"{k} {KINDS[type(v)]}" for k, v in GOOD.items())
    return spark.createDataFrame([tuple(r[k] for k in GOOD) for r in rows], schema)


@pytest.mark.parametrize(
    "rule, changes, failing",
    [
        (K.high_quality_ratio, [{"japanese_ratio": 0.49}, {"japanese_ratio": 0.5}], 1),
        (K.content_type_rule, [{"is_nav_word": True}, {}], 1),
        (K.encoding_rule, [{"has_replacement_char": True}, {"has_replacement_char": True, "has_encoding_issues": 1}], 1),
        (
            K.score_band_rule,
            [
                {"quality_score": 69}, {"quality_score": 70},
                {"quality_class": "medium", "quality_score": 90},
                {"quality_class": "medium", "quality_score": 89},
                {"quality_class": "low", "quality_score": 70},
                {"quality_class": "low", "quality_score": 29},
                {"quality_class": "poor", "quality_score": 50},
                {"quality_class": "poor", "quality_score": 49},
            ],
            5,
        ),
        (K.length_flags_rule, [{"is_too_short": 1}, {"is_too_long": 1}, {"is_too_short": 1, "text_length": 9}], 2),
        (K.char_count_rule, [{"total_japanese_chars": 101}, {"total_japanese_chars": 100}], 1),
        (K.ratios_rule, [{"symbol_ratio": 1.1}, {"ascii_ratio": -0.1}, {"whitespace_ratio": 1.0}], 2),
        (K.anomaly_flag_rule, [{"is_anomaly": 1}, {"has_repetition": 1}, {"has_repetition": 1, "is_anomaly": 1}], 2),
        (K.score_range_rule, [{"quality_score": 101}, {"quality_score": 0}], 1),
    ],
)
def test_record_rules(spark, rule, changes, failing):
    row = K.run_rules(records(spark, *changes), [rule()]).first()
    assert row["failing_records"] == failing


def test_record_rules_take_one_pass(spark, plan_of):
    plan = plan_of(K.run_rules(records(spark, {}), K.record_rules()))
    assert plan.count("Exchange") == 1


def summary_rows(spark, *rows):
    names = [
        "dataset_name", "total_records", "high_quality_pct", "medium_quality_pct", "low_quality_pct",
        "poor_quality_pct", "anomaly_rate_pct", "avg_japanese_ratio", "avg_quality_score",
    ]
    schema = "dataset_name string, total_records long, " + ", ".join(f"{n} double" for n in names[2:])
    return spark.createDataFrame(rows, schema)


def test_summary_completeness_and_totals(spark):
    good = (V.WEB_DATASET, 3, 100.0, 0.0, 0.0, 0.0, 0.0, 0.5, 90.0)
    bad = ("x", 0, 100.0, 10.0, 0.0, 0.0, 101.0, 1.5, 101.0)
    total = ("TOTAL", 3, 100.0, 0.0, 0.0, 0.0, 0.0, 0.5, 90.0)
    df = summary_rows(spark, good, bad, total)
    assert K.run_rules(df, [K.summary_rule()]).first()["failing_records"] == 1
    assert K.completeness(df, [V.WEB_DATASET, V.ARTICLE_DATASET]).first()["failing_records"] == 1
    assert K.total_consistency(spark.range(3), df).first()["failing_records"] == 0
    assert K.total_consistency(spark.range(4), df).first()["failing_records"] == 1


def test_generic_checks(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (None, " "), (2, None), (None, "z")], "k long, v string"
    )
    rules = (
        K.not_null_rules("m", ["k", "v"])
        + K.accepted_rules("m", {"v": ("a", "b")})
        + K.range_rules("m", {"k": (2, 3)})
        + [K.not_empty_rule("m", "v")]
    )
    got = {r["test_name"]: r["failing_records"] for r in K.run_rules(df, rules).collect()}
    assert got == {
        "not_null_m_k": 2, "not_null_m_v": 1, "accepted_values_m_v": 2,
        "accepted_range_m_k": 2, "not_empty_m_v": 1,
    }
    assert K.unique(df, "m", "k").first()["failing_records"] == 1
    missing = {r["column_name"]: r["missing"] for r in K.required_columns(df, ["k", "zz"]).collect()}
    assert missing == {"k": 0, "zz": 1}
    assert K.missing_columns(df, ["k", "zz"]).first()["failing_records"] == 1


def test_types_and_primary_key(spark):
    web = spark.createDataFrame([(1,)], "content_length long")
    assert K.type_consistency(web, spark.createDataFrame([(1,)], "text_length long")).first()[1] == 0
    assert K.type_consistency(web, spark.createDataFrame([(1,)], "text_length int")).first()[1] == 1
    ids = spark.createDataFrame([("a",), ("a",), ("b",)], "article_id string")
    assert K.primary_key(ids).first()["failing_records"] == 1


def test_freshness_and_failures(spark):
    raw = web_frame(spark, [(JP * 3, "u", 0), (JP * 3, "v", 60)])
    web = staging.stg_web(raw, "b", RUN)
    checks = K.graded(K.run_rules(web, K.web_rules("2024-02-06 00:00:30")))
    failed = K.failures(checks).collect()
    assert [(r["test_name"], r["failing_records"], r["status"]) for r in failed] == [
        ("data_freshness_fineweb", 1, "warn"),
    ]


def test_example_models_fail_not_null_once(spark):
    got = {r["test_name"]: r["failing_records"] for r in Q.example_models(spark, FOLDER).collect()}
    assert got["not_null_first_model_id"] == 1 and got["not_null_second_model_id"] == 0


def test_sketches_merge_over_chunks(spark):
    """Estimates over merged chunks hold their stated errors, with a hot value and NULLs."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("word"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 7919) % 40_009).alias("size"),
        (F.col("id") % 8).alias("chunk"), F.lit("d").alias("dataset"),
    )
    stored = sketches.chunk_sketches(rows, ["dataset", "chunk"], ["word"], ["size"])
    halves = [sketches.merged_sketches(stored.where(f"chunk % 2 = {k}"), ["dataset"]).drop("chunks") for k in (0, 1)]
    both = sketches.merged_sketches(halves[0].unionByName(halves[1]), ["dataset"])
    found = both.select(
        "records", sketches.distinct_estimate("word"), *[sketches.quantile_estimate("size", q) for q in (0.1, 0.5, 0.99)]
    ).first()
    exact = rows.agg(F.count_distinct("word"), F.count("size")).first()
    assert found[0] == 40_000 and abs(found[1] - exact[0]) <= 4 * sketches.DISTINCT_ERROR * exact[0]
    for share, at in zip((0.1, 0.5, 0.99), found[2:], strict=True):
        assert abs(rows.where(F.col("size") <= at).count() / exact[1] - share) <= 2 * sketches.RANK_ERROR


def test_total_medians_and_bounded_exchanges(spark, plan_of):
    """The summary shuffles datasets, chunks and cells, never a record's values; a total
    median is that of all records."""
    records = materialize(Q.measured(spark, FOLDER), "records")
    rows = {r["dataset_name"]: r for r in marts.dataset_quality_summary(records, RUN, stored=True, total_medians=True).collect()}
    lengths = [r[0] for r in records.select("text_length").collect()]
    assert rows["TOTAL"]["median_text_length"] == statistics.median(lengths)
    plain = {r["dataset_name"]: r for r in marts.dataset_quality_summary(records, RUN).collect()}
    assert plain["TOTAL"]["median_text_length"] is None
    assert plain[V.WEB_DATASET]["median_text_length"] == rows[V.WEB_DATASET]["median_text_length"]
    plan = plan_of(marts._dataset_level(marts._narrow(records)))
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert moved and all("dataset_name" in x and "text_length" not in x for x in moved)


def test_character_counts_equal_plain_ones(spark):
    texts = ["", "abc DEF 123", JP + "　x\ty\n", "—“q” §1 € ½ ٣ ǅ é e\u0301 😀!", "。、「」・ー々〆 ｱｲ\u3000\u3000", "A\r\n\r\nB ..."]
    df = spark.createDataFrame([(t, len(t)) for t in texts], "t string, n int")
    for script in ("narrow", "full", "a-f"):
        got = quality.with_character_counts(df, "t", "n", script)
        plain = got.filter(
            (F.col("total_japanese_chars") != X.count_class(F.col("t"), X.script_class(script)))
            | (F.col("_ascii") != X.count_class(F.col("t"), r"\x00-\x7F"))
            | (F.col("_space") != X.count_class(F.col("t"), r" \t\r\n\u3000"))
            | (F.col("_symbol") != X.count_class(F.col("t"), r"\p{P}\p{S}"))
        )
        assert plain.count() == 0


def test_summary_columns_need_no_symbols(spark, plan_of):
    """Records for the summary and its total are written without counting what it does not read."""
    records = Q.measured(spark, FOLDER)
    assert r"\p{S}]]++" in plan_of(records)
    plan = plan_of(records.select(*marts.summary_columns(records)))
    assert r"\p{S}]]++" not in plan and "japanese_ratio" in plan
    written = []
    real = Q.materialize
    Q.materialize = lambda df, name: (written.append(df.columns), real(df, name))[1]
    try:
        (row,) = Q.check_total_consistency(spark, FOLDER).collect()
    finally:
        Q.materialize = real
    assert row["failing_records"] == 0 and "symbol_ratio" not in written[0]


def test_content_types_look_at_the_first_character(spark):
    texts = ["", " ", "2024年1月", "2024x", "x2024", "--- !", "-a", "a-", "+1", "日本", "。、😀", "é", "HOME", "1\n", "\n1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for body in (r"0-9年月日/.:\- ", r"\p{P}\p{S} "):
        pairs = df.select(R.made_of("t", body).alias("a"), F.col("t").rlike(rf"^[{body}]+\z").alias("b")).collect()
        assert all(r["a"] == r["b"] for r in pairs) and any(r["a"] for r in pairs)
