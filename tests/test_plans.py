"""Physical plans: nothing leaves the JVM, nothing goes through one task."""

import re

import pytest

from verification.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"

# Queries that write tables are covered through the frames they are built from.
LAZY = [
    "scan_project", "chunk_limit", "chunk_row_cap", "chunk_validate", "stamp_metadata",
    "union_by_name", "filter_not_null", "length_category", "valid_article", "text_functions",
    "rounding", "group_summary", "conditional_counts", "distinct_counts", "content_diversity",
    "rollup_total", "dedup_latest", "stg_web", "stg_articles", "quality_checks",
    "quality_checks_full", "content_quality_metrics", "content_summary", "anomaly_report",
    "processing_summary", "check_not_null", "check_unique", "check_ratios", "check_pk_unique",
]


def bracket_groups(line):
    """Top-level [...] groups of a plan line."""
    groups, depth = [], 0
    for char in line:
        if char == "[":
            depth += 1
            if depth == 1:
                groups.append("")
        if depth:
            groups[-1] += char
        if char == "]":
            depth -= 1
    return groups


@pytest.mark.parametrize("name", LAZY)
def test_plan_stays_distributed(spark, plan_of, name):
    plan = plan_of(REGISTRY[name](spark, FOLDER))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas", plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    for line in plan.splitlines():
        # A window without partition columns has two groups instead of three.
        # Only the sums of ranges of files may be ordered as a whole.
        if re.search(r"\bWindow \[", line) and len(bracket_groups(line[line.index("Window [") :])) < 3:
            assert "_range" in line and "_sum" in line


@pytest.mark.parametrize("name", ["chunk_limit", "chunk_row_cap", "stamp_metadata"])
def test_chunking_moves_no_texts(spark, plan_of, name):
    """The only exchanges carry file names and row counts."""
    plan = plan_of(REGISTRY[name](spark, FOLDER))
    assert "SortMergeJoin" not in plan
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            assert "_file" in line or "_range" in line


@pytest.mark.parametrize("name", ["stg_articles", "scan_project", "quality_checks_unfiltered"])
def test_projections_do_not_shuffle(spark, plan_of, name):
    assert "Exchange" not in plan_of(REGISTRY[name](spark, FOLDER))
