"""Registered queries against their SQL; set FEW_QUERIES=1 to run some only."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from gridtally.workload import catalog

#: The reference's own queries; those of the corpus operators have tests of their own.
ENGINE = catalog.QUERIES

FEW = (
    "usage_gate",
    "energy_precedence",
    "enrich_azure_focus",
    "summary_by_period",
    "tag_top_other",
    "regions_weighted",
    "recommend_region",
    "split_allocate",
    "factor_water_stress",
    "scan_csv",
)
NAMES = FEW if os.environ.get("FEW_QUERIES") else sorted(ENGINE)


@pytest.fixture(scope="module")
def con(sf_dir):
    check_oracle = pytest.importorskip("check_oracle")
    return check_oracle.database(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    from check_oracle import compare

    line = compare(spark, con, name, sf_dir)
    assert line.startswith("ok"), line


def test_every_query_has_sql():
    assert set(ENGINE) == set(catalog.ORACLE) and set(ENGINE) <= set(entry.queries())


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def largest_methods(spark, frame) -> list[int]:
    """The largest method, in bytes, of each generated stage of a plan."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(frame._jdf.queryExecution().executedPlan())
    return [stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())]


@pytest.mark.parametrize("name", ["enrich_aws", "enrich_aws_focus", "enrich_azure", "enrich_azure_focus", "summary_by_period", "overview"])
def test_generated_methods_are_compiled(spark, sf_dir, name):
    """Beyond 8,000 bytes the JVM does not compile a method; a stage then runs without generated code."""
    frame = ENGINE[name](spark, sf_dir)
    sizes = largest_methods(spark, frame) if final_plan(frame) else []
    assert sizes and max(sizes) < 8000, sizes


def test_wide_rows_are_made_in_generated_code(spark, sf_dir):
    """The last projection of a plan, which makes the result's rows, is part of a generated stage."""
    steps = [line for line in final_plan(ENGINE["enrich_aws"](spark, sf_dir)).splitlines() if " Project [" in line]
    assert "*(" in steps[0], [line[:80] for line in steps]


@pytest.mark.parametrize("name", ["tag_coverage", "region_share", "recommend_region"])
def test_reports_do_not_read_lines_again(spark, sf_dir, name):
    assert "lineitem.parquet" in final_plan(ENGINE["top_services"](spark, sf_dir))
    assert "lineitem" not in final_plan(ENGINE[name](spark, sf_dir))


def test_entry(spark, sf_dir):
    assert entry.entry(spark).limit(5).count() == 5
