"""Where the columns that a plan reads come from, told before the plan runs.

The steps of a plan are nodes; a column that a step reads is an edge from the last
step before it that adds that column, or from the input. So for any number of landed
reports, each to be enriched by one plan, all contracts are one join: reports meet the
edges of their plan, and an edge without a provider is a breach.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.factors.tables import values_frame
from gridtally.plans.pipelines import Plan

INPUT = "(input)"


def step_columns(spark: SparkSession, plans: Mapping[str, Plan]) -> tuple[DataFrame, DataFrame]:
    """Columns that steps read (plan, step_no, step, needed) and add (plan, step_no, step, added)."""
    needs, adds = [], []
    for name, plan in plans.items():
        for number, (operator, _) in enumerate(plan.steps):
            # A step that changes what is there reads nothing it did not state.
            needs += [(name, number, operator.name, c) for c in operator.needs(plan.provider, plan.layout)]
            adds += [(name, number, operator.name, c) for c in operator.adds]
    return (
        values_frame(spark, needs, "plan string, step_no int, step string, needed string"),
        values_frame(spark, adds, "plan string, step_no int, step string, added string"),
    )


def lineage(spark: SparkSession, plans: Mapping[str, Plan]) -> DataFrame:
    """(plan, step_no, step, needed, added_by): the last earlier step that adds a column, else NULL."""
    needs, adds = step_columns(spark, plans)
    earlier = adds.select("plan", F.col("step_no").alias("_no"), F.col("step").alias("_step"), F.col("added").alias("needed"))
    joined = needs.join(earlier, ["plan", "needed"], "left")
    added_by = F.max(F.when(F.col("_no") < F.col("step_no"), F.struct("_no", "_step")))
    return joined.groupBy("plan", "step_no", "step", "needed").agg(added_by["_step"].alias("added_by"))


def contracts(reports: DataFrame, plans: Mapping[str, Plan]) -> DataFrame:
    """One row for each column that a step of a report's plan reads, with its provider.

    ``reports`` has ``plan``, and ``columns`` with the names the report holds; its other
    columns are kept. ``provider`` is a step, the input, or NULL where there is none,
    and then ``missing`` is true. A report of an unknown plan has one row, without a step.
    The edges are as many as the plans have steps with columns, so they are broadcast.
    """
    edges = F.broadcast(lineage(reports.sparkSession, plans).withColumnRenamed("plan", "_plan"))
    joined = reports.join(edges, F.col("plan") == F.col("_plan"), "left").drop("_plan")
    held = F.when(F.array_contains("columns", F.col("needed")), F.lit(INPUT))
    provider = F.coalesce("added_by", held)
    return joined.withColumns({"provider": provider, "missing": provider.isNull()}).drop("added_by", "columns")


def breaches(reports: DataFrame, plans: Mapping[str, Plan]) -> DataFrame:
    """What is missing: the rows of :func:`contracts` that have no provider."""
    return contracts(reports, plans).where("missing")
