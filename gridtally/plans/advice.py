"""Equivalences and recommendations drawn from report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors import fixed
from gridtally.factors.tables import parse_block, values_frame
from gridtally.functions.common import rounded
from gridtally.session import written_once

FLAVORS = ("Everyday", "Tech", "Nature")

# When to recommend something.
COVERAGE_GOAL_PCT = 80
HIGH_INTENSITY = 300
RISE = 1.10

METRIC_COLUMNS = {"emissions": "co2_kg", "energy": "energy_kwh", "water": "water_l"}


def equivalence_table(spark: SparkSession, flavor: str = "Everyday") -> DataFrame:
    """Two comparisons per metric; the second depends on the flavour."""
    chosen = flavor if flavor in FLAVORS else "Everyday"
    rows = parse_block(fixed.EQUIVALENCES, str, int, str, str, float)
    kept = [(metric, slot, unit, per) for metric, slot, of, unit, per in rows if of in (None, chosen)]
    return values_frame(spark, kept, "metric string, slot int, unit string, per double")


def equivalences(totals: DataFrame, flavor: str = "Everyday", by: Sequence[str] = ()) -> DataFrame:
    """Totals (``co2_kg``, ``energy_kwh``, ``water_l``) told as everyday quantities.

    Works on one row or on a row per group. Missing, negative and NaN totals
    count as zero.
    """
    pairs = [
        F.struct(F.lit(metric).alias("metric"), F.col(column).cast("double").alias("amount"))
        for metric, column in METRIC_COLUMNS.items()
    ]
    long = totals.select(*by, F.inline(F.array(*pairs)))
    amount = F.col("amount")
    sane = F.when(amount.isNull() | F.isnan(amount) | (amount < 0), F.lit(0.0)).otherwise(amount)
    table = F.broadcast(equivalence_table(totals.sparkSession, flavor))
    return long.join(table, "metric").select(*by, "metric", "slot", "unit", (sane / F.col("per")).alias("quantity"))


def _advice(kind: str, subject: Column, value: Column, message: Column) -> list[Column]:
    return [
        F.lit(kind).alias("kind"),
        subject.alias("subject"),
        value.cast("double").alias("value"),
        message.alias("message"),
    ]


def recommend_coverage(coverage: DataFrame, uncovered: DataFrame) -> DataFrame:
    """The three dearest services without emissions, while coverage is low."""
    pct = coverage.select("coverage_pct").scalar()
    name = F.coalesce("ServiceName", F.lit("unknown"))
    return (
        uncovered.where((F.col("cost") > 0) & (pct < COVERAGE_GOAL_PCT))
        .orderBy(F.desc("cost"), F.asc_nulls_last("ServiceName"))
        .limit(3)
        .select(*_advice("coverage", name, F.col("cost"), F.concat(F.lit("no emissions are modelled for "), name)))
    )


def recommend_region(regions: DataFrame) -> DataFrame:
    """Up to two carbon-heavy regions against the cleanest one in use."""
    placed = regions.where("carbon_intensity IS NOT NULL").select(C.REGION, "carbon_intensity")
    placed = written_once(placed, "regions")
    best = placed.agg(
        F.struct(
            F.min(F.struct("carbon_intensity", C.REGION)).alias("low"), F.count(F.lit(1)).alias("n")
        ).alias("best")
    ).scalar()
    ratio = rounded(F.col("carbon_intensity") / F.greatest(F.col("best.low.carbon_intensity"), F.lit(1.0)), 1)
    return (
        placed.withColumn("best", best)
        .where((F.col("carbon_intensity") > HIGH_INTENSITY) & (F.col("best.n") >= 2))
        .orderBy(F.desc("carbon_intensity"), F.asc_nulls_last(C.REGION))
        .limit(2)
        .select(
            *_advice(
                "region",
                F.col(C.REGION),
                ratio,
                F.concat(F.lit("times the carbon intensity of "), F.col(f"best.low.{C.REGION}")),
            )
        )
    )


def recommend_instance(instances: DataFrame) -> DataFrame:
    """An Arm replacement for the instance type with the most emissions."""
    arm = values_frame(
        instances.sparkSession, parse_block(fixed.ARM_FAMILIES, str, str), "family string, arm_family string"
    )
    top = instances.orderBy(F.desc_nulls_last("co2_usage_kg"), "instance_type").limit(1)
    family = F.substring_index("instance_type", ".", 1)
    swapped = F.concat(F.col("arm_family"), F.substr("instance_type", F.length("family") + 1))
    return (
        top.withColumn("family", family)
        .join(F.broadcast(arm), "family")
        .select(
            *_advice(
                "instance", F.col("instance_type"), F.col("co2_usage_kg"), F.concat(F.lit("consider "), swapped)
            )
        )
    )


def recommend_trend(summary: DataFrame) -> DataFrame:
    """A rise of more than a tenth from the first period to the last."""
    ends = (
        summary.where(F.col("operational_kg").isNotNull() & F.col(C.BILLING_PERIOD).isNotNull())
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(C.BILLING_PERIOD).alias("first"),
            F.max(C.BILLING_PERIOD).alias("last"),
            F.min_by("operational_kg", C.BILLING_PERIOD).alias("first_kg"),
            F.max_by("operational_kg", C.BILLING_PERIOD).alias("last_kg"),
        )
        .where((F.col("n") >= 2) & (F.col("first_kg") > 0) & (F.col("last_kg") > F.col("first_kg") * F.lit(RISE)))
    )
    rise = rounded((F.col("last_kg") / F.col("first_kg") - F.lit(1.0)) * F.lit(100.0), 0)
    return ends.select(
        *_advice("trend", F.col("last"), rise, F.concat(F.lit("per cent more emissions than in "), F.col("first")))
    )


def recommendations(
    coverage: DataFrame, uncovered: DataFrame, regions: DataFrame, summary: DataFrame, instances: DataFrame
) -> DataFrame:
    """All recommendations from the tables of the fixed report."""
    parts = [
        recommend_coverage(coverage, uncovered),
        recommend_region(regions),
        recommend_instance(instances),
        recommend_trend(summary),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
