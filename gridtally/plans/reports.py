"""Reports over enriched usage.

All of them aggregate with a partial sum on the map side and end in a few rows
per period, service, region or tag value. Top lists are an ``orderBy`` with a
``limit``, which Spark runs as a bounded heap per task. Input is a frame as made
by :func:`gridtally.sources.usage.conform`.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C
from gridtally.functions.common import (
    blank_to_null,
    present,
    rounded,
    tags_as_map,
    usage_charge,
    zero_if_null,
)
from gridtally.functions.sums import Sums, exact_sums
from gridtally.session import written_once

INSTANCE_IN_METER = r":((?:[a-z][a-z0-9-]*\.)+[a-z0-9]+)$"
TOP = 20
TAG_CHART_ROWS = 40


class Measures(Sums):
    """Exact sums under the names that reports ask for."""

    def kg(self, name: str, only: Column | None = None) -> Column:
        return self.total(name, only) / F.lit(1000.0)

    def water(self, only: Column | None = None) -> Column:
        return zero_if_null(self.total(C.WATER_COOLING, only)) + zero_if_null(self.total(C.WATER_ELECTRICITY, only))

    def all_emissions_kg(self, only: Column | None = None) -> Column:
        grams = zero_if_null(self.total(C.OPERATIONAL, only)) + zero_if_null(self.total(C.EMBODIED, only))
        return grams / F.lit(1000.0)


def show(**values: Column) -> list[Column]:
    """Rounded measures under their names."""
    return [rounded(value).alias(name) for name, value in values.items()]


def covered() -> Column:
    return F.col(C.OPERATIONAL).isNotNull()


# --- scope ---------------------------------------------------------------------------


def scope(periods: Iterable[str] = (), regions: Iterable[str] = ()) -> Column:
    """Predicate for the chosen periods and regions; blanks choose nothing."""
    result = F.lit(True)
    for name, chosen in ((C.BILLING_PERIOD, periods), (C.REGION, regions)):
        chosen = [value for value in chosen if value]
        if chosen:
            result = result & F.col(name).isin(chosen)
    return result


def select_scope(df: DataFrame, periods: Iterable[str] = (), regions: Iterable[str] = ()) -> DataFrame:
    """Rows in scope; the period test prunes partition folders."""
    return df.where(scope(periods, regions))


def scope_options(df: DataFrame) -> DataFrame:
    """Periods and regions to choose from, as rows (kind, value)."""
    choices = F.array(
        F.struct(F.lit("period").alias("kind"), F.col(C.BILLING_PERIOD).alias("value")),
        F.struct(F.lit("region").alias("kind"), blank_to_null(F.col(C.REGION)).alias("value")),
    )
    return df.select(F.inline(choices)).where("value IS NOT NULL").distinct().orderBy("kind", "value")


# --- fixed report ---------------------------------------------------------------------


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def summary_by_period(df: DataFrame) -> DataFrame:
    sums = Measures()
    shown = show(
        energy_kwh=sums.total(C.ENERGY),
        operational_kg=sums.kg(C.OPERATIONAL),
        embodied_kg=sums.kg(C.EMBODIED),
        water_usage_l=sums.water(),
    )
    by_period = sums.by(df, C.BILLING_PERIOD).select(C.BILLING_PERIOD, *shown)
    return by_period.orderBy(F.asc_nulls_last(C.BILLING_PERIOD))


def with_total(summary: DataFrame, label: str = "TOTAL") -> DataFrame:
    """Add a line summing the shown values, as a reader of the table would."""
    sums, names = Measures(), [m for m in summary.columns if m != C.BILLING_PERIOD]
    is_total = F.col("_total")
    measures = [F.when(is_total, rounded(zero_if_null(sums.total(m)))).otherwise(F.col(f"_own_{m}")).alias(m) for m in names]
    also = [(F.grouping(C.BILLING_PERIOD) == 1).alias("_total"), *[F.max(m).alias(f"_own_{m}") for m in names]]
    lines = sums.by(summary, C.BILLING_PERIOD, also=also, rollup=True)
    named_total = F.when(is_total, F.lit(label)).otherwise(F.col(C.BILLING_PERIOD)).alias(C.BILLING_PERIOD)
    return (
        lines.select(named_total, *measures, "_total")
        .orderBy("_total", F.asc_nulls_last(C.BILLING_PERIOD))
        .drop("_total")
    )


def top_services(df: DataFrame, n: int = TOP) -> DataFrame:
    sums = Measures()
    shown = show(
        co2_usage_kg=sums.kg(C.OPERATIONAL),
        energy_kwh=sums.total(C.ENERGY),
        co2_embodied_kg=sums.kg(C.EMBODIED),
        water_usage_l=sums.water(),
    )
    return (
        sums.by(df.where(covered()), "ServiceName")
        .select("ServiceName", *shown)
        .orderBy(
            F.desc_nulls_last("co2_usage_kg"),
            F.desc_nulls_last("co2_embodied_kg"),
            F.desc_nulls_last("energy_kwh"),
            F.asc_nulls_last("ServiceName"),
        )
        .limit(n)
    )


def top_instance_types(df: DataFrame, n: int = TOP) -> DataFrame:
    kind = F.regexp_extract("SkuMeter", INSTANCE_IN_METER, 1)
    sums = Measures()
    shown = show(co2_usage_kg=sums.kg(C.OPERATIONAL), co2_embodied_kg=sums.kg(C.EMBODIED), water_usage_l=sums.water())
    typed = df.withColumn("instance_type", kind).where(present(F.col("instance_type")))
    return (
        sums.by(typed, "instance_type")
        .select("instance_type", *shown)
        .orderBy(F.desc_nulls_last("co2_usage_kg"), "instance_type")
        .limit(n)
    )


def cost_coverage(df: DataFrame, cost: str = "BilledCost", charge: str = "ChargeCategory") -> DataFrame:
    """Share of usage cost that has emissions; columns may be native ones."""
    sums = Measures()
    everything, part = sums.total(cost), sums.total(cost, covered())
    pct = F.try_divide(part * F.lit(100.0), everything)
    shown = show(coverage_pct=pct, covered_cost=part, total_cost=everything)
    return sums.by(df.where(usage_charge(charge))).select(*shown)


def uncovered_services(df: DataFrame, n: int = TOP) -> DataFrame:
    sums = Measures()
    shown = show(cost=sums.total("BilledCost"))
    return (
        sums.by(df.where(usage_charge() & ~covered()), "ServiceName")
        .select("ServiceName", *shown)
        .orderBy(F.desc_nulls_last("cost"), F.asc_nulls_last("ServiceName"))
        .limit(n)
    )


def regional_report(df: DataFrame, list_cost: str = "ListCost") -> DataFrame:
    sums = Measures()
    (intensity, with_intensity), (pue, with_pue) = sums.mean(C.INTENSITY), sums.mean(C.PUE)
    grams = sums.total(C.OPERATIONAL) + sums.total(C.EMBODIED)
    shown = show(
        co2_usage_kg=sums.kg(C.OPERATIONAL),
        energy_kwh=sums.total(C.ENERGY),
        carbon_intensity=intensity,
        water_usage_l=sums.water(),
        water_stress_area_l=zero_if_null(sums.total(C.WATER_STRESS)),
        pue=pue,
        g_co2_per_dollar=F.try_divide(grams, sums.total(list_cost)),
    )
    by_region = sums.by(df.where(covered()), C.REGION, also=[with_intensity, with_pue]).select(C.REGION, *shown)
    return by_region.orderBy(
        F.desc_nulls_last("energy_kwh"), F.desc_nulls_last("co2_usage_kg"), F.desc_nulls_last(C.REGION)
    )


# --- interactive views -------------------------------------------------------------------


def overview(df: DataFrame, periods: Sequence[str] = (), regions: Sequence[str] = ()) -> DataFrame:
    """One row of totals in scope, beside the cost coverage of the whole input.

    Both come from one pass over the data: the scope is a condition inside the
    sums, not a filter.
    """
    chosen = F.coalesce(scope(periods, regions), F.lit(False))
    used = chosen & usage_charge()
    sums = Measures()
    part = sums.total("BilledCost", usage_charge() & covered())
    shown = show(
        total_cost=zero_if_null(sums.total("BilledCost", used)),
        energy_kwh=zero_if_null(sums.total(C.ENERGY, used)),
        operational_kg=zero_if_null(sums.kg(C.OPERATIONAL, used)),
        embodied_kg=zero_if_null(sums.kg(C.EMBODIED, used)),
        total_emissions_kg=sums.all_emissions_kg(used),
        water_l=sums.water(used),
        coverage_pct=F.try_divide(part * F.lit(100.0), sums.total("BilledCost", usage_charge())),
    )
    return sums.by(df, also=[F.count_if(chosen).alias("row_count")]).select("row_count", *shown)


def usage_measures(sums: Measures) -> list[Column]:
    used = usage_charge()
    return show(
        total_cost=sums.total("BilledCost", used),
        energy_kwh=sums.total(C.ENERGY, used),
        operational_kg=sums.kg(C.OPERATIONAL, used),
        embodied_kg=sums.kg(C.EMBODIED, used),
        total_emissions_kg=sums.all_emissions_kg(used),
        water_usage_l=sums.water(used),
    )


def usage_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Usage cost and impacts by any keys."""
    sums = Measures()
    shown = usage_measures(sums)
    added = sums.by(df, *keys)
    return added.select(*added.columns[: len(keys)], *shown)


def trend(df: DataFrame) -> DataFrame:
    return usage_by(df, C.BILLING_PERIOD).orderBy(F.asc_nulls_last(C.BILLING_PERIOD))


def named(column: str, fallback: str) -> Column:
    return F.coalesce(blank_to_null(F.col(column)), F.lit(fallback))


def top_emitters(df: DataFrame, n: int = 10) -> DataFrame:
    return (
        usage_by(
            df.where(covered()),
            named("ServiceName", "Unknown service").alias("service_name"),
            named(C.REGION, "Unknown region").alias("region"),
        )
        .withColumnsRenamed({"operational_kg": "co2_usage_kg", "embodied_kg": "co2_embodied_kg"})
        .orderBy(
            F.desc_nulls_last("total_emissions_kg"),
            F.desc_nulls_last("co2_usage_kg"),
            F.desc_nulls_last("energy_kwh"),
            "service_name",
            "region",
        )
        .limit(max(1, n))
    )


def top_emitter_totals(emitters: DataFrame) -> DataFrame:
    """Sums over the listed emitters beside the largest of them; a bounded list."""
    first = F.struct(
        F.col("total_emissions_kg"), F.col("co2_usage_kg"), F.col("energy_kwh"), F.col("service_name"), F.col("region")
    )
    sums = Measures()
    shown = show(co2_usage_kg=sums.total("co2_usage_kg"), total_cost=sums.total("total_cost"))
    added = sums.by(emitters, also=[F.count(F.lit(1)).alias("listed"), F.max(first).alias("_first")])
    return added.select(
        "listed",
        *shown,
        F.col("_first.service_name").alias("largest_emitter"),
        F.col("_first.total_emissions_kg").alias("largest_kg"),
    )


def regions_weighted(df: DataFrame) -> DataFrame:
    """By region, with intensity and PUE weighted by the energy they apply to."""
    used, sums = usage_charge(), Measures()
    energy = F.col(C.ENERGY)

    def weighted(name: str) -> Column:
        both = used & energy.isNotNull() & F.col(name).isNotNull()
        return F.try_divide(sums.of(energy * F.col(name), both), sums.of(energy, both))

    grams = zero_if_null(sums.total(C.OPERATIONAL, used)) + zero_if_null(sums.total(C.EMBODIED, used))
    shown = show(
        co2_usage_kg=zero_if_null(sums.kg(C.OPERATIONAL, used)),
        co2_embodied_kg=zero_if_null(sums.kg(C.EMBODIED, used)),
        total_emissions_kg=sums.all_emissions_kg(used),
        energy_kwh=zero_if_null(sums.total(C.ENERGY, used)),
        carbon_intensity=weighted(C.INTENSITY),
        water_usage_l=sums.water(used),
        water_stress_area_l=zero_if_null(sums.total(C.WATER_STRESS, used)),
        pue=weighted(C.PUE),
        g_co2_per_dollar=F.try_divide(grams, sums.total("BilledCost", used)),
    )
    return (
        sums.by(df.where(covered()), named(C.REGION, "Unknown region").alias("region_name"))
        .select("region_name", *shown)
        .withColumnRenamed("region_name", C.REGION)
        .orderBy(F.desc_nulls_last("total_emissions_kg"), F.desc_nulls_last("energy_kwh"), C.REGION)
    )


def region_share(regions: DataFrame) -> DataFrame:
    """Each region's percentage of all emissions, from :func:`regions_weighted`."""
    regions = written_once(regions, "regions")
    everything = exact_sums(regions, kg=F.col("total_emissions_kg"))
    share = F.try_divide(F.col("total_emissions_kg") * F.lit(100.0), everything.scalar())
    return regions.select(C.REGION, "total_emissions_kg", rounded(share).alias("share_pct"))


# --- tags ------------------------------------------------------------------------------


def tag_entries(df: DataFrame) -> DataFrame:
    """Tags as rows (key, value), from a map or from JSON text."""
    tags = tags_as_map(df)
    if tags is None:
        return df.where(F.lit(False)).select(*[F.lit(None).cast("string").alias(c) for c in ("key", "value")])
    return df.select(F.explode(tags).alias("key", "value"))


def tag_keys(df: DataFrame) -> DataFrame:
    return tag_entries(df).select(F.col("key").alias("tag_key")).distinct().orderBy("tag_key")


def tag_coverage(df: DataFrame, n: int = 10) -> DataFrame:
    """Percentage of lines with a value per tag key, in one pass over the lines.

    Each line also gives one entry without a key, whose count is that of the lines.
    The counts are read twice, so they are worked out once.
    """
    tags = tags_as_map(df)
    marker = F.array(F.struct(*[F.lit(None).cast("string").alias(name) for name in ("key", "value")]))
    entries = marker if tags is None else F.coalesce(F.concat(marker, F.map_entries(tags)), marker)
    counted = F.col("key").isNull() | (present(F.col("key")) & present(F.col("value")))
    counts = written_once(df.select(F.inline(entries)).where(counted).groupBy("key").count(), "tag-counts")
    lines = counts.where("key IS NULL").select(F.col("count").cast("double")).scalar()
    pct = rounded(F.try_divide(F.col("count").cast("double") * F.lit(100.0), lines), 1)
    return (
        counts.where("key IS NOT NULL")
        .select(F.col("key").alias("tag_key"), pct.alias("coverage_pct"))
        .where("coverage_pct > 0")
        .orderBy(F.desc("coverage_pct"), "tag_key")
        .limit(n)
    )


def tag_value(df: DataFrame, key: str) -> Column:
    tags = tags_as_map(df)
    return F.lit(None).cast("string") if tags is None else tags[key]


def tag_breakdown(df: DataFrame, key: str) -> DataFrame:
    """Impacts by value of a tag; lines without the tag form a NULL group."""
    sums = Measures()
    shown = show(
        energy_kwh=sums.total(C.ENERGY),
        operational_kg=sums.kg(C.OPERATIONAL),
        embodied_kg=sums.kg(C.EMBODIED),
        water_usage_l=sums.water(),
    )
    by_value = sums.by(df, tag_value(df, key).alias("tag_value")).select("tag_value", *shown)
    return by_value.orderBy(F.desc_nulls_last("operational_kg"), F.asc_nulls_last("tag_value"))


def tag_breakdown_usage(df: DataFrame, key: str) -> DataFrame:
    """Usage cost and impacts by non-empty value of a tag."""
    tagged = df.withColumn("tag_value", tag_value(df, key)).where(present(F.col("tag_value")))
    return usage_by(tagged, "tag_value").orderBy(F.desc_nulls_last("total_emissions_kg"), "tag_value")


def top_with_other(rows: DataFrame, metric: str, limit: int = TAG_CHART_ROWS) -> DataFrame:
    """The first values by a metric, and one line summing all the others.

    Up to ``limit`` values are listed as they are; beyond it, one fewer and the
    line of others. Only the listed head is ranked, so nothing else passes
    through a single task, however many values there are. The rows are read
    twice, so they are worked out once and written to the shared folder.
    """
    rows = written_once(rows, "tag-values")
    measures = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)]
    order = [F.desc_nulls_last(metric), F.asc_nulls_last("tag_value")]
    head = rows.orderBy(*order).limit(limit + 1)
    ranked = head.select(
        "*",
        F.row_number().over(Window.orderBy(*order)).alias("_rank"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("_n"),
    )
    listed = ranked.where((F.col("_n") <= limit) | (F.col("_rank") < limit)).drop("_rank", "_n")
    keys = F.broadcast(listed.select(F.col("tag_value").alias("_listed")))
    rest = rows.join(keys, F.col("tag_value").eqNullSafe(F.col("_listed")), "left_anti")
    sums = Measures()
    added = [zero_if_null(sums.total(m)).alias(m) for m in measures]
    other = sums.by(rest, also=[F.count(F.lit(1)).alias("_n")]).select(
        F.lit("(other)").alias("tag_value"),
        F.concat(F.lit("Other ("), F.col("_n").cast("string"), F.lit(" values)")).alias("label"),
        *added,
        "_n",
    )
    label = (
        F.when(F.col("tag_value").isNull(), "(missing)").when(F.col("tag_value") == "", "(empty)")
        .otherwise(F.col("tag_value"))
    )
    shown = ["tag_value", "label", *measures]
    return listed.withColumn("label", label).select(*shown).unionByName(other.where("_n > 0").select(*shown))


# --- native columns ------------------------------------------------------------------------


def breakdown(df: DataFrame, keys: Sequence[str], floor_g: float = 0.01) -> DataFrame:
    """Impacts of lines above a floor by any columns, such as product and operation."""
    sums = Measures()
    shown = show(
        co2_usage_kg=sums.kg(C.OPERATIONAL), co2_embodied_kg=sums.kg(C.EMBODIED), energy_usage_kwh=sums.total(C.ENERGY)
    )
    return (
        sums.by(df.where(F.col(C.OPERATIONAL) > floor_g), *keys)
        .select(*keys, *shown)
        .orderBy(
            F.desc_nulls_last("co2_usage_kg"),
            F.desc_nulls_last("co2_embodied_kg"),
            F.desc_nulls_last("energy_usage_kwh"),
            *[F.asc_nulls_last(k) for k in keys],
        )
    )


def split_by_tag(df: DataFrame, key: str, tags: str = "resource_tags") -> DataFrame:
    """Shared emissions by value of a resource tag, such as a namespace."""
    tagged = df.select(F.lit(key).alias("key"), F.col(tags)[key].alias("value"), "split_" + C.OPERATIONAL, tags)
    held = tagged.where(F.array_contains(F.map_keys(tags), key))
    return exact_sums(held, "key", "value", total_g=F.col("split_" + C.OPERATIONAL)).orderBy(
        F.desc_nulls_last("total_g"), F.asc_nulls_last("value")
    )
