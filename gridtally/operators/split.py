"""Sharing the impacts of a resource among the workloads running on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C
from gridtally.functions.common import zero_if_null
from gridtally.functions.sums import Sums
from gridtally.operators.base import ContractError
from gridtally.session import written_once

INTERVAL = "identity_time_interval"
PARENT = "split_line_item_parent_resource_id"
RESOURCE = "line_item_resource_id"
RATIO = "split_line_item_split_usage_ratio"
PREFIX = "split_"

DEFAULT_IMPACTS = (C.ENERGY, C.OPERATIONAL, C.EMBODIED)

# Groups whose totals are handed to every task. With the largest 1,000 groups
# out of the way, no remaining one can hold more than a thousandth of the rows.
HEAVY_GROUPS = 1_000


def is_parent() -> Column:
    """Rows billed for the resource itself; exports may write NULL as text."""
    return F.col(PARENT).isNull() | (F.lower(PARENT) == "null")


def owner() -> Column:
    return F.when(is_parent(), F.col(RESOURCE)).otherwise(F.col(PARENT))


def number(name: str) -> Column:
    return F.col(name).try_cast("double")


def impact_list(text: str) -> list[str]:
    """Column names separated by commas, each with at most one space after it."""
    return [part[1:] if part.startswith(" ") else part for part in text.split(",")]


def plain_columns(df: DataFrame) -> list[str]:
    """Columns that a hash can be made of."""
    return [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]


def group_totals(df: DataFrame, impacts: Sequence[str] = DEFAULT_IMPACTS) -> DataFrame:
    """Per interval and owner: impact and ratio sums over all rows, and row counts.

    The columns needed are dealt by ranges of the groups first, so that a task holds
    few groups, whatever it reads, and rows of a group mostly meet before they are sent
    on as sums. Ranges go by the row too: a resource that holds a large part of all rows
    is in several of them, and each sends one row for it.
    """
    sums = Sums()
    needed = dict.fromkeys((INTERVAL, PARENT, RESOURCE, RATIO, *impacts))
    dealt = df.select(*[F.col(f"`{name}`") for name in needed], F.xxhash64(*plain_columns(df)).alias("_row"))
    dealt = dealt.repartitionByRange(F.col(INTERVAL), owner(), F.col("_row"))
    added = {name: zero_if_null(sums.of(number(column))) for name, column in [*zip(impacts, impacts), ("ratio", RATIO)]}
    groups = sums.by(
        dealt,
        F.col(INTERVAL).alias("interval"),
        owner().alias("owner"),
        also=[F.count_if(~is_parent()).alias("children")],
    )
    return groups.select("interval", "owner", *[value.alias(name) for name, value in added.items()], "children")


def allocate_splits(
    df: DataFrame, impacts: Sequence[str] = DEFAULT_IMPACTS, heavy_groups: int = HEAVY_GROUPS
) -> DataFrame:
    """Add ``split_`` columns: each workload's share of its resource's impacts.

    The usage rows are read once for the group totals and once to share them out.
    Totals of the largest groups come by a broadcast join of at most
    ``heavy_groups`` rows. If there are more groups, the rest come by a keyed
    join, in which rows without a group of that kind are spread by a hash. A
    missing ratio, or ratios that sum to zero, give NULL. The totals are worked
    out once, when this is called, and written to the shared folder.
    """
    for name in (INTERVAL, PARENT, RESOURCE, RATIO, *impacts):
        if name not in df.columns:
            raise ContractError(f"splits need the missing column {name}")
    added = [PREFIX + name for name in impacts]
    base = df.drop(*[c for c in df.columns if c.lower() in {a.lower() for a in added}])

    prefixed = ["interval", "owner", "ratio", *impacts]
    totals = (
        group_totals(base, impacts)
        .where("children > 0")
        .select(*[F.col(c).alias(f"_t_{c}") for c in prefixed], F.col("children").alias("_t_children"))
    )
    totals = written_once(totals, "split-totals")
    more = totals.limit(heavy_groups + 1).count() > heavy_groups
    # The full key breaks ties.
    order = (F.desc("_t_children"), F.asc_nulls_last("_t_interval"), F.asc_nulls_last("_t_owner"))
    heavy = totals.orderBy(*order).limit(heavy_groups) if more else totals

    same_group = F.col(INTERVAL).eqNullSafe(F.col("_t_interval")) & F.col(PARENT).eqNullSafe(F.col("_t_owner"))
    joined = base.join(F.broadcast(heavy), ~is_parent() & same_group, "left")
    value = {c: F.col(f"_t_{c}") for c in ("ratio", *impacts)}
    if more:
        light = totals.select(
            *[F.col(c).alias(c.replace("_t_", "_l_")) for c in totals.columns if c != "_t_children"],
        )
        found = F.col("_t_children").isNotNull()
        # Rows that need no partner get a key of their own, so that none of them meet in one task.
        spare = F.concat(F.lit(" "), F.xxhash64(*plain_columns(base)).cast("string"))
        alone = is_parent() | found
        keyed = joined.withColumn("_l_spare", F.when(alone, spare))
        joined = keyed.join(
            light.withColumn("_l_none", F.lit(None).cast("string")),
            F.col(INTERVAL).eqNullSafe(F.col("_l_interval"))
            & F.col(PARENT).eqNullSafe(F.col("_l_owner"))
            & F.col("_l_spare").eqNullSafe(F.col("_l_none")),
            "left",
        )
        value = {c: F.coalesce(F.col(f"_t_{c}"), F.col(f"_l_{c}")) for c in value}

    weight = F.try_divide(number(RATIO), value["ratio"])
    sum_of_all = value["ratio"]
    for name in impacts:
        sum_of_all = sum_of_all + value[name]
    shares = [F.when(sum_of_all > 0, value[n] * weight).alias(PREFIX + n) for n in impacts]
    return joined.select(*[F.col(f"`{c}`") for c in base.columns], *shares)
