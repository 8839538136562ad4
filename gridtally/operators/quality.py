"""Checks of usage against factors and of factor sources against each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.factors.tables import Dim
from gridtally.functions.sums import exact_sums


def lookup_gaps(df: DataFrame, key: Column, cost: Column, known: Dim, known_key: str) -> DataFrame:
    """Keys seen in usage that a factor table lacks, with lines and cost behind them.

    Usage is summed by key before the anti join, so only distinct keys meet the
    factor table.
    """
    keyed = df.select(key.alias("key"), cost.alias("cost")).where(F.col("key").isNotNull())
    seen = exact_sums(keyed, "key", also=[F.count(F.lit(1)).alias("lines")], cost=F.col("cost"))
    keys = known.frame.select(F.col(known_key).alias("key"))
    return seen.join(F.broadcast(keys) if known.small else keys, "key", "left_anti")


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the other side lacks."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def keys_only_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def keys_in_both(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_semi")


def gpu_model(name: Column) -> Column:
    """GPU model without vendor words, as ``v100`` for both ``NVIDIA_TESLA_V100`` and ``Tesla V100``."""
    plain = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")
    for vendor in ("nvidia", "tesla", "amd", "radeonpro"):
        plain = F.replace(plain, F.lit(vendor), F.lit(""))
    return plain


def reconcile_gpus(ours: DataFrame, theirs: DataFrame, bundled: DataFrame, percent: float = 50) -> DataFrame:
    """Compare two GPU tables by instance type.

    ``ours``: instance_type, gpu, gpus, idle_w, full_w. ``theirs``:
    instance_type, gpu_name, gpu_units, embodied_g, gpu_embodied_g. ``bundled``:
    instance_type, embodied_g as shipped before.
    """
    left = ours.select("instance_type", "gpu", "gpus", "idle_w", "full_w", F.lit(True).alias("_ours"))
    right = theirs.select(
        "instance_type", "gpu_name", "gpu_units", "embodied_g", "gpu_embodied_g", F.lit(True).alias("_theirs")
    )
    old = bundled.select("instance_type", F.col("embodied_g").alias("bundled_g"))
    both = F.col("_ours") & F.col("_theirs")
    status = F.when(both, "both").when(F.col("_ours"), "only_ours").otherwise("only_theirs")
    watts = F.col("idle_w") + F.lit(percent / 100) * (F.col("full_w") - F.col("idle_w"))
    return (
        left.join(right, "instance_type", "full_outer")
        .join(old, "instance_type", "left")
        .select(
            "instance_type",
            status.alias("status"),
            F.when(both, F.col("gpus") == F.col("gpu_units")).alias("count_agrees"),
            F.when(both, gpu_model(F.col("gpu")) == gpu_model(F.col("gpu_name"))).alias("model_agrees"),
            F.when(F.col("_ours"), watts * F.col("gpus") / F.lit(1000.0)).alias("hourly_kwh"),
            F.try_divide("embodied_g", "bundled_g").alias("embodied_ratio"),
            (F.try_divide("gpu_embodied_g", "embodied_g") * F.lit(100.0)).alias("gpu_share_pct"),
        )
    )
