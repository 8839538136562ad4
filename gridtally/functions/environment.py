"""Emissions and water from energy and regional factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally.functions.common import present

POWER_SUPPLY, TRANSMISSION = 1.04, 1.08  # fixed values: overhead factors
HIGH_STRESS = 3  # fixed value: lowest category that counts as stressed


def operational(
    energy: Column, intensity: Column, pue: Column, supply: float = POWER_SUPPLY, transmission: float = TRANSMISSION
) -> Column:
    """g CO2e; the overheads are one factor, so that last digits agree."""
    overhead = F.coalesce(pue, F.lit(1.0)) * F.lit(supply) * F.lit(transmission)
    return energy * intensity * overhead


def facility_energy(energy: Column, region: Column, pue: Column) -> Column:
    """Energy with the site's overhead; NULL unless positive and placed."""
    return F.when((energy > 0) & present(region), energy * F.coalesce(pue, F.lit(1.0)))


def stressed_water(total_energy: Column, cooling: Column, electricity: Column, category: Column) -> Column:
    """Water drawn where it is scarce; NULL elsewhere, never zero for unknown."""
    both = F.coalesce(cooling, F.lit(0.0)) + F.coalesce(electricity, F.lit(0.0))
    return F.when(total_energy.isNotNull() & (category >= HIGH_STRESS), both)
