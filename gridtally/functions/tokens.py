"""Billing of generated text by tokens, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_USAGE = r"^[^-]*-(.*)-(?i:(output|input)-tokens(?:-batch)?)$"


def model_key(usage_type: Column) -> Column:
    """Model named between the region prefix and the token ending, case kept."""
    return F.when(usage_type.rlike(TOKEN_USAGE), F.regexp_extract(usage_type, TOKEN_USAGE, 1))


def direction(usage_type: Column) -> Column:
    """``output`` or ``input``; NULL for other usage types."""
    return F.nullif(F.lower(F.regexp_extract(usage_type, TOKEN_USAGE, 2)), F.lit(""))


OUTPUT_USAGE = r"^[^-]*-(.*)-(?i:output-tokens(?:-batch)?)$"


def output_label(product: Column, usage_type: Column) -> Column:
    """Lower-case model key of a billed output line; empty or NULL for others."""
    return F.when(product == "AmazonBedrock", F.lower(F.regexp_extract(usage_type, OUTPUT_USAGE, 1)))


def tokens_per_unit(unit: Column) -> Column:
    text = F.lower(F.trim(unit))
    return (
        F.when(text.contains("token") & text.startswith("1m"), F.lit(1_000_000.0))
        .when(text.contains("token") & text.startswith("1k"), F.lit(1_000.0))
        .otherwise(F.lit(1.0))
    )


def thousands(unit: Column, amount: Column) -> Column:
    """Thousands of billed tokens; NULL unless the amount is positive."""
    return F.when(amount > 0, amount * tokens_per_unit(unit) / F.lit(1_000.0))
