"""Small column helpers shared by every operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C


def rounded(value: Column, digits: int = 2) -> Column:
    """Round half away from zero on the scaled binary value, as a display measure."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def present(value: Column) -> Column:
    """True for a non-NULL, non-empty string, never NULL."""
    return F.coalesce(value != "", F.lit(False))


def is_usage(provider: str, layout: str) -> Column:
    """Rows that get enriched: usage charges only, never NULL."""
    charge = C.binding(provider, layout).get("charge")
    if provider not in (C.AWS, C.AZURE) or charge is None:
        return F.lit(False)
    test = F.col(charge) == "Usage" if layout == C.FOCUS else F.col(charge).endswith("Usage")
    return F.coalesce(test, F.lit(False))


def usage_charge(name: str = "ChargeCategory") -> Column:
    """Charge categories that reports count as usage, never NULL."""
    return F.coalesce(F.col(name).like("%Usage"), F.lit(False))


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column if the frame has it, otherwise a typed NULL."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind)


def map_value(df: DataFrame, name: str, key: str, default: str | None = None) -> Column:
    """One entry of a map column, which Parquet may also hold as key/value structs."""
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType):
        hits = F.filter(column, lambda entry: entry["key"] == key)
        value = F.try_element_at(hits, F.lit(1))["value"]
    else:
        value = column[key]
    return value if default is None else F.coalesce(value, F.lit(default))


def tags_as_map(df: DataFrame, name: str = "Tags") -> Column | None:
    """Tags as a map, whether held as a map or as JSON text; None if absent."""
    if name not in df.columns:
        return None
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.MapType):
        return column
    return F.from_json(column, "map<string,string>")


def ends_with_any(text: Column, tokens: Sequence[str]) -> Column:
    """True if the text ends with any token.

    The reversed text is matched against one pattern anchored at its start.
    That fails on the first letter of nearly every token, and compiles to a few
    instructions: a chain of suffix tests makes the generated method too large
    for the JVM to compile, and an alternation anchored at the end is tried at
    every letter of the text.
    """
    backwards = "|".join(r"\Q" + token[::-1] + r"\E" for token in tokens)
    return F.reverse(text).rlike(f"^(?:{backwards})")
