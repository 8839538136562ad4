"""What an enrichment operator is, and how it writes its result columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import Factors


class ContractError(ValueError):
    """A column an operator reads is missing from its input."""


@dataclass(frozen=True)
class Run:
    """What every operator of one enrichment run shares."""

    provider: str
    layout: str
    factors: Factors | None = None
    guard: Column | None = None
    placed: bool = False  # the region is worked out before any step is applied
    params: Mapping[str, Any] = field(default_factory=dict)

    def name(self, logical: str) -> str | None:
        return C.binding(self.provider, self.layout).get(logical)

    def col(self, logical: str) -> Column:
        return F.col(C.binding(self.provider, self.layout)[logical])

    def param(self, key: str, default: float) -> float:
        """A numeric parameter, which a configuration may also give as text."""
        value = self.params.get(key)
        if value is None:
            return default
        try:
            return float(value)
        except (TypeError, ValueError):
            return default

    def amount(self) -> Column:
        """Billed amount; in a plan it is NULL outside usage charges.

        Whatever is worked out from it is then NULL there too, so that
        operators need no test of their own.
        """
        return self.col("amount") if self.guard is None else F.col(GATED_AMOUNT)

    def only_usage(self, value: Column) -> Column:
        return value if self.guard is None else F.when(self.guard, value)

    def put(self, df: DataFrame, **values: Column) -> DataFrame:
        """Set result columns where a value was worked out; keep them elsewhere."""
        have = set(df.columns)
        return df.withColumns(
            {name: F.coalesce(value, F.col(name)) if name in have else value for name, value in values.items()}
        )


# Helper columns of a plan: whether a row is a usage charge, and its amount if so.
GATE, GATED_AMOUNT = "_usage", "_amount"

Apply = Callable[[DataFrame, Run], DataFrame]
Names = Callable[[str, str], list[str]]


@dataclass(frozen=True)
class Operator:
    """An enrichment step: a function from frame to frame with declared columns.

    ``needs`` gives the physical input columns for a provider and layout;
    ``adds`` the result columns. ``classify`` tells by rules what a line is, and
    ``prepare`` joins what the step looks up. A plan classifies for all its steps,
    then prepares all, before it applies any. So the rules are one projection, whose
    code is apart from the rest; and with the joins in one run and nothing but
    projections after them, Catalyst merges those into very few, and a wide row is
    copied few times. User-defined operators are built the
    same way from DataFrame functions.
    """

    name: str
    needs: Names
    adds: tuple[str, ...]
    apply: Apply
    prepare: Apply = lambda df, run: df
    types: Mapping[str, str] = field(default_factory=lambda: {**C.FOCUS_TYPES, **C.IMPACT_TYPES})
    classify: Apply = lambda df, run: df

    def __call__(self, df: DataFrame, run: Run) -> DataFrame:
        """The step on its own, outside a plan."""
        return self.apply(self.prepare(self.classify(df, run), run), run)

    def type_of(self, column: str) -> str:
        return self.types.get(column) or {**C.FOCUS_TYPES, **C.IMPACT_TYPES}.get(column, "string")


def bound(*logical: str, extra: tuple[str, ...] = ()) -> Names:
    """Needs stated as logical names, resolved per layout."""

    def names(provider: str, layout: str) -> list[str]:
        known = C.binding(provider, layout)
        found = [known[n] for n in logical if n in known]
        return list(dict.fromkeys([*found, *extra]))

    return names
