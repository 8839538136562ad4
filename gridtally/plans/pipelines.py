"""Enrichment plans: an ordered list of operators with parameters."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import Factors
from gridtally.functions.common import is_usage
from gridtally.operators import enrich as ops
from gridtally.operators.base import GATE, GATED_AMOUNT, ContractError, Operator, Run

Step = tuple[Operator, Mapping[str, Any]]

_AZURE_PUE = {"default": 1.17}  # fixed value

_DEFAULTS: dict[tuple[str, str], list[Step]] = {
    (C.AWS, C.NATIVE): [
        (ops.region, {}),
        (ops.storage_energy, {}),
        (ops.network_energy, {}),
        (ops.compute_impacts, {}),
        (ops.serverless_energy, {}),
        (ops.gpu_energy, {}),
        (ops.token_impacts, {}),
        (ops.efficiency, {}),
        (ops.water, {}),
        (ops.carbon_intensity, {}),
        (ops.operational_emissions, {}),
        (ops.aws_bridge, {}),
    ],
    (C.AZURE, C.NATIVE): [
        (ops.region, {}),
        (ops.storage_energy, {}),
        (ops.network_energy, {}),
        (ops.compute_impacts, {}),
        (ops.efficiency, _AZURE_PUE),
        (ops.water, {}),
        (ops.carbon_intensity, {}),
        (ops.operational_emissions, {}),
        (ops.azure_bridge, {}),
    ],
}
for _provider in (C.AWS, C.AZURE):
    _DEFAULTS[(_provider, C.FOCUS)] = _DEFAULTS[(_provider, C.NATIVE)][:-1]


@dataclass(frozen=True)
class Plan:
    """Operators to run in order for one provider and report layout."""

    provider: str
    layout: str
    steps: tuple[Step, ...]

    @staticmethod
    def default(provider: str, layout: str = C.NATIVE) -> Plan:
        steps = _DEFAULTS.get((provider, layout))
        if steps is None:
            raise ValueError(f"no default plan for {provider} {layout}")
        return Plan(provider, layout, tuple(steps))

    @staticmethod
    def from_json(text: str, provider: str, layout: str = C.NATIVE, extra: Mapping[str, Operator] | None = None) -> Plan:
        """Read ``{"modules": [{"name": ..., "config": {...}}, ...]}``.

        Names refer to the registered operators or to the caller's own ``extra``
        ones.
        """
        if not provider:
            raise ValueError("a plan needs a provider")
        known = {**ops.REGISTRY, **(extra or {})}
        steps = []
        for module in json.loads(text)["modules"]:
            operator = known.get(module["name"])
            if operator is None:
                raise ValueError(f"unknown operator: {module['name']}")
            if not isinstance(operator, Operator):
                raise ValueError(f"not an operator: {module['name']}")
            steps.append((operator, module.get("config") or {}))
        return Plan(provider, layout, tuple(steps))

    def added(self) -> dict[str, str]:
        """Result columns of all operators, with their types."""
        return {name: op.type_of(name) for op, _ in self.steps for name in op.adds}

    def check(self, df: DataFrame) -> None:
        """Every column an operator reads must be in the input or added before it."""
        have = set(df.columns)
        for op, _ in self.steps:
            missing = [c for c in op.needs(self.provider, self.layout) if c not in have]
            if missing:
                raise ContractError(f"operator {op.name} needs missing column(s): {', '.join(missing)}")
            have.update(op.adds)

    def apply(self, df: DataFrame, factors: Factors) -> DataFrame:
        """Enrich usage rows; other rows pass through with NULL impacts.

        Result columns overwrite input columns of the same name, whatever their
        case.
        """
        self.check(df)
        added = self.added()
        taken = {name.lower() for name in added}
        # Operators still read native columns that a result column replaces
        # (the bridge never does), so only true name clashes are dropped.
        base = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
        nulls = [F.lit(None).cast(kind).alias(name) for name, kind in added.items()]
        usage = is_usage(self.provider, self.layout)
        gate = [usage.alias(GATE)]
        amount = C.binding(self.provider, self.layout).get("amount")
        if amount in df.columns:
            gate.append(F.when(usage, F.col(amount)).alias(GATED_AMOUNT))
        seeded = df.select(*base, *nulls, *gate)
        placed = any(op is ops.region for op, _ in self.steps)
        run = Run(self.provider, self.layout, factors, F.col(GATE), placed)
        for op, params in self.steps:
            seeded = op.classify(seeded, replace(run, params=params))
        for op, params in self.steps:
            seeded = op.prepare(seeded, replace(run, params=params))
        for op, params in self.steps:
            seeded = op.apply(seeded, replace(run, params=params))
        result = ops.without_region_factors(seeded)
        kept = [c for c in df.columns if c.lower() not in taken]
        return result.select(*[F.col(f"`{c}`") for c in kept], *added)


def enrich(
    df: DataFrame, provider: str, layout: str, factors: Factors, plan: Plan | None = None
) -> DataFrame:
    """Add energy, emissions and water columns to usage rows of one report layout."""
    return (plan or Plan.default(provider, layout)).apply(df, factors)
