"""The enrichment operators.

Each one is a projection over the usage rows, joined where needed to a small
lookup table on the map side. None of them shuffles usage rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import Dim, lookup
from gridtally.functions import bridge, compute, environment, network, storage, tokens
from gridtally.functions.common import map_value, present
from gridtally.operators.base import ContractError, Operator, Run, bound

# --- region -----------------------------------------------------------------

AWS_REGION_COLUMNS = ("product_region_code", "product_from_region_code", "product_to_region_code")


def _region(df: DataFrame, run: Run) -> DataFrame:
    if run.layout == C.FOCUS:
        region = F.lower("RegionId")
    elif run.provider == C.AZURE:
        region = F.lower("ResourceLocation")
    else:
        region = F.coalesce(*AWS_REGION_COLUMNS)  # codes keep their case here
    return run.put(df, **{C.REGION: run.only_usage(region)})


def _region_needs(provider: str, layout: str) -> list[str]:
    if layout == C.FOCUS:
        return ["RegionId"]
    return ["ResourceLocation"] if provider == C.AZURE else list(AWS_REGION_COLUMNS)


# Worked out ahead of the other steps, whose lookups need it.
region = Operator("region", _region_needs, (C.REGION,), lambda df, run: df, _region)

# --- energy -----------------------------------------------------------------


def _rates(run: Run) -> tuple[float, float]:
    return (
        run.param("hdd_coefficient_tb_h", storage.HDD_WH_PER_TB_HOUR),
        run.param("ssd_coefficient_tb_h", storage.SSD_WH_PER_TB_HOUR),
    )


def _storage(df: DataFrame, run: Run) -> DataFrame:
    hdd, ssd = _rates(run)
    amount, unit = run.amount(), run.col("unit")
    if run.provider == C.AWS:
        energy = storage.aws_energy(unit, amount, F.col("_per_gb"), F.col("_copies"))
        return run.put(df, **{C.ENERGY: energy}).drop("_per_gb", "_copies")
    category, meter = run.col("category"), run.col("meter")
    energy = F.coalesce(
        storage.azure_capacity_energy(category, meter, unit, amount, ssd),
        storage.azure_disk_energy(unit, amount, F.col("_disk_gb"), F.col("_disk_media"), hdd, ssd),
    )
    return run.put(df, **{C.ENERGY: energy}).drop("_disk_gb", "_disk_media")


def _storage_rules(df: DataFrame, run: Run) -> DataFrame:
    """Rates by rules; in the last projection they would make its method too large."""
    if run.provider == C.AWS:
        line = (run.col("operation"), run.col("unit"), run.col("usage_type"), run.col("service_code"))
        return df.withColumns(storage.aws_rate(*line, *_rates(run)))
    return df


def _storage_lookup(df: DataFrame, run: Run) -> DataFrame:
    if run.provider == C.AWS:
        return df
    sku = storage.azure_disk_sku(run.col("category"), run.col("subcategory"), run.col("meter"))
    return lookup(df, run.factors.disks, sku, "sku", "_disk_")


storage_energy = Operator(
    "storage",
    bound("operation", "amount", "usage_type", "service_code", "unit", "category", "subcategory", "meter"),
    (C.ENERGY,),
    _storage,
    _storage_lookup,
    classify=_storage_rules,
)


def transfer_scope(df: DataFrame, run: Run, of: network.Scopes | None = None) -> Column:
    """Where data went: ``intra``, ``inter``, ``extra`` (or what stands for them), else NULL."""
    of = of or network.names()
    if run.provider == C.AZURE:
        return network.azure_scope(run.col("category"), run.col("subcategory"), of)
    if run.layout == C.FOCUS:
        return network.aws_focus_scope(run.col("service_code"), run.col("usage_type"), of)
    return network.aws_scope(run.col("service_code"), map_value(df, run.name("product"), "transfer_type"), of)


def _network(df: DataFrame, run: Run) -> DataFrame:
    return run.put(df, **{C.ENERGY: run.amount() * F.col("_kwh_per_gb")}).drop("_kwh_per_gb")


def _network_rules(df: DataFrame, run: Run) -> DataFrame:
    given = run.params.get("network_coefficients_kwh_gb") or {}
    rates = network.rates(**{k: float(v) for k, v in given.items() if v is not None})
    return df.withColumn("_kwh_per_gb", transfer_scope(df, run, rates))


def _network_needs(provider: str, layout: str) -> list[str]:
    if provider == C.AZURE:
        return bound("category", "subcategory", "amount")(provider, layout)
    usage = "usage_type" if layout == C.FOCUS else "product"
    return bound("service_code", usage, "amount")(provider, layout)


network_energy = Operator("network", _network_needs, (C.ENERGY,), _network, classify=_network_rules)


def raw_instance_type(run: Run) -> Column:
    """Instance type as billed: its own column, or the end of a FOCUS meter."""
    if run.layout == C.FOCUS:
        return compute.type_from_meter(run.col("usage_type"))
    return run.col("instance_type")


def instance_type(run: Run) -> Column:
    """Instance type in factor-table spelling; NULL for lines that are no compute."""
    if run.provider == C.AZURE:
        return compute.azure_type(run.col("category"), run.col("meter"), run.col("unit"))
    return compute.aws_type(
        run.col("product_code"), run.col("operation"), run.col("service_code"), raw_instance_type(run)
    )


def _given(dim: Dim, step: str, method: str) -> None:
    """A step whose table has no rows would find nothing and say nothing."""
    if dim.empty:
        raise ContractError(f"operator {step} needs a table of coefficients: give it by Factors.{method}")


def _compute_rules(df: DataFrame, run: Run) -> DataFrame:
    return df.withColumn("_vm_type", instance_type(run))


def _compute_lookup(df: DataFrame, run: Run) -> DataFrame:
    _given(run.factors.compute, "compute", "with_compute")
    return lookup(df, run.factors.compute, F.col("_vm_type"), "instance_type", "_vm_").drop("_vm_type")


def _compute(df: DataFrame, run: Run) -> DataFrame:
    amount = run.amount()
    return run.put(
        df,
        **{
            C.ENERGY: F.col("_vm_kwh") * amount,
            C.EMBODIED: F.col("_vm_embodied_g") * amount,
            C.DEPLETION: F.col("_vm_depletion_g") * amount,
        },
    ).drop("_vm_kwh", "_vm_embodied_g", "_vm_depletion_g")


def _compute_needs(provider: str, layout: str) -> list[str]:
    if provider == C.AZURE:
        return bound("category", "meter", "unit", "amount")(provider, layout)
    kind = "usage_type" if layout == C.FOCUS else "instance_type"
    return bound(kind, "service_code", "operation", "product_code", "amount")(provider, layout)


compute_impacts = Operator("compute", _compute_needs, (C.ENERGY, C.EMBODIED, C.DEPLETION), _compute, _compute_lookup, classify=_compute_rules)


def _serverless_rules(df: DataFrame, run: Run) -> DataFrame:
    rate = compute.serverless_rate(
        run.col("operation"),
        run.col("usage_type"),
        run.param("memory_coefficient_kwh", compute.MEMORY_KWH),
        run.param("x86_cpu_coefficient_kwh", compute.X86_KWH),
        run.param("arm_cpu_coefficient_kwh", compute.ARM_KWH),
    )
    return df.withColumn("_kwh_per_unit", rate)


def _serverless(df: DataFrame, run: Run) -> DataFrame:
    return run.put(df, **{C.ENERGY: run.amount() * F.col("_kwh_per_unit")}).drop("_kwh_per_unit")


serverless_energy = Operator(
    "serverless", bound("operation", "amount", "usage_type"), (C.ENERGY,), _serverless, classify=_serverless_rules
)


def _gpu_rules(df: DataFrame, run: Run) -> DataFrame:
    kind = compute.gpu_type(run.col("product_code"), run.col("operation"), raw_instance_type(run))
    return df.withColumn("_gpu_type", kind)


def _gpu_lookup(df: DataFrame, run: Run) -> DataFrame:
    percent = run.param("gpu_utilisation_percent", compute.GPU_UTILISATION_PERCENT)
    watts = compute.gpu_watts(F.col("idle_w"), F.col("full_w"), percent)
    gpus = Dim(run.factors.gpu.frame.select("instance_type", watts.alias("watts"), "gpus"), run.factors.gpu.small)
    return lookup(df, gpus, F.col("_gpu_type"), "instance_type", "_gpu_").drop("_gpu_type")


def _gpu(df: DataFrame, run: Run) -> DataFrame:
    """GPU energy comes on top of what the instance itself was given before."""
    extra = compute.gpu_energy(run.amount(), F.col("_gpu_watts"), F.col("_gpu_gpus"))
    # Written so that the energy so far appears once: it is a large expression.
    before = F.coalesce(F.col(C.ENERGY), F.when(extra.isNotNull(), F.lit(0.0))) if C.ENERGY in df.columns else None
    total = extra if before is None else before + F.coalesce(extra, F.lit(0.0))
    return df.withColumn(C.ENERGY, total).drop("_gpu_watts", "_gpu_gpus")


def _gpu_needs(provider: str, layout: str) -> list[str]:
    kind = "usage_type" if layout == C.FOCUS else "instance_type"
    return bound(kind, "operation", "product_code", "amount")(provider, layout)


gpu_energy = Operator("gpu", _gpu_needs, (C.ENERGY,), _gpu, _gpu_lookup, classify=_gpu_rules)


def _token_rules(df: DataFrame, run: Run) -> DataFrame:
    return df.withColumn("_tok_label_of", tokens.output_label(run.col("product_code"), run.col("usage_type")))


def _token_lookup(df: DataFrame, run: Run) -> DataFrame:
    _given(run.factors.tokens, "tokens", "with_tokens")
    df = lookup(df, run.factors.token_dim(), F.col("_tok_label_of"), "label", "_tok_").drop("_tok_label_of")
    billed = F.when(F.col("_tok_kwh_per_1k").isNotNull(), tokens.thousands(run.col("unit"), run.amount()))
    return df.withColumn("_thousands", billed)


def _tokens(df: DataFrame, run: Run) -> DataFrame:
    """Generated text: output tokens only, replacing any energy set before."""
    return run.put(
        df,
        **{
            C.ENERGY: F.col("_thousands") * F.col("_tok_kwh_per_1k"),
            C.EMBODIED: F.col("_thousands") * F.col("_tok_g_per_1k"),
        },
    ).drop("_tok_kwh_per_1k", "_tok_g_per_1k", "_thousands")


token_impacts = Operator(
    "tokens", bound("product_code", "amount", "unit", "usage_type"), (C.ENERGY, C.EMBODIED), _tokens, _token_lookup,
    classify=_token_rules,
)


def _load(df: DataFrame, run: Run) -> DataFrame:
    return run.put(df, **{C.CPU_LOAD: run.only_usage(F.lit(run.param("cpu_load_percentage", 50.0)))})


constant_load = Operator("constant_load", lambda provider, layout: [], (C.CPU_LOAD,), _load)

# --- regional factors ---------------------------------------------------------


DEFAULT_PUE = 1.15  # fixed value; the default Azure pipelines set 1.17

# Region factors joined once per run, then read by every regional operator.
_REGION_FIELDS = ("intensity", "wcf", "stress", "pue", "wue", "known")


def with_region_factors(df: DataFrame, run: Run) -> DataFrame:
    """Join the merged region table unless an earlier operator already did."""
    if "_rg_known" in df.columns:
        return df
    df = lookup(df, run.factors.region_dim(run.provider), F.col(C.REGION), "region", "_rg_")
    unnamed = F.when(F.col("_rg_known").isNull(), F.col(C.REGION))
    return run.factors.with_pattern_values(df, run.provider, unnamed)


def _region_lookup(df: DataFrame, run: Run) -> DataFrame:
    """Ahead of all steps only if the region is known by then."""
    return with_region_factors(df, run) if run.placed else df


def without_region_factors(df: DataFrame) -> DataFrame:
    return df.drop(*[f"_rg_{name}" for name in _REGION_FIELDS], "_rp_pue", "_rp_wue")


def region_measure(run: Run, measure: str) -> Column:
    """PUE or WUE of a row's region: by name, else by pattern; NULL without a region."""
    named = F.col(C.REGION)
    if run.provider in run.factors.many_patterns:
        by_pattern = F.col(f"_rp_{measure}")
    else:
        by_pattern = run.factors.pattern_value(run.provider, named, measure)
    return F.when(F.col("_rg_known"), F.col(f"_rg_{measure}")).when(present(named), by_pattern)


def _efficiency(df: DataFrame, run: Run) -> DataFrame:
    df = with_region_factors(df, run)
    pue = F.coalesce(region_measure(run, "pue"), F.lit(run.param("default", DEFAULT_PUE)))
    return run.put(df, **{C.PUE: run.only_usage(pue), C.WUE: region_measure(run, "wue")})


efficiency = Operator("efficiency", lambda provider, layout: [C.REGION], (C.PUE, C.WUE), _efficiency, _region_lookup)


def _water(df: DataFrame, run: Run) -> DataFrame:
    df = with_region_factors(df, run)
    df = df.withColumn("_site", environment.facility_energy(F.col(C.ENERGY), F.col(C.REGION), F.col(C.PUE)))
    df = run.put(
        df,
        **{
            C.WATER_COOLING: F.col("_site") * F.col(C.WUE),
            C.WATER_ELECTRICITY: F.col("_site") * F.col("_rg_wcf"),
        },
    )
    scarce = environment.stressed_water(
        F.col("_site"), F.col(C.WATER_COOLING), F.col(C.WATER_ELECTRICITY), F.col("_rg_stress")
    )
    return run.put(df, **{C.WATER_STRESS: scarce}).drop("_site")


water = Operator(
    "water",
    lambda provider, layout: [C.ENERGY, C.PUE, C.WUE, C.REGION],
    (C.WATER_COOLING, C.WATER_ELECTRICITY, C.WATER_STRESS),
    _water,
    _region_lookup,
)


def _intensity(df: DataFrame, run: Run) -> DataFrame:
    df = with_region_factors(df, run)
    return run.put(df, **{C.INTENSITY: F.when(F.col(C.ENERGY).isNotNull(), F.col("_rg_intensity"))})


carbon_intensity = Operator(
    "carbon_intensity", lambda provider, layout: [C.ENERGY, C.REGION], (C.INTENSITY,), _intensity, _region_lookup
)


def _operational(df: DataFrame, run: Run) -> DataFrame:
    emissions = environment.operational(
        F.col(C.ENERGY),
        F.col(C.INTENSITY),
        F.col(C.PUE),
        run.param("powerSupplyEfficiency", environment.POWER_SUPPLY),
        run.param("powerTransmissionLosses", environment.TRANSMISSION),
    )
    return run.put(df, **{C.OPERATIONAL: emissions})


operational_emissions = Operator(
    "operational_emissions", lambda provider, layout: [C.ENERGY, C.INTENSITY, C.PUE], (C.OPERATIONAL,), _operational
)

# --- FOCUS columns on native reports -------------------------------------------


def _bridge(df: DataFrame, run: Run) -> DataFrame:
    values = bridge.aws(df) if run.provider == C.AWS else bridge.azure(df)
    return run.put(df, **{name: run.only_usage(value) for name, value in values.items()})


def _bridge_needs(provider: str, layout: str) -> list[str]:
    return list(bridge.AWS_NEEDS if provider == C.AWS else bridge.AZURE_NEEDS)


AWS_BRIDGE_COLUMNS = (
    "BilledCost",
    "RegionId",
    "ServiceName",
    "ChargeCategory",
    "SubAccountId",
    "ChargePeriodStart",
    "ChargePeriodEnd",
    "Tags",
    "ListCost",
    "x_ServiceCode",
    "x_Operation",
    "SkuMeter",
)
AZURE_BRIDGE_COLUMNS = (
    "BilledCost",
    "RegionId",
    "ServiceName",
    "ChargeCategory",
    "SubAccountId",
    "ChargePeriodStart",
    "ChargePeriodEnd",
)

aws_bridge = Operator("aws_bridge", _bridge_needs, AWS_BRIDGE_COLUMNS, _bridge)
azure_bridge = Operator("azure_bridge", _bridge_needs, AZURE_BRIDGE_COLUMNS, _bridge)

REGISTRY = {
    op.name: op
    for op in (
        region,
        storage_energy,
        network_energy,
        compute_impacts,
        serverless_energy,
        gpu_energy,
        token_impacts,
        constant_load,
        efficiency,
        water,
        carbon_intensity,
        operational_emissions,
        aws_bridge,
        azure_bridge,
    )
}
