"""Queries over the enrichment operators, row by row."""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import lookup
from gridtally.functions import compute, storage, tokens
from gridtally.functions.common import is_usage
from gridtally.functions.sums import exact_sums
from gridtally.operators import enrich as ops
from gridtally.operators.base import Operator, Run, bound
from gridtally.plans.lineage import contracts
from gridtally.plans.pipelines import Plan, enrich
from gridtally.sources.usage import normalize_product
from gridtally.workload import oracle as O
from gridtally.workload import rows as W
from gridtally.workload.registry import query

IDS = ("order_id", "line_no")
AWS_RUN = Run(C.AWS, C.NATIVE)
AZURE_RUN = Run(C.AZURE, C.NATIVE)

ROWS = {
    (C.AWS, C.NATIVE): W.aws_native,
    (C.AWS, C.FOCUS): W.aws_focus,
    (C.AZURE, C.NATIVE): W.azure_native,
    (C.AZURE, C.FOCUS): W.azure_focus,
}


def partial(
    spark: SparkSession, sf_dir: str, provider: str, layout: str, *steps: Operator, params: dict | None = None
) -> DataFrame:
    """Usage rows run through some of the operators only."""
    plan = Plan(provider, layout, tuple((op, (params or {}).get(op.name, {})) for op in steps))
    return plan.apply(ROWS[provider, layout](spark, sf_dir), W.sample_factors(spark, provider))


@lru_cache(maxsize=16)
def enriched(spark: SparkSession, sf_dir: str, provider: str = C.AWS, layout: str = C.NATIVE) -> DataFrame:
    """The enriched frame, planned once and read by many reports."""
    return enrich(ROWS[provider, layout](spark, sf_dir), provider, layout, W.sample_factors(spark, provider))


def aws_sql(select: str, layout: str = C.NATIVE) -> str:
    return O.with_(*O.aws(layout)) + select


def azure_sql(select: str, layout: str = C.NATIVE) -> str:
    return O.with_(*O.azure(layout)) + select


# --- gate ---------------------------------------------------------------------------


@query(
    "usage_gate",
    O.with_(*O.aws_rows())
    + """SELECT native_charge AS charge, native_charge LIKE '%Usage' AS native_usage,
       focus_charge = 'Usage' AS focus_usage, FALSE AS other_usage, count(*) AS lines FROM u GROUP BY ALL""",
)
def usage_gate(spark, sf_dir):
    lines = W.aws_native(spark, sf_dir)
    focus = F.when(F.col("charge") == "SavingsPlanCoveredUsage", "Purchase").when(
        F.col("charge") == "DiscountedUsage", "Usage"
    )
    return (
        lines.withColumn("charge", F.col("line_item_line_item_type"))
        .withColumn("ChargeCategory", F.coalesce(focus, F.col("charge")))
        .groupBy(
            "charge",
            is_usage(C.AWS, C.NATIVE).alias("native_usage"),
            is_usage(C.AWS, C.FOCUS).alias("focus_usage"),
            is_usage(C.GOOGLE, C.NATIVE).alias("other_usage"),
        )
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "row_rebuild",
    aws_sql(
        f"""SELECT native_charge AS charge, count(*) AS lines, count({C.ENERGY}) AS with_energy,
        count({C.PUE}) AS with_pue, count(region) AS with_region, {O.exact('cost')} AS cost FROM x GROUP BY 1"""
    ),
)
def row_rebuild(spark, sf_dir):
    counts = [
        F.count(F.lit(1)).alias("lines"),
        F.count(C.ENERGY).alias("with_energy"),
        F.count(C.PUE).alias("with_pue"),
        F.count(C.REGION).alias("with_region"),
    ]
    charge = F.col("line_item_line_item_type").alias("charge")
    return exact_sums(enriched(spark, sf_dir), charge, also=counts, cost=F.col("line_item_unblended_cost"))


# --- region ---------------------------------------------------------------------------


@query("region_aws", aws_sql("SELECT order_id, line_no, region FROM g"))
def region_aws(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.region).select(*IDS, C.REGION)


@query("region_azure", azure_sql("SELECT order_id, line_no, region FROM g"))
def region_azure(spark, sf_dir):
    return partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.region).select(*IDS, C.REGION)


@query("region_focus", aws_sql("SELECT order_id, line_no, region FROM g", C.FOCUS))
def region_focus(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.FOCUS, ops.region).select(*IDS, C.REGION)


# --- storage --------------------------------------------------------------------------


@query("storage_class_aws", O.with_(*O.aws_rows()) + f"SELECT order_id, line_no, {O.MEDIA} AS media FROM u")
def storage_class_aws(spark, sf_dir):
    r = AWS_RUN
    media = storage.media(r.col("operation"), r.col("unit"), r.col("usage_type"), r.col("service_code"))
    return W.aws_native(spark, sf_dir).select(*IDS, media.alias("media"))


@query("storage_replication_aws", O.with_(*O.aws_rows()) + f"SELECT order_id, line_no, {O.COPIES} AS copies FROM u")
def storage_replication_aws(spark, sf_dir):
    copies = storage.copies(AWS_RUN.col("service_code"), AWS_RUN.col("usage_type"))
    return W.aws_native(spark, sf_dir).select(*IDS, copies.alias("copies"))


@query("storage_energy_aws", aws_sql(f"SELECT order_id, line_no, storage_kwh AS {C.ENERGY} FROM s"))
def storage_energy_aws(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.storage_energy).select(*IDS, C.ENERGY)


@query(
    "storage_energy_azure",
    azure_sql(f"SELECT order_id, line_no, coalesce(capacity_kwh, disk_kwh) AS {C.ENERGY} FROM s"),
)
def storage_energy_azure(spark, sf_dir):
    return partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.storage_energy).select(*IDS, C.ENERGY)


@query(
    "storage_azure_capacity",
    O.with_(*O.azure_rows()) + f"SELECT order_id, line_no, {O.AZURE_CAPACITY} AS kwh FROM u",
)
def storage_azure_capacity(spark, sf_dir):
    r = AZURE_RUN
    kwh = storage.azure_capacity_energy(r.col("category"), r.col("meter"), r.col("unit"), r.col("amount"))
    return W.azure_native(spark, sf_dir).select(*IDS, kwh.alias("kwh"))


@query(
    "storage_azure_disk",
    azure_sql("SELECT order_id, line_no, sku, disk_kwh AS kwh FROM s WHERE sku IS NOT NULL AND usage"),
)
def storage_azure_disk(spark, sf_dir):
    sku = storage.azure_disk_sku(*[AZURE_RUN.col(n) for n in ("category", "subcategory", "meter")])
    lines = partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.storage_energy)
    return lines.where(is_usage(C.AZURE, C.NATIVE) & sku.isNotNull()).select(
        *IDS, sku.alias("sku"), F.col(C.ENERGY).alias("kwh")
    )


@query(
    "storage_replication_azure",
    O.with_(*O.azure_rows())
    + f"SELECT order_id, line_no, {O.AZURE_COPIES} AS copies FROM u WHERE meter LIKE '%Data Stored%'",
)
def storage_replication_azure(spark, sf_dir):
    meter = AZURE_RUN.col("meter")
    lines = W.azure_native(spark, sf_dir).where(meter.contains("Data Stored"))
    return lines.select(*IDS, storage.azure_copies(meter).alias("copies"))


@query(
    "join_disk_sku",
    azure_sql(
        """SELECT sku, gb, media, count(*) AS lines FROM g LEFT JOIN disk USING (sku)
        WHERE sku IS NOT NULL GROUP BY ALL"""
    ),
)
def join_disk_sku(spark, sf_dir):
    sku = storage.azure_disk_sku(*[AZURE_RUN.col(n) for n in ("category", "subcategory", "meter")])
    disks = W.sample_factors(spark, C.AZURE).disks
    used = W.azure_native(spark, sf_dir).where(sku.isNotNull()).groupBy(sku.alias("sku"))
    return lookup(used.agg(F.count(F.lit(1)).alias("lines")), disks, F.col("sku"), "sku", "_d_").select(
        "sku", F.col("_d_gb").alias("gb"), F.col("_d_media").alias("media"), "lines"
    )


# --- network ----------------------------------------------------------------------------


@query("network_aws", aws_sql(f"SELECT order_id, line_no, {O.SCOPE_NATIVE} AS scope, network_kwh AS {C.ENERGY} FROM s"))
def network_aws(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.network_energy)
    return lines.select(*IDS, ops.transfer_scope(lines, AWS_RUN).alias("scope"), C.ENERGY)


@query(
    "network_aws_focus",
    aws_sql(f"SELECT order_id, line_no, {O.SCOPE_FOCUS} AS scope, network_kwh AS {C.ENERGY} FROM s", C.FOCUS),
)
def network_aws_focus(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.FOCUS, ops.network_energy)
    return lines.select(*IDS, ops.transfer_scope(lines, Run(C.AWS, C.FOCUS)).alias("scope"), C.ENERGY)


@query(
    "network_azure",
    azure_sql(f"SELECT order_id, line_no, {O.SCOPE_AZURE} AS scope, network_kwh AS {C.ENERGY} FROM s"),
)
def network_azure(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.network_energy)
    return lines.select(*IDS, ops.transfer_scope(lines, AZURE_RUN).alias("scope"), C.ENERGY)


@query("normalize_product_map", aws_sql(f"SELECT order_id, line_no, network_kwh AS {C.ENERGY} FROM s"))
def normalize_product_map(spark, sf_dir):
    """The product column arrives as key/value structs and is made a map again."""
    lines = W.aws_native(spark, sf_dir).withColumn("product", F.map_entries("product"))
    plan = Plan(C.AWS, C.NATIVE, ((ops.network_energy, {}),))
    return plan.apply(normalize_product(lines), W.sample_factors(spark, C.AWS)).select(*IDS, C.ENERGY)


@query("product_structs", aws_sql(f"SELECT order_id, line_no, network_kwh AS {C.ENERGY} FROM s"))
def product_structs(spark, sf_dir):
    """The product column stays key/value structs and is read as it is."""
    lines = W.aws_native(spark, sf_dir).withColumn("product", F.map_entries("product"))
    plan = Plan(C.AWS, C.NATIVE, ((ops.network_energy, {}),))
    return plan.apply(lines, W.sample_factors(spark, C.AWS)).select(*IDS, C.ENERGY)


# --- compute --------------------------------------------------------------------------------


@query("instance_type_aws", aws_sql("SELECT order_id, line_no, vm_type FROM g WHERE vm_type IS NOT NULL"))
def instance_type_aws(spark, sf_dir):
    kind = ops.instance_type(AWS_RUN)
    return W.aws_native(spark, sf_dir).where(kind.isNotNull()).select(*IDS, kind.alias("vm_type"))


@query(
    "instance_type_from_meter",
    O.with_(*O.aws_rows()) + f"SELECT order_id, line_no, {O.METER_TYPE} AS meter_type FROM u",
)
def instance_type_from_meter(spark, sf_dir):
    kind = compute.type_from_meter(F.col("line_item_usage_type"))
    return W.aws_native(spark, sf_dir).select(*IDS, kind.alias("meter_type"))


@query(
    "instance_type_azure",
    azure_sql("SELECT order_id, line_no, vm_type FROM g WHERE vm_type IS NOT NULL"),
)
def instance_type_azure(spark, sf_dir):
    kind = F.when(F.col("Quantity").isNotNull(), ops.instance_type(AZURE_RUN))
    return W.azure_native(spark, sf_dir).where(kind.isNotNull()).select(*IDS, kind.alias("vm_type"))


@query(
    "compute_impacts",
    aws_sql(
        f"SELECT order_id, line_no, vm_kwh AS {C.ENERGY}, vm_g AS {C.EMBODIED}, {C.DEPLETION} FROM s"
    ),
)
def compute_impacts(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.compute_impacts).select(*IDS, C.ENERGY, C.EMBODIED, C.DEPLETION)


@query(
    "compute_impacts_azure",
    azure_sql(f"SELECT order_id, line_no, vm_kwh AS {C.ENERGY}, {C.EMBODIED}, {C.DEPLETION} FROM s"),
)
def compute_impacts_azure(spark, sf_dir):
    return partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.compute_impacts).select(
        *IDS, C.ENERGY, C.EMBODIED, C.DEPLETION
    )


@query(
    "join_compute_factor",
    aws_sql(
        f"""SELECT vm_type, count(*) AS lines, count(vm_kwh) AS modelled, {O.exact('vm_kwh')} AS kwh,
        {O.exact('vm_g')} AS embodied_g FROM s WHERE vm_type IS NOT NULL GROUP BY 1"""
    ),
)
def join_compute_factor(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.compute_impacts)
    kind = ops.instance_type(AWS_RUN)
    counts = [F.count(F.lit(1)).alias("lines"), F.count(C.ENERGY).alias("modelled")]
    sums = {"kwh": F.col(C.ENERGY), "embodied_g": F.col(C.EMBODIED)}
    return exact_sums(lines.where(kind.isNotNull()), kind.alias("vm_type"), also=counts, **sums)


@query(
    "serverless_fargate",
    aws_sql(f"SELECT order_id, line_no, serverless_kwh AS {C.ENERGY} FROM s WHERE operation = 'FargateTask'"),
)
def serverless_fargate(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.serverless_energy)
    return lines.where("line_item_operation = 'FargateTask'").select(*IDS, C.ENERGY)


@query(
    "serverless_emr",
    aws_sql(f"SELECT order_id, line_no, serverless_kwh AS {C.ENERGY} FROM s WHERE operation IS DISTINCT FROM 'FargateTask'"),
)
def serverless_emr(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.serverless_energy)
    return lines.where("NOT line_item_operation <=> 'FargateTask'").select(*IDS, C.ENERGY)


@query(
    "gpu_energy",
    aws_sql(
        f"""SELECT order_id, line_no, CASE WHEN gpu_kwh IS NULL THEN vm_kwh ELSE gpu_kwh + coalesce(vm_kwh, 0E0) END
        AS {C.ENERGY} FROM s"""
    ),
)
def gpu_energy(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.compute_impacts, ops.gpu_energy).select(*IDS, C.ENERGY)


@query(
    "join_gpu",
    aws_sql(
        f"""SELECT gpu_type AS instance_type, count(*) AS lines, count(gpu_kwh) AS modelled,
        {O.exact('gpu_kwh')} AS kwh FROM s WHERE gpu_type IS NOT NULL GROUP BY 1"""
    ),
)
def join_gpu(spark, sf_dir):
    kind = compute.gpu_type(AWS_RUN.col("product_code"), AWS_RUN.col("operation"), ops.raw_instance_type(AWS_RUN))
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.gpu_energy)
    counts = [F.count(F.lit(1)).alias("lines"), F.count(C.ENERGY).alias("modelled")]
    return exact_sums(lines.where(kind.isNotNull()), kind.alias("instance_type"), also=counts, kwh=F.col(C.ENERGY))


# --- generated text -----------------------------------------------------------------------------


@query(
    "llm_energy",
    aws_sql(
        f"""SELECT order_id, line_no, token_kwh AS {C.ENERGY}, token_g AS {C.EMBODIED} FROM s
        WHERE product_code = 'AmazonBedrock'"""
    ),
)
def llm_energy(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.token_impacts)
    return lines.where("line_item_product_code = 'AmazonBedrock'").select(*IDS, C.ENERGY, C.EMBODIED)


@query(
    "llm_parse_usage",
    O.with_(*O.aws_rows())
    + f"SELECT usage_type, {O.TOKEN_MODEL} AS model_key, {O.TOKEN_DIRECTION} AS direction, count(*) AS lines FROM u GROUP BY ALL",
)
def llm_parse_usage(spark, sf_dir):
    usage_type = F.col("line_item_usage_type")
    return (
        W.aws_native(spark, sf_dir)
        .groupBy(
            usage_type.alias("usage_type"),
            tokens.model_key(usage_type).alias("model_key"),
            tokens.direction(usage_type).alias("direction"),
        )
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "llm_token_multiplier",
    O.with_(*O.aws_rows()) + f"SELECT unit, {O.TOKENS_PER_UNIT} AS tokens, count(*) AS lines FROM u GROUP BY ALL",
)
def llm_token_multiplier(spark, sf_dir):
    unit = F.col("pricing_unit")
    lines = W.aws_native(spark, sf_dir).groupBy(unit.alias("unit"), tokens.tokens_per_unit(unit).alias("tokens"))
    return lines.agg(F.count(F.lit(1)).alias("lines"))


@query(
    "join_llm_coeff",
    aws_sql(
        """SELECT label, kwh_per_1k, g_per_1k, count(*) AS lines FROM g LEFT JOIN token_dim USING (label)
        WHERE label IS NOT NULL GROUP BY ALL"""
    ),
)
def join_llm_coeff(spark, sf_dir):
    usage_type = F.col("line_item_usage_type")
    billed = (F.col("line_item_product_code") == "AmazonBedrock") & (tokens.direction(usage_type) == "output")
    label = F.when(billed, F.lower(tokens.model_key(usage_type)))
    used = (
        W.aws_native(spark, sf_dir).where(label.isNotNull()).groupBy(label.alias("label"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    dim = W.sample_factors(spark, C.AWS).token_dim()
    return lookup(used, dim, F.col("label"), "label", "_t_").select(
        "label", F.col("_t_kwh_per_1k").alias("kwh_per_1k"), F.col("_t_g_per_1k").alias("g_per_1k"), "lines"
    )


# --- load and regional factors --------------------------------------------------------------------


@query("constant_cpu_load", aws_sql(f"SELECT order_id, line_no, CASE WHEN usage THEN 60E0 END AS {C.CPU_LOAD} FROM g"))
def constant_cpu_load(spark, sf_dir):
    given = {"constant_load": {"cpu_load_percentage": 60}}
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.constant_load, params=given).select(*IDS, C.CPU_LOAD)


@query("pue_wue", aws_sql(f"SELECT order_id, line_no, {C.PUE}, {C.WUE} FROM x"))
def pue_wue(spark, sf_dir):
    return partial(spark, sf_dir, C.AWS, C.NATIVE, ops.region, ops.efficiency).select(*IDS, C.PUE, C.WUE)


@query("pue_wue_azure", azure_sql(f"SELECT order_id, line_no, {C.PUE}, {C.WUE} FROM x"))
def pue_wue_azure(spark, sf_dir):
    given = {"efficiency": {"default": "1.17"}}
    return partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.region, ops.efficiency, params=given).select(
        *IDS, C.PUE, C.WUE
    )


@query("join_region_pattern", aws_sql("SELECT region, pue, wue FROM regf"))
def join_region_pattern(spark, sf_dir):
    used = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.region).where("region <> ''").select(C.REGION).distinct()
    run = Run(C.AWS, C.NATIVE, W.sample_factors(spark, C.AWS))
    return ops.with_region_factors(used, run).select(
        C.REGION, ops.region_measure(run, "pue").alias("pue"), ops.region_measure(run, "wue").alias("wue")
    )


# Efficiency patterns, one for each part, and a region for each customer: more than can be tried one by one.
_MANY_PATTERNS = """
SELECT CAST(p_partkey AS INT) AS ordinal,
  CASE p_partkey % 4 WHEN 0 THEN concat('r', p_partkey % 25, '-', p_partkey % 97, '.*')
    WHEN 1 THEN concat('r', p_partkey % 25, '-[0-9]+', substr('abc', CAST(p_partkey % 3 + 1 AS INT), 1))
    WHEN 2 THEN concat('.+-', p_partkey % 97, 'a')
    ELSE concat('r', p_partkey % 23, '-1+|r', p_partkey % 25, '-2.') END AS region,
  CASE WHEN p_partkey % 5 > 0 THEN CAST(1 + p_size / 64.0 AS DOUBLE) END AS pue,
  CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size / 64.0 AS DOUBLE) END AS wue
FROM part"""
_MANY_REGIONS = """
SELECT DISTINCT concat('r', c_nationkey, '-', c_custkey % 193, substr('abcd', CAST(c_custkey % 4 + 1 AS INT), 1)) AS region
FROM customer"""


@query(
    "join_many_patterns",
    f"""
WITH patterns AS ({_MANY_PATTERNS}), regions AS ({_MANY_REGIONS})
SELECT r.region, min_by(p.pue, p.ordinal) FILTER (p.pue IS NOT NULL) AS pue,
  min_by(p.wue, p.ordinal) FILTER (p.wue IS NOT NULL) AS wue
FROM regions r LEFT JOIN patterns p ON regexp_full_match(r.region, p.region) GROUP BY r.region""",
)
def join_many_patterns(spark, sf_dir):
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("part", "customer")}
    patterns = spark.sql(_MANY_PATTERNS.replace("FROM part", "FROM {part}"), part=tables["part"])
    used = spark.sql(_MANY_REGIONS.replace("FROM customer", "FROM {customer}"), customer=tables["customer"])
    run = Run(C.AWS, C.NATIVE, W.sample_factors(spark, C.AWS).with_efficiency(C.AWS, patterns))
    return ops.with_region_factors(used.withColumnRenamed("region", C.REGION), run).select(
        F.col(C.REGION).alias("region"), ops.region_measure(run, "pue").alias("pue"), ops.region_measure(run, "wue").alias("wue")
    )


@query(
    "join_region_factors",
    aws_sql("SELECT region, intensity, wcf, stress, count(*) AS lines FROM g JOIN regf USING (region) GROUP BY ALL"),
)
def join_region_factors(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.region).where("region <> ''")
    used = lines.groupBy(C.REGION).agg(F.count(F.lit(1)).alias("lines"))
    run = Run(C.AWS, C.NATIVE, W.sample_factors(spark, C.AWS))
    return ops.with_region_factors(used, run).select(
        C.REGION,
        F.col("_rg_intensity").alias("intensity"),
        F.col("_rg_wcf").alias("wcf"),
        F.col("_rg_stress").alias("stress"),
        "lines",
    )


def impacts(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return enriched(spark, sf_dir).select(*IDS, *names)


for _name, _columns in {
    "carbon_intensity": (C.INTENSITY,),
    "operational_emissions": (C.OPERATIONAL,),
    "water_cooling": (C.WATER_COOLING,),
    "water_electricity": (C.WATER_ELECTRICITY,),
    "water_stress": (C.WATER_STRESS,),
    "energy_precedence": (C.ENERGY, C.EMBODIED),
}.items():
    query(_name, aws_sql(f"SELECT order_id, line_no, {', '.join(_columns)} FROM x"))(
        lambda spark, sf_dir, _columns=_columns: impacts(spark, sf_dir, *_columns)
    )


# --- bridges ------------------------------------------------------------------------------------------


@query(
    "focus_bridge_aws",
    aws_sql(
        """SELECT order_id, line_no, CASE WHEN usage THEN cost END AS "BilledCost",
        CASE WHEN usage THEN list_cost END AS "ListCost", lower(region) AS "RegionId",
        CASE WHEN usage THEN nullif(service_code, '') END AS "ServiceName",
        CASE WHEN usage THEN nullif(product_code, '') END AS "x_ServiceCode",
        CASE WHEN usage THEN nullif(operation, '') END AS "x_Operation",
        CASE WHEN usage THEN nullif(usage_type, '') END AS "SkuMeter",
        CASE WHEN usage THEN nullif(native_charge, '') END AS "ChargeCategory",
        CASE WHEN usage THEN CAST(l_suppkey % 6 AS VARCHAR) END AS "SubAccountId",
        CASE WHEN usage THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') END AS "ChargePeriodStart",
        CASE WHEN usage THEN strftime(l_shipdate + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS "ChargePeriodEnd",
        CASE WHEN usage THEN team END AS tag_team, CASE WHEN usage THEN env END AS tag_env FROM g"""
    ),
)
def focus_bridge_aws(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AWS, C.NATIVE, ops.region, ops.aws_bridge)
    kept = [c for c in ops.AWS_BRIDGE_COLUMNS if c != "Tags"]
    return lines.select(*IDS, *kept, F.col("Tags")["team"].alias("tag_team"), F.col("Tags")["env"].alias("tag_env"))


@query(
    "focus_bridge_azure",
    azure_sql(
        """SELECT order_id, line_no, CASE WHEN usage THEN cost END AS "BilledCost", region AS "RegionId",
        CASE WHEN usage THEN category END AS "ServiceName", CASE WHEN usage THEN native_charge END AS "ChargeCategory",
        CASE WHEN usage THEN CAST(l_suppkey % 6 AS VARCHAR) END AS "SubAccountId",
        CASE WHEN usage THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS "ChargePeriodStart",
        CASE WHEN usage THEN CAST(CAST(l_shipdate AS DATE) + 1 AS VARCHAR) END AS "ChargePeriodEnd" FROM g"""
    ),
)
def focus_bridge_azure(spark, sf_dir):
    lines = partial(spark, sf_dir, C.AZURE, C.NATIVE, ops.region, ops.azure_bridge)
    return lines.select(*IDS, *ops.AZURE_BRIDGE_COLUMNS)


# --- whole plans -----------------------------------------------------------------------------------------

IMPACTS = (
    C.REGION,
    C.ENERGY,
    C.INTENSITY,
    C.OPERATIONAL,
    C.EMBODIED,
    C.DEPLETION,
    C.PUE,
    C.WUE,
    C.WATER_COOLING,
    C.WATER_ELECTRICITY,
    C.WATER_STRESS,
)
_ALL = f"SELECT order_id, line_no, {', '.join(IMPACTS)} FROM x"

for _name, _provider, _layout, _sql in (
    ("enrich_aws", C.AWS, C.NATIVE, aws_sql(_ALL)),
    ("enrich_aws_focus", C.AWS, C.FOCUS, aws_sql(_ALL, C.FOCUS)),
    ("enrich_azure", C.AZURE, C.NATIVE, azure_sql(_ALL)),
    ("enrich_azure_focus", C.AZURE, C.FOCUS, azure_sql(_ALL, C.FOCUS)),
):
    query(_name, _sql)(
        lambda spark, sf_dir, _provider=_provider, _layout=_layout: enriched(spark, sf_dir, _provider, _layout).select(
            *IDS, *IMPACTS
        )
    )


@query(
    "configured_plan",
    aws_sql(
        f"""SELECT order_id, line_no, CASE WHEN usage THEN coalesce(
            amount * (CASE {O.SCOPE_NATIVE} WHEN 'intra' THEN 0.002E0 WHEN 'inter' THEN 0.0015E0 WHEN 'extra' THEN 0.06E0 END),
            storage_kwh) END AS {C.ENERGY}, CASE WHEN usage THEN coalesce(regf.pue, 1.3E0) END AS {C.PUE}
        FROM s LEFT JOIN regf USING (region)"""
    ),
)
def configured_plan(spark, sf_dir):
    """A plan read from JSON, with parameters of its own."""
    text = json.dumps(
        {
            "modules": [
                {"name": "region"},
                {"name": "storage", "config": {"hdd_coefficient_tb_h": 0.65}},
                {"name": "network", "config": {"network_coefficients_kwh_gb": {"intra": 0.002, "extra": 0.06}}},
                {"name": "efficiency", "config": {"default": "1.3"}},
            ]
        }
    )
    plan = Plan.from_json(text, C.AWS)
    lines = plan.apply(W.aws_native(spark, sf_dir), W.sample_factors(spark, C.AWS))
    return lines.select(*IDS, C.ENERGY, C.PUE)


def _night_share(df: DataFrame, run: Run) -> DataFrame:
    return run.put(df, night_kwh=F.col(C.ENERGY) * F.lit(run.param("share", 0.25)))


night_share = Operator("night_share", bound(extra=(C.ENERGY,)), ("night_kwh",), _night_share, types={"night_kwh": "double"})


@query(
    "operator_protocol",
    aws_sql(f"SELECT order_id, line_no, storage_kwh AS {C.ENERGY}, storage_kwh * 0.5E0 AS night_kwh FROM s"),
)
def operator_protocol(spark, sf_dir):
    """A user's own operator in a plan, after a registered one."""
    text = json.dumps({"modules": [{"name": "storage"}, {"name": "night_share", "config": {"share": 0.5}}]})
    plan = Plan.from_json(text, C.AWS, extra={"night_share": night_share})
    lines = plan.apply(W.aws_native(spark, sf_dir), W.sample_factors(spark, C.AWS))
    return lines.select(*IDS, C.ENERGY, "night_kwh")


@query(
    "seed_null_columns",
    aws_sql(
        f"""SELECT native_charge AS charge, count(*) AS lines, count(region) AS regions, count({C.ENERGY}) AS energies
        FROM x GROUP BY 1"""
    ),
)
def seed_null_columns(spark, sf_dir):
    """Input columns named like result columns, whatever their case, are overwritten."""
    lines = W.aws_native(spark, sf_dir).withColumns({"Region": F.lit("moon"), C.ENERGY: F.lit(1.0)})
    plan = Plan.default(C.AWS)
    return (
        plan.apply(lines, W.sample_factors(spark, C.AWS))
        .groupBy(F.col("line_item_line_item_type").alias("charge"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count(C.REGION).alias("regions"),
            F.count(C.ENERGY).alias("energies"),
        )
    )


# --- contracts ----------------------------------------------------------------------

#: Plans of landed reports: two sound ones, and one whose steps come in the wrong order.
CONTRACT_PLANS = {
    "aws": Plan.default(C.AWS),
    "azure": Plan.default(C.AZURE),
    "backwards": Plan(C.AWS, C.NATIVE, tuple(reversed(Plan.default(C.AWS).steps))),
}


def _contract_columns() -> list[str]:
    needed = {c for plan in CONTRACT_PLANS.values() for op, _ in plan.steps for c in op.needs(plan.provider, plan.layout)}
    return sorted(needed - {c for plan in CONTRACT_PLANS.values() for op, _ in plan.steps for c in op.adds})


def _contract_sql() -> str:
    steps = [(name, n, op, plan) for name, plan in CONTRACT_PLANS.items() for n, (op, _) in enumerate(plan.steps)]
    needs = [(name, n, op.name, c) for name, n, op, plan in steps for c in op.needs(plan.provider, plan.layout)]
    adds = [(name, n, op.name, c) for name, n, op, _ in steps for c in op.adds]
    return O.with_(
        O.values("needs", "plan, step_no, step, needed", needs),
        O.values("adds", "plan, step_no, step, added", adds),
        O.values("places", "name, place", [(c, n) for n, c in enumerate(_contract_columns())]),
        """reports AS (SELECT c_custkey AS report,
          CASE c_custkey % 4 WHEN 0 THEN 'aws' WHEN 1 THEN 'azure' WHEN 2 THEN 'backwards' ELSE 'none' END AS plan FROM customer)""",
        """providers AS (SELECT r.report, r.plan, n.step_no, n.step, n.needed, coalesce(
            (SELECT arg_max(a.step, a.step_no) FROM adds a WHERE a.plan = n.plan AND a.added = n.needed AND a.step_no < n.step_no),
            (SELECT max('(input)') FROM places p WHERE p.name = n.needed AND r.report % (p.place + 5) <> 0)) AS provider
          FROM reports r LEFT JOIN needs n ON n.plan = r.plan)""",
    ) + "SELECT *, provider IS NULL AS missing FROM providers"


@query("check_contract", _contract_sql())
def check_contract(spark, sf_dir):
    """One landed report for each customer; which columns it lacks goes by the customer's number."""
    names = [
        F.when(F.col("c_custkey") % (n + 5) != 0, F.lit(name)) for n, name in enumerate(_contract_columns())
    ]
    plan = F.get(F.array(*map(F.lit, (*CONTRACT_PLANS, "none"))), (F.col("c_custkey") % 4).cast("int"))
    reports = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("report"), plan.alias("plan"), F.array_compact(F.array(*names)).alias("columns")
    )
    return contracts(reports, CONTRACT_PLANS)
