"""Usage rows worked out from the driver's order tables.

The tables hold no billing data. Each order line becomes one usage line: its part
number picks what was billed, its supplier where, its flags the kind of charge,
its quantity and price the amount and cost. Everything is a projection over the
line-item scan with two small lookups, so work grows with the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import COMPUTE_SCHEMA, TOKEN_SCHEMA, Factors, values_frame
from gridtally.operators.split import INTERVAL, PARENT, RATIO, RESOURCE

# product code, service code, operation, usage type, unit, instance type, transfer type
AWS_SHAPES = [
    ("AmazonEC2", "AmazonEC2", "CreateVolume-Gp3", "EUW2-EBS:VolumeUsage.gp3", "GB-Mo", None, None),
    ("AmazonEC2", "AmazonEC2", "CreateVolume", "EUW2-EBS:VolumeUsage", "GB-Mo", None, None),
    ("AmazonEC2", "AmazonEC2", "CreateSnapshot", "EBS:SnapshotUsage", "GB-Month", None, None),
    ("AmazonS3", "AmazonS3", "StandardStorage", "EUW2-TimedStorage-ByteHrs", "GB-Mo", None, None),
    ("AmazonS3", "AmazonS3", "OneZoneIAStorage", "TimedStorage-ZIA-ByteHrs", "GB-Mo", None, None),
    ("AmazonS3", "AmazonS3", "PutObject", "Requests-Tier1", "Requests", None, None),
    ("AmazonEFS", "AmazonEFS", "Storage", "TimedStorage-ByteHrs", "GB-Mo", None, None),
    ("AmazonEFS", "AmazonEFS", "Storage", "TimedStorage-ZIA-ByteHrs", "GB-Mo", None, None),
    ("AmazonRDS", "AmazonRDS", "CreateDBInstance:0014", "RDS:Multi-AZ-StorageUsage", "GB-Mo", None, None),
    ("AmazonRDS", "AmazonRDS", "CreateDBCluster", "Aurora:StorageUsage", "GB-Mo", None, None),
    ("AmazonRDS", "AmazonRDS", "CreateDBInstance:0002", "RDS:ChargedBackupUsage", "GB-Mo", None, None),
    ("AmazonDocDB", "AmazonDocDB", "CreateCluster", "BackupUsage", "GB-Mo", None, None),
    ("AmazonDocDB", "AmazonDocDB", "CreateCluster", "StorageUsage", "GB-Mo", None, None),
    ("AmazonDynamoDB", "AmazonDynamoDB", "StandardStorage", "TimedStorage-ByteHrs", "GB-Mo", None, None),
    ("AmazonECR", "AmazonECR", "TimedStorage-ByteHrs", "EUW2-TimedStorage-ByteHrs", "GB-Mo", None, None),
    ("AmazonElastiCache", "AmazonElastiCache", "CreateSnapshot", "ElastiCache:BackupUsage", "GB-month", None, None),
    ("AmazonSimpleDB", "AmazonSimpleDB", "Storage", "TimedStorage-ByteHrs", "GB-Months", None, None),
    ("AmazonKinesis", "AmazonKinesisAnalytics", "RunApplication", "RunningApplicationStorage", "GB-Hours", None, None),
    ("AmazonS3", "AmazonS3", None, "EUW2-TimedStorage-ByteHrs", "GB-Mo", None, None),
    ("AmazonEC2", "AWSDataTransfer", "PublicIP-Out", "EUW2-USE1-AWS-Out-Bytes", "GB", None, "InterRegion Outbound"),
    ("AmazonEC2", "AWSDataTransfer", "LoadBalancing", "EUW2-DataTransfer-Regional-Bytes", "GB", None, "IntraRegion"),
    ("AmazonEC2", "AWSDataTransfer", "PublicIP-Out", "EUW2-DataTransfer-Out-Bytes", "GB", None, "AWS Outbound"),
    ("AmazonEC2", "AWSDataTransfer", "PublicIP-In", "EUW2-DataTransfer-In-Bytes", "GB", None, "AWS Inbound"),
    ("AWSGlobalAccelerator", "AWSDataTransfer", "Flow", "GlobalAccelerator-Bytes", "GB", None, "Accelerator"),
    ("AmazonCloudFront", "AmazonCloudFront", "GET", "EU-DataTransfer-Out-Bytes", "GB", None, "CloudFront Outbound"),
    ("AmazonS3", "AWSDataTransfer", "GetObject", "EUW2-CloudFront-Out-Bytes", "GB", None, "InterRegion Outbound"),
    ("AmazonEC2", "AWSDataTransfer", "LoadBalancing", "EUW2-DataTransfer-xAZ-In-Bytes", "GB", None, None),
    ("AmazonEC2", "AmazonEC2", "RunInstances", "EUW2-BoxUsage:m5.xlarge", "Hrs", "m5.xlarge", None),
    ("AmazonEC2", "AmazonEC2", "RunInstances:SV001", "EUW2-SpotUsage:t3.micro", "Hrs", "t3.micro", None),
    ("AmazonEC2", "AmazonEC2", "RunInstances", "EUW2-BoxUsage:g5.xlarge", "Hrs", "g5.xlarge", None),
    ("AmazonEC2", "AmazonEC2", "RunInstances", "BoxUsage:p3.8xlarge", "Hrs", "p3.8xlarge", None),
    ("AmazonEC2", "AmazonEC2", "RunInstances", "BoxUsage:x9.unknown", "Hrs", "x9.unknown", None),
    ("AmazonES", "AmazonES", "ESDomain", "ESInstance:m5.large.search", "Hrs", "m5.large.search", None),
    ("AmazonRDS", "AmazonRDS", "CreateDBInstance:0014", "InstanceUsage:db.r5.large", "Hrs", "db.r5.large", None),
    ("AmazonEC2", "AWSDataTransfer", "RunInstances", "USE1-AWS-In-Bytes", "GB", "g4dn.xlarge", "InterRegion Inbound"),
    ("AmazonECS", "AmazonECS", "FargateTask", "EUW2-Fargate-GB-Hours", "GB-Hours", None, None),
    ("AmazonECS", "AmazonECS", "FargateTask", "EUW2-Fargate-vCPU-Hours:perCPU", "hours", None, None),
    ("AmazonECS", "AmazonECS", "FargateTask", "EUW2-Fargate-ARM-vCPU-Hours:perCPU", "hours", None, None),
    ("ElasticMapReduce", "ElasticMapReduce", "JobRun", "EUW2-EMR-SERVERLESS-MemoryGBHours", "GB-Hours", None, None),
    ("ElasticMapReduce", "ElasticMapReduce", "JobRun", "EUW2-EMR-SERVERLESS-vCPUHours", "vCPU-Hours", None, None),
    ("ElasticMapReduce", "ElasticMapReduce", "JobRun", "EUW2-EMR-SERVERLESS-ARM-vCPUHours", "vCPU-Hours", None, None),
    ("AmazonBedrock", "AmazonBedrock", "Invoke", "EUW2-Mistral7B-output-tokens", "1K tokens", None, None),
    ("AmazonBedrock", "AmazonBedrock", "Invoke", "EU-MistralLarge-Output-Tokens-batch", "1M tokens", None, None),
    ("AmazonBedrock", "AmazonBedrock", "Invoke", "USE1-Mixtral8x7B-input-tokens", "1K tokens", None, None),
    ("AmazonBedrock", "AmazonBedrock", "Invoke", "USE1-Nova-Pro-output-tokens", None, None, None),
    ("AWSSupportBusiness", "AWSSupportBusiness", "", "Dollar", "Dollar", None, None),
    ("AWSConfig", "", "None", None, "ConfigRuleEvaluations", None, None),
]

# product region, from region, to region
AWS_REGIONS = [
    ("us-east-1", None, None),
    ("us-west-1", "us-east-1", None),
    ("eu-west-2", None, "us-east-1"),
    ("ap-south-1", None, None),
    ("us-gov-west-1", None, None),
    ("ap-southeast-2", None, None),
    ("EU-WEST-1", None, None),
    ("me-central-1", None, None),
    ("cn-north-1", None, None),
    ("xx-nowhere-9", None, None),
    ("eu-isoe-west-1", None, None),
    ("", None, None),
    (None, "eu-north-1", "us-west-2"),
    (None, None, "sa-east-1"),
    (None, None, None),
]

# category, subcategory, meter, unit
AZURE_SHAPES = [
    ("Storage", "Tables", "LRS Data Stored", "1 GB/Month"),
    ("Storage", "Blob Storage", "RA-GRS Data Stored", "10 GB/Month"),
    ("Storage", "Blob Storage", "GZRS Data Stored", "100 GB/Month"),
    ("Storage", "Blob Storage", "ZRS Data Stored", "1 TB/Month"),
    ("Storage", "Blob Storage", "Cool Data Stored", "1 GB/Month"),
    ("Storage", "Blob Storage", "LRS Data Stored", "10K"),
    ("Storage", "Standard SSD Managed Disks", "E2 LRS Disk", "1/Month"),
    ("Storage", "Standard HDD Managed Disks", "S4 LRS Disk", "1 /Month"),
    ("Storage", "Premium SSD Managed Disks", "P30 ZRS Disk Mount", "1/Month"),
    ("Storage", "Premium SSD Managed Disks", "P99 LRS Disk", "1/Month"),
    ("Storage", "Standard HDD Managed Disks", "S4 Disk Operations", "10K"),
    ("Storage", "Standard SSD Managed Disks", "E10 LRS Disk", "100/Month"),
    ("Storage", None, "E2 LRS Disk", "1/Month"),
    ("Storage", "Tables", None, "1 GB/Month"),
    ("Bandwidth", "Inter-Region", "Intra Continent Data Transfer Out", "1 GB"),
    ("Bandwidth", "Rtn Preference: MGN", "Standard Data Transfer Out", "1 GB"),
    ("Bandwidth", "Rtn Preference: ISP", "Standard Data Transfer Out", "1 GB"),
    ("Bandwidth", "Content Delivery", "Standard Data Transfer In", "1 GB"),
    ("Bandwidth", None, "Standard Data Transfer In", "1 GB"),
    ("Virtual Machines", "Dv3 Series", "D2s v3", "1 Hour"),
    ("Virtual Machines", "Ev3 Series", "E2 v3/E2s v3", "1 Hour"),
    ("Virtual Machines", "Fsv2 Series", " F4s v2 ", "1 Hour"),
    ("Virtual Machines", "Dv3 Series", "D4s v3", "10 Hours"),
    ("Virtual Machines", "Zz Series", "Z1 v9", "1 Hour"),
    ("Azure Monitor", "Log Analytics", "Data Ingestion", "1 GB"),
]

AZURE_REGIONS = ["EastUS", "westeurope", "SouthIndia", "uksouth", "spaincentral", "chinanorth", "unknownland", "", None]

# Hourly impacts used in trials, not measured ones: type, kWh, g CO2e, g Sb eq.
SAMPLE_AWS_COMPUTE = [
    ("t3.micro", 0.001, 5.0, 0.0001),
    ("m5.large", 0.0125, 1.75, 0.000375),
    ("m5.xlarge", 0.025, 3.5, 0.00075),
    ("r5.large", 0.01875, 2.25, 0.0005),
    ("g5.xlarge", 0.0625, 8.5, 0.00125),
    ("c5.xlarge", 0.0225, 3.125, 0.000625),
]
SAMPLE_AZURE_COMPUTE = [
    ("d2s_v3", 0.003055558, 0.46, 0.000058),
    ("d4s_v3", 0.006388894, 0.9, 0.000116),
    ("e2s_v3", 0.003888892, 0.79, 0.000082),
    ("f4s_v2", 0.00555556, 0.61, 0.000093),
]
# Per thousand output tokens, for trials: provider, model, kWh, kg CO2e, kg Sb eq.
SAMPLE_TOKENS = [
    ("huggingface_hub", "mistralai/Mistral-7B-v0.3", 0.00005090966, 1.627604e-11, 9.116565e-16),
    ("mistralai", "mistral-large-latest", 0.000599246, 0.00001858066, 1.040743e-09),
    ("mistralai", "open-mixtral-8x22b", 0.0004, 0.00001, 1e-09),
]

AWS_SHAPE_SCHEMA = (
    "shape int, product_code string, service_code string, operation string, usage_type string, unit string, "
    "instance_type string, transfer_type string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=4)
def sample_factors(spark: SparkSession, provider: str) -> Factors:
    """The fixed tables and the sample coefficients, made once per session."""
    rows = SAMPLE_AZURE_COMPUTE if provider == C.AZURE else SAMPLE_AWS_COMPUTE
    return (
        Factors.default(spark)
        .with_compute(values_frame(spark, rows, COMPUTE_SCHEMA))
        .with_tokens(values_frame(spark, SAMPLE_TOKENS, TOKEN_SCHEMA))
    )


def numbered(rows: Sequence[object]) -> list[tuple]:
    return [(n, *(row if isinstance(row, tuple) else (row,))) for n, row in enumerate(rows)]


def charge(other: str) -> Column:
    """Kind of charge from the order line's flags; ``other`` names the two special ones."""
    flags = F.concat("l_returnflag", "l_linestatus")
    special = (
        F.when(flags == "NF", "SavingsPlanCoveredUsage").when(flags == "NO", "DiscountedUsage")
        if other == "native"
        else F.when(flags == "NF", "Purchase")
    )
    return F.when(flags == "RO", "Tax").otherwise(F.coalesce(special, F.lit("Usage")))


def amount() -> Column:
    return F.when(F.col("l_tax") < 0.075, F.col("l_quantity"))


def cost() -> Column:
    return F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))


def team() -> Column:
    return F.when(F.col("l_linenumber") <= 6, F.concat(F.lit("team-"), (F.col("l_orderkey") % 50).cast("string")))


def tags() -> Column:
    """Resource tags; lines without a team have no tag of that key, and some none at all."""
    env = F.when(F.col("l_partkey") % 3 == 0, "prod").when(F.col("l_partkey") % 3 == 1, "").otherwise("dev")
    both = F.create_map(F.lit("team"), team(), F.lit("env"), env)
    return F.when(F.col("l_discount") <= 0.085, F.map_filter(both, lambda key, value: value.isNotNull()))


def period() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM")


def aws_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of an AWS cost and usage report."""
    shapes = values_frame(spark, numbered(AWS_SHAPES), AWS_SHAPE_SCHEMA)
    places = values_frame(
        spark, numbered(AWS_REGIONS), "place int, region_code string, from_code string, to_code string"
    )
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(F.broadcast(shapes), F.col("l_partkey") % len(AWS_SHAPES) == F.col("shape"))
        .join(F.broadcast(places), F.col("l_suppkey") % len(AWS_REGIONS) == F.col("place"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_suppkey").alias("supplier"),
            period().alias(C.BILLING_PERIOD),
            F.col("operation").alias("line_item_operation"),
            F.col("product_code").alias("line_item_product_code"),
            charge("native").alias("line_item_line_item_type"),
            F.col("usage_type").alias("line_item_usage_type"),
            F.col("unit").alias("pricing_unit"),
            F.when(
                F.col("transfer_type").isNotNull(), F.create_map(F.lit("transfer_type"), F.col("transfer_type"))
            ).alias("product"),
            F.col("instance_type").alias("product_instance_type"),
            F.col("region_code").alias("product_region_code"),
            F.col("from_code").alias("product_from_region_code"),
            F.col("to_code").alias("product_to_region_code"),
            F.col("service_code").alias("product_servicecode"),
            amount().alias("line_item_usage_amount"),
            cost().alias("line_item_unblended_cost"),
            F.col("l_extendedprice").alias("pricing_public_on_demand_cost"),
            (F.col("l_suppkey") % 6).cast("string").alias("line_item_usage_account_id"),
            F.col("l_shipdate").alias("line_item_usage_start_date"),
            (F.col("l_shipdate") + F.expr("INTERVAL 1 HOUR")).alias("line_item_usage_end_date"),
            tags().alias("resource_tags"),
        )
    )


def aws_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines in the FOCUS layout of AWS."""
    native = aws_native(spark, sf_dir)
    kind = F.col("line_item_line_item_type")
    return native.select(
        "order_id",
        "line_no",
        C.BILLING_PERIOD,
        F.col("line_item_unblended_cost").alias("BilledCost"),
        F.col("pricing_public_on_demand_cost").alias("ListCost"),
        F.col("product_region_code").alias("RegionId"),
        F.col("product_servicecode").alias("ServiceName"),
        F.when(kind == "SavingsPlanCoveredUsage", "Purchase")
        .when(kind == "DiscountedUsage", "Usage")
        .otherwise(kind)
        .alias("ChargeCategory"),
        F.col("line_item_usage_amount").alias("ConsumedQuantity"),
        F.col("pricing_unit").alias("PricingUnit"),
        F.col("line_item_usage_type").alias("SkuMeter"),
        F.col("line_item_operation").alias("x_Operation"),
        F.col("line_item_product_code").alias("x_ServiceCode"),
        F.col("resource_tags").alias("Tags"),
    )


def azure_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of an Azure cost details export."""
    shapes = values_frame(
        spark, numbered(AZURE_SHAPES), "shape int, category string, subcategory string, meter string, unit string"
    )
    places = values_frame(spark, numbered(AZURE_REGIONS), "place int, location string")
    lines = table(spark, sf_dir, "lineitem")
    return (
        lines.join(F.broadcast(shapes), F.col("l_partkey") % len(AZURE_SHAPES) == F.col("shape"))
        .join(F.broadcast(places), F.col("l_suppkey") % len(AZURE_REGIONS) == F.col("place"))
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            period().alias(C.BILLING_PERIOD),
            charge("native").alias("ChargeType"),
            F.col("location").alias("ResourceLocation"),
            F.col("category").alias("MeterCategory"),
            F.col("subcategory").alias("MeterSubCategory"),
            F.col("meter").alias("MeterName"),
            F.col("unit").alias("UnitOfMeasure"),
            amount().alias("Quantity"),
            cost().alias("CostInBillingCurrency"),
            (F.col("l_suppkey") % 6).cast("string").alias("SubscriptionId"),
            F.col("l_shipdate").cast("date").alias("Date"),
            F.to_json(tags()).alias("Tags"),
        )
    )


def azure_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines in the FOCUS layout of Azure."""
    native = azure_native(spark, sf_dir)
    return native.select(
        "order_id",
        "line_no",
        C.BILLING_PERIOD,
        F.col("CostInBillingCurrency").alias("BilledCost"),
        F.col("ResourceLocation").alias("RegionId"),
        F.col("MeterCategory").alias("ServiceName"),
        F.when(F.col("ChargeType").isin("Tax", "SavingsPlanCoveredUsage"), "Purchase")
        .otherwise("Usage")
        .alias("ChargeCategory"),
        F.col("Quantity").alias("ConsumedQuantity"),
        F.col("MeterCategory").alias("x_SkuMeterCategory"),
        F.col("MeterSubCategory").alias("x_SkuMeterSubcategory"),
        F.col("MeterName").alias("x_SkuMeterName"),
        F.col("UnitOfMeasure").alias("x_PricingUnitDescription"),
        "Tags",
    )


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as shared resources (line 1) and the workloads on them (the others)."""
    child = F.col("l_linenumber") > 1
    owner = F.concat(F.lit("res-"), F.col("l_suppkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when(F.col("l_suppkey") % 17 != 0, period()).alias(INTERVAL),
        F.when(child, owner).when(F.col("l_partkey") % 2 == 0, "NULL").alias(PARENT),
        F.when(child, F.concat(F.lit("pod-"), F.col("l_partkey").cast("string"))).otherwise(owner).alias(RESOURCE),
        F.when(child & (F.col("l_tax") < 0.075), (F.col("l_quantity") / F.lit(100.0)).cast("string")).alias(RATIO),
        F.when(~child & (F.col("l_suppkey") % 13 != 0), F.col("l_quantity") * F.lit(0.5)).alias(C.ENERGY),
        F.when(~child & (F.col("l_suppkey") % 13 != 0), F.col("l_extendedprice")).alias(C.OPERATIONAL),
        F.when(~child & (F.col("l_suppkey") % 13 != 0), F.col("l_extendedprice") * F.lit(0.25)).alias(C.EMBODIED),
        F.create_map(F.lit("aws_eks_namespace"), F.concat(F.lit("ns-"), (F.col("l_partkey") % 40).cast("string"))).alias(
            "resource_tags"
        ),
    )
