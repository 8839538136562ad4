"""Energy operators on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors.tables import COMPUTE_SCHEMA, TOKEN_SCHEMA, Factors, values_frame
from gridtally.functions import compute, tokens
from gridtally.operators import enrich as ops
from gridtally.plans.pipelines import Plan

GB_MONTH = 24 * 30.42
HDD, SSD = 0.65 / 1024 / 1000, 1.2 / 1024 / 1000

AWS_FIELDS = {
    "line_item_operation": "string",
    "line_item_product_code": "string",
    "line_item_line_item_type": "string",
    "line_item_usage_type": "string",
    "pricing_unit": "string",
    "product": "map<string,string>",
    "product_instance_type": "string",
    "product_region_code": "string",
    "product_from_region_code": "string",
    "product_to_region_code": "string",
    "product_servicecode": "string",
    "line_item_usage_amount": "double",
}
FOCUS_FIELDS = {
    "ChargeCategory": "string",
    "RegionId": "string",
    "SkuMeter": "string",
    "x_ServiceCode": "string",
    "x_Operation": "string",
    "ConsumedQuantity": "double",
    "PricingUnit": "string",
}
AZURE_FIELDS = {
    "ChargeType": "string",
    "ResourceLocation": "string",
    "MeterCategory": "string",
    "MeterSubCategory": "string",
    "MeterName": "string",
    "UnitOfMeasure": "string",
    "Quantity": "double",
}


def frame(spark, fields, *rows):
    schema = "n int, " + ", ".join(f"{name} {kind}" for name, kind in fields.items())
    usage = {"line_item_line_item_type": "Usage", "ChargeCategory": "Usage", "ChargeType": "Usage"}
    data = [(n, *[row.get(f, usage.get(f)) for f in fields]) for n, row in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def run(spark, provider, layout, rows, *steps, factors=None):
    fields = {(C.AWS, C.NATIVE): AWS_FIELDS, (C.AWS, C.FOCUS): FOCUS_FIELDS, (C.AZURE, C.NATIVE): AZURE_FIELDS}
    plan = Plan(provider, layout, tuple((step, {}) for step in steps))
    df = plan.apply(frame(spark, fields[provider, layout], *rows), factors or Factors.default(spark))
    return df.orderBy("n").collect()


def energies(*args, **kw):
    return [row[C.ENERGY] for row in run(*args, **kw)]


def check(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None and w is None) or g == pytest.approx(w, rel=1e-12)


def aws_storage(operation, amount, usage_type, service, unit):
    return {
        "line_item_operation": operation,
        "line_item_usage_amount": amount,
        "line_item_usage_type": usage_type,
        "product_servicecode": service,
        "pricing_unit": unit,
    }


def test_aws_storage(spark):
    rows = [
        aws_storage("Storage", 0.1, "EUW2-TimedStorage-ByteHrs", "AmazonS3", "GB-Mo"),
        aws_storage("CreateVolume-Gp3", 10.0, "VolumeUsage.gp3", "AmazonEC2", "GB-Mo"),
        aws_storage("CreateVolume", 10.0, "EUW2-EBS:VolumeUsage", "AmazonEC2", "GB-Mo"),
        aws_storage("CreateCluster", 0.1, "SomeUsageType", "AmazonDocDB", "GB-Mo"),
        aws_storage("Run", 5.0, "RunningApplicationStorage", "AmazonKinesisAnalytics", "GB-Hours"),
        aws_storage("Storage", 1.0, "EUW2-TimedStorage-ByteHrs", None, "GB-Mo"),
        aws_storage("CreateVolume", 10.0, "VolumeUsage.gp3", "AmazonEC2", "IOPS-Mo"),
        aws_storage("CreateVolume", 10.0, "VolumeUsage.gp3", "AmazonEC2", "GiBps-mo"),
        aws_storage(None, 10.0, "VolumeUsage.gp3", "AmazonEC2", "GB-Mo"),
        aws_storage("CreateVolume", 10.0, None, "AmazonEC2", "GB-Mo"),
        aws_storage("CreateVolume", None, "VolumeUsage.gp3", "AmazonEC2", "GB-Mo"),
        aws_storage("X", 1.0, "BackupUsage", "AmazonDocDB", "GB-Mo"),
    ]
    want = [
        0.1 * GB_MONTH * HDD * 6,
        10 * GB_MONTH * SSD * 2,
        10 * GB_MONTH * HDD * 2,
        0.1 * GB_MONTH * SSD * 2,
        5 * SSD,
        GB_MONTH * HDD,
        *[None] * 5,
        GB_MONTH * HDD * 3,
    ]
    check(energies(spark, C.AWS, C.NATIVE, rows, ops.storage_energy), want)


def test_suffixes_match_only_at_the_end(spark):
    rows = [
        aws_storage("X", 1.0, "VolumeUsage.gp3.extra", "AmazonEC2", "GB-Mo"),
        aws_storage("X", 1.0, "VolumeUsageXgp3", "AmazonEC2", "GB-Mo"),
    ]
    check(energies(spark, C.AWS, C.NATIVE, rows, ops.storage_energy), [None, None])


def azure(category, subcategory, meter, unit, quantity):
    return {
        "MeterCategory": category,
        "MeterSubCategory": subcategory,
        "MeterName": meter,
        "UnitOfMeasure": unit,
        "Quantity": quantity,
    }


def test_azure_storage(spark):
    disks = "Standard SSD Managed Disks"
    rows = [
        azure("Storage", "x", "LRS Data Stored", "1 GB/Month", 10.0),
        azure("Storage", "x", "RA-GRS Data Stored", "10 GB/Month", 2.0),
        azure("Storage", "x", "Data Stored", "1 TB/Month", 1.0),
        azure("Storage", "x", "LRS Data Stored", "1 GB/Month", -5.0),
        azure("Storage", disks, "E2 LRS Disk", "1/Month", 2.0),
        azure("Storage", disks, "S4 LRS Disk", "1 /Month", 2.0),
        azure("Storage", "x", "GZRS Data Stored", "1 GB/Month", 1.0),
    ]
    skipped = [azure("Storage", "x", "LRS Data Stored", unit, 1.0) for unit in ("10K", "1M", "1 GB", "10K/Month")]
    skipped += [
        azure("Storage", disks, "E2 LRS Disk", "100/Month", 1.0),
        azure("Storage", disks, "S4 Disk Operations", "1/Month", 1.0),
        azure("Storage", disks, "P99 LRS Disk", "1/Month", 1.0),
        azure("Storage", disks, None, "1/Month", 1.0),
        azure("Storage", disks, "E2 LRS Disk", "1/Month", None),
        azure("Backup", disks, "E2 LRS Disk", "1/Month", 1.0),
    ]
    want = [
        10 * GB_MONTH * SSD * 3,
        20 * GB_MONTH * SSD * 6,
        1024 * GB_MONTH * SSD,
        -5 * GB_MONTH * SSD * 3,
        2 * 8 * 720 * SSD * 3,
        2 * 32 * 720 * HDD * 3,
        GB_MONTH * SSD * 6,
        *[None] * len(skipped),
    ]
    check(energies(spark, C.AZURE, C.NATIVE, rows + skipped, ops.storage_energy), want)


def test_aws_network(spark):
    def row(service, kind):
        product = None if kind is None else {"transfer_type": kind}
        return {"product_servicecode": service, "product": product, "line_item_usage_amount": 10.0}

    rows = [
        row("AWSDataTransfer", kind)
        for kind in ("InterRegion Outbound", "IntraRegion-xAZ-In", "AWS Inbound", "AWS Outbound", "Accelerated", None)
    ] + [row("AmazonEC2", "AWS Outbound")]
    check(energies(spark, C.AWS, C.NATIVE, rows, ops.network_energy), [0.015, 0.01, 0.59, 0.59, None, None, None])


@pytest.mark.parametrize(
    ("meter", "service", "rate"),
    [
        ("EUW2-DataTransfer-Regional-Bytes", "AmazonEC2", 0.001),
        ("DataTransfer-xAZ-In-Bytes", "AmazonEC2", 0.001),
        ("EUW2-DataTransfer-Out-Bytes", "AmazonEC2", 0.059),
        ("EUW2-USE1-AWS-In-Bytes", None, 0.0015),
        ("EUW2-CloudFront-Out-Bytes", "AmazonS3", 0.0015),
        ("EU-DataTransfer-Out-Bytes", "AmazonCloudFront", None),
        ("EBS:VolumeUsage.gp3", "AmazonEC2", None),
        ("DataProcessing-Bytes", "AmazonEC2", None),
        (None, "AmazonEC2", None),
    ],
)
def test_aws_focus_network(spark, meter, service, rate):
    rows = [{"SkuMeter": meter, "x_ServiceCode": service, "ConsumedQuantity": 2.0}]
    check(energies(spark, C.AWS, C.FOCUS, rows, ops.network_energy), [None if rate is None else 2 * rate])


def test_azure_network(spark):
    kinds = ("Inter-Region", "Rtn Preference: MGN", "Rtn Preference: ISP", "CDN", None)
    rows = [azure("Bandwidth", kind, "m", "1 GB", 10.0) for kind in kinds]
    rows += [azure("Bandwidth", "Inter-Region", "m", "1 GB", None), azure("Storage", "Inter-Region", "m", "1 GB", 1.0)]
    want = [0.015, 0.015, 0.59, None, None, None, None]
    check(energies(spark, C.AZURE, C.NATIVE, rows, ops.network_energy), want)


def compute_factors(spark):
    rows = [("t3.micro", 0.001, 5.0, 1e-4), ("d2s_v3", 0.003, 0.5, 6e-5), ("g5.xlarge", 0.0625, 8.5, 1e-3)]
    return Factors.default(spark).with_compute(values_frame(spark, rows, COMPUTE_SCHEMA))


def vm(instance, service, operation, product, amount=10.0):
    return {
        "product_instance_type": instance,
        "product_servicecode": service,
        "line_item_operation": operation,
        "line_item_product_code": product,
        "line_item_usage_amount": amount,
    }


def test_aws_compute(spark):
    hits = [
        vm("t3.micro", "AmazonEC2", "RunInstances:0002", "AmazonEC2"),
        vm("t3.micro.search", "AmazonES", "ESDomain", "AmazonES"),
        vm("db.t3.micro", "AmazonRDS", "CreateDBInstance:0014", "AmazonRDS"),
    ]
    misses = [
        vm(None, "AmazonEC2", "RunInstances", "AmazonEC2"),
        vm("t3.micro", "AmazonEC2", None, "AmazonEC2"),
        vm("t3.micro", "AmazonEC2", "RunInstances", None),
        vm("t3.micro", "AmazonS3", "GetObject", "AmazonS3"),
        vm("t3.micro", "AmazonEC2", "StopInstances", "AmazonEC2"),
        vm("t3.micro", "AmazonOther", "RunInstances", "AmazonEC2"),
        vm("t3.micro", "amazonec2", "RunInstances", "amazonec2"),
        vm("unknown.type", "AmazonEC2", "RunInstances", "AmazonEC2"),
    ]
    got = run(spark, C.AWS, C.NATIVE, hits + misses, ops.compute_impacts, factors=compute_factors(spark))
    for row in got[:3]:
        assert (row[C.ENERGY], row[C.EMBODIED], row[C.DEPLETION]) == pytest.approx((0.01, 50.0, 1e-3))
    assert all(row[C.ENERGY] is None and row[C.EMBODIED] is None for row in got[3:])


def test_focus_compute_reads_the_meter(spark):
    base = {"x_ServiceCode": "AmazonEC2", "x_Operation": "RunInstances", "ConsumedQuantity": 10.0}
    rows = [{**base, "SkuMeter": meter} for meter in ("EUW2-BoxUsage:t3.micro", "BoxUsage", "BoxUsage:", None)]
    got = energies(spark, C.AWS, C.FOCUS, rows, ops.compute_impacts, factors=compute_factors(spark))
    check(got, [0.01, None, None, None])


@pytest.mark.parametrize(
    ("meter", "unit", "hit"),
    [("D2s v3", "1 Hour", True), ("D2 v3/D2s v3", "1 Hour", True), (" D2s v3 ", "1 Hour", True), ("D2s v3", "10 Hours", False)],
)
def test_azure_compute(spark, meter, unit, hit):
    rows = [azure("Virtual Machines", "Dsv3", meter, unit, 2.0)]
    got = energies(spark, C.AZURE, C.NATIVE, rows, ops.compute_impacts, factors=compute_factors(spark))
    check(got, [0.006 if hit else None])


def test_serverless(spark):
    def row(operation, usage_type, amount):
        return {"line_item_operation": operation, "line_item_usage_type": usage_type, "line_item_usage_amount": amount}

    rows = [
        row("FargateTask", "EUW2-Fargate-GB-Hours", 10.0),
        row("FargateTask", "EUW2-Fargate-vCPU-Hours:perCPU", 4.0),
        row("FargateTask", "EUW2-Fargate-ARM-vCPU-Hours:perCPU", 4.0),
        row("FargateTask", "EMR-SERVERLESS-MemoryGBHours", 4.0),
        row("Start", "EUW2-EMR-SERVERLESS-MemoryGBHours", 10.0),
        row(None, "EUW2-EMR-SERVERLESS-ARM-vCPUHours", 4.0),
        row("Start", "EUW2-Fargate-GB-Hours", 4.0),
    ]
    memory, x86, arm = 0.0000598, 0.0088121875, 0.00191015625
    want = [10 * memory, 4 * x86, 4 * arm, None, 10 * memory, 4 * arm, None]
    check(energies(spark, C.AWS, C.NATIVE, rows, ops.serverless_energy), want)


def test_gpu_adds_to_the_instance(spark):
    rows = [
        vm(kind, service, "RunInstances", "AmazonEC2", amount)
        for kind, service, amount in (
            ("g5.xlarge", "Other", 1.0),
            ("g5.xlarge", "AmazonEC2", 2.0),
            ("g4dn.xlarge", "AmazonEC2", 1.0),
            ("g6.8xlarge", "AmazonEC2", 1.0),
            ("c5.xlarge", "AmazonEC2", 1.0),
        )
    ]
    got = energies(spark, C.AWS, C.NATIVE, rows, ops.compute_impacts, ops.gpu_energy, factors=compute_factors(spark))
    check(got, [0.0855, 0.171 + 2 * 0.0625, 0.0395, 0.04, None])


def test_token_usage_types(spark):
    given = {
        "EUW2-Mistral7B-output-tokens": ("Mistral7B", "output"),
        "EU-Qwen3-32B-output-tokens-batch": ("Qwen3-32B", "output"),
        "USE1-Nova-Input-Tokens": ("Nova", "input"),
        "nodash": (None, None),
        "generic-tokens-usage": (None, None),
        "EUW2-output-tokens": (None, None),
    }
    df = spark.createDataFrame([(k,) for k in given], "u string")
    for row in df.select("u", tokens.model_key(F.col("u")).alias("m"), tokens.direction(F.col("u")).alias("d")).collect():
        assert (row["m"], row["d"]) == given[row["u"]]


def test_token_energy_replaces_other_energy(spark):
    coefficients = values_frame(spark, [("huggingface_hub", "mistralai/Mistral-7B-v0.3", 1e-3, 5e-4, 1e-9)], TOKEN_SCHEMA)
    factors = Factors.default(spark).with_tokens(coefficients)

    def row(usage_type, unit, amount, product="AmazonBedrock"):
        return {
            "line_item_product_code": product,
            "line_item_usage_type": usage_type,
            "pricing_unit": unit,
            "line_item_usage_amount": amount,
            "line_item_operation": "FargateTask",
        }

    rows = [
        row("EUW2-MISTRAL7b-output-tokens", "1M tokens", 2.0),
        row("EUW2-Mistral7B-output-tokens", "1K tokens", 2.0),
        row("EUW2-Mistral7B-output-tokens", " ", 2.0),
        row("EUW2-Mistral7B-input-tokens", "1M tokens", 2.0),
        row("EUW2-Mistral7B-output-tokens", "1M tokens", 0.0),
        row("EUW2-Mistral7B-output-tokens", "1M tokens", 2.0, "AmazonOther"),
        row("EUW2-Other-output-tokens", "1M tokens", 2.0),
    ]
    got = run(spark, C.AWS, C.NATIVE, rows, ops.token_impacts, factors=factors)
    check([r[C.ENERGY] for r in got], [2.0, 0.002, 0.000002, None, None, None, None])
    check([r[C.EMBODIED] for r in got], [1000.0, 1.0, 0.001, None, None, None, None])


def test_meter_type(spark):
    df = spark.createDataFrame([("a:b:c",), ("a:",), ("a",), (None,)], "m string")
    assert [r[0] for r in df.select(compute.type_from_meter(F.col("m"))).collect()] == ["b:c", None, None, None]
