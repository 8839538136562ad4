"""Instance types and serverless energy, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# kWh per GB-hour of memory and per vCPU-hour.
MEMORY_KWH, X86_KWH, ARM_KWH = 0.0000598, 0.0088121875, 0.00191015625
GPU_UTILISATION_PERCENT = 50


def type_from_meter(meter: Column) -> Column:
    """Text after the first colon; NULL without a colon or with nothing after it."""
    at = F.instr(meter, ":")
    return F.when(at > 0, F.nullif(F.substr(meter, at + 1), F.lit("")))


def aws_type(product: Column, operation: Column, service: Column, instance: Column) -> Column:
    """Instance type a virtual machine, search or database line is billed for."""
    return (
        F.when((product == "AmazonEC2") & operation.startswith("RunInstances") & (service == "AmazonEC2"), instance)
        .when((product == "AmazonES") & (operation == "ESDomain"), F.regexp_replace(instance, r"\.search$", ""))
        .when(
            (product == "AmazonRDS") & operation.startswith("CreateDBInstance"),
            F.regexp_replace(instance, r"^db\.", ""),
        )
    )


def azure_type(category: Column, meter: Column, unit: Column) -> Column:
    """VM size of an hourly meter such as ``D2s v3/D2 v3``, in factor-table spelling."""
    name = F.trim(meter)
    part = F.when(name.contains("/"), F.trim(F.get(F.split(name, "/", 2), F.lit(1)))).otherwise(name)
    size = F.translate(F.lower(part), " ", "_")
    return F.when((category == "Virtual Machines") & (unit == "1 Hour"), size)


def gpu_type(product: Column, operation: Column, instance: Column) -> Column:
    """Instance type of any EC2 running line; the service code is not consulted."""
    return F.when((product == "AmazonEC2") & operation.startswith("RunInstances"), instance)


def gpu_watts(idle_w: Column, full_w: Column, percent: float) -> Column:
    return idle_w + F.lit(percent / 100) * (full_w - idle_w)


def gpu_energy(amount: Column, watts: Column, gpus: Column) -> Column:
    return amount * watts * gpus / F.lit(1000.0)


def serverless_rate(
    operation: Column,
    usage_type: Column,
    memory: float = MEMORY_KWH,
    x86: float = X86_KWH,
    arm: float = ARM_KWH,
) -> Column:
    """kWh a unit of container tasks, or else of serverless clusters: by memory and by vCPU."""
    per_cpu = F.when(usage_type.contains("-ARM-"), F.lit(arm)).otherwise(F.lit(x86))
    return F.when(
        operation.eqNullSafe("FargateTask"),
        F.when(usage_type.endswith("-GB-Hours"), F.lit(memory)).when(
            usage_type.endswith("-vCPU-Hours:perCPU"), per_cpu
        ),
    ).when(
        usage_type.contains("EMR-SERVERLESS"),
        F.when(usage_type.endswith("MemoryGBHours"), F.lit(memory)).when(usage_type.endswith("-vCPUHours"), per_cpu),
    )
