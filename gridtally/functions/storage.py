"""Energy of stored data, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally.factors import fixed
from gridtally.factors.tables import parse_list, parse_pairs
from gridtally.functions.common import ends_with_any

HDD_WH_PER_TB_HOUR = 0.65
SSD_WH_PER_TB_HOUR = 1.2
HOURS_PER_MONTH = (24.0, 30.42)  # multiplied one after the other
HOURS_PER_DISK_MONTH = 30.0 * 24.0  # Azure prices managed disks by a 30-day month
GB_PER_TB = 1024.0

COPIES = parse_pairs(fixed.STORAGE_REPLICATION)
AZURE_COPIES = parse_pairs(fixed.AZURE_REPLICATION)
AZURE_UNITS = parse_pairs(fixed.AZURE_STORAGE_UNITS)
AZURE_DISK_UNITS = parse_pairs(fixed.AZURE_DISK_UNITS)
DISK_SKU = r"\b([PES]\d{1,2})\b"


def gb_month_hours(gb_months: Column) -> Column:
    hours, days = HOURS_PER_MONTH
    return gb_months * F.lit(hours) * F.lit(days)


def by_media(
    operation: Column, unit: Column, usage_type: Column, service: Column, ssd: Column, hdd: Column
) -> Column:
    """``ssd`` or ``hdd`` for an AWS storage line, else NULL; rules are tried in a fixed order."""
    ssd_service = ends_with_any(service, parse_list(fixed.SSD_SERVICES)) & ~usage_type.contains("Backup")
    kind = (
        F.when(ends_with_any(usage_type, parse_list(fixed.SSD_USAGE_TYPES)), ssd)
        .when(ssd_service, ssd)
        .when(ends_with_any(usage_type, parse_list(fixed.HDD_USAGE_TYPES)), hdd)
    )
    return F.when(operation.isNotNull() & unit.isin(parse_list(fixed.STORAGE_UNITS)), kind)


def media(operation: Column, unit: Column, usage_type: Column, service: Column) -> Column:
    """``SSD``, ``HDD`` or NULL for an AWS line."""
    return by_media(operation, unit, usage_type, service, F.lit("SSD"), F.lit("HDD"))


# Rules by service: text in the usage type (blank for any) and the factor's name.
COPY_RULES = {
    "AmazonS3": (
        ("TimedStorage-ZIA", "S3_ONE_ZONE_REDUCED_REDUNDANCY"),
        ("EarlyDelete-ZIA", "S3_ONE_ZONE_REDUCED_REDUNDANCY"),
        ("TimedStorage-RRS", "S3_ONE_ZONE_REDUCED_REDUNDANCY"),
        ("TimedStorage", "S3"),
        ("EarlyDelete", "S3"),
    ),
    "AmazonEC2": (("VolumeUsage", "EC2_EBS_VOLUME"), ("SnapshotUsage", "EC2_EBS_SNAPSHOT")),
    "AmazonEFS": (("ZIA", "EFS_ONE_ZONE"), ("", "EFS")),
    "AmazonRDS": (("BackupUsage", "RDS_BACKUP"), ("Aurora", "RDS_AURORA"), ("Multi-AZ", "RDS_MULTI_AZ")),
    "AmazonDocDB": (("BackupUsage", "DOCUMENT_DB_BACKUP"), ("", "DOCUMENT_DB_STORAGE")),
    "AmazonDynamoDB": (("", "DYNAMO_DB"),),
    "AmazonECR": (("TimedStorage", "ECR_STORAGE"),),
    "AmazonElastiCache": (("BackupUsage", "DOCUMENT_ELASTICACHE_BACKUP"),),
    "AmazonSimpleDB": (("TimedStorage", "SIMPLE_DB"),),
}


def copies(service: Column, usage_type: Column) -> Column:
    """How many times AWS keeps a stored byte; the first rule that applies.

    The rules are data to one small lambda. A projection with a lambda is a stage of its
    own, of small methods; as a chain of conditions the rules would make up much of the
    one method that Spark generates for a plan, and push it past the size that the JVM
    compiles. So this belongs into a projection ahead of the joins.
    """
    entries = []
    for name, rules in COPY_RULES.items():
        pairs = [F.struct(F.lit(text).alias("text"), F.lit(COPIES[factor]).alias("copies")) for text, factor in rules]
        entries += [F.lit(name), F.array(*pairs)]
    fits = F.filter(F.create_map(*entries)[service], lambda rule: usage_type.contains(rule["text"]))
    return F.coalesce(F.get(fits, F.lit(0))["copies"], F.lit(COPIES["DEFAULT"]))


def per_gb_hour(wh_per_tb_hour: float) -> Column:
    return F.lit(wh_per_tb_hour / GB_PER_TB)


def stored_energy(gb_hours: Column, per_gb: Column, replication: Column) -> Column:
    """kWh of keeping ``gb_hours`` at ``per_gb`` Wh each, ``replication`` times."""
    return gb_hours / F.lit(1000.0) * per_gb * replication


def aws_rate(
    operation: Column,
    unit: Column,
    usage_type: Column,
    service: Column,
    hdd: float = HDD_WH_PER_TB_HOUR,
    ssd: float = SSD_WH_PER_TB_HOUR,
) -> dict[str, Column]:
    """Wh per GB and hour, and copies, of an AWS storage line; NULL for others."""
    stored = unit.isin(parse_list(fixed.STORAGE_UNITS))
    return {
        "_per_gb": by_media(operation, unit, usage_type, service, per_gb_hour(ssd), per_gb_hour(hdd)),
        "_copies": F.when(stored, copies(service, usage_type)),
    }


def aws_energy(unit: Column, amount: Column, per_gb: Column, replication: Column) -> Column:
    gb_hours = F.when(unit == "GB-Hours", amount).otherwise(gb_month_hours(amount))
    return stored_energy(gb_hours, per_gb, replication)


def _by_unit(unit: Column, units: dict[str, int]) -> Column:
    chain = F
    for name, count in units.items():
        chain = chain.when(unit == name, F.lit(count))
    return chain.otherwise(F.lit(None).cast("int"))


def azure_copies(meter: Column) -> Column:
    """How many times Azure keeps a stored byte; GZRS is tested before its substrings."""
    return (
        F.when(meter.contains("GZRS"), F.lit(AZURE_COPIES["STORAGE_GZRS"]))
        .when(meter.contains("LRS"), F.lit(AZURE_COPIES["STORAGE_LRS"]))
        .when(meter.contains("ZRS"), F.lit(AZURE_COPIES["STORAGE_ZRS"]))
        .when(meter.contains("GRS"), F.lit(AZURE_COPIES["STORAGE_GRS"]))
        .otherwise(F.lit(AZURE_COPIES["DEFAULT"]))
    )


def is_capacity(category: Column, meter: Column) -> Column:
    return (category == "Storage") & meter.contains("Data Stored")


def azure_capacity_energy(
    category: Column, meter: Column, unit: Column, amount: Column, ssd: float = SSD_WH_PER_TB_HOUR
) -> Column:
    """Capacity meters: unit multiples of GB-months, always solid state."""
    gb_hours = gb_month_hours(amount * _by_unit(unit, AZURE_UNITS))
    return F.when(is_capacity(category, meter), stored_energy(gb_hours, per_gb_hour(ssd), azure_copies(meter)))


def azure_disk_sku(category: Column, subcategory: Column, meter: Column) -> Column:
    """Disk SKU named by a managed disk meter; NULL for every other meter."""
    disk = (
        (category == "Storage")
        & ~meter.contains("Data Stored")
        & subcategory.contains("Managed Disks")
        & ~meter.contains("Operations")
    )
    return F.when(disk, F.nullif(F.regexp_extract(meter, DISK_SKU, 1), F.lit("")))


def azure_disk_energy(
    unit: Column,
    amount: Column,
    disk_gb: Column,
    medium: Column,
    hdd: float = HDD_WH_PER_TB_HOUR,
    ssd: float = SSD_WH_PER_TB_HOUR,
) -> Column:
    """Managed disks: provisioned size over a 30-day month, whatever is in use."""
    gb_hours = amount * _by_unit(unit, AZURE_DISK_UNITS) * disk_gb * F.lit(HOURS_PER_DISK_MONTH)
    per_gb = F.when(medium == "HDD", per_gb_hour(hdd)).otherwise(per_gb_hour(ssd))
    return stored_energy(gb_hours, per_gb, F.lit(AZURE_COPIES["STORAGE_DISKS"]))
