"""Energy of transferred data, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally.functions.common import ends_with_any

# kWh per GB inside a region, between regions, to the internet.
INTRA, INTER, EXTRA = 0.001, 0.0015, 0.059

# Endings of FOCUS meters by scope, tried in this order.
INTRA_ENDINGS = ("DataTransfer-Regional-Bytes", "DataTransfer-xAZ-In-Bytes", "DataTransfer-xAZ-Out-Bytes")
EXTRA_ENDINGS = ("DataTransfer-In-Bytes", "DataTransfer-Out-Bytes")
INTER_ENDINGS = ("AWS-In-Bytes", "AWS-Out-Bytes")
ORIGIN_ENDINGS = ("-In-Bytes", "-Out-Bytes")



@dataclass(frozen=True)
class Scopes:
    """What to return for each scope of a transfer: its name, or its kWh per GB."""

    intra: Column
    inter: Column
    extra: Column


def names() -> Scopes:
    return Scopes(F.lit("intra"), F.lit("inter"), F.lit("extra"))


def rates(intra: float = INTRA, inter: float = INTER, extra: float = EXTRA) -> Scopes:
    return Scopes(F.lit(intra), F.lit(inter), F.lit(extra))


def aws_scope(service_code: Column, transfer_type: Column, of: Scopes) -> Column:
    """Scope of a native transfer line, else NULL."""
    scope = (
        F.when(transfer_type.startswith("Inter"), of.inter)
        .when(transfer_type.startswith("IntraRegion"), of.intra)
        .when(transfer_type.startswith("AWS Inbound"), of.extra)
        .when(transfer_type.startswith("AWS Outbound"), of.extra)
    )
    return F.when(service_code == "AWSDataTransfer", scope)


def aws_focus_scope(service_code: Column, sku_meter: Column, of: Scopes) -> Column:
    """The same from the ending of a FOCUS meter; CDN delivery does not count."""
    scope = (
        F.when(ends_with_any(sku_meter, INTRA_ENDINGS), of.intra)
        .when(ends_with_any(sku_meter, EXTRA_ENDINGS), of.extra)
        .when(ends_with_any(sku_meter, INTER_ENDINGS), of.inter)
        .when(sku_meter.contains("CloudFront") & ends_with_any(sku_meter, ORIGIN_ENDINGS), of.inter)
    )
    return F.when(F.coalesce(service_code != "AmazonCloudFront", F.lit(True)), scope)


def azure_scope(category: Column, subcategory: Column, of: Scopes) -> Column:
    """Microsoft's own network counts as inter-region, other providers as internet."""
    scope = (
        F.when(subcategory.contains("Inter-Region"), of.inter)
        .when(subcategory.startswith("Rtn Preference: MGN"), of.inter)
        .when(subcategory.startswith("Rtn Preference: "), of.extra)
    )
    return F.when(category == "Bandwidth", scope)
