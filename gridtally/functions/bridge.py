"""Native report columns under their FOCUS names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C
from gridtally.functions.common import blank_to_null, optional

AWS_NEEDS = (
    "line_item_unblended_cost",
    "product_servicecode",
    "line_item_product_code",
    "line_item_operation",
    "line_item_usage_type",
    "line_item_line_item_type",
    "line_item_usage_account_id",
    "line_item_usage_start_date",
    "line_item_usage_end_date",
    "pricing_public_on_demand_cost",
)
AZURE_NEEDS = ("CostInBillingCurrency", "MeterCategory", "ChargeType", "SubscriptionId", "Date")


def instant(df: DataFrame, name: str) -> Column:
    """A timestamp as an ISO-8601 UTC instant; text is passed on, blank as NULL.

    Fractions of a second are printed only where there are any, in groups of
    three digits.
    """
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return blank_to_null(column.cast("string"))
    micros = F.date_format(column, "SSSSSS")
    fraction = (
        F.when(micros == "000000", F.lit(""))
        .when(micros.endswith("000"), F.concat(F.lit("."), F.substring(micros, 1, 3)))
        .otherwise(F.concat(F.lit("."), micros))
    )
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def aws(df: DataFrame) -> dict[str, Column]:
    region = F.coalesce(
        optional(df, C.REGION),
        optional(df, "product_region_code"),
        optional(df, "product_from_region_code"),
        optional(df, "product_to_region_code"),
    )
    values = {
        "BilledCost": F.col("line_item_unblended_cost"),
        "ListCost": F.col("pricing_public_on_demand_cost"),
        "RegionId": F.lower(region),
        "ServiceName": blank_to_null(F.col("product_servicecode")),
        "x_ServiceCode": blank_to_null(F.col("line_item_product_code")),
        "x_Operation": blank_to_null(F.col("line_item_operation")),
        "SkuMeter": blank_to_null(F.col("line_item_usage_type")),
        "ChargeCategory": blank_to_null(F.col("line_item_line_item_type")),
        "SubAccountId": F.col("line_item_usage_account_id"),
        "ChargePeriodStart": instant(df, "line_item_usage_start_date"),
        "ChargePeriodEnd": instant(df, "line_item_usage_end_date"),
    }
    if "resource_tags" in df.columns and isinstance(df.schema["resource_tags"].dataType, T.MapType):
        values["Tags"] = F.col("resource_tags")
    return values


def azure(df: DataFrame) -> dict[str, Column]:
    """Azure lines are daily, so the charge period is one day."""
    day = F.col("Date").cast("date")
    return {
        "BilledCost": F.col("CostInBillingCurrency"),
        "RegionId": F.coalesce(optional(df, C.REGION), F.lower(optional(df, "ResourceLocation"))),
        "ServiceName": F.col("MeterCategory"),
        "ChargeCategory": F.col("ChargeType"),
        "SubAccountId": F.col("SubscriptionId"),
        "ChargePeriodStart": day.cast("string"),
        "ChargePeriodEnd": F.date_add(day, 1).cast("string"),
    }
