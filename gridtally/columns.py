"""Column names, types and the logical-to-physical bindings of each report layout."""

from __future__ import annotations

AWS, AZURE, GOOGLE = "AWS", "AZURE", "GOOGLE"
NATIVE, FOCUS = "NATIVE", "FOCUS"

# Value of the ``provider`` column in the region factor tables.
FACTOR_PROVIDER = {AWS: "aws", AZURE: "azure", GOOGLE: "gcp"}

BILLING_PERIOD = "BILLING_PERIOD"

# Impact columns added by enrichment, with their Spark types.
REGION = "region"
ENERGY = "operational_energy_kwh"
INTENSITY = "carbon_intensity"
OPERATIONAL = "operational_emissions_co2eq_g"
EMBODIED = "embodied_emissions_co2eq_g"
DEPLETION = "embodied_adp_sbeq_g"
CPU_LOAD = "cpu_load_percentage"
PUE = "power_usage_effectiveness"
WUE = "water_usage_effectiveness"
WATER_COOLING = "water_cooling_l"
WATER_ELECTRICITY = "water_electricity_production_l"
WATER_STRESS = "water_consumption_stress_area_l"

IMPACT_TYPES = {
    REGION: "string",
    ENERGY: "double",
    INTENSITY: "double",
    OPERATIONAL: "double",
    EMBODIED: "double",
    DEPLETION: "double",
    CPU_LOAD: "double",
    PUE: "double",
    WUE: "double",
    WATER_COOLING: "double",
    WATER_ELECTRICITY: "double",
    WATER_STRESS: "double",
}

AWS_NATIVE_COLUMNS = (
    BILLING_PERIOD,
    "line_item_operation",
    "line_item_product_code",
    "line_item_line_item_type",
    "line_item_usage_type",
    "pricing_unit",
    "product",
    "product_instance_type",
    "product_instance_family",
    "product_product_family",
    "product_region_code",
    "product_from_region_code",
    "product_to_region_code",
    "product_servicecode",
    "line_item_usage_amount",
)

AZURE_NATIVE_COLUMNS = (
    "ChargeType",
    "ResourceLocation",
    "MeterCategory",
    "MeterSubCategory",
    "MeterName",
    "UnitOfMeasure",
    "Quantity",
    "CostInBillingCurrency",
    "SubscriptionId",
    "Date",
)

FOCUS_TYPES = {
    "BilledCost": "double",
    "BillingCurrency": "string",
    "RegionId": "string",
    "ServiceName": "string",
    "ChargeCategory": "string",
    "SubAccountId": "string",
    "ChargePeriodStart": "string",
    "ChargePeriodEnd": "string",
    "Tags": "map<string,string>",
    "ConsumedQuantity": "double",
    "ListCost": "double",
    "PricingUnit": "string",
    "SkuMeter": "string",
}

AWS_FOCUS_EXTENSION = ("x_Operation", "x_ServiceCode")

AZURE_FOCUS_EXTENSION = (
    "x_SkuMeterCategory",
    "x_SkuMeterSubcategory",
    "x_SkuMeterName",
    "x_PricingUnitDescription",
)

# Logical name -> physical column. A logical name missing from a layout means
# that the layout does not carry the information.
BINDINGS = {
    (AWS, NATIVE): {
        "operation": "line_item_operation",
        "product_code": "line_item_product_code",
        "service_code": "product_servicecode",
        "usage_type": "line_item_usage_type",
        "instance_type": "product_instance_type",
        "amount": "line_item_usage_amount",
        "unit": "pricing_unit",
        "product": "product",
        "charge": "line_item_line_item_type",
        "service": "product_servicecode",
        "cost": "line_item_unblended_cost",
        "list_cost": "pricing_public_on_demand_cost",
    },
    (AWS, FOCUS): {
        "operation": "x_Operation",
        "product_code": "x_ServiceCode",
        "service_code": "x_ServiceCode",
        "usage_type": "SkuMeter",
        "amount": "ConsumedQuantity",
        "unit": "PricingUnit",
        "charge": "ChargeCategory",
        "service": "ServiceName",
        "cost": "BilledCost",
        "list_cost": "ListCost",
    },
    (AZURE, NATIVE): {
        "category": "MeterCategory",
        "subcategory": "MeterSubCategory",
        "meter": "MeterName",
        "amount": "Quantity",
        "unit": "UnitOfMeasure",
        "charge": "ChargeType",
        "service": "MeterCategory",
        "cost": "CostInBillingCurrency",
    },
    (AZURE, FOCUS): {
        "category": "x_SkuMeterCategory",
        "subcategory": "x_SkuMeterSubcategory",
        "meter": "x_SkuMeterName",
        "amount": "ConsumedQuantity",
        "unit": "x_PricingUnitDescription",
        "charge": "ChargeCategory",
        "service": "ServiceName",
        "cost": "BilledCost",
        "list_cost": "ListCost",
    },
}

# Columns every report query relies on; absent ones are added as typed NULL.
REPORT_TYPES = {
    BILLING_PERIOD: "string",
    REGION: "string",
    "ServiceName": "string",
    "ChargeCategory": "string",
    "BilledCost": "double",
    "ListCost": "double",
    "SkuMeter": "string",
    ENERGY: "double",
    OPERATIONAL: "double",
    EMBODIED: "double",
    WATER_COOLING: "double",
    WATER_ELECTRICITY: "double",
    WATER_STRESS: "double",
    INTENSITY: "double",
    PUE: "double",
}


def binding(provider: str, layout: str) -> dict[str, str]:
    """Bindings of one report layout; unknown combinations carry none."""
    return BINDINGS.get((provider, layout), {})
