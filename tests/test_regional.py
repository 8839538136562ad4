"""Regional factors, bridges and whole plans."""

from __future__ import annotations

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors import tables
from gridtally.factors.patterns import literal_head, literal_tail, resolve, trie
from gridtally.factors.tables import EFFICIENCY_SCHEMA, Factors, values_frame
from gridtally.functions import bridge
from gridtally.operators import enrich as ops
from gridtally.operators.base import ContractError, Operator, bound
from gridtally.plans.pipelines import Plan
from test_energy import AWS_FIELDS, AZURE_FIELDS, frame, run


def test_region_rules(spark):
    rows = [
        {"product_region_code": "EU-West-1", "product_from_region_code": "x"},
        {"product_from_region_code": "a", "product_to_region_code": "b"},
        {"product_to_region_code": "b"},
        {},
    ]
    assert [r["region"] for r in run(spark, C.AWS, C.NATIVE, rows, ops.region)] == ["EU-West-1", "a", "b", None]
    azure = run(spark, C.AZURE, C.NATIVE, [{"ResourceLocation": "UKSouth"}], ops.region)
    assert azure[0]["region"] == "uksouth"


def at(region, kwh=100.0):
    """A transfer line of a known energy in a region."""
    return {
        "product_region_code": region,
        "product_servicecode": "AWSDataTransfer",
        "product": {"transfer_type": "IntraRegion"},
        "line_item_usage_amount": None if kwh is None else kwh * 1000,
    }


ALL = (
    ops.region,
    ops.network_energy,
    ops.efficiency,
    ops.water,
    ops.carbon_intensity,
    ops.operational_emissions,
)


@pytest.mark.parametrize(
    ("region", "pue", "wue"),
    [
        ("us-east-1", 1.15, 0.12),
        ("us-gov-west-1", 1.14, 0.13),
        ("ap-south-1", 1.42, 0.98),
        ("ap-southeast-2", 1.27, 0.12),
        ("nowhere", 1.15, None),
        ("xus-east-9", 1.15, None),
        ("", 1.15, None),
        (None, 1.15, None),
    ],
)
def test_efficiency(spark, region, pue, wue):
    row = run(spark, C.AWS, C.NATIVE, [at(region)], ops.region, ops.efficiency)[0]
    assert (row[C.PUE], row[C.WUE]) == (pue, wue)


def test_overlapping_patterns_follow_file_order_per_measure(spark):
    table = values_frame(
        spark,
        [(0, "zz-a.+", 1.5, None), (1, "zz-.+", 1.9, 0.7)],
        "ordinal int, region string, pue double, wue double",
    )
    factors = Factors.default(spark).with_efficiency(C.AWS, table)
    row = run(spark, C.AWS, C.NATIVE, [at("zz-abc")], ops.region, ops.efficiency, factors=factors)[0]
    assert (row[C.PUE], row[C.WUE]) == (1.5, 0.7)


def test_literal_ends_of_patterns(spark):
    cases = [
        ("us-.*", "us-", ""), ("us*", "u", ""), ("us-east", "us-east", "us-east"), (".+-east", "", "-east"), ("a|b.c", "", ""),
        (r"us\d-x", "us", ""), ("(?i)us-x", "", ""), ("[ab]-x", "", "-x"), ("a{2}b", "", "b"), ("", "", ""), ("eu-1?x", "eu-", "x"),
    ]
    frame = spark.createDataFrame([(p,) for p, _, _ in cases], "p string")
    got = frame.select("p", literal_head(F.col("p")), literal_tail(F.col("p"))).collect()
    assert [tuple(row) for row in got] == cases


def test_alternatives_hang_on_nodes_of_their_own(spark):
    """Only texts without head and tail may meet all regions."""
    rows = [
        (0, "a1-1+|b2-2.", 1.0, None), (1, "(a|b)x", 2.0, 2.5), (2, "c[0-9]|", 3.0, None), (3, "(?i)q|A1.*", 4.0, None),
        (4, "a1-1+|zz", 5.0, 5.5), (5, "[a|b]", 6.0, None), (6, "b2-2a", 7.0, 7.5),
    ]
    patterns = spark.createDataFrame(rows, EFFICIENCY_SCHEMA)
    nodes = {(r.side, r.key, r.text) for r in trie(patterns).collect()}
    assert nodes == {
        ("head", "a1-", "a1-1+"), ("head", "b2-2", "b2-2."), ("head", "", "(a|b)x"), ("head", "c", "c[0-9]"), ("head", "", ""),
        ("head", "", "(?i)q|A1.*"), ("head", "zz", "zz"), ("head", "", "[a|b]"), ("head", "b2-2a", "b2-2a"),
    }
    regions = ["a1-11", "a1-", "b2-2a", "ax", "c7", "", "Q", "zz", "|", "none"]
    found = resolve(spark.createDataFrame([(r,) for r in regions], "region string"), patterns)
    assert {r.region: (r.pue, r.wue) for r in found.collect()} == {
        "a1-11": (1.0, 5.5), "a1-": (4.0, None), "b2-2a": (1.0, 7.5), "ax": (2.0, 2.5), "c7": (3.0, None), "": (3.0, None),
        "Q": (4.0, None), "zz": (5.0, 5.5), "|": (6.0, None),
    }



@pytest.mark.parametrize("planned", [0, 100])
def test_many_patterns_give_what_few_give(spark, monkeypatch, planned):
    """Joined by key or planned one by one; overlaps, measures apart, regions named in a table, empty and null ones."""
    monkeypatch.setattr(tables, "MAX_PLANNED_PATTERNS", planned)
    patterns = [
        (0, "zz-a.+", 1.5, None), (1, "zz-.+", 1.9, 0.7), (2, ".+-tail", None, 0.1), (3, ".+-tail", 1.2, 0.2),
        (4, "[xy]+|zz.*", 1.3, 0.3), (5, "plain-1", 1.4, 0.4), (6, "eu-west-[12].*", 9.0, 9.0), (7, r"q\d.", 1.6, None),
        (8, None, 1.7, 0.1), (9, "zz*.", 1.8, 0.8),
    ]
    names = ["zz-abc", "zz-b", "q-tail", "xyx", "plain-1", "plain-2", "q1x", "qax", "eu-west-1", "zz", "z!", "", None]
    table = values_frame(spark, patterns, "ordinal int, region string, pue double, wue double")
    factors = Factors.default(spark).with_efficiency(C.AWS, table)
    assert (C.AWS in factors.many_patterns) == (planned == 0)
    got = run(spark, C.AWS, C.NATIVE, [at(name) for name in names], ops.region, ops.efficiency, factors=factors)

    def value(name, place):
        fits = [p[place] for p in patterns if name and p[1] and p[place] is not None and re.fullmatch(p[1], name)]
        return fits[0] if fits else None

    found = {row[C.REGION] or None: (row[C.PUE], row[C.WUE]) for row in got}
    assert len(got) == len(names)
    for name in names:
        pue = value(name, 2)
        assert found[name or None] == (1.15 if pue is None else pue, value(name, 3)), name


def test_water_and_emissions(spark):
    got = run(spark, C.AWS, C.NATIVE, [at("us-east-1"), at("ap-south-1"), at("nowhere"), at("us-east-1", None)], *ALL)
    first, stressed, unknown, idle = got
    assert first[C.WATER_COOLING] == pytest.approx(13.8)
    assert first[C.WATER_ELECTRICITY] == pytest.approx(100 * 1.15 * 2.312704)
    assert first[C.WATER_STRESS] is None
    assert first[C.INTENSITY] == 384.4
    assert first[C.OPERATIONAL] == pytest.approx(100 * 384.4 * 1.15 * 1.04 * 1.08)
    assert stressed[C.WATER_STRESS] == pytest.approx(142 * 0.98 + 142 * 3.436844)
    assert unknown[C.OPERATIONAL] is None and unknown[C.WATER_COOLING] is None and unknown[C.PUE] == 1.15
    assert idle[C.INTENSITY] is None and idle[C.PUE] == 1.15


def test_zero_energy_has_intensity_but_no_water(spark):
    row = run(spark, C.AWS, C.NATIVE, [at("us-east-1", 0.0)], *ALL)[0]
    assert row[C.INTENSITY] == 384.4 and row[C.OPERATIONAL] == 0.0 and row[C.WATER_COOLING] is None


@pytest.mark.parametrize(
    ("provider", "region", "intensity", "wcf", "stress"),
    [
        (C.AWS, "us-east-1", 384.4, 2.312704, 2),
        (C.AWS, "eu-west-1", 256.54, 1.47693, 0),
        (C.AWS, "us-west-2", 184.02, 9.48246, 1),
        (C.AWS, "ap-southeast-1", 497.09, None, None),
        (C.AWS, "me-central-1", 467.51, None, 4),
        (C.GOOGLE, "us-east1", 259.37, 2.294556, 2),
        (C.AZURE, "eastus", 327.17, 2.312704, 2),
    ],
)
def test_region_table(spark, provider, region, intensity, wcf, stress):
    dim = Factors.default(spark).region_dim(provider)
    row = dim.frame.where(F.col("region") == region).first()
    assert (row["intensity"], row["wcf"], row["stress"]) == (intensity, wcf, stress)
    assert dim.small


def test_only_usage_is_enriched(spark):
    kinds = ("Usage", "SavingsPlanCoveredUsage", "DiscountedUsage", "Tax", "Fee", None)
    rows = [{**at("us-east-1"), "line_item_line_item_type": kind} for kind in kinds]
    df = frame(spark, AWS_FIELDS, *rows).withColumn(
        "line_item_line_item_type", F.when(F.col("n") < 5, F.col("line_item_line_item_type"))
    )
    plan = Plan(C.AWS, C.NATIVE, tuple((op, {}) for op in ALL))
    got = plan.apply(df, Factors.default(spark)).orderBy("n").collect()
    assert [r[C.OPERATIONAL] is not None for r in got] == [True] * 3 + [False] * 3
    assert [r[C.REGION] is not None for r in got] == [True] * 3 + [False] * 3


def test_input_columns_named_like_results_are_overwritten(spark):
    df = frame(spark, AWS_FIELDS, at("us-east-1")).withColumns({"Region": F.lit("moon"), C.OPERATIONAL: F.lit(9.0)})
    plan = Plan(C.AWS, C.NATIVE, ((ops.region, {}), (ops.operational_emissions, {})))
    with pytest.raises(ContractError, match=C.INTENSITY):
        plan.check(df)
    out = Plan(C.AWS, C.NATIVE, tuple((op, {}) for op in ALL)).apply(df, Factors.default(spark))
    assert [c for c in out.columns if c.lower() == "region"] == ["region"]
    assert out.first()["region"] == "us-east-1" and out.first()[C.OPERATIONAL] > 9


def test_contract_names_the_operator_and_column(spark):
    df = frame(spark, AWS_FIELDS, {}).drop("pricing_unit")
    with pytest.raises(ContractError, match="storage.*pricing_unit"):
        Plan.default(C.AWS).check(df)
    late = Plan(C.AWS, C.NATIVE, ((ops.water, {}), (ops.region, {})))
    with pytest.raises(ContractError, match="water"):
        late.check(frame(spark, AWS_FIELDS, {}))


def test_plans_from_json(spark):
    plan = Plan.from_json(json.dumps({"modules": [{"name": "region"}, {"name": "gpu", "config": {"x": 1}}]}), C.AWS)
    assert [op.name for op, _ in plan.steps] == ["region", "gpu"] and plan.steps[1][1] == {"x": 1}
    with pytest.raises(ValueError, match="unknown operator"):
        Plan.from_json('{"modules": [{"name": "nope"}]}', C.AWS)
    with pytest.raises(ValueError, match="not an operator"):
        Plan.from_json('{"modules": [{"name": "x"}]}', C.AWS, extra={"x": object()})
    with pytest.raises(ValueError, match="provider"):
        Plan.from_json('{"modules": []}', "")
    with pytest.raises(ValueError, match="no default plan"):
        Plan.default(C.GOOGLE)


def test_default_plans_list_their_steps():
    native = [op.name for op, _ in Plan.default(C.AWS).steps]
    assert native == [
        "region", "storage", "network", "compute", "serverless", "gpu", "tokens", "efficiency", "water",
        "carbon_intensity", "operational_emissions", "aws_bridge",
    ]
    assert [op.name for op, _ in Plan.default(C.AWS, C.FOCUS).steps] == native[:-1]
    azure = Plan.default(C.AZURE)
    assert dict((op.name, p) for op, p in azure.steps)["efficiency"] == {"default": 1.17}


def test_own_operator_can_follow_any_other(spark):
    double = Operator(
        "double", bound(extra=(C.ENERGY,)), ("twice",), lambda df, run: run.put(df, twice=F.col(C.ENERGY) * 2),
        types={"twice": "double"},
    )
    plan = Plan(C.AWS, C.NATIVE, ((ops.network_energy, {}), (double, {})))
    assert plan.apply(frame(spark, AWS_FIELDS, at("x")), Factors.default(spark)).first()["twice"] == pytest.approx(200)


def test_aws_bridge(spark):
    schema = ", ".join(
        [
            "line_item_line_item_type string, line_item_unblended_cost double, product_servicecode string",
            "line_item_product_code string, line_item_operation string, line_item_usage_type string",
            "line_item_usage_account_id string, line_item_usage_start_date timestamp, line_item_usage_end_date string",
            "pricing_public_on_demand_cost double, resource_tags map<string,string>, product_region_code string",
        ]
    )
    start = dt.datetime(2025, 5, 1, 3, 4, 5)
    df = spark.createDataFrame(
        [
            ("Usage", 1.5, "", "AmazonEC2", "", "BoxUsage:t3.micro", "", start, "2025-05-01T04:00:00Z", None, {"a": "b"}, "EU-West-1"),
            ("Tax", 1.5, "x", "AmazonEC2", "", "y", "", start, "", 2.0, None, None),
        ],
        schema,
    )
    plan = Plan(C.AWS, C.NATIVE, ((ops.aws_bridge, {}),))
    row, tax = plan.apply(df, Factors.default(spark)).collect()
    assert row["BilledCost"] == 1.5 and row["ListCost"] is None and row["RegionId"] == "eu-west-1"
    assert row["ServiceName"] is None and row["x_Operation"] is None and row["SubAccountId"] == ""
    assert row["SkuMeter"] == "BoxUsage:t3.micro" and row["Tags"] == {"a": "b"}
    assert row["ChargePeriodStart"].endswith(":04:05Z") and row["ChargePeriodEnd"] == "2025-05-01T04:00:00Z"
    assert tax["BilledCost"] is None and tax["ChargeCategory"] is None


def test_instants_print_fractions_only_where_there_are_any(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp'2025-01-01 00:00:00', timestamp'2025-01-01 00:00:00.5',"
        " timestamp'2025-01-01 00:00:00.123456')) AS t"
    )
    assert [r[0] for r in df.select(bridge.instant(df, "t")).collect()] == [
        "2025-01-01T00:00:00Z", "2025-01-01T00:00:00.500Z", "2025-01-01T00:00:00.123456Z",
    ]


def test_azure_bridge(spark):
    df = frame(spark, AZURE_FIELDS, {"ResourceLocation": "UKSouth", "MeterCategory": "Storage"}).withColumns(
        {
            "CostInBillingCurrency": F.lit(2.5),
            "SubscriptionId": F.lit("sub"),
            "Date": F.lit("2026-06-29").cast("date"),
        }
    )
    row = Plan(C.AZURE, C.NATIVE, ((ops.azure_bridge, {}),)).apply(df, Factors.default(spark)).first()
    assert (row["ChargePeriodStart"], row["ChargePeriodEnd"]) == ("2026-06-29", "2026-06-30")
    assert row["RegionId"] == "uksouth" and row["ServiceName"] == "Storage"


def test_every_aws_step_stays_on_the_map_side(spark, sf_dir):
    """No shuffle of usage rows and no Python in an enrichment plan."""
    from gridtally.workload.q_enrich import enriched

    plan = enriched(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    facts = plan.split("BroadcastExchange")[0]
    assert "Python" not in plan and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in facts
    assert plan.count("BroadcastHashJoin") >= 4
