"""Reports and advice on hand-made enriched rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.functions.common import rounded
from gridtally.functions.sums import Sums, exact_sums
from gridtally.plans import advice as A
from gridtally.plans import reports as R
from gridtally.sources.usage import conform

FIELDS = (
    f"{C.BILLING_PERIOD} string, region string, ServiceName string, ChargeCategory string, BilledCost double, "
    f"ListCost double, SkuMeter string, {C.ENERGY} double, {C.OPERATIONAL} double, {C.EMBODIED} double, "
    f"{C.WATER_COOLING} double, {C.INTENSITY} double, {C.PUE} double, Tags map<string,string>"
)
ROWS = [
    ("2025-01", "us-east-1", "EC2", "Usage", 10.0, 20.0, "BoxUsage:m5.large", 2.0, 1000.0, 500.0, 1.0, 400.0, 1.2, {"team": "a"}),
    ("2025-01", "eu-north-1", "EC2", "DiscountedUsage", 5.0, 5.0, "BoxUsage:c5.large", 1.0, 20.0, None, None, 20.0, 1.1, {"team": "b"}),
    ("2025-02", "us-east-1", "S3", "Usage", 4.0, 8.0, "TimedStorage", 4.0, 2400.0, None, 2.0, 500.0, None, {"team": ""}),
    ("2025-02", "", "", "Usage", 1.0, 0.0, None, 1.0, 30.0, None, None, 30.0, 1.0, {"env": "x"}),
    ("2025-02", "us-east-1", "Support", "Usage", 30.0, 30.0, None, None, None, None, None, None, 1.2, None),
    ("2025-02", "us-east-1", "Tax", "Tax", 7.0, None, None, None, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def cur(spark):
    return conform(spark.createDataFrame(ROWS, FIELDS))


def rows(df):
    return [row.asDict() for row in df.collect()]


def spread_values(chooser):
    """Values of one sign or two, of few or very many sizes, and near-ties of doubles."""
    low, high = chooser.choice([(-12, 12), (-3, 3), (0, 1), (-17, 30), (5, 6)])
    values = [chooser.choice([-1, 1]) * chooser.random() * 10 ** chooser.uniform(low, high) for _ in range(chooser.choice([1, 2, 50]))]
    large = float(chooser.getrandbits(53) | 1 << 52) * 2.0 ** chooser.randint(-30, 40)
    tie = [large, math.ulp(large) / 2, math.ulp(large) * 2.0 ** -chooser.randint(5, 15)]
    return values if chooser.random() < 0.5 else [chooser.choice([-1, 1]) * v for v in tie[: chooser.choice([2, 3])]]


def test_sums_are_those_of_fsum(spark):
    chooser = random.Random(3)
    groups = {g: spread_values(chooser) for g in range(600)}
    groups |= {700: [1e30, 1.0, -1e30], 701: [0.0, -0.0], 702: [5.0, -5.0], 703: [1.5e30, 1e-17], 704: [0.1] * 1000}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [(700, None)], "g int, v double")
    for parts in (1, 7):
        got = {r.g: r.s for r in exact_sums(df.repartition(parts), "g", s=F.col("v")).collect()}
        assert got == {g: math.fsum(vs) for g, vs in groups.items()}


def test_sums_of_few_and_odd_values(spark):
    def total(*values):
        return exact_sums(spark.createDataFrame([(v,) for v in values], "v double"), s=F.col("v")).first().s

    assert total(None) is None and total(None, 1.5) == 1.5
    assert total(1e17, 2.5e200, -1.0) == 2.5e200 and total(1e-320, 1e-320) == 2e-320
    assert math.isnan(total(math.nan, 1.0)) and total(math.inf, 1.0) == math.inf and math.isnan(total(math.inf, -math.inf))


def test_one_aggregation_of_several_sums(spark):
    df = spark.createDataFrame([("a", 1.5, 1), ("a", -0.25, 0), ("b", None, 1)], "k string, v double, u int")
    sums = Sums()
    used, every = sums.total("v", F.col("u") == 1), sums.total("v")
    mean, count = sums.mean("v")
    rows_ = sums.by(df, "k", also=[F.count(F.lit(1)).alias("n"), count]).select("k", "n", used.alias("used"), every.alias("every"), mean.alias("mean"))
    assert sorted(map(tuple, rows_.collect())) == [("a", 2, 1.5, 1.25, 0.625), ("b", 1, None, None, None)]


@pytest.mark.parametrize("value, shown", [(1e17, 1e17), (-0.125, -0.13), (0.125, 0.13), (-2.0, -2.0), (1e-12, 0.0), (None, None)])
def test_rounding(spark, value, shown):
    df = spark.createDataFrame([(value,)], "a double")
    assert df.select(rounded(F.col("a")).alias("r")).first()["r"] == shown


def test_summary_and_total(cur):
    first, second, everything = rows(R.with_total(R.summary_by_period(cur)))
    assert (first["energy_kwh"], first["operational_kg"], first["embodied_kg"]) == (3.0, 1.02, 0.5)
    assert second["embodied_kg"] is None and second["water_usage_l"] == 2.0
    assert everything[C.BILLING_PERIOD] == "TOTAL" and everything["operational_kg"] == 3.45
    assert everything["embodied_kg"] == 0.5


def test_services_and_instances(cur):
    assert [r["ServiceName"] for r in rows(R.top_services(cur))] == ["S3", "EC2", ""]
    assert [r["instance_type"] for r in rows(R.top_instance_types(cur))] == ["m5.large", "c5.large"]


def test_coverage(cur):
    assert rows(R.cost_coverage(cur)) == [{"coverage_pct": 40.0, "covered_cost": 20.0, "total_cost": 50.0}]
    assert rows(R.uncovered_services(cur)) == [{"ServiceName": "Support", "cost": 30.0}]
    assert rows(R.cost_coverage(cur.where("false"))) == [{"coverage_pct": None, "covered_cost": None, "total_cost": None}]


def test_regions(cur):
    east = rows(R.regional_report(cur))[0]
    assert east["carbon_intensity"] == 450.0 and east["g_co2_per_dollar"] == pytest.approx(3900 / 28, abs=0.01)
    weighted = {r["region"]: r for r in rows(R.regions_weighted(cur))}
    assert weighted["us-east-1"]["carbon_intensity"] == pytest.approx((2 * 400 + 4 * 500) / 6, abs=0.01)
    assert weighted["us-east-1"]["pue"] == 1.2 and "Unknown region" in weighted
    shares = rows(R.region_share(R.regions_weighted(cur)))
    assert sum(r["share_pct"] for r in shares) == pytest.approx(100, abs=0.05)


def test_overview_scopes_totals_but_not_coverage(cur):
    row = rows(R.overview(cur, ["2025-01", ""], ["us-east-1"]))[0]
    assert row["row_count"] == 1 and row["total_cost"] == 10.0 and row["total_emissions_kg"] == 1.5
    assert row["coverage_pct"] == 40.0
    assert rows(R.overview(cur))[0]["row_count"] == len(ROWS)


def test_emitters(cur):
    top = R.top_emitters(cur, 0)
    assert [(r["service_name"], r["region"]) for r in rows(top)] == [("S3", "us-east-1")]
    got = rows(R.top_emitter_totals(R.top_emitters(cur)))[0]
    assert got["largest_emitter"] == "S3" and got["listed"] == 4 and got["total_cost"] == 20.0


def test_options(cur):
    got = [(r["kind"], r["value"]) for r in rows(R.scope_options(cur))]
    assert got == [("period", "2025-01"), ("period", "2025-02"), ("region", "eu-north-1"), ("region", "us-east-1")]


def test_tags_from_maps(cur):
    assert [r["tag_key"] for r in rows(R.tag_keys(cur))] == ["env", "team"]
    assert rows(R.tag_coverage(cur)) == [
        {"tag_key": "team", "coverage_pct": 33.3},
        {"tag_key": "env", "coverage_pct": 16.7},
    ]
    assert {r["tag_value"] for r in rows(R.tag_breakdown(cur, "team"))} == {"a", "b", "", None}
    assert [r["tag_value"] for r in rows(R.tag_breakdown_usage(cur, "team"))] == ["a", "b"]


def test_tags_from_json(cur):
    text = F.when(F.col("Tags").isNull(), "not json").otherwise(F.to_json("Tags"))
    df = cur.withColumn("Tags", text)
    assert [r["tag_key"] for r in rows(R.tag_keys(df))] == ["env", "team"]
    assert [r["tag_value"] for r in rows(R.tag_breakdown_usage(df, "team"))] == ["a", "b"]
    assert rows(R.tag_keys(df.drop("Tags"))) == []


@pytest.mark.parametrize("count", [39, 40, 41, 200])
def test_other_line(spark, count):
    data = [(f"v{n:03d}", float(n)) for n in range(count)]
    got = rows(R.top_with_other(spark.createDataFrame(data, "tag_value string, total_cost double"), "total_cost"))
    assert sum(r["total_cost"] for r in got) == sum(v for _, v in data)
    assert len(got) == min(count, 40)
    others = [r for r in got if r["tag_value"] == "(other)"]
    assert [r["label"] for r in others] == ([f"Other ({count - 39} values)"] if count > 40 else [])


def test_equivalences(spark):
    df = spark.createDataFrame([("x", 1000.0, -5.0, float("nan")), ("y", None, 7000.0, 150.0)], "team string, co2_kg double, energy_kwh double, water_l double")
    got = {(r["team"], r["metric"], r["slot"]): r["quantity"] for r in A.equivalences(df, by=["team"]).collect()}
    assert got["x", "emissions", 1] == pytest.approx(1000 / 0.17) and got["x", "emissions", 2] == 2.0
    assert got["x", "energy", 1] == 0.0 and got["x", "water", 2] == 0.0
    assert got["y", "energy", 1] == 2.0 and got["y", "water", 2] == 1.0 and len(got) == 12
    units = {r["unit"] for r in A.equivalences(df, "Tech").collect()}
    assert "hours of video streaming" in units and "flights" not in units


def test_recommendations(cur):
    got = {
        r["kind"]: r
        for r in A.recommendations(
            R.cost_coverage(cur), R.uncovered_services(cur), R.regional_report(cur), R.summary_by_period(cur), R.top_instance_types(cur)
        ).collect()
    }
    assert got["coverage"]["subject"] == "Support" and got["coverage"]["value"] == 30.0
    assert got["region"]["subject"] == "us-east-1" and got["region"]["value"] == 22.5
    assert got["instance"]["message"] == "consider m6g.large"
    assert got["trend"]["subject"] == "2025-02" and got["trend"]["value"] == 138.0
