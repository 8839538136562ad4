"""Queries over reports, shares and advice."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors import fixed
from gridtally.factors.tables import parse_block
from gridtally.functions.common import usage_charge
from gridtally.functions.sums import exact_sums
from gridtally.operators import split as S
from gridtally.operators.quality import lookup_gaps
from gridtally.plans import advice as A
from gridtally.plans import reports as R
from gridtally.sources.usage import conform
from gridtally.workload import oracle as O
from gridtally.workload import rows as W
from gridtally.workload.q_enrich import enriched
from gridtally.workload.registry import query

U = "\"ChargeCategory\" LIKE '%Usage'"
COVERED = f"{C.OPERATIONAL} IS NOT NULL"
PERIODS = ("1997-03", "1997-04", "", "1998-01")
PLACES = ("us-east-1", "ap-south-1", "EU-WEST-1", "")
IN_SCOPE = (
    "(\"BILLING_PERIOD\" IN ('1997-03', '1997-04', '1998-01') AND region IN ('us-east-1', 'ap-south-1', 'EU-WEST-1'))"
)


@lru_cache(maxsize=8)
def cur(spark, sf_dir) -> DataFrame:
    """Enriched lines under report names."""
    return conform(enriched(spark, sf_dir))


def sql(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return O.with_(*O.aws_report(), *ctes) + select


def shown(**measures: str) -> str:
    return ", ".join(f"{O.r2(value)} AS {name}" for name, value in measures.items())


SUMMARY = shown(
    energy_kwh=O.exact(C.ENERGY),
    operational_kg=O.kg(C.OPERATIONAL),
    embodied_kg=O.kg(C.EMBODIED),
    water_usage_l=O.water(),
)
USAGE_MEASURES = shown(
    total_cost=O.exact('"BilledCost"', U),
    energy_kwh=O.exact(C.ENERGY, U),
    operational_kg=O.kg(C.OPERATIONAL, U),
    embodied_kg=O.kg(C.EMBODIED, U),
    total_emissions_kg=O.all_kg(U),
    water_usage_l=O.water(U),
)
PERIOD_SUMMARY = f'summary AS (SELECT "BILLING_PERIOD", {SUMMARY} FROM cur GROUP BY 1)'


# --- fixed report ------------------------------------------------------------------


@query("row_count", sql("SELECT count(*) AS row_count FROM cur"))
def row_count(spark, sf_dir):
    return R.row_count(cur(spark, sf_dir))


@query("summary_by_period", sql(PERIOD_SUMMARY, "SELECT * FROM summary"))
def summary_by_period(spark, sf_dir):
    return R.summary_by_period(cur(spark, sf_dir))


_TOTAL = shown(
    energy_kwh=f"coalesce({O.exact('energy_kwh')}, 0E0)",
    operational_kg=f"coalesce({O.exact('operational_kg')}, 0E0)",
    embodied_kg=f"coalesce({O.exact('embodied_kg')}, 0E0)",
    water_usage_l=f"coalesce({O.exact('water_usage_l')}, 0E0)",
)


@query(
    "summary_total_row",
    sql(PERIOD_SUMMARY, f"SELECT * FROM summary UNION ALL SELECT 'TOTAL' AS \"BILLING_PERIOD\", {_TOTAL} FROM summary"),
)
def summary_total_row(spark, sf_dir):
    return R.with_total(R.summary_by_period(cur(spark, sf_dir)))


@query(
    "union_total_row",
    sql(
        'r AS (SELECT region AS "BILLING_PERIOD", ' + SUMMARY + " FROM cur WHERE region <> '' GROUP BY 1)",
        f"SELECT * FROM r UNION ALL SELECT 'ALL' AS \"BILLING_PERIOD\", {_TOTAL} FROM r",
    ),
)
def union_total_row(spark, sf_dir):
    """The same total line under a summary by region."""
    lines = cur(spark, sf_dir).where("region <> ''").withColumn(C.BILLING_PERIOD, F.col(C.REGION))
    return R.with_total(R.summary_by_period(lines), "ALL")


TOP_SERVICES = f"""SELECT "ServiceName", {shown(
    co2_usage_kg=O.kg(C.OPERATIONAL), energy_kwh=O.exact(C.ENERGY), co2_embodied_kg=O.kg(C.EMBODIED),
    water_usage_l=O.water())}
  FROM cur WHERE {COVERED} GROUP BY 1
  ORDER BY co2_usage_kg DESC NULLS LAST, co2_embodied_kg DESC NULLS LAST, energy_kwh DESC NULLS LAST, "ServiceName" """


@query("top_services", sql(TOP_SERVICES + " LIMIT 20"))
def top_services(spark, sf_dir):
    return R.top_services(cur(spark, sf_dir))


@query("top_k", sql(TOP_SERVICES + " LIMIT 3"))
def top_k(spark, sf_dir):
    return R.top_services(cur(spark, sf_dir), 3)


INSTANCES = f"""inst AS (SELECT instance_type, {shown(
    co2_usage_kg=O.kg(C.OPERATIONAL), co2_embodied_kg=O.kg(C.EMBODIED), water_usage_l=O.water())}
  FROM (SELECT *, regexp_extract("SkuMeter", ':((?:[a-z][a-z0-9-]*\\.)+[a-z0-9]+)$', 1) AS instance_type FROM cur)
  WHERE length(instance_type) > 0 GROUP BY 1
  ORDER BY co2_usage_kg DESC NULLS LAST, instance_type LIMIT 20)"""


@query("top_instance_types", sql(INSTANCES, "SELECT * FROM inst"))
def top_instance_types(spark, sf_dir):
    return R.top_instance_types(cur(spark, sf_dir))


def coverage_sql(cost: str, charge: str) -> str:
    return f"""cov AS (SELECT {O.exact(cost)} AS total, {O.exact(cost, COVERED)} AS covered
  FROM cur WHERE {charge} LIKE '%Usage'),
coverage AS (SELECT {O.r2('covered * 100E0 / nullif(total, 0)')} AS coverage_pct, {O.r2('covered')} AS covered_cost,
  {O.r2('total')} AS total_cost FROM cov)"""


COVERAGE = coverage_sql('"BilledCost"', '"ChargeCategory"')


@query("cost_coverage", sql(COVERAGE, "SELECT * FROM coverage"))
def cost_coverage(spark, sf_dir):
    return R.cost_coverage(cur(spark, sf_dir))


@query("native_cost_coverage", sql(coverage_sql("cost", "native_charge"), "SELECT * FROM coverage"))
def native_cost_coverage(spark, sf_dir):
    return R.cost_coverage(enriched(spark, sf_dir), "line_item_unblended_cost", "line_item_line_item_type")


UNCOVERED = f"""uncovered AS (SELECT "ServiceName", {O.r2(O.exact('"BilledCost"'))} AS cost
  FROM cur WHERE NOT ({COVERED}) AND {U} GROUP BY 1 ORDER BY cost DESC NULLS LAST, "ServiceName" NULLS LAST LIMIT 20)"""


@query("uncovered_services", sql(UNCOVERED, "SELECT * FROM uncovered"))
def uncovered_services(spark, sf_dir):
    return R.uncovered_services(cur(spark, sf_dir))


def regional_sql(list_cost: str) -> str:
    op, em = O.exact(C.OPERATIONAL), O.exact(C.EMBODIED)
    stress = f"coalesce({O.exact(C.WATER_STRESS)}, 0E0)"
    return f"""regional AS (SELECT region, {shown(
        co2_usage_kg=O.kg(C.OPERATIONAL), energy_kwh=O.exact(C.ENERGY), carbon_intensity=O.mean(C.INTENSITY),
        water_usage_l=O.water(), water_stress_area_l=stress, pue=O.mean(C.PUE),
        g_co2_per_dollar=f"({op} + {em}) / nullif({O.exact(list_cost)}, 0)")}
  FROM cur WHERE {COVERED} GROUP BY 1)"""


REGIONAL = regional_sql('"ListCost"')


@query("regional_report", sql(REGIONAL, "SELECT * FROM regional"))
def regional_report(spark, sf_dir):
    return R.regional_report(cur(spark, sf_dir))


@query("native_regional", sql(regional_sql("list_cost"), "SELECT * FROM regional"))
def native_regional(spark, sf_dir):
    return R.regional_report(enriched(spark, sf_dir), "pricing_public_on_demand_cost")


@query(
    "order_by_multi",
    sql(
        REGIONAL,
        """SELECT region, energy_kwh, co2_usage_kg FROM regional
        ORDER BY energy_kwh DESC NULLS LAST, co2_usage_kg DESC NULLS LAST, region DESC NULLS LAST LIMIT 5""",
    ),
)
def order_by_multi(spark, sf_dir):
    return R.regional_report(cur(spark, sf_dir)).select(C.REGION, "energy_kwh", "co2_usage_kg").limit(5)


# --- interactive views -----------------------------------------------------------------


@query(
    "report_usage_predicate",
    sql(
        f"""SELECT native_charge AS charge, count(*) AS lines, count(*) FILTER (WHERE {U}) AS usage_lines,
        {O.exact('"BilledCost"', U)} AS usage_cost FROM cur GROUP BY 1"""
    ),
)
def report_usage_predicate(spark, sf_dir):
    counts = [F.count(F.lit(1)).alias("lines"), F.count_if(usage_charge()).alias("usage_lines")]
    charge = F.col("line_item_line_item_type").alias("charge")
    return exact_sums(cur(spark, sf_dir), charge, also=counts, usage_cost=F.when(usage_charge(), F.col("BilledCost")))


@query("filter_selection", sql(f"SELECT order_id, line_no, \"BILLING_PERIOD\", region FROM cur WHERE {IN_SCOPE}"))
def filter_selection(spark, sf_dir):
    lines = R.select_scope(cur(spark, sf_dir), PERIODS, PLACES)
    return lines.select("order_id", "line_no", C.BILLING_PERIOD, C.REGION)


@query(
    "filter_options",
    sql(
        """SELECT DISTINCT 'period' AS kind, "BILLING_PERIOD" AS value FROM cur WHERE "BILLING_PERIOD" IS NOT NULL
        UNION ALL SELECT DISTINCT 'region', region FROM cur WHERE region <> ''"""
    ),
)
def filter_options(spark, sf_dir):
    return R.scope_options(cur(spark, sf_dir))


def overview_sql(scope: str) -> str:
    used = f"{scope} AND {U}"
    return sql(
        f"""SELECT count(*) FILTER (WHERE {scope}) AS row_count, {shown(
            total_cost=f"coalesce({O.exact('"BilledCost"', used)}, 0E0)",
            energy_kwh=f"coalesce({O.exact(C.ENERGY, used)}, 0E0)",
            operational_kg=f"coalesce({O.kg(C.OPERATIONAL, used)}, 0E0)",
            embodied_kg=f"coalesce({O.kg(C.EMBODIED, used)}, 0E0)",
            total_emissions_kg=O.all_kg(used),
            water_l=O.water(used),
            coverage_pct=f'''{O.exact('"BilledCost"', f"{U} AND {COVERED}")} * 100E0
                / nullif({O.exact('"BilledCost"', U)}, 0)''')} FROM cur"""
    )


@query("overview", overview_sql(IN_SCOPE))
def overview(spark, sf_dir):
    return R.overview(cur(spark, sf_dir), PERIODS, PLACES)


@query("cross_coverage", overview_sql("TRUE"))
def cross_coverage(spark, sf_dir):
    """Totals of everything beside the coverage of everything."""
    return R.overview(cur(spark, sf_dir))


@query("trend", sql(f'SELECT "BILLING_PERIOD", {USAGE_MEASURES} FROM cur GROUP BY 1'))
def trend(spark, sf_dir):
    return R.trend(cur(spark, sf_dir))


@query("trend_in_scope", sql(f'SELECT "BILLING_PERIOD", {USAGE_MEASURES} FROM cur WHERE {IN_SCOPE} GROUP BY 1'))
def trend_in_scope(spark, sf_dir):
    return R.trend(R.select_scope(cur(spark, sf_dir), PERIODS, PLACES))


EMITTERS = f"""emitters AS (SELECT coalesce(nullif("ServiceName", ''), 'Unknown service') AS service_name,
    coalesce(nullif(region, ''), 'Unknown region') AS region_name, {USAGE_MEASURES}
  FROM cur WHERE {COVERED} GROUP BY 1, 2
  ORDER BY total_emissions_kg DESC NULLS LAST, operational_kg DESC NULLS LAST, energy_kwh DESC NULLS LAST, 1, 2
  LIMIT 25)"""


@query(
    "top_emitters",
    sql(
        EMITTERS,
        """SELECT service_name, region_name AS region, total_cost, energy_kwh, operational_kg AS co2_usage_kg,
        embodied_kg AS co2_embodied_kg, total_emissions_kg, water_usage_l FROM emitters""",
    ),
)
def top_emitters(spark, sf_dir):
    return R.top_emitters(cur(spark, sf_dir), 25)


@query(
    "top_emitter_totals",
    sql(
        EMITTERS,
        f"""SELECT count(*) AS listed, {shown(co2_usage_kg=O.exact('operational_kg'), total_cost=O.exact('total_cost'))},
        first(service_name ORDER BY total_emissions_kg DESC, operational_kg DESC, energy_kwh DESC) AS largest_emitter,
        max(total_emissions_kg) AS largest_kg FROM emitters""",
    ),
)
def top_emitter_totals(spark, sf_dir):
    return R.top_emitter_totals(R.top_emitters(cur(spark, sf_dir), 25))


def _weighted(name: str) -> str:
    both = f"{U} AND {C.ENERGY} IS NOT NULL AND {name} IS NOT NULL"
    return f"{O.exact(f'{C.ENERGY} * {name}', both)} / nullif({O.exact(C.ENERGY, both)}, 0)"


_GRAMS = f"(coalesce({O.exact(C.OPERATIONAL, U)}, 0E0) + coalesce({O.exact(C.EMBODIED, U)}, 0E0))"
WEIGHTED = f"""weighted AS (SELECT coalesce(nullif(region, ''), 'Unknown region') AS region_name, {shown(
    co2_usage_kg=f"coalesce({O.kg(C.OPERATIONAL, U)}, 0E0)",
    co2_embodied_kg=f"coalesce({O.kg(C.EMBODIED, U)}, 0E0)",
    total_emissions_kg=O.all_kg(U),
    energy_kwh=f"coalesce({O.exact(C.ENERGY, U)}, 0E0)",
    carbon_intensity=_weighted(C.INTENSITY),
    water_usage_l=O.water(U),
    water_stress_area_l=f"coalesce({O.exact(C.WATER_STRESS, U)}, 0E0)",
    pue=_weighted(C.PUE),
    g_co2_per_dollar=f'''{_GRAMS} / nullif({O.exact('"BilledCost"', U)}, 0)''')}
  FROM cur WHERE {COVERED} GROUP BY 1)"""


@query("regions_weighted", sql(WEIGHTED, "SELECT region_name AS region, * EXCLUDE (region_name) FROM weighted"))
def regions_weighted(spark, sf_dir):
    return R.regions_weighted(cur(spark, sf_dir))


@query(
    "region_share",
    sql(
        WEIGHTED,
        f"all_kg AS (SELECT {O.exact('total_emissions_kg')} AS kg FROM weighted)",
        f"""SELECT region_name AS region, total_emissions_kg,
        {O.r2('total_emissions_kg * 100E0 / (SELECT kg FROM all_kg)')} AS share_pct FROM weighted""",
    ),
)
def region_share(spark, sf_dir):
    return R.region_share(R.regions_weighted(cur(spark, sf_dir)))


# --- tags ----------------------------------------------------------------------------------

TAGS = """tags AS (SELECT 'team' AS tag_key, team AS tag_value FROM cur WHERE team IS NOT NULL
  UNION ALL SELECT 'env', env FROM cur WHERE env IS NOT NULL)"""


@query("tag_keys", sql(TAGS, "SELECT DISTINCT tag_key FROM tags"))
def tag_keys(spark, sf_dir):
    return R.tag_keys(cur(spark, sf_dir))


@query("distinct_keys", sql(TAGS, "SELECT DISTINCT tag_key, tag_value FROM tags"))
def distinct_keys(spark, sf_dir):
    return R.tag_entries(cur(spark, sf_dir)).select(
        F.col("key").alias("tag_key"), F.col("value").alias("tag_value")
    ).distinct()


COVERAGE_BY_KEY = f"""SELECT tag_key, {O.r2('count(*) * 100E0 / (SELECT count(*) FROM cur)', 1)} AS coverage_pct
  FROM tags WHERE tag_value <> '' GROUP BY 1 HAVING coverage_pct > 0
  ORDER BY coverage_pct DESC, tag_key LIMIT 10"""


@query("tag_coverage", sql(TAGS, COVERAGE_BY_KEY))
def tag_coverage(spark, sf_dir):
    return R.tag_coverage(cur(spark, sf_dir))


@query("tag_breakdown", sql(f"SELECT team AS tag_value, {SUMMARY} FROM cur GROUP BY 1"))
def tag_breakdown(spark, sf_dir):
    return R.tag_breakdown(cur(spark, sf_dir), "team")


@query("tag_breakdown_env", sql(f"SELECT env AS tag_value, {SUMMARY} FROM cur GROUP BY 1"))
def tag_breakdown_env(spark, sf_dir):
    """Missing and empty values are groups of their own."""
    return R.tag_breakdown(cur(spark, sf_dir), "env")


TEAM_USAGE = f"teams AS (SELECT team AS tag_value, {USAGE_MEASURES} FROM cur WHERE team <> '' GROUP BY 1)"


@query("tag_breakdown_usage", sql(TEAM_USAGE, "SELECT * FROM teams"))
def tag_breakdown_usage(spark, sf_dir):
    return R.tag_breakdown_usage(cur(spark, sf_dir), "team")


@query(
    "order_nulls_last",
    sql(f"SELECT team AS tag_value, {SUMMARY} FROM cur GROUP BY 1 ORDER BY embodied_kg DESC NULLS LAST, 1 NULLS LAST LIMIT 7"),
)
def order_nulls_last(spark, sf_dir):
    rows = R.tag_breakdown(cur(spark, sf_dir), "team")
    return rows.orderBy(F.desc_nulls_last("embodied_kg"), F.asc_nulls_last("tag_value")).limit(7)


MEASURES = ("total_cost", "energy_kwh", "operational_kg", "embodied_kg", "total_emissions_kg", "water_usage_l")


def other_sql(metric: str, limit: int) -> str:
    rest = ", ".join(f"coalesce({O.exact(m)}, 0E0) AS {m}" for m in MEASURES)
    return sql(
        TEAM_USAGE,
        f"ranked AS (SELECT *, row_number() OVER (ORDER BY {metric} DESC NULLS LAST, tag_value) AS rk, "
        "count(*) OVER () AS n FROM teams)",
        f"""SELECT tag_value, tag_value AS label, {', '.join(MEASURES)} FROM ranked WHERE n <= {limit} OR rk < {limit}
        UNION ALL SELECT '(other)', 'Other (' || CAST(count(*) AS VARCHAR) || ' values)', {rest}
        FROM ranked WHERE n > {limit} AND rk >= {limit} HAVING count(*) > 0""",
    )


@query("tag_top_other", other_sql("total_emissions_kg", 40))
def tag_top_other(spark, sf_dir):
    return R.top_with_other(R.tag_breakdown_usage(cur(spark, sf_dir), "team"), "total_emissions_kg")


@query("union_other_row", other_sql("total_cost", 60))
def union_other_row(spark, sf_dir):
    """Few enough values: no line of others."""
    return R.top_with_other(R.tag_breakdown_usage(cur(spark, sf_dir), "team"), "total_cost", 60)


AZURE_CUR = [
    *O.azure(C.NATIVE),
    f"""cur AS (SELECT *, CASE WHEN usage THEN native_charge END AS "ChargeCategory",
      CASE WHEN usage THEN cost END AS "BilledCost" FROM x)""",
]


def azure_cur(spark, sf_dir) -> DataFrame:
    return conform(enriched(spark, sf_dir, C.AZURE, C.NATIVE))


@query("tag_keys_json", O.with_(*AZURE_CUR, TAGS) + "SELECT DISTINCT tag_key FROM tags")
def tag_keys_json(spark, sf_dir):
    return R.tag_keys(azure_cur(spark, sf_dir))


@query("tag_coverage_json", O.with_(*AZURE_CUR, TAGS) + COVERAGE_BY_KEY)
def tag_coverage_json(spark, sf_dir):
    return R.tag_coverage(azure_cur(spark, sf_dir))


@query(
    "tag_breakdown_usage_json",
    O.with_(*AZURE_CUR) + f"SELECT team AS tag_value, {USAGE_MEASURES} FROM cur WHERE team <> '' GROUP BY 1",
)
def tag_breakdown_usage_json(spark, sf_dir):
    return R.tag_breakdown_usage(azure_cur(spark, sf_dir), "team")


@query(
    "event_tag_values",
    """SELECT json_extract_string(props, '$.k') AS tag_value, count(*) AS lines
    FROM events WHERE json_extract_string(props, '$.k') <> '' GROUP BY 1""",
)
def event_tag_values(spark, sf_dir):
    """Tag values out of the event properties, which are JSON text."""
    lines = W.table(spark, sf_dir, "events").withColumnRenamed("props", "Tags")
    value = R.tag_value(lines, "k")
    return lines.where(value != "").groupBy(value.alias("tag_value")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "breakdown_service_operation",
    sql(
        f"""SELECT product_code AS line_item_product_code, service_code AS product_servicecode,
        operation AS line_item_operation, {shown(
            co2_usage_kg=O.kg(C.OPERATIONAL), co2_embodied_kg=O.kg(C.EMBODIED), energy_usage_kwh=O.exact(C.ENERGY))}
        FROM cur WHERE {C.OPERATIONAL} > 0.01E0 GROUP BY ALL"""
    ),
)
def breakdown_service_operation(spark, sf_dir):
    keys = ("line_item_product_code", "product_servicecode", "line_item_operation")
    return R.breakdown(enriched(spark, sf_dir), keys)


# --- advice -----------------------------------------------------------------------------------


def equivalence_sql(flavor: str) -> str:
    kept = [(m, s, u, p) for m, s, f, u, p in parse_block(fixed.EQUIVALENCES, str, int, str, str, float) if f in (None, flavor)]
    return sql(
        O.values("per", "metric, slot, unit, per", kept),
        f"""t AS (SELECT "BILLING_PERIOD", {O.all_kg(U)} AS emissions, coalesce({O.exact(C.ENERGY, U)}, 0E0) AS energy,
          {O.water(U)} AS water FROM cur GROUP BY 1)""",
        "long AS (UNPIVOT t ON emissions, energy, water INTO NAME metric VALUE amount)",
        """SELECT "BILLING_PERIOD", metric, slot, unit, greatest(amount, 0E0) / per AS quantity FROM long JOIN per USING (metric)""",
    )


def totals_by_period(spark, sf_dir) -> DataFrame:
    used, sums = usage_charge(), R.Measures()
    shown = {"co2_kg": sums.all_emissions_kg(used), "energy_kwh": sums.total(C.ENERGY, used), "water_l": sums.water(used)}
    by_period = sums.by(cur(spark, sf_dir), C.BILLING_PERIOD)
    return by_period.select(C.BILLING_PERIOD, *[value.alias(name) for name, value in shown.items()])


@query("equivalences", equivalence_sql("Everyday"))
def equivalences(spark, sf_dir):
    return A.equivalences(totals_by_period(spark, sf_dir), by=[C.BILLING_PERIOD])


@query("equivalences_nature", equivalence_sql("Nature"))
def equivalences_nature(spark, sf_dir):
    return A.equivalences(totals_by_period(spark, sf_dir), "Nature", [C.BILLING_PERIOD])


@query(
    "recommend_coverage",
    sql(
        COVERAGE,
        UNCOVERED,
        """SELECT 'coverage' AS kind, coalesce("ServiceName", 'unknown') AS subject, cost AS value,
        'no emissions are modelled for ' || coalesce("ServiceName", 'unknown') AS message
        FROM uncovered WHERE cost > 0 AND (SELECT coverage_pct FROM coverage) < 80
        ORDER BY cost DESC, "ServiceName" NULLS LAST LIMIT 3""",
    ),
)
def recommend_coverage(spark, sf_dir):
    lines = cur(spark, sf_dir)
    return A.recommend_coverage(R.cost_coverage(lines), R.uncovered_services(lines))


@query(
    "recommend_region",
    sql(
        REGIONAL,
        "low AS (SELECT region, carbon_intensity FROM regional WHERE carbon_intensity IS NOT NULL "
        "ORDER BY carbon_intensity, region LIMIT 1)",
        f"""SELECT 'region' AS kind, r.region AS subject,
        {O.r2('r.carbon_intensity / greatest(low.carbon_intensity, 1E0)', 1)} AS value,
        'times the carbon intensity of ' || low.region AS message
        FROM regional r, low WHERE r.carbon_intensity > 300 AND (SELECT count(carbon_intensity) FROM regional) >= 2
        ORDER BY r.carbon_intensity DESC, r.region LIMIT 2""",
    ),
)
def recommend_region(spark, sf_dir):
    return A.recommend_region(R.regional_report(cur(spark, sf_dir)))


@query(
    "recommend_instance",
    sql(
        INSTANCES,
        O.values("arm", "family, arm_family", parse_block(fixed.ARM_FAMILIES, str, str)),
        """first_one AS (SELECT * REPLACE (regexp_replace(instance_type, '^p3[.]', 'c5.') AS instance_type) FROM inst
          ORDER BY co2_usage_kg DESC, instance_type LIMIT 1)""",
        """SELECT 'instance' AS kind, instance_type AS subject, co2_usage_kg AS value,
        'consider ' || arm_family || substr(instance_type, length(family) + 1) AS message
        FROM first_one JOIN arm ON family = split_part(instance_type, '.', 1)""",
    ),
)
def recommend_instance(spark, sf_dir):
    """Over all lines; those of p3 machines are billed as c5, so that the largest emitter has an Arm counterpart."""
    lines = cur(spark, sf_dir).withColumn("SkuMeter", F.regexp_replace("SkuMeter", ":p3[.]", ":c5."))
    return A.recommend_instance(R.top_instance_types(lines))


@query(
    "recommend_trend",
    sql(
        PERIOD_SUMMARY,
        """v AS (SELECT CAST(3996 - CAST(substr("BILLING_PERIOD", 1, 4) AS INT) AS VARCHAR) || '-' ||
          lpad(CAST(13 - CAST(substr("BILLING_PERIOD", 6, 2) AS INT) AS VARCHAR), 2, '0') AS "BILLING_PERIOD", operational_kg
          FROM summary WHERE operational_kg IS NOT NULL)""",
        """ends AS (SELECT min("BILLING_PERIOD") AS f, max("BILLING_PERIOD") AS l,
          arg_min(operational_kg, "BILLING_PERIOD") AS fk, arg_max(operational_kg, "BILLING_PERIOD") AS lk, count(*) AS n FROM v)""",
        f"""SELECT 'trend' AS kind, l AS subject, {O.r2('(lk / fk - 1E0) * 100E0', 0)} AS value,
        'per cent more emissions than in ' || f AS message FROM ends WHERE n >= 2 AND fk > 0 AND lk > fk * 1.10E0""",
    ),
)
def recommend_trend(spark, sf_dir):
    """Over all periods, counted backwards in time, so that emissions rise."""
    summary = R.summary_by_period(cur(spark, sf_dir))
    year, month = (F.substring(C.BILLING_PERIOD, at, n).cast("int") for at, n in ((1, 4), (6, 2)))
    mirrored = F.concat((F.lit(3996) - year).cast("string"), F.lit("-"), F.lpad((F.lit(13) - month).cast("string"), 2, "0"))
    return A.recommend_trend(summary.withColumn(C.BILLING_PERIOD, mirrored))


# --- gaps -------------------------------------------------------------------------------------------


def gaps_sql(key: str, known: str) -> str:
    return O.with_(*O.aws(C.NATIVE)) + (
        f"SELECT {key} AS key, count(*) AS lines, {O.exact('cost')} AS cost FROM x "
        f"WHERE usage AND {key} IS NOT NULL AND {key} NOT IN ({known}) GROUP BY 1"
    )


@query("lookup_gaps", gaps_sql("vm_type", "SELECT instance_type FROM vm"))
def instance_gaps(spark, sf_dir):
    from gridtally.functions.common import is_usage
    from gridtally.workload.q_enrich import AWS_RUN, ops

    lines = W.aws_native(spark, sf_dir).where(is_usage(C.AWS, C.NATIVE))
    known = W.sample_factors(spark, C.AWS).compute
    return lookup_gaps(lines, ops.instance_type(AWS_RUN), AWS_RUN.col("cost"), known, "instance_type")


@query("region_gaps", gaps_sql("nullif(region, '')", "SELECT region FROM ci"))
def region_gaps(spark, sf_dir):
    lines = enriched(spark, sf_dir)
    known = W.sample_factors(spark, C.AWS).region_dim(C.AWS)
    placed = type(known)(known.frame.where("intensity IS NOT NULL"), known.small)
    key = F.nullif(F.col(C.REGION), F.lit(""))
    return lookup_gaps(lines, key, F.col("line_item_unblended_cost"), placed, "region")


# --- splits -------------------------------------------------------------------------------------------

SPLIT_ROWS = f"""r AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no,
    CASE WHEN l_suppkey % 17 <> 0 THEN {O.PERIOD} END AS interval_name,
    'res-' || CAST(l_suppkey AS VARCHAR) AS owner, l_linenumber > 1 AS child,
    'ns-' || CAST(l_partkey % 40 AS VARCHAR) AS ns,
    CASE WHEN l_linenumber > 1 AND l_tax < 0.075E0 THEN l_quantity / 100E0 END AS ratio,
    CASE WHEN l_linenumber = 1 AND l_suppkey % 13 <> 0 THEN l_quantity * 0.5E0 END AS kwh,
    CASE WHEN l_linenumber = 1 AND l_suppkey % 13 <> 0 THEN l_extendedprice END AS op,
    CASE WHEN l_linenumber = 1 AND l_suppkey % 13 <> 0 THEN l_extendedprice * 0.25E0 END AS em FROM lineitem)"""
SPLIT_TOTALS = f"""t AS (SELECT interval_name, owner, coalesce({O.exact('kwh')}, 0E0) AS kwh,
    coalesce({O.exact('op')}, 0E0) AS op, coalesce({O.exact('em')}, 0E0) AS em,
    coalesce({O.exact('ratio')}, 0E0) AS ratio, count(*) FILTER (WHERE child) AS children FROM r GROUP BY 1, 2)"""
SHARES = """shares AS (SELECT r.*, CASE WHEN child AND t.ratio + t.kwh + t.op + t.em > 0 THEN r.ratio / nullif(t.ratio, 0) END AS w,
    t.kwh AS t_kwh, t.op AS t_op, t.em AS t_em
  FROM r JOIN t ON r.owner = t.owner AND r.interval_name IS NOT DISTINCT FROM t.interval_name)"""


@query(
    "split_owner_key",
    O.with_(SPLIT_ROWS) + "SELECT interval_name, owner, count(*) AS lines, count(*) FILTER (WHERE NOT child) AS parents FROM r GROUP BY 1, 2",
)
def split_owner_key(spark, sf_dir):
    return (
        W.split_rows(spark, sf_dir)
        .groupBy(F.col(S.INTERVAL).alias("interval_name"), S.owner().alias("owner"))
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if(S.is_parent()).alias("parents"))
    )


@query("split_group_totals", O.with_(SPLIT_ROWS, SPLIT_TOTALS) + "SELECT * FROM t")
def split_group_totals(spark, sf_dir):
    return S.group_totals(W.split_rows(spark, sf_dir)).withColumnsRenamed(
        {"interval": "interval_name", C.ENERGY: "kwh", C.OPERATIONAL: "op", C.EMBODIED: "em"}
    )


_SHARE_SQL = O.with_(SPLIT_ROWS, SPLIT_TOTALS, SHARES) + (
    f"SELECT order_id, line_no, owner, t_kwh * w AS split_{C.ENERGY}, t_op * w AS split_{C.OPERATIONAL}, "
    f"t_em * w AS split_{C.EMBODIED} FROM shares"
)


def _shares(df: DataFrame, impacts=S.DEFAULT_IMPACTS) -> DataFrame:
    return df.select("order_id", "line_no", S.owner().alias("owner"), *[S.PREFIX + name for name in impacts])


@query("split_allocate", _SHARE_SQL)
def split_allocate(spark, sf_dir):
    return _shares(S.allocate_splits(W.split_rows(spark, sf_dir)))


@query("join_group_totals", _SHARE_SQL)
def join_group_totals(spark, sf_dir):
    """The same with few groups broadcast, so that most go through the keyed join."""
    return _shares(S.allocate_splits(W.split_rows(spark, sf_dir), heavy_groups=10))


@query(
    "split_impact_columns",
    O.with_(SPLIT_ROWS, SPLIT_TOTALS)
    + f"""SELECT order_id, line_no, r.owner, CASE WHEN child AND t.ratio + t.op > 0 THEN t.op * (r.ratio / nullif(t.ratio, 0)) END
        AS split_{C.OPERATIONAL}
      FROM r JOIN t ON r.owner = t.owner AND r.interval_name IS NOT DISTINCT FROM t.interval_name""",
)
def split_impact_columns(spark, sf_dir):
    impacts = S.impact_list(C.OPERATIONAL)
    return _shares(S.allocate_splits(W.split_rows(spark, sf_dir), impacts), impacts)


@query(
    "split_custom_columns",
    O.with_(SPLIT_ROWS, SPLIT_TOTALS)
    + """SELECT order_id, line_no, r.owner, CASE WHEN child AND t.ratio + t.kwh + t.em > 0 THEN t.kwh * (r.ratio / nullif(t.ratio, 0)) END
        AS split_other_kwh,
      CASE WHEN child AND t.ratio + t.kwh + t.em > 0 THEN t.em * (r.ratio / nullif(t.ratio, 0)) END AS split_other_g
      FROM r JOIN t ON r.owner = t.owner AND r.interval_name IS NOT DISTINCT FROM t.interval_name""",
)
def split_custom_columns(spark, sf_dir):
    """Impact columns of another tool, one of them held as text."""
    lines = W.split_rows(spark, sf_dir).select(
        "*", F.col(C.ENERGY).cast("string").alias("other_kwh"), F.col(C.EMBODIED).alias("other_g")
    )
    impacts = S.impact_list("other_kwh, other_g")
    return _shares(S.allocate_splits(lines, impacts), impacts)


@query(
    "split_by_namespace",
    O.with_(SPLIT_ROWS, SPLIT_TOTALS, SHARES)
    + f"SELECT 'aws_eks_namespace' AS key, ns AS value, {O.exact('t_op * w')} AS total_g FROM shares GROUP BY 2",
)
def split_by_namespace(spark, sf_dir):
    return R.split_by_tag(S.allocate_splits(W.split_rows(spark, sf_dir)), "aws_eks_namespace")
