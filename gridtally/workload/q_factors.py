"""Queries over the building and checking of factor tables.

The landed datasets are worked out from the driver's tables, one landed row per
table row, so that the builders run over data that grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally import columns as C
from gridtally.factors import build as B
from gridtally.factors import fixed
from gridtally.factors.json_tables import factor_rows, leaves
from gridtally.factors.tables import load_factor_csv as load_csv
from gridtally.factors.tables import parse_block, parse_factor_lines
from gridtally.functions.storage import gb_month_hours
from gridtally.operators.quality import keys_in_both, keys_only_left, reconcile_gpus, unmatched
from gridtally.session import scratch_path
from gridtally.workload import oracle as O
from gridtally.workload import rows as W
from gridtally.workload.registry import query


def choose(key: Column, *options: str | None) -> Column:
    """An option by key modulo their number."""
    chain = F
    for n, option in enumerate(options):
        chain = chain.when(key % len(options) == n, F.lit(option))
    return chain


def choose_sql(key: str, *options: str | None) -> str:
    cases = " ".join(f"WHEN {n} THEN {O.lit(option)}" for n, option in enumerate(options))
    return f"CASE {key} % {len(options)} {cases} END"


def text(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


# --- regions ------------------------------------------------------------------------

PROVIDERS = ("aws", "gcp", "azure")


def region_documents(spark, sf_dir) -> DataFrame:
    """A JSON document per customer with two region entries, some without a code."""
    key = F.col("c_custkey")

    def entry(code: Column, name: Column) -> Column:
        return F.struct(
            code.alias("cloud_region"),
            name.alias("name"),
            choose(F.col("c_nationkey"), "Spain", "India", "United States").alias("country"),
            (key % 90).cast("string").alias("latitude"),
            (-(key % 180)).cast("string").alias("longitude"),
        )

    first = entry(text("r-", "c_custkey"), text("Place ", "c_custkey"))
    code = F.when(key % 5 == 0, F.lit(None)).when(key % 5 == 1, F.lit("")).otherwise(text("s-", "c_custkey"))
    second = entry(code, text("Site ", "c_custkey"))
    payload = F.to_json(F.struct(F.array(first, second).alias("cloud_regions")))
    return W.table(spark, sf_dir, "customer").select(choose(key, *PROVIDERS).alias("provider"), payload.alias("payload"))


_ENTRIES = f"""entries AS (
  SELECT {choose_sql('c_custkey', *PROVIDERS)} AS provider, 'r-' || CAST(c_custkey AS VARCHAR) AS region,
         'Place ' || CAST(c_custkey AS VARCHAR) AS name, {choose_sql('c_nationkey', 'Spain', 'India', 'United States')} AS country,
         CAST(c_custkey % 90 AS VARCHAR) AS latitude, CAST(-(c_custkey % 180) AS VARCHAR) AS longitude,
         CAST(NULL AS VARCHAR) AS metro_area FROM customer
  UNION ALL
  SELECT {choose_sql('c_custkey', *PROVIDERS)},
         CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 's-' || CAST(c_custkey AS VARCHAR) END,
         'Site ' || CAST(c_custkey AS VARCHAR), {choose_sql('c_nationkey', 'Spain', 'India', 'United States')},
         CAST(c_custkey % 90 AS VARCHAR), CAST(-(c_custkey % 180) AS VARCHAR), NULL FROM customer)"""


@query("factor_regions", O.with_(_ENTRIES) + "SELECT * FROM entries WHERE region <> ''")
def factor_regions(spark, sf_dir):
    return B.factor_regions(B.region_entries(region_documents(spark, sf_dir)))


@query(
    "unresolved_regions",
    O.with_(_ENTRIES) + "SELECT * EXCLUDE (region) FROM entries WHERE coalesce(region, '') = ''",
)
def unresolved_regions(spark, sf_dir):
    return B.unresolved_regions(B.region_entries(region_documents(spark, sf_dir)))


@query(
    "factor_region_fixes",
    O.with_(
        _ENTRIES,
        # custkey 7k moves onto 7k+1, unresolved sites 35k are promoted onto r-35k+2, 11k is edited
        """keyed AS (SELECT *, CAST(substr(region, 3) AS BIGINT) AS k FROM entries WHERE region LIKE 'r-%')""",
        """stayed AS (SELECT * FROM keyed WHERE k % 7 <> 0 AND NOT (k % 7 = 1 AND EXISTS
            (SELECT 1 FROM customer WHERE c_custkey = k - 1)) AND NOT (k % 35 = 2 AND EXISTS
            (SELECT 1 FROM customer WHERE c_custkey = k - 2)))""",
        """moved AS (SELECT provider, 'r-' || CAST(k + 1 AS VARCHAR) AS region, name, country, latitude, longitude,
            metro_area FROM keyed WHERE k % 7 = 0)""",
        """promoted AS (SELECT provider, 'r-' || CAST(CAST(substr(name, 6) AS BIGINT) + 2 AS VARCHAR) AS region, name,
            country, latitude, longitude, metro_area FROM entries
            WHERE coalesce(region, '') = '' AND CAST(substr(name, 6) AS BIGINT) % 35 = 0)""",
        """merged AS (SELECT * EXCLUDE (k) FROM stayed UNION ALL SELECT * FROM moved UNION ALL SELECT * FROM promoted)""",
    )
    + """SELECT provider, region, name, country, CASE WHEN CAST(substr(region, 3) AS BIGINT) % 11 = 0 THEN '1.5'
        ELSE latitude END AS latitude, longitude, CASE WHEN CAST(substr(region, 3) AS BIGINT) % 11 = 0 THEN 'Metro'
        ELSE metro_area END AS metro_area FROM merged
        UNION ALL SELECT * FROM entries WHERE region <> '' AND region NOT LIKE 'r-%'""",
)
def factor_region_fixes(spark, sf_dir):
    """Moves, promotions and edits worked out from customer numbers, all of one provider. Codes of sites (s-) have none."""
    entries = B.region_entries(region_documents(spark, sf_dir).withColumn("provider", F.lit("one")))
    keys = W.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    fields = ("latitude", "longitude", "metro_area", "name")

    def fix(of: DataFrame, action: str, source: Column, target: Column, **edit: str) -> DataFrame:
        values = [F.lit(edit.get(f)).cast("string").alias(f) for f in fields]
        return of.select(
            F.lit("one").alias("provider"),
            F.lit(action).alias("action"),
            source.alias("source"),
            target.alias("target"),
            *values,
        )

    def code(key: Column) -> Column:
        return F.concat(F.lit("r-"), key.cast("string"))

    k = F.col("k")
    fixes = (
        fix(keys.where("k % 7 = 0"), "move", code(k), code(k + 1))
        .unionByName(fix(keys.where("k % 35 = 0"), "promote", text("Site ", "k"), code(k + 2)))
        .unionByName(
            fix(
                keys.select(F.explode(F.array(k, k + 1, k + 2)).alias("k")).where("k % 11 = 0").distinct(),
                "edit",
                code(k),
                F.lit(None).cast("string"),
                latitude="1.5",
                metro_area="Metro",
            )
        )
    )
    fixed_regions = B.apply_region_fixes(B.factor_regions(entries), B.unresolved_regions(entries), fixes)
    number = F.substr("name", F.lit(7)).cast("bigint")
    site = F.substr("name", F.lit(6)).cast("bigint")
    owner = F.when(F.col("name").startswith("Place "), number).otherwise(site)
    return fixed_regions.withColumn("provider", choose(owner, *PROVIDERS))


# --- carbon intensity ------------------------------------------------------------------


def yearly(spark, sf_dir) -> DataFrame:
    """Orders as yearly long-format rows; their key order is the file order."""
    return W.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 300 == 0, "").otherwise(
            F.concat(choose(F.col("o_custkey"), "US-", "IN-"), choose(F.col("o_custkey"), "A", "TG", "C", "OR", "E9"))
        ).alias("key"),
        F.when(F.col("o_custkey") % 11 == 0, 0).otherwise(F.year("o_orderdate")).alias("year"),
        F.when(F.col("o_orderpriority") == "5-LOW", "TWh").otherwise("gCO2/kWh").alias("unit"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("value"),
        F.col("o_orderkey").alias("ordinal"),
    )


_YEARLY = f"""yearly AS (
  SELECT CASE WHEN o_custkey % 300 = 0 THEN '' ELSE {choose_sql('o_custkey', 'US-', 'IN-')} ||
         {choose_sql('o_custkey', 'A', 'TG', 'C', 'OR', 'E9')} END AS key,
         CASE WHEN o_custkey % 11 = 0 THEN 0 ELSE year(o_orderdate) END AS year,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'TWh' ELSE 'gCO2/kWh' END AS unit,
         o_totalprice / 1E3 AS value, o_orderkey AS ordinal FROM orders)"""
_LATEST = """latest AS (
  SELECT key, year, value FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY year DESC, ordinal) AS n
    FROM yearly WHERE unit = 'gCO2/kWh' AND key <> '' AND year > 0) WHERE n = 1)"""


@query(
    "latest_per_key",
    O.with_(_YEARLY, _LATEST) + "SELECT key, CAST(year AS INTEGER) AS year, value FROM latest",
)
def latest_per_key(spark, sf_dir):
    return B.latest_per_key(yearly(spark, sf_dir))


_ALIASED = """aliased AS (SELECT key, value FROM latest
  UNION ALL SELECT 'IN-TS', value FROM latest WHERE key = 'IN-TG'
  UNION ALL SELECT 'IN-OD', value FROM latest WHERE key = 'IN-OR')"""


@query("union_alias_rows", O.with_(_YEARLY, _LATEST, _ALIASED) + "SELECT * FROM aliased")
def union_alias_rows(spark, sf_dir):
    return B.with_aliases(B.latest_per_key(yearly(spark, sf_dir)))


NATIONS = ("United States", "India", "United Kingdom", "France", "Türkiye", "Nowhere")
STATES = ("Virginia", "Ohio", "Texas", "Île-de-France", "Kanagawa Prefecture", "São  Paulo", "", None)
CODES = ("US-A", "IN-TS", "IN-OD", "bad", "US-C", None, "US-ZZ")


def places(spark, sf_dir) -> DataFrame:
    """Every customer as a region with a country and what lies below it."""
    key = F.col("c_custkey")
    return W.table(spark, sf_dir, "customer").select(
        choose(key, *PROVIDERS).alias("provider"),
        text("c-", "c_custkey").alias("region"),
        choose(F.col("c_nationkey"), *NATIONS).alias("country"),
        choose(key, *STATES).alias("state"),
        choose(key, *CODES).alias("subdivision"),
        (F.lit(36) + key % 5).cast("string").alias("latitude"),
    )


_PLACES = f"""places AS (
  SELECT {choose_sql('c_custkey', *PROVIDERS)} AS provider, 'c-' || CAST(c_custkey AS VARCHAR) AS region,
         {choose_sql('c_nationkey', *NATIONS)} AS country, {choose_sql('c_custkey', *STATES)} AS state,
         {choose_sql('c_custkey', *CODES)} AS subdivision, 36 + c_custkey % 5 AS latitude FROM customer)"""


def national(spark, sf_dir) -> DataFrame:
    """A value per country, the largest order in thousands."""
    name = choose(F.col("o_custkey"), "United States of America", "India", "Great Britain", "France", "turkiye")
    return (
        W.table(spark, sf_dir, "orders").groupBy(name.alias("key"))
        .agg((F.max("o_totalprice") / F.lit(1000.0)).alias("value"))
    )


_NATIONAL = f"""national AS (SELECT
  {choose_sql('o_custkey', 'United States of America', 'India', 'Great Britain', 'France', 'turkiye')} AS key,
  max(o_totalprice) / 1E3 AS value FROM orders GROUP BY 1)"""


@query(
    "factor_carbon_intensity",
    O.with_(_YEARLY, _LATEST, _ALIASED, _PLACES, _NATIONAL)
    + """SELECT * FROM (SELECT p.provider, p.region, coalesce(a.value, n.value) AS intensity FROM places p
      LEFT JOIN aliased a ON p.subdivision = a.key AND p.country IN ('United States', 'India')
        AND regexp_full_match(p.subdivision, '[A-Z]{2}-[A-Z0-9]+')
      LEFT JOIN national n ON p.country = CASE n.key WHEN 'United States of America' THEN 'United States' ELSE n.key END)
      WHERE intensity IS NOT NULL""",
)
def factor_carbon_intensity(spark, sf_dir):
    subdivisions = B.with_aliases(B.latest_per_key(yearly(spark, sf_dir)))
    return B.factor_carbon_intensity(places(spark, sf_dir), national(spark, sf_dir), subdivisions)


# --- water -----------------------------------------------------------------------------

GRIDS = ("RFCE", "SRVC", "RFCW", "NWPP")


@query(
    "factor_wcf",
    O.with_(
        _PLACES,
        _NATIONAL,
        f"grids AS (SELECT {choose_sql('o_custkey', *GRIDS)} AS grid, max(o_totalprice) / 1E6 AS value FROM orders GROUP BY 1)",
        O.values("states", "state, grid", parse_block(fixed.STATE_GRIDS, str, str)),
    )
    + f"""SELECT provider, region, {O.r2('v * 3.78541E0', 6)} AS wcf FROM (
      SELECT p.provider, p.region, CASE WHEN p.country = 'United States' THEN g.value ELSE n.value END AS v
      FROM places p LEFT JOIN states s USING (state)
      LEFT JOIN grids g ON g.grid = CASE WHEN p.state = 'Virginia' THEN CASE WHEN p.latitude > 38.5E0 THEN 'RFCE' ELSE 'SRVC' END
        ELSE s.grid END
      LEFT JOIN national n ON lower(n.key) = lower(CASE p.country WHEN 'United Kingdom' THEN 'Great Britain' ELSE p.country END))
      WHERE v IS NOT NULL""",
)
def factor_wcf(spark, sf_dir):
    grids = (
        W.table(spark, sf_dir, "orders").groupBy(choose(F.col("o_custkey"), *GRIDS).alias("key"))
        .agg((F.max("o_totalprice") / F.lit(1e6)).alias("value"))
    )
    return B.factor_wcf(places(spark, sf_dir), grids, national(spark, sf_dir))


INDICATORS = ("bws", "bwd")
WEIGHTS = ("Tot", "Dom", "Tot")
PROVINCES = (("FRANCE", "ile de france"), ("France", "Ile-de-France"), ("India", "kanagawa"), ("Turkiye", "sao paulo"))


def stress_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Landed stress categories per province and per country, one row per order before grouping."""
    key = F.col("o_custkey")
    base = W.table(spark, sf_dir, "orders").select(
        choose(key, *INDICATORS).alias("indicator"),
        choose(key, *WEIGHTS).alias("weight"),
        choose(key, *[p[0] for p in PROVINCES]).alias("country"),
        choose(key, *[p[1] for p in PROVINCES]).alias("name"),
        "o_orderkey",
    )
    provinces = base.groupBy("indicator", "weight", "country", "name").agg(
        F.when(F.max("o_orderkey") % 3 == 0, -9999).otherwise(F.max("o_orderkey") % 5).cast("int").alias("category")
    )
    countries = (
        base.withColumn("name", F.initcap(F.lower("country")))
        .groupBy("indicator", "weight", "name")
        .agg((F.max("o_orderkey") % 5).cast("int").alias("category"))
    )
    return provinces, countries


_STRESS = f"""base AS (SELECT {choose_sql('o_custkey', *INDICATORS)} AS indicator, {choose_sql('o_custkey', *WEIGHTS)} AS weight,
    {choose_sql('o_custkey', *[p[0] for p in PROVINCES])} AS country, {choose_sql('o_custkey', *[p[1] for p in PROVINCES])} AS name,
    o_orderkey FROM orders),
provinces AS (SELECT lower(country) AS country, name, CASE WHEN max(o_orderkey) % 3 = 0 THEN -9999 ELSE max(o_orderkey) % 5 END AS cat
  FROM base WHERE indicator = 'bws' AND weight = 'Tot' GROUP BY country, name),
countries AS (SELECT lower(country) AS name, max(o_orderkey) % 5 AS cat FROM base WHERE indicator = 'bws' AND weight = 'Tot'
  GROUP BY lower(country))"""
_PLACE_NAME = "trim(regexp_replace(strip_accents(lower({})), '\\s+', ' ', 'g'))"
_ENDING = (
    "trim(regexp_replace({}, ' (prefecture|province|county|region|governorate|district|municipality|metropolis)$', '', 'i'))"
)


@query(
    "factor_water_stress",
    O.with_(_PLACES, _STRESS)
    + f"""SELECT provider, region, CAST(nullif(cat, -9999) AS INTEGER) AS stress FROM (
      SELECT p.provider, p.region, coalesce(r.cat, c.cat) AS cat FROM places p
      LEFT JOIN provinces r ON {_PLACE_NAME.format('p.country')} = {_PLACE_NAME.format('r.country')}
        AND {_PLACE_NAME.format(_ENDING.format("nullif(p.state, '')"))} = {_PLACE_NAME.format('r.name')}
      LEFT JOIN countries c ON {_PLACE_NAME.format('p.country')} = {_PLACE_NAME.format('c.name')})
      WHERE nullif(cat, -9999) IS NOT NULL""",
)
def factor_water_stress(spark, sf_dir):
    return B.factor_water_stress(places(spark, sf_dir), *stress_rows(spark, sf_dir))


@query(
    "place_names",
    O.with_(_PLACES) + f"SELECT region, {_PLACE_NAME.format(_ENDING.format('state'))} AS name FROM places",
)
def place_names(spark, sf_dir):
    return places(spark, sf_dir).select("region", B.place_name(B.without_admin_ending(F.col("state"))).alias("name"))


@query(
    "sort_factor_rows",
    O.with_(_PLACES) + "SELECT provider, region, country FROM places ORDER BY provider, region",
)
def sort_factor_rows(spark, sf_dir):
    return B.sort_factors(places(spark, sf_dir).select("provider", "region", "country"))


# --- compute and tokens ---------------------------------------------------------------------


@query(
    "factor_compute",
    """SELECT 'i-' || CAST(p_partkey AS VARCHAR) AS instance_type, p_size * 0.5E0 * 0.277778E0 AS kwh,
       p_retailprice * 1E3 AS embodied_g, CASE WHEN p_size % 4 <> 0 THEN p_size * 0.25E0 * 1E3 END AS depletion_g FROM part""",
)
def factor_compute(spark, sf_dir):
    def part(field: str, value: Column) -> Column:
        return F.struct(F.struct(value.alias("value")).alias(field))

    payload = F.to_json(
        F.struct(
            F.struct(
                part("use", F.col("p_size") * F.lit(0.5)).alias("fe"),
                part("embedded", F.col("p_retailprice")).alias("gwp"),
                part("embedded", F.when(F.col("p_size") % 4 != 0, F.col("p_size") * F.lit(0.25))).alias("adp"),
            ).alias("impacts")
        )
    )
    answers = W.table(spark, sf_dir, "part").select(text("i-", "p_partkey").alias("instance_type"), payload.alias("payload"))
    return B.factor_compute(answers)


def estimates(spark, sf_dir) -> DataFrame:
    """A range, a plain number or nothing as the energy estimate, by part number."""
    size, price = F.col("p_size").cast("double").cast("string"), F.col("p_retailprice").cast("string")
    energy = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('{"value":{"min":0.5,"max":'), size, F.lit("}}")))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit('{"value":'), size, F.lit("}")))
        .otherwise(F.lit("{}"))
    )
    payload = F.concat(
        F.lit('{"impacts":{"energy":'),
        energy,
        F.lit(',"embodied":{"gwp":{"value":{"max":'),
        price,
        F.lit('}},"adpe":{"value":"n/a"}}}}'),
    )
    return W.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("provider"), text("m-", "p_partkey").alias("model"), payload.alias("payload")
    )


@query(
    "factor_llm",
    """SELECT p_brand AS provider, 'm-' || CAST(p_partkey AS VARCHAR) AS model,
       CASE WHEN p_partkey % 3 < 2 THEN CAST(p_size AS DOUBLE) ELSE 0E0 END AS kwh_per_1k,
       p_retailprice AS kg_per_1k, 0E0 AS depletion_kg_per_1k FROM part""",
)
def factor_llm(spark, sf_dir):
    return B.factor_tokens(estimates(spark, sf_dir))


def part_labels(spark, sf_dir) -> DataFrame:
    return W.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("label"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_brand")).otherwise("").alias("provider"),
        text("m-", "p_partkey").alias("model"),
    )


_UNMAPPED = """SELECT p_brand AS provider, 'm-' || CAST(p_partkey AS VARCHAR) AS model FROM part
  WHERE p_size % 5 = 0"""


@query("factor_llm_unmapped", _UNMAPPED)
def factor_llm_unmapped(spark, sf_dir):
    return B.unmapped_models(B.factor_tokens(estimates(spark, sf_dir)), part_labels(spark, sf_dir))


@query("anti_unmapped", _UNMAPPED)
def anti_unmapped(spark, sf_dir):
    """The bare anti join under it."""
    models = estimates(spark, sf_dir).select("provider", "model")
    return unmatched(models, part_labels(spark, sf_dir).where("provider <> ''"), ["provider", "model"])


# --- reconciliation -----------------------------------------------------------------------------


@query(
    "gpu_reconcile",
    O.with_(
        """o AS (SELECT p_partkey * 2 AS k, CASE p_partkey % 2 WHEN 0 THEN 'v100' ELSE 'a10g' END AS gpu, p_size % 8 + 1 AS gpus,
          CAST(p_size AS DOUBLE) AS lo, p_size * 10E0 AS hi FROM part)""",
        """t AS (SELECT p_partkey * 3 AS k, CASE WHEN p_partkey % 10 = 0 THEN 'a100' WHEN p_partkey % 2 = 0 THEN 'v100' ELSE 'a10g' END AS gpu,
          p_size % 8 + 1 + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS gpus, p_retailprice AS em,
          p_retailprice * 0.25E0 AS gem FROM part)""",
        "b AS (SELECT p_partkey * 6 AS k, p_retailprice * 1.25E0 AS old FROM part)",
    )
    + """SELECT 'i-' || CAST(k AS VARCHAR) AS instance_type,
      CASE WHEN o.gpu IS NOT NULL AND t.gpu IS NOT NULL THEN 'both' WHEN o.gpu IS NOT NULL THEN 'only_ours' ELSE 'only_theirs' END AS status,
      o.gpus = t.gpus AS count_agrees, o.gpu = t.gpu AS model_agrees, (lo + 0.5E0 * (hi - lo)) * o.gpus / 1E3 AS hourly_kwh,
      em / old AS embodied_ratio, gem / em * 100E0 AS gpu_share_pct
      FROM o FULL JOIN t USING (k) LEFT JOIN b USING (k)""",
)
def gpu_reconcile(spark, sf_dir):
    """Sides whose names agree in part: multiples of two, of three and of six."""
    parts = W.table(spark, sf_dir, "part")
    key = F.col("p_partkey")

    def named(factor: int) -> Column:
        return F.concat(F.lit("i-"), (key * factor).cast("string")).alias("instance_type")

    ours = parts.select(
        named(2),
        choose(key, "NVIDIA_TESLA_V100", "NVIDIA_A10G").alias("gpu"),
        (F.col("p_size") % 8 + 1).alias("gpus"),
        F.col("p_size").cast("double").alias("idle_w"),
        (F.col("p_size") * F.lit(10.0)).alias("full_w"),
    )
    name = F.when(key % 10 == 0, "Tesla A100").otherwise(choose(key, "Tesla V100", "A10G"))
    theirs = parts.select(
        named(3),
        name.alias("gpu_name"),
        (F.col("p_size") % 8 + 1 + F.when(key % 5 == 0, 1).otherwise(0)).alias("gpu_units"),
        F.col("p_retailprice").alias("embodied_g"),
        (F.col("p_retailprice") * F.lit(0.25)).alias("gpu_embodied_g"),
    )
    bundled = parts.select(
        named(6), (F.col("p_retailprice") * F.lit(1.25)).alias("embodied_g")
    )
    return reconcile_gpus(ours, theirs, bundled)


@query(
    "full_outer_reconcile",
    """SELECT status, count(*) AS keys FROM (
      SELECT CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS status
      FROM (SELECT DISTINCT l_partkey + l_linenumber AS k FROM lineitem) a
      FULL JOIN (SELECT p_partkey * 2 AS k FROM part) b USING (k)) GROUP BY 1""",
)
def full_outer_reconcile(spark, sf_dir):
    sold, parts = _parts_sold(spark, sf_dir)
    left = sold.distinct().withColumn("in_left", F.lit(True))
    right = parts.withColumn("in_right", F.lit(True))
    status = F.when(F.col("in_left").isNull(), "right").when(F.col("in_right").isNull(), "left").otherwise("both")
    return left.join(right, "k", "full_outer").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("keys"))


def _parts_sold(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two key columns that agree in part, from whole tables."""
    sold = W.table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + F.col("l_linenumber")).alias("k"))
    return sold, W.table(spark, sf_dir, "part").select((F.col("p_partkey") * 2).alias("k"))


@query(
    "set_difference",
    """SELECT DISTINCT l_partkey + l_linenumber AS k FROM lineitem
       EXCEPT SELECT p_partkey * 2 FROM part""",
)
def set_difference(spark, sf_dir):
    return keys_only_left(*_parts_sold(spark, sf_dir), ["k"])


@query(
    "set_intersection",
    """SELECT l_partkey + l_linenumber AS k FROM lineitem
       INTERSECT SELECT p_partkey * 2 FROM part""",
)
def set_intersection(spark, sf_dir):
    return keys_in_both(*_parts_sold(spark, sf_dir), ["k"])


# --- factor files --------------------------------------------------------------------------------


@query(
    "load_factor_csv",
    """SELECT provider, region, max_by(v, ln) AS intensity FROM (
      SELECT o_orderkey AS ln, CASE o_orderkey % 2 WHEN 0 THEN 'aws' ELSE 'gcp' END AS provider,
             'r-' || CAST(o_custkey % 700 AS VARCHAR) AS region, o_totalprice AS v
      FROM orders WHERE o_orderkey % 9 > 2) GROUP BY 1, 2""",
)
def load_factor_csv(spark, sf_dir):
    """Factor lines from orders: comments, blanks, a bad number, repeated keys whose last line wins."""
    key = F.col("o_orderkey")
    line = F.concat(
        choose(key, "aws", "gcp"),
        F.lit(" , r-"),
        (F.col("o_custkey") % 700).cast("string"),
        F.lit(","),
        F.col("o_totalprice").cast("string"),
        choose(key, "", " ", ",,"),
    )
    value = (
        F.when(key % 9 == 0, F.concat(F.lit("# "), line))
        .when(key % 9 == 1, F.lit("   "))
        .when(key % 9 == 2, F.lit("provider,region,gCO2_per_kWh"))
        .otherwise(line)
    )
    lines = W.table(spark, sf_dir, "orders").select(value.alias("value"), key.alias("line_no"))
    return parse_factor_lines(lines, "intensity")


@query(
    "load_factor_files",
    """SELECT provider, region, arg_max(v, ln) AS intensity FROM (
      SELECT o_orderkey % 2 * 1E12 + o_orderkey AS ln, 'aws' AS provider,
             'r-' || CAST(o_custkey % 700 AS VARCHAR) AS region, o_totalprice AS v FROM orders) GROUP BY 1, 2""",
)
def load_factor_files(spark, sf_dir):
    """Two folders of several files with the same keys: the later folder wins, and its last file and line."""
    key = F.col("o_orderkey")
    line = F.concat(
        F.lit("aws,r-"), (F.col("o_custkey") % 700).cast("string"), F.lit(","), F.col("o_totalprice").cast("string")
    )
    orders = W.table(spark, sf_dir, "orders").select(key, line.alias("value"))
    folders = []
    for rest in (0, 1):
        folders.append(scratch_path(spark, "factor-lines"))
        part = orders.where(key % 2 == rest).repartitionByRange(4, key).sortWithinPartitions(key)
        part.select("value").write.text(folders[-1])
    return load_csv(spark, folders, "intensity")


# --- conversions ------------------------------------------------------------------------------------


@query(
    "unit_conversions",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_quantity * 24E0 * 30.42E0 AS gb_hours,
       l_quantity * 0.277778E0 AS kwh, l_quantity * 3.78541E0 AS litres, l_quantity * 1E3 AS grams FROM lineitem""",
)
def unit_conversions(spark, sf_dir):
    quantity = F.col("l_quantity")
    return W.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        gb_month_hours(quantity).alias("gb_hours"),
        (quantity * F.lit(B.KWH_PER_MJ)).alias("kwh"),
        (quantity * F.lit(B.LITRES_PER_GALLON)).alias("litres"),
        (quantity * F.lit(B.GRAMS_PER_KG)).alias("grams"),
    )


# --- JSON factor files ---------------------------------------------------------------


def factor_documents(spark, sf_dir) -> DataFrame:
    """A factor file for each customer, of one of four layouts; some are cut short or hold no table."""
    k = F.col("c_custkey")
    number = k.cast("string")
    disk = F.concat(
        F.lit('{"MANAGED_DISKS": {"P'), number, F.lit('": {"capacity_gb": '), (k % 64).cast("string"),
        F.lit(', "storage_type": "SSD"}, "E 1.x": {"capacity_gb": "many", "storage_type": "HDD"}}}'),
    )
    instance = F.concat(
        F.lit('{"GPU_INSTANCES_TYPES": {"g'), number, F.lit('.large": {"type": "T4", "quantity": '), (k % 8).cast("string"),
        F.lit('}}, "GPU_INFO": {"T4": {"min": 8.5, "max": '), (k % 100).cast("string"), F.lit("}}}"),
    )
    rules = F.concat(
        F.lit('{"SSD_USAGE_TYPES": ["Gp'), number, F.lit('", "Piops"], "SSD_SERVICES": [], "HDD_USAGE_TYPES": ["St'),
        number, F.lit('"]}'),
    )
    other = F.concat(F.lit('{"a": [1, {"b": "'), number, F.lit('"}], "n": null}'))
    whole = F.when(k % 4 == 0, disk).when(k % 4 == 1, instance).when(k % 4 == 2, rules).otherwise(other)
    payload = F.when(k % 11 == 0, F.left(whole, F.lit(20))).otherwise(whole)
    return W.table(spark, sf_dir, "customer").select(number.alias("file"), payload.alias("payload"))


_FILES = """files AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS file, c_custkey % 4 AS kind FROM customer
  WHERE c_custkey % 11 <> 0)"""


@query(
    "load_factor_json",
    O.with_(_FILES)
    + """SELECT CAST(c_custkey AS VARCHAR) AS file, NULL AS layout, NULL AS key, NULL AS field, NULL AS value, 'no JSON' AS problem
        FROM customer WHERE c_custkey % 11 = 0
        UNION ALL SELECT file, NULL, NULL, NULL, NULL, 'no table' FROM files WHERE kind = 3
        UNION ALL SELECT file, 'MANAGED_DISKS', 'P' || file, 'capacity_gb', CAST(k % 64 AS VARCHAR), NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS', 'P' || file, 'storage_type', 'SSD', NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS', 'E 1.x', 'capacity_gb', NULL, 'bad value: capacity_gb' FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS', 'E 1.x', 'storage_type', 'HDD', 'bad value: capacity_gb' FROM files WHERE kind = 0
        UNION ALL SELECT file, 'GPU_INSTANCES_TYPES', 'g' || file || '.large', 'type', 'T4', NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INSTANCES_TYPES', 'g' || file || '.large', 'quantity', CAST(k % 8 AS VARCHAR), NULL FROM files
          WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INFO', 'T4', 'min', '8.5', NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INFO', 'T4', 'max', CAST(CAST(k % 100 AS DOUBLE) AS VARCHAR), NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'SSD_USAGE_TYPES', '0', 'token', 'Gp' || file, NULL FROM files WHERE kind = 2
        UNION ALL SELECT file, 'SSD_USAGE_TYPES', '1', 'token', 'Piops', NULL FROM files WHERE kind = 2
        UNION ALL SELECT file, 'HDD_USAGE_TYPES', '0', 'token', 'St' || file, NULL FROM files WHERE kind = 2""",
)
def load_factor_json(spark, sf_dir):
    return factor_rows(factor_documents(spark, sf_dir))


@query(
    "factor_json_leaves",
    O.with_(_FILES)
    + """SELECT CAST(c_custkey AS VARCHAR) AS file, NULL AS path, NULL AS value, 'no JSON' AS problem FROM customer
          WHERE c_custkey % 11 = 0
        UNION ALL SELECT file, 'MANAGED_DISKS/P' || file || '/capacity_gb', CAST(k % 64 AS VARCHAR), NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS/P' || file || '/storage_type', 'SSD', NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS/E 1.x/capacity_gb', 'many', NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'MANAGED_DISKS/E 1.x/storage_type', 'HDD', NULL FROM files WHERE kind = 0
        UNION ALL SELECT file, 'GPU_INSTANCES_TYPES/g' || file || '.large/type', 'T4', NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INSTANCES_TYPES/g' || file || '.large/quantity', CAST(k % 8 AS VARCHAR), NULL FROM files
          WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INFO/T4/min', '8.5', NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'GPU_INFO/T4/max', CAST(k % 100 AS VARCHAR), NULL FROM files WHERE kind = 1
        UNION ALL SELECT file, 'SSD_USAGE_TYPES/0', 'Gp' || file, NULL FROM files WHERE kind = 2
        UNION ALL SELECT file, 'SSD_USAGE_TYPES/1', 'Piops', NULL FROM files WHERE kind = 2
        UNION ALL SELECT file, 'HDD_USAGE_TYPES/0', 'St' || file, NULL FROM files WHERE kind = 2
        UNION ALL SELECT file, 'a/0', '1', NULL FROM files WHERE kind = 3
        UNION ALL SELECT file, 'a/1/b', file, NULL FROM files WHERE kind = 3
        UNION ALL SELECT file, 'n', NULL, NULL FROM files WHERE kind = 3""",
)
def factor_json_leaves(spark, sf_dir):
    """Every value of the same files, found without naming a table."""
    return leaves(factor_documents(spark, sf_dir))
