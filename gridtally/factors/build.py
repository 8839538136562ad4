"""Building factor tables from landed public datasets.

Nothing here downloads. Each builder takes frames as landed (Parquet, CSV or JSON
read by Spark) and returns a factor table or a check of one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.factors import fixed
from gridtally.factors.tables import Dim, lookup, parse_block, values_frame
from gridtally.functions.common import blank_to_null, present, rounded

# Unit conversions and markers of the public datasets.
KWH_PER_MJ = 0.277778
GRAMS_PER_KG = 1000.0
LITRES_PER_GALLON = 3.78541
INTENSITY_UNIT = "gCO2/kWh"
NO_DATA = -9999
VIRGINIA_SPLIT_LATITUDE = 38.5
SUBDIVIDED_COUNTRIES = ("United States", "India")
SUBDIVISION_CODE = r"^[A-Z]{2}-[A-Z0-9]+$"
COUNTRY_SPELLING = {"United States of America": "United States"}
WATER_COUNTRY_SPELLING = {"United Kingdom": "Great Britain"}
SUBDIVISION_ALIASES = [("IN-TS", "IN-TG"), ("IN-OD", "IN-OR")]

# Endings dropped from names of administrative units.
ADMIN_ENDING = r"(?i) (?:prefecture|province|county|region|governorate|district|municipality|metropolis)$"

_PLACE = "cloud_region string, name string, country string, latitude string, longitude string, metro_area string"
REGION_FIELDS = ("name", "country", "latitude", "longitude", "metro_area")


def recode(value: Column, spelling: dict[str, str]) -> Column:
    result = value
    for given, wanted in spelling.items():
        result = F.when(value == given, F.lit(wanted)).otherwise(result)
    return result


# --- regions --------------------------------------------------------------------------


def region_entries(documents: DataFrame) -> DataFrame:
    """Region entries of provider documents (``provider``, ``payload`` JSON), one per row."""
    schema = f"cloud_regions array<struct<{', '.join(p.strip().replace(' ', ':') for p in _PLACE.split(','))}>>"
    parsed = documents.select("provider", F.from_json("payload", schema).alias("doc"))
    return parsed.select("provider", F.inline("doc.cloud_regions"))


def factor_regions(entries: DataFrame) -> DataFrame:
    """Entries under their region code."""
    return entries.where(present(F.col("cloud_region"))).select(
        "provider", F.col("cloud_region").alias("region"), *REGION_FIELDS
    )


def unresolved_regions(entries: DataFrame) -> DataFrame:
    """Entries that came without a region code."""
    return entries.where(~present(F.col("cloud_region"))).select("provider", *REGION_FIELDS)


FIX_SCHEMA = (
    "provider string, action string, source string, target string, "
    "latitude string, longitude string, metro_area string, name string"
)


def region_fixes(spark: SparkSession) -> DataFrame:
    """The published corrections; a small table of its own schema."""
    return values_frame(spark, parse_block(fixed.REGION_FIXES, *[str] * 8), FIX_SCHEMA)


def apply_region_fixes(regions: DataFrame, unresolved: DataFrame, fixes: DataFrame) -> DataFrame:
    """Overlay corrections on a region table.

    ``move`` re-codes a region (two moves make a swap), ``promote`` gives an
    unresolved entry, found by name, a code, and ``edit`` replaces single
    fields. What already sits at the target of a move or promotion gives way.
    """
    moves = fixes.where("action = 'move'").select("provider", F.col("source").alias("region"), "target")
    promotions = fixes.where("action = 'promote'").select("provider", F.col("source").alias("name"), "target")
    edits = fixes.where("action = 'edit'").select(
        "provider",
        F.col("source").alias("region"),
        *[F.col(c).alias(f"_{c}") for c in ("latitude", "longitude", "metro_area", "name")],
    )
    keyed = regions.join(moves, ["provider", "region"], "left")
    taken = (
        moves.select("provider", F.col("target").alias("region"))
        .unionByName(promotions.select("provider", F.col("target").alias("region")))
    )
    moved = keyed.where("target IS NOT NULL").select("provider", F.col("target").alias("region"), *REGION_FIELDS)
    stayed = keyed.where("target IS NULL").drop("target").join(taken, ["provider", "region"], "left_anti")
    promoted = unresolved.join(promotions, ["provider", "name"]).select(
        "provider", F.col("target").alias("region"), *REGION_FIELDS
    )
    merged = stayed.select("provider", "region", *REGION_FIELDS).unionByName(moved).unionByName(promoted)
    edited = merged.join(edits, ["provider", "region"], "left")
    fields = [
        F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c != "country" else F.col(c) for c in REGION_FIELDS
    ]
    return edited.select("provider", "region", *fields)


# --- carbon intensity --------------------------------------------------------------------


def latest_per_key(yearly: DataFrame) -> DataFrame:
    """Latest carbon intensity per key from (key, year, unit, value, ordinal) rows.

    The first row wins a tie of years. ``max_by`` keeps one candidate per key
    and task, so no key is ever gathered or sorted.
    """
    rows = yearly.where((F.col("unit") == INTENSITY_UNIT) & present(F.col("key")) & (F.col("year") > 0))
    return rows.groupBy("key").agg(
        F.max("year").alias("year"), F.max_by("value", F.struct(F.col("year"), -F.col("ordinal"))).alias("value")
    )


def with_aliases(factors: DataFrame, aliases: Sequence[tuple[str, str]] = SUBDIVISION_ALIASES) -> DataFrame:
    """Repeat a factor (``key``, ``value``) under codes that other sources use for it."""
    names = values_frame(factors.sparkSession, aliases, "alias string, key string")
    extra = factors.join(F.broadcast(names), "key").select(F.col("alias").alias("key"), "value")
    return factors.select("key", "value").unionByName(extra)


def factor_carbon_intensity(regions: DataFrame, countries: DataFrame, subdivisions: DataFrame) -> DataFrame:
    """Intensity per region: by subdivision where published for the country, else by country.

    ``regions``: provider, region, country, subdivision. ``countries`` and
    ``subdivisions``: key, value.
    """
    code = F.when(
        F.col("country").isin(*SUBDIVIDED_COUNTRIES) & F.col("subdivision").rlike(SUBDIVISION_CODE), F.col("subdivision")
    )
    national = countries.select(
        recode(F.col("key"), COUNTRY_SPELLING).alias("_country"), F.col("value").alias("_national")
    )
    local = subdivisions.select(F.col("key").alias("_code"), F.col("value").alias("_local"))
    joined = lookup(regions, Dim.checked(local), code, "_code", "")
    joined = lookup(joined, Dim.checked(national), F.col("country"), "_country", "")
    value = F.coalesce("_local", "_national")
    return joined.select("provider", "region", value.alias("intensity")).where("intensity IS NOT NULL")


# --- water ---------------------------------------------------------------------------------


def grid_subregion(state: Column, latitude: Column, mapped: Column) -> Column:
    """Grid subregion of a US state; Virginia lies in two."""
    north = latitude.try_cast("double") > VIRGINIA_SPLIT_LATITUDE
    return F.when(state == "Virginia", F.when(north, "RFCE").otherwise("SRVC")).otherwise(mapped)


def factor_wcf(regions: DataFrame, subregions: DataFrame, countries: DataFrame) -> DataFrame:
    """Litres per kWh of generation by region: US by grid subregion, others by country.

    ``regions``: provider, region, country, state, latitude. ``subregions``
    (key = code) and ``countries`` (key = name): gallons per kWh in ``value``.
    """
    spark = regions.sparkSession
    states = values_frame(spark, parse_block(fixed.STATE_GRIDS, str, str), "state string, grid string")
    litres = F.col("value") * F.lit(LITRES_PER_GALLON)
    grids = subregions.select(F.col("key").alias("_grid"), litres.alias("_grid_wcf"))
    nations = countries.select(F.lower(F.trim("key")).alias("_country"), litres.alias("_country_wcf"))
    domestic = F.col("country") == "United States"
    placed = regions.join(F.broadcast(states), "state", "left").select(
        "provider",
        "region",
        F.when(domestic, grid_subregion(F.col("state"), F.col("latitude"), F.col("grid"))).alias("grid"),
        F.when(~domestic, F.lower(recode(F.col("country"), WATER_COUNTRY_SPELLING))).alias("nation"),
    )
    joined = lookup(placed, Dim.checked(grids), F.col("grid"), "_grid", "")
    joined = lookup(joined, Dim.checked(nations), F.col("nation"), "_country", "")
    wcf = F.coalesce("_grid_wcf", "_country_wcf")
    return sort_factors(
        joined.select("provider", "region", rounded(wcf, 6).alias("wcf")).where("wcf IS NOT NULL")
    )


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their plain lower-case letters, by decomposition."""
    given, plain = [], []
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        letter = chr(point).lower()
        base = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(letter) == 1 and len(base) == 1 and base != letter:
            given.append(letter)
            plain.append(base)
    return "".join(given), "".join(plain)


def place_name(name: Column) -> Column:
    """Lower case, without accents, single spaces."""
    given, plain = _accent_table()
    text = F.regexp_replace(F.translate(F.lower(name), given, plain), r"\p{M}", "")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_admin_ending(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, ADMIN_ENDING, ""))


def factor_water_stress(regions: DataFrame, provinces: DataFrame, countries: DataFrame) -> DataFrame:
    """Water stress category by region: its province's, else its country's.

    A province known to have no data does not fall back to its country.
    ``regions``: provider, region, country, state. ``provinces`` (country, name)
    and ``countries`` (name): indicator, weight, category.
    """
    def baseline(df: DataFrame) -> DataFrame:
        return df.where((F.col("indicator") == "bws") & (F.col("weight") == "Tot") & F.col("category").isNotNull())

    def within(country: Column, name: Column) -> Column:
        return F.concat(country, F.lit("\n"), name)

    local = baseline(provinces).select(
        within(place_name(F.col("country")), place_name(F.col("name"))).alias("_province"),
        F.col("category").alias("_local"),
    )
    national = baseline(countries).select(
        place_name(F.col("name")).alias("_cn"), F.col("category").alias("_national")
    )
    placed = regions.select(
        "provider",
        "region",
        place_name(F.col("country")).alias("_country"),
        place_name(without_admin_ending(blank_to_null(F.col("state")))).alias("_state"),
    )
    joined = lookup(placed, Dim.checked(local), within(F.col("_country"), F.col("_state")), "_province", "")
    joined = lookup(joined, Dim.checked(national), F.col("_country"), "_cn", "")
    category = F.coalesce("_local", "_national")
    known = joined.select("provider", "region", F.nullif(category, F.lit(NO_DATA)).cast("int").alias("stress"))
    return sort_factors(known.where("stress IS NOT NULL"))


def sort_factors(factors: DataFrame) -> DataFrame:
    """Factor rows in file order: by provider and key."""
    return factors.orderBy(*factors.columns[:2])


# --- compute and tokens ----------------------------------------------------------------------


def factor_compute(answers: DataFrame) -> DataFrame:
    """Hourly impacts from landed answers (``instance_type``, ``payload`` JSON) of an impact service."""
    part = "struct<{0}:struct<value:double>>"
    schema = (
        f"impacts struct<fe:{part.format('use')}, gwp:{part.format('embedded')}, adp:{part.format('embedded')}>"
    )
    parsed = answers.select("instance_type", F.from_json("payload", schema).alias("a"))
    return parsed.select(
        "instance_type",
        (F.col("a.impacts.fe.use.value") * F.lit(KWH_PER_MJ)).alias("kwh"),
        (F.col("a.impacts.gwp.embedded.value") * F.lit(GRAMS_PER_KG)).alias("embodied_g"),
        (F.col("a.impacts.adp.embedded.value") * F.lit(GRAMS_PER_KG)).alias("depletion_g"),
    )


def upper_estimate(payload: Column, path: str) -> Column:
    """``value.max`` of a range, a plain number as it is, otherwise zero."""
    value = F.get_json_object(payload, f"{path}.value")
    high = F.get_json_object(payload, f"{path}.value.max")
    return F.coalesce(high.try_cast("double"), value.try_cast("double"), F.lit(0.0))


def factor_tokens(estimates: DataFrame) -> DataFrame:
    """Impacts per thousand output tokens from landed estimates (``provider``, ``model``, ``payload``)."""
    payload = F.col("payload")
    frame = estimates.select(
        "provider",
        "model",
        upper_estimate(payload, "$.impacts.energy").alias("kwh_per_1k"),
        upper_estimate(payload, "$.impacts.embodied.gwp").alias("kg_per_1k"),
        upper_estimate(payload, "$.impacts.embodied.adpe").alias("depletion_kg_per_1k"),
    )
    return sort_factors(frame)


def unmapped_models(tokens: DataFrame, labels: DataFrame) -> DataFrame:
    """Models with coefficients that no usage label leads to."""
    named = labels.where(present(F.col("provider")) & present(F.col("model"))).select("provider", "model").distinct()
    return tokens.select("provider", "model").join(named, ["provider", "model"], "left_anti")
