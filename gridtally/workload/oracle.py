"""The same rows and impacts in plain SQL, written apart from the Spark code.

Each helper returns SQL text for a database that holds the driver's tables.
Queries are checked by running both and comparing every value.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from gridtally import columns as C
from gridtally.factors import fixed
from gridtally.factors.tables import efficiency_rows, parse_block, parse_list, parse_pairs
from gridtally.workload import rows as W


def lit(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        text = repr(value)
        return text if "e" in text else text + "E0"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows: Sequence[Sequence[object]], kinds: str | None = None) -> str:
    """A named inline table; ``kinds`` casts the first row, which types the rest."""
    types = kinds.split() if kinds else [None] * len(rows[0])
    body = []
    for n, row in enumerate(rows):
        cells = [lit(v) if n or t is None else f"CAST({lit(v)} AS {t})" for v, t in zip(row, types)]
        body.append("(" + ", ".join(cells) + ")")
    return f"{name}({columns}) AS (VALUES {', '.join(body)})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def exact(value: str, where: str | None = None) -> str:
    """The exact sum, rounded once to the nearest double, in 128-bit whole numbers.

    Values are cut at 2^-40; what is below comes in units of 2^-140. Of the total, whose
    absolute value is whole + part / 2^100, the first 60 bits and a bit that says whether
    anything follows are turned into a double. Holds for values from 4e-27 on, in sums
    below 1e26.
    """
    only = f" FILTER (WHERE {where})" if where else ""
    scaled = f"(CAST(({value}) AS DOUBLE) * {2.0**40!r}E0)"
    unit = "CAST(pow(2, 100) AS HUGEINT)"
    sums = f"""[{{'whole': sum(CAST(floor({scaled}) AS HUGEINT)){only},
        'part': sum(CAST(floor(({scaled} - floor({scaled})) * {2.0**100!r}) AS HUGEINT)){only}}}]"""
    carried = f"{{'whole': s.whole + s.part // {unit}, 'part': s.part % {unit}}}"
    size = f"""CASE WHEN s.whole >= 0 THEN {{'below': false, 'whole': s.whole, 'part': s.part}}
        WHEN s.part = 0 THEN {{'below': true, 'whole': -s.whole, 'part': s.part}}
        ELSE {{'below': true, 'whole': -s.whole - 1, 'part': {unit} - s.part}} END"""
    cut = """{'s': s, 'down': greatest(0, CASE WHEN s.whole > 0 THEN length(bin(s.whole)) + 100 ELSE length(bin(s.part)) END - 60)}"""
    power = "CAST(pow(2, {}) AS HUGEINT)".format
    bits = f"""CASE WHEN c.down >= 100
        THEN {{'kept': c.s.whole // {power('c.down - 100')}, 'lost': c.s.whole % {power('c.down - 100')} <> 0 OR c.s.part <> 0}}
        ELSE {{'kept': c.s.whole * {power('100 - c.down')} + c.s.part // {power('c.down')}, 'lost': c.s.part % {power('c.down')} <> 0}} END"""
    shown = f"""list_transform([{bits}], lambda b: CAST(CAST(b.kept AS BIGINT) | CASE WHEN b.lost THEN 1 ELSE 0 END AS DOUBLE)
        * pow(2E0, c.down - 140) * CASE WHEN c.s.below THEN -1E0 ELSE 1E0 END)[1]"""
    for step in (carried, size, cut):
        sums = f"list_transform({sums}, lambda s: {step})"
    return f"(list_transform({sums}, lambda c: {shown})[1])"


def mean(value: str) -> str:
    return f"({exact(value)} / nullif(count({value}), 0))"


def r2(value: str, digits: int = 2) -> str:
    return f"round(({value}), {digits})"


def kg(name: str, where: str | None = None) -> str:
    return f"({exact(name, where)} / 1E3)"


def water(where: str | None = None) -> str:
    return (
        f"(coalesce({exact(C.WATER_COOLING, where)}, 0E0) + coalesce({exact(C.WATER_ELECTRICITY, where)}, 0E0))"
    )


def all_kg(where: str | None = None) -> str:
    return f"((coalesce({exact(C.OPERATIONAL, where)}, 0E0) + coalesce({exact(C.EMBODIED, where)}, 0E0)) / 1E3)"


def ending(column: str, tokens: Sequence[str]) -> str:
    alternatives = "|".join(re.sub(r"([.+*?()\[\]])", r"\\\1", t) for t in tokens)
    return f"regexp_matches({column}, '({alternatives})$')"


# --- usage rows -------------------------------------------------------------------

AMOUNT = "CASE WHEN l_tax < 0.075E0 THEN l_quantity END"
COST = "l_extendedprice * (1E0 - l_discount)"
PERIOD = "strftime(l_shipdate, '%Y-%m')"
TEAM = "CASE WHEN l_discount <= 0.085E0 AND l_linenumber <= 6 THEN 'team-' || CAST(l_orderkey % 50 AS VARCHAR) END"
ENV = (
    "CASE WHEN l_discount <= 0.085E0 THEN CASE l_partkey % 3 WHEN 0 THEN 'prod' WHEN 1 THEN '' ELSE 'dev' END END"
)
NATIVE_CHARGE = (
    "CASE l_returnflag || l_linestatus WHEN 'NF' THEN 'SavingsPlanCoveredUsage' "
    "WHEN 'NO' THEN 'DiscountedUsage' WHEN 'RO' THEN 'Tax' ELSE 'Usage' END"
)


def aws_rows() -> list[str]:
    """CTE ``u``: usage lines under short names, for both AWS layouts."""
    return [
        values(
            "shapes",
            "shape, product_code, service_code, operation, usage_type, unit, instance_type, transfer_type",
            W.numbered(W.AWS_SHAPES),
            "INT VARCHAR VARCHAR VARCHAR VARCHAR VARCHAR VARCHAR VARCHAR",
        ),
        values(
            "places",
            "place, region_code, from_code, to_code",
            W.numbered(W.AWS_REGIONS),
            "INT VARCHAR VARCHAR VARCHAR",
        ),
        f"""u AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey, l_partkey, l_shipdate,
         {PERIOD} AS "BILLING_PERIOD", shapes.*, places.*,
         {NATIVE_CHARGE} AS native_charge,
         CASE l_returnflag || l_linestatus WHEN 'NF' THEN 'Purchase' WHEN 'RO' THEN 'Tax' ELSE 'Usage' END
           AS focus_charge,
         {AMOUNT} AS amount, {COST} AS cost, l_extendedprice AS list_cost,
         {TEAM} AS team, {ENV} AS env
  FROM lineitem
  JOIN shapes ON l_partkey % {len(W.AWS_SHAPES)} = shape
  JOIN places ON l_suppkey % {len(W.AWS_REGIONS)} = place)""",
    ]


def azure_rows() -> list[str]:
    return [
        values(
            "shapes",
            "shape, category, subcategory, meter, unit",
            W.numbered(W.AZURE_SHAPES),
            "INT VARCHAR VARCHAR VARCHAR VARCHAR",
        ),
        values("places", "place, location", W.numbered(W.AZURE_REGIONS), "INT VARCHAR"),
        f"""u AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey, l_shipdate,
         {PERIOD} AS "BILLING_PERIOD", shapes.*, places.*,
         {NATIVE_CHARGE} AS native_charge,
         CASE l_returnflag || l_linestatus WHEN 'NF' THEN 'Purchase' WHEN 'RO' THEN 'Purchase' ELSE 'Usage' END
           AS focus_charge,
         {AMOUNT} AS amount, {COST} AS cost, {TEAM} AS team, {ENV} AS env
  FROM lineitem
  JOIN shapes ON l_partkey % {len(W.AZURE_SHAPES)} = shape
  JOIN places ON l_suppkey % {len(W.AZURE_REGIONS)} = place)""",
    ]


# --- factors ----------------------------------------------------------------------


def factor_ctes(provider: str) -> list[str]:
    key = C.FACTOR_PROVIDER[provider]

    def own(block: str, kind: type) -> list[tuple]:
        return [(region, value) for p, region, value in parse_block(block, str, str, kind) if p == key]

    block = fixed.AZURE_PUE_WUE if provider == C.AZURE else fixed.AWS_PUE_WUE
    compute = W.SAMPLE_AZURE_COMPUTE if provider == C.AZURE else W.SAMPLE_AWS_COMPUTE
    power = {m: (lo, hi) for m, lo, hi in parse_block(fixed.GPU_POWER, str, float, float)}
    gpus = [(t, n, *power[m]) for t, m, n in parse_block(fixed.GPU_INSTANCES, str, str, int)]
    labels = [(a.lower(), b, c) for a, b, c in parse_block(fixed.TOKEN_MODEL_LABELS, str, str, str)]
    return [
        values("ci", "region, intensity", own(fixed.CARBON_INTENSITY, float)),
        values("wf", "region, wcf", own(fixed.WATER_CONSUMPTION, float)),
        values("ws", "region, stress", own(fixed.WATER_STRESS, int)),
        values("eff", "ordinal, region, pue, wue", efficiency_rows(block), "INT VARCHAR DOUBLE DOUBLE"),
        values("vm", "instance_type, kwh, embodied_g, depletion_g", compute),
        values("gpu", "instance_type, gpus, idle_w, full_w", gpus),
        values("disk", "sku, gb, media", parse_block(fixed.AZURE_DISKS, str, int, str)),
        values("labels", "label, provider, model", labels),
        values("tok", "provider, model, kwh_per_1k, kg_per_1k, depletion", W.SAMPLE_TOKENS),
        "token_dim AS (SELECT label, kwh_per_1k, kg_per_1k * 1E3 AS g_per_1k FROM labels JOIN tok USING (provider, model))",
        "pat AS (SELECT * FROM eff WHERE regexp_matches(region, '[.+*]'))",
        "fix AS (SELECT * FROM eff WHERE NOT regexp_matches(region, '[.+*]'))",
    ]


REPLICATION = parse_pairs(fixed.STORAGE_REPLICATION)

MEDIA = f"""CASE WHEN operation IS NOT NULL AND usage_type IS NOT NULL
     AND unit IN ({', '.join(lit(x) for x in parse_list(fixed.STORAGE_UNITS))}) THEN
  CASE WHEN {ending('usage_type', parse_list(fixed.SSD_USAGE_TYPES))} THEN 'SSD'
       WHEN {ending('service_code', parse_list(fixed.SSD_SERVICES))} AND usage_type NOT LIKE '%Backup%' THEN 'SSD'
       WHEN {ending('usage_type', parse_list(fixed.HDD_USAGE_TYPES))} THEN 'HDD' END END"""

COPIES = """CASE
  WHEN service_code IS NULL OR usage_type IS NULL THEN 1
  WHEN service_code = 'AmazonS3' THEN CASE
    WHEN regexp_matches(usage_type, 'TimedStorage-ZIA|EarlyDelete-ZIA|TimedStorage-RRS') THEN 2
    WHEN regexp_matches(usage_type, 'TimedStorage|EarlyDelete') THEN 6 ELSE 1 END
  WHEN service_code = 'AmazonEC2' THEN CASE
    WHEN usage_type LIKE '%VolumeUsage%' THEN 2 WHEN usage_type LIKE '%SnapshotUsage%' THEN 3 ELSE 1 END
  WHEN service_code = 'AmazonEFS' THEN CASE WHEN usage_type LIKE '%ZIA%' THEN 2 ELSE 3 END
  WHEN service_code = 'AmazonRDS' THEN CASE
    WHEN usage_type LIKE '%BackupUsage%' THEN 3 WHEN usage_type LIKE '%Aurora%' THEN 6
    WHEN usage_type LIKE '%Multi-AZ%' THEN 2 ELSE 1 END
  WHEN service_code = 'AmazonDocDB' THEN CASE WHEN usage_type LIKE '%BackupUsage%' THEN 3 ELSE 2 END
  WHEN service_code = 'AmazonDynamoDB' THEN 2
  WHEN service_code = 'AmazonECR' AND usage_type LIKE '%TimedStorage%' THEN 3
  WHEN service_code = 'AmazonElastiCache' AND usage_type LIKE '%BackupUsage%' THEN 3
  WHEN service_code = 'AmazonSimpleDB' AND usage_type LIKE '%TimedStorage%' THEN 2
  ELSE 1 END"""

STORAGE_AWS = f"""((CASE WHEN unit = 'GB-Hours' THEN amount ELSE amount * 24E0 * 30.42E0 END) / 1000E0
  * (CASE {MEDIA} WHEN 'HDD' THEN 0.65E0 / 1024E0 WHEN 'SSD' THEN 1.2E0 / 1024E0 END) * ({COPIES}))"""

SCOPE_NATIVE = """CASE WHEN service_code = 'AWSDataTransfer' THEN
  CASE WHEN transfer_type LIKE 'Inter%' THEN 'inter' WHEN transfer_type LIKE 'IntraRegion%' THEN 'intra'
       WHEN transfer_type LIKE 'AWS Inbound%' OR transfer_type LIKE 'AWS Outbound%' THEN 'extra' END END"""

SCOPE_FOCUS = """CASE WHEN product_code IS DISTINCT FROM 'AmazonCloudFront' THEN
  CASE WHEN regexp_matches(usage_type, 'DataTransfer-(Regional|xAZ-In|xAZ-Out)-Bytes$') THEN 'intra'
       WHEN regexp_matches(usage_type, 'DataTransfer-(In|Out)-Bytes$') THEN 'extra'
       WHEN regexp_matches(usage_type, 'AWS-(In|Out)-Bytes$') THEN 'inter'
       WHEN regexp_matches(usage_type, 'CloudFront.*-(In|Out)-Bytes$') THEN 'inter' END END"""

SCOPE_AZURE = """CASE WHEN category = 'Bandwidth' THEN
  CASE WHEN subcategory LIKE '%Inter-Region%' OR subcategory LIKE 'Rtn Preference: MGN%' THEN 'inter'
       WHEN subcategory LIKE 'Rtn Preference: %' THEN 'extra' END END"""


def network(scope: str) -> str:
    return f"amount * (CASE {scope} WHEN 'intra' THEN 0.001E0 WHEN 'inter' THEN 0.0015E0 WHEN 'extra' THEN 0.059E0 END)"


METER_TYPE = (
    "CASE WHEN instr(usage_type, ':') > 0 AND instr(usage_type, ':') < length(usage_type) "
    "THEN substr(usage_type, instr(usage_type, ':') + 1) END"
)


def aws_type(instance: str, service: str) -> str:
    return f"""CASE
  WHEN product_code = 'AmazonEC2' AND operation LIKE 'RunInstances%' AND {service} = 'AmazonEC2' THEN {instance}
  WHEN product_code = 'AmazonES' AND operation = 'ESDomain' THEN regexp_replace({instance}, '\\.search$', '')
  WHEN product_code = 'AmazonRDS' AND operation LIKE 'CreateDBInstance%' THEN regexp_replace({instance}, '^db\\.', '')
  END"""


AZURE_TYPE = """CASE WHEN category = 'Virtual Machines' AND unit = '1 Hour' AND amount IS NOT NULL THEN
  replace(lower(trim(CASE WHEN position('/' IN meter) > 0 THEN substr(meter, position('/' IN meter) + 1)
  ELSE meter END)), ' ', '_') END"""

SERVERLESS = """amount * (CASE
  WHEN operation = 'FargateTask' THEN CASE
    WHEN usage_type LIKE '%-GB-Hours' THEN 0.0000598E0
    WHEN usage_type LIKE '%-vCPU-Hours:perCPU' THEN
      CASE WHEN usage_type LIKE '%-ARM-%' THEN 0.00191015625E0 ELSE 0.0088121875E0 END END
  WHEN usage_type LIKE '%EMR-SERVERLESS%' THEN CASE
    WHEN usage_type LIKE '%MemoryGBHours' THEN 0.0000598E0
    WHEN usage_type LIKE '%-vCPUHours' THEN
      CASE WHEN usage_type LIKE '%-ARM-%' THEN 0.00191015625E0 ELSE 0.0088121875E0 END END
  END)"""

GPU_TYPE = "CASE WHEN product_code = 'AmazonEC2' AND operation LIKE 'RunInstances%' THEN {} END"

TOKEN_DIRECTION = r"nullif(lower(regexp_extract(usage_type, '^[^-]*-.*-(output|input)-tokens(-batch)?$', 1, 'i')), '')"
TOKEN_MODEL = r"""CASE WHEN regexp_matches(usage_type, '^[^-]*-.*-(output|input)-tokens(-batch)?$', 'i')
  THEN regexp_extract(usage_type, '^[^-]*-(.*)-(output|input)-tokens(-batch)?$', 1, 'i') END"""
TOKENS_PER_UNIT = """CASE WHEN lower(trim(unit)) LIKE '1m%token%' THEN 1000000E0
  WHEN lower(trim(unit)) LIKE '1k%token%' THEN 1000E0 ELSE 1E0 END"""

AZURE_UNITS = "CASE unit WHEN '1 GB/Month' THEN 1 WHEN '10 GB/Month' THEN 10 WHEN '100 GB/Month' THEN 100 WHEN '1 TB/Month' THEN 1024 END"
AZURE_COPIES = """CASE WHEN meter LIKE '%GZRS%' THEN 6 WHEN meter LIKE '%LRS%' OR meter LIKE '%ZRS%' THEN 3
  WHEN meter LIKE '%GRS%' THEN 6 ELSE 1 END"""
AZURE_CAPACITY = f"""CASE WHEN category = 'Storage' AND meter LIKE '%Data Stored%' THEN
  amount * ({AZURE_UNITS}) * 24E0 * 30.42E0 / 1000E0 * (1.2E0 / 1024E0) * ({AZURE_COPIES}) END"""
AZURE_SKU = r"""CASE WHEN category = 'Storage' AND meter NOT LIKE '%Data Stored%' AND subcategory LIKE '%Managed Disks%'
  AND meter NOT LIKE '%Operations%' THEN nullif(regexp_extract(meter, '\b([PES]\d{1,2})\b', 1), '') END"""
AZURE_DISK = """CASE WHEN unit IN ('1/Month', '1 /Month') THEN
  amount * disk.gb * 720E0 / 1000E0 * (CASE WHEN disk.media = 'HDD' THEN 0.65E0 / 1024E0 ELSE 1.2E0 / 1024E0 END) * 3 END"""


def regional(default_pue: float, source: str = "e") -> list[str]:
    """From energy rows to all impacts: PUE and WUE by region, then the products."""
    return [
        f"""places_used AS (SELECT DISTINCT region FROM {source} WHERE region <> '')""",
        """regf AS (
  SELECT region,
         coalesce(fix.pue, (SELECT arg_min(pat.pue, pat.ordinal) FROM pat
            WHERE pat.pue IS NOT NULL AND regexp_full_match(places_used.region, pat.region))) AS pue,
         coalesce(fix.wue, (SELECT arg_min(pat.wue, pat.ordinal) FROM pat
            WHERE pat.wue IS NOT NULL AND regexp_full_match(places_used.region, pat.region))) AS wue,
         intensity, wcf, stress
  FROM places_used LEFT JOIN fix USING (region) LEFT JOIN ci USING (region)
  LEFT JOIN wf USING (region) LEFT JOIN ws USING (region))""",
        f"""p AS (
  SELECT {source}.*,
         CASE WHEN usage THEN coalesce(regf.pue, {lit(default_pue)}) END AS {C.PUE},
         CASE WHEN usage THEN regf.wue END AS {C.WUE},
         regf.wcf, regf.stress,
         CASE WHEN {C.ENERGY} IS NOT NULL THEN regf.intensity END AS {C.INTENSITY}
  FROM {source} LEFT JOIN regf ON {source}.region = regf.region)""",
        f"""w AS (
  SELECT *, CASE WHEN {C.ENERGY} > 0 AND region <> '' THEN {C.ENERGY} * coalesce({C.PUE}, 1E0) END AS site FROM p)""",
        f"""x AS (
  SELECT *, site * {C.WUE} AS {C.WATER_COOLING}, site * wcf AS {C.WATER_ELECTRICITY},
         CASE WHEN site IS NOT NULL AND stress >= 3
              THEN coalesce(site * {C.WUE}, 0E0) + coalesce(site * wcf, 0E0) END AS {C.WATER_STRESS},
         {C.ENERGY} * {C.INTENSITY} * (coalesce({C.PUE}, 1E0) * 1.04E0 * 1.08E0) AS {C.OPERATIONAL}
  FROM w)""",
    ]


def aws(layout: str) -> list[str]:
    """CTEs up to ``x``: enriched AWS lines of a layout."""
    focus = layout == C.FOCUS
    region = "lower(region_code)" if focus else "coalesce(region_code, from_code, to_code)"
    usage = "focus_charge = 'Usage'" if focus else "native_charge LIKE '%Usage'"
    service = "product_code" if focus else "service_code"
    instance = f"({METER_TYPE})" if focus else "instance_type"
    storage = STORAGE_AWS.replace("service_code", "product_code") if focus else STORAGE_AWS
    scope = SCOPE_FOCUS if focus else SCOPE_NATIVE
    return [
        *aws_rows(),
        *factor_ctes(C.AWS),
        f"""g AS (
  SELECT *, {usage} AS usage, CASE WHEN {usage} THEN {region} END AS region,
         {aws_type(instance, service)} AS vm_type, {GPU_TYPE.format(instance)} AS gpu_type,
         CASE WHEN product_code = 'AmazonBedrock' AND {TOKEN_DIRECTION} = 'output' THEN lower({TOKEN_MODEL}) END AS label
  FROM u)""",
        f"""s AS (
  SELECT g.*,
         CASE WHEN usage THEN {storage} END AS storage_kwh,
         CASE WHEN usage THEN {network(scope)} END AS network_kwh,
         CASE WHEN usage THEN vm.kwh * amount END AS vm_kwh,
         CASE WHEN usage THEN vm.embodied_g * amount END AS vm_g,
         CASE WHEN usage THEN vm.depletion_g * amount END AS {C.DEPLETION},
         CASE WHEN usage THEN {SERVERLESS} END AS serverless_kwh,
         CASE WHEN usage THEN amount * (idle_w + 0.5E0 * (full_w - idle_w)) * gpus / 1000E0 END AS gpu_kwh,
         CASE WHEN usage AND amount > 0 THEN amount * {TOKENS_PER_UNIT} / 1000E0 * kwh_per_1k END AS token_kwh,
         CASE WHEN usage AND amount > 0 THEN amount * {TOKENS_PER_UNIT} / 1000E0 * g_per_1k END AS token_g
  FROM g LEFT JOIN vm ON vm_type = vm.instance_type LEFT JOIN gpu ON gpu_type = gpu.instance_type
  LEFT JOIN token_dim USING (label))""",
        f"""e AS (
  SELECT *,
         coalesce(token_kwh, gpu_kwh + coalesce(serverless_kwh, vm_kwh, network_kwh, storage_kwh, 0E0),
                  serverless_kwh, vm_kwh, network_kwh, storage_kwh) AS {C.ENERGY},
         coalesce(token_g, vm_g) AS {C.EMBODIED}
  FROM s)""",
        *regional(1.15),
    ]


def azure(layout: str) -> list[str]:
    usage = "focus_charge = 'Usage'" if layout == C.FOCUS else "native_charge LIKE '%Usage'"
    return [
        *azure_rows(),
        *factor_ctes(C.AZURE),
        f"""g AS (
  SELECT *, {usage} AS usage, CASE WHEN {usage} THEN lower(location) END AS region,
         {AZURE_TYPE} AS vm_type, {AZURE_SKU} AS sku FROM u)""",
        f"""s AS (
  SELECT g.*,
         CASE WHEN usage THEN {AZURE_CAPACITY} END AS capacity_kwh,
         CASE WHEN usage THEN {AZURE_DISK} END AS disk_kwh,
         CASE WHEN usage THEN {network(SCOPE_AZURE)} END AS network_kwh,
         CASE WHEN usage THEN vm.kwh * amount END AS vm_kwh,
         CASE WHEN usage THEN vm.embodied_g * amount END AS {C.EMBODIED},
         CASE WHEN usage THEN vm.depletion_g * amount END AS {C.DEPLETION}
  FROM g LEFT JOIN disk USING (sku) LEFT JOIN vm ON vm_type = vm.instance_type)""",
        f"e AS (SELECT *, coalesce(vm_kwh, network_kwh, capacity_kwh, disk_kwh) AS {C.ENERGY} FROM s)",
        *regional(1.17),
    ]


def aws_report() -> list[str]:
    """CTE ``cur``: enriched native AWS lines under report names."""
    return [
        *aws(C.NATIVE),
        f"""cur AS (
  SELECT order_id, line_no, "BILLING_PERIOD", region, CASE WHEN usage THEN native_charge END AS "ChargeCategory",
         CASE WHEN usage THEN cost END AS "BilledCost", CASE WHEN usage THEN list_cost END AS "ListCost", CASE WHEN usage THEN nullif(service_code, '') END AS "ServiceName",
         CASE WHEN usage THEN nullif(usage_type, '') END AS "SkuMeter",
         product_code, service_code, operation, CASE WHEN usage THEN team END AS team, CASE WHEN usage THEN env END AS env,
         native_charge, cost, list_cost, {C.ENERGY}, {C.INTENSITY}, {C.OPERATIONAL}, {C.EMBODIED}, {C.PUE}, {C.WUE},
         {C.WATER_COOLING}, {C.WATER_ELECTRICITY}, {C.WATER_STRESS}
  FROM x)""",
    ]
