"""Factor tables as Spark frames, and the lookups that join them to usage.

Factor tables are small configuration: regions, instance types, models. The
fixed ones become in-memory relations of known length. Loaded ones have no
promised size, so each is counted once, up to a bound, when it is loaded: within
the bound its lookups are broadcast, beyond it they are ordinary joins that
Spark shuffles and that adaptive execution splits where keys are skewed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C
from gridtally.factors import fixed
from gridtally.factors.patterns import resolve

MAX_BROADCAST_ROWS = 200_000
#: Region patterns of a provider that become part of the plan; more are joined by key.
MAX_PLANNED_PATTERNS = 50


def literal(value: object) -> str:
    """A Spark SQL literal; floats are written as doubles, not decimals."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        text = repr(value)
        return text if "e" in text else text + "E0"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_frame(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str) -> DataFrame:
    """A small in-memory relation with declared types, built without Python workers."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    body = ", ".join(
        "(" + ", ".join(f"CAST({literal(v)} AS {kind})" for v, (_, kind) in zip(row, fields)) + ")" for row in rows
    )
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in fields)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    names = ", ".join(name for name, _ in fields)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def parse_block(block: str, *kinds: type) -> list[tuple]:
    """Rows of a fixed-value text block; a blank field is NULL."""
    rows = []
    for line in block.strip().splitlines():
        parts = [p.strip() for p in line.split(",")]
        parts += [""] * (len(kinds) - len(parts))
        rows.append(tuple(kind(p) if p else None for kind, p in zip(kinds, parts)))
    return rows


def parse_list(block: str) -> list[str]:
    return block.strip().splitlines()


def parse_pairs(block: str) -> dict[str, int]:
    return {key: int(value) for key, value in (line.rsplit(",", 1) for line in block.strip().splitlines())}


@dataclass(frozen=True)
class Dim:
    """A lookup table with unique keys, and whether its size is proven small."""

    frame: DataFrame
    small: bool
    empty: bool = False

    @staticmethod
    def checked(frame: DataFrame, limit: int = MAX_BROADCAST_ROWS, key: Sequence[str] = ()) -> Dim:
        """Size a table of unknown length; reads at most ``limit`` + 1 of its rows.

        A repeated ``key`` would multiply usage rows, so it raises.
        """
        if key:
            twice = frame.groupBy(*key).count().where("count > 1").drop("count").first()
            if twice is not None:
                raise ValueError(f"lookup key given twice: {', '.join(map(str, twice))}")
        rows = frame.limit(limit + 1).count()
        return Dim(frame, rows <= limit, rows == 0)


def settled(dim: Dim, limit: int = 5_000) -> Dim:
    """A derived lookup table worked out now, if it is only some thousand rows.

    Every plan then starts from its rows, not from the joins and aggregates
    that made them.
    """
    rows = dim.frame.limit(limit + 1).collect()
    if len(rows) > limit:
        return dim
    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in dim.frame.schema.fields)
    return Dim(values_frame(dim.frame.sparkSession, [tuple(row) for row in rows], schema), True)


def spread_nulls(df: DataFrame, key: Column) -> Column:
    """A join key whose NULLs, which match nothing, do not all land in one task.

    Most usage lines have no key for any one lookup. They get a blank-led key
    from the hash of their plain columns instead.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    spare = F.concat(F.lit(" "), F.xxhash64(*[F.col(f"`{c}`") for c in plain]).cast("string"))
    return F.coalesce(key, spare)


def lookup(df: DataFrame, dim: Dim, key: Column, dim_key: str, prefix: str) -> DataFrame:
    """Left join a lookup table by a text key; its value columns arrive with ``prefix``."""
    renamed = dim.frame.select([F.col(c).alias(prefix + c) for c in dim.frame.columns])
    if dim.small:
        joined = df.join(F.broadcast(renamed), key == F.col(prefix + dim_key), "left")
    else:
        joined = df.join(renamed, spread_nulls(df, key) == F.col(prefix + dim_key), "left")
    return joined.drop(prefix + dim_key)


def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the last in the given order; combined on the map side."""
    row = F.max_by(F.struct(*df.columns), F.col(order)).alias("_row")
    return df.groupBy(*keys).agg(row).select("_row.*")


EFFICIENCY_SCHEMA = "ordinal int, region string, pue double, wue double"


def is_pattern(key: Column) -> Column:
    """Region keys holding one of ``.+*`` are patterns over the whole region code."""
    return key.contains(".") | key.contains("+") | key.contains("*")


@dataclass(frozen=True)
class Factors:
    """All factor tables one enrichment run needs.

    ``compute`` holds hourly impacts per instance type and ``tokens`` those per
    thousand output tokens per model. Both have hundreds of rows that change
    often, so they are given as landed files; see :meth:`with_compute` and
    :meth:`with_tokens`.
    """

    spark: SparkSession
    intensity: Dim
    water: Dim
    stress: Dim
    efficiency: dict[str, Dim]
    gpu: Dim
    disks: Dim
    labels: Dim
    compute: Dim
    tokens: Dim
    patterns: dict[str, list[tuple[str, float | None, float | None]]] = field(default_factory=dict)
    many_patterns: dict[str, DataFrame] = field(default_factory=dict)
    _merged: dict[str, Dim] = field(default_factory=dict, init=False, repr=False, compare=False)

    @staticmethod
    def default(spark: SparkSession) -> Factors:
        """The published fixed tables; no compute or token coefficients."""

        def dim(rows: list[tuple], schema: str) -> Dim:
            return Dim(values_frame(spark, rows, schema), len(rows) <= MAX_BROADCAST_ROWS, not rows)

        power = {model: (idle, full) for model, idle, full in parse_block(fixed.GPU_POWER, str, float, float)}
        gpus = [
            (kind, model, count, *power[model]) for kind, model, count in parse_block(fixed.GPU_INSTANCES, str, str, int)
        ]
        efficiency, patterns = {}, {}
        for provider, block in ((C.AWS, fixed.AWS_PUE_WUE), (C.AZURE, fixed.AZURE_PUE_WUE)):
            rows = efficiency_rows(block)
            efficiency[provider] = dim(rows, EFFICIENCY_SCHEMA)
            patterns[provider] = [
                (key, pue, wue) for _, key, pue, wue in rows if any(sign in key for sign in ".+*")
            ]
        return Factors(
            spark=spark,
            intensity=dim(
                parse_block(fixed.CARBON_INTENSITY, str, str, float), "provider string, region string, intensity double"
            ),
            water=dim(
                parse_block(fixed.WATER_CONSUMPTION, str, str, float), "provider string, region string, wcf double"
            ),
            stress=dim(parse_block(fixed.WATER_STRESS, str, str, int), "provider string, region string, stress int"),
            efficiency=efficiency,
            patterns=patterns,
            gpu=dim(gpus, "instance_type string, gpu string, gpus int, idle_w double, full_w double"),
            disks=dim(parse_block(fixed.AZURE_DISKS, str, int, str), "sku string, gb int, media string"),
            labels=dim(
                [
                    (label.lower(), provider, model)
                    for label, provider, model in parse_block(fixed.TOKEN_MODEL_LABELS, str, str, str)
                ],
                "label string, provider string, model string",
            ),
            compute=dim([], COMPUTE_SCHEMA),
            tokens=dim([], TOKEN_SCHEMA),
        )

    def with_compute(self, frame: DataFrame) -> Factors:
        """Use landed compute impacts (``COMPUTE_SCHEMA``)."""
        return replace(self, compute=Dim.checked(frame, key=["instance_type"]))

    def with_tokens(self, frame: DataFrame) -> Factors:
        """Use landed token coefficients (``TOKEN_SCHEMA``)."""
        return replace(self, tokens=Dim.checked(frame, key=["provider", "model"]))

    def with_tables(self, **frames: DataFrame) -> Factors:
        """Replace other lookup tables by frames of the same columns."""
        return replace(self, **{name: Dim.checked(frame) for name, frame in frames.items()})

    def with_efficiency(self, provider: str, frame: DataFrame) -> Factors:
        """Replace one provider's PUE/WUE table (``EFFICIENCY_SCHEMA``)."""
        dim = Dim.checked(frame)
        patterns = frame.where(is_pattern(F.col("region")))
        rows = patterns.orderBy("ordinal", "region").limit(MAX_PLANNED_PATTERNS + 1).collect()
        few = len(rows) <= MAX_PLANNED_PATTERNS
        others = {key: value for key, value in self.many_patterns.items() if key != provider}
        return replace(
            self,
            efficiency={**self.efficiency, provider: dim},
            patterns={**self.patterns, provider: [(r["region"], r["pue"], r["wue"]) for r in rows] if few else []},
            many_patterns=others if few else {**others, provider: patterns},
        )

    def region_dim(self, provider: str) -> Dim:
        """Every known region of a provider with all its factors in one row.

        Merging first means usage rows meet a single region join. PUE and WUE
        are resolved here for all known regions, so that patterns are only
        tried on a row whose region no table names.
        """
        if provider not in self._merged:
            self._merged[provider] = settled(self._region_dim(provider))
        return self._merged[provider]

    def _region_dim(self, provider: str) -> Dim:
        key = C.FACTOR_PROVIDER[provider]
        none = F.lit(None).cast("double")

        def part(frame: DataFrame, **values: Column) -> DataFrame:
            measures = [
                values.get(name, none).cast("double").alias(name) for name in ("intensity", "wcf", "stress", "pue", "wue")
            ]
            return frame.select("region", *measures)

        own = F.col("provider") == key
        efficiency = self.efficiency.get(provider)
        parts = [
            part(self.intensity.frame.where(own), intensity=F.col("intensity")),
            part(self.water.frame.where(own), wcf=F.col("wcf")),
            part(self.stress.frame.where(own), stress=F.col("stress")),
        ]
        if efficiency is not None:
            exact = efficiency.frame.where(~is_pattern(F.col("region")))
            parts.append(part(exact, pue=F.col("pue"), wue=F.col("wue")))
        merged = parts[0]
        for more in parts[1:]:
            merged = merged.unionByName(more)
        merged = merged.groupBy("region").agg(
            *[F.max(name).alias(name) for name in ("intensity", "wcf", "stress", "pue", "wue")]
        )
        by_pattern = {m: self.pattern_value(provider, F.col("region"), m) for m in ("pue", "wue")}
        if provider in self.many_patterns:
            named = merged.where("region IS NOT NULL").select("region")
            found = resolve(named, self.many_patterns[provider])
            merged = merged.join(found.withColumnsRenamed({"pue": "_pue", "wue": "_wue"}), "region", "left")
            by_pattern = {m: F.col(f"_{m}") for m in ("pue", "wue")}
        frame = merged.select(
            "region",
            "intensity",
            "wcf",
            F.col("stress").cast("int").alias("stress"),
            F.coalesce("pue", by_pattern["pue"]).alias("pue"),
            F.coalesce("wue", by_pattern["wue"]).alias("wue"),
            F.lit(True).alias("known"),
        )
        sources = [self.intensity, self.water, self.stress, *([efficiency] if efficiency else [])]
        return Dim(frame, all(source.small for source in sources))

    def pattern_value(self, provider: str, region: Column, measure: str) -> Column:
        """Value of the first pattern, in file order, that covers the whole region."""
        at = {"pue": 1, "wue": 2}[measure]
        result = F.lit(None).cast("double")
        for row in reversed(self.patterns.get(provider, [])):
            if row[at] is not None:
                result = F.when(region.rlike(f"^(?:{row[0]})$"), F.lit(row[at])).otherwise(result)
        return result

    def with_pattern_values(self, df: DataFrame, provider: str, region: Column) -> DataFrame:
        """Add ``_rp_pue`` and ``_rp_wue`` for regions that no table names, if patterns are too many to be planned.

        ``region`` is NULL where a table names it. Reads the distinct regions of ``df`` ahead of its rows.
        """
        if provider not in self.many_patterns:
            return df
        if df.isStreaming:
            raise ValueError(f"a stream takes at most {MAX_PLANNED_PATTERNS} region patterns")
        unnamed = df.select(region.alias("region")).where("region <> ''").distinct()
        found = resolve(unnamed, self.many_patterns[provider])
        found = found.withColumnsRenamed({name: f"_rp_{name}" for name in found.columns})
        return df.join(found, spread_nulls(df, region) == F.col("_rp_region"), "left").drop("_rp_region")

    def token_dim(self) -> Dim:
        """Label -> coefficients: the two hops merged ahead of the usage join."""
        if "tokens" not in self._merged:
            frame = self.labels.frame.join(self.tokens.frame, ["provider", "model"]).select(
                "label", "kwh_per_1k", (F.col("kg_per_1k") * F.lit(1000.0)).alias("g_per_1k")
            )
            self._merged["tokens"] = settled(Dim(frame, self.labels.small and self.tokens.small))
        return self._merged["tokens"]


COMPUTE_SCHEMA = "instance_type string, kwh double, embodied_g double, depletion_g double"
TOKEN_SCHEMA = "provider string, model string, kwh_per_1k double, kg_per_1k double, depletion_kg_per_1k double"


def efficiency_rows(block: str) -> list[tuple[int, str, float | None, float | None]]:
    """PUE/WUE rows with their file order, which settles overlapping patterns."""
    rows = parse_block(block, str, str, float, float)
    return [(n, region, pue, wue) for n, (_, region, pue, wue) in enumerate(rows)]


# File layouts: field names in order, key fields, fields that must be numeric,
# and whether any other number of fields is an error.
CSV_LAYOUTS = {
    "compute": (("instance_type", "kwh", "embodied_g", "depletion_g"), ("instance_type",), 1, True),
    "intensity": (("provider", "region", "intensity"), ("provider", "region"), 2, True),
    "efficiency": (("place", "region", "pue", "wue"), ("region",), None, False),
    "water": (("provider", "region", "wcf"), ("provider", "region"), 2, False),
    "stress": (("provider", "region", "stress"), ("provider", "region"), 2, False),
    "tokens": (
        ("provider", "model", "kwh_per_1k", "kg_per_1k", "depletion_kg_per_1k"),
        ("provider", "model"),
        2,
        False,
    ),
    "labels": (("label", "provider", "model"), ("label",), None, False),
}


def load_factor_csv(spark: SparkSession, paths: str | Iterable[str], kind: str) -> DataFrame:
    """Read a factor file: ``#`` and blank lines skipped, fields trimmed.

    Lines with too few fields are skipped, or fail the job where the layout is
    strict. The header drops out because its measures are not numbers. When a
    key repeats, its last line wins: paths count in the order given, files of one
    path by name, whatever their sizes.
    """
    parts = []
    for n, path in enumerate([paths] if isinstance(paths, str) else paths):
        # Within one block of a file the row number grows; between blocks it need not.
        number = F.monotonically_increasing_id()
        place = [F.lpad(x.cast("string"), 20, "0") for x in (F.lit(n), F.col("_metadata.file_block_start"), number)]
        order = F.concat(place[0], F.col("_metadata.file_path"), F.lit("\n"), place[1], place[2])
        parts.append(spark.read.text(path).select("value", order.alias("line_no")))
    return parse_factor_lines(reduce(DataFrame.unionByName, parts), kind)


def parse_factor_lines(lines: DataFrame, kind: str) -> DataFrame:
    """Parse text lines (``value``, ``line_no``) of one factor layout.

    ``line_no`` is anything that sorts in the order of the lines.
    """
    names, keys, first_number, strict = CSV_LAYOUTS[kind]
    text = F.trim("value")
    is_data = F.coalesce((text != "") & ~text.startswith("#"), F.lit(False))
    # Trailing empty fields do not count towards the number of fields.
    parts = F.split(F.regexp_replace("value", r",+\s*$", ""), ",")
    needed = len(names) - 1 if kind == "efficiency" else len(names)
    if strict:
        # Filters may be evaluated in any order, so the test for a data line is
        # part of the expression that can fail.
        bad = F.raise_error(F.concat(F.lit("bad factor line: "), F.col("value")))
        parts = F.when(is_data, F.when(F.size(parts) == needed, parts).otherwise(bad))
    else:
        parts = F.when(is_data & (F.size(parts) >= needed), parts)
    got = lines.select("line_no", parts.alias("parts")).where("parts IS NOT NULL")
    fields = [F.trim(F.get("parts", F.lit(n))).alias(name) for n, name in enumerate(names)]
    frame = got.select("line_no", *fields)
    for key in keys:
        frame = frame.where(F.coalesce(F.col(key) != "", F.lit(False)))
    if kind == "efficiency":
        frame = frame.withColumns({m: F.col(m).try_cast("double") for m in ("pue", "wue")})
        frame = frame.where("pue IS NOT NULL OR wue IS NOT NULL")
    elif kind == "labels":
        frame = frame.where("lower(label) <> 'label' AND provider <> '' AND model <> ''")
        frame = frame.withColumn("label", F.lower("label"))
    else:
        numbers = names[first_number:]
        number = "int" if kind == "stress" else "double"
        frame = frame.withColumns({m: F.col(m).try_cast(number) for m in numbers}).dropna(subset=list(numbers))
    last = last_per_key(frame, keys, "line_no")
    if kind == "efficiency":
        return last.select(F.col("line_no").alias("ordinal"), "region", "pue", "wue")
    return last.drop("line_no")


def load_disks_json(spark: SparkSession, path: str) -> DataFrame:
    """Managed disk SKUs from a JSON object of SKU -> capacity and medium."""
    schema = "MANAGED_DISKS map<string, struct<capacity_gb:int, storage_type:string>>"
    return (
        spark.read.schema(schema)
        .json(path, multiLine=True)
        .select(F.explode("MANAGED_DISKS").alias("sku", "disk"))
        .select("sku", F.col("disk.capacity_gb").alias("gb"), F.col("disk.storage_type").alias("media"))
    )


def load_gpu_json(spark: SparkSession, path: str) -> DataFrame:
    """GPU instances joined to the power draw of their GPU model."""
    schema = (
        "GPU_INSTANCES_TYPES map<string, struct<type:string, quantity:int>>, "
        "GPU_INFO map<string, struct<min:double, max:double>>"
    )
    root = spark.read.schema(schema).json(path, multiLine=True)
    instances = root.select(F.explode("GPU_INSTANCES_TYPES").alias("instance_type", "of")).select(
        "instance_type", F.col("of.type").alias("gpu"), F.col("of.quantity").alias("gpus")
    )
    power = root.select(F.explode("GPU_INFO").alias("gpu", "power")).select(
        "gpu", F.col("power.min").alias("idle_w"), F.col("power.max").alias("full_w")
    )
    return instances.join(power, "gpu").select("instance_type", "gpu", "gpus", "idle_w", "full_w")


def load_storage_rules_json(spark: SparkSession, path: str) -> DataFrame:
    """Storage token lists as rows: priority, match kind, token, medium."""
    schema = "SSD_USAGE_TYPES array<string>, SSD_SERVICES array<string>, HDD_USAGE_TYPES array<string>"
    root = spark.read.schema(schema).json(path, multiLine=True)
    rules = (
        (1, "usage_type", "SSD", "SSD_USAGE_TYPES"),
        (2, "service", "SSD", "SSD_SERVICES"),
        (3, "usage_type", "HDD", "HDD_USAGE_TYPES"),
    )
    parts = [
        root.select(
            F.lit(n).alias("priority"),
            F.lit(match).alias("match_kind"),
            F.explode(name).alias("token"),
            F.lit(media).alias("media"),
        )
        for n, match, media, name in rules
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
