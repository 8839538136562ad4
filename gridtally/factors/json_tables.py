"""Factor files in JSON, as rows, whatever their depth.

A file is one document. Documents are parsed to variants, so that lists and objects
keyed by names of any kind become rows without a schema that names the keys. What
cannot be read is told row by row, beside the rows that can.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lists and objects within each other, at most; what lies deeper is told as a problem.
DEPTH = 8


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, payload) of JSON files, one row for each."""
    text = spark.read.text(paths, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("payload"))


def parsed(documents: DataFrame) -> DataFrame:
    """Documents with their content as ``doc``; NULL where the text is no JSON."""
    return documents.withColumn("doc", F.try_parse_json("payload"))


def _entries(rows: DataFrame, value: str, key: str, kept: list[str]) -> DataFrame:
    """One row for each entry of a variant that is a list or an object."""
    spread = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(value).outer()))
    name = F.coalesce("key", F.col("pos").cast("string"))
    return spread.select(*kept, name.alias(key), F.col("value").alias("_entry"))


def _is_container(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def keyed(documents: DataFrame, root: str, fields: Mapping[str, str]) -> DataFrame:
    """Entries of an object (or list) under ``root``: (file, key, fields, problem).

    A field that is absent, or of another kind, is NULL; the second is a problem.
    """
    held = parsed(documents).select("file", F.try_variant_get("doc", f"$.{root}", "variant").alias("_root"))
    entries = _entries(held.where("_root IS NOT NULL"), "_root", "key", ["file"])
    values = {name: F.try_variant_get("_entry", f"$.{name}", kind) for name, kind in fields.items()}
    wrong = [
        F.when(F.try_variant_get("_entry", f"$.{name}", "variant").isNotNull() & value.isNull(), F.lit(name))
        for name, value in values.items()
    ]
    problem = F.nullif(F.concat_ws(", ", *wrong), F.lit(""))
    return entries.select(
        "file", "key", *[v.alias(n) for n, v in values.items()], F.concat(F.lit("bad value: "), problem).alias("problem")
    )


def listed(documents: DataFrame, root: str) -> DataFrame:
    """Texts of a list under ``root``, in order: (file, place, token)."""
    held = parsed(documents).select("file", F.try_variant_get("doc", f"$.{root}", "variant").alias("_root"))
    entries = _entries(held.where("_root IS NOT NULL"), "_root", "place", ["file"])
    return entries.select("file", F.col("place").cast("int").alias("place"), F.try_variant_get("_entry", "$", "string").alias("token"))


def leaves(documents: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Every single value of every document: (file, path, value, problem), names joined by slashes.

    Unreadable documents, and lists and objects deeper than ``depth``, have a row with
    their problem and no value. Empty lists and objects have no row.
    """
    rows = parsed(documents)
    bad = rows.where("doc IS NULL").select(
        "file", F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("value"),
        F.when(F.col("payload").isNull(), "no text").otherwise("no JSON").alias("problem"),
    )
    level = rows.where("doc IS NOT NULL").select("file", F.lit("").alias("path"), F.col("doc").alias("_entry"))
    found, shown = [bad], ["file", "path", "value", "problem"]

    def row(level: DataFrame, value: Column, problem: Column) -> DataFrame:
        return level.select("file", F.substr("path", F.lit(2)).alias("path"), value.alias("value"), problem.alias("problem"))

    for _ in range(depth):
        deeper = level.where(_is_container(F.col("_entry")))
        single = level.where(~_is_container(F.col("_entry")))
        found.append(row(single, F.try_variant_get("_entry", "$", "string"), F.lit(None).cast("string")))
        entries = _entries(deeper, "_entry", "_key", ["file", "path"])
        level = entries.where("_key IS NOT NULL").select("file", F.concat_ws("/", "path", "_key").alias("path"), "_entry")
    found.append(row(level.where(~_is_container(F.col("_entry"))), F.try_variant_get("_entry", "$", "string"), F.lit(None).cast("string")))
    found.append(row(level.where(_is_container(F.col("_entry"))), F.lit(None).cast("string"), F.lit("too deep")))
    result = found[0].select(*shown)
    for more in found[1:]:
        result = result.unionByName(more.select(*shown))
    return result


#: Fields of the keyed tables in factor files.
KEYED = {
    "MANAGED_DISKS": {"capacity_gb": "int", "storage_type": "string"},
    "GPU_INSTANCES_TYPES": {"type": "string", "quantity": "int"},
    "GPU_INFO": {"min": "double", "max": "double"},
}
#: Lists of tokens in factor files, in the order in which they are tried.
LISTED = ("SSD_USAGE_TYPES", "SSD_SERVICES", "HDD_USAGE_TYPES")


def factor_rows(documents: DataFrame) -> DataFrame:
    """All that factor files hold, in one form: (file, layout, key, field, value, problem).

    Keyed tables give a row for each entry and field, lists a row for each token with
    its place as key. A document that is no JSON, or holds none of the tables, gives one
    row with its problem.
    """
    none = F.lit(None).cast("string")
    parts = []
    for root, fields in KEYED.items():
        pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
        rows = keyed(documents, root, fields)
        parts.append(rows.select("file", F.lit(root).alias("layout"), "key", F.inline(pairs), "problem"))
    for root in LISTED:
        rows = listed(documents, root)
        parts.append(
            rows.select(
                "file",
                F.lit(root).alias("layout"),
                F.col("place").cast("string").alias("key"),
                F.lit("token").alias("field"),
                F.col("token").alias("value"),
                none.alias("problem"),
            )
        )
    roots = [F.try_variant_get("doc", f"$.{root}", "variant").isNotNull() for root in (*KEYED, *LISTED)]
    held = roots[0]
    for other in roots[1:]:
        held = held | other
    problem = F.when(F.col("doc").isNull(), F.lit("no JSON")).when(~held, F.lit("no table"))
    empty = parsed(documents).select("file", *[none.alias(c) for c in ("layout", "key", "field", "value")], problem.alias("problem"))
    result = empty.where("problem IS NOT NULL")
    for part in parts:
        result = result.unionByName(part)
    return result
