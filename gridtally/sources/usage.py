"""Reading, repairing, checking and writing usage reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import columns as C

# --- reading ------------------------------------------------------------------


def read_usage(
    spark: SparkSession, path: str, provider: str, layout: str = C.NATIVE, schema: T.StructType | str | None = None
) -> DataFrame:
    """A billing export: Parquet for AWS, CSV with a header for Azure.

    Paths go to Spark as they are, so object stores work wherever the cluster
    has their connector and credentials. Give a schema for large CSV exports;
    without one Spark reads the files an extra time to infer types.
    """
    if provider == C.AZURE:
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return normalize_azure(reader.csv(path), layout)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """Enriched Parquet from a folder, a glob or a single file.

    Hive-style folders become partition columns, also below a glob, whose fixed
    leading part is then the base of the table. Quoted-looking period values
    such as 2025-05 stay text.
    """
    path = path.strip().rstrip("/")
    reader = spark.read
    at = min((path.index(sign) for sign in "*?[" if sign in path), default=-1)
    if at >= 0:
        base = path[:at].rsplit("/", 1)[0]
        base = "/".join(part for part in base.split("/") if "=" not in part)
        reader = reader.option("basePath", base)
    elif path.endswith(".parquet") and f"/{C.BILLING_PERIOD}=" in path:
        reader = reader.option("basePath", path[: path.index(f"/{C.BILLING_PERIOD}=")])
    return reader.parquet(path)


# --- repair of inferred CSV types -----------------------------------------------


def normalize_numeric(df: DataFrame, layout: str = C.NATIVE) -> DataFrame:
    """Amounts and costs as doubles; text that is no number becomes NULL."""
    names = ("ConsumedQuantity", "BilledCost") if layout == C.FOCUS else ("Quantity", "CostInBillingCurrency")
    return df.withColumns({n: F.col(n).try_cast("double") for n in names if n in df.columns})


def parse_date(value: Column) -> Column:
    """ISO dates, then US dates with and without leading zeros, else NULL."""
    return F.coalesce(
        F.try_to_date(value), F.try_to_date(value, "MM/dd/yyyy"), F.try_to_date(value, "M/d/yyyy")
    )


def normalize_date(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", parse_date(F.col("Date").cast("string"))) if "Date" in df.columns else df


def braced(tags: Column) -> Column:
    """Tags as a JSON object; some exports leave the outer braces out."""
    return F.when(~tags.startswith("{"), F.concat(F.lit("{"), tags, F.lit("}"))).otherwise(tags)


def normalize_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("Tags", braced(F.col("Tags"))) if "Tags" in df.columns else df


def normalize_azure(df: DataFrame, layout: str = C.NATIVE) -> DataFrame:
    return normalize_tags(normalize_date(normalize_numeric(df, layout)))


def normalize_product(df: DataFrame, name: str = "product") -> DataFrame:
    """A product column held as key/value structs becomes a map."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return df.withColumn(name, F.map_from_entries(name))
    return df


# --- report view ------------------------------------------------------------------


def billing_period(start: Column) -> Column:
    """``yyyy-MM`` of a charge period start given as timestamp, ISO or US text."""
    text = start.cast("string")
    us = F.coalesce(F.try_to_date(text, "MM/dd/yyyy"), F.try_to_date(text, "M/d/yyyy"))
    return F.when(text.rlike(r"^\d{4}-\d{2}"), F.substring(text, 1, 7)).otherwise(F.date_format(us, "yyyy-MM"))


def conform(df: DataFrame, defaults: Mapping[str, str] = C.REPORT_TYPES) -> DataFrame:
    """Give known columns their canonical case and add absent ones as NULL.

    Without a billing period it is inferred from ``ChargePeriodStart``, so the
    same reports run on the output of every plan.
    """
    canonical = {name.lower(): name for name in defaults}
    have = {c.lower(): c for c in df.columns}
    columns = [F.col(f"`{c}`").alias(canonical.get(c.lower(), c)) for c in df.columns]
    for name, kind in defaults.items():
        if name.lower() in have:
            continue
        if name == C.BILLING_PERIOD and "chargeperiodstart" in have:
            columns.append(billing_period(F.col(have["chargeperiodstart"])).alias(name))
        else:
            columns.append(F.lit(None).cast(kind).alias(name))
    return df.select(*columns)


# --- sharing and writing -------------------------------------------------------------


def anonymize(df: DataFrame, provider: str, keep: Iterable[str] = ()) -> DataFrame:
    """Keep only columns that carry no account, resource or tag of the user's own.

    Everything not on the list of known report and impact columns is dropped,
    in input order; ``keep`` adds names to the list.
    """
    allowed = {*C.AWS_NATIVE_COLUMNS, *C.IMPACT_TYPES, *C.FOCUS_TYPES, *C.AWS_FOCUS_EXTENSION, *keep}
    if provider == C.AZURE:
        allowed |= {*C.AZURE_NATIVE_COLUMNS, *C.AZURE_FOCUS_EXTENSION}
    kept = [c for c in df.columns if c in allowed]
    if not kept:
        raise ValueError(f"no column is on the list of columns to keep: {', '.join(df.columns)}")
    return df.select(*[F.col(f"`{c}`") for c in kept])


#: Frames read from fewer bytes than this are dealt by period before they are written.
DEALT_BELOW = 256 << 20
#: Bytes of sources for one task of a larger write: at least, as long as there are cores without one, and at most.
LEAST_SOURCE, MOST_SOURCE = 32 << 20, 128 << 20
#: Periods that such a task writes side by side, and bytes of rows that it holds for each of them.
OPEN_PERIODS, HELD_BYTES = 128, 4 << 20
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Sources that Spark knows no size of count as larger than this.
UNKNOWN_BYTES = 1 << 62


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of what a frame is read from, or None where Spark does not know them.

    The plan's estimate of the frame itself is no use here: a join multiplies those of its sides.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(leaves.apply(n).stats().sizeInBytes()) for n in range(leaves.size()))
    return size if size < UNKNOWN_BYTES else None


def write_usage(df: DataFrame, path: str) -> None:
    """Overwrite Parquet, with one folder per billing period where there is one."""
    if C.BILLING_PERIOD in df.columns:
        write_periods(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_periods(df: DataFrame, path: str, **options: str) -> None:
    """Overwrite Parquet in folders of billing periods; ``options`` go to the writer.

    A small frame is dealt by period, so each period has few files. Dealing lays every
    row on disk once more, several times as large as in the table, so a large frame is
    written as it lies: each task has a file open for every period it meets, and needs
    neither shuffle nor sort. Tasks are then few enough for files of some size. Once a
    task has met ``OPEN_PERIODS`` periods it sorts the rest of its rows.
    """
    spark, size = df.sparkSession, source_bytes(df)
    if size is None or size < DEALT_BELOW:
        by_period(df).write.mode("overwrite").options(**options).partitionBy(C.BILLING_PERIOD).parquet(path)
        return
    tasks = max(size // MOST_SOURCE, min(size // LEAST_SOURCE, spark.sparkContext.defaultParallelism))
    writer = df.coalesce(max(tasks, 1)).write.mode("overwrite").option("parquet.block.size", HELD_BYTES)
    before = spark.conf.get(OPEN_WRITERS, None)
    spark.conf.set(OPEN_WRITERS, OPEN_PERIODS)
    try:
        writer.options(**options).partitionBy(C.BILLING_PERIOD).parquet(path)
    finally:
        spark.conf.unset(OPEN_WRITERS) if before is None else spark.conf.set(OPEN_WRITERS, before)


def by_period(df: DataFrame) -> DataFrame:
    """The rows dealt by billing period, in parts of the advisory size, of which large periods have several.

    A writer of folders sorts the rows of its task by folder. Usage comes in any order,
    so the rows of a whole input split would be sorted, and spilled, as wide as they are;
    a part fits in memory. The rows are shuffled once, compressed.
    """
    return df.hint("rebalance", F.col(C.BILLING_PERIOD))


def replace_periods(df: DataFrame, path: str, **options: str) -> None:
    """Write the billing periods that a frame holds over those of a table; other periods stay.

    ``path`` may be of any scheme that Hadoop has a file system for; ``options`` go to it.
    Files are staged below the table and its periods change only once all tasks are
    done, so a write that fails leaves the old rows. Periods are folders, which is all
    that readers go by. To delete a period, remove its folder.
    """
    if C.BILLING_PERIOD not in df.columns:
        raise ValueError(f"periods are replaced by column {C.BILLING_PERIOD}, which is missing")
    write_periods(df, path, **options, partitionOverwriteMode="dynamic")
