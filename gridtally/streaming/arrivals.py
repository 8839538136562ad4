"""Enrichment of usage lines as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridtally import columns as C
from gridtally.factors.tables import Factors
from gridtally.plans.pipelines import Plan, enrich


def enrich_arrivals(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    provider: str,
    layout: str,
    factors: Factors,
    plan: Plan | None = None,
) -> StreamingQuery:
    """Enrich Parquet files landing in a folder and append the result.

    Enrichment keeps no state: it is a projection with joins of the stream to
    static factor tables, so the batch plan serves as it is. Runs over what has
    arrived and stops.
    """
    arriving: DataFrame = spark.readStream.schema(schema).parquet(source)
    writer = enrich(arriving, provider, layout, factors, plan).writeStream.format("parquet")
    if C.BILLING_PERIOD in arriving.columns:
        writer = writer.partitionBy(C.BILLING_PERIOD)
    return (
        writer.option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
