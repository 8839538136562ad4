"""Reading the given tables, and Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column; a null is the empty text."""
    return [text or "" for text in column.to_pylist()]


def mapped(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """Apply a step that turns each Arrow batch into column dictionaries."""
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                for columns in step(batch):
                    yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def in_groups(batches: Batches, keys: list[str]) -> Iterator[pa.Table]:
    """Groups of equal keys out of rows that are sorted by them, one table each.

    Rows come through the batches in order, so only the group at hand is held.
    """
    import numpy as np

    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            change |= column[1:] != column[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            part = batch.slice(begin, end - begin)
            if rest and any(rest[-1].column(key)[-1].as_py() != part.column(key)[0].as_py() for key in keys):
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(part)
    if rest:
        yield pa.Table.from_batches(rest)
