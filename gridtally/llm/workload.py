"""Registered queries of the corpus operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridtally.llm.decontaminate import op10_benchmark_leaks
from gridtally.llm.divergence import op11_source_divergence
from gridtally.llm.divergence import oracle as divergence_sql
from gridtally.llm.embeddings import op4_near_vectors
from gridtally.llm.html_text import op3_main_text
from gridtally.llm.jaccard import op7_jaccard_join
from gridtally.llm.language import op5_language_id
from gridtally.llm.mixing import op6_mixed_sample
from gridtally.llm.mixing import oracle as mixing_sql
from gridtally.llm.packing import op13_packed_sequences
from gridtally.llm.repeats import op8_repeated_bytes
from gridtally.llm.secrets import op1_secret_scan
from gridtally.llm.sharding import op2_byte_shards
from gridtally.llm.tables import table
from gridtally.llm.token_counts import op9_section_tokens
from gridtally.llm.vector_codes import op12_vector_codes
from gridtally.llm.vector_codes import oracle as codes_sql

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[..., DataFrame], *more: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(table(spark, sf_dir, each) for each in (name, *more)))

    return run


QUERIES: dict[str, Query] = {
    "op1_secret_scan": _over("documents", op1_secret_scan),
    "op2_byte_shards": _over("documents", op2_byte_shards),
    "op3_main_text": _over("pages", op3_main_text),
    "op4_near_vectors": _over("embeddings", op4_near_vectors),
    "op5_language_id": _over("documents", op5_language_id),
    "op6_mixed_sample": _over("documents", op6_mixed_sample),
    "op7_jaccard_join": _over("documents", op7_jaccard_join),
    "op8_repeated_bytes": _over("documents", op8_repeated_bytes),
    "op9_section_tokens": _over("documents", op9_section_tokens),
    "op10_benchmark_leaks": _over("documents", op10_benchmark_leaks, "benchmark"),
    "op11_source_divergence": _over("documents", op11_source_divergence),
    "op12_vector_codes": _over("embeddings", op12_vector_codes),
    "op13_packed_sequences": _over("documents", op13_packed_sequences),
}

ORACLE: dict[str, str] = {
    "op6_mixed_sample": mixing_sql(),
    "op11_source_divergence": divergence_sql(),
    "op12_vector_codes": codes_sql(),
}
