"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, counts, hnsw, language, licenses, mixing, packing, pipeline, prefixes, quality, repair, simhash, substrings, toxicity
from .common import table


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_neighbours": _over("embeddings", hnsw.op1),
    "op2_simhash_near_duplicates": _over("documents", simhash.op2),
    "op3_toxicity": toxicity.op3,
    "op4_token_counts": _over("documents", counts.op4),
    "op5_source_mix": _over("documents", mixing.op5),
    "op6_quality_rules": quality.op6,
    "op7_token_files": _over("documents", repair.op7),
    "op8_packing": _over("documents", packing.op8),
    "op9_language": _over("documents", language.op9),
    "op10_licenses": _over("documents", licenses.op10),
    "op11_prefix_trie": _over("conversations", prefixes.op11),
    "op12_token_alignment": _over("documents", alignment.op12),
    "op13_substring_dedup": _over("documents", substrings.op13),
    "pipeline": pipeline.run,
}
ORACLES = {"op5_source_mix": mixing.OP5_SQL, "op11_prefix_trie": prefixes.OP11_SQL}
