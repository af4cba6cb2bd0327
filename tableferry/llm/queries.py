"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableferry.llm import backoff, centroids, contamination, html, language, licenses, mixing, neardup, periods, pii, sharding, substrings, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": pii.q_op1,
    "op2_shards": sharding.q_op2,
    "op3_repeated_substrings": substrings.q_op3,
    "op4_mix_sources": mixing.q_op4,
    "op5_decontaminate": contamination.q_op5,
    "op6_license_scan": licenses.q_op6,
    "op7_near_duplicates": neardup.q_op7,
    "op8_main_text": html.q_op8,
    "op9_top_k": vectors.q_op9,
    "op10_language_id": language.q_op10,
    "op11_centroids": centroids.q_op11,
    "op12_periodic_runs": periods.q_op12,
    "op13_model_scores": backoff.q_op13,
}
ORACLES: dict[str, str] = {
    "op4_mix_sources": mixing.OP4_SQL,
    "op5_decontaminate": contamination.OP5_SQL,
    "op6_license_scan": licenses.OP6_SQL,
    "op7_near_duplicates": neardup.OP7_SQL,
    "op9_top_k": vectors.OP9_SQL,
    "op11_centroids": centroids.OP11_SQL,
}
