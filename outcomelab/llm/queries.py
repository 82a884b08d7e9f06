"""Queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(spark, table(spark, sf_dir, "documents"))


@query("op2_benchmark_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import matches
    return matches(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_ngram_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components
    return jaccard_components(spark, table(spark, sf_dir, "documents"))


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score_documents
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(spark, docs, table(spark, sf_dir, "labels")))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find, fit
    docs = table(spark, sf_dir, "documents")
    return find(docs, fit(spark, docs))


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import digests, without_repeats
    return digests(without_repeats(spark, table(spark, sf_dir, "documents")))


@query("op8_token_id_output")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import round_trip
    return round_trip(spark, table(spark, sf_dir, "documents"))


@query("op4_html_extraction")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract
    return extract(spark, table(spark, sf_dir, "pages"))


@query("op6_license_scans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan
    return scan(spark, table(spark, sf_dir, "documents"))


@query("op3_lm_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pitman_yor import score_documents
    return score_documents(spark, table(spark, sf_dir, "documents"))


@query("op11_source_divergence")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit
    return audit(spark, table(spark, sf_dir, "documents"))


@query("op12_filter_interaction")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .interaction import audit
    return audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_sharding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents
    return shard_documents(spark, table(spark, sf_dir, "documents"))
