"""Registered queries of the training-data problems, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from raqim.llm import lookalike, mixing, mojibake, neardup, packing, residue, site_lines, stuffing, tokens, truncation
from raqim.session import checkpointed, spread, table


def _results(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "crawler_results"))


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_pairs(_results(spark, d))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(_results(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.stuffing(_results(spark, d)).filter("spam").select("id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(_results(spark, d)).select("id", "field")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.report(_results(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.marked(_results(spark, d)).select("id", "field")


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    df = _results(spark, d)
    rules = lookalike.form_table(lookalike.character_counts(df, ["title", "snippet"]))
    return lookalike.forms(df, "id", ["title", "snippet"], rules, ["description"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(_results(spark, d)).select("id", "field").distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.repeated_lines(_results(spark, d)).select("id", "field", "line_no")


def p6_blocks(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.blocks(_results(spark, d))


def p6_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return site_lines.cleaned(_results(spark, d))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    capacities = table(spark, d, "pack_capacities").withColumnRenamed("capacity_tokens", "capacity")
    return packing.packed(tokens.sizes(_documents(spark, d), ["doc_id"]), capacities)


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.report(p7_packed(spark, d))


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(tokens.sizes(_documents(spark, d), ["doc_id", "source"]), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(checkpointed(p8_mixed(spark, d)), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled(_documents(spark, d)).select("doc_id").distinct()


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.garbled(_documents(spark, d)).select("doc_id", "restored", "spans", "lost")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        p1_found, p1_groups, p2_found, p3_found, p3_report, p4_found, p4_forms, p5_found, p6_found, p6_blocks, p6_cleaned, p7_packed, p7_report, p8_mixed, p8_shares, p9_found, p9_restored,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """None of these is put in SQL; tests/llm holds them against brute force, exact round trips and built cases."""
    return {}
