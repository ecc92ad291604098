"""A corpus made ready for training: quality rules, near-duplicates, long repeats, benchmark leaks, packing.

Every stage takes what the one before it kept, with the columns of documents; the last returns sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.llm import op2_leaks, op4_rules, op7_suffix, op8_simhash, op9_packing
from folioscan.llm._common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op4_rules.keep_good(spark, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id.

    Of rows that repeat a doc_id one stays, that with the least hash of its text; rows without a doc_id come after all others, in the order of such hashes.
    """
    # Columns of docs live in a struct meanwhile, so that no name can clash.
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), text.bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1)))
    own = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    found = stage(spark, op8_simhash.near_duplicates(spark, own.select("doc_id", "text")).select("doc_id", "component_id"), "near_duplicates")
    others = found.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = own.join(others.hint("shuffle_hash"), "doc_id", "left_anti")
    again = stage(spark, found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "repeated_ids")
    if again.isEmpty():
        return kept.select("row.*")
    once = kept.join(again, "doc_id", "left_anti").select("row")
    first = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("row", F.xxhash64("text")).alias("row")).select("row")
    return once.union(first).select("row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_suffix.remove_repeats(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_leaks.without_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_packing.pack_documents(spark, docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: Several stages can't be expressed in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
