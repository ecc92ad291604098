"""Retrieval evaluation: gold answers, hit rates, comparison of runs, grades, reading cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions import labels as N

from . import editions

KS = (1, 3, 5, 10)


def first_rank(questions: DataFrame, results: DataFrame, gold: DataFrame, key: list[str]) -> DataFrame:
    """questions (qid, kind) with the rank of the first gold answer, null if none was returned."""
    hit = results.join(gold.select("qid", *key).distinct(), ["qid", *key]).groupBy("qid").agg(F.min("rank").alias("rank"))
    return questions.select("qid", "kind").join(hit, "qid", "left")


def hit_rates(ranks: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """hit@k and mean reciprocal rank of each kind, and of all as kind 'all'."""
    share = [F.round(F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)), 6).alias(f"hit_{k}") for k in ks]
    mrr = F.round(F.avg(F.when(F.col("rank") <= max(ks), 1 / F.col("rank")).otherwise(0.0)), 6).alias("mrr")
    return ranks.rollup("kind").agg(F.count("*").alias("n"), *share, mrr, F.grouping("kind").alias("_all")).select(F.when(F.col("_all") == 1, "all").otherwise(F.col("kind")).alias("kind"), "n", *[f"hit_{k}" for k in ks], "mrr")


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """What moved between two runs (qid, rank): better, worse, only in one; what stayed is left out."""
    both = a.select("qid", F.col("rank").alias("rank_a"), F.lit(1).alias("_a")).join(b.select("qid", F.col("rank").alias("rank_b"), F.lit(1).alias("_b")), "qid", "full_outer")
    worst = F.lit(1 << 30)
    change = F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(F.coalesce("rank_b", worst) < F.coalesce("rank_a", worst), "better").when(F.coalesce("rank_b", worst) > F.coalesce("rank_a", worst), "worse").otherwise("same")
    return both.withColumn("change", change).filter("change <> 'same'").select("qid", "rank_a", "rank_b", "change")


def grade_report(records: DataFrame, verdicts: tuple[str, ...]) -> DataFrame:
    """Counts of each verdict by kind and over all; rates leave errors out."""
    counts = [F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in verdicts]
    graded = F.count_if(F.col("verdict") != "error")
    rates = [F.round(100.0 * F.count_if(F.col("verdict") == v) / F.nullif(graded, F.lit(0)), 6).alias(f"pct_{v}") for v in verdicts if v != "error"]
    return records.rollup("kind").agg(F.count("*").alias("n"), *counts, *rates, F.sum("tokens").alias("tokens"), F.grouping("kind").alias("_all")).select(F.when(F.col("_all") == 1, "all").otherwise(F.col("kind")).alias("kind"), "n", *[f"n_{v}" for v in verdicts], *[f"pct_{v}" for v in verdicts if v != "error"], "tokens")


def floor_percentile(value: Column | str, p: float) -> Column:
    """The element at floor(p * (n - 1)) of the sorted values; percentile() would interpolate.

    The values of a group are gathered, so it is for question sets; calls.summary counts values first.
    """
    v = F.col(value) if isinstance(value, str) else value
    ordered = F.sort_array(F.collect_list(v))
    return F.get(ordered, F.floor(F.lit(p) * (F.size(ordered) - 1)).cast("int"))


def reading_cost(rows: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Median, mean and p90 of each measure. One row a question: the groups are question sets."""
    aggs = [a for m in measures for a in (F.round(F.median(m), 6).alias(f"{m}_median"), F.round(F.avg(m), 6).alias(f"{m}_mean"), floor_percentile(m, 0.9).alias(f"{m}_p90"))]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *aggs)


def scopes(questions: DataFrame, docs: DataFrame) -> DataFrame:
    """questions (id, collection, document, version) with scope_slug, the one edition that answers them, and scope_error; both are null where a question names no document.

    A version without a document is an error, never a guess; without a version the current edition answers.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("document", "version")}
    named = text["document"] != ""
    asked = questions.filter(named).select(F.col("id").alias("request"), "collection", F.col("document").alias("doc_id"), "version")
    versioned = text["version"] != ""
    exact = editions.as_of(asked.filter(versioned), docs).select("request", "slug", "how")
    now = editions.resolved(docs).filter("is_current").groupBy("collection", "doc_id").agg(F.min("slug").alias("slug"))
    current = asked.filter(~versioned).join(now, ["collection", "doc_id"], "left").select("request", "slug", F.when(F.col("slug").isNull(), "no edition").alias("how"))
    found = exact.union(current).select(F.col("request").alias("id"), F.col("slug").alias("scope_slug"), "how")
    error = F.coalesce(N.needs_document(text["version"], text["document"]), F.when(named & F.col("scope_slug").isNull(), F.col("how")))
    return questions.join(found, "id", "left").withColumn("scope_error", error).drop("how")


def unanswered(sections: DataFrame, answers: DataFrame) -> DataFrame:
    """sections (collection, slug, file, …) that no answer (collection, slug, file) points at; without a collection an answer stands for all, and without a file (a quote) for none.

    The two kinds of answers are two equality joins, so no section meets all answers.
    """
    own = answers.filter("slug is not null and file is not null").select("collection", "slug", "file")
    left = sections.join(own.filter("collection is not null"), ["collection", "slug", "file"], "left_anti")
    return left.join(own.filter("collection is null").select("slug", "file"), ["slug", "file"], "left_anti").select(*sections.columns)
