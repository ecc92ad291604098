"""Entries of references: roll-up, exact lookup, reassembly, budgets; logs explained by their codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.functions.udfs import close_ratio

# Characters of an entry, of an entry in a log report, entries of one report, listed names.
ENTRY_CHARS, LOG_CHARS, LOG_ENTRIES, LISTED = 40_000, 2_500, 25, 300
SEVERITIES = {"fatal": 0, "error": 1, "warning": 2, "information": 3}
CLOSE = {"entity": (0.7, 8), "command": (0.75, 3), "option": (0.6, 3)}
# End of fixed values.


def entities(chunks: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, name, name_lower, chunk_count, page_start, page_end) of every entry."""
    own = chunks.filter(F.col("entity").isNotNull()).groupBy(*doc, "entity")
    return own.agg(F.count("*").alias("chunk_count"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end")).select(*doc, F.col("entity").alias("name"), F.lower("entity").alias("name_lower"), "chunk_count", "page_start", "page_end")


def lookup(asked: DataFrame, entities_: DataFrame, doc: list[str]) -> DataFrame:
    """asked (qid, name) with every entry that has one of its spellings; none: nulls. entities_: as entities() makes them, a row an entry.

    An entry has one spelling, so it meets a question's distinct ones once: the spellings are made distinct, not all that is met.
    """
    keys = asked.select("qid", F.explode(X.entity_keys("name")).alias("name_lower")).distinct()
    hit = keys.join(entities_.withColumnRenamed("name", "entity"), "name_lower").select("qid", *doc, "entity", "chunk_count", "page_start", "page_end")
    return asked.join(hit, "qid", "left")


def reassembled(chunks: DataFrame, by: list[str], ord_: str = "ord", body: str = "body", most: int = ENTRY_CHARS) -> DataFrame:
    """(by, text, n_chars, cut): bodies in order, one line feed between, cut at `most` characters.

    Only pieces that begin inside the budget are gathered, so a group of any size stays small.
    """
    w = Window.partitionBy(*by).orderBy(ord_).rowsBetween(Window.unboundedPreceding, -1)
    sized = chunks.withColumn("_before", F.coalesce(F.sum(F.length(body) + 1).over(w), F.lit(0)))
    total = chunks.groupBy(*by).agg((F.sum(F.length(body) + 1) - 1).alias("n_chars"))
    near = sized.filter(F.col("_before") < most).groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ord_, body))), lambda x: x[body]), "\n").alias("_t"))
    return near.join(total, by).select(*by, F.left("_t", F.lit(most)).alias("text"), "n_chars", (F.col("n_chars") > most).alias("cut"))


def budgeted(rows: DataFrame, by: list[str], order: list[str], text: str, budget: int, most: int = LISTED) -> DataFrame:
    """The first rows of each group, as many as fit the budget of characters and the number."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most).withColumn("used", F.sum(F.length(text)).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("used") <= budget)


def severity(line: Column | str) -> Column:
    word = F.lower(F.regexp_extract(line, r"(?i)\b(fatal|error|warning|info(?:rmation)?)\b", 1))
    return F.when(word == "fatal", 0).when(word == "error", 1).when(word == "warning", 2).when(word.startswith("info"), 3).otherwise(4)


def scan_log(lines: DataFrame, by: list[str], pos: str = "pos", line: str = "line") -> DataFrame:
    """(by, kind, code, n_lines, first_pos, sample, severity): message codes and rules of log lines, the worst and most frequent first by order of columns severity, n_lines, first_pos."""
    codes = F.array_distinct(F.regexp_extract_all(F.col(line), F.lit(r"(?<![\w-])([A-Z][A-Z0-9]{1,9}-\d{2,5})(?![\w-])"), F.lit(1)))
    rules = F.array_distinct(F.regexp_extract_all(F.col(line), F.lit(r"\b(?:DRC\s+)?[Rr]ule\s+([A-Z]{1,3}\d{1,4})\b"), F.lit(1)))
    items = F.concat(F.transform(codes, lambda c: F.struct(F.lit("code").alias("kind"), c.alias("code"))), F.transform(rules, lambda c: F.struct(F.lit("rule").alias("kind"), c.alias("code"))))
    flat = lines.select(*by, pos, F.left(F.col(line), F.lit(200)).alias("_sample"), severity(line).alias("_sev"), F.inline(items))
    return flat.groupBy(*by, "kind", "code").agg(F.count("*").alias("n_lines"), F.min(pos).alias("first_pos"), F.min_by("_sample", pos).alias("sample"), F.min("_sev").alias("severity"))


def explained(items: DataFrame, entries: DataFrame, by: list[str], most: int = LOG_ENTRIES, chars: int = LOG_CHARS) -> DataFrame:
    """The first `most` items of each log with the text of the entry (name_lower, text) of their code; missing where there is none."""
    w = Window.partitionBy(*by).orderBy("severity", F.desc("n_lines"), "first_pos", "code")
    top = items.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most)
    keys = top.select(*by, "n", F.explode(X.entity_keys("code")).alias("name_lower"))
    met = keys.join(entries, "name_lower").groupBy(*by, "n").agg(F.min(F.left("text", F.lit(chars))).alias("text"))
    return top.join(met, [*by, "n"], "left").withColumn("missing", F.col("text").isNull())


def suggestions(asked: DataFrame, names: DataFrame, kind: str = "entity", prefix_most: int = 25) -> DataFrame:
    """asked (qid, name) with names (name_lower) like it: by prefix, else close matches among all names, best first; none: an empty list.

    Distinct asked names meet all distinct names of a length that can reach the ratio; only those that reach it are ranked.
    """
    cutoff, most = CLOSE[kind]
    own = names.select("name_lower").filter("name_lower is not null").distinct()
    words = asked.select(F.lower("name").alias("_q")).filter("_q is not null").distinct()
    short, both = F.least(F.length("_q"), F.length("name_lower")), F.length("_q") + F.length("name_lower")
    starts = F.col("name_lower").startswith(F.col("_q"))
    # A ratio is at most twice the shorter length over both.
    met = words.crossJoin(own).filter(starts | (2 * short >= cutoff * both - 1e-9)).withColumn("_p", starts).withColumn("_r", close_ratio(cutoff)("_q", "name_lower"))
    by_prefix = met.filter("_p").withColumn("_n", F.row_number().over(Window.partitionBy("_q").orderBy("name_lower"))).filter(F.col("_n") <= prefix_most)
    close = met.filter("_r is not null").withColumn("_n", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("_r"), F.desc("name_lower")))).filter(F.col("_n") <= most)
    # At most prefix_most + most names of each asked name are gathered.
    rows = by_prefix.select("_q", "_p", "_n", "name_lower").union(close.select("_q", F.lit(False).alias("_p"), "_n", "name_lower"))
    listed = lambda p: F.transform(F.sort_array(F.collect_list(F.when(F.col("_p") == p, F.struct("_n", "name_lower")))), lambda x: x.name_lower)
    out = rows.groupBy("_q").agg(listed(True).alias("_a"), listed(False).alias("_b")).select("_q", F.when(F.size("_a") > 0, F.col("_a")).otherwise(F.col("_b")).alias("suggested"))
    joined = asked.withColumn("_q", F.lower("name")).join(out, "_q", "left")
    return joined.select(*asked.columns, F.when(F.col("_q").isNotNull(), F.coalesce("suggested", F.array().cast("array<string>"))).alias("suggested"))
