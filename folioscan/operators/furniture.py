"""Running headers and footers: the title of a document as a line, "feedback" links, and page labels that differ in their digits.

Lines that merely repeat are content: reference texts reuse whole sentences, and a line that is lost can't be had back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

# Fixed values.
TITLE_TEXTS, TITLE_HEAD, TITLE_SHARE = 3, 40, 0.6
LABEL_SHARE, LABEL_VARIETY, LABEL_TEXTS, LABEL_DISTINCT = 0.25, 0.5, 10, 30
ADJACENT = 3
PROSE_RUN = r"\b[a-z]+\s+[a-z]+\s+[a-z]+\b"
BARE_NUMBER = r"^\s*[0-9]{1,4}\s*$"
CHAPTER_HEADER = r"(?i)^\s*(?:Chapter|Appendix|Section)\s+\w{1,4}\s*:"
# End of fixed values.


def exploded(texts: DataFrame, doc: list[str], text_id: str, text: str = "text") -> DataFrame:
    """(doc, text_id, pos, line, core, in_code) of every line. The fence state is a running sum within the text, so it never leaves the row."""
    own = X.lines(F.coalesce(F.col(text), F.lit("")))
    fences = F.transform(own, lambda x: x.rlike(r"^\s*```"))
    state = F.aggregate(fences, F.struct(F.lit(False).alias("open"), F.array().cast("array<boolean>").alias("code")), lambda a, f: F.struct((a["open"] != f).alias("open"), F.concat(a["code"], F.array(a["open"] | f)).alias("code")), lambda a: a["code"])
    # Only texts with a fence need the state.
    code = F.when(F.exists(fences, lambda f: f), state).otherwise(F.transform(own, lambda x: F.lit(False)))
    flat = texts.select(*doc, text_id, F.posexplode(F.arrays_zip(own.alias("line"), code.alias("in_code"))).alias("pos", "_l"))
    return flat.select(*doc, text_id, "pos", F.col("_l.line").alias("line"), F.col("_l.in_code").alias("in_code")).withColumn("core", X.strip_emphasis("line"))


def candidates(lines: DataFrame, doc: list[str], text_id: str) -> DataFrame:
    """(doc, text_id, core): lines outside code of the shape of a header, once a text."""
    return lines.filter(~F.col("in_code") & X.furniture_candidate("line", "core")).select(*doc, text_id, "core").distinct()


def title_lines(own: DataFrame, titles: DataFrame, doc: list[str], least: int = TITLE_TEXTS) -> DataFrame:
    """(doc, core) of candidates that are the document's title, or most of it, in `least` texts; and of "feedback" in any."""
    spaced = F.translate(X.collapse(F.regexp_replace("core", X.TAG, "")), X.MARKS, "")
    counts = own.groupBy(*doc, "core").agg(F.count("*").alias("_n")).select("*", X.comparable("core").alias("_k"), spaced.alias("_s"))
    met = counts.join(titles.select(*doc, X.comparable("title").alias("_t")), doc, "left")
    norm, spaced, head = F.col("_k"), F.col("_s"), F.left(F.col("_t"), F.lit(TITLE_HEAD))
    begins = norm.startswith(head) & ~F.substring(norm, F.length(head) + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]") & ~F.substring(spaced, F.length(head) + 1, F.length(spaced)).rlike(PROSE_RUN)
    part = F.col("_t").startswith(F.left(norm, F.lit(TITLE_HEAD))) & (F.length(norm) >= TITLE_SHARE * F.length("_t"))
    title = (F.coalesce(F.col("_t"), F.lit("")) != "") & (norm != "") & (begins | part) & (F.col("_n") >= least)
    return met.filter((norm == "feedback") | title).select(*doc, "core")


def page_labels(own: DataFrame, sizes: DataFrame, doc: list[str], text_id: str, share: float = LABEL_SHARE, variety: float = LABEL_VARIETY, texts: int = LABEL_TEXTS, distinct: int = LABEL_DISTINCT) -> DataFrame:
    """(doc, masked, n_texts, n_distinct): labels alike but for their numbers, in enough texts and different enough. sizes: (doc, n_all) texts."""
    shaped = own.filter(X.label_shaped("core")).select(*doc, text_id, "core", X.masked_label("core").alias("masked"))
    carriers = shaped.select(*doc, "masked", text_id).distinct().groupBy(*doc, "masked").agg(F.count("*").alias("n_texts"))
    kinds = shaped.select(*doc, "masked", "core").distinct().groupBy(*doc, "masked").agg(F.count("*").alias("n_distinct"))
    met = carriers.join(kinds, [*doc, "masked"]).join(sizes, doc)
    enough = (F.col("n_texts") >= texts) & (F.col("n_texts") >= share * F.col("n_all")) & (F.col("n_distinct") >= distinct) & (F.col("n_distinct") >= variety * F.col("n_texts"))
    return met.filter(enough).select(*doc, "masked", "n_texts", "n_distinct")


def detected(lines: DataFrame, titles: DataFrame, doc: list[str], text_id: str) -> DataFrame:
    """(doc, core) of all furniture of each document. titles: (doc, title)."""
    own = candidates(lines, doc, text_id)
    sizes = lines.select(*doc, text_id).distinct().groupBy(*doc).agg(F.count("*").alias("n_all"))
    labels = page_labels(own, sizes, doc, text_id).select(*doc, F.col("masked").alias("_m"))
    labelled = own.filter(X.label_shaped("core")).withColumn("_m", X.masked_label("core")).join(labels, [*doc, "_m"], "left_semi").select(*doc, "core")
    return title_lines(own, titles, doc).union(labelled).distinct()


def stripped(lines: DataFrame, furniture: DataFrame, doc: list[str], text_id: str, around: int = ADJACENT) -> DataFrame:
    """Lines that stay: furniture outside code goes, and bare page numbers and chapter headers within so many lines of it."""
    marked = lines.join(furniture.select(*doc, "core").distinct().withColumn("_f", F.lit(1)), [*doc, "core"], "left").withColumn("_f", F.when(~F.col("in_code"), F.col("_f")))
    near = F.max("_f").over(Window.partitionBy(*doc, text_id).orderBy("pos").rowsBetween(-around, around))
    bare = ~F.col("in_code") & (F.col("line").rlike(BARE_NUMBER) | F.col("line").rlike(CHAPTER_HEADER))
    return marked.withColumn("_near", near).filter(F.col("_f").isNull() & ~(bare & F.col("_near").isNotNull())).drop("_f", "_near")
