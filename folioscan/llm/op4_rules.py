"""Operator 4: quality rules and robust multivariate outliers, in DataFrame functions only.

Statistics of every text come from array functions inside its row. Four of them, transformed (word length, shares of
symbols, of capitals and of repeated words and lines), are a vector; for each language and source a minimum-covariance-determinant
estimate is made: from two starts (medians with spreads about them, and means with variances), concentration steps take the closest 3/4 of
the vectors, whose mean and covariance give the distances of the next step, until no group's determinant falls any more; of the two the
smaller determinant wins. Vectors far from their group's estimate are rejected. Cut-off distances are exact
quantiles of binned distances, so groups of any size are aggregated partially before they are shuffled; estimates, one row a
group, are broadcast below a counted size, and beyond it meet their rows in salted parts, so that no group is one task.

The estimate is a regularised one: a fixed floor squared is added to each variance, so that groups where most documents agree to the digit
have a regular covariance. It is part of the rule, and of the determinants that are compared.
Groups of fewer than LEAST_GROUP documents use their language's estimate, and languages of as few the whole table's.

Defined results: null and empty texts have zero statistics and fail; null languages and sources count as the empty string; rows
that repeat a doc_id are judged each, by their own text; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import stage, table

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \\t\\n\\u000B\\u000C\\r"  # SQL literals have no escape for a form feed
SHARE = 0.75
#: Most concentration steps: determinants fall with each, and stop falling after a few; a guard, as rounding might keep them moving.
STEPS = 12
LEAST_GROUP = 50
#: Groups whose estimates are broadcast (some 300 bytes each), and the parts of a group's rows where there are more.
BROADCAST_GROUPS, SALTS = 100_000, 32
#: Least spread of a dimension.
FLOOR = (0.15, 0.6, 0.6, 0.8)
#: Squared Mahalanobis distance beyond which a vector is rejected (chi-square, four dimensions: 1 of 100,000 is over 28.5).
CUTOFF = 28.5
#: Chi-square consistency of the covariance of the closest 3/4 in four dimensions.
CONSISTENT = 0.75 / 0.5046
#: A fall of a determinant's logarithm that asks for another step.
SETTLED = 0.01
#: Bins a unit of a value and of a squared distance; beyond the last of these, bins grow with the distance, so that their number is bounded.
VALUE_BINS, DISTANCE_BINS, LAST = 64, 16, 100_000
DIMS = range(4)

#: Words in 5-word windows that are in the text twice or more. Only texts with an equal pair of hashes sort their windows;
#: each array is bound by a lambda, so it is made once.
_REPEATED = """
element_at(transform(array(transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))), h ->
  CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
  element_at(transform(array(sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i)))), s ->
    element_at(transform(array(sort_array(transform(filter(s, (e, j) -> coalesce(get(s, j - 1).x = e.x, false) OR coalesce(get(s, j + 1).x = e.x, false)), e -> e.i))), p ->
      aggregate(transform(p, (a, j) -> cast(least(5, coalesce(get(p, j + 1) - a, 5)) AS bigint)), 0L, (x, y) -> x + y)), 1)), 1) END), 1)
"""
_WORDS = f"""
element_at(transform(array(CASE WHEN t = '' THEN cast(array() AS array<string>) ELSE split(t, '[\\\\x20\\\\x09-\\\\x0D]+') END), w -> named_struct(
  'n', cast(size(w) AS bigint),
  'chars', cast(char_length(array_join(w, '')) AS bigint),
  'repeated', CASE WHEN size(w) < 5 THEN 0L ELSE {_REPEATED} END)), 1)
"""
_LINES = """
element_at(transform(array(filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')), l -> cast(size(l) - size(array_distinct(l)) AS bigint)), 1)
"""


def _digest() -> Column:
    """Of all that a verdict depends on."""
    return F.md5(F.concat_ws("\n", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")]))


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, lang, source, n_words, word_chars, n_symbols, n_upper, n_dup_lines, n_repeat_words) of every text."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("t", F.expr(f"trim(BOTH '{BLANKS}' FROM text)"))
    size = F.char_length("text")
    return own.select(
        "doc_id", "digest", "lang", "source", F.expr(_WORDS).alias("words"), F.expr(_LINES).alias("n_dup_lines"),
        (size - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (size - F.char_length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
    ).select("doc_id", "digest", "lang", "source", F.col("words.n").alias("n_words"), F.col("words.chars").alias("word_chars"), "n_symbols", "n_upper", "n_dup_lines", F.col("words.repeated").alias("n_repeat_words"))


def vectors(stats: DataFrame) -> DataFrame:
    """With base_failed and the transformed vector x0..x3, rounded so that quantiles can be counted."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    own = (
        F.log(chars / words),
        F.log1p(100 * F.col("n_symbols") / words),
        F.log1p(100 * F.col("n_upper") / chars),
        F.log1p(100 * F.col("n_repeat_words") / words + F.col("n_dup_lines")),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select("*", failed.alias("base_failed"), *[F.round(x, 6).alias(f"x{i}") for i, x in enumerate(own)])


def _meet(rows: DataFrame, few: DataFrame, n: int, by: list[str]) -> DataFrame:
    """rows with the one row of each group, n rows in all."""
    if n <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(few), by)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    return rows.withColumn("_salt", salt).join(few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [*by, "_salt"]).drop("_salt")


def grouped(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """With g: the language and source, or the language, or everything, whichever is large enough."""
    pairs = stage(spark, rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "groups")
    langs = pairs.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    group = F.when(F.col("n") >= LEAST_GROUP, F.concat(F.lit("2"), F.to_json(F.struct("lang", "source")))).when(F.col("n_lang") >= LEAST_GROUP, F.concat(F.lit("1"), F.col("lang"))).otherwise(F.lit("0"))
    return _meet(rows, pairs.join(langs, "lang").select("lang", "source", group.alias("g")), pairs.count(), ["lang", "source"])


def _bin(x: Column, per: int) -> Column:
    """Whole numbers for quantiles: rounded parts of a unit, then logarithmic."""
    near = F.round(x * per)
    return F.when(near <= LAST, near).otherwise(LAST + F.floor(F.log(F.greatest(near, F.lit(LAST)) / LAST) * per)).cast("int")


def _start(rows: DataFrame, n: int) -> DataFrame:
    """Two starts of each group, with diagonal factors: medians and spreads about them, means and standard deviations."""
    middle = rows.groupBy("g").agg(*[(F.percentile(_bin(F.col(f"x{i}"), VALUE_BINS), F.lit(0.5)) / VALUE_BINS).alias(f"m{i}") for i in DIMS])
    spread = _meet(rows, middle, n, ["g"]).groupBy("g").agg(*[(1.4826 * F.percentile(_bin(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), VALUE_BINS), F.lit(0.5)) / VALUE_BINS).alias(f"s{i}") for i in DIMS])
    robust = middle.join(spread, "g").withColumn("start", F.lit(0))
    plain = rows.groupBy("g").agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in DIMS], *[F.coalesce(F.stddev_pop(f"x{i}"), F.lit(0.0)).alias(f"s{i}") for i in DIMS]).withColumn("start", F.lit(1))
    both, zero = robust.unionByName(plain), F.lit(0.0)
    return both.select("g", "start", *[f"m{i}" for i in DIMS], *[(F.greatest(F.col(f"s{i}"), F.lit(FLOOR[i])) if i == j else zero).alias(f"l{i}{j}") for i in DIMS for j in range(i + 1)], F.lit(float("inf")).alias("log_det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of x to m, by forward substitution through the Cholesky factor l."""
    y: list[Column] = []
    for i in DIMS:
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _factor(moments: DataFrame) -> DataFrame:
    """Mean, Cholesky factor of the covariance, column by column, and the logarithm of its determinant."""
    own = moments
    for i in DIMS:
        for j in range(i + 1):
            cell = CONSISTENT * (F.col(f"c{j}{i}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
            if i == j:
                cell = cell + FLOOR[i] ** 2
            for k in range(j):
                cell = cell - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            own = own.withColumn(f"l{i}{j}", F.sqrt(F.greatest(cell, F.lit(1e-6))) if i == j else cell / F.col(f"l{j}{j}"))
    log_det = sum((2 * F.log(f"l{i}{i}") for i in DIMS[1:]), 2 * F.log("l00"))
    return own.select("g", "start", *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i in DIMS for j in range(i + 1)], log_det.alias("log_det"))


def estimates(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Mean and factor of each group's minimum-covariance-determinant estimate; one row a group."""
    rows = rows.select("g", *[f"x{i}" for i in DIMS])
    n = rows.select("g").distinct().count()
    now = stage(spark, _start(rows, n), "mcd", light=True)
    for _ in range(STEPS):
        # Both starts of a group are one row, so rows meet their group once.
        factors = now.groupBy("g").agg(F.collect_list(F.struct("start", *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i in DIMS for j in range(i + 1)])).alias("s"))
        far = _meet(rows, factors, n, ["g"]).select("g", *[f"x{i}" for i in DIMS], F.inline("s")).select("g", "start", *[f"x{i}" for i in DIMS], _bin(_distance(), DISTANCE_BINS).alias("d"))
        cut = far.groupBy("g", "start").agg(F.percentile("d", F.lit(SHARE)).alias("cut"))
        near = _meet(far, cut, 2 * n, ["g", "start"]).filter("d <= cut")
        moments = near.groupBy("g", "start").agg(F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in DIMS], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i in DIMS for j in DIMS if i <= j])
        state = [f"m{i}" for i in DIMS] + [f"l{i}{j}" for i in DIMS for j in range(i + 1)] + ["log_det"]
        new = _factor(moments).join(now.select("g", "start", F.struct(*state).alias("was")), ["g", "start"])
        # A start that has settled stays as it is: binned cut-offs could make it go round in circles.
        falls = F.col("log_det") < F.col("was.log_det") - SETTLED
        now = stage(spark, new.select("g", "start", *[F.when(falls, F.col(c)).otherwise(F.col(f"was.{c}")).alias(c) for c in state], falls.alias("falls")), "mcd", light=True)
        if now.filter("falls").isEmpty():
            break
        now = now.drop("falls")
    best = now.groupBy("g").agg(F.min(F.struct(F.round("log_det", 6).alias("log_det"), "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    return now.join(best, ["g", "start"]).select("g", *[f"m{i}" for i in DIMS], *[f"l{i}{j}" for i in DIMS for j in range(i + 1)])


def judged(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Statistics, base_failed, distance and kept of every document, and the digest of what was judged."""
    rows = stage(spark, vectors(statistics(docs)), "statistics")
    rows = stage(spark, grouped(spark, rows), "statistics")
    few = stage(spark, estimates(spark, rows), "mcd", light=True)
    found = _meet(rows, few, few.count(), ["g"]).withColumn("distance", F.round(_distance(), 6))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("distance") <= CUTOFF)).alias("kept"), "distance", "n_upper", "digest")


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns. Rows that repeat a doc_id are told apart by what was judged."""
    good = judged(spark, docs).filter("kept").select(F.struct("doc_id", "digest").alias("k")).distinct()
    # Columns of docs live in a struct meanwhile, so that no name can clash.
    own = docs.select(F.struct("*").alias("row"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("digest")).alias("k"))
    return own.join(good.hint("shuffle_hash"), own.k.eqNullSafe(good.k), "left_semi").select("row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, table(spark, sf_dir, "documents")).drop("digest")
