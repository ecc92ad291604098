"""Column expressions over names, versions, captions and replies: what is shown, asked for or read off a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# Captions and sentences that cite one, the words beside a running title, verdicts, sizes of probes.
CAPTION = r"(?i)^\s*(figure|fig\.)\s*[A-Z]?[\d.-]*\d"
SENTENCE = r"^\s*(?i:figure|fig\.)\s*[A-Z]?[\d.-]*\d\s+[a-z]"
LABEL_ONLY = r"(?i)^\s*(figure|fig\.)\s*[A-Z]?[\d.-]*\d[.:]?\s*$"
CAPTION_CHARS = 200
BESIDE_TITLE = r"(?:software|version|release|page|v?\d+|[a-z])"
VERDICTS = ("correct", "partial", "wrong")
PROBE, STEP, REACH = 40, 20, 600
PARTS_ALIKE = 4
# End of fixed values.


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamped(value: Column | str, default: int, low: int, high: int) -> Column:
    """A whole number within bounds; what is none is the default."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.trim(_c(value).cast("string")).try_cast("int"), F.lit(default))))


def ends_in_path(file: Column | str, asked: Column | str) -> Column:
    """Whether a file is the path asked for, or ends in it after a slash; percent signs and underscores are ordinary characters."""
    own = F.regexp_replace(F.regexp_replace(F.regexp_replace(_c(asked), r"\\", "/"), "^/+", ""), r"^\./", "")
    return (_c(file) == own) | _c(file).endswith(F.concat(F.lit("/"), own))


def needs_document(version: Column | str, document: Column | str) -> Column:
    """The error of a version without a document; null where there is none."""
    return F.when((F.coalesce(_c(version), F.lit("")) != "") & (F.coalesce(_c(document), F.lit("")) == ""), "`version` needs `document`: a release means nothing without a manual.")


def edition_name(version: Column | str, later: Column | str, slug: Column | str) -> Column:
    v = _c(version)
    return F.when(F.coalesce(v, F.lit("")) == "", _c(slug)).when(F.coalesce(_c(later), F.lit(False)), F.concat(v, F.lit(" and later"))).otherwise(v)


def pages(start: Column | str, end: Column | str) -> Column:
    """p. 3 or pp. 3–5; null without pages."""
    s, e = _c(start), _c(end)
    return F.when(e.isNull() | (e == s), F.concat(F.lit("p. "), s.cast("string"))).otherwise(F.concat(F.lit("pp. "), s.cast("string"), F.lit("–"), e.cast("string")))


def citation(label: Column | str, breadcrumb: Column | str, start: Column | str, end: Column | str, entity: Column | str) -> Column:
    """Where a section is from: document, breadcrumb, pages and entry, as far as known."""
    crumb = F.nullif(F.trim(F.regexp_replace(F.trim(_c(breadcrumb)), r"^\*+|\*+$", "")), F.lit(""))
    own = F.nullif(_c(entity), F.lit(""))
    return F.concat_ws(" · ", _c(label), crumb, pages(start, end), F.concat(F.lit("`"), own, F.lit("`")))


def coverage_note(all_sections: Column, indexed: Column, stale: Column) -> Column:
    """What answers must say where the index is partial or older than its sources; empty where it is neither."""
    part = F.when(indexed < all_sections, F.concat(F.lit("\n\nThe index holds "), indexed.cast("string"), F.lit(" of "), all_sections.cast("string"), F.lit(" sections.")))
    return F.concat(F.coalesce(part, F.lit("")), F.when(stale, F.lit("\n\nThe index is older than its sources.")).otherwise(""))


def figure_text(caption: Column | str, labels: Column | str, ocr: Column | str, description: Column | str) -> Column:
    """All words of a figure that a search can find it by."""
    return F.concat_ws(" ", *[F.nullif(F.trim(_c(c)), F.lit("")) for c in (caption, labels, ocr, description)])


def is_caption(line: Column | str) -> Column:
    """A line that numbers a figure, and doesn't go on as a sentence about it."""
    return _c(line).rlike(CAPTION) & ~_c(line).rlike(SENTENCE)


def caption_text(lines: Column | str, of_caption_box: Column | None = None) -> Column:
    """The caption of a box's lines: all of a caption box, else the first, with the second where the first is the bare label."""
    own = _c(lines)
    two = F.when(F.get(own, F.lit(0)).rlike(LABEL_ONLY) & (F.size(own) > 1), F.concat_ws(" ", F.get(own, F.lit(0)), F.get(own, F.lit(1)))).otherwise(F.get(own, F.lit(0)))
    text = two if of_caption_box is None else F.when(of_caption_box, F.array_join(own, " ")).otherwise(two)
    return F.left(F.trim(X.collapse(text)), F.lit(CAPTION_CHARS))


def caption_key(text: Column | str) -> Column:
    """A caption as its words, whatever marks stand around them."""
    return F.array_join(X.ascii_words(F.regexp_replace(_c(text), "<[^>]*>", " ")), " ")


def same_caption(a: Column | str, b: Column | str) -> Column:
    """Equal keys, or one with four words or more that the other begins with."""
    x, y = _c(a), _c(b)
    short, long = F.when(F.length(x) <= F.length(y), x).otherwise(y), F.when(F.length(x) <= F.length(y), y).otherwise(x)
    return (x == y) | ((F.size(F.split(short, " ")) >= PARTS_ALIKE) & long.startswith(F.concat(short, F.lit(" "))))


def title_core(words: Column | str) -> Column:
    """A line's words without versions and page numbers at either end."""
    return F.regexp_replace(F.trim(X.collapse(words)), rf"^(?:{BESIDE_TITLE}(?: |$))+|(?:(?:^| ){BESIDE_TITLE})+$", "")


def implausible_title(title: Column | str) -> Column:
    """Why a text is no title; null where it may be one."""
    t = _c(title)
    return F.when(F.length(F.regexp_replace(t, r"[^\p{L}]", "")) < 3, "has fewer than three letters").when(F.length(t) > 200, "is too long to be a title")


def boilerplate(heading: Column | str) -> Column:
    """Legal and support headings, of which no questions are made."""
    return F.lower(_c(heading)).rlike(r"copyright|trademark|legal notice|disclaimer|licen[cs]e|third.party|end.user|support|feedback|warranty|proprietary")


def verdict(reply: Column | str, verdicts: tuple[str, ...] = VERDICTS) -> Column:
    """(verdict, reason) of a grader's reply: a JSON object anywhere in it, else the word itself after its name; never guessed."""
    raw = F.coalesce(_c(reply), F.lit(""))
    obj = F.from_json(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), "verdict string, reason string")
    own = F.lower(F.trim(obj["verdict"]))
    word = F.lower(F.regexp_extract(raw, rf"(?i)verdict\W{{1,5}}({'|'.join(verdicts)})\b", 1))
    return F.when(own.isin(*verdicts), F.struct(own.alias("verdict"), F.trim(F.coalesce(obj["reason"], F.lit(""))).alias("reason"))).when(word != "", F.struct(word.alias("verdict"), F.lit("").alias("reason"))).otherwise(F.struct(F.lit(None).cast("string").alias("verdict"), F.concat(F.lit("no verdict: "), F.left(raw, F.lit(200))).alias("reason")))


def probes(text: Column | str, from_end: bool = False) -> Column:
    """(offset, probe): pieces of 40 characters, one every 20, within 600 of the start or the end; shorter texts are one piece."""
    t = _c(text)
    n = F.length(t)
    size = F.least(F.lit(PROBE), n)
    last = F.greatest(F.least(F.lit(REACH), n - size), F.lit(0))
    at = F.sequence(F.lit(0), F.floor(last / STEP).cast("int"))
    start = (lambda o: n - o - size) if from_end else (lambda o: o)
    return F.transform(at, lambda k: F.struct((k * STEP).alias("offset"), F.substring(t, start(k * STEP) + 1, size).alias("probe")))


def call_time(t: Column | str) -> Column:
    """A moment as UTC text with milliseconds."""
    return F.date_format(F.to_utc_timestamp(_c(t), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def anchoring_band(density: Column) -> Column:
    return F.when(density < 0.5, "low").when(density < 1.0, "moderate").otherwise("high")


def fallback_band(shared: Column) -> Column:
    return F.when(shared < 0.10, "strong").when(shared < 0.40, "good").otherwise("weak")


def release_of(version: Column | str) -> Column:
    """(version, later) as typed: "2023.1+" and "2023.1 and later" claim what follows too."""
    v = F.trim(F.coalesce(_c(version), F.lit("")))
    bare = F.regexp_extract(v, r"(?i)^(.+?)\s*(?:\+|\band\s+later)$", 1)
    return F.when(bare != "", F.struct(F.trim(bare).alias("version"), F.lit(True).alias("later"))).otherwise(F.struct(F.nullif(v, F.lit("")).alias("version"), F.lit(False).alias("later")))


def filename_agrees(named: Column | str, shown: Column | str, named_key: Column | str | None = None, shown_key: Column | str | None = None) -> Column:
    """Whether a file name's release is the cover's, or says only more or less of it: one's dotted numbers begin the other's, and no two service packs differ.

    Keys that are columns already need not be made again.
    """
    a, b = (X.version_key(v) if k is None else _c(k) for v, k in ((named, named_key), (shown, shown_key)))
    cut = lambda k: F.array_position(k, F.lit(-1).cast("long")).cast("int")
    dotted = lambda k: F.slice(k, F.lit(1), F.greatest(cut(k) - 1, F.lit(0)))
    pack = lambda v: F.regexp_extract(X.norm_version(v), r"SP([0-9]+(?:-[0-9]+)?)", 1)
    n = F.least(F.size(dotted(a)), F.size(dotted(b)))
    begins = (n > 0) & (F.slice(dotted(a), F.lit(1), n) == F.slice(dotted(b), F.lit(1), n)) & ((pack(named) == pack(shown)) | (pack(named) == "") | (pack(shown) == ""))
    same = F.when(a.isNull() | b.isNull(), (X.norm_version(named) != "") & (X.norm_version(named) == X.norm_version(shown))).otherwise(a == b)
    return same | F.coalesce(begins, F.lit(False))
