"""Column expressions over text: words, lines, headings, identifiers, version keys. All stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them.
STOPWORDS = """
a an the and or of to in on for with from by at as is are was were be been being
do does did how what when where which who why can could should would will shall
my our your it its this that these those there here if then than else i you we
me us them he she they him her his hers their please tell show explain use using
about into over under between within any all some no not
""".split()
MESSAGE_CODE = r"[A-Z][A-Z0-9]{1,9}-\d{2,5}"
RULE_ID = r"^(?:(?:drc\s+)?rule\s+)?([a-z]{1,3}\d{1,4})$"
FRONT_MATTER = r"^(?:contents|table of contents|index|feedback|list of (?:figures|tables))(?: \((?:cont\.|intro)\))*$"
DOT_LEADER = r"\.\s?\.\s?\.\s?\."
OPEN_PUNCTUATION = "`'\"()[]{}<>,;:?!"
CRUMB = " › "
MARKS = "™℠®©"
TAG = r"</?[A-Za-z][^>]*>"
# End of fixed values.

WORD = r"[\p{L}\p{N}]+"
SPACES = r"[ \t\n\x0B\f\r]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def words(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD), F.lit(0))


def ascii_words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit("[0-9a-z]+"), F.lit(0))


def lines(text: Column | str) -> Column:
    """Parts between line feeds; other separators are ordinary characters."""
    return F.split(_c(text), "\n")


def collapse(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(text), SPACES, " "))


def slug(text: Column | str, longest: int = 80, default: str = "") -> Column:
    out = F.left(F.regexp_replace(F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(longest))
    out = F.regexp_replace(out, "-+$", "")
    return F.when(out == "", F.lit(default)).otherwise(out)


def mask_digits(text: Column | str) -> Column:
    return F.regexp_replace(_c(text), r"[0-9]+", "#")


def clean_heading(text: Column | str) -> Column:
    """Without marks of emphasis around it, three deep; never empty."""
    out = F.trim(_c(text))
    for _ in range(3):
        out = F.trim(F.regexp_replace(out, r"^(\*{1,3}|_{1,3}|`)(.*[^ ].*)\1$", "$2"))
    return out


def strip_emphasis(line: Column | str) -> Column:
    return clean_heading(F.regexp_replace(F.trim(_c(line)), r"^#{1,6}\s+", ""))


def comparable(line: Column | str) -> Column:
    """A line as a reader sees it: no tags, trademark signs, emphasis or apostrophes; folded."""
    bare = F.translate(F.regexp_replace(strip_emphasis(line), TAG, ""), MARKS, "")
    return F.lower(F.trim(collapse(F.regexp_replace(strip_emphasis(bare), r"\s*[’']\s*", ""))))


def label_shaped(core: Column | str) -> Column:
    """Whether a line is plain words and numbers, as a page label is: two words and a number at least, no identifier, option or bracket."""
    t = F.filter(F.split(F.translate(F.regexp_replace(_c(core), TAG, " "), MARKS, ""), SPACES), lambda x: x != "")
    digit = r"[0-9]"
    fine = F.forall(t, lambda x: ~x.contains("_") & (~x.rlike(r"^[-<\[({`]") | x.rlike(r"^-?[0-9][0-9.\-]*$")) & (~x.rlike(digit) | x.rlike(r"^(?:[A-Za-z]-|[vV])?[0-9.,\-/:]+$")))
    return F.coalesce((F.size(F.regexp_extract_all(F.array_join(t, " "), F.lit("[A-Za-z]{2,}"), F.lit(0))) >= 2) & F.exists(t, lambda x: x.rlike(digit)) & fine, F.lit(False))


def masked_label(core: Column | str) -> Column:
    """A label with its numbers masked; the letter of an appendix's page counts as a number."""
    return mask_digits(F.regexp_replace(_c(core), r"(?<![A-Za-z0-9])[A-Z]-(?=[0-9])", "0-"))


def line_core(line: Column | str) -> Column:
    """What a line says: link texts without targets, no tags, marks or doubled blanks."""
    out = F.regexp_replace(_c(line), r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    out = F.regexp_replace(F.regexp_replace(out, r"</?[A-Za-z][^>]*>", " "), r"^\s*#{1,6}\s+", "")
    return collapse(F.regexp_replace(out, r"[*`]+", ""))


def title_key(title: Column | str) -> Column:
    """A title for comparison: no emphasis, no chapter number, folded."""
    out = F.lower(collapse(clean_heading(title)))
    return F.regexp_replace(out, r"^(?:chapter|appendix|part)\s+[0-9a-z]+[.:]?\s+|^[0-9]+(?:\.[0-9]+)*[.:]?\s+", "")


def norm_title(title: Column | str) -> Column:
    """A title for matching headings with outline entries: no emphasis, no "Chapter N", no numbering; folded."""
    bare = F.trim(collapse(strip_emphasis(title)))
    bare = F.regexp_replace(bare, r"(?i)^(chapter|appendix|part)\s+[\w.]{1,4}\s*[:.\-–]?\s+", "")
    return F.lower(F.regexp_replace(bare, r"^\d+(\.\d+)*\.?\s*", ""))


def content_words(text: Column | str) -> Column:
    """Distinct words of four characters or more that aren't numbers."""
    return F.array_distinct(F.filter(ascii_words(text), lambda w: (F.length(w) >= 4) & ~w.rlike("^[0-9]+$")))


def light_stem(word: Column | str) -> Column:
    """The first of ing, ed, es, s that leaves three characters goes."""
    w, out = _c(word), None
    for suffix in ("ing", "ed", "es", "s"):
        hit = w.endswith(suffix) & (F.length(w) - len(suffix) >= 3)
        cut = F.substring(w, F.lit(1), F.length(w) - len(suffix))
        out = F.when(hit, cut) if out is None else out.when(hit, cut)
    return out.otherwise(w)


def _bare(token: Column) -> Column:
    klass = "".join("\\" + c for c in OPEN_PUNCTUATION)
    return F.regexp_replace(F.regexp_replace(token, f"^[{klass}]+|[{klass}]+$", ""), r"\.+$", "")


def identifiers(text: Column | str) -> Column:
    """Lower-case tokens that hold an underscore, begin with a dash, or are message codes."""
    bare = F.transform(F.split(F.coalesce(_c(text), F.lit("")), SPACES), _bare)
    return F.transform(F.filter(bare, lambda t: (t != "") & (t.contains("_") | (t.startswith("-") & (F.length(t) > 1)) | t.rlike(f"^{MESSAGE_CODE}$"))), F.lower)


def named_identifiers(query: Column | str) -> Column:
    """As identifiers(), and words in back-ticks: what a query names outright."""
    raw = F.split(F.coalesce(_c(query), F.lit("")), SPACES)
    ticked = F.transform(F.filter(raw, lambda t: t.rlike(r"^`.*`[.,;:?!]*$")), lambda t: F.lower(_bare(t)))
    return F.array_distinct(F.concat(identifiers(query), F.filter(ticked, lambda t: t != "")))


def query_tokens(query: Column | str) -> Column:
    """Words of a query between blanks, without punctuation around them, lower case, in order."""
    return F.filter(F.transform(F.split(F.coalesce(_c(query), F.lit("")), SPACES), lambda t: F.lower(_bare(t))), lambda t: t != "")


def match_terms(query: Column | str) -> Column:
    """Alphanumeric words of a query; stop words go if others are left."""
    own = F.regexp_extract_all(F.lower(_c(query)), F.lit("[0-9a-z]+"), F.lit(0))
    content = F.filter(own, lambda w: ~w.isin(STOPWORDS))
    return F.array_distinct(F.when(F.size(content) > 0, content).otherwise(own))


def is_noise(heading: Column | str, body: Column | str) -> Column:
    """Front matter: by its whole heading, or by three lines in ten with dot leaders."""
    h = F.lower(collapse(heading))
    full = F.filter(lines(body), lambda x: F.trim(x) != "")
    led = F.size(F.filter(full, lambda x: x.rlike(DOT_LEADER)))
    return F.coalesce(h.rlike(FRONT_MATTER) | h.startswith("about this") | ((F.size(full) >= 4) & (10 * led >= 3 * F.size(full))), F.lit(False))


def norm_version(version: Column | str) -> Column:
    v = F.regexp_replace(F.upper(F.regexp_replace(F.coalesce(_c(version), F.lit("")), r"\s+", "")), "_", ".")
    return F.regexp_replace(v, r"^V([0-9])", "$1")


def version_key(version: Column | str) -> Column:
    """Numbers to order releases by: with a year, its dotted parts, -1 and service pack; else all numbers; none: null."""
    v = norm_version(version)
    year, release, more = (F.regexp_extract(v, r"(20[0-9]{2})\.([0-9]{1,2})((?:\.[0-9]+)*)", i) for i in (1, 2, 3))
    pack, sub = (F.coalesce(_number(F.regexp_extract(v, r"SP([0-9]+)(?:-([0-9]+))?", i)), F.lit(0)) for i in (1, 2))
    further = F.transform(F.filter(F.split(more, r"\."), lambda x: x != ""), _number)
    numbers = F.transform(F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0)), _number)
    return F.when(year != "", F.concat(F.array(_number(year), _number(release)), further, F.array(F.lit(-1).cast("long"), pack, sub))).when(F.size(numbers) > 0, numbers)


def _number(digits: Column) -> Column:
    """A number; null for none, and for one of over 18 digits the largest there is."""
    return F.when(F.length(digits) > 18, F.lit((1 << 63) - 1)).otherwise(digits.try_cast("long"))


def version_text(version: Column | str) -> Column:
    """The numbers as text that sorts as they do."""
    pad = lambda n: F.when(n < 0, F.concat(F.lit("-"), F.lpad((-n).cast("string"), 5, "0"))).otherwise(F.lpad(n.cast("string"), 6, "0"))
    return F.array_join(F.transform(version_key(version), pad), ".")


def filename_version(name: Column | str) -> Column:
    """The release in the name of a file: a letter with year and release, or a year with what is dotted, dashed or underscored behind it."""
    stem = F.regexp_replace(F.regexp_extract(_c(name), r"([^/\\\\]*)$", 1), r"\.[A-Za-z0-9]{1,5}$", "")
    lettered = F.upper(F.regexp_extract(stem, r"(?i)(?:^|[^A-Za-z0-9])([A-Z]-20[0-9]{2}\.[0-9]{2}(?:-SP[0-9]+(?:-[0-9]+)?)?)", 1))
    pattern = r"(?i)(?:^|[^0-9])(20[0-9]{2})[._-]([0-9]{1,2})((?:[._-][0-9]+)*)(-?SP[0-9]+(?:-[0-9]+)?)?(?:[^0-9]|$)"
    year, release, more, pack = (F.regexp_extract(stem, pattern, i) for i in (1, 2, 3, 4))
    further = F.array_join(F.transform(F.regexp_extract_all(more, F.lit("[0-9]+"), F.lit(0)), lambda n: F.concat(F.lit("."), n.cast("long").cast("string"))), "")
    return F.when(lettered != "", lettered).when(year != "", F.concat(year, F.lit("."), release.cast("int").cast("string"), further, F.upper(F.coalesce(pack, F.lit("")))))


def default_doc_id(slug_: Column | str, version: Column | str) -> Column:
    """A slug without the release at its end: the document's own, else one that looks like a year's."""
    s, own = _c(slug_), slug(F.coalesce(_c(version), F.lit("")))
    tail = F.concat(F.lit("-"), own)
    bare = F.regexp_replace(s, r"-(?:[a-z]-)?v?20[0-9]{2}(?:-[0-9]+)*(?:-sp[0-9]+(?:-[0-9]+)?)?$", "")
    return F.when((own != "") & s.endswith(tail) & (F.length(s) > F.length(tail)), F.left(s, F.length(s) - F.length(tail))).when(bare == "", s).otherwise(bare)


def default_slug(stem: Column | str, version: Column | str) -> Column:
    """The folder of a new edition: the manual's name and the release."""
    v = _c(version)
    return F.when(F.coalesce(v, F.lit("")) != "", F.concat_ws("-", default_doc_id(stem, v), slug(v))).otherwise(_c(stem))


def split_crumb(crumb: Column | str, title: Column | str) -> Column:
    """Ancestors of a breadcrumb under its title; null if it isn't rooted there."""
    parts = F.split(_c(crumb), CRUMB)
    return F.when(F.element_at(parts, 1) == _c(title), F.slice(parts, F.lit(2), F.size(parts)))


def without_crumb(body: Column | str, crumb: Column | str) -> Column:
    """A body without its first line, where that is the breadcrumb but for stars and blanks."""
    b = _c(body)
    first = F.substring_index(b, "\n", 1)
    bare = lambda x: F.trim(F.regexp_replace(F.trim(x), r"^\*+|\*+$", ""))
    own = bare(F.coalesce(_c(crumb), F.lit("")))
    return F.when((own != "") & (bare(first) == own), F.substring(b, F.length(first) + 2, F.length(b))).otherwise(b)


def furniture_candidate(raw: Column | str, core: Column | str) -> Column:
    """Whether a line has the shape of a running header: several words, at most 120 characters, no structure, no code."""
    raw, core = _c(raw), _c(core)
    structural = F.trim(raw).rlike(r"^$|^[|>*+•#-]|^```")
    words_ok = core.rlike(r"[A-Za-z]") & (F.length(core) <= 120) & core.rlike(r"\s") & ~core.rlike(r"^[\w\s.-]*[_(){};=]+[\w\s.-]*$")
    return F.coalesce((F.lower(core) == "feedback") | (~structural & words_ok & ~core.rlike(r"^<!--|-->$")), F.lit(False))


def valid_pages(start: Column | str, end: Column | str, pages: Column | str) -> Column:
    """none, invalid or ok."""
    s, e, n = _c(start), _c(end), _c(pages)
    return F.when(s.isNull() & e.isNull(), "none").when((s >= 1) & (s <= e) & (n.isNull() | (e <= n)), "ok").otherwise("invalid")


def safe_path(path: Column | str) -> Column:
    p = F.regexp_replace(_c(path), r"\\", "/")
    return F.coalesce(p.rlike("^sections/.") & ~p.rlike(r"(^|/)\.\.(/|$)"), F.lit(False))


def skipped_name(name: Column | str) -> Column:
    """Folders that are no documents: backups, work in progress, hidden ones."""
    return _c(name).rlike(r"\.(old|new)$|^[._]")


def entity_keys(name: Column | str) -> Column:
    """The spellings under which an entry can be found."""
    low = F.lower(collapse(name))
    rule = F.regexp_extract(low, RULE_ID, 1)
    return F.array_distinct(F.when(rule != "", F.array(low, rule, F.concat(F.lit("rule "), rule), F.concat(F.lit("drc rule "), rule))).otherwise(F.array(low)))
