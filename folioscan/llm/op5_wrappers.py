"""Operator 5: main text of web pages, with wrappers inferred per host as union-free regular expressions.

A page is a stream of tokens: tags with their class (implied end tags included) and texts. For each host a bounded sample of pages, those
with the smallest hashes, is aligned one page after the other with the expression found so far: equal tokens stay,
differing texts become slots, a run of tokens that repeats the one before it becomes a repeated group, what only one side has
becomes optional. Pages that are copies of one another count once in the sample, so that a text in all of them is not taken for the template.

The wrapper then chooses the content. Its region is the element, by its path, that holds nearly all the text in slots and repeated or optional groups outside of
what is left out by element, role and class (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments).
On a page with that path the blocks of the region are the text; blocks whose text the wrapper holds constant at that path are template and go, wherever they stand
(in an article, not those of lists, tables, quotes and headings: these may well be alike).

Pages without the region of their host, and hosts without a wrapper, fall back on articles (<article>, <main>) where they hold at least as much
text as what is outside of them, else on both; articles of comments and teasers, and those inside a left-out element that is closed, are none.
Sampling bounds the inference of a host of any size; every page is extracted whole, and pages of any size are sampled. Streams too long to be aligned
token by token are cut at tokens that both have once; stretches without any become optional.

Defined results: null and empty html give empty text; broken markup is read as browsers do, as far as extraction
needs it (unclosed tags end with their parents, stray end tags are skipped, an unclosed comment or script runs to the end);
hosts with fewer than LEAST_PAGES different sample pages have no wrapper; repeated rows give a row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import stage, steps, table, tune

#: Pages of a host from which its wrapper is inferred, and how many different ones it takes.
SAMPLE_PAGES, LEAST_PAGES = 8, 3
#: Pairs of tokens that are aligned one by one; longer streams are cut at tokens that both have once.
CELLS = 1 << 18
#: Tokens of a repeated group.
GROUP = 12
#: Share of the variable text that a child must hold for the region to be in it.
REGION = 0.8
#: Wrappers of up to so many bytes in all are broadcast; more are joined.
BROADCAST_BYTES = 16 << 20

_token = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|textarea|title|svg|math|object|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?(?:</\1\s*[^>]*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_attribute = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head nav footer aside form button input select menu dialog search noscript audio video canvas".split())
_boilerplate = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w*|signup|login|sidebar|side|aside|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|disqus|replies|reply|respond|discussion|share|sharing|social|related|recommend\w*|widget|pagination|pager|toolbar|alert|disclaimer|copyright|search|skip)(?:$|[\s_-])",
    re.I,
)
#: Articles that are not the content: a class or id of its own, as "has-sidebar" may well be.
_aside_article = re.compile(r"(?:^|\s)(?:div-)?(?:(?:comment|reply|review)(?:-(?:body|item|\d+))?|(?:ads?|advert\w*|sponsor\w*|promo|teaser|related|recommend\w*)(?:-(?:post|item|article|card|\d+))?|(?:post|article|entry|story)-(?:teaser|related|promo))(?:$|\s)", re.I)
_roles = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Elements in an article whose text stays, even if every page has it.
KEPT = frozenset("li td th dt dd h1 h2 h3 h4 h5 h6 pre blockquote caption figcaption".split())
#: Elements that a region can be.
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
#: These end an open paragraph.
_ends_p = BLOCKS - {"body", "html", "option", "caption", "tbody", "td", "th", "tr", "thead", "tfoot"}


def tokens_of(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): 'text', 'open' with attributes, or 'close'. Comments and raw elements are passed over."""
    for m in _token.finditer(html):
        if m[3]:
            yield ("close" if m[2] else "open", m[3].lower(), m[4])
        elif m[0][0] != "<" or m[0] == "<":
            yield ("text", "", m[0])


def attributes(rest: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _attribute.findall(rest)} if rest else {}


def is_boilerplate(name: str, rest: str, own: dict[str, str]) -> bool:
    if name in LEFT_OUT:
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    if name == "article":
        return any(_aside_article.search(own.get(k, "")) for k in ("class", "id"))
    return own.get("role", "").lower() in _roles or own.get("aria-hidden") == "true" or re.search(r"\shidden(?:\s|=|$)", rest) is not None or any(_boilerplate.search(own.get(k, "")) for k in ("class", "id"))


def unclosed(html: str) -> frozenset[str]:
    """Names of elements that the page opens more often than it closes."""
    count: Counter[str] = Counter()
    for kind, name, rest in tokens_of(html):
        if kind == "close" or kind == "open" and not rest.endswith("/"):
            count[name] += 1 if kind == "open" else -1
    return frozenset(name for name, n in count.items() if n > 0)


_START, _END, _TEXT, _VOID = range(4)


def events(html: str) -> Iterator[tuple[int, str, str, bool]]:
    """(what, name or text, tag, left out): every start has its end, as browsers would close it. A tag is the name with the class, numbers masked."""
    stack: list[tuple[str, str, bool]] = []
    blocks: list[int] = []  # where in the stack block elements are
    count: Counter[str] = Counter()
    within = out = 0  # open articles, open elements that are left out
    open_names: frozenset[str] | None = None

    def pop() -> tuple[int, str, str, bool]:
        nonlocal within, out
        name, tag, left = stack.pop()
        if blocks and blocks[-1] == len(stack):
            blocks.pop()
        count[name] -= 1
        within -= name in ("article", "main")
        out -= left
        return (_END, name, tag, left)

    for kind, name, rest in tokens_of(html):
        if kind == "text":
            yield (_TEXT, rest, "", out > 0)
        elif kind == "open":
            if name in ("article", "main") and out and not within:  # an unclosed notice does not swallow the content
                open_names = unclosed(html) if open_names is None else open_names
                if all(n in open_names for n, _, left in stack if left):
                    while out:
                        yield pop()
            if name in _ends_p and blocks and stack[blocks[-1]][0] == "p":
                at = blocks[-1]
                while len(stack) > at:
                    yield pop()
            if name in ("li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                yield pop()
            own = attributes(rest)
            tag = f"{name} {' '.join(re.sub('[0-9]+', '0', own['class']).split())}" if own.get("class") else name
            if name in VOID or rest.endswith("/"):
                yield (_VOID, name, tag, False)
                continue
            left = is_boilerplate(name, rest, own) or (name == "header" and not within)
            if name in BLOCKS:
                blocks.append(len(stack))
            stack.append((name, tag, left))
            count[name] += 1
            out += left
            within += name in ("article", "main")
            yield (_START, name, tag, left)
        elif count[name]:
            while stack[-1][0] != name:
                yield pop()
            yield pop()
        elif name in BLOCKS:
            yield (_VOID, name, name, False)
    while stack:
        yield pop()


class Wrapper(NamedTuple):
    """What extraction needs of a host's expression: the path of its region, and texts that are constant at a path."""

    region: tuple[str, ...] = ()
    constant: dict[str, frozenset[str]] = {}


def blocks_of(html: str, wrapper: Wrapper = Wrapper()) -> list[str]:
    """The content blocks of a page in order."""
    region, constant = wrapper
    path: list[str] = []
    met = 0  # open elements, from the root, that are the region's path
    articles = out = 0
    found: list[tuple[bool, bool, str]] = []  # whether in an article, in the region
    buffer: list[str] = []
    template = True  # all of the buffer is constant

    def flush() -> None:
        nonlocal template
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text and not template:
                found.append((articles > 0, bool(region) and met == len(region), text))
        template = True

    for what, name, tag, left in events(html):
        if what == _TEXT:
            if not left:
                buffer.append(name)
                if template and constant:
                    text = " ".join(entities.unescape(name).split())
                    template = not text or (text in constant and "/".join(path) in constant[text] and not (articles and any(t.split(" ", 1)[0] in KEPT for t in path)))
                else:
                    template = False
        elif what == _START:
            if left or name in BLOCKS:
                flush()
            if met == len(path) and met < len(region) and region[met] == tag:
                met += 1
            path.append(tag)
            out += left
            articles += name in ("article", "main")
        elif what == _END:
            if left or name in BLOCKS:
                flush()
            path.pop()
            met = min(met, len(path))
            out -= left
            articles -= name in ("article", "main")
        elif name == "br":
            buffer.append("\n")
        elif name in BLOCKS:
            flush()
    flush()
    size = lambda rows: sum(len(t) for *_, t in rows)
    own = [x for x in found if x[1]]
    if own and size(own) >= size(x for x in found if x[0] and not x[1]):
        return [t for *_, t in own]
    inside = [x for x in found if x[0]]
    return [t for *_, t in (inside if 2 * size(inside) >= size(found) else found)]


def main_text(html: str | None, wrapper: Wrapper = Wrapper()) -> str:
    return "\n".join(blocks_of(html or "", wrapper))


# Inference of wrappers: an expression is a list of nodes.


class Node(NamedTuple):
    """A tag, a text or a repeated group. shape is what counts for alignment: all texts are alike there, but for those that every page has in one place."""

    shape: object
    text: str | None = None  # a text that all pages agree on; None: a slot
    inner: tuple[Node, ...] = ()
    optional: bool = False
    chars: int = 0

    @property
    def is_text(self) -> bool:
        return not self.inner and self.shape[0] == TEXT


TEXT = "#"


def placed(page: list[Node]) -> Iterator[tuple[tuple[str, str], Node]]:
    """Each token with its path and its text."""
    path: list[str] = []
    for n in page:
        if n.shape[0] == "<" and n.shape[1] == "/":
            path.pop()
        yield ("/".join(path), n.text or ""), n
        if n.shape[0] == "<" and n.shape[1] != "/" and n.shape[1:-1].split(" ", 1)[0] not in VOID:
            path.append(n.shape[1:-1])


def with_template(pages: list[list[Node]]) -> list[list[Node]]:
    """Texts that every page has at one path have a shape of their own, so that no group takes them in."""
    every = set.intersection(*({k for k, n in placed(p) if n.is_text} for p in pages))
    return [[n._replace(shape=TEXT + n.text) if n.is_text and k in every else n for k, n in placed(p)] for p in pages]


def signature(html: str) -> list[Node]:
    """The token stream of a page."""
    out = []
    for what, name, tag, _ in events(html):
        if what == _TEXT:
            text = " ".join(entities.unescape(name).split())
            if text:
                out.append(Node(TEXT, text, chars=len(text)))
        elif what == _END:
            out.append(Node(f"</{tag}>"))
        elif what == _START or name in VOID:
            out.append(Node(f"<{tag}>"))
    return out


def _merge(a: Node, b: Node) -> Node:
    """One node for two that are alike: differing texts make a slot."""
    inner = tuple(_merge(x, y) for x, y in zip(a.inner, b.inner, strict=True))
    return Node(a.shape, a.text if a.text == b.text else None, inner, a.optional or b.optional, a.chars + b.chars)


def _group(nodes: list[Node]) -> Node:
    return Node(("+", *(n.shape for n in nodes)), inner=tuple(nodes))


def fold(nodes: list[Node], known: frozenset = frozenset()) -> list[Node]:
    """Neighbouring runs of equal shape become one repeated group; so do single runs of a known group's shape."""
    out: list[Node] = []
    shapes: list[object] = []

    def cut(n: int, node: Node) -> None:
        del out[-n:], shapes[-n:]
        out.append(node)
        shapes.append(node.shape)

    for node in nodes:
        out.append(node)
        shapes.append(node.shape)
        folded = True
        while folded:
            folded = False
            for n in range(1, min(GROUP, len(out)) + 1):
                last = shapes[-n:]
                if len(out) > n and shapes[-n - 1] == ("+", *last):
                    group = out[-n - 1]
                    cut(n + 1, group._replace(inner=tuple(_merge(a, b) for a, b in zip(group.inner, out[-n:], strict=True))))
                elif n > 1 and str(last[0]).startswith("<") and last[0][1] != "/" and last[-1] == f"</{last[0][1:]}" and (("+", *last) in known or shapes[-2 * n : -n] == last):
                    twice = shapes[-2 * n : -n] == last and ("+", *last) not in known
                    cut(2 * n if twice else n, _group([_merge(a, b) for a, b in zip(out[-2 * n : -n], out[-n:], strict=True)] if twice else out[-n:]))
                else:
                    continue
                folded = True
                break
    return out


def _pairs(a: list, b: list) -> list[tuple[int, int]]:
    """Places of an in-order matching of two lists of shapes."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            out.append((i2, j2))
        if i == i2 or j == j2:
            continue
        if (i2 - i) * (j2 - j) <= CELLS:
            for x, y, n in SequenceMatcher(None, a[i:i2], b[j:j2], autojunk=False).get_matching_blocks():
                out += [(i + x + k, j + y + k) for k in range(n)]
            continue
        once = {s for s, n in Counter(a[i:i2]).items() if n == 1} & {s for s, n in Counter(b[j:j2]).items() if n == 1}
        at = {s: y for y, s in enumerate(b[j:j2], j) if s in once}
        ends, chain = [], []  # longest increasing run of places in b
        for x in range(i, i2):
            if a[x] in once:
                y = at[a[x]]
                k = bisect_left(ends, y)
                ends[k : k + 1] = [y]
                chain.append((k, x, y))
        marks, k = [], len(ends) - 1
        for k2, x, y in reversed(chain):
            if k2 == k and (not marks or y < marks[-1][1]):
                marks.append((x, y))
                k -= 1
        if not marks:
            continue
        edges = [(i - 1, j - 1), *reversed(marks), (i2, j2)]
        out += marks
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def align(expression: list[Node], page: list[Node]) -> list[Node]:
    """The expression that also covers the page."""
    out: list[Node] = []
    i = j = 0
    for x, y in [*_pairs([n.shape for n in expression], [n.shape for n in page]), (len(expression), len(page))]:
        out += [n._replace(optional=True) for n in [*expression[i:x], *page[j:y]]]
        if x < len(expression):
            out.append(_merge(expression[x], page[y]))
        i, j = x + 1, y + 1
    return out


def _groups(nodes: list[Node]) -> frozenset:
    return frozenset(n.shape for n in nodes if n.inner)


def infer(pages: list[str]) -> list[Node]:
    """The wrapper of a host's sample pages."""
    expression: list[Node] = []
    streams = [signature(html) for html in pages]
    for n, stream in enumerate(with_template(streams) if len(streams) > 1 else streams):
        page = stream = fold(stream)
        if n:
            known = _groups(expression) | _groups(page)
            page = align(fold(expression, known), fold(stream, known))
        expression = page
    return expression


def accepts(expression: list[Node], page: list[Node]) -> bool:
    """Whether the expression generates the token stream of a page."""

    def ends(nodes: tuple[Node, ...], starts: set[int]) -> set[int]:
        for n in nodes:
            if n.inner:
                new, now = set(), starts
                while now := ends(n.inner, now) - new:
                    new |= now
            else:
                new = {i + 1 for i in starts if i < len(page) and (page[i].is_text and n.text in (None, page[i].text) if n.is_text else page[i].shape == n.shape)}
            starts = new | starts if n.optional else new
        return starts

    return len(page) in ends(tuple(expression), {0})


def rendered(expression: list[Node]) -> str:
    """The expression as text: slots as #, optional and repeated groups marked ? and +."""
    return "".join(f"({rendered(list(n.inner))})+{'?' * n.optional}" if n.inner else f"({n.text or '#' if n.is_text else n.shape})?" if n.optional else (n.text or "#") if n.is_text else str(n.shape) for n in expression)


def wrapper_of(expression: list[Node]) -> Wrapper:
    """Region and constant texts of an expression."""
    volume: Counter[tuple[str, ...]] = Counter()
    heads: set[tuple[str, ...]] = set()
    repeated: set[tuple[str, ...]] = set()
    constant: dict[str, set[str]] = {}
    path: list[str] = []
    out: list[bool] = []

    def walk(nodes, group: bool, optional: bool) -> None:
        for n in nodes:
            if n.inner:
                walk(n.inner, True, optional or n.optional)
            elif n.is_text:
                if n.text is not None and not (optional or n.optional):
                    constant.setdefault(n.text, set()).add("/".join(path))
                elif not any(out):
                    for k in range(1, len(path) + 1):
                        volume[tuple(path[:k])] += n.chars
            elif n.shape[1] == "/":
                if n.shape[2:-1] in path:
                    while path.pop() != n.shape[2:-1]:
                        out.pop()
                    out.pop()
            else:
                tag = n.shape[1:-1]
                name = tag.split(" ", 1)[0]
                if name in VOID:
                    continue
                if name in ("h1", "h2"):
                    heads.add(tuple(path))
                path.append(tag)
                out.append(is_boilerplate(name, "class" if " " in tag else "", {"class": tag.partition(" ")[2]}) or (name == "header" and not any(t.split(" ", 1)[0] in ("article", "main") for t in path)))
                if group:
                    repeated.add(tuple(path))

    walk(expression, False, False)
    # Down from the root, as long as one child holds nearly everything.
    children: dict[tuple[str, ...], list[tuple[str, ...]]] = {}
    for p in volume:
        children.setdefault(p[:-1], []).append(p)
    region: tuple[str, ...] = ()
    whole = sum(volume[p] for p in children.get((), []))
    while True:
        best = max(children.get(region, []), key=lambda p: (volume[p], p), default=None)
        last = region[-1].split(" ", 1)[0] if region else ""
        if best is None or last in ("article", "main") or region in heads or best in repeated or best[-1].split(" ", 1)[0] not in CONTAINERS or volume[best] < REGION * whole:
            break
        region = best
    return Wrapper(region if region and region[-1].split(" ", 1)[0] not in ("html", "body") else (), {t: frozenset(p) for t, p in constant.items()})


def different(pages: list[str]) -> list[str]:
    """Pages of which none shares one of its three longest texts with an earlier one: copies count once."""
    seen: set[str] = set()
    out = []
    for html in pages:
        texts = {" ".join(entities.unescape(name).split()) for what, name, _, left in events(html) if what == _TEXT and not left}
        long = sorted((t for t in texts if len(t) >= 40), key=len)[-3:]
        if not seen.intersection(long):
            out.append(html)
        seen.update(long)
    return out


def _host(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """(host, expression, wrapper) from at most `sample` pages of each host: the expression as text, and what extraction needs of it as JSON."""
    own = pages.filter("html is not null").select(_host(F.col("url")).alias("host"), "html")
    # Ranks need no html: Spark keeps the first few of each host in every task before anything is shuffled.
    few = own.withColumn("k", F.xxhash64("html")).withColumn("rn", F.row_number().over(Window.partitionBy("host").orderBy("k"))).filter(F.col("rn") <= sample).select("host", "html")

    def of_host(rows: pd.DataFrame) -> pd.DataFrame:
        own = different(sorted(set(rows["html"])))
        found = infer(own) if len(own) >= LEAST_PAGES else []
        w = wrapper_of(found)
        packed = json.dumps([w.region, {t: sorted(p) for t, p in sorted(w.constant.items())}]) if w.region or w.constant else None
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "expression": [rendered(found)], "wrapper": [packed]})

    return few.groupBy("host").applyInPandas(of_host, "host string, expression string, wrapper string")


def unpacked(wrapper: str | None) -> Wrapper:
    if wrapper is None:
        return Wrapper()
    region, constant = json.loads(wrapper)
    return Wrapper(tuple(region), {t: frozenset(p) for t, p in constant.items()})


def extract(spark: SparkSession, pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tune(spark)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = stage(spark, wrappers(own, sample).select("host", "wrapper").filter("wrapper is not null"), "wrappers")
    size = found.agg(F.sum(F.octet_length("host") + F.octet_length("wrapper"))).first()[0] or 0
    keyed = own.withColumn("host", _host(F.col("url"))).join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str | None, Wrapper] = {}
        for batch in steps(batches, "html"):
            texts = []
            for html, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if packed not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    memo[packed] = unpacked(packed)
                texts.append(main_text(html, memo[packed]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return keyed.select("page_id", "url", "html", "wrapper").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))
