"""Main text of web pages by wrappers inferred for each host.

A page becomes a stream of balanced tokens: element labels (tag, class and id
words, digits made one) and text. A host's wrapper is a union-free regular
expression over such tokens, kept as a tree: elements, text slots, and groups
marked 1, ? (optional), + (repeated) or * (both). Pages are aligned with the
wrapper one after the other: equal labels are aligned level by level; what one
side lacks becomes optional; neighbours that repeat, alone or in groups of two
or three, become one repeated group; texts that differ become slots, and texts
that never differ stay constants. A level that stays irregular beyond
``LOOSE`` entries becomes a repeated group of optional ones, so a wrapper's size
is bounded by its labels.

The wrapper says which elements hold the article: every outermost ``article`` or
``main`` that holds slots, of whatever size, or else the innermost elements with
all of the variable text outside links and page furniture: from the outermost,
one goes down only while one child holds it all. Furniture is told by tags, roles
and whole names; a form, header, aside or so named element that holds the only
article of a host, or most of its variable text, is none. Reader comments are
told by whole names, by their role and by schema.org's item types, ``article``
elements among them. The headings in an article's header, at any depth, are its
titles. The wrapper also tells constant texts (template, not article) where
``CONSTANT_PAGES`` or more pages of different content agree; inside ``article``
and ``main`` only those of an element that holds nothing variable and is neither
prose (paragraphs, quotations, list items, cells, headings) nor inside of it.

Every page of a host takes part. Each task folds its pages into one partial
wrapper for each host, and partial wrappers are aligned with each other on two
levels, so no html is shuffled and a host with a third of all pages costs a row
for each task, merged by ``SALTS`` tasks before one merges theirs. Decisions (a few paths for each host) are broadcast if counted to be few,
else joined with salted hosts.

Defined cases: null and empty pages have empty text; a null or malformed url is
host ''; broken markup is closed as browsers close it;
elements nested beyond ``DEEPEST`` are flattened; repeated rows are
extracted each; an empty table gives no rows; columns named like the output are
replaced.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

#: Pages that must agree on a text before it counts as template.
CONSTANT_PAGES = 5
#: Entries of a level beyond which it becomes a repeated group of optional entries.
LOOSE = 48
#: Share of an element's text that one child must hold to stand for it.
MOST = 0.75
#: Hosts that a task folds before it passes its wrappers on; decisions that are broadcast; salts of a host otherwise.
HELD_HOSTS, BROADCAST_HOSTS, SALTS = 2000, 20_000, 16

#: Nesting beyond which elements are flattened into the one that holds them.
DEEPEST = 150

# HTML's void, raw, head, block and heading elements.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEAD = {"base", "link", "meta", "title"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "optgroup", "p", "pre", "search", "section",
    "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
TEXT_BLOCK = {"p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "blockquote", "pre", "dd", "dt", "figcaption", "caption", "summary"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements that a start tag closes, up to the element that holds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
# Page furniture: elements, roles, and words of classes and ids.
FURNITURE = {"nav", "header", "footer", "aside", "form", "fieldset", "button", "select", "option", "menu", "dialog", "head", "title", "search", "input"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies",
    "disclaimer", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup",
    "promo", "promotion", "related", "replies", "reply", "respond", "responses", "share", "sharing", "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
}

# Words that a furniture name may have besides, furniture that is never an article's frame, and what its labels begin with.
PLACES = {"area", "bar", "block", "body", "bottom", "box", "container", "content", "global", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "page", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "thread", "top", "wrap", "wrapper"}
COMMENTS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "responses"}
NEVER = {"nav", "footer", "button", "select", "option", "menu", "dialog", "head", "title", "search", "input"}
SHUT = "!"

_OTHER = re.compile(r"[\W_]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)\b[^><]*/>"
    r"|<(script|style|noscript|template|textarea|iframe|svg|object|audio|video|canvas|math)\b[^><]*+>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/><]*+)((?:[^><"']|"[^"]*"|'[^']*')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/><]*+)([^><]*+)>"
    r"|<[!?/][^>]*>?"
    r"|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def furniture_name(name: str, words: set[str] = WORDS) -> bool:
    """Whether a whole class or id names furniture: some of ``words``, and else only words of furniture, place and box."""
    parts = [p for p in re.split(r"[-_:.\d]+", name) if p]
    return any(p in words for p in parts) and all(p in WORDS or p in PLACES for p in parts)


def reader_comment(found: dict[str, str], names: list[str]) -> bool:
    """Whether an element's attributes say that it holds reader comments."""
    kinds = {k.rstrip("/").rsplit("/", 1)[-1].lower() for k in found.get("itemtype", "").split()}
    return found.get("role", "").lower() == "comment" or "comment" in found.get("itemprop", "").lower().split() or not kinds.isdisjoint({"comment", "usercomments"}) or any(furniture_name(n, COMMENTS) for n in names)


class Element:
    __slots__ = ("tag", "label", "furniture", "inside", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        names = re.findall(r"[^\s]+", f"{found.get('class', '')} {found.get('id', '')}".lower())
        self.label = ".".join([tag, *(re.sub(r"\d+", "0", n).replace("/", "") for n in names)])
        comment = tag not in ("html", "body", "main") and reader_comment(found, names)
        words = any(furniture_name(n) for n in names) and tag not in ("html", "body", "article", "main")
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", ""))
        role = found.get("role", "").lower()
        self.furniture = bool(tag in FURNITURE or hidden or role in ROLES or words or comment)
        # furniture that may be the frame of an article
        self.inside = self.furniture and not hidden and not comment and tag not in NEVER and (role == "form" or role not in ROLES)
        if self.furniture:
            self.label = SHUT + self.label


def parse(page: str | None) -> Element:
    """The page's block elements; their children are elements and (text, in a link) pairs."""
    root = Element("#page")
    stack, link = [root], False
    flat: list[str] = []  # open elements beyond DEEPEST

    def close(tags: set[str], holders: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in holders:
                return
            if stack[k].tag in tags:
                del stack[k:]
                return

    for m in _TOKEN.finditer(page or ""):
        if (text := m[8]) is not None:
            stack[-1].children.append((html.unescape(text), link))
            continue
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        end, attributes = m[2] or m[5], m[4] or m[7] or ""
        if tag == "br":
            stack[-1].children.append((" ", link))
        elif tag == "a":
            link = not end
        elif tag not in BLOCK:
            continue
        elif end:
            if tag in flat:
                del flat[len(flat) - 1 - flat[::-1].index(tag) :]
            elif any(e.tag == tag for e in stack):
                link = False
                while stack.pop().tag != tag:
                    pass
        else:
            link = False
            if stack[-1].tag in ("head", "title") and tag not in HEAD:
                close({"head"}, set())
            if tag not in ("option", "button"):
                close({"p"}, {"button", "td", "th", "caption", "table"})
            if tag in HEADING:
                close(HEADING, {"div", "section", "article", "td", "li"})
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in ("html", "body") and any(e.tag == tag for e in stack):
                continue
            e = Element(tag, attributes)
            stack[-1].children.append(e)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                if len(stack) < DEEPEST:
                    stack.append(e)
                else:
                    flat.append(tag)
    return root


# A wrapper's entry: [label, mark, children] of an element or group, or ["#", mark, constant or None, letters and digits, those in links,
# hashes of up to CONSTANT_PAGES different pages with the constant] of text.
TEXT, GROUP = "#", "()"


def letters(text: str) -> int:
    return len(_OTHER.sub("", text))


def page_hash(root: Element) -> int:
    """Hash of a page's texts outside furniture: copies of an article have the same."""
    found = hashlib.blake2b(digest_size=6)
    todo: list = [root]
    while todo:
        e = todo.pop()
        if isinstance(e, Element):
            if not e.furniture or e.inside:
                todo.extend(reversed(e.children))
        elif text := " ".join(e[0].split()):
            found.update(f"{text}\n".encode("utf-8", "surrogatepass"))
    return int.from_bytes(found.digest(), "little")


def shape(e: Element, page: int | None = None) -> list:
    """The wrapper of one page: its elements with repeats folded; furniture that cannot be the page's frame has no inside."""
    page = page_hash(e) if page is None else page
    children: list[list] = []
    if not e.furniture or e.inside:
        texts: list[tuple[str, bool]] = []

        def flush() -> None:
            if text := " ".join("".join(t for t, _ in texts).split()):
                children.append([TEXT, "1", text, letters(text), sum(letters(t) for t, a in texts if a), [page]])
            texts.clear()

        for c in e.children:
            if isinstance(c, Element):
                flush()
                children.append(shape(c, page))
            else:
                texts.append(c)
        flush()
    return [e.label, "1", fold(children)]


def name(entry: list) -> str:
    return entry[0] if entry[0] != GROUP else f"({' '.join(name(c) for c in entry[2])})"


def mark(a: str, b: str) -> str:
    """The mark of two aligned entries."""
    few, many = a in "?*" or b in "?*", a in "+*" or b in "+*"
    return "*" if few and many else "?" if few else "+" if many else "1"


def repeated(m: str) -> str:
    return "*" if m in "?*" else "+"


def optional(entry: list) -> list:
    return [entry[0], "*" if entry[1] in "+*" else "?", *entry[2:]]


def merge(a: list, b: list) -> list:
    """One entry for two of the same name."""
    if a[0] == TEXT:
        same = a[2] is not None and a[2] == b[2]
        pages = [] if not same else a[5] if a[5] == b[5] else sorted({*a[5], *b[5]})[:CONSTANT_PAGES]
        return [TEXT, mark(a[1], b[1]), a[2] if same else None, a[3] + b[3], a[4] + b[4], pages]
    inside = [merge(x, y) for x, y in zip(a[2], b[2], strict=True)] if a[0] == GROUP else align(a[2], b[2])
    return [a[0], mark(a[1], b[1]), inside]


def fold(entries: list[list]) -> list[list]:
    """Neighbours that repeat, alone or in groups, as one repeated entry."""
    for size in (1, 2, 3):
        names = [name(e) for e in entries]
        out, i = [], 0
        while i < len(entries):
            j = i + size
            group = entries[i:j]
            while len(group) == size and names[j : j + size] == names[i : i + size]:
                group = [merge(x, y) for x, y in zip(group, entries[j : j + size], strict=True)]
                j += size
            if j == i + size or len(group) < size:
                out.append(entries[i])
                i += 1
            else:
                out.append([group[0][0], repeated(group[0][1]), *group[0][2:]] if size == 1 else [GROUP, "+", group])
                i = j
        entries = out
    return loosen(entries) if len(entries) > LOOSE else entries


def loosen(entries: list[list]) -> list[list]:
    """One repeated group of optional entries, one for each name, that accepts any order."""
    by: dict[str, list] = {}
    todo = list(entries)
    for e in todo:
        if e[0] == GROUP:
            todo.extend(e[2])
        else:
            by[e[0]] = optional(merge(by[e[0]], e) if e[0] in by else e)
    return [[GROUP, "+", [by[k] for k in sorted(by)]]]


def align(a: list[list], b: list[list]) -> list[list]:
    """Two levels as one: a longest common run of names is merged, the rest becomes optional."""
    x, y = [name(e) for e in a], [name(e) for e in b]
    if x == y:
        return [merge(p, q) for p, q in zip(a, b, strict=True)]
    for one, other in ((a, b), (b, a)):  # a loose level takes in everything
        if len(one) == 1 and one[0][0] == GROUP and all(e[1] in "?*" for e in one[0][2]):
            return loosen([*one, *other])
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append(merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            out.append(optional(a[i]))
            i += 1
        else:
            out.append(optional(b[j]))
            j += 1
    return fold(out)


def expression(entry: list) -> str:
    """The wrapper as a union-free regular expression."""
    m = "" if entry[1] == "1" else entry[1]
    if entry[0] == TEXT:
        return f"(#text){m}" if entry[2] is None else f"({entry[2]!r}){m}"
    inside = "".join(expression(c) for c in entry[2])
    return f"({inside}){m}" if entry[0] == GROUP else f"(<{entry[0]}>{inside}</{entry[0]}>){m}" if m else f"<{entry[0]}>{inside}</{entry[0]}>"


def inner(entries: list[list]) -> Iterator[list]:
    """The entries of a level, groups opened."""
    for e in entries:
        if e[0] == GROUP:
            yield from inner(e[2])
        else:
            yield e


def weight(entry: list) -> int:
    """Letters and digits of variable text outside links, inside of furniture included."""
    if entry[0] == TEXT:
        return max(0, entry[3] - entry[4]) if entry[2] is None or len(entry[5]) < CONSTANT_PAGES else 0
    return sum(weight(c) for c in inner(entry[2]))


def tag_of(entry: list) -> str:
    return entry[0].removeprefix(SHUT).split(".")[0]


def framed(wrapper: list) -> tuple[list, list[str]]:
    """The wrapper without furniture, and paths of furniture that stays: it holds the only article, or most variable text where there is none."""
    opened: list[str] = []

    def articles(entry: list, furniture: bool) -> bool:
        if entry[0] == TEXT or entry[0].startswith(SHUT) and not furniture:
            return False
        return tag_of(entry) in ("article", "main") and weight(entry) > 0 or any(articles(c, furniture) for c in inner(entry[2]))

    outside, somewhere, whole = articles(wrapper, False), articles(wrapper, True), weight(wrapper)

    def without(entry: list, path: str) -> list:
        if entry[0] == TEXT:
            return entry
        if entry[0] == GROUP:
            return [*entry[:2], [c for e in entry[2] if (c := without(e, path)) is not None]]
        path = f"{path}/{entry[0]}" if path else entry[0]
        if entry[0].startswith(SHUT):
            if outside or not (articles(entry, True) if somewhere else whole and weight(entry) >= MOST * whole):
                return [*entry[:2], []]
            opened.append(path)
        return [*entry[:2], [without(c, path) for c in entry[2]]]

    return without(wrapper, ""), sorted(set(opened))


def decide(wrapper: list) -> dict:
    """Paths of the elements that hold the article, and (path, text) of template texts in them."""
    wrapper, opened = framed(wrapper)
    articles: list[tuple[str, list]] = []

    def find(entry: list, path: str) -> None:
        if entry[0] == TEXT:
            return
        if tag_of(entry) in ("article", "main") and weight(entry):
            articles.append((path, entry))
            return
        for c in inner(entry[2]):
            find(c, f"{path}/{c[0]}")

    find(wrapper, wrapper[0])
    if not articles:
        entry, path = wrapper, wrapper[0]
        while True:
            held = [c for c in inner(entry[2]) if weight(c)]
            if len(held) != 1 or tag_of(held[0]) in TEXT_BLOCK or held[0][0] == TEXT or any(tag_of(c) in ("h1", "h2") for c in inner(entry[2])):
                break
            entry, path = held[0], f"{path}/{held[0][0]}"
        if not held or any(c[0] == TEXT for c in held):
            articles = [(path, entry)]
        else:  # all that holds variable text, and headings
            articles = [(f"{path}/{c[0]}", c) for c in inner(entry[2]) if weight(c) or tag_of(c) in HEADING]
    constants: list[list[str]] = []

    def constant(entry: list, path: str, article: bool) -> None:
        if article and tag_of(entry) in TEXT_BLOCK:
            return
        for c in inner(entry[2]):
            if c[0] != TEXT:
                constant(c, f"{path}/{c[0]}", article)
            elif c[2] is not None and len(c[5]) >= CONSTANT_PAGES and not (article and weight(entry)):
                constants.append([path, c[2]])

    for p, e in articles:
        constant(e, p, tag_of(e) in ("article", "main"))
    return {"roots": sorted({p for p, _ in articles}), "constants": constants, "opened": opened}


def titles(e: Element, path: str, constants: set[tuple[str, str]], opened: set[str]) -> Iterator[str]:
    """The headings of an article's header, at any depth outside other furniture."""
    for c in e.children:
        if isinstance(c, Element) and not c.furniture:
            yield from (blocks if c.tag in HEADING else titles)(c, f"{path}/{c.label}", constants, opened)


def blocks(e: Element, path: str, constants: set[tuple[str, str]], opened: set[str]) -> Iterator[str]:
    """Text blocks of an element in page order, without furniture and template texts."""
    texts: list[str] = []

    def flush() -> Iterator[str]:
        if (text := " ".join("".join(texts).split())) and (path, text) not in constants:
            yield text
        texts.clear()

    for c in e.children:
        if isinstance(c, Element):
            yield from flush()
            if not c.furniture or f"{path}/{c.label}" in opened:
                yield from blocks(c, f"{path}/{c.label}", constants, opened)
            elif c.tag == "header":
                yield from titles(c, f"{path}/{c.label}", constants, opened)
        else:
            texts.append(c[0])
    yield from flush()


def extract(page: str | None, decision: dict | None) -> str:
    """The main text of a page by its host's decision; by its own wrapper where that finds nothing."""
    root = parse(page)

    def found(d: dict) -> list[str]:
        roots, constants, opened = set(d["roots"]), {(p, t) for p, t in d["constants"]}, set(d["opened"])
        out: list[str] = []

        def walk(e: Element, path: str) -> None:
            if path in roots:
                out.extend(b for b in blocks(e, path, constants, opened) if b)
                return
            for c in e.children:
                if isinstance(c, Element) and (not c.furniture or f"{path}/{c.label}" in opened):
                    walk(c, f"{path}/{c.label}")

        walk(root, root.label)
        return out

    return "\n".join((found(decision) if decision else []) or found(decide(shape(root))))


def host(url: str) -> Column:
    """Lower-case authority of a url; '' if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, page) -> (host, wrapper): the aligned wrapper of all pages of each host, as JSON."""
    names = ["host", "wrapper"]

    def batch(held: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())], names=names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for b in batches:
            for h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = shape(parse(page))
                held[h] = merge(held[h], w) if h in held else w
                if len(held) >= HELD_HOSTS:
                    yield batch(held)
                    held = {}
        if held:
            yield batch(held)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[str, list] = {}
        for b in batches:
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if now and h not in now:
                    yield batch(now)
                    now = {}
                w = json.loads(text)
                now[h] = merge(now[h], w) if now else w
        if now:
            yield batch(now)

    found = pages.mapInArrow(partial, "host string, wrapper string").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for keys in (["host", "salt"], ["host"]):
        found = found.repartition(*keys).select("host", "wrapper").sortWithinPartitions("host", "wrapper").mapInArrow(whole, "host string, wrapper string")
    return found


def decisions(wrapped: DataFrame) -> DataFrame:
    """(host, wrapper) -> (host, decision), both as JSON."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([json.dumps(decide(json.loads(w))) for w in b.column(1).to_pylist()], pa.string())], names=["host", "decision"])

    return wrapped.mapInArrow(run, "host string, decision string")


def main_text(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """Append the main text of every page."""
    common.bounded_batches(pages.sparkSession)
    base = common.without(pages, [out]).withColumn("__llm_host", host(url))
    found = common.stage(decisions(wrappers(base.select(F.col("__llm_host").alias("host"), F.col(page).alias("page")))), "wrapper-decisions")
    found = found.select(F.col("host").alias("__llm_of"), F.col("decision").alias("__llm_decision"))
    if found.count() <= BROADCAST_HOSTS:
        rows = base.join(F.broadcast(found), F.col("__llm_host") == F.col("__llm_of"), "left")
    else:
        salted = found.withColumn("__llm_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = base.withColumn("__llm_own_salt", F.pmod(F.xxhash64(url, page), F.lit(SALTS)).cast("int"))
        rows = own.join(salted, (F.col("__llm_host") == F.col("__llm_of")) & (F.col("__llm_own_salt") == F.col("__llm_salt")), "left")
    kept = [c for c in base.columns if c != "__llm_host"]
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], "__llm_decision")

    def make():
        known: dict[str, dict] = {}

        def batch(b: pa.RecordBatch) -> list:
            texts = []
            for p, d in zip(common.column(b, page).to_pylist(), common.column(b, "__llm_decision").to_pylist(), strict=True):
                if d is not None and d not in known:
                    if len(known) >= HELD_HOSTS:
                        known.clear()
                    known[d] = json.loads(d)
                texts.append(extract(p, known.get(d)))
            return [pa.array(texts, pa.string())]

        return batch

    return common.add_columns(rows, [T.StructField(out, T.StringType())], make).drop("__llm_decision")


@register("op8_html_wrapper")
def op8_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = main_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
