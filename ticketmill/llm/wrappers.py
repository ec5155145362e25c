"""HTML extraction by wrappers: union-free expressions inferred from all pages of a host.

Text that stands at the same place on most of a host's different pages is fixed, all other text a
slot. The token trees of the pages of one template are aligned one after the other, and partial
wrappers of many tasks in turn: tokens that match are one, what one side lacks becomes an optional
group, neighbours alike a repeated group, text a slot. The wrapper says which of its parts holds the
article, by the text that went through its slots, and which texts are fixed; every page is then
read whole, and its blocks inside that part that are no fixed text are kept.
"""

from __future__ import annotations

import html as entities
import json
import re
import sys
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import per_slice, slices
from ticketmill.llm.frames import pick, ship, written

#: Text is fixed if it stands on this share of the host's different pages that have its place, and
#: on this many at least.
FIXED_SHARE, FIXED_PAGES = 0.8, 4
#: Partial wrappers that a task keeps, and groups into which a template's are dealt to be aligned.
HELD, DEALT = 1000, 64
#: Python calls per level of the deepest page (alignment follows the nesting).
DEEPEST_CALLS = 1_000_000

#: Elements by how they stand in the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt "
    "s samp small span strike strong sub sup time tt u var br wbr img".split())
OPAQUE = frozenset("script style noscript template title textarea select iframe svg math object "
                   "canvas audio video head".split())
ASIDE = frozenset("nav footer aside form button menu dialog fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                        "menu menubar toolbar".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar "
    "comment comments respond replies cookie cookies consent notice notices banner alert share "
    "sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation footer "
    "header masthead subscribe newsletter signup login popup modal widget pagination pager "
    "disclaimer toolbar hidden".split())
#: Names of which one word in a class or id is enough.
STRONG_NAMES = frozenset(
    "comment comments disqus discussion discussions responses replies respond cookie cookies "
    "advert adverts advertisement advertisements advertising sponsored share sharing newsletter".split())
#: Words that add nothing to such a name, and elements that no name sets aside.
NEUTRAL = frozenset("site global top bottom left right box bar block list area container wrap "
                    "wrapper slot unit".split())
NEVER_ASIDE = frozenset("html body main article".split())
MAIN_NAMES = frozenset("article main content post entry story".split())
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DIGITS = re.compile(r"\d+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    """A block element; ``parts`` holds text pieces (with whether linked) and elements.
    ``hinted``: only its class or id sets it aside. ``path`` stands for the labels down to it;
    ``headed``: it stands inside an article or main element."""

    __slots__ = ("tag", "label", "aside", "hinted", "parts", "path", "headed")

    def __init__(self, tag: str, label: str, aside: bool, hinted: bool = False):
        self.tag, self.label, self.aside, self.hinted, self.parts = tag, label, aside, hinted, []
        self.path, self.headed = 0, False

    def add(self, made: Element) -> None:
        made.path = _below(self.path, made.label)
        made.headed = self.headed or self.tag in ("article", "main")
        self.parts.append(made)


def _mark(path: int, text: str) -> int:
    """64 bits that stand for a place and what is there."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8,
                                  key=path.to_bytes(8, "little", signed=True)).digest(), "little", signed=True)


@lru_cache(maxsize=1 << 16)
def _below(path: int, label: str) -> int:
    """The path of an element of that label; the pages of a template share nearly all of theirs."""
    return _mark(path, label)


@lru_cache(maxsize=1 << 12)
def _aside_name(name: str) -> bool:
    """Whether a class or id says so: by one strong word, or because all its words are such names
    or neutral ones."""
    words = {w.lower() for w in _NAME_PARTS.findall(name)}
    return bool(words & STRONG_NAMES) or bool(words & ASIDE_NAMES) and words <= ASIDE_NAMES | NEUTRAL


def _element(tag: str, attributes: str) -> Element:
    aside, hinted, label = tag in ASIDE, False, tag
    if attributes and "=" in attributes or "hidden" in attributes:
        found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = [*found.get("class", "").split(), found.get("id", "")]
        aside = (aside or found.get("role", "").lower() in ASIDE_ROLES or "hidden" in found
                 or found.get("aria-hidden") == "true")
        hinted = not aside and tag not in NEVER_ASIDE and found.get("role") != "main" and any(
            map(_aside_name, names))
        first = found.get("class", "").split()
        # numbers in class names tell pages apart, not templates
        label = tag + (f".{_DIGITS.sub('0', first[0])}" if first else "")
        if found.get("role") == "main":
            label = "main"
    return Element(tag, label, aside or hinted, hinted)


def _keep_full(root: Element) -> None:
    """Elements set aside by name alone stay if they hold most of the page's unlinked text."""
    order = [root]
    for e in order:
        order += [p for p in e.parts if isinstance(p, Element)]
    held: dict[int, int] = {}
    for e in reversed(order):
        held[id(e)] = sum(held[id(p)] if isinstance(p, Element) else
                          0 if p[1] else len("".join(p[0].split())) for p in e.parts)
    for e in order:
        if e.hinted and 2 * held[id(e)] > held[id(root)]:
            e.aside = False


def parse(page: str) -> Element:
    """The blocks of a page. Inline elements only carry their text; a block ends an open
    paragraph, and end tags without a start are passed over."""
    root = Element("#root", "#root", False)
    stack, links, at, any_hinted = [root], 0, 0, False

    def text(piece: str) -> None:
        if piece:
            stack[-1].parts.append((entities.unescape(piece), links > 0))

    while hit := _TOKEN.search(page, at):
        text(page[at:hit.start()])
        at = hit.end()
        tag = (hit[2] or "").lower()
        if not tag:
            continue
        if tag in OPAQUE:
            if not hit[1] and not hit[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if tag == "head" and not end:
                    continue
                at = end.end() if end else len(page)
        elif tag in INLINE:
            if tag == "a":
                links = 0 if hit[1] else 1
            elif tag == "br":
                stack[-1].parts.append((" ", False))
        elif tag in VOID:
            stack[-1].add(Element(tag, tag, False))
        elif hit[1]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
            if depth:
                del stack[depth:]
                links = 0
        else:
            while len(stack) > 1 and stack[-1].tag in CLOSED_BY and (
                    CLOSED_BY[stack[-1].tag] is None or tag in CLOSED_BY[stack[-1].tag]):
                stack.pop()
            links = 0
            made = _element(tag, hit[3])
            headed = stack[-1].headed or stack[-1].tag in ("article", "main")
            if tag == "header" and not headed:
                made.aside, made.hinted = True, False
            elif made.hinted and headed and made.label.endswith(".header"):
                made.aside = made.hinted = False
            any_hinted = any_hinted or made.hinted
            stack[-1].add(made)
            stack.append(made)
    text(page[at:])
    if any_hinted:
        _keep_full(root)
    return root


def blocks(element: Element) -> list[tuple[int, str]]:
    """(path, text) of the blocks inside, in page order, without what stands aside."""
    out: list[tuple[int, str]] = []
    run: list[str] = []
    walk = [(element.path, iter(element.parts))]

    def end(path: int) -> None:
        words = " ".join("".join(run).split())
        if words:
            out.append((path, words))
        run.clear()

    while walk:
        path, parts = walk[-1]
        part = next(parts, None)
        if part is None:
            end(path)
            walk.pop()
        elif isinstance(part, tuple):
            run.append(part[0])
        else:
            end(path)
            if not part.aside:
                walk.append((part.path, iter(part.parts)))
    return out


def outermost(root: Element, wanted) -> list[Element]:
    """The elements that ``wanted`` accepts, in page order, but for those inside another one or
    inside what stands aside."""
    found, waiting = [], [root]
    while waiting:
        e = waiting.pop()
        if e.aside:
            continue
        if wanted(e):
            found.append(e)
        else:
            waiting += [p for p in reversed(e.parts) if isinstance(p, Element)]
    return found


# --- wrappers ------------------------------------------------------------------------------


class Node:
    """Part of a wrapper: an element with its children, or text (label "#"): a slot, or fixed.

    ``pages`` is the number of pages it was found on, ``chars`` the characters outside links that
    went through its own slots."""

    __slots__ = ("label", "path", "text", "children", "optional", "repeated", "aside", "pages", "chars",
                 "key", "held")

    def __init__(self, label: str, path: int, text: str | None = None):
        self.label, self.path, self.text = label, path, text
        self.children: list[Node] = []
        self.optional = self.repeated = self.aside = False
        self.pages, self.chars, self.key, self.held = 1, 0, label, 0

    def close(self) -> Node:
        """Set what the node is aligned by: its label, and its text if all of it is fixed."""
        texts = [self] if self.label == "#" else [c for c in self.children if c.label == "#"]
        fixed = texts and len(texts) == len(self.children or texts) and all(t.text is not None for t in texts)
        self.key = f"{self.label}|{' '.join(t.text for t in texts)}" if fixed else self.label
        return self

    def pattern(self) -> str:
        """The union-free expression: + repeats, ? is optional, # is a slot."""
        if self.label == "#":
            own = "#" if self.text is None else json.dumps(self.text)
        else:
            own = f"<{self.label}>{''.join([c.pattern() for c in self.children])}</>"
        return f"({own})" + "+" * self.repeated + "?" * self.optional \
            if self.repeated or self.optional else own

    def weigh(self) -> int:
        """Set, for this and all below, the characters in slots outside links and outside what
        stands aside."""
        order = [self]
        for node in order:
            order += node.children
        for node in reversed(order):
            node.held = 0 if node.aside else node.chars + sum(c.held for c in node.children)
        return self.held


def as_wrapper(element: Element, fixed: frozenset[int] | set[int] = frozenset()) -> Node:
    """The wrapper of one page; ``fixed`` holds the marks of fixed texts (see :func:`text_marks`)."""
    node = Node(element.label, element.path)
    node.aside = element.aside
    made: list[Node] = []
    run: list[tuple[str, bool]] = []

    def end() -> None:
        words = " ".join("".join(piece for piece, _ in run).split())
        if words:
            known = bool(fixed) and _mark(element.path, words) in fixed
            made.append(Node("#", element.path, words if known else None).close())
            if not known:
                made[-1].chars = sum(len("".join(piece.split())) for piece, linked in run if not linked)
        run.clear()

    for part in element.parts:
        if isinstance(part, tuple):
            run.append(part)
        else:
            end()
            made.append(as_wrapper(part, fixed))
    end()
    node.children = _folded(made)
    return node.close()


def _folded(nodes: list[Node]) -> list[Node]:
    """Neighbours alike become a repeated group."""
    out: list[Node] = []
    for n in nodes:
        if out and out[-1].key == n.key and n.label != "#":
            pages = max(out[-1].pages, n.pages)
            optional = out[-1].optional and n.optional
            out[-1] = align(out[-1], n)
            out[-1].pages, out[-1].repeated, out[-1].optional = pages, True, optional
        else:
            out.append(n)
    return out


def align(a: Node, b: Node) -> Node:
    """One expression that matches what both match. Tokens with equal keys (an element by its label,
    and by its text where all of it is fixed) are matched in order; what lies between is found on
    one side only and becomes optional."""
    node = Node(a.label, a.path, a.text if a.text == b.text else None)
    node.chars, node.aside, node.pages = a.chars + b.chars, a.aside and b.aside, a.pages + b.pages
    node.optional, node.repeated = a.optional or b.optional, a.repeated or b.repeated
    made: list[Node] = []
    keys = [n.key for n in a.children], [n.key for n in b.children]
    if keys[0] == keys[1]:  # as most do
        node.children = [align(x, y) for x, y in zip(a.children, b.children)]
        return node.close()
    for kind, i, i_end, j, j_end in SequenceMatcher(None, *keys, False).get_opcodes():
        left, right = a.children[i:i_end], b.children[j:j_end]
        if kind == "equal":
            made += [align(x, y) for x, y in zip(left, right)]
        else:
            for x in [*left, *right]:
                x.optional = True
                made.append(x)
    node.children = _folded(made)
    return node.close()


def region(wrapper: Node) -> list[Node]:
    """The parts of a wrapper that hold the article: its article elements, if they hold nearly all
    that any named elements hold; else its main elements, or those with a content name, if they
    hold a fair share of the text; else the deepest element that holds most of it. None without
    any text in slots."""
    def named(wanted) -> tuple[list[Node], int]:
        found, waiting = [], [wrapper]
        while waiting:
            node = waiting.pop()
            if node.aside or node.label == "#":
                continue
            if wanted(node.label.partition(".")):
                found.append(node)
            else:
                waiting += reversed(node.children)
        return found, sum(n.held for n in found)

    whole = wrapper.weigh()
    if not whole:
        return []
    articles, of_articles = named(lambda p: p[0] == "article")
    mains, of_mains = named(lambda p: p[0] == "main")
    contents, of_contents = named(lambda p: p[0] not in ("article", "main") and bool(
        MAIN_NAMES.intersection(w.lower() for w in _NAME_PARTS.findall(p[2]))))
    if 5 * of_articles >= 4 * max(of_mains, of_contents) and 10 * of_articles >= 3 * whole:
        return articles
    for found, held in ((mains, of_mains), (contents, of_contents), (articles, of_articles)):
        if 10 * held >= 3 * whole:
            return found
    node = wrapper
    while True:
        inner = [c for c in node.children if c.label != "#" and 5 * c.held >= 4 * whole]
        if not inner or inner[0].label.split(".")[0] in ("p", "li", "td", "h1", "h2"):
            return [node]
        node = inner[0]


def fixed_marks(wrapper: Node) -> list[int]:
    """Marks of the fixed texts that most pages of the template show."""
    out, waiting = [], [wrapper]
    while waiting:
        node = waiting.pop()
        if node.label == "#" and node.text is not None and node.pages >= FIXED_SHARE * wrapper.pages:
            out.append(_mark(node.path, node.text))
        waiting += node.children
    return out


def text_marks(root: Element) -> dict[int, int]:
    """The marks of a page's blocks, each with its path."""
    return {_mark(path, text): path for path, text in blocks(root)}


def infer(pages: list[str], least: int = 1) -> Node:
    """The wrapper of some pages by themselves; text is fixed if at least ``least`` show it."""
    roots = [parse(p) for p in pages]
    marks = [text_marks(r) for r in roots]
    shown: dict[int, int] = {}
    places: dict[int, int] = {}
    for page in marks:
        for mark in page:
            shown[mark] = shown.get(mark, 0) + 1
        for path in set(page.values()):
            places[path] = places.get(path, 0) + 1
    path_of = {m: p for page in marks for m, p in page.items()}
    fixed = {m for m, n in shown.items() if n >= max(least, FIXED_SHARE * places[path_of[m]])}
    wrapper = as_wrapper(roots[0], fixed)
    for root in roots[1:]:
        wrapper = align(wrapper, as_wrapper(root, fixed))
    return wrapper


def main_text(page: str, label: str | None = None, paths: list[int] | None = None,
              fixed: frozenset[int] = frozenset()) -> str:
    """The blocks inside every outermost element of that label, or at one of ``paths``; on a page
    that has no fair share of its text there, inside the part that the page by itself suggests.
    Blocks whose marks are ``fixed`` go, unless they are half of that text or more: such a page is
    a copy, not a frame."""
    root = parse(page)
    wanted = frozenset(paths or ())
    found = outermost(root, lambda e: e.label == label or e.path in wanted)

    def inside(elements: list[Element]) -> tuple[list[tuple[int, str]], int]:
        made = [b for e in elements for b in blocks(e)]
        return made, sum(len(text) for _, text in made)

    texts, size = inside(found)
    if not size or not label and 10 * size < 3 * inside([root])[1]:
        own = frozenset(n.path for n in region(as_wrapper(root)))
        texts, size = inside(outermost(root, lambda e: e.path in own))
    if not fixed:
        return "\n".join(t for _, t in texts)
    kept = [t for path, t in texts if _mark(path, t) not in fixed]
    if 2 * sum(map(len, kept)) <= size:
        kept = [t for _, t in texts]
    return "\n".join(kept)


# --- wrappers as rows ----------------------------------------------------------------------

def _rows(node: Node) -> str:
    """A wrapper as a flat list of its nodes, each with its number of children."""
    out, waiting = [], [node]
    while waiting:
        n = waiting.pop()
        out.append([n.label, n.path, n.text, n.optional, n.repeated, n.aside, n.pages, n.chars, len(n.children)])
        waiting += reversed(n.children)
    return json.dumps(out)


def _tree(rows: str) -> Node:
    made = []
    for label, path, text, optional, repeated, aside, pages, chars, n in reversed(json.loads(rows)):
        node = Node(label, path, text)
        node.optional, node.repeated, node.aside = optional, repeated, aside
        node.pages, node.chars = pages, chars
        node.children = [made.pop() for _ in range(n)]
        made.append(node.close())
    return made[0]


def template(html: Column) -> Column:
    """What tells the templates of a host apart: the article and main elements of a page, by tag and
    first class without numbers, each once."""
    def name(tag: Column) -> Column:
        classes = F.regexp_extract(tag, r"\bclass\s*=\s*[\"']?([^\"'>]*)", 1)
        first = F.regexp_replace(F.get(F.split(F.trim(classes), r"\s+"), F.lit(0)), r"\d+", "0")
        return F.concat_ws(".", F.regexp_extract(tag, r"^<(\w+)", 1), F.nullif(first, F.lit("")))

    tags = F.regexp_extract_all(F.lower(html), F.lit(r"<(?:article|main)\b[^>]*"), F.lit(0))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(tags, name))), " ")


def host(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host (lower case; empty where the url names none) and template."""
    slim = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("bigint").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).alias("html"))
    found = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return slim.withColumns({"host": F.lower(F.coalesce(found, F.lit(""))), "template": template(F.col("html"))})


def fixed_texts(sited: DataFrame) -> DataFrame:
    """(host, marks): the marks of each host's fixed texts. Equal pages count once. What is counted
    are marks, per host and place, so a busy host is many sums; a host has no more fixed texts than
    a page has blocks, by the share of pages that must show them."""
    def work(batch: pa.RecordBatch) -> dict:
        hosts, prints, paths, marks = [], [], [], []
        sent = (batch.column(c).to_pylist() for c in ("host", "print", "html"))
        for name, own, page in zip(*sent):
            found = text_marks(parse(page))
            hosts += [name] * len(found)
            prints += [own] * len(found)
            paths += found.values()
            marks += found
        return {"host": pa.array(hosts, pa.string()), "print": pa.array(prints, pa.int64()),
                "path": pa.array(paths, pa.int64()), "mark": pa.array(marks, pa.int64())}

    pages = sited.select("host", F.xxhash64("html").alias("print"), "html")
    seen = written(per_slice(pages, work, "host string, print bigint, path bigint, mark bigint", "html")
                   .distinct(), "marks")
    shown = seen.groupBy("host", "path", "mark").count().where(F.col("count") >= FIXED_PAGES)
    places = seen.select("host", "path", "print").distinct().groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= FIXED_PAGES)
    fixed = shown.join(places, ["host", "path"]).where(F.col("count") >= FIXED_SHARE * F.col("pages"))
    return fixed.groupBy("host").agg(F.collect_list("mark").alias("marks"))


def _aligned(trees: Iterator[tuple[tuple, Node]], held: dict) -> None:
    for key, tree in trees:
        held[key] = align(held[key], tree) if key in held else tree


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, pattern, paths, marks): the wrapper of each template of a host, inferred from
    all its pages, the paths of its article and the marks of its fixed texts.

    Tasks align the pages they have, template by template, then the partial wrappers of a template
    are aligned in two steps, so a busy host is never one task's. A wrapper grows with the variety
    of a template's pages, not with their number.
    """
    sited = host(pages).where("html != ''")
    fixed = written(fixed_texts(sited), "fixed-texts")
    both = sited.join(fixed.withColumnRenamed("host", "of"), sited["host"] == F.col("of"), "left").select(
        "host", "template", "html", "marks")
    schema = "host string, template string, dealt int, tree string"

    def out(held: dict) -> pa.RecordBatch:
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([crc32(_rows(held[k]).encode()) % DEALT for k in keys], pa.int32()),
             pa.array([_rows(held[k]) for k in keys], pa.string())],
            names=["host", "template", "dealt", "tree"])

    def partial(batches):
        sys.setrecursionlimit(DEEPEST_CALLS)
        held: dict[tuple, Node] = {}
        for batch in batches:
            for part in slices(batch, "html"):
                rows = (part.column(c).to_pylist() for c in ("host", "template", "html", "marks"))
                _aligned((((h, t), as_wrapper(parse(page), frozenset(marks or ())))
                          for h, t, page, marks in zip(*rows)), held)
                if len(held) >= HELD:
                    yield out(held)
                    held.clear()
        if held:
            yield out(held)

    def merged(rows: pa.Table) -> Node:
        sys.setrecursionlimit(DEEPEST_CALLS)
        held: dict[tuple, Node] = {}
        _aligned((((), _tree(t)) for t in sorted(rows.column("tree").to_pylist())), held)
        return held[()]

    def some(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.table({"host": pa.array([key[0].as_py()]), "template": pa.array([key[1].as_py()]),
                         "dealt": pa.array([0], pa.int32()), "tree": pa.array([_rows(merged(rows))])})

    def whole(key: tuple, rows: pa.Table) -> pa.Table:
        wrapper = merged(rows)
        return pa.table({"host": pa.array([key[0].as_py()]), "template": pa.array([key[1].as_py()]),
                         "pattern": pa.array([wrapper.pattern()]),
                         "paths": pa.array([[n.path for n in region(wrapper)]], pa.list_(pa.int64())),
                         "marks": pa.array([fixed_marks(wrapper)], pa.list_(pa.int64()))})

    ship(pages.sparkSession)
    parts = both.mapInArrow(partial, schema).groupBy("host", "template", "dealt").applyInArrow(some, schema)
    return parts.groupBy("host", "template").applyInArrow(
        whole, "host string, template string, pattern string, paths array<bigint>, marks array<bigint>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (main text; empty if none) and n_chars, one row per row of ``pages``.

    Blocks are decoded, white space inside a block is one space, and blocks are joined by a
    newline. Null or empty html gives empty text; so does a page without text outside menus and
    the like. Pages without a readable url are one host. Text that FIXED_SHARE of a host's
    different pages show at the same place, FIXED_PAGES at least, is part of the frame and goes,
    also inside the article, unless it is half of a page's text. Repeated rows and null page_ids
    stand for themselves, and equal pages count once. Broken or cut-off html is read as far as it
    goes; pages of any length and depth are read whole. Extra columns play no part.
    """
    found = written(infer_wrappers(pages), "wrappers").select(
        F.col("host").alias("of"), F.col("template").alias("kind"), "paths", "marks")
    sited = host(pages)
    both = sited.join(found, (sited["host"] == found["of"]) & (sited["template"] == found["kind"]), "left").select(
        "page_id", "url", "html", "paths", "marks")

    def work(batch: pa.RecordBatch) -> dict:
        sys.setrecursionlimit(DEEPEST_CALLS)
        rows = (batch.column(c).to_pylist() for c in ("html", "paths", "marks"))
        texts = [main_text(page, None, paths, frozenset(marks or ())) for page, paths, marks in zip(*rows)]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return per_slice(both, work, "page_id bigint, url string, text string, n_chars bigint", "html")
