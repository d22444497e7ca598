"""Main-text extraction from raw HTML by scoring the element tree.

Each page is read once into a tree of elements and text blocks; boilerplate elements (menus, headers and footers of
the page, controls of forms, scripts, styles) are cut by element name or role. Forms and objects, which some pages stand in whole, are
cut like elements named as boilerplate. Elements named as boilerplate by the head word of a
class or id (sidebars, notices, adverts, comments) score less, and are cut if most of their text is links, or if all
elements of that name hold at most half of the page's unlinked text; more is cut only as a discussion beside an article.
Names of states (has-sidebar) and ids of headings and sections, which are slugs of their titles (but for the id
"comments" outside an article), cut nothing, and a name of content beside that of boilerplate keeps the element. Each remaining paragraph-like block passes points to its ancestors, one plus one a comma plus one a hundred
characters (three at most): all to the parent, half to the grandparent, a third and less further up. An ancestor's
score is discounted by its link density, the share of its text inside links. The best container is kept together with
those siblings that score near it, that have its name and class (sections of one article), that are paragraphs,
headings, lists, quotations or tables, if most of their text is not links, or other sections without any link or name of
boilerplate (leads, headlines), unless they are legal lines; a title above is kept if there is no other.
The blocks of all these, in page order, are the text. White space within a block becomes one space, and blocks are joined by one space.

This reader is a plain tokeniser with the parts of HTML's rules that matter here: void elements, implied ends of
the head, paragraphs, list items, parts of tables and options, raw text of scripts and styles, comments, and ends of
elements that were never begun. Boilerplate elements end by the same rules as others. It runs inside tasks, page by page; nothing is shuffled.

Edge cases: null, empty, or text-free html gives the empty text; html without any element is one block; unclosed and
crossing elements are accepted; very long pages are read in linear time; repeated rows give repeated rows; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import small_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")
#: Element names by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("aside audio button canvas datalist dialog embed footer head iframe input map menu nav noframes noscript option script select style svg template textarea title video".split())
#: Cut like elements named as boilerplate, since pages may stand in them whole.
WRAPPERS = frozenset("form object".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
#: An element of the key closes an open element of the value, unless one of the third kind lies between.
CLOSES = {
    **{k: (("p",), ("table", "button", "td", "th", "object")) for k in BLOCKS - {"br", "option", "html", "body", "tr", "td", "th", "tbody", "thead", "tfoot", "legend", "summary"}},
    "li": (("li", "p"), ("ul", "ol", "menu")),
    "dt": (("dt", "dd", "p"), ("dl",)),
    "dd": (("dt", "dd", "p"), ("dl",)),
    **{k: (("caption", "colgroup", "tbody", "thead", "tfoot", "tr", "td", "th", "p"), ("table",)) for k in ("tbody", "thead", "tfoot")},
    "tr": (("caption", "colgroup", "tr", "td", "th", "p"), ("table",)),
    "td": (("td", "th", "p"), ("tr", "table")),
    "th": (("td", "th", "p"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
TABLE = frozenset("tbody thead tfoot tr td th".split())
HEAD = frozenset("base bgsound head link meta noscript script style template title".split())  # do not end the head
#: Words of a class or id, or roles, that mark boilerplate, and those that mark content.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs combx comment comments commentlist community consent cookie cookies copyright disqus disclaimer dialog foot footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended related remark replies reply search share sharing shoutbox sidebar side signup skip social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
CONTENT = frozenset("article articlebody body content entry hentry main maincontent page post story text".split())
#: Words before which a name's head does not matter, and those that may follow its head.
STATES = frozenset("no has have with without hide show is".split())
TAILS = frozenset("area areas articles bar block blocks bottom box button buttons card center column container content count footer form group holder icons inner item items label left line link links list main module outer panel posts region right row section slot stories text title toggle top unit wrap wrapper zone".split())
TALK = frozenset("combx comment comments commentlist disqus remark replies reply shoutbox".split())
#: Names of boilerplate that say where a heading or paragraph stands, not what it is.
PLACES = frozenset("banner breadcrumb copyright disclaimer foot footer header masthead notice notices remark search side social tags".split())
#: Elements that belong to the container beside them.
PARTS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol dl table figure".split())
SECTIONS = frozenset("div section header hgroup figure center".split())
LEGAL = re.compile(r"©|\bcopyright\b|\(c\)\s*\d{4}|all rights reserved", re.I)
ARTICLE = 250  # characters of unlinked text
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog note toolbar".split())
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


NONE: frozenset[str] = frozenset()


class Node:
    __slots__ = ("children", "classes", "commas", "dropped", "links", "name", "noise", "parent", "score", "size", "weight")

    def __init__(self, name: str, parent: Node | None, weight: float = 0.0):
        self.name, self.parent, self.weight = name, parent, weight
        self.children: list[Node | str] = []
        self.noise: frozenset[str] = NONE
        self.dropped = False  # open, but with all that is in it not part of the tree
        self.score = 0.0
        self.classes = ""
        self.size = self.links = self.commas = 0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _boilerplate(name: str, attrs: dict[str, str], inside: set[str]) -> bool:
    if name in DROPPED or name == "label" and "form" in inside or "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    if name == "header":
        return "article" not in inside and "main" not in inside
    if name == "form" and attrs.get("role", "").lower() == "form":
        return False
    return name not in ("html", "body", "article", "main") and attrs.get("role", "").lower() in ROLES


@lru_cache(maxsize=4096)
def _names(classes: str, id_: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """Boilerplate words that are the heads of classes, those of the id, and whether a class or the id names content."""

    def head(name: str) -> str:
        words = [w.lower() for w in WORD.findall(name)]
        if STATES & set(words[:-1]):
            return ""
        while len(words) > 1 and (words[-1] in TAILS or words[-1].isdigit()) and words[-1] not in NOISE:
            words.pop()
        if len(words) > 1 and words[-1] in TAILS & NOISE and words[-2] in NOISE:
            words.pop()
        return words[-1] if words else ""

    def content(name: str) -> bool:
        words = {w.lower() for w in WORD.findall(name)}
        return bool(words & CONTENT) and head(name) not in NOISE

    of_class = frozenset(head(c) for c in classes.split()) & NOISE
    return of_class, frozenset([head(id_)]) & NOISE, any(content(x) for x in [*classes.split(), id_])


def _noise(name: str, attrs: dict[str, str], inside: bool) -> tuple[frozenset[str], float]:
    """The boilerplate words that may cut an element, and the points its names give it."""
    of_class, of_id, content = _names(attrs.get("class", ""), attrs.get("id", ""))
    heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
    points = 25.0 * content - 25.0 * bool(of_class or of_id and not heading)
    if content or name in ("html", "body", "article", "main", "b", "i", "em", "strong", "a"):
        return NONE, points
    if heading or name == "p":
        return of_class - PLACES, points
    slug = name == "section" or "section" in attrs.get("class", "").split()
    if slug and not inside and attrs.get("id", "").lower() in TALK:
        slug = False
    return of_class if slug else of_class | of_id, points


def tree(html: str) -> Node:
    """The page's elements and raw text, without boilerplate."""
    root = node = Node("#root", None)
    open_: list[Node] = [root]
    inside: dict[str, int] = {}
    at = skip = 0
    lower: str | None = None
    n = len(html)

    def close(k: int) -> None:
        for gone in open_[k:]:
            inside[gone.name] -= 1
        del open_[k:]

    while at < n:
        m = TOKEN.search(html, at)
        text = html[at : m.start() if m else n]
        if text:
            if node.name == "head" and text.strip():
                close(len(open_) - 1)
                node = open_[-1]
            if not node.dropped:
                node.children.append(text)
        if not m:
            break
        at = m.end()
        end, name, attrs = m[1], m[2], m[3]
        if name:
            name = name.lower()
            if node.name == "head" and name not in HEAD:
                close(len(open_) - 1)
                node = open_[-1]
            if name in VOID:
                if not node.dropped and name in ("br", "hr"):
                    node.children.append(Node(name, node))
                continue
            if name in RAW:
                lower = html.lower() if lower is None else lower
                stop = lower.find(f"</{name}", at) if len(lower) == n else html.find(f"</{name}", at)
                at = n if stop < 0 else stop
                skip = html.find(">", at)
                at = n if skip < 0 or stop < 0 else skip + 1
                continue
            if attrs.rstrip().endswith("/") and name in ("svg", "path"):
                continue
            rule = CLOSES.get(name)
            if rule and any(inside.get(x) for x in rule[0]):
                across = name in TABLE and inside.get("table")
                last = 0
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k].name in rule[0]:
                        last = k
                    elif open_[k].name in rule[1] or not across and open_[k].name in ("div", "article", "section", "main", "body"):
                        break
                if last:
                    close(last)
                    node = open_[-1]
            child = Node(name, node)
            if node.dropped:
                child.dropped = True
            else:
                a = _attributes(attrs) if attrs.strip() else {}
                within = {k for k in ("article", "main", "form") if inside.get(k)}
                if _boilerplate(name, a, within):
                    child.dropped = True
                else:
                    child.classes = a.get("class", "")
                    child.noise, points = _noise(name, a, bool(within - {"form"})) if a else (NONE, 0.0)
                    if name in WRAPPERS:
                        child.noise |= {name}
                    child.weight = 25.0 * ((a.get("role") == "main") + 2 * (name in ("article", "main")) + (a.get("itemprop") == "articleBody")) + points
                    node.children.append(child)
            open_.append(child)
            inside[name] = inside.get(name, 0) + 1
            node = child
        elif end:
            end = end.lower()
            if inside.get(end):
                k = len(open_) - 1
                while open_[k].name != end:
                    k -= 1
                # The end of a stray inline element does not end a dropped block that it crosses.
                if end in BLOCKS or open_[k].dropped or not node.dropped:
                    close(k)
                    node = open_[-1]
            elif end in ("body", "html") and node.dropped:
                close(next(k for k, x in enumerate(open_) if x.dropped))
                node = open_[-1]
    return root


def _walk(root: Node) -> list[Node]:
    """All elements, parents first."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node))
    return out


def _blocks(node: Node) -> list[str]:
    """Texts of the node's blocks, in page order."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        if text:
            out.append(text)
        parts.clear()

    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            parts.append(x)
        elif x.name in BLOCKS:
            flush()
            todo.append(None)
            todo.extend(reversed(x.children))
        else:
            todo.extend(reversed(x.children))
    flush()
    return out


def _measured(root: Node) -> list[Node]:
    """All elements, parents first, with the sizes of their texts, of the links in these, and their commas."""
    nodes = _walk(root)
    for x in reversed(nodes):
        x.size = x.links = x.commas = 0
        for c in x.children:
            if isinstance(c, Node):
                x.size += c.size
                x.links += c.size if c.name == "a" else c.links
                x.commas += c.commas
            else:
                x.size += len(c.strip())
                x.commas += c.count(",")
    return nodes


def _without_noise(root: Node, nodes: list[Node]) -> list[Node]:
    """Cuts the elements that are named as boilerplate and whose sizes agree; the page as it is if nothing else is there."""
    under: dict[int, frozenset[str]] = {id(root): NONE}
    total: dict[str, int] = {}  # unlinked text in the outermost elements of a name
    for x in nodes[1:]:
        above = under[id(x.parent)]
        for w in x.noise - above:
            total[w] = total.get(w, 0) + x.size - x.links
        under[id(x)] = above | x.noise if x.noise else above
    if not total:
        return nodes
    page = root.size - root.links
    cut = {w for w, n in total.items() if 2 * n <= page or w in TALK and page - n >= max(ARTICLE, page // 10)}
    gone: list[tuple[Node, list[Node | str]]] = []
    for x in nodes:
        left = [c for c in x.children if not (isinstance(c, Node) and c.noise and (c.noise & cut or 2 * c.links > c.size))]
        if len(left) < len(x.children):
            gone.append((x, x.children))
            x.children = left
    now = _measured(root)
    if not root.size:
        for x, children in gone:
            x.children = children
        now = _measured(root)
    return now


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = tree(html)
    nodes = _without_noise(root, _measured(root))
    scored: list[Node] = []
    for x in nodes:
        own = x.name in PARAGRAPHS or (x.name not in ("a", "#root") and any(isinstance(c, str) and len(c.strip()) > 24 for c in x.children) and x.name in BLOCKS)
        if not own or x.size < 10 or (x.parent and x.name not in ("p", "pre", "blockquote") and x.parent.name in PARAGRAPHS):
            continue
        points = 1 + x.commas + min(x.size // 100, 3)
        points *= 1 - x.links / max(x.size, 1)
        up, level = (x if x.name not in PARAGRAPHS else x.parent), 0
        while up is not None and level < 6:
            if up.score == 0.0:
                up.score = up.weight or 1e-9
                scored.append(up)
            up.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            up, level = up.parent, level + 1
    if not scored:
        return " ".join(_blocks(root))
    value = {id(x): x.score * (1 - x.links / max(x.size, 1)) for x in scored}
    best = max(scored, key=lambda x: (value[id(x)], x.size))
    least = max(10.0, 0.2 * value[id(best)])

    def belongs(c: Node) -> bool:
        if not c.size or 2 * c.links > c.size:
            return False
        if value.get(id(c), 0) >= least or c.name in PARTS or (c.name, c.classes) == (best.name, best.classes):
            return True
        # A lead, a headline or a picture's caption in an element of its own.
        return c.name in SECTIONS and not c.links and not c.noise and not LEGAL.search("".join(_blocks(c)[:1]))

    kept = {id(c) for c in best.parent.children if isinstance(c, Node) and belongs(c)} | {id(best)} if best.parent else {id(best)}
    top = best.parent or best
    if not any(x.name == "h1" for y in top.children if id(y) in kept for x in _walk(y)):
        above = top
        while above.parent is not None:
            kept.add(id(above))
            titles = _titles(above)
            above = above.parent
            if titles:
                for x in titles:
                    while x is not above:
                        kept.add(id(x))
                        x = x.parent
                top = above
                break
    return " ".join(_kept_blocks(top, kept))


def _titles(node: Node) -> list[Node]:
    """First-level headings beside a node, or in an element before it."""
    out: list[Node] = []
    before = True
    for c in node.parent.children:
        if c is node:
            before = False
        elif isinstance(c, Node):
            out += [x for x in (_walk(c) if before and c.name in SECTIONS and not c.noise else [c]) if x.name == "h1" and x.size and 2 * x.links <= x.size]
    return out


def _kept_blocks(node: Node, kept: set[int]) -> list[str]:
    """Blocks of the kept elements, in page order; of a kept element without kept children all."""
    out: list[str] = []
    todo = [node]
    while todo:
        x = todo.pop()
        inner = [c for c in x.children if isinstance(c, Node) and id(c) in kept]
        if inner:
            todo.extend(reversed(inner))
        else:
            out += _blocks(x)
    return out


def _extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = [main_text(h) if isinstance(h, str) else "" for h in pdf["html"]]
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text and n_chars, its code points."""
    small_batches(pages.sparkSession)
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return read.mapInPandas(_extracted, "page_id long, url string, text string, n_chars long")
