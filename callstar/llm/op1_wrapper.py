"""Main text of web pages by wrapper induction.

For each host a bounded sample of its pages is aligned by simple tree matching
into one template. A text that fills the same node in (nearly) all sampled
pages is template; nodes whose texts differ are slots. The content region is
the smallest container that holds all of the slot text outside menus, headers,
footers, sidebars, notices, adverts, forms and comments. Every page of the host
is then aligned with the template: what the region's nodes hold, without
template texts and without parts of those roles, is the main text.

A host without template (one page, or pages that do not align) falls back to
the page's own region by the same rule.

Only the sample is bounded (``SAMPLE`` pages a host); every page is extracted
from its whole html, and a host with most of the pages is split among tasks.

Defined cases: null or empty html gives an empty text; a null or odd url is the
host ``''``; broken markup is closed as browsers close it; character references
are decoded, unknown ones stay; repeated rows are extracted once each; very long
pages are read whole; elements nested below ``DEEPEST`` levels count as blocks
of the level above; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callstar.llm.common import stage, with_row_id

#: Pages of a host that its template is induced from.
SAMPLE = 8
#: Share (and number) of sampled pages in which a text makes it template.
CONSTANT_SHARE = 0.8
CONSTANT_PAGES = 4
#: Hosts up to which the templates (a few kB each) are broadcast; beyond, they are joined by a shuffle.
BROADCAST_HOSTS = 5_000
BROADCAST_ROWS = 1 << 20
#: Levels of a page's tree; elements nested deeper count as blocks of the one above them.
DEEPEST = 200

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
SILENT = {"head", "script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "map",
          "select", "option", "button", "textarea", "dialog", "menu"}
ROLE_TAGS = {"nav", "header", "footer", "aside", "form"} | SILENT
#: A page's own frame is never a side part, whatever its classes say.
WHOLE = {"html", "body", "main", "article"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "blockquote", "td", "th", "tr", "figcaption", "caption"}
#: Words in class, id or role that mark a part which is not main text.
ROLE_WORDS = {"ad", "ads", "adv", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "popup", "modal",
              "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "sidebar", "side", "aside",
              "header", "masthead", "topbar", "footer", "foot", "copyright", "legal", "cookie", "cookies", "consent", "gdpr", "notice", "alert",
              "newsletter", "subscribe", "signup", "login", "search", "form", "comment", "comments", "commentlist", "reply", "replies", "disqus",
              "respond", "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "skip", "hidden", "complementary", "contentinfo"}
#: Tags that an opening tag of the key closes, up to the limit tags.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "key", "role", "kids")

    def __init__(self, tag: str, key: str, role: bool):
        self.tag, self.key, self.role, self.kids = tag, key, role, []


class Builder(HTMLParser):
    """Block tree of a page; inline tags melt into the text around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", "html", False)
        self.stack = [self.root]
        self.deep: list[tuple[str, bool]] = []  # open elements below the deepest level: tag, role
        self.deep_tags: Counter = Counter()

    def _leave_deep(self, to: int) -> None:
        for tag, role in self.deep[to:]:
            self.deep_tags[tag] -= 1
            self.deep_tags[None] -= role
        del self.deep[to:]
        self.stack[-1].kids.append(Node("hr", "hr", False))

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "hr"):
                self.stack[-1].kids.append(" " if tag == "br" else Node("hr", "hr", False))
            return
        names = [v for k, v in attrs if k in ("class", "id", "role") and v]
        words = {w for v in names for w in _WORD.findall(v.lower())}
        role = tag in ROLE_TAGS or tag not in WHOLE and not words.isdisjoint(ROLE_WORDS)
        if tag in INLINE and not role:
            return
        if tag in ("html", "body") and any(n.tag == tag for n in self.stack[1:]) or tag == "html":
            return
        if len(self.stack) > DEEPEST:
            self.deep.append((tag, role))
            self.deep_tags.update([tag, None] if role else [tag])
            self.stack[-1].kids.append(Node("hr", "hr", False))
            return
        if tag in CLOSES:
            closed, limits = CLOSES[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in limits:
                    break
                if self.stack[i].tag in closed:
                    del self.stack[i:]
                    break
        if tag not in INLINE and self.stack[-1].tag == "p":
            self.stack.pop()  # a paragraph ends where a block begins
        if tag == "body" and self.stack[-1].tag == "head":
            self.stack.pop()
        node = Node(tag, ".".join([tag, *sorted(words)]), role)
        self.stack[-1].kids.append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        if self.deep_tags[tag] > 0:
            to = len(self.deep) - 1
            while self.deep[to][0] != tag:
                to -= 1
            return self._leave_deep(to)
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                if self.deep:
                    self._leave_deep(0)
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self.stack[-1].role and not self.deep_tags[None]:
            self.stack[-1].kids.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def own_blocks(node: Node) -> list[str]:
    """The node's direct texts, as blocks between its child nodes."""
    out, run = [], []
    for kid in [*node.kids, None]:
        if isinstance(kid, str):
            run.append(kid)
        else:
            text = _SPACE.sub(" ", "".join(run)).strip()
            if text:
                out.append(text)
            run = []
    return out


def digest(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) << 20 | len(text) & 0xFFFFF


class Shape:
    """A node with its same-keyed sisters melted into one: what tree matching compares."""

    __slots__ = ("key", "tag", "role", "kids", "texts", "mass", "pages", "nodes")

    def __init__(self, key: str, tag: str, role: bool):
        self.key, self.tag, self.role = key, tag, role
        self.kids, self.texts, self.mass, self.pages, self.nodes = [], {}, 0, 1, []


def shape(nodes: list[Node]) -> Shape:
    out = Shape(nodes[0].key, nodes[0].tag, nodes[0].role)
    out.nodes = nodes
    groups: dict[str, list[Node]] = {}
    for node in nodes:
        for text in own_blocks(node):
            out.texts[digest(text)] = 1
            out.mass += len(text)
        for kid in node.kids:
            if isinstance(kid, Node):
                groups.setdefault(kid.key, []).append(kid)
    out.kids = [shape(g) for g in groups.values()]
    return out


def tree_match(a: Shape, b: Shape) -> tuple[int, list]:
    """Simple tree matching: the size of the largest order-keeping match, and the matched pairs of children."""
    if a.key != b.key:
        return 0, []
    n, m = len(a.kids), len(b.kids)
    weight = [[tree_match(x, y)[0] if x.key == y.key else 0 for y in b.kids] for x in a.kids]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight[i][j])
    pairs, i, j = [], n, m
    while i and j:
        if weight[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + weight[i - 1][j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[n][m] + 1, pairs[::-1]


def absorb(template: Shape, page: Shape) -> None:
    """Align a page with the template and add its texts and new nodes."""
    template.pages += page.pages
    template.mass += page.mass
    for d, n in page.texts.items():
        template.texts[d] = template.texts.get(d, 0) + n
    _, pairs = tree_match(template, page)
    matched = {j: i for i, j in pairs}
    kids, at = list(template.kids), 0
    for j, kid in enumerate(page.kids):
        if j in matched:
            absorb(template.kids[matched[j]], kid)
            at = kids.index(template.kids[matched[j]]) + 1
        else:
            kids.insert(at, kid)
            at += 1
    template.kids = kids


def slot_mass(node: Shape, pages: int) -> float:
    """Text of a subtree that is neither template nor of another role."""
    if node.role:
        return 0.0
    constant = sum(n for n in node.texts.values() if is_constant(n, pages))
    own = node.mass * (1 - constant / max(1, sum(node.texts.values())))
    return own + sum(slot_mass(k, pages) for k in node.kids)


def is_constant(n: int, pages: int) -> bool:
    return n >= CONSTANT_PAGES and n >= CONSTANT_SHARE * pages


def region(root: Shape) -> list[str]:
    """Keys from the root down to the smallest container of all slot text (or an article or main that is it)."""
    total, node, path = slot_mass(root, root.pages), root, [root.key]
    while node.tag not in ("article", "main"):
        inner = [k for k in node.kids if k.tag not in LEAVES and not k.role and slot_mass(k, root.pages) > total - 0.5]  # less than a character outside
        if not total or not inner:
            break
        node = inner[0]
        path.append(node.key)
    return path


def induce(pages: list[str]) -> str:
    """Template of sampled pages, as JSON: the tree, its template texts, and the path of the region."""
    shapes = [shape([parse(h)]) for h in dict.fromkeys(pages) if h]  # copies of a page show no slots
    if not shapes:
        return ""
    template = shapes[0]
    for s in shapes[1:]:
        absorb(template, s)

    def plain(node: Shape) -> list:
        return [node.key, [d for d, n in node.texts.items() if is_constant(n, template.pages)], [plain(k) for k in node.kids]]

    return json.dumps([plain(template), region(template)])


def restore(tree: list) -> Shape:
    out = Shape(tree[0], tree[0].split(".")[0], False)
    out.texts = dict.fromkeys(tree[1], 1)
    out.kids = [restore(k) for k in tree[2]]
    return out


def collect(node: Node, constant: dict[int, set], out: list[str]) -> None:
    """Blocks of a node in page order, without other roles and template texts."""
    fixed = constant.get(id(node), ())
    run: list[str] = []

    def flush():
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text and digest(text) not in fixed:
            out.append(text)
        run.clear()

    for kid in node.kids:
        if isinstance(kid, str):
            run.append(kid)
            continue
        flush()
        if not kid.role or kid.tag == "header" and any(isinstance(k, Node) and k.tag == "h1" for k in kid.kids):
            collect(kid, constant, out)
    flush()


def extract(html: str | None, template: tuple[Shape, list[str]] | None) -> str:
    if not html:
        return ""
    page = shape([parse(html)])
    constant: dict[int, set] = {}
    path = None
    if template:
        found, roots = [page], []

        def align(model: Shape, node: Shape) -> None:
            for n in node.nodes:
                constant[id(n)] = model.texts.keys()
            for i, j in tree_match(model, node)[1]:
                align(model.kids[i], node.kids[j])

        align(template[0], page)
        path = template[1]
    for keys in ([path] if path else []) + [region(page)]:
        found = [page] if page.key == keys[0] else []
        for key in keys[1:]:
            found = [k for s in found for k in s.kids if k.key == key]
        out: list[str] = []
        for s in found:
            for node in s.nodes:
                collect(node, constant, out)
        if out:
            return "\n\n".join(out)
    return ""


def host(url):
    """Lower-cased host of a url column; '' if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages`` (a file scan)."""
    rows = with_row_id(pages.select("page_id", "url", "html"), "uid").withColumn("host", host(F.col("url")))
    order = Window.partitionBy("host").orderBy(F.xxhash64("uid"), "uid")
    drawn = stage(rows.select("uid", "host").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= SAMPLE).select("uid"), "drawn")
    sample = rows.select("uid", "host", "html").join(F.broadcast(drawn) if drawn.count() <= BROADCAST_ROWS else drawn, "uid")

    def templates(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid")
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "template": [induce([h for h in frame["html"] if h])]})

    wrappers = stage(sample.groupBy("host").applyInPandas(templates, "host string, template string"), "wrappers")
    matched = rows.join(F.broadcast(wrappers) if wrappers.count() <= BROADCAST_HOSTS else wrappers, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple | None] = {}
        for batch in batches:
            out = []
            for html, text in zip(batch.column(2), batch.column(3)):
                text = text.as_py()
                if text not in known:
                    if len(known) > 256:
                        known.clear()
                    tree = json.loads(text) if text else None
                    known[text] = (restore(tree[0]), tree[1]) if tree else None
                out.append(extract(html.as_py(), known[text]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    texts = matched.select("page_id", "url", "html", "template").mapInArrow(run, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
