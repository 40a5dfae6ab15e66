"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.buffers import slices
from tideline.llm.tables import table, whole_text

# Elements of HTML by their role.
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = set("p blockquote pre".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template svg math iframe object canvas textarea select title".split())
ASIDE = set("nav footer aside form button menu dialog fieldset label head".split()) | RAW
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SELF_CLOSING |= dict.fromkeys(("tbody", "thead", "tfoot"), {"tbody", "thead", "tfoot", "caption", "tr", "td", "th"})
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}} | dict.fromkeys(("tbody", "thead", "tfoot"), {"table"})
# Words in class and id names, and roles, of parts that are not the article.
NAMED_ASIDE = set(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead comment comments commentary disqus reply replies respond responses reviews discussion guestbook share sharing social related "
    "widget login signup toolbar pagination".split())
# Of these, what readers write: an `article` named so is a comment where the page has another one.
READERS = set("comment comments disqus reply replies respond responses reviews discussion guestbook".split())
# Words of names that say what shape a part has or where it lies, not what it is.
SHAPES = set(
    "area bar block body box button buttons card cell col column container content count entry form frame grid group head header heading holder icon icons "
    "inner item items left link links list listing main outer panel part post posts article articles right row section slot stories tile title "
    "thread top bottom unit user reader view wrap wrapper site global primary secondary section text".split())
HOLDING = set("has with no without hide show page layout".split())
WRAPPERS = set("div section span table tbody tr td center".split())  # elements that may hold a whole page
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
# A closing tag of the second kind does not reach past an open element of the first.
HOLDERS, ENDED_WITHIN = {"td", "th", "button"}, set("p b i em strong span a u small font".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?<![\w-])(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
ROLE = re.compile(r"(?<![\w-])role\s*=\s*[\"']?([\w-]+)", re.I)
HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])(?!\s*=\s*[\"']?until)|display\s*:\s*none", re.I)


class Node:
    """An element with its own pieces: text and elements in page order."""

    __slots__ = ("tag", "parent", "pieces", "aside", "holder", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None) -> None:
        self.tag, self.parent, self.pieces, self.aside = tag, parent, [], ""
        self.holder = self if parent is None or tag in HOLDERS else parent.holder
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


class Open:
    """The open elements: the innermost one, and how many of each name are open, so that no tag walks in vain."""

    def __init__(self, root: Node) -> None:
        self.root = self.node = root
        self.count: dict[str, int] = {}
        self.within: dict[tuple[int, str], int] = {}  # by the holder an element lies in

    def push(self, child: Node) -> None:
        self.count[child.tag] = self.count.get(child.tag, 0) + 1
        key = id(child.parent.holder), child.tag
        self.within[key] = self.within.get(key, 0) + 1
        self.node = child

    def leave(self, last: Node) -> None:
        """Close the elements up to and with `last`."""
        while True:
            node, self.node = self.node, self.node.parent
            self.count[node.tag] -= 1
            self.within[id(node.parent.holder), node.tag] -= 1
            if node is last:
                return

    def any(self, *tags: str) -> bool:
        return any(self.count.get(t) for t in tags)

    def reaches(self, tag: str) -> bool:
        """Whether a closing tag has an element to close."""
        if tag in ENDED_WITHIN:
            return bool(self.within.get((id(self.node.holder), tag)))
        return self.any(tag)


def names_of(attributes: str) -> Iterator[list[str]]:
    """The words of each class and id name."""
    for name in " ".join(x for m in NAMES.finditer(attributes) for x in m.groups() if x).split():
        yield [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if len(x) > 1]


def named(attributes: str, words: set[str]) -> bool:
    """Whether a name says that a part is one of `words`: its last word does, shapes and places apart.

    `has-sidebar` or `with-ads` say what a wrapper holds, `no-sidebar` what it lacks; `related-work` is work.
    """
    for parts in names_of(attributes):
        telling = [x for x in parts if x not in SHAPES]
        if telling and parts[0] not in HOLDING and telling[-1] in words:
            return True
    return False


def is_aside(tag: str, attributes: str, open_: Open) -> str:
    """How an element is a menu, notice, advert or the like: "surely" by its tag or role, "named" by class and id, "" not."""
    if tag in ASIDE:
        return "surely"
    if tag == "header":
        return "" if open_.any("article", "main") else "surely"
    if tag in ("body", "html", "main") or not attributes.strip():
        return ""
    if tag == "article":
        return "named" if named(attributes, READERS) else ""
    role = ROLE.search(attributes)
    if role and role[1].lower() in ASIDE_ROLES or HIDDEN.search(re.sub(r"=\s*(\"[^\"]*\"|'[^']*')", lambda m: m[0] if "display" in m[0] else "=", attributes)):
        return "surely"
    return "named" if named(attributes, NAMED_ASIDE) else ""


def parse(source: str) -> tuple[Node, Node]:
    """The root and the body (the root if there is none), without what is_aside rejects.

    A rejected element ends where HTML ends it, as any other does: it is read like the others and taken out afterwards.
    """
    root = Node("", None)
    open_ = Open(root)
    body, at, size = root, 0, len(source)
    while at < size:
        token = TOKEN.search(source, at)
        text = source[at: token.start() if token else size]
        if text:
            if open_.node.tag == "head" and not text.isspace():
                open_.leave(open_.node)
            open_.node.pieces.append(html.unescape(text))
        if not token:
            break
        at = token.end()
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if open_.reaches(tag):
                up = open_.node
                while up.tag != tag:
                    up = up.parent
                open_.leave(up)
            continue
        if open_.node.tag == "head" and tag not in IN_HEAD:
            open_.leave(open_.node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            if not attributes.endswith("/") or tag in ("script", "style", "title", "textarea"):
                at = end.end() if end else size
            continue
        if tag in VOID:
            if not is_aside(tag, attributes, open_):
                open_.node.pieces.append(Node(tag, open_.node))
            continue
        if tag in CLOSES_P and open_.any("p"):
            up = open_.node
            while up is not root and up.tag != "p" and up.tag not in BLOCK:
                up = up.parent
            if up.tag == "p":
                open_.leave(up)
        if tag in SELF_CLOSING and open_.any(*SELF_CLOSING[tag]):
            up = open_.node
            while up is not root and up.tag not in SELF_CLOSING[tag] and up.tag not in HOLDS[tag]:
                up = up.parent
            while up.tag in SELF_CLOSING[tag]:
                open_.leave(up)
                up = open_.node
        child = Node(tag, open_.node)
        child.aside = is_aside(tag, attributes, open_)
        if child.aside and attributes.endswith("/"):
            continue
        open_.node.pieces.append(child)
        open_.push(child)
        if tag == "body" and body is root:
            body = child
    without_asides(root)
    return root, body


def without_asides(root: Node) -> None:
    """Takes out the rejected elements.

    One rejected by its name stays if it holds article or main, or most of the text of a page without
    these; so does an article named like a reader's comment where there is no other.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in node.pieces if isinstance(x, Node) and x.aside != "surely")
    held: dict[int, tuple[int, bool]] = {}
    for node in reversed(order):
        size, article = 0, node.tag in ("article", "main", "body") and not node.aside
        for x in node.pieces:
            if isinstance(x, str):
                size += len("".join(x.split()))
            elif x.aside != "surely":
                size, article = size + held[id(x)][0], article or held[id(x)][1]
        held[id(node)] = size, article
    articles = any(node.tag in ("article", "main") and not node.aside for node in order)
    most = math.inf if articles else held[id(root)][0] / 2
    for node in order:
        node.pieces = [x for x in node.pieces if isinstance(x, str) or not x.aside or (x.aside == "named" and (
            not articles if x.tag == "article" else x.tag in WRAPPERS and (held[id(x)][1] or held[id(x)][0] > most)))]


def measure(body: Node) -> list[Node]:
    """All nodes, each after its children, with characters, tags, links, density and density sum."""
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in node.pieces if isinstance(x, Node))
    order.reverse()
    for node in order:
        for x in node.pieces:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            else:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.link_chars
                node.link_tags += x.link_tags
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    all_chars, all_links = max(body.chars, 1), body.link_chars
    for node in order:
        if node.chars:
            tags, plain = max(node.tags, 1), max(node.chars - node.link_chars, 1)
            inner = node.chars / max(node.link_chars, 1) * tags / max(node.link_tags, 1)
            base = math.log(node.chars / plain * node.link_chars + all_links / all_chars * node.chars + math.e)
            node.density = node.chars / tags * max(math.log(max(inner, 1.0)), 0.0) / base
        node.total = sum(x.density for x in node.pieces if isinstance(x, Node))
    return order


def main_parts(body: Node) -> list[Node]:
    """The subtree of the greatest density sum, and what lies beside the way to the body and is as dense as its least dense node."""
    order = measure(body)
    best = max(reversed(order), key=lambda n: n.total)
    if best is body or best.total == 0:
        return [body]
    up, enclosing = best, None
    while up is not None and up is not body:
        if up.tag in ("article", "main"):
            enclosing = up
        up = up.parent
    if enclosing is not None:
        return [enclosing]
    threshold, path, up = best.density, {id(best)}, best.parent
    while up is not body.parent:
        threshold = min(threshold, up.density)
        path.add(id(up))
        up = up.parent
    return [beside(body, best, path, threshold)]


def beside(node: Node, best: Node, path: set[int], threshold: float) -> Node:
    """A copy of a node on the way to the best one, with what belongs to it of what lies beside the way.

    These are parts as dense as the threshold, prose and inline text without links, and the headings
    before any of it.
    """
    top = copy = Node(node.tag, None)
    while node is not best:
        onward, heading = None, []
        for x in node.pieces:
            if isinstance(x, Node) and x.tag in HEADINGS and id(x) not in path:
                heading.append(x)
            elif isinstance(x, str) or id(x) in path or x.density >= threshold or (not x.link_chars and (x.tag in PROSE or x.tag not in BLOCK)):
                if isinstance(x, Node) and (x.chars or id(x) in path):
                    copy.pieces += heading
                    heading = []
                if isinstance(x, Node) and id(x) in path and x is not best:
                    onward, x = x, Node(x.tag, copy)
                    inner = x
                copy.pieces.append(x)
        if onward is None:
            break
        node, copy = onward, inner
    return top


def blocks_of(parts: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space as single spaces, without empty ones."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    for part in parts:
        close()
        stack: list[tuple[Node, int]] = [(part, 0)]
        while stack:
            node, at = stack.pop()
            if at == len(node.pieces):
                if node.tag in BLOCK:
                    close()
                continue
            stack.append((node, at + 1))
            x = node.pieces[at]
            if isinstance(x, str):
                run.append(x)
            elif x.tag == "br":
                run.append(" ")
            else:
                if x.tag in BLOCK:
                    close()
                stack.append((x, 0))
    close()
    return out


def main_text(source: str) -> str:
    if not source:
        return ""
    _, body = parse(source)
    return "\n".join(blocks_of(main_parts(body)))


def run_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(x) for x in pc.fill_null(batch.column("html"), "").to_pylist()]
        yield pa.record_batch({
            "page_id": batch.column("page_id"), "url": batch.column("url"),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(x) for x in texts], pa.int64())})


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of (page_id, url, html): page_id, url, text, n_chars.

    Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments go
    by element, role, or the words of class and id. Each node left has its characters per tag,
    adjusted for links, and the sum of these densities over its children; the node of the greatest
    sum is the article, widened to an enclosing `article` or `main`, or else to siblings no less dense
    than the least dense node between it and the body. Blocks are joined by a line feed, white
    space within them is one space, `br` is white space. A null or empty html gives an empty text.
    Pages are read one by one, so repeated rows give repeated results and no page is cut.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", whole_text("html").alias("html")).mapInArrow(
        run_pages, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
