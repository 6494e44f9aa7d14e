"""Main text of web pages by tree scoring (operator 8).

A page is read into a tree (missing end tags implied, scripts and comments
skipped, character references decoded). Paragraphs pass points for their
length and commas to their ancestors, less with every level; a container's
sum is discounted by its link density. The best container is kept, widened to
the article element around it, together with siblings that score a tenth of
it. Where no element or name tells the main text, every sibling of few links
stays with it: lists, tables, sections, loose text. What is a menu, header,
footer, sidebar, notice, advert, form or comment by its element, role, class or
id is left out wherever it stands; only an article's own header, inside it and
with a heading and few links, is text. A
class, an id or a form alone does not take out a heading, what holds an
article or main element, or a third of the page's unlinked text: these stay
in the scoring, for a part of their points, and go only if the best container
lies elsewhere. ``has-``, ``no-`` and ``with-`` before a name, and ids made
from a section's own title, mark nothing.

Blocks are joined in page order by one line break; white space inside a block
becomes one space. Nothing else is dropped.

Defined cases: null and empty pages, and pages without visible text, give an
empty text. Unclosed tags end with their parent, an unclosed comment or
script with the page, a cut-off tag at the end is dropped. If leaving out
by class or id leaves no text, only elements and roles count (a form without
an article, main element or third of the text still goes). Nesting may be
any depth; the time is linear in the page (but for a logarithm in the nesting
of lists and tables). Equal pages give equal texts. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>?|<[/a-zA-Z][^>]*+\Z|[^<]++|<""",
    re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody "
    "td tfoot th thead tr ul".split())
DROP = frozenset(
    "aside audio button canvas dialog embed footer head header iframe input menu nav noscript object script search select "
    "style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
#: Words that mark boilerplate in a class or id, as a whole part of the name.
PARTS = frozenset(
    "ad ads adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent copyright disclaimer disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "outbrain overlay pager pagination popup promo promoted promotion related recommended replies respond share sharing sidebar sidenav "
    "signup skip social sponsor sponsored subscribe subscription taboola tags toolbar topbar widget widgets".split())
#: The marks of readers' answers, which can be longer than the article.
ANSWERS = frozenset("comment comments commentlist disqus replies respond".split())
#: Words before a mark that make it a property of a layout.
MODIFIERS = frozenset("has no non not with without".split())
#: Second words of ids that name a collection, not a title.
COLLECTIONS = frozenset("area articles block box content items links list news posts section stories wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: From this share of the page's unlinked text, and so many characters, an element is not cut by its name.
LEAST_SHARE = 1 / 3
LEAST_SHARE_CHARS = 140
MOST_LINKED = 0.3
#: Part of the points that is left to a text under a mark, and under a mark of answers.
UNDER_MARK = 0.25
UNDER_ANSWERS = 0.05
#: Siblings of this part of the best container's points belong to it.
SIBLING = 0.1
#: Words that mark the main text's container, and elements that are parts of a larger one.
CONTENT = frozenset("article content entry main post story".split())
PART = frozenset("tr td th tbody thead tfoot caption li ul ol dl dt dd table p".split())
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements that end an open element of the same group, up to the nearest of the bounds.
_ENDS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
         "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
         "option": ("option", ("select",)), "tbody": ("tbody thead tfoot tr td th", ("table",)),
         "thead": ("tbody thead tfoot tr td th", ("table",)), "tfoot": ("tbody thead tfoot tr td th", ("table",))}
_PARAGRAPH = frozenset("p pre blockquote td dd".split())
COMMAS = ",،，、"
LEAST_PARAGRAPH = 25
LEVELS = 5


class Node:
    __slots__ = ("tag", "attrs", "up", "kids", "chars", "linked", "score", "mark", "weight", "plain", "holds", "commas", "lead")

    def __init__(self, tag: str, attrs: str, up: Node | None):
        self.tag, self.attrs, self.up, self.kids = tag, attrs, up, []
        self.chars = self.linked = self.plain = self.commas = 0
        self.lead = False
        self.score, self.weight = 0.0, 1.0
        self.mark, self.holds = "", ""


def parse(page: str) -> Node:
    """The page's tree; texts are kids of type str, decoded.

    ``path`` holds the open elements and ``depths`` their places by tag, so
    that each tag finds what it ends without walking the open elements.
    """
    root = Node("#root", "", None)
    path: list[Node] = [root]
    depths: dict[str, list[int]] = {}
    pos, n = 0, len(page)

    def close(depth: int) -> None:
        while len(path) > depth:
            depths[path.pop().tag].pop()

    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                path[-1].kids.append(html.unescape(m[0]))
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if depths.get(tag):
                close(depths[tag][-1])
            continue
        if tag in BLOCK and depths.get("p"):
            close(depths["p"][-1])  # a block element ends an open paragraph
        if tag in _ENDS:
            group, bounds = _ENDS[tag]
            bound = max((depths[t][-1] for t in bounds if depths.get(t)), default=0)
            ended = [d[bisect_right(d, bound)] for d in map(depths.get, group.split()) if d and d[-1] > bound]
            if ended:
                close(min(ended))
        attrs = m[3] if m[2] else m[6]
        node = Node(tag, attrs, path[-1])
        path[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, pos)
            pos = n if end is None else end.start()
            if end is not None:
                shut = page.find(">", pos)
                pos = n if shut < 0 else shut + 1
        elif tag not in VOID and not (attrs.endswith("/") and tag not in BLOCK and tag != "a"):
            depths.setdefault(tag, []).append(len(path))
            path.append(node)
    return root


def _attributes(node: Node) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in reversed(_ATTRIBUTE.findall(node.attrs))}


def _parts(name: str) -> list[str]:
    return [p.lower() for p in _NAME_PART.findall(name)]


def boilerplate(node: Node, by_name: bool) -> bool:
    """Whether an element goes with all it holds; sets ``mark`` where only its name (or being a form) speaks against it."""
    if node.tag in DROP and not node.lead:
        return True
    node.mark = "form" if node.tag == "form" else ""
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    a = _attributes(node)
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES \
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
        return True
    if by_name and node.tag not in HEADINGS:
        names = a.get("class", "").split()
        if "id" in a and not _titled(node, a["id"]):
            names.append(a["id"])
        for name in names:
            parts = _parts(name)
            for k, p in enumerate(parts):
                if p in PARTS and MODIFIERS.isdisjoint(parts[:k]):
                    node.mark = "answers" if p in ANSWERS or node.mark == "answers" else "name"
    return False


def _titled(node: Node, name: str) -> bool:
    """Whether an id is made from the title that the element begins with."""
    parts = _parts(name)
    if len(parts) < 2 or not ANSWERS.isdisjoint(parts) or PARTS.union(COLLECTIONS).issuperset(parts):
        return False
    near = [k for k in node.kids if not isinstance(k, str)]
    near += [x for k in near[:2] for x in k.kids if not isinstance(x, str)]
    return any(k.tag in HEADINGS and set(parts) <= set(_parts(_title(k))) for k in near)


def _title(heading: Node) -> str:
    """A heading's text without that of headings inside it, so that no text is read once per level."""
    out, stack = [], [heading]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x is heading or x.tag not in HEADINGS:
            if x.tag == "br" or x.tag in BLOCK:
                out.append(" ")
            stack.extend(reversed(x.kids))
    return "".join(out)


def _walk(root: Node) -> list[Node]:
    """The nodes of a tree, parents before kids."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [k for k in reversed(node.kids) if not isinstance(k, str)]
    return out


def _visible(root: Node, by_name: bool) -> list[Node]:
    """Nodes that stay, parents before kids; boilerplate kids are cut off."""
    _find_leads(root)
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        node.kids = [k for k in node.kids if isinstance(k, str) or not boilerplate(k, by_name)]
        stack += [k for k in reversed(node.kids) if not isinstance(k, str)]
    if not any(node.mark for node in out):
        return out
    _weigh(out)
    stack = [root]
    while stack:
        node = stack.pop()
        node.kids = [k for k in node.kids if isinstance(k, str) or not k.mark or _stays(k, root)]
        stack += [k for k in node.kids if not isinstance(k, str)]
    out = _walk(root)
    for node in out:
        own = 1.0
        if node.mark == "answers":
            own = UNDER_ANSWERS
        elif node.mark and node.holds != "article":
            own = max(UNDER_MARK, _share(node, root))
        node.weight = own if node.up is None else node.up.weight * own
        node.chars = node.linked = 0
    return out


def _find_leads(root: Node) -> None:
    """Notes the headers that are an article's own: inside one, with a heading and few links."""
    nodes = _walk(root)
    inside, headers = set(), []
    for node in nodes:
        if node.tag == "article" or id(node.up) in inside:
            inside.add(id(node))
            if node.tag == "header":
                headers.append(node)
    if not headers:
        return
    _count(nodes)
    titled = set()
    for node in reversed(nodes):
        if node.up is not None and (node.tag in HEADINGS or id(node) in titled):
            titled.add(id(node.up))
    for node in headers:
        node.lead = id(node) in titled and node.linked < MOST_LINKED * node.chars
    for node in nodes:
        node.chars = node.linked = 0


def _weigh(nodes: list[Node]) -> None:
    """Counts texts, unlinked ones without answers, and notes what holds an article or a first-level heading."""
    _count(nodes)
    for node in reversed(nodes):
        node.plain += sum(len(k.strip()) for k in node.kids if isinstance(k, str))
        if node.up is not None and node.tag != "a" and node.mark != "answers":
            node.up.plain += node.plain
    for kind, tags in (("h1", ("h1",)), ("article", ("article", "main"))):
        for node in nodes:
            if node.tag in tags and not node.mark:
                x = node
                while x is not None and x.holds != kind:
                    x.holds = kind
                    x = x.up


def _share(node: Node, root: Node) -> float:
    return node.plain / max(1, root.plain, node.plain)


def _large(node: Node, root: Node) -> bool:
    return node.plain >= LEAST_SHARE_CHARS and _share(node, root) >= LEAST_SHARE and node.linked < MOST_LINKED * node.chars


def _stays(node: Node, root: Node) -> bool:
    """Whether a marked element takes part in the scoring."""
    return node.holds == "article" or node.holds == "h1" and node.linked < MOST_LINKED * node.chars or _large(node, root)


def _cut_marked(best: Node, root: Node) -> None:
    """Takes out the marked elements that do not hold the best container, nor (inside it) an article, a heading or much text."""
    path, x = set(), best
    while x is not None:
        path.add(id(x))
        x = x.up
    inside = best.tag not in ("html", "body", "#root")
    stack, less = [root], False
    while stack:
        node = stack.pop()
        kept = []
        for k in node.kids:
            if isinstance(k, str) or not k.mark or id(k) in path or k.holds == "article" \
                    or k.holds == "h1" and inside or k.mark != "answers" and _large(k, root):
                kept.append(k)
        less |= len(kept) < len(node.kids)
        node.kids = kept
        stack += [k for k in kept if not isinstance(k, str)]
    if less:
        nodes = _walk(root)
        for node in nodes:
            node.chars = node.linked = 0
        _count(nodes)


def _count(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        own = [k for k in node.kids if isinstance(k, str)]
        size = sum(len(k) - k.count(" ") if len(k) < 4 else len(k.strip()) for k in own)
        node.chars += size
        if node.tag == "a":
            node.linked = node.chars
        if node.up is not None:
            node.up.chars += node.chars
            node.up.linked += node.linked


def _score(nodes: list[Node]) -> Node | None:
    """Adds up lengths, passes points to ancestors; the node of the best discounted score."""
    _count(nodes)
    for node in reversed(nodes):
        # commas up to the next paragraph below, which has its own
        node.commas += sum(k.count(c) for k in node.kids if isinstance(k, str) for c in COMMAS)
        if node.up is not None and node.tag not in _PARAGRAPH:
            node.up.commas += node.commas
    for node in nodes:
        own = any(isinstance(k, str) and not k.isspace() for k in node.kids)
        if not node.chars or not (node.tag in _PARAGRAPH or own and (node.tag in BLOCK or node.tag == "#root")):
            continue
        density = node.linked / node.chars
        points = (1.0 + node.commas + min(node.chars / 100.0, 3.0)) * (1.0 - density)
        if node.chars < LEAST_PARAGRAPH:
            points *= 0.1
        points *= node.weight
        up, level = (node if node.tag not in _PARAGRAPH else node.up), 0
        while up is not None and level < LEVELS:
            up.score += points / (1 if level == 0 else 2 * level if level == 1 else 3 * level)
            up, level = up.up, level + 1
    best, top = None, 0.0
    for node in nodes:
        if node.score:
            node.score *= 1.0 - node.linked / max(1, node.chars)
            if node.score > top:
                best, top = node, node.score
    return best


def _blocks(roots: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append(text)

    for root in roots:
        stack: list = [root]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                run.append(x)
            elif x is None:
                flush()
            elif x.tag in ("br", "wbr"):
                run.append(" " if x.tag == "br" else "")
            else:
                block = x.tag in BLOCK or x.tag == "#root"
                if block:
                    flush()
                    stack.append(None)
                stack.extend(reversed(x.kids))
        flush()
    return out


def main_text(page: str) -> str:
    """The blocks of the page's main text, joined by line breaks."""
    for by_name in (True, False):
        root = parse(page)
        best = _score(_visible(root, by_name))
        if best is None:
            continue
        best = _whole(best)
        _cut_marked(best, root)
        roots = [best]
        if best.up is not None and best.tag not in ("article", "main"):
            roots = _with_siblings(best)
        blocks = _blocks(roots)
        if blocks:
            return "\n".join(blocks)
    return ""


def _whole(best: Node) -> Node:
    """The container widened to what it is a part of: its list or table, then the article or main element, then a
    container named as content."""
    while best.tag in PART and best.up is not None:
        best = best.up
    for named in ("article", "main", None):
        up = best
        while up is not None and not (up.tag == named if named else up.tag not in ("html", "body", "#root") and _is_content(up)):
            up = up.up
        if up is not None:
            return up
    return best


def _is_content(node: Node) -> bool:
    if not node.attrs:
        return False
    a = _attributes(node)
    return any(p.lower() in CONTENT for p in _NAME_PART.findall(f"{a.get('class', '')} {a.get('id', '')}"))


def _with_siblings(best: Node) -> list[Node]:
    """The best container and what belongs to it beside it, in page order."""
    named, least = _is_content(best), SIBLING * best.score
    while not named and best.up.chars == best.chars and best.up.up is not None:
        best = best.up  # a mere wrapper: the siblings stand further out
    roots: list[Node] = []
    loose: Node | None = None
    for k in best.up.kids:
        if isinstance(k, str) or k.tag not in BLOCK:
            # loose text and inline elements make one block
            if loose is None:
                loose = Node("#loose", "", None)
                roots.append(loose)
            loose.kids.append(k)
            loose.chars += len(k.strip()) if isinstance(k, str) else k.chars
            loose.linked += 0 if isinstance(k, str) else k.linked
        else:
            loose = None
            roots.append(k)
    return [k for k in roots if k is best or _joins(k, least, named) or any(x is best for x in k.kids)]


def _joins(node: Node, least: float, named: bool) -> bool:
    """Whether a sibling of the best container belongs to the main text."""
    if node.mark:
        return node.holds == "article"
    if node.tag != "#loose" and node.score >= least:
        return True
    density = node.linked / max(1, node.chars)
    if not named or node.tag in HEADINGS:
        return density < MOST_LINKED and node.chars > 0
    return node.tag in _PARAGRAPH and node.chars > 0 and (density < 0.25 if node.chars > 80 else density == 0)


def _extract(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                text = [main_text(x) if x else "" for x in part.column("__html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in names), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    names=[*names, "text", "n_chars"])
    return run


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points) of every page."""
    names = list(keep)
    inner = pages.select(*names, F.col(html_col).alias("__html"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*names).schema]
    return inner.mapInArrow(_extract(names), ", ".join([*schema, "text string", "n_chars long"]))
