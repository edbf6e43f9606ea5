"""Main text of web pages by composite text density.

A page is parsed leniently into a tree (open elements are closed as browsers do for the common
cases). Every element gets ``chars`` / ``tags`` of its subtree and the same for its links, and from
them the composite density

    chars / tags * log_base(chars / link_chars * tags / link_tags),
    base = ln(chars / other_chars * link_chars + body_link_chars / body_chars * chars + e)

(zero denominators count as 1). The element whose children's densities add up to the most is the
content root. The smallest density on the path from it to ``body`` is the threshold: inside the
root, link-dominated containers below the threshold are left out. Elements that are no article
text by their kind (scripts, forms, navigation, ...) or by what their class, id or role says
(advert, comments, sidebar, ...) are cut before anything is measured. A class, id or role alone
does not cut what looks like the article's wrapper (``_settle``): the density decides. Inside an
article only whole names such as ``comments`` or ``ad`` cut, and an article in an article goes when it
has no heading (a reader's comment). Attributes are parsed: values are never searched for names. Reading
a page takes linear time, unclosed tags and quotes included (such a tag is text). If the root lies inside an
``article`` or ``main`` element, or holds exactly one that has most of its text, that element is
taken, so short paragraphs and the heading stay.
"""
from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

_MARK = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|!\[CDATA\[|[!?])")
_STEP = re.compile(r">|=\s*[\"']")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?|["'][^"']*["']?""")
_NAMES = frozenset("class id role aria-label hidden aria-hidden style".split())

RAW = frozenset("script style textarea title xmp iframe noembed noframes template svg math".split())
CUT = frozenset("head nav footer aside form script style noscript template svg math iframe object embed "
                "button select option textarea input label fieldset dialog menu audio video canvas map "
                "title xmp noembed noframes applet".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
                  "nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CONTAINER = frozenset("div section ul ol dl table header center details td".split())
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Words in class, id or role that mark something other than the article.
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|"
    r"modal|overlay|newsletter|subscri\w+|paywall|sidebar|side-bar|aside|rail|widget|menu|nav|navbar|navigation|"
    r"breadcrumbs?|pagination|pager|masthead|topbar|toolbar|site-header|page-header|footer|foot|share|sharing|"
    r"social|related|recommend\w*|more-stories|trending|comments?|comment-\w+|disqus|respons\w+|reply|replies|"
    r"search|login|signup|copyright|legal|disclaimer|complementary|contentinfo|search)(?:$|[\s_-])", re.I)


# Words that make a name part a description of the layout: has-sidebar, no-sidebar, layout_sidebar_left.
_LAYOUT = re.compile(r"(?:^|[_-])(?:has|with|without|no|layout)[_-]", re.I)


# Inside an article only these, as whole names, mark something else; an id only on a container.
_STRONG = re.compile(
    r"(?:ads?(?:[-_]\w+)*|advert\w*|adsense|sponsor\w*|promo\w*|comments?(?:[-_]\w+)*|disqus\w*|shar(?:e|ing)(?:[-_]\w+)*|social-share|"
    r"related(?:[-_]\w+)*|recommend\w*|newsletter|subscri\w+|cookies?(?:[-_]\w+)*|consent|popup|modal|overlay|notice|alert|"
    r"paywall|widget|sidebar|side-bar|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|footer)", re.I)
_STRONG_ID = re.compile(r"(?:ads?(?:[-_]\w+)*|advert\w*|comments?(?:[-_]\w+)*|disqus\w*|shar(?:e|ing)(?:[-_]\w+)*)", re.I)


class _Node:
    __slots__ = ("tag", "parent", "parts", "cut", "hinted", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag, parent, cut, hinted=False):
        self.tag, self.parent, self.cut, self.hinted, self.parts = tag, parent, cut, hinted, []


def _is_cut(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """(cut by kind or as hidden, hinted by a name)."""
    if tag in CUT:
        return True, False
    if tag == "header":
        return not inside_article, False
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, False
    hinted = False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name not in _NAMES:
            continue
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                return True, False
        elif inside_article:
            mark = _STRONG_ID if name == "id" else _STRONG
            hinted = hinted or (name != "id" or tag in CONTAINER) and any(mark.fullmatch(w) for w in value.split())
        elif value and _HINT.search(value := value.replace(".", " ")):
            hinted = hinted or bool(_HINT.search(" ".join(w for w in value.split() if not _LAYOUT.search(w))))
    return False, hinted


def _settle(root: _Node) -> None:
    """Cut the hinted elements, except those of which two of these hold: most of the page's text outside
    links lies in it; it holds an article, main or h1; no article or main with text lies beside it."""
    order, stack = [], [(root, None, False)]
    text, heads, area, inside = {}, {}, {}, {}
    while stack:                                            # page order, with the nearest hinted ancestor
        node, near, link = stack.pop()
        order.append(node)
        area[node], inside[node] = near, link
        link = link or node.tag == "a"
        near = node if node.hinted else near
        stack.extend((p, near, link) for p in reversed(node.parts) if not isinstance(p, str) and not p.cut)
    articles: dict = {}
    for node in reversed(order):
        linked = inside[node] or node.tag == "a"
        own = sum(0 if linked else len(p.strip()) for p in node.parts if isinstance(p, str))
        below = [p for p in node.parts if not isinstance(p, str) and not p.cut]
        text[node] = own + sum(text[p] for p in below)
        heads[node] = any(heads[p] or p.tag in ("article", "main", "h1") for p in below)
        if node.tag in ("article", "main") and text[node]:
            articles[area[node]] = articles.get(area[node], 0) + 1
    stack = [(root, articles.get(None, 0), 0)]
    while stack:                                            # known: articles in the kept areas around
        node, known, above = stack.pop()
        if node.hinted:
            reasons = (2 * text[node] > text[root]) + heads[node] + (known <= above)
            if reasons < 2:
                node.cut = True
                continue
            known += articles.get(node, 0)
        above += node.tag in ("article", "main") and text[node] > 0
        stack.extend((p, known, above) for p in node.parts if not isinstance(p, str) and not p.cut)


def parse(page: str) -> _Node:
    """The page's tree; ``parts`` of a node are texts and child nodes in page order."""
    root = _Node("#root", None, False)
    open_, articles, hints = [root], 0, False
    at = 0

    def pop_to(depth: int) -> None:
        nonlocal articles
        for node in open_[depth:]:
            articles -= node.tag in ("article", "main")
            count[node.tag] -= 1
        del open_[depth:]

    last_end = page.rfind(">")
    quoted = True                                           # until a quote is found that nothing closes
    count: dict[str, int] = {}                              # open elements by tag
    nested: list[_Node] = []                                # articles in an article

    def tag_end(start: int) -> int:
        """Where the tag ends whose name ends at ``start``: the first ``>`` outside quoted values."""
        nonlocal quoted
        place = start
        while quoted:
            step = _STEP.search(page, place)
            if step and step[0] == ">":
                return step.start()
            close = page.find(step[0][-1], step.end()) if step else -1
            if close < 0:
                quoted = False
            place = close + 1
        return page.find(">", start)

    while True:
        m = _MARK.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            open_[-1].parts.append(page[at:end])
        if not m:
            for node in nested:                             # a comment on the article around it
                if not _has_heading(node):
                    node.cut = True
            if hints:
                _settle(root)
            return root
        if not m[2]:                                        # a comment, CDATA or a declaration
            mark = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = page.find(mark, m.end())
            if m[0] == "<![CDATA[":
                open_[-1].parts.append(page[m.end():end if end >= 0 else len(page)].replace("&", "&amp;"))
            at = end + len(mark) if end >= 0 else len(page)
            continue
        end = tag_end(m.end()) if m.end() <= last_end else -1
        if end < 0:                                         # never ends: text
            open_[-1].parts.append(m[0])
            at = m.end()
            continue
        at = end + 1
        tag, attributes = m[2].lower(), page[m.end():end]
        if m[1]:                                            # an end tag
            limit = len(open_) - 1 if count.get(tag) else 0
            while limit > 0 and open_[limit].tag != tag:
                if tag not in BLOCK and open_[limit].tag in BLOCK:
                    limit = 0
                    break
                limit -= 1
            if limit > 0:
                pop_to(limit)
            elif tag == "p":
                open_[-1].parts.append(_Node("p", open_[-1], False))
            continue
        if tag in ("html", "body") and count.get(tag):
            continue
        if tag == "body":                                   # ends an unclosed head
            for depth, node in enumerate(open_):
                if node.tag == "head":
                    pop_to(depth)
                    break
        if tag in BLOCK:                                    # a block ends an open paragraph
            for depth in range(len(open_) - 1, 0, -1):
                if open_[depth].tag == "p":
                    pop_to(depth)
                    break
                if open_[depth].tag in BLOCK:
                    break
        if tag in _CLOSES:
            ends, stops = _CLOSES[tag]
            depth = len(open_) - 1
            last = None
            while depth > 0 and open_[depth].tag not in stops:
                if open_[depth].tag in ends:
                    last = depth
                    if tag not in ("tr",):
                        break
                depth -= 1
            if last:
                pop_to(last)
        node = _Node(tag, open_[-1], *_is_cut(tag, attributes, articles > 0))
        hints = hints or node.hinted
        open_[-1].parts.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("path", "circle", "rect"):
            continue
        if tag in RAW:                                      # its content is not markup
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag == "article" and count.get("article"):
            nested.append(node)
        open_.append(node)
        count[tag] = count.get(tag, 0) + 1
        articles += tag in ("article", "main")


def _has_heading(node: _Node) -> bool:
    stack = [node]
    while stack:
        node = stack.pop()
        if node.tag in ("h1", "h2", "h3", "hgroup"):
            return True
        stack.extend(p for p in node.parts if not isinstance(p, str) and not p.cut and p.tag != "article")
    return False


def _clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _measure(root: _Node) -> list[_Node]:
    """Fill in the counts bottom-up and the densities; returns the kept nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.cut:
            continue
        order.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, _Node))
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(_clean(part))
            elif not part.cut:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    body = next((n for n in order if n.tag == "body"), root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in order:
        if not node.chars:
            node.density = 0.0
            continue
        other = node.chars - node.link_chars
        base = math.log(node.chars / (other or 1) * node.link_chars + share * node.chars + math.e)
        inner = node.chars / (node.link_chars or 1) * (node.tags or 1) / (node.link_tags or 1)
        node.density = node.chars / (node.tags or 1) * math.log(max(inner, 1.0)) / math.log(max(base, 1.0 + 1e-9)) \
            if base > 1.0 else node.chars / (node.tags or 1) * math.log(max(inner, 1.0)) * 1e3
    for node in order:
        node.total = sum(p.density for p in node.parts if isinstance(p, _Node) and not p.cut)
    return order


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by newlines; empty if the page is null or has none."""
    if not page:
        return ""
    order = _measure(parse(page))
    if not order[0].chars:
        return ""
    body = next((n for n in order if n.tag == "body"), order[0])
    inside = {id(body)}
    for n in order:                                         # page order: parents come first
        if n.parent is not None and id(n.parent) in inside:
            inside.add(id(n))
    scope = [n for n in order if id(n) in inside and n.chars] or [order[0]]
    best = max(scope, key=lambda n: (n.total, n.density))
    node, threshold = best, best.density
    while node is not None and node is not body:
        node = node.parent
        if node is not None:
            threshold = min(threshold, node.density)
    root, node = best, best
    while node is not None:
        if node.tag in ("article", "main"):
            root = node
            break
        node = node.parent
    else:
        held = [n for n in order if n.tag in ("article", "main") and _under(n, best)
                and not any(_under(n.parent, m) and m.tag in ("article", "main") for m in _up(n.parent, best))]
        if len(held) == 1 and 2 * held[0].chars >= best.chars:
            root = held[0]
        elif best.tag in BLOCK and best.tag not in CONTAINER and best.parent is not None and best is not body:
            root = best.parent                              # a single paragraph: its container
    return "\n".join(_blocks(root, threshold))


def _up(node, stop):
    while node is not None:
        yield node
        if node is stop:
            return
        node = node.parent


def _under(node, top) -> bool:
    return any(n is top for n in _up(node, None)) if node is not None else False


def _blocks(root: _Node, threshold: float) -> list[str]:
    """Texts of the blocks below ``root`` in page order."""
    blocks, line = [], []

    def flush() -> None:
        text = _clean("".join(line))
        line.clear()
        if text:
            blocks.append(text)

    stack: list = [root]
    while stack:
        part = stack.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            line.append(part)
        elif part.cut:
            if part.tag in BLOCK:
                flush()
        elif part.tag == "br":
            line.append(" ")
        else:
            if (part is not root and part.tag in CONTAINER and part.chars and part.density < threshold
                    and 2 * part.link_chars > part.chars):
                flush()
                continue
            if part.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(part.parts))
    flush()
    return blocks


def extract(pages: DataFrame, html: str = "html", out: tuple[str, str] = ("text", "n_chars"),
            keep: tuple[str, ...] | None = None) -> DataFrame:
    """Add the main text and its length in code points to every row (with the columns ``keep``).

    A null or empty page has the empty text; repeated rows are rows of their own; an empty table gives none.
    Columns of ``pages`` named like the new ones are replaced."""
    keep = [c for c in keep or pages.columns if c not in out]
    schema = T.StructType([*pages.select(*keep).schema.fields, T.StructField(out[0], T.StringType()),
                           T.StructField(out[1], T.LongType())])

    def extracted(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [main_text(x.as_py()) for x in part.column(html)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*keep, *out])

    return pages.mapInArrow(extracted, schema)
