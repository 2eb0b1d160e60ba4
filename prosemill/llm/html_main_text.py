"""Main text of HTML pages by composite text density.

A page is read into a DOM by one scan over its tags. For every node the composite density
is its characters per tag, scaled by how little of it is link text. The densities of a node's
children are summed; the node with the largest sum holds the content, and the least density
on its path from the body is the threshold that its descendants have to reach.

Parts that a word of their class, id or role names as a menu, an advert and the like are measured
apart. One that holds an article or main element is none. Others hold the content only if their
densest node has ASIDE_TIMES the sum of any outside, and that is in no article; inside the content, those named by a part
of a longer name have to reach as many times the threshold.
"""

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)>?|<[!?][^>]*>?", re.S)
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")

#: fixed values of HTML: elements without content, with text that is not markup, and those
#: that start a block; <br> is white space inside its block
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
#: elements that never hold the article's own text
ASIDE = frozenset(
    "head nav footer aside form button select option label input script style noscript textarea title iframe object "
    "svg canvas audio video template menu dialog search".split())
#: words of class, id and role that name such parts
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup nav navbar navigation menu menus breadcrumb "
    "breadcrumbs sidebar sidebars aside widget widgets footer footers masthead toolbar pagination pager comment comments "
    "disqus reply replies respond share sharing social related recommended search login navigation complementary contentinfo".split())
#: how much denser than others a part with such a name has to be
ASIDE_TIMES = 2
#: names of a header that is not an article's own
SITE = frozenset("header site page top global main wrapper container".split())
#: tags that a new one of these closes: (opened, closed, up to)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


class Node:
    __slots__ = ("tag", "up", "kids", "skip", "named", "link", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag, up, skip, link):
        self.tag, self.up, self.skip, self.link, self.kids = tag, up, skip, link, []
        self.named = None
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


_WHOLE = ("html", "body", "article", "main")


def _boilerplate(tag: str, attributes: str, up: Node) -> bool:
    if tag in ASIDE:
        return True
    if tag == "header":  # the header of a page, not that of an article
        while up and up.tag not in ("article", "main"):
            up = up.up
        return up is None
    return bool(attributes and tag not in _WHOLE and _HIDDEN.search(attributes))


def _aside(tag: str, attributes: str) -> str | None:
    """Whether class, id or role name a part beside the content: by a ``whole`` name, or a
    ``part`` of one."""
    found = None
    if not attributes or tag in _WHOLE:
        return found
    for m in _NAMED.finditer(attributes):
        value = (m[1] or m[2] or m[3] or "").lower()
        words = _WORD.findall(value)
        if not NAMES.isdisjoint(value.split()) or words and SITE.issuperset(words) and "header" in words:
            return "whole"
        if not NAMES.isdisjoint(words):
            found = "part"
    return found


def parse(page: str) -> Node:
    """The DOM of a page; texts are string children. Markup that is broken never fails:
    unclosed elements end with their parent, end tags without a start are ignored."""
    root = at = Node("#", None, False, False)
    pos, end, lower = 0, len(page), None
    while pos < end:
        m = _TAG.search(page, pos)
        if m is None:
            at.kids.append(page[pos:])
            break
        if m.start() > pos:
            at.kids.append(page[pos:m.start()])
        pos = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            node = at
            while node.up and node.tag != tag:
                # an inline end tag doesn't close a block
                if tag not in BLOCK and node.tag in BLOCK:
                    node = root
                    break
                node = node.up
            if node.up:
                at = node.up
            elif tag == "p":
                at.kids.append(Node("p", at, at.skip, at.link))
            continue
        if tag in BLOCK:
            node = at
            while node.up and node.tag not in BLOCK:
                node = node.up
            if node.tag == "p" and node.up:
                at = node.up
        if tag in _CLOSES:
            closed, upto = _CLOSES[tag]
            node, last = at, None
            while node.up and node.tag not in upto:
                if node.tag in closed:
                    last = node
                node = node.up
            if last:
                at = last.up
        node = Node(tag, at, at.skip or _boilerplate(tag, m[3] or "", at), at.link or tag == "a")
        at.kids.append(node)
        if not node.skip:
            node.named = _aside(tag, m[3] or "")
            if tag in ("article", "main"):  # what encloses it is not beside it
                up = at
                while up:
                    up.named, up = None, up.up
        if tag in RAW:
            lower = lower or page.lower()
            if len(lower) != end:  # a letter whose lower case is longer
                lower = re.sub("[A-Z]", lambda x: x[0].lower(), page)
            close = lower.find(f"</{tag}", pos)
            if close < 0:
                close = end
            node.kids.append(page[pos:close])
            pos = page.find(">", close) + 1 or end
        elif tag not in VOID:
            at = node
    return root


def _measure(top: Node, asides: list[Node], share: float | None = None) -> tuple[Node, float]:
    """Fill in characters, tags and densities bottom-up, without the parts with names of their
    own, which are added to ``asides``. Returns the body, or the top, and the share of link
    text in it, which a part takes over from its page."""
    order, body = [top], top
    for node in order:
        if node.tag == "body" and body is top:
            body = node
        for i, kid in enumerate(node.kids):
            if isinstance(kid, Node):
                if not kid.skip:
                    (asides if kid.named else order).append(kid)
            elif not node.skip:
                node.kids[i] = kid = entities.unescape(kid) if "&" in kid else kid
                n = len(_SPACE.sub("", kid))
                node.chars += n
                node.link_chars += n if node.link else 0
    for node in reversed(order):
        if node is not top:
            up = node.up
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    if share is None:
        share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, node.link_tags
        if c:
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            # one is added to the base, which is 1 on pages without links
            if lc < c:
                node.density = c / t * math.log(max(math.e, c / max(1, lc) * t / max(1, lt))) / math.log(1 + base)
        if node is not top:
            node.up.total += node.density
    return body, share


def _densest(top: Node) -> Node:
    """The node with the largest sum of densities, without looking into parts with names."""
    best, stack = top, [top]
    while stack:
        node = stack.pop()
        if node.total > best.total:
            best = node
        stack += [k for k in node.kids if isinstance(k, Node) and not k.skip and not k.named]
    return best


def _blocks(top: Node, threshold: float) -> list[str]:
    """Texts of the blocks below a node, in page order. A part counts if it or a part of it
    reaches the threshold; text directly in a kept node always counts."""
    out, line, stack = [], [], [(top, 0)]

    def flush():
        if line:
            text = _SPACE.sub(" ", "".join(line)).strip()
            if text:
                out.append(text)
            line.clear()

    while stack:
        node, i = stack.pop()
        if i == 0 and node.tag in BLOCK:
            flush()
        while i < len(node.kids):
            kid = node.kids[i]
            i += 1
            if not isinstance(kid, Node):
                line.append(kid)
            elif kid.tag == "br":
                line.append(" ")
            elif kid.named and (kid.named == "whole" or max(kid.density, kid.total) < ASIDE_TIMES * threshold or kid.chars <= kid.link_chars):
                continue
            elif not kid.skip and kid.chars and (kid.tag not in _PARTS or kid.chars > kid.link_chars and max(kid.density, kid.total) >= threshold):
                stack.append((node, i))
                stack.append((kid, 0))
                break
        else:
            if node.tag in BLOCK:
                flush()
    flush()
    return out


#: parts that are judged as wholes; paragraphs, headings and inline text follow their part
_PARTS = frozenset("div section article main table ul ol dl td center details".split())


def main_text(page: str | None) -> str:
    """Main text of one page, blocks joined by newlines; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    asides = []
    body, share = _measure(root, asides)
    best = _densest(body)
    node, least = best, ASIDE_TIMES * best.total
    while node.up and node.tag not in ("article", "main"):
        node = node.up
    for part in asides:  # grows by the parts inside parts
        _measure(part, asides, share)
        dense = _densest(part)
        if dense.total > least and not node.up:  # no match for an article
            best, least = dense, dense.total
    # the article that holds the densest node is taken whole
    node = best
    while node.up:
        if node.tag in ("article", "main"):
            best = node
        node = node.up
    threshold, node = best.density, best
    while node.up and node is not body:
        node = node.up
        threshold = min(threshold, node.density) if node.chars else threshold
    if best is not body and best.tag == "p":
        best = best.up
    return "\n".join(_blocks(best, threshold))


def _extractor(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key", "url", "text"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, ``url``, ``text`` and ``n_chars`` (code points of the text).

    The text holds the blocks of the article in page order, one per line, white space inside
    a block collapsed and character references decoded; menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles and comments are left out. A null or empty page,
    or one without content, gives an empty text. Rows with null or repeated ids are kept as
    they are, other columns left out; an empty table gives an empty one. No shuffle.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("key"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    out = rows.mapInArrow(_extractor, f"key {kind}, url string, text string")
    return out.select(F.col("key").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars"))


@query("op3_html_main_text")
def op3_html_main_text(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
