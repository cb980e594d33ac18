"""Main text of web pages: blocks score points for their ancestors, the article around the best container and its siblings are kept."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, by what they mean for a reader.
SKIPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video head title select "
                    "option button textarea input form nav footer aside menu dialog datalist map applet".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul".split())
#: An element that one of these opens ends before it does.
ENDED_BY = {
    "p": BLOCKS - {"html", "body"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]),
    "th": frozenset(["td", "th", "tr", "tbody"]), "option": frozenset(["option", "optgroup"]),
}
#: Elements an end tag or an implied end does not reach across.
WALLS = frozenset("table td th ul ol dl div section article main body html blockquote".split())
#: Words in class, id or role that name what is not the article.
BOILERPLATE = frozenset("ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
                        "comments commentlist complementary consent contentinfo cookie cookies copyright dialog disqus "
                        "footer footnav gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
                        "pagination pager paywall popup promo promoted promotion recommended related replies reply respond "
                        "rss search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe "
                        "subscription tags toolbar widget widgets alert".split())
#: Words that speak for the article, where they make up a class or id without any of the above: main-content, post-body.
ARTICLE = frozenset("article body content entry main page post story text".split())
#: Words that no other class of the element outvotes.
NEVER = frozenset("ad ads advert adverts advertisement advertising comment comments commentlist disqus sidebar cookie "
                  "cookies nav navbar menu footer sponsor sponsored promo notice respond replies".split())
#: First words of the classes of articles that are not the article.
NO_ARTICLE = frozenset("ad ads advert comment comments promo reply replies sponsored teaser".split())
#: Elements whose ids are made from their own words and whose classes say little.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre figcaption".split())
CONTAINERS = frozenset("div section article main body html td form".split())
SCOPES = frozenset("div section article main body html form".split())
LINK_LISTS = frozenset("ul ol div section table dl".split())

# Every part is possessive, so a tag is scanned once, however it is broken off.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+)>""")
_UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=>/"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_BLANK = re.compile(r"\s+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Characters of a link below which a list of links in an article is a menu rather than references.
MENU_CHARS = 20
#: Tags broken by an odd quote that are read again up to the first >; after so many all of the page's are.
ODD_QUOTES = 16


class _Node:
    """A block element. What its ancestors say is kept on it, so no step looks further up than it must."""
    __slots__ = ("name", "parent", "bad", "ender", "in_article", "in_form", "points", "score", "chars", "links", "texts",
                 "around", "listed", "inside", "scoped")

    def __init__(self, name: str, parent: "_Node | None", bad: bool):
        self.name, self.parent, self.bad = name, parent, bad
        #: the nearest element from here up that another may end, and that lies before the next wall
        self.ender = self if name in ENDED_BY else None if parent is None or name in WALLS else parent.ender
        self.in_article = name in ("article", "main") or (parent is not None and parent.in_article)
        self.in_form = name == "form" or (parent is not None and parent.in_form)
        self.points, self.score, self.chars, self.links, self.texts = 0.0, 0.0, 0, 0, 0
        self.around = self.listed = self.inside = self.scoped = False


def _attributes(text: str) -> dict[str, str]:
    """Names in lower case; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


def _words(name: str) -> set[str]:
    return {w.lower() for w in _HUMP.findall(name)}


def _is_boilerplate(name: str, text: str, in_article: bool) -> bool:
    """Whether the element itself says that it is not part of an article.

    Each class, id or role is judged by itself. One with a word of BOILERPLATE is bad, and outvoted by another with a
    word of ARTICLE unless it is one of NEVER; a header is bad outside the article only, and not as that of an entry. Headings,
    paragraphs and the like have ids made from their words, so only NEVER counts there, as it does for ids inside an article.
    """
    if (name in SKIPPED and name != "form") or (name == "header" and not in_article):
        return True
    if not text.strip():
        return False
    own = _attributes(text)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(own.get("style", "")):
        return True
    if name in ("html", "body", "main", "form"):
        return False
    classes = own.get("class", "").split()
    if name == "article":
        return any(_HUMP.findall(c)[:1] and _HUMP.findall(c)[0].lower() in NO_ARTICLE for c in classes)
    bad = good = False
    for kind, token in [*[("class", c) for c in classes], ("id", own.get("id", "")), ("role", own.get("role", ""))]:
        words = _words(token)
        found = words & BOILERPLATE
        if "header" in found and (in_article or words & ARTICLE):
            found = found - {"header"}
        if kind == "id" and name in PROSE:
            continue
        if name in PROSE or (kind == "id" and in_article):
            found = found & NEVER
        if found & NEVER:
            return True
        bad = bad or bool(found)
        good = good or (not found and bool(words & ARTICLE))
    return bad and not good


def blocks_of(html: str) -> tuple[list[tuple[str, _Node, int]], list[_Node]]:
    """(text, innermost block, characters in links) of every run of text, and the blocks, parents before children.

    The page is read once from front to back. A tag that the page breaks off inside ends it.
    """
    root = _Node("html", None, False)
    nodes, opened = [root], Counter()
    node, out, text, links = root, [], [], 0
    link_depth, at, odd = 0, 0, 0
    unclosed: set[str] = set()      # raw elements without an end tag from here on
    inline_bad: list[str] = []      # open inline elements that hide what they hold

    def end_block():
        nonlocal text, links
        if text:
            joined = _BLANK.sub(" ", "".join(text)).strip()
            if joined:
                out.append((joined, node, min(links, len(joined))))
        text, links = [], 0

    def say(piece):
        nonlocal links
        if piece and not node.bad and not inline_bad:
            piece = unescape(piece)
            text.append(piece)
            if link_depth:
                links += len(piece.strip())

    def leave(up):
        """Everything from the current block up to and with this one ends."""
        nonlocal node, link_depth
        end = up.parent
        while node is not end:
            opened[node.name] -= 1
            node = node.parent
        link_depth = 0
        inline_bad.clear()

    size = len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            say(html[at:])
            break
        say(html[at:start])
        at = start + 1
        after = html[at:at + 1]
        if after in ("!", "?"):
            opener, closer = next((x for x in (("<!--", "-->"), ("<![CDATA[", "]]>")) if html.startswith(x[0], start)), ("<" + after, ">"))
            end = html.find(closer, start + len(opener))
            if opener == "<![CDATA[":
                say(html[start + 9:end if end >= 0 else size])
            at = end + len(closer) if end >= 0 else size
            continue
        if not (after.isascii() and after.isalpha()) and not (after == "/" and html[at + 1:at + 2].isascii() and html[at + 1:at + 2].isalpha()):
            say("<")
            continue
        m = _TAG.match(html, start) if odd < ODD_QUOTES else None
        if m is None:
            odd += 1
            m = _UNQUOTED.match(html, start)
            if m is None:
                break
        at = m.end()
        name, attributes = m[2].lower(), m[3]
        if m[1]:                                            # an end tag
            if name == "a":
                link_depth = max(link_depth - 1, 0)
            if inline_bad and name == inline_bad[-1]:
                inline_bad.pop()
            if opened[name]:
                up = node
                while up.name != name and not (name == "p" and up.name in WALLS):
                    up = up.parent
                if up.name == name:
                    end_block()
                    leave(up)
                    continue
            if name == "p":
                end_block()
            continue
        if name in VOID:
            if name == "hr":
                end_block()
            elif name == "br":
                say(" ")
            continue
        if name == "svg" and attributes.rstrip().endswith("/"):     # closed in itself, as foreign elements may be
            say(" ")
            continue
        if name in RAW:                                     # its content is no markup
            close = None if name in unclosed else re.compile(rf"</{name}\s*+>", re.I).search(html, at)
            if close:
                at = close.end()
            elif name in ("script", "style", "textarea", "title"):
                at = size
            else:
                unclosed.add(name)
            say(" ")
            continue
        if name in BLOCKS or name in SKIPPED:
            end_block()
            up = node.ender
            while up is not None and name not in ENDED_BY[up.name]:
                up = up.parent.ender if up.parent is not None else None
            if up is not None:
                leave(up)
            bad = node.bad or _is_boilerplate(name, attributes, node.in_article)
            if not attributes.rstrip().endswith("/") or name in BLOCKS:
                node = _Node(name, node, bad)
                nodes.append(node)
                opened[name] += 1
        else:
            if name == "a":
                link_depth += 1
            if (name == "label" and node.in_form) or (
                    attributes and not attributes.rstrip().endswith("/") and _is_boilerplate(name, attributes, True)):
                inline_bad.append(name)
    end_block()
    return out, nodes


def _density(links: int, chars: int) -> float:
    return links / max(chars, 1)


def main_text(html: str) -> str:
    """The blocks of the best container and its kept siblings, in page order, joined by newlines.

    A block gives its parent one point, one per comma and up to three for its length, its grandparent half of them
    and so on upwards; links take their share away, and each container's sum is discounted by its link density. A form
    passes nothing on, and goes unless it holds the best container. The article is the outermost article or main element
    around the container with the most points, or else that container. It is kept with all that stands beside it: whatever the length,
    points or name of a block, nothing is dropped there but marked boilerplate and what consists of links; in an article or main
    element only menus of short links go, its lists of references stay. Rows, cells and lists stand beside what their table or list does.
    """
    found, nodes = blocks_of(html)
    if not found:
        return ""
    for text, node, links in found:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - links / len(text))
        holder = node if node.name in CONTAINERS else node.parent or node
        holder.points += points
        node.chars += len(text)
        node.links += links
        node.texts += 1
    for node in reversed(nodes):        # children before their parents
        node.score += node.points
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.links += node.links
            node.parent.texts += node.texts
            if node.name != "form":
                node.parent.score += node.score / 2
    # an element that says it is the article counts for more
    weight = {"article": 1.5, "main": 1.25}
    best = max(nodes, key=lambda n: n.score * (1 - _density(n.links, n.chars)) * weight.get(n.name, 1.0))     # the first of equals
    article, up, element = best, best, None
    while up is not None:
        up.around = True
        if up.name in weight:
            article = up
            if element is None or element.name == "main":
                element = up        # the innermost article, or else main
        up = up.parent
    if element is not None and element.name == "main":
        element = article
    scope = article.parent or article
    while scope.parent is not None and scope.name not in SCOPES:
        scope = scope.parent
    for node in nodes:                  # parents before their children
        above = node.parent
        node.scoped = node is scope or (above is not None and above.scoped)
        node.inside = node is element or (above is not None and above.inside)
        of_links = node.name in LINK_LISTS and _density(node.links, node.chars) > 0.7
        own = (of_links and (not node.inside or node.chars < MENU_CHARS * node.texts)) or node.name == "form"
        node.listed = not node.around and (own or (above is not None and above.listed))

    def kept(node: _Node, links: int, chars: int) -> bool:
        if not node.scoped or node.listed:
            return False
        if node.inside or scope is article or node is article:
            return True
        alone = node.around or (node.name == "p" and node.parent.around)
        return not (alone and links > 0.7 * chars)

    return "\n".join(text for text, node, links in found if kept(node, links, len(text)))


def _extract(batches):
    for batch in batches:
        texts = [main_text(x or "") for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], ["row", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row.

    The whole page is read; null and empty pages have an empty text. Repeated rows and ids are extracted one by one,
    other columns are left out, an empty table gives no rows.
    """
    whole = F.struct(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = pages.select(whole.alias("row"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "row struct<page_id:long,url:string>, text string, n_chars long").select(
        "row.page_id", "row.url", "text", "n_chars")
