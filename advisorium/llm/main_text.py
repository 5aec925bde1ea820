"""Main text of web pages: flat text blocks, classified by a decision tree over each block and its neighbours.

A page is cut into flat blocks at block-level tags. A block has its number of words, its link density (share
of words inside links), where it stands (inside an article, inside a navigation or form element or one whose
class says so), whether it is a heading, and words and link density of the blocks before and after it. The
tree is grown on the small labelled table below.
"""

import html
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import batch_of, in_arrow, packed, row_type, unpacked

FEATURES = ("in_article", "in_boilerplate", "heading", "words", "links", "words_before", "links_before", "words_after",
            "links_after")

# Labelled blocks: FEATURES, then 1 for main text. Link densities in hundredths.
LABELLED = (
    # articles marked as such: every block outside boilerplate elements, however short
    (1, 0, 1, 6, 0, 9, 0, 60, 0, 1), (1, 0, 0, 60, 0, 6, 0, 45, 5, 1), (1, 0, 0, 45, 5, 60, 0, 2, 0, 1),
    (1, 0, 0, 2, 0, 45, 5, 88, 2, 1), (1, 0, 0, 88, 2, 2, 0, 1, 0, 1), (1, 0, 0, 1, 0, 88, 2, 9, 0, 1),
    (1, 0, 0, 30, 20, 12, 0, 25, 0, 1), (1, 0, 0, 8, 90, 30, 0, 40, 0, 1), (1, 0, 1, 3, 100, 25, 0, 50, 0, 1),
    (1, 0, 0, 150, 1, 80, 0, 0, 0, 1), (1, 0, 0, 5, 0, 0, 0, 0, 0, 1), (1, 0, 0, 14, 0, 5, 100, 5, 100, 1),
    (1, 0, 0, 4, 0, 3, 0, 6, 0, 1), (1, 0, 1, 10, 0, 1, 100, 12, 0, 1), (1, 0, 0, 1, 100, 20, 5, 18, 0, 1),
    # inside menus, footers, notices, adverts, forms and comments: no block, however long
    (0, 1, 0, 1, 100, 0, 0, 1, 100, 0), (0, 1, 0, 2, 100, 1, 100, 1, 100, 0), (0, 1, 0, 9, 0, 1, 100, 10, 0, 0),
    (0, 1, 0, 12, 0, 60, 0, 0, 0, 0), (0, 1, 0, 40, 0, 35, 0, 42, 0, 0), (0, 1, 0, 120, 0, 60, 0, 80, 0, 0),
    (1, 1, 0, 25, 0, 60, 0, 45, 0, 0), (1, 1, 0, 3, 100, 60, 0, 45, 0, 0), (1, 1, 1, 2, 0, 88, 0, 30, 0, 0),
    (1, 1, 0, 80, 0, 40, 0, 60, 0, 0), (0, 1, 1, 4, 0, 2, 100, 30, 0, 0), (0, 1, 0, 30, 60, 4, 0, 12, 0, 0),
    (0, 1, 0, 6, 0, 90, 0, 2, 100, 0), (1, 1, 0, 10, 10, 12, 0, 0, 0, 0),
    # pages without an article element: long blocks, and short ones between or beside long ones
    (0, 0, 0, 60, 0, 1, 100, 70, 0, 1), (0, 0, 0, 45, 5, 60, 0, 50, 0, 1), (0, 0, 0, 120, 2, 8, 0, 30, 0, 1),
    (0, 0, 0, 30, 0, 40, 0, 5, 0, 1), (0, 0, 0, 20, 0, 30, 0, 25, 10, 1), (0, 0, 0, 4, 0, 40, 0, 35, 0, 1),
    (0, 0, 0, 9, 0, 50, 0, 20, 0, 1), (0, 0, 0, 16, 0, 30, 0, 4, 0, 1), (0, 0, 0, 12, 0, 35, 0, 0, 0, 1),
    (0, 0, 1, 6, 0, 2, 100, 60, 0, 1), (0, 0, 1, 4, 0, 60, 0, 55, 0, 1), (0, 0, 1, 8, 0, 0, 0, 40, 0, 1),
    (0, 0, 0, 18, 0, 0, 0, 0, 0, 1), (0, 0, 0, 25, 0, 1, 100, 2, 100, 1), (0, 0, 0, 35, 25, 40, 0, 30, 0, 1),
    (0, 0, 0, 2, 0, 25, 0, 30, 0, 1), (0, 0, 0, 3, 0, 60, 0, 22, 0, 1), (0, 0, 0, 7, 0, 20, 0, 60, 0, 1),
    (0, 0, 0, 1, 100, 0, 0, 1, 100, 0), (0, 0, 0, 3, 100, 2, 100, 4, 100, 0), (0, 0, 0, 6, 80, 3, 100, 5, 60, 0),
    (0, 0, 0, 5, 0, 2, 100, 3, 100, 0), (0, 0, 0, 8, 0, 1, 100, 2, 100, 0), (0, 0, 0, 2, 0, 3, 0, 2, 100, 0),
    (0, 0, 0, 3, 0, 2, 0, 4, 0, 0), (0, 0, 0, 30, 90, 20, 80, 4, 0, 0), (0, 0, 0, 60, 75, 5, 100, 8, 0, 0),
    (0, 0, 1, 2, 0, 3, 100, 2, 100, 0), (0, 0, 1, 3, 100, 4, 0, 5, 100, 0), (0, 0, 0, 12, 60, 40, 0, 2, 100, 0),
    (0, 0, 0, 4, 100, 60, 0, 3, 100, 0), (0, 0, 0, 5, 70, 40, 0, 35, 0, 0), (0, 0, 0, 1, 0, 0, 0, 2, 0, 0),
    (0, 0, 0, 6, 0, 8, 0, 0, 0, 0), (0, 0, 0, 2, 100, 18, 0, 0, 0, 0), (0, 0, 0, 9, 10, 2, 100, 6, 0, 0),
)

# Elements of the HTML standard by what they do to the text.
SILENT = frozenset("script style template noscript svg math object iframe head title textarea select button canvas audio video".split())
#: Of these, those whose content is no markup: never closed, they reach to the end of the page.
RAW = frozenset("script style".split())
BOILERPLATE = frozenset("nav footer aside form header menu dialog fieldset".split())
ARTICLE = frozenset("article main".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that name boilerplate, and those that name the article.
HINTS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar "
                  "navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices "
                  "newsletter subscribe signup share sharing social related recommended recommendations comment comments "
                  "respond replies reply disqus popup modal overlay paywall login search toolbar widget pagination pager "
                  "copyright legal disclaimer tags byline meta complementary contentinfo outbrain taboola skip hidden "
                  "alert".split())
#: Those that make even an article element boilerplate.
OTHERS = frozenset("ad ads advert advertisement sponsored promo comment comments reply related recommended".split())
NAMES = frozenset("article articlebody post entry story content main body-text".split())

# A quotation mark opens a value only after an equals sign, and only if it is closed later; else the value ends at white space or >.
ATTRIBUTE = r"""(?:=?[^\s/>=]++|=)(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{ATTRIBUTE})*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
MARKS = re.compile(r"(?i)\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD_PART = re.compile(r"[a-z]+")
LONG, LINK_POOR = 15, 34  # words and link density (in hundredths) of a block that speaks for its wrapper


def marked(attributes):
    """(names boilerplate, names the article) by the class, id, role and visibility of an element."""
    boilerplate = article = False
    for name, value in MARKS.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            boilerplate = True
        elif name == "style":
            boilerplate |= "display:none" in value.replace(" ", "")
        elif name in ("class", "id", "role"):
            parts = set(WORD_PART.findall(value))
            boilerplate |= bool(parts & HINTS)
            article |= bool(parts & NAMES)
    return boilerplate, article and not boilerplate


def firm(attributes):
    """Whether an element that names boilerplate is hidden, or an advert or comments: its text never outvotes that."""
    return any(name.lower() not in ("class", "id", "role") or OTHERS & set(WORD_PART.findall(value.lower()))
               for name, value in MARKS.findall(attributes) if marked(f'{name}={value}' if value else name)[0])


def outvoted(blocks):
    """Wrappers named boilerplate that hold over half the words of a page's long, link-poor blocks."""
    words, total = {}, 0
    for _, _, (sure, wrappers), _, n, linked in blocks:
        if not sure and n >= LONG and 100 * linked < LINK_POOR * n:
            total += n
            for w in wrappers:
                words[w] = words.get(w, 0) + n
    return {w for w, n in words.items() if 2 * n > total}


def blocks_of(page):
    """Flat blocks of a page: [text, in_article, in_boilerplate, heading, words, words in links].

    Tags are followed by a stack of open elements; a closing tag without its opening one is ignored, and what is
    left open ends with its parent. The first article of a page begins afresh, whatever was left open before it.
    Without one, a wrapper whose class, id or role names boilerplate is none if it holds most of the page's text.
    """
    blocks, parts, linked, unclosed, wrapper = [], [], 0, set(), 0
    # name, in article, in boilerplate (for sure, by the class of which wrappers), heading
    stack = [("", False, (False, ()), False)]
    in_link, at, n, seen = 0, 0, len(page), False

    def close_block():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, article, boilerplate, heading = stack[-1]
                blocks.append([text, article, boilerplate, heading, text.count(" ") + 1, linked])
            parts.clear()
        linked = 0

    def said(text):
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text.split())

    while at < n:
        tag = TAG.search(page, at)
        if tag is None:
            said(page[at:])
            break
        if tag.start() > at:
            said(page[at:tag.start()])
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if not tag[1]:
            if name in SILENT:
                if name not in INLINE:
                    close_block() if name in ("head", "title") else parts.append(" ")
                if not tag[3].endswith("/"):
                    closing = None if name in unclosed else re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                    if closing is None:
                        unclosed.add(name)
                    at = closing.end() if closing else n if name in RAW else at
                continue
            if name in INLINE:
                if name == "a":
                    in_link = 1
                elif name == "br":
                    parts.append(" ")
                if name in ("span", "a", "small", "label") and tag[3] and marked(tag[3])[0]:
                    close_block()
                    stack.append((name, stack[-1][1], (True, ()), False))
                continue
            close_block()
            in_link = 0
            if name in VOID:
                continue
            if stack[-1][0] == "p" or stack[-1][0] == name in ("li", "tr", "td", "th", "dt", "dd", "option"):
                stack.pop()
            _, article, (sure, wrappers), heading = stack[-1]
            bad, good = marked(tag[3]) if tag[3] and name not in ("html", "body") else (False, False)
            if name in ARTICLE and not (seen and (sure or wrappers)) and not (bad and OTHERS & set(WORD_PART.findall(tag[3].lower()))):
                article, sure, wrappers, seen = True, False, (), True
            elif name in BOILERPLATE and not (name == "header" and article) or bad and (sure or firm(tag[3])):
                sure = True
            elif bad:
                wrapper += 1
                wrappers = (*wrappers, wrapper)
            elif good and not sure:
                article = True
            stack.append((name, article, (sure, wrappers), heading or name in HEADINGS))
        elif name in INLINE:
            if name == "a":
                in_link = 0
            if stack[-1][0] == name:
                close_block()
                stack.pop()
        else:
            close_block()
            in_link = 0
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
    close_block()
    free = set() if seen else outvoted(blocks)
    for block in blocks:
        sure, wrappers = block[2]
        block[2] = sure or not free.issuperset(wrappers)
    return blocks


def features(blocks):
    """FEATURES of every block."""
    flat = [(b[4], 100 * b[5] // b[4] if b[4] else 0) for b in blocks]
    edge = (0, 0)
    return [(int(b[1]), int(b[2]), int(b[3]), *own, *(flat[i - 1] if i else edge), *(flat[i + 1] if i + 1 < len(flat) else edge))
            for i, (b, own) in enumerate(zip(blocks, flat))]


def impurity(rows):
    """Gini impurity times the number of rows."""
    ones = sum(r[-1] for r in rows)
    return 2 * ones * (len(rows) - ones) / len(rows) if rows else 0


def grow(rows, depth=6):
    """A decision tree: (feature, threshold, tree up to it, tree beyond it) or a label."""
    ones = sum(r[-1] for r in rows)
    if not depth or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))
    best = None
    for k in range(len(FEATURES)):
        values = sorted({r[k] for r in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            sides = [r for r in rows if r[k] <= cut], [r for r in rows if r[k] > cut]
            cost = impurity(sides[0]) + impurity(sides[1])
            if best is None or cost < best[0] - 1e-9:
                best = cost, k, cut, sides
    if best is None or best[0] >= impurity(rows) - 1e-9:
        return int(2 * ones >= len(rows))
    _, k, cut, (below, above) = best
    return k, cut, grow(below, depth - 1), grow(above, depth - 1)


@lru_cache(maxsize=4)
def trained(rows=LABELLED, depth=6):
    return grow(rows, depth)


def label(tree, row):
    while not isinstance(tree, int):
        k, cut, below, above = tree
        tree = below if row[k] <= cut else above
    return tree


def main_text(page, rows=LABELLED):
    """The main text of one page; "" for none. Blocks are joined by two line ends."""
    if not page:
        return ""
    tree, blocks = trained(rows), blocks_of(page)
    return "\n\n".join(b[0] for b, f in zip(blocks, features(blocks)) if label(tree, f))


def texts_of(batches, schema, rows):
    for batch in batches:
        texts = [main_text(h.as_py(), rows) for h in batch.column("html")]
        yield batch_of(schema, {"row": batch.column("row"), "text": texts}, len(texts))


def extract(df: DataFrame, html_col="html", carry=None, labelled=LABELLED) -> DataFrame:
    """The rows of ``df`` with ``text`` and its length ``n_chars`` in code points.

    Null or empty html, and pages without main text, give "". Repeated rows are extracted each on its own; an
    empty table gives no rows; columns of ``df`` named text or n_chars are replaced. ``carry`` names the columns
    to return (default: all but the html). ``labelled`` is the table the tree is grown on.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in ("text", "n_chars") and (carry or c != html_col)]
    fields = [("row", row_type(df, carry)), ("text", "string")]
    source = df.select(packed(df, carry), F.col(f"`{html_col}`").alias("html"))
    found = in_arrow(source, texts_of, fields, labelled)
    return unpacked(found, carry, {"text": F.col("text"), "n_chars": F.length("text").cast("long")})
