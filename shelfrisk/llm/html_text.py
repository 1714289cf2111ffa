"""Main text of web pages by line-block distribution (operator 7).

Markup becomes lines: each block element's text is one, with character references decoded and white space
folded. Lines inside menus, page headers and footers, sidebars, adverts, notices, forms and reader comments,
and lines outside <article> and <main> that are mostly links, count as barren (length 0). The distribution sums
line lengths over windows of ``WINDOW`` lines. A stretch runs from where the sums leave 0 to the next dive (a whole window of barren lines), so
fewer barren lines don't split it; it is text if a window in it reaches ``SURGE`` characters (a surge), headline and
other short lines included. On a page without any surge all stretches are text. If the largest run of fertile lines
is in an <article> or <main> element, the fertile lines of all such elements make the main text, whatever their lengths; else
all stretches do.

Defined results: null, empty and markup-less html are read as text; a page with no fertile line gives an
empty string and 0; repeated rows each get their row; nulls in page_id and url are passed on.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Lines of a window, and the characters in a window that make a surge.
WINDOW, SURGE = 3, 80
#: The part of a line's text in links from which on it is barren.
LINKED = 0.8

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|</?[A-Za-z][^>]*\Z", re.DOTALL)
#: An attribute's name and its value: in quotes, or up to white space.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")

# Elements by their part in a page.
RAW = frozenset("script style noscript template svg iframe object canvas textarea select option title".split())
BARREN = frozenset("nav header footer aside form button dialog menu head".split())
HEAD = frozenset("base link meta noscript script style template title".split())  # any other element ends an open head
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody
    td tfoot th thead tr ul""".split())
CLOSES = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
NOISE = frozenset("""ad ads advert advertisement adverts banner sponsor sponsored promo promotion sidebar side rail menu nav navbar
    navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices notification gdpr popup modal
    overlay comment comments disqus respond replies reply share sharing social related recommended newsletter subscribe signup
    login search pagination pager widget toolbar""".split())
#: Values of hidden with which the text is meant to be read.
SHOWN = frozenset(["false", "until-found"])
KEEP = frozenset(["article", "main", "body", "html"])
MAIN = frozenset(["article", "main"])
#: Where the raw text of an element ends: at its end tag; an option's also at what closes it when that is left out.
RAW_END = {tag: re.compile(rf"</{tag}", re.IGNORECASE) for tag in RAW}
RAW_END["option"] = re.compile(rf"</?(?:option|optgroup|select|datalist|{'|'.join(sorted(BLOCKS))})(?![A-Za-z0-9:-])", re.IGNORECASE)


class Line(NamedTuple):
    text: str
    fertile: int  # characters, 0 for a barren line
    root: int  # the outermost article or main element it is in, 0 for none


def is_noise(tag: str, attributes: str, inside: bool) -> bool:
    if tag in BARREN:
        return not (tag == "header" and inside)  # an article's own header holds its title
    if not attributes or tag in KEEP:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and value not in SHOWN or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and NOISE.intersection(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def read_lines(page: str) -> list[Line]:
    """The page's non-empty lines in order."""
    lines: list[Line] = []
    words, linked = [], 0
    stack: list[tuple[str, bool]] = []  # open elements: tag, is it noise
    opened: Counter = Counter()
    noise, links, roots, root, root_depth, at, end = 0, 0, 0, 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            words.clear()
            if text:
                barren = noise or not root_depth and linked >= LINKED * len(text)
                lines.append(Line(text, 0 if barren else len(text), root if root_depth else 0))
        linked = 0

    def close_head() -> None:
        nonlocal noise
        if stack and stack[-1][0] == "head":
            flush()
            opened["head"] -= 1
            noise -= stack.pop()[1]

    while at < end:
        m = MARKUP.search(page, at)
        start = m.start() if m else end
        if start > at:
            if opened["head"] and not page[at:start].isspace():
                close_head()
            words.append(page[at:start])
            if links:
                linked += start - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag closes what is open up to its start tag, if there is one
            if tag in BLOCKS:
                flush()
            while opened[tag]:
                name, was = stack.pop()
                opened[name] -= 1
                noise -= was
                links -= name == "a"
                root_depth -= name in MAIN
                if name == tag:
                    break
            continue
        if tag not in HEAD:
            close_head()
        if tag in RAW:
            if not m[0].endswith("/>"):
                close = RAW_END[tag].search(page, at)
                at = close.start() if close else end
            continue
        if tag == "br":
            words.append(" ")
        if tag in BLOCKS:
            flush()
        if tag in VOID or m[0].endswith("/>"):
            continue
        while stack and tag in CLOSES.get(stack[-1][0], ()):
            name, was = stack.pop()
            opened[name] -= 1
            noise -= was
        bad = is_noise(tag, m[3], root_depth > 0)
        stack.append((tag, bad))
        opened[tag] += 1
        noise += bad
        links += tag == "a"
        if tag in MAIN:
            if not root_depth:
                roots += 1
                root = roots
            root_depth += 1
    flush()
    return lines


def stretches(lengths: list[int]) -> list[tuple[int, int]]:
    """[start, end) of the lines between two dives of the window sums, if there is a surge between them or nowhere."""
    out, start, n = [], None, len(lengths)
    sums = [sum(lengths[i : i + WINDOW]) for i in range(n)]
    for i in range(n):
        if start is None and lengths[i]:
            start = i
        elif start is not None and not sums[i]:
            out.append((start, i))
            start = None
    if start is not None:
        out.append((start, n))
    return [s for s in out if max(sums[s[0] : s[1]]) >= SURGE] or out


def main_text(page: str | None) -> str:
    lines = read_lines(page or "")
    found = [lines[s:e] for s, e in stretches([x.fertile for x in lines])]
    runs = [list(run) for part in found for fertile, run in groupby(part, lambda x: x.fertile > 0) if fertile]
    best = max(runs, key=lambda run: sum(x.fertile for x in run), default=[])
    if any(x.root for x in best):  # text beside articles doesn't belong to them
        chosen = [x for x in lines if x.root]
    else:
        chosen = [x for part in found for x in part]
    return "\n\n".join(x.text for x in chosen if x.fertile)


def _extracted(batches):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("_html")]
        yield pa.RecordBatch.from_arrays([batch.column("_page"), batch.column("_url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("_page"), F.col("url").cast("string").alias("_url"), F.col("html").cast("string").alias("_html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
