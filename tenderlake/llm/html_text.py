"""The main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block-level element. The weights of
the lines, which are the lengths of their text outside links, are summed over a
sliding window. Text begins where the sums surge to a threshold, ends where
they dive to zero, and what lies between is kept.

Tags never keep or drop a line by themselves; they weigh:

* A line in an article or main element weighs MARK more, so nearly any article
  surges, but not a lone number or mark beside a long text.
* A line in a menu, header, footer, side bar, advert, notice, form or comment
  weighs a hundredth (FAINT). Such lines are a run of their own, so they neither
  cause a surge nor a dive amid the text around them.

Windows do not reach over the edge of an article or of a faint run. The
threshold is SURGE, or half of the page's highest sum where that is less, so
that little text on a page without more stands out as well. In an article the
text also reaches back from its surge to where the sums were zero, as it reaches
forth to the dive; elsewhere only headings just before a surge join it.

Scripts, styles, form controls, hidden elements and the like show no text and
are stripped with the markup. Null, empty and text-free pages give an empty
text. Rows that are alike give alike texts; no page is dropped or cut, however
long. Columns named text or n_chars are replaced, others left alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import with_columns

WINDOW = 3
SURGE = 86
#: What a line in an article weighs more, the share of its length that a line of a menu, advert and the like weighs, and the least sum of a run of those that surges.
MARK, FAINT, FAINT_SURGE = 80, 0.01, 2.0

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup: it ends at the first end tag of the name.
RAW = frozenset("script style title textarea xmp noembed noframes iframe".split())
#: Elements that show no running text.
UNSEEN = frozenset("script style title textarea noscript template select button iframe svg canvas object head xmp noembed noframes audio video map".split())
#: Elements of what is not main text.
MARGINS = frozenset("nav footer aside form dialog menu".split())
#: Names of classes and ids of what is not main text, and words that go with them in a name.
SIGNS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner banners sidebar sidebars menu menus submenu nav navs navbar navigation topbar breadcrumb breadcrumbs"
    " footer footers masthead cookie cookies consent notice notices gdpr alert popup modal overlay newsletter subscribe subscription signup share sharing social related"
    " recommended recommendations comment comments commentlist respond disqus login search searchbox widget toolbar copyright pagination pager skip hidden".split()
)
FILLERS = frozenset(
    "box block container wrapper wrap inner outer section area bar list item items group unit slot panel column col row rail left right top bottom main global page site post posts article articles story blog reader user"
    " link links button buttons icon icons form content body text title widget widgets module footer header js fixed sticky mobile desktop small large primary secondary id the and of in to my".split()
)
#: Elements that hold a piece of text rather than a part of the page. On these, only a name that is a sign as a whole counts.
PIECES = frozenset("p span a b i em strong small big sub sup u s q cite code pre blockquote h1 h2 h3 h4 h5 h6 li dt dd td th tr tbody thead caption figcaption figure img mark label time abbr font center br hr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Containers that an unclosed paragraph or list item does not reach out of.
HOLDERS = frozenset("article aside blockquote body dd details div dl fieldset figure footer form header html li main nav ol section table td th tr ul".split())


def _is_sign(name: str, within_piece: bool, in_article: bool) -> bool:
    """Whether a class or an id names what is not main text: menu, siteMenu and ad-box do, share-price does not."""
    if name.lower() in SIGNS:
        return True
    if within_piece:
        return False
    parts = {x.lower() for x in NAME_PART.findall(name)}
    headed = "header" in parts and not in_article
    return (headed or not SIGNS.isdisjoint(parts)) and parts <= SIGNS | FILLERS


def _standing(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is unseen, and whether it is a part of the page that is not main text."""
    if name in UNSEEN:
        return True, False
    faint = name in MARGINS or name == "header" and not in_article
    if not attributes or name in ("html", "body", "main", "article") or "=" not in attributes and "hidden" not in attributes:
        return False, faint
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes):
        return True, faint
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            faint = faint or any(_is_sign(x, name in PIECES, in_article) for x in value.split())
        elif key == "role":
            faint = faint or value.lower() in ROLES
        elif key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, faint
    return False, faint


class Line(NamedTuple):
    """A line of a page: its text, the characters of it in links, and where it stands."""

    text: str
    links: int
    in_article: bool
    faint: bool
    heading: bool


def lines_of(page: str) -> list[Line]:
    """The page's lines in their order, without what is unseen."""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, unseen, faint, in an article
    opened: dict[str, int] = {}
    text: list[str] = []
    links = 0

    def end_line(heading: bool = False) -> None:
        nonlocal links
        if text:
            if joined := " ".join("".join(text).split()):
                lines.append(Line(joined, links, in_article, faint, heading))
            text.clear()
        links = 0

    def close(name: str) -> None:
        while stack:
            top = stack.pop()[0]
            opened[top] -= 1
            if top == name:
                break

    unseen = faint = in_article = False
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and not unseen:
            piece = html.unescape(page[at:start])
            text.append(piece)
            if opened.get("a"):
                links += len(piece)
        if start >= size:
            break
        m = TOKEN.match(page, start)
        if not m:
            if not unseen:
                text.append("<")
            at = start + 1
            continue
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            if name in BLOCKS:
                end_line(name in HEADINGS)
            if opened.get(name):
                close(name)
                unseen, faint, in_article = stack[-1][1:] if stack else (False, False, False)
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            end_line()
            if opened.get("p") and name != "p" or opened.get(name) and name in ("p", "li", "option", "dt", "dd", "tr", "td", "th"):
                # an open paragraph ends here, as does an open item of the same kind
                for k in range(len(stack) - 1, -1, -1):
                    top = stack[k][0]
                    if top == "p" or top == name:
                        while len(stack) > k:
                            opened[stack.pop()[0]] -= 1
                        break
                    if top in HOLDERS:
                        break
                unseen, faint, in_article = stack[-1][1:] if stack else (False, False, False)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}", re.I).search(page, at)
            at = end.start() if end else size
        marked = name in ("article", "main") or "main" in attributes and re.search(r"\brole\s*=\s*[\"']?main\b", attributes, re.I) is not None
        hides, margin = _standing(name, attributes, in_article)
        if marked and opened.get("form") and not any(s[2] and s[0] != "form" for s in stack):
            faint = False  # pages that are one form as a whole
        unseen, faint, in_article = unseen or hides, faint or margin, in_article or marked
        stack.append((name, unseen, faint, in_article))
        opened[name] = opened.get(name, 0) + 1
    end_line()
    return lines


def weight_of(line: Line) -> float:
    if line.faint:
        return FAINT * max(0, len(line.text) - line.links)
    return MARK + len(line.text) if line.in_article else max(0, len(line.text) - line.links)


def _runs(lines: list[Line]) -> list[list[int]]:
    """The places of lines that follow each other with nothing of another kind between; text reads on past faint lines."""
    runs: list[list[int]] = []
    plain: list[int] = []
    for k, line in enumerate(lines):
        if line.faint:
            if k and lines[k - 1].faint:
                runs[-1].append(k)
            else:
                runs.append([k])
        else:
            if plain and lines[plain[-1]].in_article != line.in_article:
                runs.insert(0, plain)
                plain = []
            plain.append(k)
    return [*runs, plain] if plain else runs


def kept_lines(lines: list[Line], window: int = WINDOW, surge: float = SURGE) -> list[int]:
    """The places of the lines between each surge and its dive."""
    runs = [(run, [weight_of(lines[k]) for k in run]) for run in _runs(lines)]
    summed = [(run, weights, [sum(weights[i : i + window]) for i in range(len(run))]) for run, weights in runs]
    surge = min(surge, max((max(sums) for _, _, sums in summed), default=0.0) / 2)
    kept: list[int] = []
    for run, weights, sums in summed:
        first, i, done = lines[run[0]], 0, 0  # up to done, lines are decided on
        least = max(surge, FAINT_SURGE) if first.faint else surge
        while i < len(run):
            if not weights[i] or sums[i] < least:
                i += 1
                continue
            start = i
            while start > done and weights[start - 1] and (first.in_article or lines[run[start - 1]].heading):
                start -= 1
            while i < len(run) and sums[i] > 0:
                i += 1
            kept += run[start:i]
            done = i
    return sorted(kept)


def main_text(page: str | None, window: int = WINDOW, surge: float = SURGE) -> str:
    """The main text, its blocks joined by a blank line; empty for null, empty and text-free pages."""
    lines = lines_of(page or "")
    return "\n\n".join(lines[k].text for k in kept_lines(lines, window, surge))


def _row() -> Callable[[str | None], tuple]:
    def one(page: str | None) -> tuple:
        text = main_text(page)
        return text, len(text)

    return one


def extract(pages: DataFrame, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """pages with text and n_chars; columns of those names are replaced."""
    return with_columns(pages, html_column, "text string, n_chars long", _row, keep)
