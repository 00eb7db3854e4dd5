"""Main text of web pages by tree scoring.

Every paragraph passes points for its length and commas to the elements around it, fewer the
further out they are and the more of the paragraph is link text. The element with the most
points is the article; its siblings join if they score well too. What stays are the blocks of
these elements in page order.

Parts that are never article are left out while the page is read: navigation, headers,
footers, asides, controls, scripts and styles by their tags or roles. Forms, and elements whose
class or id has a whole word for adverts, notices, menus, sharing or reader comments, are only
suspects, since a form may hold the whole page and such words are also in names of wrappers and
in ids made from headings. They are read, and left out before the scores if the rest of the
page is enough without them (``suspects``). A page that has no text without its navigation,
headers, footers and hidden parts is read again with these as suspects too, if they hold prose.

Any text is a page: markup that is no tag of HTML is skipped as the HTML standard does, and the
time is linear in the length of the page.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from paperloom.llm.arrow import map_texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end a block of text where they begin and where they end.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that can be the article.
CONTAINERS = frozenset(
    "html body main article section div td blockquote center figure details".split()
)
# Elements that are no text, and elements that are no article unless there is nothing else.
LEFT_OUT = frozenset(
    "head script style noscript template svg math iframe object canvas audio video button "
    "select option textarea input".split()
)
ASIDE = frozenset("header nav footer aside menu dialog label".split())
# Elements whose content has no tags, up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split()
)
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored "
    "promo promotion promoted banner cookie cookies consent gdpr notice notices notification alert "
    "popup modal overlay newsletter subscribe subscription signup paywall menu menus nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail widget widgets "
    "footer header masthead topbar toolbar comment comments commentlist disqus replies reply respond "
    "share sharing social related recommended recommendations outbrain taboola skip hidden "
    "toc form login search".split()
)
# Elements that a word makes suspect: no headings, no paragraphs, nothing inside a line.
SUSPECT = BLOCK - HEADINGS - {"html", "body", "main", "p"}
FORMS = frozenset(("form", "fieldset"))
LISTS = frozenset("ul ol dl table".split())
# Elements that end an open one of their kind, up to the element that holds them.
CLOSES = {
    "li": ("ul", "ol", "menu", "dir"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("tr", "table"),
    "th": ("tr", "table"),
}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

LEVELS = 6  # elements around a paragraph that get points
PARAGRAPH = 25  # shorter blocks pass no points
BONUS = {"article": 25.0, "main": 15.0}
SIBLING = 0.2  # share of the best score that lets a sibling join
MENU_LINKS = 0.7  # share of link text that makes a list a menu
REST = 0.1  # share of the points outside of suspects below which these are the page
MOST_TEXT = 0.25  # share of the text without links that goes with most of the points


# Where markup begins: a comment, a tag, or something else that is skipped up to the next ">".
MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
# The end of a tag, or the next of its attributes up to its value.
IN_TAG = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(\s*=\s*)?)")
UNQUOTED = re.compile(r"[^\s>]*")


class Page:
    """Blocks of text of one page, and the tree of elements that hold them.

    With ``lenient`` navigation, headers, footers and hidden parts are suspects; otherwise they
    are left out.
    """

    def __init__(self, html: str, lenient: bool = False) -> None:
        self.lenient = lenient
        self.cut = False  # whether something was left out that would be a suspect
        self.tags = ["#root"]
        self.parents = [-1]
        self.stack = [0]
        self.open_at: dict[str, list[int]] = defaultdict(list)  # places in the stack by tag
        self.blocks_at = [0]  # places in the stack of open blocks
        self.out_at: list[int] = []  # stack depths of open parts that are left out
        self.header_at: list[int] = []  # stack depths of open headers inside an article
        self.suspects: dict[int, str] = {}  # elements with a word, in page order
        self.slugs: dict[int, set[str]] = {}  # words of their id, where only that has a word
        self.plain: list[int] = []  # articles without a word
        self.named: list[int] = []  # outermost articles with one
        self.links = 0
        self.articles = 0
        self.headings = 0
        self.parts: list[str] = []
        self.link_chars = 0
        self.blocks: list[tuple[int, str, float]] = []
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        """Read the whole page. What ends nowhere (a tag, a comment) reaches to the page's end."""
        last = {c: html.rfind(c) for c in "\"'>"}
        at = 0
        while found := MARKUP.search(html, at):
            if found.start() > at:
                self.handle_data(unescape(html[at : found.start()]))
            comment, end_tag, name = found.groups()
            if comment:
                closed = html.find("-->", found.start() + 2)
                at = len(html) if closed < 0 else closed + 3
            elif name is None:
                closed = html.find(">", found.end() - 1)
                at = len(html) if closed < 0 else closed + 1
            elif found.start() > last[">"]:
                return
            else:
                attrs, at = read_attributes(html, found.end(), last)
                if at < 0:
                    return
                tag = name.lower()
                if end_tag:
                    self.handle_endtag(tag)
                    continue
                self.handle_starttag(tag, attrs)
                if tag in RAW:
                    closing = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                    inner = html[at : closing.start() if closing else len(html)]
                    self.handle_data(unescape(inner))
                    self.handle_endtag(tag)
                    at += len(inner)
        self.handle_data(unescape(html[at:]))

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                node = self.stack[self.blocks_at[-1]]
                self.blocks.append((node, text, min(1.0, self.link_chars / len(text))))
            self.parts = []
        self.link_chars = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCK:
            self.close_open("p", self.blocks_at[-1])
            for same in SAME.get(tag, (tag,) if tag in CLOSES else ()):
                self.close_open(same, max((self.open_at[u][-1] for u in CLOSES[tag] if self.open_at[u]), default=0))
            self.flush()
        elif tag == "a":
            self.close_open("a", self.blocks_at[-1])
        self.push(tag, attrs)

    def push(self, tag: str, attrs: list) -> None:
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.open_at[tag].append(len(self.stack))
        if tag in BLOCK:
            self.blocks_at.append(len(self.stack))
        self.stack.append(len(self.tags) - 1)
        depth = len(self.stack)
        if tag == "a":
            self.links += 1
        if self.out_at:
            return
        if self.articles and tag == "header":
            self.header_at.append(depth)  # of an article: only its headings stay
            return
        if tag in LEFT_OUT:
            self.out_at.append(depth)
            return
        beside = stands_beside(tag, attrs)
        if beside and not self.lenient:
            self.cut = True
            self.out_at.append(depth)
            return
        node = self.stack[-1]
        word = suspect_word(tag, attrs) or ("part" if beside or tag in FORMS else "")
        if tag in ("article", "main"):
            if not word:
                self.plain.append(node)
            elif not self.articles:
                self.named.append(node)
                word = ""  # an article inside another one may be a comment
            self.articles += 1
        elif tag in HEADINGS:
            self.headings += 1
        if word:
            # Of a header of an article the headings stay in any case.
            self.suspects[node] = "header" if self.articles and word == "header" else "part"
            self.slugs[node] = slug(attrs)

    def pop(self) -> None:
        depth = len(self.stack)
        tag = self.tags[self.stack[-1]]
        if tag in BLOCK:
            self.flush()
            self.blocks_at.pop()
        self.stack.pop()
        self.open_at[tag].pop()
        if tag == "a":
            self.links -= 1
        if self.out_at and self.out_at[-1] == depth:
            self.out_at.pop()
            return
        if self.header_at and self.header_at[-1] == depth:
            self.header_at.pop()
        elif not self.out_at:
            if tag in ("article", "main"):
                self.articles -= 1
            elif tag in HEADINGS:
                self.headings -= 1

    def close_open(self, tag: str, barrier: int) -> None:
        """Close the innermost open ``tag`` unless it lies below ``barrier`` in the stack."""
        if self.open_at[tag] and self.open_at[tag][-1] >= max(1, barrier):
            at = self.open_at[tag][-1]
            while len(self.stack) > at:
                self.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag not in VOID:
            # The end tag of an element within a line closes nothing across a block.
            self.close_open(tag, 0 if tag in BLOCK else self.blocks_at[-1])

    def handle_data(self, data: str) -> None:
        if self.out_at or (self.header_at and not self.headings):
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data.strip())


def read_attributes(html: str, at: int, last: dict[str, int]) -> tuple[list, int]:
    """Attributes of a tag and where it ends, -1 for nowhere.

    ``last`` has the last places of quotes, so that a quote without an end is known at once; its
    value ends like one without quotes.
    """
    attrs: dict[str, str | None] = {}
    while found := IN_TAG.match(html, at):
        at = found.end()
        end, name, given = found.groups()
        if end:
            return list(attrs.items()), at
        value = None
        if given:
            quote = html[at : at + 1]
            if quote in ("'", '"') and last[quote] > at:
                closed = html.index(quote, at + 1)
                value, at = html[at + 1 : closed], closed + 1
            else:
                value = UNQUOTED.match(html, at).group()
                at += len(value)
            value = unescape(value)
        attrs.setdefault(name.lower(), value)
    return [], -1


def stands_beside(tag: str, attrs: list) -> bool:
    """Whether an element is no article by its tag, its role, or because it is hidden."""
    if tag in ASIDE:
        return True
    for name, value in attrs:
        if name == "hidden":
            return True
        if not value:
            continue
        if name == "role" and value.strip().lower() in ROLES:
            return True
        if name == "aria-hidden" and value.strip().lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def words_of(text: str) -> list[str]:
    return [w for w in re.split("[^a-z]+", text.lower()) if w]


def suspect_word(tag: str, attrs: list) -> str:
    """A word of the class or id that makes an element suspect, or empty."""
    if tag not in SUSPECT:
        return ""
    for name, value in attrs:
        if value and name in ("class", "id"):
            found = WORDS.intersection(words_of(value))
            if found:
                return "header" if found == {"header"} else min(found)
    return ""


def slug(attrs: list) -> set[str]:
    """Words of an id that may be made from a heading: more than words for parts of a page."""
    given = {name: set(words_of(value or "")) for name, value in attrs if name in ("class", "id")}
    found = given.get("id", set())
    return set() if WORDS & given.get("class", set()) or found <= WORDS else found


def main_text(html: str | None) -> str:
    """Article text of a page: blocks joined by an empty line; empty for null or no text."""
    if not html:
        return ""
    page = Page(html)
    found = select(page)
    if not found and page.cut:
        page = Page(html, lenient=True)
        if any(gained_points(text, linked) for _, text, linked in page.blocks):
            found = select(page)
    return "\n\n".join(found)


def gained_points(text: str, linked: float) -> float:
    """Points that a block passes to the elements around it."""
    if len(text) < PARAGRAPH:
        return 0.0
    return (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked)


def suspects(page: Page) -> set[int]:
    """Suspects that are no article: what they hold is left out.

    A suspect stays if it holds an article, most of the page's points, or a heading that its
    id is made from. If next to nothing has points outside of suspects, all of them stay. The
    same holds for suspects inside those that stay, against what is not left out by then.
    """
    tags, parents = page.tags, page.parents
    points = [0.0] * len(tags)
    plain_chars = [0.0] * len(tags)
    chars = [0] * len(tags)
    for node, text, linked in page.blocks:
        points[node] += gained_points(text, linked)
        plain_chars[node] += (1 - linked) * len(text)
        chars[node] += len(text)
    holds = [False] * len(tags)
    for node in page.plain or page.named:
        holds[node] = True
    for node in range(len(tags) - 1, 0, -1):  # children come after their parents
        points[parents[node]] += points[node]
        plain_chars[parents[node]] += plain_chars[node]
        chars[parents[node]] += chars[node]
        holds[parents[node]] |= holds[node]
    around = [0] * len(tags)  # innermost suspect around or at an element
    for node in range(1, len(tags)):
        around[node] = node if node in page.suspects else around[parents[node]]
    stays, seen = set(), set()
    for node, text, _ in page.blocks:
        at = around[node]
        if at and at not in seen and tags[node] in HEADINGS:
            seen.add(at)
            linked = plain_chars[at] < (1 - MENU_LINKS) * chars[at]
            if page.slugs[at] and page.slugs[at] <= set(words_of(text)) and not linked:
                stays.add(at)
    inner: dict[int, list[int]] = {}
    for node in page.suspects:
        inner.setdefault(around[parents[node]], []).append(node)
    out = set()
    measure = points if points[0] > 0 else chars
    total, all_chars = measure[0], plain_chars[0]
    scopes = [0]
    while scopes:
        found = inner.get(scopes.pop(), [])
        kept = [n for n in found if holds[n] or n in stays]
        doubtful = [n for n in found if not (holds[n] or n in stays)]
        rest = total - sum(measure[n] for n in doubtful)
        rest_chars = all_chars - sum(plain_chars[n] for n in doubtful)
        if rest >= REST * total or rest_chars > (1 - MOST_TEXT) * all_chars:
            most = [
                n for n in doubtful
                if 2 * measure[n] > total and plain_chars[n] >= MOST_TEXT * all_chars
            ]
        else:
            # Of the suspects that are all there is, those stay that one with most does not outdo.
            most = [n for n in doubtful if 2 * measure[n] > total] or doubtful
        left = set(doubtful).difference(most)
        out |= left
        total -= sum(measure[n] for n in left)
        all_chars -= sum(plain_chars[n] for n in left)
        scopes += kept + most
    return out


def without_suspects(page: Page) -> list[tuple[int, str, float]]:
    """Blocks of a page that are in no suspect that is left out."""
    if not page.suspects:
        return page.blocks
    left = suspects(page)
    state = [""] * len(page.tags)  # why the text of an element is left out
    for node in range(1, len(state)):
        above = state[page.parents[node]]
        state[node] = page.suspects[node] if node in left and above != "part" else above
        if state[node] == "header" and page.tags[node] in HEADINGS:
            state[node] = ""
    return [block for block in page.blocks if not state[block[0]]]


def lists_said_before(
    tags: list[str], parents: list[int], blocks: list[tuple[int, str, float]]
) -> dict[int, tuple[str, str]]:
    """For every list the tag and the text of the block that is next to it before it begins."""
    found = {node: ("", "") for node, tag in enumerate(tags) if tag in LISTS}
    previous = [0] * len(tags)  # the element before one in the same parent
    last_child = [0] * len(tags)
    for node in range(1, len(tags)):
        previous[node], last_child[parents[node]] = last_child[parents[node]], node
    last_text: dict[int, str] = {node: text for node, text, _ in blocks}
    for node in found:
        if previous[node] in last_text:
            found[node] = (tags[previous[node]], last_text[previous[node]])
    return found


def announced(said: tuple[str, str]) -> bool:
    """Whether a list of links belongs to a text: its heading says so, or a colon before it."""
    tag, text = said
    return text.endswith(":") or (tag in HEADINGS and not WORDS.intersection(words_of(text)))


def select(page: Page) -> list[str]:
    tags, parents, blocks = page.tags, page.parents, without_suspects(page)
    points = [0.0] * len(tags)
    chars = [0] * len(tags)
    link_chars = [0.0] * len(tags)
    n_links = [0] * len(tags)
    around = [-1] * len(tags)  # innermost element that can be the article
    said_before = lists_said_before(tags, parents, blocks)
    for node, tag in enumerate(tags):
        around[node] = node if tag in CONTAINERS else around[parents[node]] if node else -1
    for node, text, linked in blocks:
        gained = gained_points(text, linked)
        chars[node] += len(text)
        link_chars[node] += linked * len(text)
        n_links[node] += linked > 0.5
        level, at = 0, around[node]
        while gained and at >= 0 and level < LEVELS:
            level += 1
            points[at] += gained / (1 if level == 1 else 2 if level == 2 else 3 * (level - 1))
            at = around[parents[at]] if at else -1
    for node in range(len(tags) - 1, 0, -1):  # children come after their parents
        chars[parents[node]] += chars[node]
        link_chars[parents[node]] += link_chars[node]
        n_links[parents[node]] += n_links[node]
    best, best_score = 0, -1.0
    for node, tag in enumerate(tags):
        if tag in CONTAINERS and chars[node]:
            points[node] = (points[node] + BONUS.get(tag, 0.0)) * (1 - link_chars[node] / chars[node])
            # Where nothing scores, the outermost element holds everything.
            if points[node] > best_score:
                best, best_score = node, points[node]
    accepted = {best}
    if best:
        bar = max(10.0, SIBLING * best_score)
        seen_best = False
        for node in [n for n, p in enumerate(parents) if p == parents[best]]:
            seen_best |= node == best
            if not chars[node] or node == best:
                continue
            sparse = link_chars[node] / chars[node] < 0.25
            prose = tags[node] == "p" and sparse and (chars[node] > 80)
            title = tags[node] in ("h1", "h2") and not seen_best
            if points[node] >= bar or prose or title:
                accepted.add(node)
    inside = [False] * len(tags)
    for node, tag in enumerate(tags):
        menu = (
            tag in LISTS
            and n_links[node] >= 3
            and link_chars[node] >= MENU_LINKS * chars[node]
            # An article may have a list of links, and a heading or a colon announce one.
            and tags[best] not in ("article", "main")
            and not announced(said_before[node])
        )
        inside[node] = node in accepted or (node > 0 and inside[parents[node]] and not menu)
    return [text for node, text, _ in blocks if inside[node]]


def extract(
    pages: DataFrame, html_col: str = "html", carry: list[str] | None = None
) -> DataFrame:
    """Rows (row, main_text) from whole pages, well-formed or not.

    Null or empty html, and pages without text, give the empty string. Repeated rows are
    extracted alike. ``row`` holds the columns of ``carry`` (all for None) whatever their
    names are.
    """

    def prepare():
        return lambda pages: [pa.array([main_text(p) for p in pages], pa.string())]

    fields = [StructField("main_text", StringType(), False)]
    return map_texts(pages, html_col, carry, fields, prepare)
