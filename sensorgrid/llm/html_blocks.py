"""Main text of HTML pages by two-pass block rules.

Pass 1 cuts the page into blocks and decides each from its length, its
share of stop words and its share of linked text; blocks inside page
furniture (menus, headers, footers, asides, forms, adverts, notices, reader
comments) are decided as boilerplate by their containers.  Pass 2 gives an
undecided block, such as a short paragraph or a heading, the label of the
nearest decided blocks.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import add_columns, column

# Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = frozenset((
    "a an and are as at be been but by can for from had has have he her his i if in is it its not of on or "
    "our she so that the their there they this to was we were what when which who will with would you your "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er "
    "es für hat ich im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war wie "
    "wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et été il ils je la le les leur lui mais ne "
    "nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous y "
    "al como con cuando de del desde donde el ella en entre era es esta este ha hay la las le lo los más me "
    "mi muy no nos o para pero por que se si sin sobre son su sus también un una y ya").split())

# Elements whose content is never text of the page.
RAW = frozenset("script style noscript template svg iframe canvas head title select textarea".split())
# Of these, a missing end tag hides the rest of the page; of the others it is passed over.
HIDES_REST = frozenset("script style".split())
# Elements that are page furniture wherever they stand.
FURNITURE = frozenset("nav footer aside form menu dialog button fieldset".split())
# Words in class or id that mark furniture.
MARKS = frozenset((
    "ad ads adv advert adverts advertisement advertisements advertising adbox adsbygoogle banner banners "
    "breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr masthead menu "
    "menus modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promoted "
    "promotion related respond share sharing sidebar sidebars social sponsor sponsored subscribe toolbar widget "
    "widgets alert header replies reply discussion recommended signup login").split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Inline elements do not end a block.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr picture source input "
    "math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that end an open paragraph.
CLOSES_P = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
# Elements that part a page.
BOXES = frozenset("article blockquote body center div dl figure main ol section table td th ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                 r"<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
HEADS = frozenset(("header", "masthead"))             # of a page; inside an article they hold its title
# Elements that hold running text themselves: a name that only contains a mark ("notice-of-death") says nothing of them.
TEXTS = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figcaption td th dd dt address".split())
JOINING = frozenset("of for to the and in on with about".split())
PARAGRAPHS = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
KEEPS_P = ("div", "td", "th", "li", "button", "article", "section")
LISTS = ("ul", "ol", "dl", "table", "div", "article", "section")

LONG_WORDS, SHORT_WORDS = 30, 12      # of a surely running text; below the second a block is undecided
STOP_HIGH, STOP_LOW = 0.30, 0.15
LINKED = 0.5

GOOD, BAD, OPEN = 1, -1, 0


def _is_furniture(name: str, attrs: str, in_article: bool) -> bool:
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if attrs and ("=" in attrs or "hidden" in attrs):
        for m in ATTR.finditer(attrs):
            key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return True
            if key == "role" and value.lower() in ROLES:
                return True
            if key in ("class", "id") and name not in ("body", "html", "article", "main"):
                for one in value.split():
                    words = re.split(r"[^a-z]+", CAMEL.sub(r"\1 \2", one).lower())
                    if words[0] in ("no", "has", "with", "without"):     # says what the page has, not what this is
                        continue
                    if not JOINING.isdisjoint(words) or (name in TEXTS and not MARKS.issuperset(words)):
                        continue
                    if not MARKS.isdisjoint(words) and not (in_article and HEADS.issuperset(MARKS.intersection(words))):
                        return True
    return False


def blocks(page: str) -> list[tuple[str, int, bool, bool, int]]:
    """``(text, linked characters, in furniture, in article, box)`` of each
    block in page order; a block is the text between two block-level tags, and
    its box the number of the innermost part of the page that holds it."""
    out: list = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, bool, bool, int]] = []    # name; furniture, article, link outside it; number
    places: dict[str, list[int]] = {}                      # of open elements by name, so that no search walks the stack
    walls: list[int] = []                                  # places of open elements that are not inline
    boxes: list[int] = []                                  # numbers of open boxes
    furniture = article = link = False
    raw, at, n = "", 0, len(page)

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((text, len(SPACE.sub("", html.unescape("".join(linked)))), furniture, article, boxes[-1] if boxes else 0))
            parts.clear()
            linked.clear()

    def put(s: str) -> None:
        if s and not raw:
            parts.append(s)
            if link:
                linked.append(s)

    def pop(to: int) -> None:
        nonlocal furniture, article, link
        _, furniture, article, link, _ = stack[to]
        while len(stack) > to:
            name = stack.pop()[0]
            places[name].pop()
            if name not in INLINE:
                walls.pop()
            if name in BOXES:
                boxes.pop()

    def last(names) -> int:
        """Place of the innermost open element of these names, -1 for none."""
        return max((places[x][-1] for x in names if places.get(x)), default=-1)

    while at < n:
        m = TAG.search(page, at)
        if raw:                                       # only its own end tag ends it
            end = re.compile(rf"</{raw}(?=[\s>/])[^>]*(?:>|\Z)", re.I).search(page, at)
            raw_name, raw = raw, ""
            at = end.end() if end else (n if raw_name in HIDES_REST else at)
            continue
        if m is None:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        if m.group(1) is not None:
            put(html.escape(m.group(1)))
            continue
        if not m.group(3):
            continue
        name, attrs = m.group(3).lower(), m.group(4) or ""
        if m.group(2):                                # end tag
            if name == "br":
                put(" ")
                continue
            where = last((name,))
            if name not in INLINE:
                flush()
            if where >= 0 and not (name in INLINE and walls and walls[-1] > where):
                pop(where)
            continue
        if name in RAW:
            if name in ("head", "title", "select", "textarea"):
                flush()
            if not attrs.rstrip().endswith("/") or name in ("script", "style"):
                raw = name
            continue
        if name not in INLINE:
            flush()
            if name in CLOSES_P:
                where = last(PARAGRAPHS)
                if where > last(KEEPS_P):
                    pop(where)
            where = last(SIBLINGS.get(name, ()))
            if where > last(LISTS):
                pop(where)
        elif name == "br":
            put(" ")
        if name in VOID or attrs.rstrip().endswith("/"):
            continue
        places.setdefault(name, []).append(len(stack))
        if name not in INLINE:
            walls.append(len(stack))
        if name in BOXES:
            boxes.append(at)
        stack.append((name, furniture, article, link, at))
        furniture = furniture or _is_furniture(name, attrs, article)
        article = article or name in ("article", "main")
        link = link or name == "a"
    flush()
    return out


def first_pass(block: tuple[str, int, bool, bool, int]) -> int:
    """Decide a block by container, link density, length and stop words."""
    text, linked, furniture = block[:3]
    if furniture:
        return BAD
    if linked > LINKED * max(1, len(text) - text.count(" ")):
        return BAD
    words = WORD.findall(text.lower())
    if len(words) < SHORT_WORDS:
        return OPEN
    share = sum(w in STOP_WORDS for w in words) / len(words)
    if share >= STOP_HIGH or (len(words) >= LONG_WORDS and share >= STOP_LOW):
        return GOOD
    return OPEN


def second_pass(found: list, labels: list[int]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided ones: of their
    own box, else of the article or the rest of the page, whichever they stand
    in.  A tie, or none decided, follows the place: kept in an article, else
    dropped, unless the page has neither an article nor any block decided
    good.  Articles part the page only if they hold most of the running text
    (a teaser in an ``article`` element beside the story does not)."""
    good = [sum(len(b[0]) for b, v in zip(found, labels) if v == GOOD and b[3] == p) for p in (False, True)]
    has_article = any(b[3] and not b[2] for b in found) and good[True] >= good[False]
    if not has_article:
        found = [(*b[:3], False, b[4]) for b in found]
    any_good = GOOD in labels
    marks = [(i, v) for i, v in enumerate(labels) if v != OPEN]
    by_place = {p: _nearest(len(labels), [(i, v) for i, v in marks if found[i][3] == p and not (p and found[i][2])]) for p in (True, False)}
    by_box: dict[int, list] = {}
    out = []
    for i, v in enumerate(labels):
        if v == OPEN:
            place, box = found[i][3], found[i][4]
            if box not in by_box:
                by_box[box] = _nearest(len(labels), [(j, x) for j, x in marks if found[j][4] == box and found[j][3] == place and not found[j][2]])
            v = _vote(by_box[box][i]) or _vote(by_place[place][i])
            if v == OPEN:
                v = GOOD if place or not (has_article or any_good) else BAD
        out.append(v == GOOD and (found[i][3] or not has_article))
    return out


def _vote(near: list) -> int:
    """Label of the nearer neighbour; none for a tie or without neighbours."""
    votes = [x for x in near if x is not None]
    least = min((d for d, _ in votes), default=0)
    labels = {x for d, x in votes if d == least}
    return labels.pop() if len(labels) == 1 else OPEN


def _nearest(n: int, decided: list[tuple[int, int]]) -> list:
    """For each position the distance and label of the nearest decided block
    on either side."""
    out = [[None, None] for _ in range(n)]
    for side, order in ((0, range(n)), (1, range(n - 1, -1, -1))):
        known, last = dict(decided), None
        for i in order:
            if last is not None:
                out[i][side] = (abs(i - last[0]), last[1])
            if i in known:
                last = (i, known[i])
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    kept = second_pass(found, [first_pass(b) for b in found])
    return "\n".join(b[0] for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the main text, its blocks joined by a line
    feed (empty if there is none).  NULL reads as empty; cut-off pages are
    read to their end; repeated rows stay; an input column named like ``out``
    is replaced."""

    def make():
        return lambda batch: [pa.array([main_text(p) for p in column(batch, page).to_pylist()], type=pa.string())]

    return add_columns(pages, [T.StructField(out, T.StringType())], make, page, 16_000_000)


def summary(extracted: DataFrame) -> DataFrame:
    return extracted.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
