"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Text in navigation, footers, asides, dialogs, scripts and hidden or
tell-tale elements (class, id, role; of any element) is left out; forms and tell-tale boxes only as long as they don't hold the page
itself (an h1, a main element, or nine tenths of the text with no h1 or article outside).

Pass 1 looks at each block: link density, length and stop-word density make it good, bad, or ambiguous (short, a heading,
or of middling density); a copyright line is bad. The page's article (else its main element) is a feature of that: if half of the text that is not
bad lies in it, what lies outside is bad, inside stop words alone make a block of any but short length good, and a lack of them is ambiguous instead of bad.
In pass 2 ambiguous blocks, those of middling density first, inherit from the nearest decided blocks before and after: from both if they agree,
else from the nearer one, and if they are equally near, a block of stop words or of a sentence's form is good. The edge of the
article counts as a good neighbour, that of a page without one as a bad neighbour. A heading inherits from what follows.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one newline; two line
breaks in a row end a block. Null or empty html gives the empty text; markup that never closes is read to the end; nothing
is cut off. Repeated rows stay, other columns are left out. The scan is linear in the page.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, table

STOP_WORDS = frozenset(
    # en
    "a about after all also an and any are as at be because been but by can could do for from had has have he her his how i if in into is it its just more most my no not now of on one only or other our out over she so some such than that the their them then there these they this to up was we were what when where which who will with would you your "
    # de
    "aber als am an auch auf aus bei bin bis das dass dem den der des die dies du durch ein eine einem einen einer eines er es für hat hatte ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war was wie wir wird zu zum zur "
    # fr
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos notre nous on ou où par pas pour qu que qui sa se ses si son sur ta te tes toi ton tu un une vos votre vous y était être "
    # es
    "al algo como con cual cuando de del desde donde el ella ellos en entre era es esta este esto fue ha hay la las le les lo los me mi muy más ni no nos o os para pero por porque que quien se si sin sobre son su sus también te tiene todo tu un una unas uno unos y ya yo".split()
)

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements whose content is no text of the page; those of controls end with the next block.
_HIDDEN = frozenset("noscript template object canvas audio video svg math datalist".split())
_CONTROL = frozenset("button select option optgroup".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BOX = frozenset("article main nav header footer aside form div section ul ol dl table tbody thead tfoot tr td th body figure dialog fieldset details blockquote menu address center".split())
_BREAK = _BOX | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr caption figcaption legend summary html head".split())
_WALLS = _BOX | _HIDDEN
#: Elements that a start tag of one of these ends, within the same box.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_SCOPE = frozenset("article main body html".split())
_BAD_TAG = frozenset("nav footer aside dialog menu".split())
_BAD_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar note".split())
_BAD_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|adbox|banner|sponsor(?:ed|s)?|promo(?:tion)?s?|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|social|shar(?:e|ing)|related|recommend(?:ed|ations)?|comments?|commentlist|disqus|replies|respond|sidebar|widgets?|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|copyright|pagination|pager|toolbar|login|teasers?|disclaimer|feedback|reviews?)(?:$|[\s_-])",
    re.I,
)
_HEADER_WORD = re.compile(r"(?:^|[\s_-])(?:header|topbar|site-title)(?:$|[\s_-])", re.I)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACE = re.compile(r"\s+")
GOOD, BAD, SHORT, NEAR = range(4)
#: Pass 1: link density, lengths in characters, stop-word densities.
MAX_LINKS, MIN_LENGTH, GOOD_LENGTH, LOW_STOP, HIGH_STOP = 0.4, 60, 140, 0.08, 0.2
#: Share of the text that is not bad which an article must hold, and which a tell-tale box must hold to be the page itself.
ARTICLE_SHARE, PAGE_SHARE = 0.5, 0.9


class Block:
    """links: characters of it in links; inside: 2 in an article, 1 in a main element; soft: numbers of the forms and tell-tale boxes around it."""

    __slots__ = ("text", "links", "inside", "heading", "soft")

    def __init__(self, text: str, links: int, inside: int, heading: bool, soft: tuple[int, ...]):
        self.text, self.links, self.inside, self.heading, self.soft = text, links, inside, heading, soft


class _Open:
    """An open element with what holds inside it."""

    __slots__ = ("name", "bad", "inside", "soft", "link")

    def __init__(self, name: str, bad: bool, inside: int, soft: tuple[int, ...], link: bool):
        self.name, self.bad, self.inside, self.soft, self.link = name, bad, inside, soft, link


class _Page:
    """Blocks with text, in page order."""

    def __init__(self, html: str):
        self.html = html
        self.blocks: list[Block] = []
        self.whole: set[int] = set()  # soft boxes that hold an h1 or a main element
        self.marks: list[tuple[int, ...]] = []  # the soft boxes around each h1, main element and article
        self.stack = [_Open("", False, 0, (), False)]
        self.open: dict[str, int] = {}  # how many of each name are open
        self.ends: dict[str, int] = {}  # where the last end tag of a name is
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.heading, self.breaks, self.boxes = False, 0, 0
        self._scan()

    def _flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", unescape("".join(self.parts))).strip()
            if text:
                links = len(_SPACE.sub(" ", unescape("".join(self.linked))).strip()) if self.linked else 0
                top = self.stack[-1]
                self.blocks.append(Block(text, links, top.inside, self.heading, top.soft))
            self.parts = []
        self.linked = []
        self.breaks = 0

    def _text(self, piece: str) -> None:
        top = self.stack[-1]
        if piece and not top.bad:
            self.parts.append(piece)
            if top.link:
                self.linked.append(piece)
            if self.breaks and not piece.isspace():
                self.breaks = 0

    def _last_end(self, name: str) -> int:
        if name not in self.ends:
            self.ends[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}[\\s/>]", self.html, re.I)), default=-1)
        return self.ends[name]

    def _scan(self) -> None:
        html, at, n = self.html, 0, len(self.html)
        while at < n:
            start = html.find("<", at)
            if start < 0:
                break
            if html.startswith("<!--", start) or html.startswith("<![CDATA[", start):
                close = "-->" if html[start + 2] == "-" else "]]>"
                end = html.find(close, start)
                self._text(html[at:start])
                at = n if end < 0 else end + 3
                continue
            m = _NAME.match(html, start + 1)
            if m is None:
                if html.startswith(("<!", "<?", "</"), start):
                    end = html.find(">", start)
                    self._text(html[at:start])
                    at = n if end < 0 else end + 1
                else:  # a sign, not a tag
                    self._text(html[at : start + 1])
                    at = start + 1
                continue
            rest = _REST.match(html, m.end())
            end = rest.end() if rest else html.find(">", m.end()) + 1
            self._text(html[at:start])
            if not end:  # no tag ends any more
                self._text(html[start:])
                at = n
                break
            at = end
            name = m[0].lower()
            if name[0] == "/":
                self._close(name[1:])
            elif name in _RAW:
                if not html.endswith("/>", start, end):
                    close = re.compile(f"</{name}[\\s/>]", re.I).search(html, end) if self._last_end(name) >= end else None
                    stop = html.find(">", close.start()) if close else -1
                    if close is None and name not in ("script", "style"):
                        continue
                    at = n if stop < 0 else stop + 1
            else:
                self._start(name, html[m.end() : end - 1])
        if at < n:
            self._text(html[at:])
        self._flush()

    def _pop(self, upto: int) -> None:
        while len(self.stack) > upto:
            self.open[self.stack.pop().name] -= 1

    def _find(self, names: tuple[str, ...], stop: frozenset[str]) -> int:
        """The topmost open element of these names that is not behind one of ``stop``; 0 if there is none."""
        if not any(self.open.get(x) for x in names):
            return 0
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name in names:
                return k
            if self.stack[k].name in stop:
                return 0
        return 0

    def _close(self, name: str) -> None:
        if name in _BREAK:
            self._flush()
            self.heading = False
        elif name == "br":
            return
        if k := self._find((name,), frozenset() if name in _SCOPE else _SCOPE):
            self._pop(k)

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self.breaks += 1
            self._text(" ")
            if self.breaks > 1:
                self._flush()
            return
        if name in _BREAK:
            self._flush()
            self.heading = name in _HEADING
            for names in (("p",), _ENDS.get(name, ()), tuple(_CONTROL)):
                if names and (k := self._find(names, _WALLS - {"tr", "td", "th"} if name in _ENDS else _WALLS)):
                    self._pop(k)
        if name == "a" and (k := self._find(("a",), _WALLS)):
            self._pop(k)
        if name in _VOID or rest.endswith("/"):
            return
        top = self.stack[-1]
        bad, inside, soft, link = top.bad, top.inside, top.soft, top.link
        attrs: dict[str, str] = {}
        for k, v in _ATTR.findall(rest) if rest.strip() else ():
            attrs.setdefault(k.lower(), v.strip("\"'"))
        role, marks = attrs.get("role", "").lower(), f"{attrs.get('class', '')} {attrs.get('id', '')}"
        telling = len(marks) > 1 and name not in ("main", "body", "html") and _BAD_WORD.search(marks) is not None
        if name in _BAD_TAG or role in _BAD_ROLE or name in _CONTROL or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
            bad = True
        elif name in _HIDDEN:
            bad = bad or self._last_end(name) >= 0
        elif name == "header" and not inside or not inside and len(marks) > 1 and _HEADER_WORD.search(marks):
            bad = True
        elif name in ("form", "fieldset") or telling and name in _BOX:
            self.boxes += 1
            soft = (*soft, self.boxes)
        elif telling:
            bad = True
        if name == "article" and not telling:
            inside = 2
        elif (name == "main" or role == "main") and not inside:
            inside = 1
        if (name == "h1" or name == "main") and not bad:
            self.whole.update(soft)
        if name in ("h1", "main", "article") and not bad and not telling:
            self.marks.append(soft)
        if name == "a":
            link = "href" in attrs or not ("name" in attrs or "id" in attrs)  # a target is none
        self.stack.append(_Open(name, bad, inside, soft, link))
        self.open[name] = self.open.get(name, 0) + 1


def blocks_of(html: str) -> list[Block]:
    """Blocks with text in page order, without those of forms and tell-tale boxes that aren't the page itself."""
    page = _Page(html)
    if not page.boxes:
        return page.blocks
    held: dict[int, int] = {}
    for b in page.blocks:
        for k in b.soft:
            held[k] = held.get(k, 0) + len(b.text)
    total = sum(len(b.text) for b in page.blocks)
    left = {k for k, size in held.items() if k not in page.whole and not (size >= PAGE_SHARE * total and all(k in soft for soft in page.marks))}
    return [b for b in page.blocks if left.isdisjoint(b.soft)]


def density(text: str) -> float:
    """The share of stop words among a block's words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: Block, inside: bool = False) -> int:
    """Label by link density, length and stop-word density."""
    size = len(block.text)
    if block.heading:
        return SHORT
    if block.links > MAX_LINKS * size or "©" in block.text and size < GOOD_LENGTH and not inside:
        return BAD
    if size < MIN_LENGTH:
        return BAD if block.links and not inside else SHORT
    share = density(block.text)
    if share >= HIGH_STOP:
        return GOOD if inside or size >= GOOD_LENGTH else NEAR
    return NEAR if share >= LOW_STOP or inside else BAD


def second_pass(blocks: list[Block], labels: list[int], edge: int) -> list[bool]:
    """Ambiguous blocks inherit from the nearest decided neighbours, those of middling density first, then short ones and
    headings; ``edge`` is what lies beyond both ends."""
    if GOOD not in labels and edge == BAD:  # nothing is decided in favour: middling blocks are the best there is
        labels = [GOOD if x == NEAR else x for x in labels]
    for kind in (NEAR, SHORT):
        before, after = _neighbours(labels, edge), _neighbours(labels[::-1], edge)[::-1]
        labels = [_inherited(b, own, x, y, i + 1 == len(labels)) if own == kind else own for i, (b, own, x, y) in enumerate(zip(blocks, labels, before, after, strict=True))]
    return [x == GOOD for x in labels]


def _inherited(block: Block, own: int, before: tuple[int, int], after: tuple[int, int], last: bool) -> int:
    """The label of an ambiguous block by its decided neighbours and how far away they are."""
    (left, far_left), (right, far_right) = before, after
    if block.heading:
        return left if last else right
    if left == right:
        return left
    if far_left != far_right:
        return left if far_left < far_right else right
    told = density(block.text) >= HIGH_STOP or own == SHORT and block.text[-1] in ".!?…" and not block.links
    return GOOD if told else BAD


def _neighbours(labels: list[int], edge: int) -> list[tuple[int, int]]:
    """The nearest decided label before each block and how many blocks away it is."""
    out, last, far = [], edge, 1
    for x in labels:
        out.append((last, far))
        last, far = (x, 1) if x in (GOOD, BAD) else (last, far + 1)
    return out


def article_of(blocks: list[Block]) -> int:
    """2 or 1 if an article or main element holds the page's text, else 0."""
    weight = [0, 0, 0]
    for b in blocks:
        if b.inside and b.links <= MAX_LINKS * len(b.text) or not b.inside and first_pass(b) in (GOOD, NEAR):
            weight[b.inside] += len(b.text)
    total = sum(weight)
    if total and weight[2] >= ARTICLE_SHARE * total:
        return 2
    return 1 if total and weight[1] + weight[2] >= ARTICLE_SHARE * total else 0


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    blocks = blocks_of(html)
    level = article_of(blocks)
    blocks = [b for b in blocks if b.inside >= level]
    labels = [first_pass(b, level > 0) for b in blocks]
    keep = second_pass(blocks, labels, GOOD if level else BAD)
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


SCHEMA = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``; other columns are left out."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = [extract(h) for h in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    own = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return map_arrow(own, run, SCHEMA)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
