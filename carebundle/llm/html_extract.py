"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level elements.  The first pass classifies a block by its link density, stop-word
density and length, and by the elements around it: those that never hold main text (menus, forms, scripts, ...) decide
against it and are no neighbours of others.  The second pass gives the undecided blocks, which are short or poor in stop
words, the label of the nearest decided neighbours.  A page with an article (``article``, ``main``, a class such as ``content``) is judged within it: blocks outside are out,
and undecided blocks look for neighbours inside.  An article or page without any good block consists of short or unusual
text: there all blocks but links belong to the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from carebundle.llm.common import quoted, slices, text_buffers

# Elements by their role in HTML.
SKIPPED = "script style noscript template iframe object embed svg math canvas audio video select option textarea head title"
BOILERPLATE = "nav footer aside form button menu dialog fieldset label input"
BLOCKS = (
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th"
    " thead tr ul caption"
)
HEADINGS = "h1 h2 h3 h4 h5 h6"
VOID = "area base br col embed hr img input link meta param source track wbr"
# Words in class, id and role that name what is not main text, and words that name what is.
NEGATIVE = (
    "ad ads adsense advert advertisement advertising banner promo promotion sponsor sponsored nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar widget footer header masthead cookie cookies consent gdpr notice alert popup modal overlay"
    " newsletter subscribe subscription signup login social share sharing related recommended recommendations comment"
    " comments disqus reply replies respond pagination pager toolbar search contentinfo complementary teaser outbrain taboola"
    " skip toc copyright legal"
)
POSITIVE = "article content main post entry story body text page"
PLACES = "article content main post entry story"
# Words beside a negative one that tell how a page is laid out, and words that make an article no main text.
LAYOUT = "no has with without"
NO_ARTICLE = "comment comments reply replies respond teaser promo promotion sponsored advert advertisement advertising related"
# Frequent function words of some languages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i if in is it its more not of on one or our she so"
    " that the their them there they this to was we were what when which who will with would you your",
    "fr": "à au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui ma mais me même mes ne nous on ou"
    " par pas pour qu que qui sa se ses son sur ta te un une vous y",
    "de": "als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer es für hat ich im in ist"
    " mit nach nicht noch nur oder sich sie sind so über um und von vor war wie wir zu zum zur",
    "es": "a al como con de del el ella en era es esta este fue ha hay la las le lo los más me mi muy no o para pero por que"
    " se si sin sobre su sus también un una y ya",
    "it": "al anche che chi ci come con da dei del della di e è gli ha i il in io la le lo ma mi nel non o per più se si sono"
    " su un una",
    "pt": "a ao as com como da das de do dos e é ela ele em era essa este eu foi mais mas na não no o os ou para pela pelo por"
    " que se sem seu sua um uma",
    "nl": "aan al als bij dat de den der die dit een en er haar had heb het hij hoe ik in is je maar met naar niet nog of om"
    " ook op te tot uit van voor was wat we wel wij ze zijn zo",
}

_set = lambda words: frozenset(words.split())
_SKIPPED, _BOILER, _BLOCKS, _HEADINGS, _VOID = map(_set, (SKIPPED, BOILERPLATE, BLOCKS, HEADINGS, VOID))
_NEGATIVE, _POSITIVE, _PLACES, _LAYOUT, _NO_ARTICLE = map(_set, (NEGATIVE, POSITIVE, PLACES, LAYOUT, NO_ARTICLE))
_STOP = frozenset(word for words in STOP_WORDS.values() for word in words.split())
# Elements whose content is not markup.
RAW = "script style noscript template textarea title iframe svg math"
_ENDS = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in RAW.split()}
_TAG = re.compile(r"</?+([a-zA-Z][^\s/>]*+)")
_QUOTE_OR_END = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])(?:([a-zA-Z-]++)\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]++)|hidden\b)""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"\w+")
GOOD, BAD, OPEN, POOR, LINKS = "good", "bad", "open", "poor", "links"


@dataclass(frozen=True)
class Rules:
    """Thresholds of the first pass."""

    link_density: float = 0.5
    few_stop_words: float = 0.1
    many_stop_words: float = 0.25
    short_chars: int = 70
    long_chars: int = 100
    list_of_links: int = 3


@dataclass
class Block:
    text: str
    link_chars: int
    boilerplate: bool
    article: int
    heading: bool
    label: str = OPEN


def _negative(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is named or marked as something that is not main text.  A negative word counts whatever stands
    beside it, unless the name tells of a layout with or without such a part; an article is out only as a comment or
    teaser of another."""
    if not attributes or tag in ("html", "body", "main") or "=" not in attributes and "hidden" not in attributes:
        return False
    negative = _NO_ARTICLE if tag == "article" else _NEGATIVE
    for match in _ATTRIBUTE.finditer(attributes):
        if not match[1]:
            return True
        name, value = match[1].lower(), match[2].strip("\"'")
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id", "role"):
            for item in value.split():
                parts = {part.lower() for part in _NAME_PARTS.findall(item)}
                own_header = in_article and "header" in parts and parts <= _POSITIVE | {"header"}
                if parts & negative and not parts & _LAYOUT and not own_header:
                    return True
    return False


def _positive(tag: str, attributes: str) -> bool:
    """Whether an element is named as the place of the main text."""
    if tag in ("article", "main"):
        return True
    if tag not in ("div", "section", "td") or "=" not in attributes:
        return False
    return any(
        match[1] and match[1].lower() in ("class", "id", "role") and
        any(_names_a_place({part.lower() for part in _NAME_PARTS.findall(item)}) for item in match[2].strip("\"'").split())
        for match in _ATTRIBUTE.finditer(attributes)
    )


def _names_a_place(parts: set[str]) -> bool:
    return bool(parts & _PLACES) and not (parts & _NEGATIVE and not parts & _LAYOUT)


def _markup(html: str) -> Iterator[tuple[int, int, bool, str, str, bool]]:
    """Tags, comments and declarations in order: where each begins and ends, whether it closes an element, name, attributes, and
    whether it is a whole element without markup inside.  Comments and declarations have no name.  One pass: what is
    known to follow no more is not looked for again."""
    at, last = 0, html.rfind(">")
    gone = {"-->": False, '"': False, "'": False}

    def after(mark: str, start: int) -> int:
        found = -1 if gone[mark] else html.find(mark, start)
        gone[mark] |= found < 0
        return found

    while (start := html.find("<", at)) >= 0:
        if html.startswith("<!--", start):
            end = after("-->", start + 4)
            at = len(html) if end < 0 else end + 3
            yield start, at, False, "", "", False
            continue
        if start > last:  # nothing more can end
            return
        if html.startswith(("<!", "<?"), start):
            at = html.index(">", start) + 1
            yield start, at, False, "", "", False
            continue
        tag = _TAG.match(html, start)
        if not tag:
            at = start + 1
            continue
        end, place = -1, tag.end()
        while end < 0 and (mark := _QUOTE_OR_END.search(html, place)):
            if mark[0] == ">":
                end = mark.start()
            elif (place := after(mark[0], mark.end()) + 1) == 0:
                break
        if end < 0:  # a quotation mark without its other half
            end = html.index(">", tag.end())
        name, closing = tag[1].lower(), html[start + 1] == "/"
        attributes, at = html[tag.end() : end], end + 1
        whole = name in _ENDS and not closing and html[end - 1] != "/"
        if whole:
            close = _ENDS[name].search(html, at)
            at = close.end() if close else len(html)
        yield start, at, closing, name, attributes, whole


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    found: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    open_elements: list[tuple[str, bool, int]] = []  # name, boilerplate within, number of the article within or 0
    boilerplate, article, articles, links, heading = False, 0, 0, 0, False

    def close() -> None:
        nonlocal pieces, linked, heading
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            chars = len(" ".join(unescape("".join(linked)).split())) if linked else 0
            found.append(Block(text, chars, boilerplate, article, heading))
        pieces, linked, heading = [], [], False

    def take(text: str) -> None:
        if text:
            pieces.append(text)
            if links:
                linked.append(text)

    def leave(tag: str) -> None:
        """Close the innermost open element of a name and all within it."""
        nonlocal boilerplate, article
        while open_elements:
            name, boilerplate, article = open_elements.pop()
            opened[name] -= 1
            if name == tag:
                break

    def enter(tag: str) -> None:
        open_elements.append((tag, boilerplate, article))
        opened[tag] += 1

    at = 0
    opened: Counter[str] = Counter()
    for start, end, closing, tag, attributes, whole in _markup(html):
        take(html[at:start])
        at = end
        if not tag or whole:
            if tag in ("textarea", "iframe"):
                close()
            continue
        if tag == "br":
            take(" ")
        if tag == "a":
            links = 0 if closing else 1
        if tag not in _BLOCKS and tag not in _BOILER and tag not in _SKIPPED:
            if not closing and tag not in _VOID and _negative(tag, attributes, article > 0):
                close()
                enter(tag)
                boilerplate = True
            elif closing and opened[tag]:
                close()
                leave(tag)
            continue
        close()
        heading = tag in _HEADINGS and not closing
        if tag in ("p", "hr", "input", "embed"):
            if not closing and tag == "p" and not boilerplate and _negative(tag, attributes, article > 0):
                enter(tag)
                boilerplate = True
            elif tag == "p" and open_elements and open_elements[-1][0] == "p":
                leave(tag)
            continue
        if closing:
            if opened[tag]:
                leave(tag)
            links = 0
        elif tag not in ("html", "body"):
            enter(tag)
            if not boilerplate and not article and _positive(tag, attributes):
                articles += 1
                article = articles
            out = tag in _BOILER or tag in _SKIPPED or tag == "header" and not article
            boilerplate = boilerplate or out or _negative(tag, attributes, article > 0)
    take(html[at:].split("<", 1)[0] if html[at:].startswith("<") else html[at:])
    close()
    return found


def _first_pass(block: Block, rules: Rules, common: frozenset[str] = frozenset()) -> str:
    """The label of a block by itself; POOR is long without stop words, LINKS is mostly links.  ``common`` are the short words
    that are frequent on the page: where they are dense, or the script is none that the lists know, a block without
    known stop words is in another language and undecided."""
    length = len(block.text)
    if block.link_chars > rules.link_density * length and not block.heading:
        return LINKS
    words = _WORD.findall(block.text.lower())
    density = sum(word in _STOP for word in words) / len(words) if words else 0.0
    if block.article:
        return GOOD if length >= rules.short_chars and density >= rules.few_stop_words else OPEN
    if length < rules.short_chars or block.heading:
        return OPEN
    if density >= rules.many_stop_words:
        return GOOD if length >= rules.long_chars else OPEN
    if density >= rules.few_stop_words:
        return OPEN
    foreign = sum(word[0] > "\u024f" for word in words) * 2 > len(words)
    return OPEN if foreign or sum(word in common for word in words) >= rules.many_stop_words * len(words) > 0 else POOR


def _common_words(blocks: list[Block], rules: Rules) -> frozenset[str]:
    """Short words that stand in many of the long blocks: function words, whatever the language."""
    long_blocks = [block for block in blocks if len(block.text) >= rules.short_chars and block.link_chars * 2 <= len(block.text)]
    counts = Counter(word for block in long_blocks for word in {w for w in _WORD.findall(block.text.lower()) if len(w) <= 4 and w.isalpha()})
    return frozenset(word for word, n in counts.items() if n >= max(2, 0.3 * len(long_blocks)))


def _lone_links(blocks: list[Block], rules: Rules) -> None:
    """Inside an article one or two blocks of links in a row may be text; more are a list of links."""
    first = 0
    while first < len(blocks):
        last = first
        while last < len(blocks) and blocks[last].label == LINKS:
            last += 1
        if last - first < rules.list_of_links:
            for block in blocks[first:last]:
                block.label = OPEN
        first = max(last, first + 1)


def _second_pass(blocks: list[Block]) -> None:
    """Undecided blocks of one article or page take the label of the nearest decided block.  Between two that disagree at
    equal distance a heading follows the block behind it, and any other block belongs to an article and not to a page."""
    decided = [block.label for block in blocks]
    if GOOD not in decided:
        for block in blocks:
            block.label = BAD if block.label == LINKS else GOOD
        return
    count = len(blocks)
    previous: list[int | None] = [None] * count
    following: list[int | None] = [None] * count
    for order, nearest in ((range(count), previous), (range(count - 1, -1, -1), following)):
        last = None
        for i in order:
            nearest[i] = last
            if decided[i] != OPEN:
                last = i
    for i, block in enumerate(blocks):
        if decided[i] != OPEN:
            continue
        sides = [(abs(i - j), decided[j]) for j in (previous[i], following[i]) if j is not None]
        least = min(distance for distance, _ in sides)
        near = {label == GOOD for distance, label in sides if distance == least}
        if len(near) == 1:
            good = near.pop()
        else:
            good = decided[following[i]] == GOOD if block.heading else block.article > 0
        block.label = GOOD if good else BAD


def main_text(html: str, rules: Rules = Rules()) -> str:  # noqa: B008
    """The text of the good blocks in page order, joined by one space."""
    blocks = blocks_of(html)
    candidates = [block for block in blocks if not block.boilerplate]
    if any(block.article for block in candidates):
        candidates = [block for block in candidates if block.article]
    places: dict[int, list[Block]] = {}
    common = _common_words(candidates, rules)
    for block in candidates:
        block.label = _first_pass(block, rules, common)
        places.setdefault(block.article, []).append(block)
    for article, place in places.items():
        if article:
            _lone_links(place, rules)
        _second_pass(place)
    return " ".join(block.text for block in candidates if block.label == GOOD)


def extract(
    pages: DataFrame,
    rules: Rules = Rules(),  # noqa: B008
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    Null, empty and text-free pages have an empty text.  Long pages are read whole.  Repeated rows give repeated rows, an
    empty table an empty one; other columns are not looked at.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            _, offsets = text_buffers(column)
            for low, high in slices(offsets, 8 << 20):
                texts = [main_text(html or "", rules) for html in column.slice(low, high - low).to_pylist()]
                ids, urls = (batch.column(k).slice(low, high - low) for k in (0, 1))
                counts = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, urls, pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"]
                )

    rows = pages.select(
        quoted(id_column).alias("page_id"), quoted(url_column).alias("url"), quoted(html_column).alias("html")
    )
    kinds = [pages.schema[name].dataType.simpleString() for name in (id_column, url_column)]
    return rows.mapInArrow(extracted, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
