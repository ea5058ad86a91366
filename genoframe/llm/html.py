"""Main text of HTML pages by two passes of block rules.

Tags cut a page into blocks. Structure decides about some: what stands in menus,
footers, forms and the like is left out. In the first pass length, link density
and stop-word density call the other blocks good or bad, or leave them undecided;
in the second, undecided blocks take the label of the nearest decided neighbours.
A place in an article is evidence: such blocks are left undecided where others are
bad, and win a tie.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.batches import small_batches
from genoframe.plans.shared import remove, shared_path

# Element names of HTML by their role.
SKIPPED = frozenset(
    "script style noscript template svg iframe object embed canvas audio video map "
    "select textarea button title head datalist annotation annotation-xml".split()
)
RAW_TEXT = frozenset("script style textarea title noscript iframe xmp".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset("article main".split())
# Start tags that end an open element of the same kind.
CLOSES = {
    **dict.fromkeys(BLOCKS, frozenset({"p"})),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "option": frozenset({"option"}),
}
# Words in class, id and role that mark a container as no part of the article, unless
# the page's good text refutes it.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adverts?|advert[ei]s\w*|banner\w*|sponsor\w*|promo\w*|nav|navbar|"
    r"navigation|menu\w*|breadcrumb\w*|sidebar\w*|widget\w*|footer|cookie\w*|consent|notices?|"
    r"gdpr|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|disclaimer|"
    r"copyright|related|recommend\w*|toolbar|pagination|pager|skip\w*|search\w*|complementary|"
    r"contentinfo|alert)(?:$|[\s_-])",
    re.IGNORECASE,
)
# The same for what readers wrote; these are articles of their own on some pages.
READER_MARKS = re.compile(
    r"(?:^|[\s_-])(?:comment\w*|disqus\w*|discussion|respond|responses|repl(?:y|ies))(?:$|[\s_-])",
    re.IGNORECASE,
)
# The part of a class that says whether a page has such a part, not that it is one.
LAYOUT = re.compile(
    r"^.*[_-](?:open|opened|closed|enabled|disabled)$|"
    r"(?:^|[_-])(?:has|have|no|not|with|without|hide|show)[_-].*$",
    re.IGNORECASE,
)
NUMBERS = re.compile(r"\d+")
# Marks that wrappers of whole pages carry as well, and those of parts that can
# have more text than the article.
WRAPPER_MARKS = re.compile(
    r"(?:^|[_-])(?:nav|navbar|navigation|menu\w*|sidebar\w*|widget\w*|header|masthead|footer|modal|"
    r"overlay|toolbar|search\w*|banner\w*|notices?|social|skip\w*|popup|alert|pager|pagination|login)"
    r"(?:$|[_-])",
    re.IGNORECASE,
)
# Ids that can be the title of an article's section.
SECTION_IDS = re.compile(
    r"discussion|responses|related[_-](?:work|works|research|literature)|search\w*[_-]\w+|search|"
    r"navigation|notices?|copyright|disclaimer|consent|menus?|social|sharing|alert|overlay|"
    r"modal|widgets?|cookies?|banners?|recommendations?|sponsors?|header|footer|login|adverts?|"
    r"advert[ei]sing|pagination",
    re.IGNORECASE,
)
# The same for places outside an article; inside it they hold its headings.
HEADER_MARKS = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.IGNORECASE)
# Frequent short words of some languages; those of others are learnt from the pages.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he i this are or his from at "
    "which but have an had they you were their one all we can her has there been if more when "
    "le la les de des du et en un une est que qui dans par pour sur au aux avec ce il elle ne pas "
    "plus se son sa ses ou mais nous vous leur cette sont "
    "der die das den dem und ist im von zu mit sich auf für nicht ein eine einer als auch es an "
    "werden aus er hat dass sie nach wird bei noch wie über so zum "
    "el los las del y una por con para se su al lo como más pero sus este ya o fue ha sí porque "
    "esta son entre cuando muy sin sobre también me hasta hay".split()
)

QUOTED = "\"[^\"]*\"|'[^']*'"
TOKEN = re.compile(
    # Quoted values may hold brackets; a tag has a hundred of them at most.
    rf"<!--(?:.*?-->|(?P<endless>))|<(?P<name>/?[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*+(?:(?:{QUOTED})[^>\"']*+){{0,100}}+)>"
    # Quotes that do not pair up: to the next bracket.
    r"|<(?P<odd>/?[a-zA-Z][^\s/>]*)[^>]*>|<[!?][^>]*>",
    re.DOTALL,
)
# Names with their values in order: what stands in a value is no name.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
# Most tags have none of the attributes that count.
TELLING = re.compile("class|id|role|style|lang", re.IGNORECASE)
LAST_PIECE = re.compile(r"<[a-zA-Z/!][^>]*\Z")

# First pass.
MAX_LINK_DENSITY = 0.33
SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP_WORDS = 0.05
HIGH_STOP_WORDS = 0.15

# Stop words of a language: short words that make up so much of its text and of some
# words more that have none of them, so a rare language needs clearer evidence. Entries
# that a task holds before it hands them on.
STOP_LETTERS = 5
STOP_SHARE = 0.004
PRIOR_WORDS = 2000
COUNTER_ENTRIES = 100_000

LANGUAGE = re.compile(r"[a-zA-Z]{2,3}\b")
NO_LETTERS = bytes(b for b in range(256) if not chr(b).isascii() or not chr(b).isalpha())
BEYOND_ASCII = re.compile(r"[^\x00-\x7f]+")
# Characters as wide as two others; they stand for more than one letter.
WIDE = re.compile("[\u1100-\u11ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\uff00-\uff60]")
SENTENCE = re.compile(r"[.!?…。！？｡।؟۔։።။][\"'»”’)\]]*$")
NOTICE = re.compile(r"(?:©|copyright\s+(?:©|\(c\)|[12]\d{3}\b|by\b))", re.IGNORECASE)

GOOD, BAD, OPEN = "good", "bad", "open"


@dataclass(frozen=True, eq=False)
class Mark:
    """A container that calls itself no part of the article: the word by which it
    does. ``title``: an id inside an article that can be a section's title."""

    word: str
    reader: bool
    title: bool


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    main: bool
    outside: bool
    marks: tuple[Mark, ...] = ()
    label: str = OPEN
    # Of long blocks.
    words: int = 0
    stops: int = 0


@dataclass
class _Element:
    name: str
    skipped: bool
    outside: bool
    main: bool
    link: bool
    heading: bool
    marks: tuple[Mark, ...] = ()


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=list)
    # Depths of the open elements by name, of open blocks, and of those but headings.
    depths: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    block_depths: list[int] = field(default_factory=list)
    container_depths: list[int] = field(default_factory=list)
    language: str | None = None

    def push(self, element: _Element) -> None:
        depth = len(self.stack)
        self.stack.append(element)
        self.depths[element.name].append(depth)
        if element.name in BLOCKS:
            self.block_depths.append(depth)
            if element.name not in HEADINGS:
                self.container_depths.append(depth)

    def cut(self, depth: int) -> None:
        """Ends the elements from this depth on."""
        for element in self.stack[depth:]:
            self.depths[element.name].pop()
        del self.stack[depth:]
        for depths in (self.block_depths, self.container_depths):
            while depths and depths[-1] >= depth:
                depths.pop()


def _last(depths: list[int] | None) -> int:
    return depths[-1] if depths else -1


def _top(page: _Page) -> _Element:
    return page.stack[-1] if page.stack else _Element("", False, False, False, False, False)


def _flush(page: _Page) -> None:
    """End the open block: decode references, fold white space."""
    if page.pieces:
        text = " ".join(unescape("".join([piece for piece, _ in page.pieces])).split())
        if text:
            top = _top(page)
            links = sum(len(piece.strip()) for piece, link in page.pieces if link)
            page.blocks.append(Block(text, links, top.heading, top.main, top.outside, top.marks))
        page.pieces.clear()


def _attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _hidden(name: str, attributes: Mapping[str, str]) -> bool:
    """Whether readers do not see an element. A part of a sentence that only screen
    readers skip is an icon or a second form of what stands beside it."""
    if "hidden" in attributes or NO_DISPLAY.search(attributes.get("style", "")):
        return True
    return name not in BLOCKS and attributes.get("aria-hidden", "").lower() == "true"


def _mark(name: str, attributes: Mapping[str, str], main: bool) -> Mark | None:
    """The mark of a container, by the first word of its class, id or role that is one;
    of several, one of what readers wrote, then one that is no section's title."""
    marks = []
    for attribute, value in attributes.items():
        if attribute not in ("class", "id", "role"):
            continue
        for word in value.split():
            word = LAYOUT.sub("", word)
            reader = bool(READER_MARKS.search(word))
            # An article's own classes say how the page is laid out around it.
            other = name not in MAIN and (
                MARKS.search(word) or (not main and HEADER_MARKS.search(word))
            )
            if reader or other:
                title = main and attribute == "id" and bool(SECTION_IDS.fullmatch(word))
                marks.append(Mark(NUMBERS.sub("", word.lower()), reader, title))
    return min(marks, key=lambda mark: (mark.title, not mark.reader), default=None)


def _open(page: _Page, name: str, rest: str) -> None:
    closes = CLOSES.get(name)
    if closes:
        # Only as far as the nearest container: a list in a list item stays inside.
        depth = max(_last(page.depths.get(inner)) for inner in closes)
        if depth >= 0 and depth >= _last(page.container_depths):
            page.cut(depth)
    attributes = _attributes(rest) if rest and TELLING.search(rest) else {}
    if name == "html" and page.language is None and "lang" in attributes:
        said = LANGUAGE.match(attributes["lang"].strip())
        page.language = said[0].lower() if said else None
    if name in VOID or rest.endswith("/"):
        return
    above = _top(page)
    # A page header goes; the header of an article holds its headings.
    outside = above.outside or name in BOILERPLATE or (name == "header" and not above.main)
    marks = above.marks
    hidden = False
    if not outside and attributes and name not in ("html", "body"):
        outside = hidden = _hidden(name, attributes)
        # A heading is named by its subject.
        mark = None if outside or name in HEADINGS else _mark(name, attributes, above.main)
        # Words count, not how often they stand around a block; titles count each.
        if mark and (mark.title or all(m.word != mark.word or m.title for m in marks)):
            marks = (*marks, mark)
    page.push(
        _Element(
            name,
            # A hidden part of a sentence is no block that could be left out.
            above.skipped or name in SKIPPED or (hidden and name not in BLOCKS),
            outside,
            above.main or name in MAIN,
            above.link or name == "a",
            above.heading or name in HEADINGS,
            marks,
        )
    )


def _close(page: _Page, name: str) -> None:
    depth = _last(page.depths.get(name))
    # An inline end tag does not reach out of its block.
    if depth >= 0 and (name in BLOCKS or depth > _last(page.block_depths)):
        page.cut(depth)


def blocks_of(html: str) -> list[Block]:
    """The text blocks of a page in order, with what their place says about them."""
    return _parsed(html).blocks


def _parsed(html: str) -> _Page:
    """A page's blocks and its declared language, in time that grows with its length."""
    page, at = _Page(), 0
    # A tag that the end of the page cuts off is markup, not text.
    cut = LAST_PIECE.search(html, max(html.rfind("<"), 0)) if "<" in html else None
    end = cut.start() if cut else len(html)
    # Behind the last bracket no tag ends.
    last = html.rfind(">", 0, end) + 1
    while at < end:
        found = TOKEN.search(html, at, max(last, at))
        if not found or found["endless"] is not None:
            # A comment without an end goes to the end of the page.
            comment = html.find("<!--", at, end) if not found else found.start()
            end, found = comment if comment >= 0 else end, None
        text = html[at : found.start() if found else end]
        top = _top(page)
        if text and not top.skipped:
            page.pieces.append((text, top.link))
        if not found:
            break
        at = found.end()
        tag, rest = found["name"] or found["odd"], (found["rest"] or "").strip()
        if not tag:
            continue
        closing, name = tag[0] == "/", tag.lstrip("/").lower()
        if name in BLOCKS:
            _flush(page)
        elif name in ("br", "img", "input"):
            page.pieces.append((" ", top.link))
        if closing:
            _close(page, name)
        else:
            _open(page, name, rest)
            if name in RAW_TEXT and not rest.endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\s*/?>", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
                _close(page, name)
    _flush(page)
    return page


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


def _words(text: str) -> list[str]:
    return [word.strip(".,;:!?\"'()[]%#*$&") for word in text.lower().split()]


@lru_cache(1 << 16)
def _script(letter: str) -> str:
    return unicodedata.name(letter, "?").split()[0]


def _plain(blocks: list[Block]) -> list[Block]:
    """Long blocks without links."""
    return [b for b in blocks if not (b.outside or b.link_chars) and _length(b.text) >= SHORT_CHARS]


def _language(page: _Page, plain: list[Block]) -> str:
    """What a page says about its language, and the script of its long blocks."""
    scripts: Counter[str] = Counter()
    for block in plain:
        scripts["LATIN"] += len(block.text.encode("ascii", "ignore").translate(None, NO_LETTERS))
        if not block.text.isascii():
            for letter, n in Counter("".join(BEYOND_ASCII.findall(block.text))).items():
                if letter.isalpha():
                    scripts[_script(letter)] += n
    scripts = +scripts
    script = max(sorted(scripts), key=scripts.__getitem__, default="")
    return f"{page.language or ''} {script}"


def _count_stops(blocks: list[Block], stop_words: frozenset[str]) -> bool:
    """Counts words and stop words of long blocks. Whether the list fits the page."""
    for block in blocks:
        if not block.outside and _length(block.text) >= SHORT_CHARS:
            words = _words(block.text)
            block.words, block.stops = len(words), sum(map(stop_words.__contains__, words))
    plain = _plain(blocks)
    return sum(b.stops for b in plain) >= LOW_STOP_WORDS * sum(b.words for b in plain)


def _first_pass(block: Block, fits: bool) -> str:
    length = _length(block.text)
    if block.outside or block.link_chars > MAX_LINK_DENSITY * len(block.text):
        return BAD
    if block.heading:
        return OPEN
    if length < SHORT_CHARS:
        return BAD if block.link_chars and not block.main else OPEN
    if block.stops >= HIGH_STOP_WORDS * block.words:
        return GOOD
    if block.stops >= LOW_STOP_WORDS * block.words:
        return GOOD if length > LONG_CHARS else OPEN
    if not fits and not block.link_chars:
        # Of another language: sentences are text, also where no spaces part words.
        written = SENTENCE.search(block.text) or len(block.text) > 20 * block.words
        return GOOD if written else OPEN
    # Text without stop words: inside an article its neighbours decide.
    return OPEN if block.main else BAD


def _drop_notices(blocks: list[Block]) -> None:
    """Short copyright lines behind the last good block are bad."""
    for block in reversed(blocks):
        length = _length(block.text)
        short = length < SHORT_CHARS and block.text.startswith(("©", "Copyright "))
        if short or (length < LONG_CHARS and NOTICE.match(block.text)):
            block.label = BAD
        elif block.label == GOOD:
            break


def _second_pass(blocks: list[Block]) -> None:
    """Undecided blocks: the label of the neighbours if they agree, or of the only
    one. If they do not agree, a heading goes with what follows, others with the
    nearer neighbour. Where nothing is decided, an article's blocks are good."""
    first = [block.label for block in blocks]
    before: list[tuple[str, int]] = []
    label, place = "", -1
    for i, found in enumerate(first):
        if found != OPEN:
            label, place = found, i
        before.append((label, place))
    label, place = "", len(blocks)
    for i in range(len(blocks) - 1, -1, -1):
        block = blocks[i]
        if first[i] != OPEN:
            label, place = first[i], i
            continue
        left, left_at = before[i]
        if left == label:
            alone = block.main or block.heading or len(block.text) >= SHORT_CHARS
            block.label = label or (GOOD if alone else BAD)
        elif block.heading:
            block.label = label or (left if block.main else BAD)
        elif not left or not label:
            block.label = left or label
        elif i - left_at == place - i:
            block.label = GOOD if block.main else left
        else:
            block.label = left if i - left_at < place - i else label


def _standing(blocks: list[Block]) -> None:
    """Puts outside what stands under marks that the page's good text does not refute.

    A section of an article with a title's id is refuted by good text of its own. The
    word of wrappers is, if all its containers together hold most of the good text, or
    the page's only article with any; any other word, if no text is left without it.
    """
    refuted = {
        mark for block in blocks if block.label == GOOD for mark in block.marks if mark.title
    }
    for block in blocks:
        block.marks = tuple(mark for mark in block.marks if mark not in refuted)
    inside = [block for block in blocks if not block.outside]
    while any(block.marks for block in inside):
        alone = all(block.marks or block.heading for block in inside)
        # Readers' text does not speak for a wrapper; open text of an article speaks against.
        own = [b for b in inside if b.label == GOOD and not any(m.reader for m in b.marks)]
        free = [b for b in inside if b.main and b.label != BAD and not b.marks]
        total = sum(len(b.text) for b in {id(b): b for b in own + free}.values())
        words: dict[str, int] = {}
        articles: set[str] = set()
        for block in own:
            here = {mark.word for mark in block.marks}
            articles |= here if block.main and not free else set()
            for word in here:
                words[word] = words.get(word, 0) + len(block.text)
        gone = None
        for word in sorted(words, key=lambda word: (-words[word], word)):
            most = word in articles or 2 * words[word] > total
            if alone or (most and WRAPPER_MARKS.search(word)):
                gone = word
                break
        if gone is None and alone:
            gone = next((m.word for b in inside if b.label == GOOD for m in b.marks), None)
        if gone is None:
            break
        for block in blocks:
            block.marks = tuple(mark for mark in block.marks if mark.word != gone)
    for block in blocks:
        if block.marks:
            block.outside, block.label = True, BAD


def _article(blocks: list[Block]) -> bool:
    """Whether the page's article elements hold its article: at least half of the
    good text, or all there is if none is good."""
    inner = [block for block in blocks if block.main and not block.outside]
    good = sum(len(block.text) for block in blocks if block.label == GOOD)
    return bool(inner) and 2 * sum(len(b.text) for b in inner if b.label == GOOD) >= good


def main_text(html: str | None, learnt: Mapping[str, frozenset[str]] = {}) -> str:
    """The article of a page, its blocks joined by newlines; empty if there is none.

    ``learnt``: stop words by language, beside the fixed ones.
    """
    page = _parsed(html or "")
    blocks = page.blocks
    more = learnt.get(_language(page, _plain(blocks))) if learnt else None
    fits = _count_stops(blocks, STOP_WORDS | more if more else STOP_WORDS)
    for block in blocks:
        block.label = _first_pass(block, fits)
    _standing(blocks)
    if _article(blocks):
        # The rest is not the article, and says nothing about its neighbours in it.
        blocks = [block for block in blocks if block.main and not block.outside]
    else:
        # Teasers or comments: article elements are no evidence.
        for block in blocks:
            if block.main:
                block.main = False
                block.label = _first_pass(block, fits)
    _drop_notices(blocks)
    _second_pass(blocks)
    return "\n".join(block.text for block in blocks if block.label == GOOD)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often short words stand in long blocks, by language; the empty word counts all."""
    counts: Counter[tuple[str, str]] = Counter()

    def rows() -> pa.RecordBatch:
        columns = {
            "language": pa.array([key[0] for key in counts], pa.string()),
            "word": pa.array([key[1] for key in counts], pa.string()),
            "n": pa.array(list(counts.values()), pa.int64()),
        }
        counts.clear()
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        for html in batch["html"].to_pylist():
            page = _parsed(html or "")
            plain = _plain(page.blocks)
            language = _language(page, plain)
            words = [word for block in plain for word in _words(block.text)]
            counts[language, ""] += len(words)
            for word, n in Counter(words).items():
                if 0 < len(word) <= STOP_LETTERS and word.isalpha():
                    counts[language, word] += n
            if len(counts) > COUNTER_ENTRIES:
                yield rows()
    if counts:
        yield rows()


def learn_stop_words(pages: DataFrame) -> dict[str, frozenset[str]]:
    """Frequent short words of languages to which the fixed list does not fit.

    All pages count. A list has 1 / ``STOP_SHARE`` words at most, and the driver gets
    the lists alone.
    """
    spark = pages.sparkSession
    folder = shared_path(spark, "words")
    parts = pages.select("html").mapInArrow(_count_words, "language string, word string, n bigint")
    parts.groupBy("language", "word").agg(F.sum("n").alias("n")).write.parquet(folder)
    counts = spark.read.schema("language string, word string, n bigint").parquet(folder)
    known = F.when(F.col("word").isin(*sorted(STOP_WORDS)), F.col("n")).otherwise(0)
    totals = counts.groupBy("language").agg(
        F.sum(F.when(F.col("word") == "", F.col("n"))).alias("total"), F.sum(known).alias("known")
    )
    strange = totals.where(F.col("known") < HIGH_STOP_WORDS * F.col("total"))
    frequent = counts.where("word <> ''").join(strange, "language").where(
        F.col("n") >= STOP_SHARE * (F.col("total") + PRIOR_WORDS)
    )
    found: dict[str, set[str]] = {}
    for row in frequent.select("language", "word").collect():
        found.setdefault(row["language"], set()).add(row["word"])
    remove(spark, folder)
    return {language: frozenset(words) for language, words in found.items()}


def _extract(learnt: Mapping[str, frozenset[str]]):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, learnt) for html in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(text) for text in texts], pa.int64()),
                }
            )

    return extract


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Two passes: the first counts words for the stop words of languages that are not
    known, only its counts are shuffled; in the second pages are independent, a batch
    of them in memory. A null or empty page and one without an article have an empty text. Equal pages
    get equal texts. No pages give no rows; other columns are not read.
    """
    small_batches(pages.sparkSession)
    kinds = {name: pages.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(_extract(learn_stop_words(pages)), schema)
