"""Main text of web pages by deducing the template of their host from equivalence classes of tokens.

A page is a row of tokens: tags with the path they stand on, and runs of text. Tokens that occur equally often on each
page of a host share an occurrence vector and are a class. Spark adds up, for each host and token, on how many pages it
is and a digest of its vector, so that a host with very many pages is reduced inside the tasks. Classes on enough pages
whose tokens come in the same order on a page, one class inside a gap of another, make the template; what a page has
between template tokens is in its slots. A slot is left out where the template's tokens around it are those of menus,
headers, footers, sidebars, notices, adverts, forms or comments, and text that is itself a template token is part of
the template. What remains, in page order, is the main text.

Hosts with few pages borrow the template that all pages together give.
"""

import re
import zlib
from collections import defaultdict
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.arrow import packed, row_type
from jobtide.llm.url_filter import host
from jobtide.sinks.scratch import stored

#: Pages that a host needs for a template of its own, and the share of them that must have a token of it.
MIN_PAGES, MIN_SHARE = 3, 0.5
#: Where less than this share of what the main element holds is the page's own, the page is one of copies.
COPY_SHARE = 0.1

#: Elements whose text is not shown, or not prose.
DROPPED = frozenset("script style noscript template iframe object svg math canvas audio video select option button textarea input label datalist head title".split())
#: Elements around the main text.
AROUND = frozenset("nav header footer aside form dialog menu".split())
#: Words in classes, ids and roles that say so of other elements.
AROUND_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe subscription share sharing social sidebar rail widget widgets related recommended recommendations menu "
    "nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer bottombar comment comments disqus reply replies respond discussion "
    "pagination pager login signup search toolbar skip complementary contentinfo navigation tags legal copyright disclaimer".split()
)
#: Of these, words of what stands apart and may hold articles of its own, such as comments.
APART_WORDS = frozenset("comment comments disqus reply replies respond discussion related recommended recommendations".split())
#: Words after which a class says what an element holds or is about, not what it is.
DESCRIBING = frozenset("has with without no category tag".split())
#: Words that make a header the headline of a text.
HEADLINE_OF = frozenset("article entry post story".split())
#: Elements, and words in classes, ids and roles, of the main text.
MAIN, MAIN_WORDS = frozenset(["article", "main"]), frozenset("article articlebody main post entry story".split())

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag of the same kind ends, up to the container that holds them.
SIBLINGS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",),
}
#: Elements that an end tag does not reach out of, and those that end each other like one of the same kind.
WALLS = frozenset(["article", "main", "td", "body"])
ALIKE = {"dt": ("dd",), "dd": ("dt",), "td": ("th",), "th": ("td",)}
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template")
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


@lru_cache(4096)
def _kind(tag: str, named: tuple[str, ...]) -> tuple[bool, bool, bool, bool]:
    """Whether an element is around by its names, so even inside the main text, apart whatever it holds, and main."""
    words = set()
    for value in (v for each in named for v in each.split()):
        for word in (w.lower() for w in _WORD.findall(value)):
            if word in DESCRIBING:
                break
            words.add(word)
    said = words & AROUND_WORDS if tag not in ("body", "html") else set()
    if said == {"header"} and words & HEADLINE_OF:
        said = set()
    # a header inside the article holds its headline
    inside = (tag in AROUND and tag != "header") or bool(said - {"header"})
    apart = (tag in AROUND and tag != "form") or bool(said & APART_WORDS)
    return tag in AROUND or bool(said), inside, apart, tag in MAIN or bool(words & MAIN_WORDS)


class _Element:
    __slots__ = ("apart", "around", "article", "dropped", "kind", "main", "parent", "path", "tag")

    def __init__(self, tag: str, attributes: str, parent: "_Element | None"):
        named = sorted("".join(m[1:]) for m in _ATTRIBUTE.findall(attributes)) if "=" in attributes else []
        self.tag, self.parent = tag, parent
        # a hash of the whole path, so that a deep page's keys are no longer than others
        path = f"{parent.path}/{tag}" if parent else tag
        self.path = xxhash.xxh64_hexdigest(path + "".join([f"[{n}]" for n in named]) if named else path)
        self.dropped = (parent is not None and parent.dropped) or tag in DROPPED
        self.kind = _kind(tag, tuple(named))
        self.apart = (parent is not None and parent.apart) or self.kind[2]
        # the article or main element it is in; an article inside an article is a comment on it
        self.article = parent.article if parent else None
        if tag in MAIN and (self.article is None or self.article.tag == "main"):
            self.article = self
        self.settle(())

    def settle(self, spared) -> None:
        """Set ``around`` and ``main`` from its names, which do not make an element of ``spared`` around."""
        parent = self.parent
        inside = parent is not None and parent.main
        self.around = (parent is not None and parent.around) or (self.kind[inside] and self not in spared)
        self.main = (inside or self.kind[3]) and not self.around

    def line(self) -> "list[_Element]":
        """The element and all that hold it, from the outermost on."""
        out, element = [], self
        while element is not None:
            out.append(element)
            element = element.parent
        return out[::-1]


class _Open(list):
    """The open elements, from the outermost on, with the places of each tag among them; place 0 is the root's.

    ``blocks`` has the places of blocks, ``walls`` those of elements that an end tag doesn't reach out of.
    """

    def __init__(self, root: _Element):
        super().__init__([root])
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.blocks, self.walls = [0], [0]

    def open(self, element: _Element, is_block: bool) -> None:
        place, tag = len(self), element.tag
        self.places[tag].append(place)
        if is_block:
            self.blocks.append(place)
            if tag in WALLS:
                self.walls.append(place)
        self.append(element)

    def cut(self, at: int) -> None:
        """Close the element at a place and all in it."""
        while len(self) > at:
            self.places[self.pop().tag].pop()
        while self.blocks[-1] >= at:
            self.blocks.pop()
        while self.walls[-1] >= at:
            self.walls.pop()

    def last(self, tag: str) -> int:
        """The place of the innermost element of a tag, 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0


def read(html: str) -> list[tuple[str, "_Element", str]]:
    """Tokens of a page: key, the element it is in, and the text of a block.

    Blocks are runs of shown text with white space as one space; those without text are none. A key is a hash of the
    path of a tag, or that of a block with its text's digest. Time and memory grow with the page, however deep it is.
    """
    root = _Element("html", "", None)
    tokens, open_ = [], _Open(root)
    parts: list[str] = []
    owner = root

    def flush():
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                tokens.append((f"{owner.path}#{zlib.crc32(text.encode('utf-8', 'replace')):08x}{len(text):x}", owner, text))

    def shown(text):
        nonlocal owner
        if text and not open_[-1].dropped:
            if not parts:
                owner = open_[open_.blocks[-1]]
            parts.append(text)

    place, end = 0, len(html)
    while place < end:
        found = _TOKEN.search(html, place)
        if not found:
            shown(html[place:])
            break
        shown(html[place : found.start()])
        place = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag == "br":
            shown(" ")
            continue
        is_block = tag in BLOCKS
        if is_block:
            flush()
        if found[1]:
            at = open_.last(tag)
            # an end tag does not reach out of the article or a table cell it is not in
            if at and (open_.walls[-1] <= at or tag in ("article", "main", "table", "body", "html")):
                tokens.append((f"{open_[at].path}/end", open_[at], ""))
                open_.cut(at)
            continue
        if is_block and tag not in ("body", "html"):
            # a paragraph ends where a block begins, and with it what it left open
            at = open_.last("p")
            if at and open_.blocks[-1] == at:
                open_.cut(at)
        if tag in SIBLINGS:
            at = max(map(open_.last, (tag, *ALIKE.get(tag, ()))))
            if at > max(map(open_.last, SIBLINGS[tag])):
                open_.cut(at)
        if tag == "html" or (tag == "body" and open_.last("body")):
            continue
        if tag == "body":
            open_.cut(1)
        element = _Element(tag, found[3], open_[-1])
        tokens.append((element.path, element, ""))
        if tag in VOID or found[3].endswith("/") and not is_block:
            continue
        open_.open(element, is_block)
        if tag in _RAW:
            close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(html, place)
            if not element.dropped:
                shown(html[place : close.start() if close else end])
            place = close.end() if close else end
            open_.cut(len(open_) - 1)
    flush()
    return tokens


class Template:
    """The template of a host, from its tokens: key, pages that have it, digest of its occurrence vector, mean place.

    ``root`` is the class with the most tokens on the most pages, in order; ``member`` names the class of each token.
    """

    def __init__(self, tokens: list[tuple[str, int, int, float]]):
        classes: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for key, pages, digest, place in tokens:
            classes.setdefault((pages, digest), []).append((place, key))
        self.member = {key: name for name, keys in classes.items() for _, key in keys}
        self.name = max(classes, key=lambda name: (name[0] * len(classes[name]), name), default=None)
        self.root = {key: i for i, (_, key) in enumerate(sorted(classes.get(self.name, [])))}

    def slots(self, keys: list[str]) -> list[int] | None:
        """The slot of each token, numbered by the root's token before it; None where the page does not follow.

        A page follows if it has half of the root's tokens at least, and those in the template's order.
        """
        found, out, slot = [], [], -1
        for key in keys:
            place = self.root.get(key)
            if place is not None and place > slot:
                slot = place
                found.append(place)
            elif place is not None and place not in found:
                return None
            out.append(slot)
        return out if 2 * len(found) >= len(self.root) > 0 else None

    def nested(self, keys: list[str], slots: list[int]) -> set[tuple[int, int]]:
        """Classes whose tokens lie in one slot of the root on this page: those that are valid inside it."""
        places: dict[tuple[int, int], set[int]] = {}
        for key, slot in zip(keys, slots, strict=True):
            name = self.member.get(key)
            if name is not None and name != self.name:
                places.setdefault(name, set()).add(slot)
        return {name for name, where in places.items() if len(where) == 1}


def _spared(tokens: list[tuple[str, _Element, str]], slots: list[int] | None, of_template: list[bool]) -> set[_Element]:
    """The elements that are or hold the main text, whatever their names say; none where names do not touch it.

    The main text is in the article or main element with the most text; those that stand apart come into question only
    if they hold more than all that is not around. Without such an element it is in the slot with the most text of the
    page's own, if that is more than what is not around; a page that follows no template is one slot, in question only
    where it has nothing else.
    """
    if not any(text and element.around for _, element, text in tokens):
        return set()
    articles: dict[_Element, int] = {}
    by_slot: dict[int, list[tuple[_Element, int]]] = {}
    clean = own = 0
    for i, (_, element, text) in enumerate(tokens):
        if not text:
            continue
        if element.article is not None:
            articles[element.article] = articles.get(element.article, 0) + len(text)
        if not element.around:
            clean += len(text)
            own += len(text) * (not of_template[i])
        if not element.apart and not of_template[i]:
            by_slot.setdefault(slots[i] if slots else 0, []).append((element, len(text)))
    found = {e: n for e, n in articles.items() if not e.apart} or {e: n for e, n in articles.items() if n > clean}
    if found:
        return set(max(found, key=found.__getitem__).line())
    if not by_slot:
        return set()
    blocks = max(by_slot.values(), key=lambda some: sum(n for _, n in some))
    if sum(n for _, n in blocks) <= own or (not slots and own):
        return set()
    return _common([e for e, _ in blocks])


def _common(elements: list[_Element]) -> set[_Element]:
    """The elements that are or hold all of some; each is passed once."""
    line = elements[0].line()
    known, least = {e: i for i, e in enumerate(line)}, len(line) - 1
    for element in elements[1:]:
        passed = []
        while element not in known:
            passed.append(element)
            element = element.parent
        least = min(least, known[element])
        known.update(dict.fromkeys(passed, known[element]))
    return set(line[: least + 1])


def extract(html: str | None, template: Template | None) -> str:
    """The main text of a page; empty for null, and where a page has none.

    Template tokens cut the page into slots. Blocks that are template tokens are left out wherever they are, also in a
    main element, and so are blocks of slots that names say are around the main text; names never take away what holds
    it (``_spared``). Of the rest, blocks in a main element count, or all if none is in one. A page that follows no
    template is one slot. Where hardly any of the text is the page's own, its host has copies of one page, and the
    template's text is the main text.
    """
    if not html:
        return ""
    tokens = read(html)
    keys = [key for key, _, _ in tokens]
    slots = template.slots(keys) if template else None
    valid = template.nested(keys, slots) | {template.name} if slots else set()
    of_template = [bool(slots) and template.member.get(key) in valid for key in keys]
    spared = _spared(tokens, slots, of_template)
    if spared:
        for _, element, _ in tokens:
            element.settle(spared)
    # what the slots hold, and the template's own text between them
    blocks = [(text, element.main, of_template[i]) for i, (_, element, text) in enumerate(tokens) if text and not element.around]
    in_main = [block for block in blocks if block[1]]
    own = _own(in_main) or _own(blocks)
    if in_main and sum(len(text) for text, _, _ in own) < COPY_SHARE * sum(len(text) for text, _, _ in in_main):
        own = in_main
    return "\n\n".join(text for text, _, _ in own or blocks)


def _own(blocks: list[tuple[str, bool, bool]]) -> list[tuple[str, bool, bool]]:
    return [block for block in blocks if not block[2]]


def _digest(page: int, count: int) -> int:
    """A number for a page and how often it has a token; sums of these tell occurrence vectors apart."""
    value = (page * 0x9E3779B97F4A7C15 + count * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) & ((1 << 64) - 1)
    value ^= value >> 31
    value = value * 0xBF58476D1CE4E5B9 & ((1 << 64) - 1)
    # small enough that sums of very many do not overflow
    return (value >> 32) & 0x7FFFFFFF


def _occurrences(batches):
    for batch in batches:
        counted: dict[tuple[str | None, str], list[float]] = {}
        for site, page, html in zip(batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if not html:
                continue
            own, first = {"": 1}, {"": 0}
            for place, (key, _, _) in enumerate(read(html)):
                own[key] = own.get(key, 0) + 1
                first.setdefault(key, place)
            for key, count in own.items():
                digest = _digest(page, count)
                # the pages of all hosts together know each other by their tags only
                for name in (site, None) if "#" not in key else (site,):
                    total = counted.setdefault((name, key), [0, 0, 0])
                    total[0] += 1
                    total[1] += digest
                    total[2] += first[key]
        hosts, keys = zip(*counted, strict=True) if counted else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(keys, pa.string()), *[pa.array([c[i] for c in counted.values()], pa.int64()) for i in range(3)]],
            names=["host", "key", "pages", "digest", "place"],
        )


def templates(pages: DataFrame) -> DataFrame:
    """``host`` (null: all pages together) and ``tokens`` (array of key, pages, digest, place) that enough of its pages have.

    ``pages`` has ``host``, ``page`` (a number that tells pages apart) and ``html``. Each token is on at least the share
    ``MIN_SHARE`` of the host's pages, so a template has at most so many times as many tokens as a page.
    """
    counted = pages.select("host", "page", "html").mapInArrow(_occurrences, "host string, key string, pages long, digest long, place long")
    counted = stored(counted.groupBy("host", "key").agg(F.sum("pages").alias("pages"), F.sum("digest").alias("digest"), F.sum("place").alias("place")).where("pages >= 2 OR key = ''"), "tokens")
    sizes = counted.where(F.col("key") == "").select(F.col("host").alias("of"), F.col("pages").alias("all_pages")).where(F.col("all_pages") >= MIN_PAGES)
    enough = counted.where("key != ''").join(sizes, F.col("host").eqNullSafe(F.col("of"))).where(F.col("pages") >= F.col("all_pages") * MIN_SHARE)
    return enough.groupBy("host").agg(F.collect_list(F.struct("key", "pages", "digest", (F.col("place") / F.col("pages")).alias("place"))).alias("tokens"))


def _extract(batches, common):
    shared = Template(common) if common else None
    known: dict[str, Template] = {}
    for batch in batches:
        texts = []
        for site, html, tokens in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), batch.column("tokens"), strict=True):
            template = shared
            if tokens.is_valid:
                if site not in known:
                    known.clear() if len(known) > 100 else None
                    known[site] = Template([tuple(t.values()) for t in tokens.as_py()])
                template = known[site]
            texts.append(extract(html, template))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", "text", "n_chars"])


def extract_pages(pages: DataFrame, carried: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """``carried`` as one struct ``row`` (see ``arrow.unpacked``), ``text`` and ``n_chars`` of each row of ``pages``.

    Blocks are joined by an empty line, in page order; character references are decoded and white space inside a block
    is one space. Null and empty pages have an empty text. A null URL, or one without a host, belongs to one host of
    its own. Repeated rows are pages of their own; an empty table gives no rows.
    """
    given = packed(pages, html, [*carried, url])
    site = host(F.coalesce(F.col(f"row.c{len(carried)}"), F.lit("")))
    given = given.select("row", F.col("text").alias("html"), site.alias("host"))
    found = templates(given.select("host", "html", F.xxhash64("html").alias("page")))
    found = stored(found, "templates")
    common = found.where("host IS NULL").select("tokens").first()
    common = [tuple(t) for t in common["tokens"]] if common else []
    by_host = found.where("host IS NOT NULL")
    row, _ = row_type(given)
    joined = given.join(by_host, "host", "left").select("row", "host", "html", "tokens")
    return joined.mapInArrow(lambda batches: _extract(batches, common), f"row {row}, text string, n_chars long")
