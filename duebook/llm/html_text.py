"""Main text of web pages by deducing each host's template.

Tokens of a page are its tags, told apart by their place in the tree, and its
text blocks.  Tokens with equal occurrence vectors (how often on which of the
host's pages) form an equivalence class; classes on enough pages are the template
of the host, nested by the places of their tags (Arasu and Garcia-Molina,
"Extracting Structured Data from Web Pages", 2003).  What a page has in the
template's slots is left, in an ``article`` too: text blocks of the template itself
are navigation, notices and the like, and among the template's containers the one
that holds the most slot text is where pages carry their text.  ``article`` and
``main`` are a hint: text in them counts ``HINT`` times when containers are compared,
the one around the container belongs to it, and they decide where no template does.

Occurrence vectors are never built: tokens of a host are compared by the 128-bit
sum of a hash of (page, count) over pages, which is summed before and after the
shuffle, so a host with a third of all pages is no larger group than others.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Set
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .url_filter import host_and_path

LEAST_PAGES = 4
LEAST_SHARE = 0.9
HINT = 2

# HTML's names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe svg canvas object nav footer aside button select textarea "
    "input dialog menu title option datalist video audio".split()
)
MAIN = frozenset(("article", "main"))
ENDS_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Words in class, id and role that name something beside the article, but not after one
# of NOT_ITSELF in the same name: "page-with-sidebar" is no sidebar.
NOT_ITSELF = frozenset("has have with without no not".split())
BESIDE = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside "
    "footer header masthead share sharing social related recommended newsletter subscribe signup login search form widget toolbar pagination pager skip "
    "complementary contentinfo navigation".split()
)
# Words that name what readers wrote.
READERS = frozenset("comment comments comentarios kommentare commentaires disqus reply replies respond".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PART = re.compile(r"[^a-z]+")
_NUMBER = re.compile(r"[0-9]{2,}")


def _beside(attributes: str) -> int:
    """2 if a name tells of readers' comments, 1 if of another thing beside the article."""
    found = 0
    for names in _NAMES.findall(attributes):
        for name in "".join(names).lower().split():
            for part in _PART.split(name):
                if part in NOT_ITSELF:
                    break
                found = max(found, 2 if part in READERS else int(part in BESIDE))
    return found


class Page:
    """A page read as a stream of tags and text blocks, in page order.

    ``read`` holds (place, never, marked, main, text) of each tag that opens (text empty)
    and of each text block; ``never`` if it is in what never holds the article
    (``DROPPED``), ``marked`` the innermost element around that is a form or has a name
    that marks it as beside the article, 0 for none.

    A place stands for the path of open elements with their classes, in which numbers of
    two digits and more are alike (``post-17``): a hash of the name and the place of the
    parent, which ``parent`` gives, so that deep nesting takes no longer names.  ``main``
    is the place of the innermost ``article`` around, else of ``main``, else empty.  White
    space in a block becomes one space, character references are decoded.
    """

    def __init__(self, page: str | None):
        self.parent: dict[str, str] = {"": ""}
        self.around = [0]  # of each marked element, the next one outside
        self.readers = [False]  # whether its name tells of comments
        self.in_main = [False]  # whether it is inside an article or main
        self.holds = {0}  # marked elements with an article or main
        self.read = list(self._parsed(page or ""))

    def blocks(self, known: Set[str] = frozenset()) -> Iterator[tuple[str, int, str, str]]:
        """(place, dropped, main, text): ``dropped`` is 2 in what never holds the article,
        1 in a marked element, else 0.

        A marked element is a wrapper and not dropped where no article or main has text
        outside of marked ones, and it holds one, or more than half of the page's text
        that is not ``known`` template; and inside an article that has more than half of the
        text of articles in it.  One of comments is a wrapper only if it holds an article or all text.
        """
        n = len(self.around)
        size, of_main, main_outside = [0] * n, [0] * n, False
        if n > 1:
            for place, never, marked, main, text in self.read:
                if text and not never and _said(place, text) not in known:
                    main_outside |= bool(main) and not marked
                    size[marked] += len(text)
                    of_main[marked] += len(text) if main else 0
            for i in range(n - 1, 0, -1):  # an element opens after those around it
                size[self.around[i]] += size[i]
                of_main[self.around[i]] += of_main[i]
        beside = [False]
        for i in range(1, n):
            if main_outside:
                wraps = self.in_main[i] and not self.readers[i] and 2 * of_main[i] > of_main[0]
            elif self.readers[i]:
                wraps = i in self.holds or size[i] == size[0]
            else:
                wraps = i in self.holds or 2 * size[i] > size[0]
            beside.append(beside[self.around[i]] or not wraps)
        for place, never, marked, main, text in self.read:
            yield place, 2 if never else int(beside[marked]), main, text

    def within(self, outer: str) -> dict[str, bool]:
        """Whether each place is ``outer`` or inside of it."""
        found = {"": outer == ""}
        for place, above in self.parent.items():  # parents come first
            found[place] = place == outer or found[above]
        return found

    def up_from(self, place: str) -> dict[str, int]:
        """The place and those around it, each with its distance."""
        found: dict[str, int] = {}
        while place:
            found[place] = len(found)
            place = self.parent[place]
        return found

    def _below(self, above: str, name: str) -> str:
        place = _place(above, name)
        self.parent[place] = above
        return place

    def _parsed(self, page: str) -> Iterator[tuple[str, bool, int, str, str]]:
        outside = ("", "", False, "", 0)
        stack: list[tuple[str, str, bool, str, int]] = []  # name, place, never, main, marked
        at_depth: dict[str, list[int]] = {}  # where elements of a name are open
        solid = [0]  # how many elements up to each depth are not inline
        text: list[str] = []

        def flush():
            said = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            return said

        def push(*element):
            at_depth.setdefault(element[0], []).append(len(stack))
            stack.append(element)
            solid.append(solid[-1] + (element[0] not in INLINE))

        def cut(depth):
            while len(stack) > depth:
                at_depth[stack.pop()[0]].pop()
                solid.pop()

        def innermost(*names):
            return max((found[-1] for name in names if (found := at_depth.get(name))), default=None)

        at, here = 0, outside
        end = len(page)
        while at < end:
            m = _TOKEN.search(page, at)
            text.append(page[at : m.start() if m else end])
            if not m:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                depth = innermost(name)
                if name not in INLINE:
                    if said := flush():
                        yield here[1], here[2], here[4], here[3], said
                if depth is not None and not (name in INLINE and solid[-1] > solid[depth + 1]):
                    cut(depth)
                    here = stack[-1] if stack else outside
                continue
            if name not in INLINE:
                if said := flush():
                    yield here[1], here[2], here[4], here[3], said
                if name in ENDS_P and (depth := innermost("p")) is not None:
                    cut(depth)
                if name in SAME:
                    depth = innermost(*SAME[name], "ul", "ol", "dl", "table")
                    if depth is not None and stack[depth][0] in SAME[name]:
                        cut(depth)
                here = stack[-1] if stack else outside
            elif name == "br":
                text.append(" ")
            attributes = m[3] or m[6] or ""
            if name in VOID:
                continue
            kind = "" if name in INLINE else _NUMBER.sub("#", " ".join(sorted(x for found in _NAMES.findall(attributes) for x in "".join(found).split())))
            place = here[1] if name in INLINE else self._below(here[1], name + f"[{kind}]" * bool(kind))
            opens = (name in MAIN and not here[2]) or bool(re.search(r"role\s*=\s*[\"']?main\b", attributes))
            main = place if opens and (name == "article" or not here[3]) else here[3]
            never = here[2] or name in DROPPED or (name == "header" and not here[3])
            marked = here[4]
            if opens and not never:
                up = marked
                while up not in self.holds:
                    self.holds.add(up)
                    up = self.around[up]
            names = 0 if name in ("html", "body", "main") or (name == "article" and not here[3]) else _beside(attributes)
            if name == "form" or names:
                self.around.append(marked)
                self.readers.append(names == 2)
                self.in_main.append(bool(here[3]))
                marked = len(self.around) - 1
            if name not in INLINE:
                yield place, never, marked, main, ""
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = close.start() if close else end
                push(name, place, True, main, marked)
            elif not attributes.rstrip().endswith("/"):
                push(name, place, never, main, marked)
            if stack:
                here = stack[-1]
        if said := flush():
            yield here[1], here[2], here[4], here[3], said


@lru_cache(1 << 16)  # the pages of a host have the same places
def _place(above: str, name: str) -> str:
    return blake2b(f"{above}/{name}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _mark(text: str) -> str:
    """What stands for a text block among the tokens: 128 bits, so that no texts are moved."""
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _said(place: str, text: str) -> str:
    return f"{place}\n{_mark(text)}"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct token of a page, with the place of its parent, its count and the length
    of the text: of the blocks of which a tag is the parent (``HINT`` times in an article),
    of a block itself."""
    for batch in batches:
        out: list[tuple] = []
        for host, key, html in zip(*(batch[c].to_pylist() for c in ("host", "key", "html")), strict=True):
            counts: Counter = Counter()
            size: Counter = Counter()
            page = Page(html)
            for place, dropped, main, text in page.blocks():
                if not text:
                    counts[(place, "")] += 1
                elif dropped < 2:
                    token, long = (place, _mark(text)), 0 if dropped else len(text) * (HINT if main else 1)
                    counts[token] += 1
                    size[token] += long
                    size[(page.parent[place], "")] += long
            out += [(host, key, place, mark, page.parent[place], size[place, mark], n) for (place, mark), n in counts.items()]
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        kinds = (pa.string(), pa.int64(), *(pa.string(),) * 3, pa.int64(), pa.int64())
        names = ["host", "key", "place", "mark", "parent", "size", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def templates(pages: DataFrame) -> DataFrame:
    """``host``, ``said`` (text blocks of its template), ``container`` (its place with
    the most slot text) of hosts with at least ``LEAST_PAGES`` pages.

    ``pages`` has host, key (of a page) and html.
    """
    scratch = Scratch(pages.sparkSession)
    tokens = pages.mapInArrow(_tokens, "host string, key long, place string, mark string, parent string, size long, n long")
    vector = [F.sum(F.xxhash64(F.lit(i), "key", "n").cast("decimal(38,0)")).alias(v) for i, v in enumerate("vw")]
    counted = tokens.groupBy("host", "place", "mark", "parent").agg(*vector, F.count("*").alias("pages"), F.sum("size").alias("size"))
    found = scratch.cut(counted.where(F.col("pages") >= LEAST_SHARE * LEAST_PAGES))  # fewer are often on no host
    hosts = found.groupBy("host").agg(F.max("pages").alias("of_host")).where(F.col("of_host") >= LEAST_PAGES)
    # Tokens of one vector are on as many pages, so what is seldom goes before classes are formed.
    often = scratch.cut(found.join(hosts, "host").where(F.col("pages") >= LEAST_SHARE * F.col("of_host")))
    classes = often.groupBy("host", "v", "w").agg(F.count("*").alias("members"), F.max((F.col("mark") == "").cast("int")).alias("tags"))
    classes = classes.where("members > 1 and tags = 1")  # a class that nests: with a tag and something beside it
    valid = scratch.cut(often.join(classes.select("host", "v", "w"), ["host", "v", "w"]))
    parent = F.when(F.col("mark") == "", F.col("place")).otherwise(F.col("parent"))
    own = F.when(F.col("mark") == "", F.col("size")).otherwise(-F.col("size"))  # slot text: all text without the template's
    slots = valid.groupBy("host", parent.alias("place")).agg(F.sum(own).alias("size"), F.max((F.col("mark") == "").cast("int")).alias("tags"))
    slots = slots.where("tags = 1").groupBy("host").agg(F.max(F.struct("size", "place")).alias("slot"))
    said = F.collect_set(F.when(F.col("mark") != "", F.concat("place", F.lit("\n"), "mark"))).alias("said")
    known = valid.groupBy("host").agg(said).join(slots, "host", "left")
    return scratch.cut(known.select("host", "said", F.when(F.col("slot.size") > 0, F.col("slot.place")).alias("container")))


def extract(page: str | None, said: list[str] | None, container: str | None) -> str:
    """The main text: the blocks that are not template, in the host's container and
    the ``article`` or ``main`` around it.  A page with nothing there gives those in
    its own ``article`` or ``main``, else all; a page that is template throughout, as
    all pages of a host of copies are, is read without one."""
    known = frozenset(said or ())
    read = Page(page)
    all_left = [(place, main, text) for place, dropped, main, text in read.blocks(known) if text and not dropped]
    left = [x for x in all_left if _said(x[0], x[2]) not in known] if known else all_left
    left = left or all_left
    if container and container in read.parent:
        inside, above = read.within(container), read.up_from(container)
        around = {main for place, main, _ in left if main and inside[place] and main in above}
        inside = read.within(max(around, key=above.__getitem__, default=container))
        inner = [text for place, _, text in left if inside[place]]
        if inner:
            return "\n\n".join(inner)
    return "\n\n".join([text for _, main, text in left if main] or [text for _, _, text in left])


def _extracted(pages: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for html, said, container in pages:
        yield pa.array([extract(*x) for x in zip(html.to_pylist(), said.to_pylist(), container.to_pylist(), strict=True)], pa.string())


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points) of every page.

    A null or empty html gives an empty text.  A null url belongs to the host
    ``''``.  Pages of hosts with few pages have no template.  Rows come out as often
    as they came in; an empty table gives an empty table.
    """
    host = host_and_path(F.col("url"))[0]
    named = pages.select(host.alias("host"), "page_id", "url", F.col("html").cast("string").alias("html"))
    key: Column = F.xxhash64("page_id", "url", "html").alias("key")
    known = templates(named.select("host", key, "html"))
    joined = named.join(known, "host", "left")
    text = F.arrow_udf(_extracted, "string")("html", "said", "container")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
