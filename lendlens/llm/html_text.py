"""Main text of web pages by template deduction from equivalence classes of tokens.

A token is a text with its path, told apart by the how-manieth of its kind it is on the page, or a tag
with its path that occurs once on the page. Tokens of a host that occur on exactly the same pages form
a class. Classes on enough pages are validated: their tokens must come in one order, so a token whose
rank in its class changes from page to page is left out. The class on most pages is the template's
frame; tokens of the others are nested into it if they lie in one and the same slot of the frame on
every page. Texts of the frame and nested texts are the host's template and are cut; what remains are
the slots. Element names, and the words of class, id and role, only decide between slots.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from lendlens.llm.common import ready
from lendlens.operators.joins import dealt_join
from lendlens.sources.session import stage

#: A class is frequent on three pages at least (the usual support of the method) and on this share of the host's.
SUPPORT, SHARE = 3, 0.6
#: A main element with less text than this share of the page's largest one is a teaser.
TEASER = 0.25

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SILENT = set(
    "head script style noscript template svg math iframe object select option button input textarea canvas audio video "
    "map form nav aside footer menu dialog".split()
)
CLOSES = {
    "p": set("p".split()),
    "li": set("li p".split()),
    "dt": set("dt dd p".split()),
    "dd": set("dt dd p".split()),
    "tr": set("tr td th p".split()),
    "td": set("td th p".split()),
    "th": set("td th p".split()),
    "option": set("option".split()),
}
ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: Ends the search for an element to close.
SCOPE = set("article aside body blockquote div footer header html main nav section table td th ul ol dl form".split())
MAIN = {"article", "main"}
#: Never silent by their names, which there tell of the page's layout.
WHOLE = {"html", "body"} | MAIN
#: Silent elements that some pages wrap around all they hold.
UNSURE = set("header nav aside footer menu dialog form map".split())
# Words of class, id and role attributes.
SILENT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted related "
    "replies respond search share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split()
)
MAIN_WORDS = set("article articlebody content entry main post story".split())
#: Words that, beside a silent one, leave a name silent.
NEUTRAL_WORDS = set(
    "area bar block box button container feed footer group head header inner item items link links list outer overlay panel "
    "posts section signup site thread top user users wrap wrapper".split()
)

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Text:
    """One run of character data."""

    path: int
    value: str
    block: int
    silent: int  # 0 shown, 1 silent by a name or an unsure element, 2 never shown
    main: int  # 2 inside an element for main text, 1 inside one named so, 0 else
    linked: bool
    region: int  # number of the outermost main element, 0 outside
    token: int = 0


@dataclass
class Page:
    texts: list[Text] = field(default_factory=list)
    tokens: list[tuple[int, bool]] = field(default_factory=list)  # key and whether it is a text, in page order


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


def _named(attributes: str) -> tuple[bool, bool]:
    """Whether one of the element's names is that of silent parts, and one that of main text.

    A name of several parts is silent if it has a silent word and its others are such or neutral
    ("cookie-bar", "comment-list", not "with-nav"), and that of main text only if it has no silent
    word ("main-nav" is neither).
    """
    quiet = named = False
    for name in " ".join(x.strip("\"'") for x in _NAMES.findall(attributes)).lower().split():
        words = {x for x in _WORD.findall(name) if not x.isdigit()}
        silent = words & SILENT_WORDS
        quiet |= bool(silent) and words - silent <= NEUTRAL_WORDS
        named |= bool(words & MAIN_WORDS) and not silent
    return quiet, named


@dataclass
class _Element:
    name: str
    silent: int
    main: int
    path: int
    links: int
    region: int


class _Open:
    """The open elements, with the places of each name, so that ends are found without a search."""

    def __init__(self):
        self.stack: list[_Element] = [_Element("", 0, 0, 0, 0, 0)]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = [0]

    @property
    def top(self) -> _Element:
        return self.stack[-1]

    def push(self, element: _Element) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        if element.name in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append(element)

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            element = self.stack.pop()
            self.places[element.name].pop()
            if self.scopes[-1] == len(self.stack):
                self.scopes.pop()

    def end(self, name: str) -> int | None:
        """Path of the element that an end tag closes; an inline one closes none outside its scope."""
        places = self.places.get(name)
        if not places or (name in INLINE and self.scopes[-1] > places[-1]):
            return None
        path = self.stack[places[-1]].path
        self.cut(places[-1])
        return path

    def imply(self, closed: set[str]) -> None:
        """Close the elements ``closed`` down to the nearest other scope."""
        at = len(self.scopes) - 1
        while at and self.stack[self.scopes[at]].name in closed:
            at -= 1
        least = len(self.stack)
        for name in closed:
            places = self.places.get(name)
            if places:
                k = bisect_right(places, self.scopes[at])
                if k < len(places):
                    least = min(least, places[k])
        self.cut(least)


def parse(source: str) -> Page:
    """The page's texts and tokens, tolerant of elements left open and of stray ends.

    Linear in the page: no more tags are looked for behind the last ``>``, paths are hashed step by
    step, and ends find their element by its name's place.
    """
    page, seen = Page(), Counter()
    elements = _Open()
    block, at, regions = 0, 0, 0
    size, last = len(source), source.rfind(">")

    def text_token(value: int) -> int:
        seen[value] += 1
        key = value if seen[value] == 1 else _hash(f"{value}#{seen[value]}")
        page.tokens.append((key, True))
        return key

    def tag_token(value: int) -> None:
        seen[value] += 1
        page.tokens.append((value, False))

    while at <= size:
        m = _TAG.search(source, at) if at <= last or source.startswith("<!", source.find("<", at)) else None
        raw = source[at : m.start()] if m else source[at:]
        if raw and not raw.isspace():
            top = elements.top
            value = " ".join(entities.unescape(raw).split())
            if value:
                shown = (" " if raw[0].isspace() else "") + value + (" " if raw[-1].isspace() else "")
                found = Text(top.path, shown, block, top.silent, top.main, top.links > 0, top.region)
                found.token = text_token(_hash(f"{top.path}|{value}"))
                page.texts.append(found)
        elif raw and page.texts and page.texts[-1].block == block:
            page.texts[-1].value += " "
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        end, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name not in INLINE:
            block += 1
        elif name == "br" and page.texts and page.texts[-1].block == block:
            page.texts[-1].value += " "
        if end:
            path = elements.end(name)
            if path is not None:
                tag_token(_hash(f"/{path}"))
            continue
        closed = CLOSES.get(name, set()) | ({"p"} if name in ENDS_P else set())
        if closed:
            elements.imply(closed)
        top = elements.top
        quiet, named = _named(attributes) if attributes else (False, False)
        path = _hash(f"{top.path}>{name}")
        tag_token(path)
        silent, main, region = top.silent, top.main, top.region
        if name in SILENT - UNSURE:
            silent = 2
        elif name in SILENT or (quiet and name not in WHOLE) or (name == "header" and not main):
            silent = max(silent, 1)
        main = max(main, 2 if name in MAIN else 1 if named else 0)
        if name in MAIN and not region:
            regions += 1
            region = regions
        if name in RAW:
            close = re.compile(f"</{name}", re.I).search(source, at)
            at = close.start() if close else size
        if name not in VOID and not attributes.endswith("/"):
            elements.push(_Element(name, silent, main, path, top.links + (name == "a"), region))
    page.tokens = [(key, is_text) for key, is_text in page.tokens if is_text or seen[key] == 1]
    return page


def extract(source: str | None, fixed: set[int]) -> str:
    """Main text of a page whose template has the texts with the tokens ``fixed``: its slots, of which

    those silent by name or element are left out (unless all are); where the page has an element for
    main text (or else one named so) only the slots inside count, without teasers; where it has neither,
    all whose text is not mostly links.
    """
    if not source:
        return ""
    texts = [t for t in parse(source).texts if t.silent < 2]
    texts = [t for t in texts if t.token not in fixed]
    texts = [t for t in texts if not t.silent] or texts
    level = max((t.main for t in texts), default=0)
    if level == 2:
        sizes: Counter = Counter()
        for t in texts:
            sizes[t.region] += len(t.value) * (t.region > 0)
        largest = max(sizes.values(), default=0)
        texts = [t for t in texts if t.region and sizes[t.region] >= TEASER * largest]
    blocks: dict[int, list[Text]] = {}
    for t in texts:
        if t.main >= level:
            blocks.setdefault(t.block, []).append(t)
    out = []
    for parts in blocks.values():
        whole = " ".join("".join(t.value for t in parts).split())
        if not level and 2 * sum(len(t.value) for t in parts if t.linked) > len(whole):
            continue
        if whole:
            out.append(whole)
    return "\n".join(out)


def _tokens(pages: DataFrame) -> DataFrame:
    """``host, token, page, place, is_text``: each token of each distinct page once, written.

    Token 0 stands for the page itself. Copies of a page count as one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, source in zip(batch["host"], batch["html"], strict=True):
                own = _hash(source)
                rows.append((host, 0, own, -1, False))
                rows += [(host, k, own, place, is_text) for place, (k, is_text) in enumerate(parse(source).tokens)]
            frame = pd.DataFrame(rows, columns=["host", "token", "page", "place", "is_text"])
            yield frame.astype({"token": np.int64, "page": np.int64, "place": np.int32, "is_text": bool})

    rows = pages.where("host is not null and html is not null").select(F.xxhash64("host").alias("host"), "html")
    found = rows.mapInPandas(run, "host bigint, token bigint, page bigint, place int, is_text boolean")
    return stage(found.dropDuplicates(["host", "token", "page"]), "html-tokens")


def templates(pages: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """``host, fixed``: tokens of the texts in each host's template (``host`` as its hash).

    Occurrence vectors are compared by a hash summed up over pages, so a hot host is reduced before
    the shuffle and never collected; its tokens' places are dealt to several tasks. What is gathered
    in one row is bounded by a page's tokens: a page's places of a class, and a host's template.
    """
    found = _tokens(pages)
    vectors = found.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.bit_xor(F.xxhash64("page")).alias("vector"), F.max("is_text").alias("is_text")
    )
    frequent = vectors.where(F.col("pages") >= support)
    hosts = frequent.where("token = 0").select("host", F.col("pages").alias("all"))
    frequent = frequent.where("token <> 0").join(hosts, "host").where(F.col("pages") >= share * F.col("all"))
    frequent = stage(frequent.withColumn("key", F.xxhash64("host", "token")), "html-classes")

    facts = frequent.select("key", "vector", "pages")
    placed = dealt_join(found.withColumn("key", F.xxhash64("host", "token")), facts, "key", "pages", "page")
    lines = placed.groupBy("host", "page", "vector").agg(F.sort_array(F.collect_list(F.struct("place", "token"))).alias("line"))
    ranked = stage(lines.select("host", "page", "vector", F.posexplode("line").alias("rank", "x")).select("*", "x.*").drop("x"), "html-ranks")
    steady = ranked.groupBy("host", "vector", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.min("rank").alias("low"), F.max("rank").alias("high")
    )
    steady = stage(steady.where("low = high").drop("low", "high"), "html-steady")
    # the frame: the class on most pages, of those the one with most tokens
    classes = steady.groupBy("host", "vector").agg(F.max("pages").alias("pages"), F.count(F.lit(1)).alias("size"))
    frames = classes.groupBy("host").agg(F.max_by("vector", F.struct("pages", "size", "vector")).alias("frame"))
    known = stage(steady.join(frames, "host").withColumn("key", F.xxhash64("host", "token")), "html-known")
    valid = dealt_join(
        ranked.select("host", "page", "token", "place", F.xxhash64("host", "token").alias("key")),
        known.select("key", "pages", (F.col("vector") == F.col("frame")).alias("framed")),
        "key",
        "pages",
        "page",
    )
    outer = F.sort_array(F.collect_list(F.when(F.col("framed"), F.col("place")))).alias("outer")
    inner = F.collect_list(F.when(~F.col("framed"), F.struct("token", "place"))).alias("inner")
    sides = valid.groupBy("host", "page").agg(outer, inner, F.count(F.lit(1)).alias("n"))
    slots = sides.select("host", "outer", F.inline("inner"))
    slot = F.size(F.filter("outer", lambda p: p < F.col("place")))
    nested = slots.groupBy("host", "token").agg(F.min(slot).alias("low"), F.max(slot).alias("high")).where("low = high")
    inside = known.where("vector = frame").select("host", "token").unionByName(nested.select("host", "token"))
    texts = inside.join(frequent.where("is_text").select("host", "token"), ["host", "token"])
    return texts.groupBy("host").agg(F.collect_list("token").alias("fixed"))


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    support: int = SUPPORT,
    share: float = SHARE,
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row: blocks in page order, joined by line ends.

    A null or empty html gives an empty text. Pages whose url is null or has no host, and hosts with
    fewer distinct pages than ``support``, have no template, only their own marks. Null ids and repeated
    rows are answered row by row, an empty table gives none, other columns are ignored. The templates'
    side of the join is written first, so its measured size decides how it is joined.
    """
    ready(pages.sparkSession)
    host = F.lower(F.nullif(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1), F.lit("")))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host")
    )
    known = stage(templates(rows, support, share), "html-templates")

    @F.pandas_udf("string")
    def extracted(sources: pd.Series, fixed: pd.Series) -> pd.Series:
        out = []
        for source, tokens in zip(sources, fixed, strict=True):
            out.append(extract(source, set(tokens.tolist()) if tokens is not None else set()))
        return pd.Series(out, dtype=object)

    keyed = rows.withColumn("host", F.when(F.col("host").isNotNull(), F.xxhash64("host")))
    joined = keyed.join(known, "host", "left").withColumn("text", extracted("html", "fixed"))
    return joined.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
