"""Main text of web pages: differencing of pages with near URLs, checked against the markup.

A page becomes lines, one per block. Its candidate lines are those of the main region
where the markup names one (``article``, ``main`` or the usual attributes), without the
parts that markup names as menus, notices, adverts, forms, comments and the like;
otherwise all lines that markup does not name. An article among comments or teasers is
the main region only if the page has no other.

Every page is compared with the page of the nearest URL path on its host: its candidate
lines and all lines of the other are aligned by a longest common subsequence, and shared
lines are deleted as template. Two checks follow. Lines of a named main region come back,
because sites repeat passages and whole articles under near URLs, and those must stay.
If all lines of a page without a main region are shared, the two are copies of one
article and all stay. ``n_shared`` tells how many candidate lines were found shared. A
page that is alone on its host keeps its lines.

Neighbours come from a range partitioning by host and path, so a host with a third of
all pages spreads over many tasks; the first path of each range is handed to the range
before it. Of pages with equal paths the one with the least line hashes is compared. Of
two neighbours that are as near, the one before is taken. Only its line hashes are
shuffled; candidate lines move once, to the hashes of their neighbour, and html never.
Pages are parsed twice, which takes less than storing what was parsed.

Edge cases: null or empty html gives an empty text; a null url has no host and thus no
neighbour. Tags that are never closed, cut pages and stray end tags are tolerated. If
all of a page was dropped, all lines that a reader sees are compared.
Repeated rows and pages with equal paths share their neighbour. An empty table gives
no rows; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.common import text_of
from flowsift.storage import materialize

# Names of HTML and words that sites use in class and id attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
UNSEEN_TAGS = frozenset("head title script style noscript template svg iframe object canvas".split())
DROPPED_TAGS = frozenset("nav footer aside button select textarea dialog menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe subscription signup login sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus reply replies respond share sharing social related "
    "recommended recommendations widget toolbar pagination pager skip".split()
)
# Parts that a dropped name may have besides dropped words; any other part makes it a state or another thing.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box button buttons container content form group inner item items left link links list main "
    "panel post posts right section site slot text title top unit wrap wrapper".split()
)
# A start tag that ends an open element of these kinds, unless one of the others comes first.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "table", "article", "main")),
    "td": (("td", "th"), ("table",)),
    "th": (("td", "th"), ("table",)),
    "tr": (("tr",), ("table",)),
    "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")),
}
ENDS_P = frozenset(
    "address article aside blockquote dd details div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li "
    "main menu nav ol p pre section table tr td th ul".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset(
    ["main", "content", "main-content", "maincontent", "article", "article-body", "article-content", "post",
     "post-content", "post-body", "entry-content", "story", "story-body"]
)
# A form, and a region skipped for its class words, end where a main one begins; dropped and unseen ones hold.
# An article in a skipped region, or one that is itself named as comment or teaser, may be the main one: it is if
# the page has no other.
REGIONS = ("open", "main", "maybe", "skipped", "form", "dropped", "unseen")


def _dropped_name(name: str) -> bool:
    """Whether a whole class name or id says that its element is no text of the page."""
    parts = set(re.split("[-_]+", name)) - {""}
    return bool(parts & DROPPED_WORDS) and parts <= DROPPED_WORDS | NEUTRAL_WORDS


class _Lines(HTMLParser):
    """Collects (region, line) of a page; a region holds until its element ends."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Region names are those of REGIONS.
        self.stack: list[tuple[str, str]] = []
        self.lines: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.region = "open"

    def end_line(self) -> None:
        if self.parts:
            line = " ".join("".join(self.parts).split())
            self.parts.clear()
            if line:
                self.lines.append((self.region, line))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.end_line()
        self.end_implied(tag)
        if tag in VOID:
            return
        if tag in MAIN_TAGS:
            # Menus and page headers left open end where the article begins.
            for k, (name, _) in enumerate(self.stack):
                if name in ("nav", "header", "head"):
                    del self.stack[k:]
                    self.region = self.stack[-1][1] if self.stack else "open"
                    break
        elif tag == "body" and any(name == "head" for name, _ in self.stack):
            self.stack.clear()
            self.region = "open"
        region = self.named(tag, dict(attrs))
        if region != self.region:
            self.end_line()
        self.stack.append((tag, region))
        self.region = region

    def end_implied(self, tag: str) -> None:
        """End elements whose end tag may be left out before this start tag."""
        if tag in ENDS_P:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == "p":
                    self.cut(k)
                    break
                if self.stack[k][0] not in INLINE:
                    break
        kinds, stops = IMPLIED.get(tag, ((), ()))
        for k in range(len(self.stack) - 1 if kinds else -1, -1, -1):
            if self.stack[k][0] in kinds:
                self.cut(k)
                break
            if self.stack[k][0] in stops:
                break

    def cut(self, k: int) -> None:
        region = self.stack[k - 1][1] if k else "open"
        if region != self.region:
            self.end_line()
        del self.stack[k:]
        self.region = region

    def named(self, tag: str, attrs: dict[str, str | None]) -> str:
        if self.region == "unseen" or tag in UNSEEN_TAGS:
            return "unseen"
        if self.region == "dropped" or tag in DROPPED_TAGS or tag == "header" and self.region != "main":
            return "dropped"
        # Inside a main region comments and teasers can be articles too.
        inside = any(region == "main" for _, region in self.stack)
        plain = tag in ("html", "body")
        names = [] if plain else f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()
        role = "" if plain else (attrs.get("role") or "").lower()
        if not plain and ("hidden" in attrs or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()):
            return "unseen"
        if role in DROPPED_ROLES:
            return "dropped"
        skips = any(_dropped_name(n) for n in names)
        named_main = tag in MAIN_TAGS or role == "main" or (attrs.get("itemprop") or "").lower() == "articlebody"
        if named_main and not inside:
            return "maybe" if skips or self.region in ("skipped", "maybe") else "main"
        if self.region in ("skipped", "form") or skips:
            return "skipped" if skips or self.region == "skipped" else "form"
        if tag == "form":
            return "form"
        if self.region == "maybe":
            return "maybe"
        return "main" if named_main or MAIN_WORDS.intersection(names) else self.region

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Only void elements close themselves in HTML; the slash of others means nothing.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                self.cut(k)
                return

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def page_lines(html: str | None) -> list[tuple[str, str]]:
    """(region, text) of every line of a page, in order."""
    if not html:
        return []
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    maybe = "skipped" if any(region == "main" for region, _ in parser.lines) else "main"
    final = {"maybe": maybe, "form": "skipped"}
    return [(final.get(region, region), text) for region, text in parser.lines]


def shared_lines(a: list[int], b: list[int]) -> list[bool]:
    """Which items of ``a`` a longest common subsequence with ``b`` holds.

    Row ``i`` of the length table is kept as the bits where it grows along ``b``, which
    one addition turns into the next row. Every ``step``-th row is kept and those
    between are made again on the way back, so memory is about ``sqrt(len(a))`` rows.
    """
    n, m = len(a), len(b)
    held = [False] * n
    if not n or not m:
        return held
    every = (1 << m) - 1
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j

    def after(row: int, x: int) -> int:
        # Bits that are 0 mark where the common subsequence gets longer.
        hits = row & places.get(x, 0)
        return ((row + hits) | (row - hits)) & every

    step = max(1, int(n**0.5))
    kept, row = [], every
    for i, x in enumerate(a):
        if i % step == 0:
            kept.append(row)
        row = after(row, x)
    j = m - 1
    for block in range(len(kept) - 1, -1, -1):
        rows = [kept[block]]
        stop = min(n, (block + 1) * step)
        for i in range(block * step, stop):
            rows.append(after(rows[-1], a[i]))
        for i in range(stop - 1, block * step - 1, -1):
            now, was = rows[i - block * step + 1], rows[i - block * step]
            upto = (1 << (j + 1)) - 1
            grows = ~now & upto
            if not grows:
                return held
            # The last place up to j where this row grows ends a best alignment.
            j = grows.bit_length() - 1
            if (~was & upto & ((1 << (j + 1)) - 1)).bit_count() < grows.bit_count():
                held[i] = True
                j -= 1
    return held


def _candidates(html: Column) -> Column:
    """Whether the markup names the main region, and the lines that may be the text."""

    @F.pandas_udf("struct<named boolean, lines array<string>>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            out = []
            for html in pages:
                lines = page_lines(html)
                found = [t for region, t in lines if region == "main"]
                named = bool(found)
                found = found or [t for region, t in lines if region == "open"]
                out.append((named, found or [t for region, t in lines if region != "unseen"]))
            yield pd.DataFrame(out, columns=["named", "lines"])

    return parse(html)


def _all_lines(html: Column) -> Column:
    @F.pandas_udf("array<string>")
    def parse(pages: pd.Series) -> pd.Series:
        return pd.Series([[t for _, t in page_lines(html)] for html in pages], dtype=object)

    return parse(html)


def _hashes(lines: Column) -> Column:
    return F.transform(lines, lambda t: F.xxhash64(t))


def _aligned(mine: Column, other: Column) -> Column:
    @F.pandas_udf("array<boolean>")
    def align(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([shared_lines(list(x), list(y)) for x, y in zip(a, b, strict=True)], dtype=object)

    return align(mine, other)


def _neighbours(pages: DataFrame) -> DataFrame:
    """``host, path, other``: for every path the nearest other path on the host."""
    paths = pages.where("host IS NOT NULL").select("host", "path").distinct()
    # Stored, because ranges come from a sample and must not change between uses.
    ranged = materialize(paths.repartitionByRange("host", "path").withColumn("part", F.spark_partition_id()), "paths")
    here = Window.partitionBy("part").orderBy("host", "path")
    me = F.struct("host", "path")
    near = ranged.select("*", F.lag(me).over(here).alias("before"), F.lead(me).over(here).alias("next"))
    ends = ranged.groupBy("part").agg(F.min(me).alias("lo"), F.max(me).alias("hi"))
    order = Window.orderBy("part")
    ends = ends.select(F.col("part").alias("p"), F.lag("hi").over(order).alias("hi"), F.lead("lo").over(order).alias("lo"))
    near = near.join(F.broadcast(ends), F.col("part") == F.col("p"))  # one row per partition
    near = near.withColumn("before", F.coalesce("before", "hi")).withColumn("next", F.coalesce("next", "lo"))

    def common(other: str) -> Column:
        n = F.least(F.char_length("path"), F.char_length(f"{other}.path"))
        agree = F.filter(F.sequence(F.lit(0), n), lambda k: F.substring("path", 1, k) == F.substring(F.col(f"{other}.path"), 1, k))
        return F.when(F.col(f"{other}.host") == F.col("host"), F.size(agree)).otherwise(0)

    near = near.withColumn("b", common("before")).withColumn("n", common("next"))
    near = near.withColumn("other", F.when(F.col("b") >= F.col("n"), F.col("before")).otherwise(F.col("next")))
    return near.where("b > 0 OR n > 0").select("host", "path", F.col("other.path").alias("other"))


def _neighbour_lines(pages: DataFrame) -> DataFrame:
    """``h, q, theirs``: for every path the line hashes of the page of the nearest other path."""
    seen = pages.where("host IS NOT NULL").select("host", "path", _hashes(_all_lines(F.col("html"))).alias("hashes"))
    seen = seen.groupBy("host", "path").agg(F.min("hashes").alias("theirs"))
    near = _neighbours(pages).toDF("h", "q", "other")
    return seen.join(near, (F.col("host") == F.col("h")) & (F.col("path") == F.col("other"))).select("h", "q", "theirs")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_shared`` of every page."""
    url = F.col(f"`{url_col}`").cast("string")
    address = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)"
    host, path = F.lower(F.regexp_extract(url, address, 1)), F.regexp_extract(url, address, 2)
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.when(F.length(host) > 0, host).alias("host"),
        F.regexp_replace(path, r"(\.html?)?/*$", "").alias("path"),
        text_of(f"`{html_col}`").alias("html"),
    )
    # Pages without a host meet nothing; their hash spreads them over the tasks of the join.
    at = F.when(F.col("host").isNull(), F.hex(F.xxhash64("html"))).otherwise(F.col("path"))
    mine = rows.select("page_id", "url", F.coalesce("host", F.lit("")).alias("host"), at.alias("path"), _candidates(F.col("html")).alias("p"))
    mine = mine.select("page_id", "url", "host", "path", "p.named", "p.lines")
    both = mine.join(_neighbour_lines(rows), (F.col("host") == F.col("h")) & (F.col("path") == F.col("q")), "left")
    none = F.expr("array()").cast("array<bigint>")
    both = both.withColumn("shared", _aligned(_hashes(F.col("lines")), F.coalesce("theirs", none)))
    # What the markup names as main comes back.
    own = F.filter("lines", lambda _, i: ~F.get("shared", i) | F.col("named"))
    text = F.array_join(F.when(F.size(own) > 0, own).otherwise(F.col("lines")), " ")
    n_shared = F.size(F.filter("shared", lambda s: s)).cast("long")
    out = both.select("page_id", "url", text.alias("text"), n_shared.alias("n_shared"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_shared")
