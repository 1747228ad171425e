"""Main text of web pages, with wrappers inferred per host from token streams.

A page is read as a stream of block tags and text slots; inline tags belong
to the text. Runs that repeat are folded into groups, which leaves a short
skeleton. The skeletons of a host are aligned one after another into a
wrapper, a regular expression without unions: what differs becomes optional,
what one page has once and another several times becomes a repeated group,
and differing texts share a slot. Over all pages of the host, a wrapper slot
shows whether it always holds the same text.

Text in an article or main element, or else in an element that is named as
content, is the main text; navigation, notices, adverts, forms, comments and
the like are cut out of it. Text before it, such as a title, goes with it if it
stands outside links and differs over the host's pages. A name counts as a whole: `cookie-notice` is a
notice, `has-sidebar` is none. No name cuts an element that is or holds an
article or main element, comments excepted, and no id cuts a heading or
section. Pages with neither keep the slots that are no
furniture: not mostly links, and not the same wherever the host's wrapper has
them. Copies of a page show nothing about that: only pages that differ count,
and where nothing else would be left, what is the same stays.

Pages are dealt out by Spark and never grouped; what is grouped by host are
the distinct skeletons, in groups of bounded size that are merged level by
level. The verdict on each skeleton goes back to the pages in a join that is
a broadcast only if it was counted to be small.

Defined results: null and empty html have the empty text; a null url is the
empty host; tags and comments that never end reach to the end; repeated rows
each have their result; an empty table gives an empty result; other columns
do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import broadcast_if_small, materialise
from ontime.llm.url_filters import host

# Skeletons or wrappers that one task folds into one wrapper.
MERGE_GROUP = 64
# Different pages that have to agree on a slot's text before it counts as furniture.
CONSTANT_PAGES = 3
MAX_PERIOD = 8

# Elements of HTML by what they mean here.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol optgroup option p pre search section select summary table tbody td tfoot th thead"
    " title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea xmp".split())
DROPPED = frozenset(
    "annotation annotation-xml aside audio button canvas datalist dialog footer form head label math"
    " menu nav object option search select svg title video".split()
)
# Dropped, but text where they stand in main text or content.
TEXT_IN_MAIN = frozenset("label math".split())
DROPPED_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement alert banner bio breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar"
    " navigation newsletter notice overlay pager pagination popup promo promotion recommended"
    " related respond search share sharing sidebar signup skip social sponsor sponsored subscribe"
    " subscription toast toolbar widget".split()
)
CONTENT_NAMES = frozenset("article content entry maincontent post story".split())
# Parts that may stand before or behind those of DROPPED_NAMES in a name.
BEFORE_NAMES = CONTENT_NAMES | frozenset(
    "author bottom global inline main page primary reader readers secondary site top user".split()
)
BEHIND_NAMES = frozenset(
    "area articles bar block box button buttons container inner item items links list outer posts section"
    " slot unit wrap wrapper".split()
)
COMMENT_NAMES = frozenset("comment comments disqus respond".split())
COMMENT_PARTS = (
    COMMENT_NAMES
    | BEHIND_NAMES
    | frozenset("article body content entry post reader readers reply thread user".split())
)
ID_IS_ANCHOR = frozenset("h1 h2 h3 h4 h5 h6 section".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)|[^<]++|<""",
    re.DOTALL,
)
NAMES = re.compile(
    r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE
)
HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE
)
NAME_PARTS = re.compile(r"[a-z]+")


def is_furniture(token: str) -> bool:
    """Whether a whole class, id or role names furniture, as `site-footer` does."""
    parts = NAME_PARTS.findall(token)
    while parts and parts[0] in BEFORE_NAMES:
        del parts[0]
    while len(parts) > 1 and parts[-1] in BEHIND_NAMES:
        del parts[-1]
    return bool(parts) and DROPPED_NAMES.issuperset(parts)


def is_comment(token: str) -> bool:
    parts = NAME_PARTS.findall(token)
    return not COMMENT_NAMES.isdisjoint(parts) and COMMENT_PARTS.issuperset(parts)


def dropped_by(name: str, attributes: str) -> str:
    """What an element is dropped by: its (e)lement, a (n)ame, a (c)omment's name, or nothing."""
    if name in DROPPED:
        return "e"
    if not attributes:
        return ""
    if HIDDEN.search(attributes):
        return "e"
    if name in ("html", "body", "main"):
        return ""
    tokens = [
        token
        for kind, *values in NAMES.findall(attributes)
        if name not in ID_IS_ANCHOR or kind.lower() != "id"
        for token in "".join(values).lower().split()
    ]
    if any(map(is_comment, tokens)):
        return "c"
    return "n" if name != "article" and any(map(is_furniture, tokens)) else ""


def element_zone(name: str, attributes: str, around: str, cause: str) -> str:
    """The zone inside an element: d(ropped), m(ain), c(ontent) or r(est)."""
    if around in ("m", "c") and name in TEXT_IN_MAIN and not (attributes and HIDDEN.search(attributes)):
        return around
    if around == "d" or cause:
        return "d"
    parts: set[str] = set()
    if attributes:
        for _, *values in NAMES.findall(attributes):
            parts.update(NAME_PARTS.findall("".join(values).lower()))
    if around == "m" or name in ("article", "main") or "main" in parts:
        return "m"
    if name == "header":
        return "d"
    if around == "c" or parts & CONTENT_NAMES:
        return "c"
    return "r"


def parsed(html: str) -> tuple[list[str], list[str]]:
    """Symbols of a page, tags and slots in order, and the text of each slot."""
    symbols, texts, spared = read_tags(html, frozenset())
    if spared:
        symbols, texts, _ = read_tags(html, spared)
    return symbols, texts


def read_tags(html: str, spared: frozenset[int]) -> tuple[list[str], list[str], frozenset[int]]:
    """Symbols and texts, and where elements start that a name drops though they hold an article.

    No name drops the elements that start at one of `spared`.
    """
    symbols: list[str] = []
    texts: list[str] = []
    stack: list[tuple[str, str, str, str, int]] = []
    holders: set[int] = set()
    zone = "r"
    parts: list[str] = []
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        parts.clear()
        if text:
            symbols.append(f"#{zone}a" if 2 * linked > len(text) else f"#{zone}")
            texts.append(text)
        linked = 0

    at, end = 0, len(html)
    match = TOKEN.match
    while at < end:
        token = match(html, at)
        start, at = at, token.end()
        name = token[2]
        if name is None:
            text = token[0]
            if text[0] != "<" or len(text) == 1:
                text = unescape(text) if "&" in text else text
                parts.append(text)
                if links:
                    linked += len(text)
            continue
        name = name.lower()
        if token[1]:
            if name == "a":
                links = max(0, links - 1)
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    flush()
                    zone = stack[depth][1]
                    symbols.append(f"</{name}>")
                    del stack[depth:]
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name == "a":
            links += 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW:
            close = re.compile(f"</{name}[^a-zA-Z0-9]|</{name}$", re.IGNORECASE).search(html, at)
            at = html.find(">", close.start()) + 1 or end if close else end
            continue
        inside, cause = zone, ""
        is_block = name in BLOCKS
        if is_block or name in DROPPED or token[3]:
            cause = dropped_by(name, token[3])
            if start in spared:
                cause = ""
            inside = element_zone(name, token[3], zone, cause)
        if is_block or inside != zone:
            flush()
            if name in ("article", "main") and zone == "d" and inside == "d":
                # Neither stands in navigation; what was to end before did not.
                close_menus(stack)
                inside = element_zone(name, token[3], stack[-1][2] if stack else "r", cause)
                named = {entry[4]: entry[3] for entry in stack if entry[3]}
                lifted = ("n",) if name == "article" else ("n", "c")
                if not cause and all(why in lifted for why in named.values()):
                    holders.update(named)
            if name not in VOID and not token[3].endswith("/"):
                stack.append((name, zone, inside, cause, start))
                zone = inside
                symbols.append(f"<{name}>")
    flush()
    return symbols, texts, frozenset(holders)


def close_menus(stack: list[tuple[str, str, str, str, int]]) -> None:
    """An article closes the elements around it that cannot hold one."""
    while stack and stack[-1][2] == "d" and stack[-1][0] in CLOSED_BY_ARTICLE:
        stack.pop()


# Elements that hold no article, and those that stand in them.
CLOSED_BY_ARTICLE = frozenset("nav ul ol li menu head title header".split())


class Item:
    """A symbol or a repeated group of a skeleton, with the slots it holds."""

    __slots__ = ("symbol", "slots")

    def __init__(self, symbol: str, slots: list[list[int]]):
        self.symbol, self.slots = symbol, slots


def folded(symbols: Sequence[str]) -> list[Item]:
    """Runs of equal neighbours become `(...)+`; their slots come together."""
    items, n = [], 0
    for symbol in symbols:
        if symbol[0] == "#":
            items.append(Item(symbol, [[n]]))
            n += 1
        else:
            items.append(Item(symbol, []))
    for period in range(1, MAX_PERIOD + 1):
        at = 0
        names = [item.symbol for item in items]
        result: list[Item] = []
        while at < len(items):
            unit = names[at : at + period]
            stop = at + period
            while len(unit) == period and names[stop : stop + period] == unit:
                stop += period
            if stop == at + period:
                result.append(items[at])
                at += 1
                continue
            single = period == 1 and unit[0].endswith(")+")
            slots = [list(slot) for item in items[at : at + period] for slot in item.slots]
            for first in range(at + period, stop, period):
                more = (slot for item in items[first : first + period] for slot in item.slots)
                for slot, others in zip(slots, more, strict=True):
                    slot += others
            result.append(Item(unit[0] if single else f"({' '.join(unit)})+", slots))
            at = stop
        items = result
    return items


def slot_count(symbol: str) -> int:
    return symbol.count("#")


def merged(wrapper: list[str], other: list[str]) -> list[str]:
    """A wrapper for both: common parts stay, others become optional or repeated."""
    result: list[str] = []
    bare = [w.removesuffix("?") for w in wrapper]
    bare_other = [w.removesuffix("?") for w in other]
    for what, a, b, c, d in SequenceMatcher(None, bare, bare_other, autojunk=False).get_opcodes():
        ours, theirs = wrapper[a:b], other[c:d]
        if what == "equal":
            result += [x if x.endswith("?") else y for x, y in zip(ours, theirs, strict=True)]
        elif repeats(ours, theirs):
            result += ours
        elif repeats(theirs, ours):
            result += theirs
        else:
            result += [w if w.endswith("?") else f"{w}?" for w in (*ours, *theirs)]
    return result


def repeats(group: list[str], once: list[str]) -> bool:
    return len(group) == 1 and bool(once) and group[0].removesuffix("?") == f"({' '.join(once)})+"


def aligned_slots(wrapper: list[str], skeleton: list[str]) -> list[int]:
    """For each slot of a skeleton, the wrapper slot that it falls into, or -1."""
    starts = [0]
    for item in wrapper:
        starts.append(starts[-1] + slot_count(item))
    places: list[int] = []
    bare = [w.removesuffix("?") for w in wrapper]
    for what, a, b, c, d in SequenceMatcher(None, bare, skeleton, autojunk=False).get_opcodes():
        n = sum(map(slot_count, skeleton[c:d]))
        if what == "equal" or repeats(wrapper[a:b], skeleton[c:d]):
            places += range(starts[a], starts[a] + n)
        else:
            places += [-1] * n
    return places


PAGE = (
    "page_id long, url string, host string, skeleton string, skeleton_key long, page long,"
    " blocks array<struct<slot:int,text:string>>"
)


def read_pages(pages: DataFrame) -> DataFrame:
    """Per page: its skeleton, and its texts with the slot that each falls into."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            skeletons, keys, contents, blocks = [], [], [], []
            for html in batch.column(3).to_pylist():
                symbols, texts = parsed(html or "")
                items = folded(symbols)
                slots = [0] * len(texts)
                for number, members in enumerate(m for item in items for m in item.slots):
                    for at in members:
                        slots[at] = number
                skeleton = "\n".join(item.symbol for item in items)
                skeletons.append(skeleton)
                keys.append(xxhash.xxh3_64_intdigest(skeleton) >> 1)
                contents.append(xxhash.xxh3_64_intdigest("\0".join(texts).encode("utf-8", "surrogatepass")) >> 1)
                blocks.append([{"slot": s, "text": t} for s, t in zip(slots, texts, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(skeletons, pa.string()),
                    pa.array(keys, pa.int64()),
                    pa.array(contents, pa.int64()),
                    pa.array(blocks, block),
                ],
                ["page_id", "url", "host", "skeleton", "skeleton_key", "page", "blocks"],
            )

    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), "html")
    return rows.mapInArrow(read, PAGE)


def skeleton_slots(read: DataFrame) -> DataFrame:
    """Per host, skeleton and slot (null if it has none): the least and greatest
    hash of its texts and of the pages that have it, and about how many differ."""
    texts = read.select(
        "host",
        "skeleton_key",
        "skeleton",
        "page",
        F.explode_outer("blocks").alias("block"),
    )
    text = F.xxhash64("block.text")
    return texts.groupBy("host", "skeleton_key", F.col("block.slot").alias("slot")).agg(
        F.first("skeleton").alias("skeleton"),
        F.min(text).alias("least"),
        F.max(text).alias("greatest"),
        F.array(F.min("page"), F.max("page")).alias("ends"),
        F.approx_count_distinct("page", 0.1).alias("pages"),
    )


def wrappers(spark: SparkSession, skeletons: DataFrame) -> DataFrame:
    """(wrapper_host, wrapper): each host's skeletons merged, some at a time, until one is left."""
    level = skeletons.select("host", "skeleton_key", "skeleton")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        ordered = sorted(set(group["skeleton"]), key=lambda s: (len(s), s))
        wrapper = ordered[0].split("\n") if ordered[0] else []
        for other in ordered[1:]:
            wrapper = merged(wrapper, other.split("\n"))
        text = "\n".join(wrapper)
        key = xxhash.xxh3_64_intdigest(text) >> 1
        return pd.DataFrame({"host": group["host"][:1], "skeleton_key": key, "skeleton": text})

    while True:
        level, _ = materialise(spark, level, "wrappers")
        counts = level.groupBy(F.col("host").alias("c_host")).agg(F.count("*").alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        groups = F.ceil(F.col("n") / MERGE_GROUP).cast("int")
        level = (
            level.join(counts, F.col("host") == F.col("c_host"))
            .withColumn("part", F.pmod(F.xxhash64("skeleton_key"), groups).cast("int"))
            .groupBy("host", "part")
            .applyInPandas(merge, "host string, skeleton_key long, skeleton string")
        )
    return level.select(F.col("host").alias("wrapper_host"), F.col("skeleton").alias("wrapper"))


PLACES = "host string, skeleton_key long, slot int, zone string, in_links boolean, place int"


def slot_places(skeletons: DataFrame, wrapper_table: DataFrame) -> DataFrame:
    """Each skeleton's slots with their zone and their place in the host's wrapper."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for h, key, text, wrapper in batch[["host", "skeleton_key", "skeleton", "wrapper"]].itertuples(index=False):
                items = text.split("\n") if text else []
                zones = re.findall(r"#(\w)(a?)", text)
                places = aligned_slots(wrapper.split("\n") if wrapper else [], items)
                rows += [
                    (h, key, n, zone, bool(link), at)
                    for n, ((zone, link), at) in enumerate(zip(zones, places, strict=True))
                ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PLACES.split(", ")])

    joined = skeletons.join(wrapper_table, F.col("host") == F.col("wrapper_host"))
    return joined.mapInPandas(place, PLACES)


def kept_slots(places: DataFrame, slots: DataFrame) -> DataFrame:
    """(k_host, k_key, kept): the slots of each skeleton that hold main text."""
    joined = places.join(slots, ["host", "skeleton_key", "slot"])
    # Pages of equal texts can have different skeletons, so pages are not added
    # up: with fewer than three in each skeleton, the ends are all that there are.
    shared = (
        joined.where("place >= 0")
        .select("host", "place", "least", "greatest", "pages", F.explode("ends").alias("end"))
        .groupBy(F.col("host").alias("s_host"), F.col("place").alias("s_place"))
        .agg(
            (F.min("least") == F.max("greatest")).alias("same"),
            F.greatest(F.max("pages"), F.approx_count_distinct("end", 0.1)).alias("seen"),
        )
    )
    judged = joined.join(
        shared, (F.col("host") == F.col("s_host")) & (F.col("place") == F.col("s_place")), "left"
    )
    known = F.col("seen") >= CONSTANT_PAGES
    constant = F.coalesce(F.col("same") & known, F.lit(False))
    varied = F.coalesce(~F.col("same") & known, F.lit(False))
    unlinked = (F.col("zone") == "r") & ~F.col("in_links")
    # Before the main text, what differs from page to page belongs to it.
    lead = F.filter("varied", lambda slot: slot < F.array_min("main"))
    return (
        judged.groupBy(F.col("host").alias("k_host"), F.col("skeleton_key").alias("k_key"))
        .agg(
            F.collect_list(F.when(F.col("zone") == "m", F.col("slot"))).alias("main"),
            F.collect_list(F.when(unlinked & varied, F.col("slot"))).alias("varied"),
            F.collect_list(F.when(F.col("zone") == "c", F.col("slot"))).alias("content"),
            F.collect_list(F.when(unlinked & ~constant, F.col("slot"))).alias("rest"),
            F.collect_list(F.when(unlinked, F.col("slot"))).alias("unlinked"),
        )
        .select(
            "k_host",
            "k_key",
            F.when(F.size("main") > 0, F.concat(lead, "main"))
            .when(F.size("content") > 0, F.col("content"))
            .when(F.size("rest") > 0, F.col("rest"))
            .otherwise(F.col("unlinked"))
            .alias("kept"),
        )
    )


def main_texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, the main text, its length in code points."""
    # Parsing is the dearest part: its result is written, and read twice.
    read, _ = materialise(spark, read_pages(pages), "read-pages")
    slots, _ = materialise(spark, skeleton_slots(read), "slots")
    skeletons = slots.groupBy("host", "skeleton_key").agg(F.first("skeleton").alias("skeleton"))
    slots = slots.drop("skeleton")
    places = slot_places(skeletons, wrappers(spark, skeletons))
    kept, _ = materialise(spark, kept_slots(places, slots), "kept-slots")
    chosen = F.filter("blocks", lambda block: F.array_contains("kept", block["slot"]))
    text = F.coalesce(F.array_join(F.transform(chosen, lambda block: block["text"]), "\n\n"), F.lit(""))
    return (
        read.drop("skeleton")
        .join(
            broadcast_if_small(kept, kept.agg(F.coalesce(F.sum(F.size("kept") + 1), F.lit(0))).first()[0]),
            (F.col("host") == F.col("k_host")) & (F.col("skeleton_key") == F.col("k_key")),
            "left",
        )
        .select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.char_length("text").cast("long"))
    )
