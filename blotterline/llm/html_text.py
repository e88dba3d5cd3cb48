"""Main text of web pages: nearest-URL page differencing.

Pages of a host are made from templates, and pages with neighbouring URLs from the same one. Each
page is cut into lines (block by block, in page order) and compared with the nearest pages of its
host in URL order: lines of their longest common subsequences are the template's and go. Pages that
share most of their text are copies of an article rather than of a template; they are passed over
for the next page. What the markup itself names as boilerplate (menus, footers, forms, adverts,
comments) goes as well, and what it names as the article stays even if another page has it.

Equal pages of a host are one page here, and all get its text. Ranges of URLs are drawn from a
sample of the keys alone, so a page is cut into lines once and shuffled once, packed, to the range
it lies in, a host with a third of all pages over many ranges. A task compares pages as they come;
only the first and last pages of a range wait for those of the ranges beside it, a fixed number per
range.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.llm.common import bound_batches, map_frames, materialize, parallelism, stored_texts

# Names of HTML elements and attribute words.
HIDDEN = frozenset({"script", "style", "head", "title", "template", "noscript", "svg", "iframe", "object", "select", "textarea"})
RAW = frozenset({"script", "style", "textarea", "title", "iframe", "noscript"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})
BOILERPLATE = frozenset({"nav", "footer", "aside", "form", "button", "dialog", "menu"})
ARTICLE = frozenset({"article", "main"})
INLINE = frozenset(
    {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
     "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
     "time", "tt", "u", "var", "wbr", "img"}
)
BOILERPLATE_WORDS = frozenset(
    {"ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
     "cookies", "footer", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo",
     "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
)
BOILERPLATE_ROLES = frozenset({"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "form"})

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

BOILER, PLAIN, MAIN = 0, 1, 2


def _named_boilerplate(name: str, tag: str, inside_article: bool) -> bool:
    """Whether an element is a menu, footer, advert or the like by its name or attributes."""
    if name in BOILERPLATE or (name == "header" and not inside_article):
        return True
    for key, value in ATTRIBUTE.findall(tag):
        words = WORD.findall(value.lower())
        known = BOILERPLATE_ROLES if key.lower() == "role" else BOILERPLATE_WORDS
        if known.intersection(words) and name not in ("html", "body", *ARTICLE):
            return True
    return False


def page_lines(html: str) -> list[tuple[int, str]]:
    """The lines of a page in order: what kind of place each is in, and its text.

    A block is a line: text between two tags that are not inline ones, with character references
    decoded and white space as one blank. Broken markup is read as far as it goes: an element that
    is never closed ends with the one around it, a tag cut off by the end of the page is dropped.
    """
    lines: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the kind of place around each
    opened: Counter[str] = Counter()
    hidden, at, kind, size = 0, 0, PLAIN, len(html)

    def flush() -> None:
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                lines.append((kind, text))

    while at < size:
        match = TOKEN.search(html, at)
        stop = match.start() if match else size
        if stop > at and not hidden:
            rest = html[at:stop]
            cut = -1 if match else rest.rfind("<")
            # The page ends inside a tag.
            parts.append(rest[:cut] if cut >= 0 and re.match(r"</?[a-zA-Z!]|<$|</$", rest[cut:]) else rest)
        if not match:
            break
        at, tag = match.end(), match[0]
        named = NAME.match(tag)
        if not named:
            continue
        name = named[1].lower()
        if name not in INLINE:
            flush()
        if tag.startswith("</"):
            if opened[name]:
                flush()
                while True:
                    closed, kind = stack.pop()
                    opened[closed] -= 1
                    hidden -= closed in HIDDEN
                    if closed == name:
                        break
            continue
        if name in VOID or tag.endswith("/>"):
            continue
        if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name:
            opened[name] -= 1
            kind = stack.pop()[1]  # these close themselves
        if name in INLINE:
            # Broken pages leave them open; only those that hold boilerplate matter.
            if not _named_boilerplate(name, tag, kind == MAIN):
                continue
            flush()
        stack.append((name, kind))
        opened[name] += 1
        hidden += name in HIDDEN
        if kind != BOILER:
            if _named_boilerplate(name, tag, kind == MAIN):
                kind = BOILER
            elif name in ARTICLE:
                kind = MAIN
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(html, at)
            at = end.start() if end else size
    flush()
    return lines


def packed(lines: list[tuple[int, str]]) -> bytes:
    return zlib.compress(json.dumps(lines, ensure_ascii=False).encode("utf-8", "surrogatepass"))


def unpacked(body: bytes) -> list[tuple[int, str]]:
    return [(kind, text) for kind, text in json.loads(zlib.decompress(body).decode("utf-8", "surrogatepass"))]


def _places(b: list[str]) -> dict[str, int]:
    places: dict[str, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | (1 << j)
    return places


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    places, everything = _places(b), (1 << len(b)) - 1
    row = everything
    for x in a:
        matches = row & places.get(x, 0)
        row = ((row + matches) | (row - matches)) & everything
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[: len(b)].astype(np.int64))])


def _subsequence(a: list[tuple[int, str]], b: list[str]) -> Iterator[int]:
    """Places (the first of each pair of ``a``) of a longest common subsequence.

    The bit-parallel form of the usual table: one row per line of ``a``, held as one integer. A table
    of more than ``MOST_BITS`` is cut at the middle line, where the lengths from both ends say how
    ``b`` is divided, so memory does not grow with the product of the lengths.
    """
    if not a or not b:
        return
    if len(a) * len(b) > MOST_BITS and len(a) > 1:
        half = len(a) // 2
        ahead = _lengths([x for _, x in a[:half]], b)
        back = _lengths([x for _, x in a[half:]][::-1], b[::-1])[::-1]
        cut = int(np.argmax(ahead + back))
        yield from _subsequence(a[:half], b[:cut])
        yield from _subsequence(a[half:], b[cut:])
        return
    places, everything = _places(b), (1 << len(b)) - 1
    rows, row = [], everything
    for _, x in a:
        matches = row & places.get(x, 0)
        row = ((row + matches) | (row - matches)) & everything
        rows.append(row)
    # A zero bit in a row is a step of the subsequence's length; walk back along the steps.
    j = len(b) - 1
    for at in range(len(a) - 1, -1, -1):
        before = rows[at - 1] if at else everything
        while j >= 0 and rows[at] >> j & 1:
            j -= 1
        if j < 0:
            break
        if before >> j & 1:
            yield a[at][0]
            j -= 1


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of two pages' lines.

    Equal beginnings and ends are matched first, and lines that only one page has are left out;
    neither changes the length.
    """
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    shared = set(range(first)) | set(range(len(a) - last, len(a)))
    inner = [(i, a[i]) for i in range(first, len(a) - last)]
    in_a = {x for _, x in inner}
    other = [x for x in b[first : len(b) - last] if x in in_a]
    in_b = set(other)
    shared.update(_subsequence([(i, x) for i, x in inner if x in in_b], other))
    return shared


#: Bits of a table of common lines that are held at once.
MOST_BITS = 1 << 28
#: Pages on each side that may be compared, and how many of them decide about a line by majority.
NEAREST, VOTERS = 3, 3
#: A page that has more than this part of another one's text is a copy of its article.
COPIED = 0.8
#: Copied pages (a key each) and bytes of their texts that are sent to all tasks; beyond that, Spark
#: joins by shuffling.
MOST_BROADCAST, MOST_BYTES = 200_000, 32_000_000


def main_text(lines: list[tuple[int, str]], nearest: list[list[tuple[int, str]]]) -> str:
    """The lines that are the article's, joined by blanks; ``nearest`` are other pages, nearest first.

    A line goes that the voters share by majority: the nearest pages that have lines and are no copies
    of the article. Lines of a named article stay; boilerplate that the markup names goes
    whether it is shared or not.
    """
    texts = [text for _, text in lines]
    body = {i for i, (kind, _) in enumerate(lines) if kind != BOILER}
    article = {i for i, (kind, _) in enumerate(lines) if kind == MAIN}
    size, votes, voters = sum(len(texts[i]) for i in body), Counter(), 0
    for other in nearest:
        if voters == VOTERS:
            break
        if not other:
            continue
        shared = common_lines(texts, [text for _, text in other])
        if sum(len(texts[i]) for i in body & shared) > COPIED * size:
            continue
        votes.update(shared)
        voters += 1
    template = {i for i, n in votes.items() if n >= min(voters, 2)}
    return " ".join(texts[i] for i in sorted((body - template) | article))


def _nearest(at: int, pages: list) -> list:
    """Other pages of a run in order, by their distance."""
    found = []
    for step in range(1, NEAREST + 1):
        found += [pages[i] for i in (at - step, at + step) if 0 <= i < len(pages)]
    return found


def _range_of(keys: DataFrame, names: list[str], count: int) -> Column:
    """The number of the range (of ``count`` of even size) that a row's key lies in; the bounds come from
    at most 200 sampled keys per range."""
    wanted, total = 100 * count, keys.count()
    sample = keys.select(*names)
    if total > wanted:
        sample = sample.where(F.rand(7) < wanted / total)
    found = sorted(tuple(row) for row in sample.limit(2 * wanted).collect())
    bounds = [found[len(found) * i // count] for i in range(1, count)] if found else []
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(bound, names, strict=True)]) for bound in bounds])
    return F.size(F.filter(table, lambda bound: bound <= F.struct(*names)))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and ``text`` of every page.

    Null html is an empty page, whose text is empty. A null URL is a host of its own. Equal pages of a
    host have equal texts, whatever their URLs: they are compared once, at the first URL of them.
    Pages with one URL that differ are neighbours of each other. Repeated rows and null page_ids
    stay; an empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    kind = pages.schema[page_id].dataType.simpleString()
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    source = F.coalesce(F.col(html).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(source.cast("binary")))
    chosen = pages.select(
        F.regexp_extract(address, r"^(?:\w+:)?(?://)?([^/?#]*)", 1).alias("host"),
        F.regexp_replace(address, r"^(?:\w+:)?(?://)?[^/?#]*", "").alias("path"),
        F.xxhash64(page_id, digest).alias("tie"),
        digest.alias("digest"),
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        source.alias("html"),
    )
    key = ["host", "digest"]
    place = ["host", "path", "tie"]
    keys = stored_texts(chosen.select(*place, "digest"), "page-keys")
    copied = materialize(keys.groupBy(*key).count().where("count > 1").select(*key), "copied-pages")
    few = copied.count() <= MOST_BROADCAST
    marks = F.broadcast(copied) if few else copied
    # Copies meet in their task first: of each group, a row per task is shuffled.
    groups = (
        chosen.join(marks, key, "left_semi")
        .groupBy(*key)
        .agg(F.min("path").alias("path"), F.first("html").alias("html"))
        .select("host", "path", F.xxhash64("digest").alias("tie"), "digest", F.lit(None).cast(kind).alias("page_id"), F.lit(None).cast("string").alias("url"), "html")
    )
    single = chosen.join(marks, key, "left_anti").withColumn("digest", F.lit(None).cast("binary"))
    ranges = 3 * parallelism(spark)
    part = _range_of(keys, place, ranges).cast("int")
    texts = _differenced(single.unionByName(groups).withColumn("part", part), ranges, kind)
    shared = texts.where(F.col("digest").isNotNull()).select(*key, "text")
    size = shared.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    together = chosen.drop("html").join(marks, key, "left_semi")
    copies = together.join(F.broadcast(shared) if size <= MOST_BYTES else shared, key)
    alone = texts.where(F.col("digest").isNull())
    return alone.select("page_id", "url", "text").unionByName(copies.select("page_id", "url", "text"))


def _differenced(pages: DataFrame, ranges: int, kind: str) -> DataFrame:
    """host, digest, page_id, url, text of different pages (with ``part``, the range each lies in)."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(packed=[packed(page_lines(source)) for source in frame.pop("html")])

    schema = f"part int, host string, path string, tie long, digest binary, page_id {kind}, url string, packed binary"
    cut_pages = map_frames(pages.select("part", "host", "path", "tie", "digest", "page_id", "url", "html"), cut, schema)
    ordered = cut_pages.repartition(ranges, "part").sortWithinPartitions("part", "host", "path", "tie")

    columns = ["part", "place", "open", "host", "digest", "page_id", "url", "text", "packed"]
    wide = 2 * NEAREST

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Finished texts; and the first and last pages of each range (``part`` is set), for the ranges
        beside it. Held are the last few pages: a page is compared when those after it are there."""
        part, count, held, rows = None, 0, [], []  # held: place, host, digest, page_id, url, lines, packed

        def edge(page: tuple, is_open: bool) -> None:
            place, host, digest, own_id, own_url, _, body = page
            rows.append((part, place, is_open, host, digest, own_id, own_url, None, body))

        def finish() -> None:
            for page in held:
                if page[0] > count - 1 - NEAREST:
                    if page[0] >= NEAREST:
                        edge(page, True)
                elif page[0] > count - 1 - wide and page[0] >= wide:
                    edge(page, False)

        for frame in frames:
            for own_part, host, digest, own_id, own_url, body in frame.itertuples(index=False):
                if own_part != part:
                    if part is not None:
                        finish()
                    part, count, held = own_part, 0, []
                held = [*held[-2 * wide :], (count, host, digest, own_id, own_url, unpacked(body), body)]
                count += 1
                if count <= NEAREST:
                    edge(held[-1], True)
                elif count > 2 * NEAREST:
                    at = len(held) - 1 - NEAREST
                    page = held[at]
                    near = [other[5] for other in _nearest(at, held) if other[1] == page[1]]
                    rows.append((None, None, None, *page[1:5], main_text(page[5], near), None))
                    if page[0] < wide:
                        edge(page, False)
            yield pd.DataFrame(rows, columns=columns)
            rows.clear()
        if part is not None:
            finish()
            yield pd.DataFrame(rows, columns=columns)

    schema = (
        f"part int, place int, open boolean, host string, digest binary, page_id {kind}, url string, "
        "text string, packed binary"
    )
    source = ordered.select("part", "host", "digest", "page_id", "url", "packed")
    stored = stored_texts(map_frames(source, run, schema), "pages")
    # A few pages per range; only their places go through the window.
    edges = stored.where(F.col("part").isNotNull())
    order = F.row_number().over(Window.orderBy("part", "place"))
    edges = edges.join(edges.select("part", "place", order.alias("at")), ["part", "place"])
    steps = [d for d in range(-NEAREST, NEAREST + 1) if d]
    beside = edges.select("host", "at", "packed", F.explode(F.array(*map(F.lit, steps))).alias("step")).select(
        "host",
        (F.col("at") + F.col("step")).alias("at"),
        # The page before comes first of two at one distance.
        F.struct((2 * F.abs("step") + (F.col("step") < 0).cast("int")).alias("distance"), "packed").alias("other"),
    )
    waiting = edges.where("open").select("host", "at", "digest", "page_id", "url", "packed")
    near = waiting.select("host", "at").join(beside, ["host", "at"]).groupBy("at").agg(F.sort_array(F.collect_list("other")).alias("others"))
    waiting = waiting.join(near, "at", "left").select(
        "host", "digest", "page_id", "url", "packed", F.coalesce(F.col("others.packed"), F.array().cast("array<binary>")).alias("others")
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bodies, others = frame.pop("packed"), frame.pop("others")
            texts = [main_text(unpacked(own), [unpacked(x) for x in near]) for own, near in zip(bodies, others, strict=True)]
            yield frame.assign(text=texts)

    names = f"host string, digest binary, page_id {kind}, url string, text string"
    finished = stored_texts(map_frames(waiting, compare, names), "edge-texts")
    done = stored.where(F.col("part").isNull()).select("host", "digest", "page_id", "url", "text")
    return done.unionByName(finished)
