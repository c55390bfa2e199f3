"""Main text of HTML pages: markup regions, and differencing against the page with the nearest URL."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import byte_slices
from wardflow.llm.url_rules import host_of, path_of
from wardflow.session import settle

#: Elements: fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr object math mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt"
    " mroot munder mover munderover mtable mtr mtd mstyle mpadded mphantom merror menclose semantics".split()
)
#: Elements whose content is no text of the page; a line goes on behind them.
RAW = frozenset("script style textarea title noscript template iframe svg annotation annotation-xml".split())
#: Elements that never hold main text.
CHROME = RAW | frozenset("head nav header footer aside form button select menu dialog figcaption".split())
#: Elements that mark main text.
MAIN = frozenset("article main".split())
#: Elements that hold running text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt".split())
#: Words of class, id and role that name something other than main text.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent"
    " cookie cookies discussion disqus footer header login masthead menu modal nav navbar navigation newsletter notice"
    " notices pagination popup promo promoted related replies respond search share sharing sidebar signup skip social"
    " sponsor sponsored subscribe toolbar widget complementary contentinfo alert".split()
)
_NAME = re.compile(r"[^\s/>]+")
#: From behind a tag's name to its end; quotes count where a value begins. Possessive, so that nothing is read twice.
_REST = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>")
#: Words that stand before or after one of these as one name: fixed values.
_BEFORE = "site page main top bottom left right global primary secondary mobile footer header side blog post".split()
_AFTER = (
    "area banner bar block box buttons container content form holder icons item items left link links list main"
    " message notice overlay panel popup posts right section slot top unit widget widgets wrap wrapper articles"
    " body consent footer header menu nav text media"
).split()
#: Compounds that mean something other than main text, as the words and what is made of them alone do. The header of a
#: page or post may hold its title.
CHROME_COMPOUNDS = {
    name for word in CHROME_WORDS for name in (*[f"{x}-{word}" for x in _BEFORE], *[f"{word}-{x}" for x in _AFTER])
} - {"page-header", "post-header"}
#: Names of an article that is a comment on another.
COMMENT_NAMES = frozenset(("comment", "comment-body", "comment-content", "comment-item"))
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SEPARATORS = re.compile(r"[-_\d]+")
#: What an element is: shown, left out, or left out unless it holds a main element.
SHOWN, HIDDEN, NAMED = range(3)

#: Lines above which two pages are aligned in parts, split at a line that occurs once in each.
MAX_LCS_CELLS = 4_000_000


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a tag by lower-cased name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value.strip("\"'") if value[:1] in ("'", '"') else value)
    return found


def _names(attributes: dict[str, str]) -> set[str]:
    """Whole names in class, id and role, with one hyphen for each run of hyphens, underscores and digits."""
    words = " ".join(attributes.get(key, "") for key in ("class", "id", "role")).lower().split()
    return {_SEPARATORS.sub("-", word).strip("-") for word in words}


def _kind(name: str, text: str, inside_main: bool) -> int:
    """What an element is by its name and attributes. A header inside main text belongs to it."""
    if name in CHROME and not (inside_main and name in ("header", "figcaption")):
        return HIDDEN
    if not text or text.isspace() or name in ("html", "body", "main"):
        return SHOWN
    attributes = attributes_of(text)
    if name == "article":
        return SHOWN if _names(attributes).isdisjoint(COMMENT_NAMES) else HIDDEN
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return HIDDEN
    for found in _names(attributes):
        if (found in CHROME_COMPOUNDS or CHROME_WORDS.issuperset(found.split("-"))) and not (
            inside_main and found.endswith("header")
        ):
            return NAMED
    return SHOWN


class Markup:
    """Reads a page from its start to its end in linear time, however broken its markup is.

    What is not there, such as another `>`, is looked for once and remembered.
    """

    def __init__(self, page: str) -> None:
        self.page, self.size = page, len(page)
        self.gone: set[str] = set()
        self.broken = False

    def find(self, what: str, at: int) -> int:
        """Where `what` stands next; -1 if it stands nowhere behind `at`."""
        if what in self.gone:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def behind(self, what: str, at: int) -> int:
        """The place behind the next `what`, or the end of the page."""
        found = self.find(what, at)
        return self.size if found < 0 else found + len(what)

    def tags(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(start, end, lower-case name, whether it closes, attributes) of each tag; comments have no name.

        A `<` that begins no tag, or has no `>` behind it, is text. `skip` moves on, past an element of raw text.
        """
        page, self.at = self.page, 0
        while (start := self.find("<", self.at)) >= 0:
            if page.startswith("<!--", start):
                end = self.behind("-->", start + 4)
            elif page.startswith("<![CDATA[", start):
                end = self.behind("]]>", start + 9)
            elif page.startswith(("<!", "<?"), start):
                end = self.behind(">", start + 2)
            else:
                closes = page.startswith("</", start)
                first = start + 1 + closes
                if not page[first : first + 1].isascii() or not page[first : first + 1].isalpha() or self.find(">", first) < 0:
                    self.at = start + 1
                    continue
                name = _NAME.match(page, first)
                rest = None if self.broken else _REST.match(page, name.end())
                if rest is None:
                    # A quote that is never closed hides all that follows: from here on quotes do not count.
                    self.broken = True
                end = self.find(">", name.end()) + 1 if rest is None else rest.end()
                self.at = end
                yield start, end, name[0].lower(), closes, page[name.end() : end - 1]
                continue
            self.at = end
            yield start, end, "", False, ""

    def skip(self, name: str) -> None:
        """Moves behind the end tag of an element of raw text, or to the end of the page."""
        close = re.compile(rf"</{name}(?![\w-])", re.IGNORECASE).search(self.page, self.at)
        self.at = self.behind(">", close.end()) if close else self.size


class LineBuilder:
    """Text lines of a page while its tags go by."""

    def __init__(self) -> None:
        # Text in order; where a line ends, a pair (in a main element, in an element of running text).
        self.parts: list[str | tuple[bool, bool]] = []
        # Open elements: name, whether it began a left-out region, where a region begins that goes if nothing main is in it.
        self.stack: list[list] = []
        self.named: list[list] = []
        # How often each name is open, and the places of open elements that are not inline.
        self.open: dict[str, int] = {}
        self.blocks: list[int] = []
        self.chrome = self.main = self.prose = 0

    def text(self, text: str) -> None:
        if text and not self.chrome:
            self.parts.append(text)

    def close_line(self) -> None:
        if self.parts and isinstance(self.parts[-1], str):
            self.parts.append((self.main > 0, self.prose > 0))

    def leave(self, to: int) -> None:
        """Ends the open elements from place `to` on."""
        while len(self.stack) > to:
            name, hides, start = self.stack.pop()
            self.open[name] -= 1
            if self.blocks and self.blocks[-1] == len(self.stack):
                self.blocks.pop()
            self.chrome -= hides
            self.main -= name in MAIN
            self.prose -= name in PROSE
            if start is not None:
                self.named.pop()
                # Lines that end within the region end where it stands.
                ends = next((x for x in self.parts[start:] if not isinstance(x, str)), None)
                del self.parts[start:]
                if ends and self.parts and isinstance(self.parts[-1], str):
                    self.parts.append(ends)

    def end(self, name: str) -> None:
        """An end tag; one that closes nothing only ends a line."""
        if name not in INLINE and name not in RAW:
            self.close_line()
        if self.open.get(name):
            k = len(self.stack) - 1
            while self.stack[k][0] != name:
                k -= 1
            self.leave(k)

    def begin(self, name: str, attributes: str, empty: bool) -> None:
        """A start tag."""
        if name not in INLINE:
            self.close_line()
            if name in PROSE and self.blocks:
                # A new paragraph, item or heading ends an unclosed one; nothing inline stays open across.
                last = self.stack[self.blocks[-1]][0]
                if last in PROSE and last not in ("blockquote", "td", "th", "li"):
                    self.leave(self.blocks[-1])
        if empty:
            return
        kind = SHOWN if self.chrome else _kind(name, attributes, self.main > 0)
        # Articles within an article are comments on it, so there a name decides alone.
        hides = kind == HIDDEN or (kind == NAMED and self.open.get("article", 0) > 0)
        element = [name, hides, len(self.parts) if kind == NAMED and not hides else None]
        if name in MAIN and not self.chrome and not hides:
            for region in self.named:
                region[2] = None
            self.named.clear()
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)
        self.open[name] = self.open.get(name, 0) + 1
        if element[2] is not None:
            self.named.append(element)
        self.chrome += hides
        self.main += name in MAIN
        self.prose += name in PROSE

    def lines(self) -> list[tuple[str, bool, bool]]:
        """The lines, when all tags have gone by."""
        self.close_line()
        self.leave(0)
        found: list[tuple[str, bool, bool]] = []
        start = 0
        for k, end in enumerate(self.parts):
            if not isinstance(end, str):
                text = " ".join(html.unescape("".join(self.parts[start:k])).split())
                if text:
                    found.append((text, *end))
                start = k + 1
        return found


def lines_of(page: str | None) -> list[tuple[str, bool, bool]]:
    """Text lines of a page: (text, in a main element, in an element of running text).

    A line is the text between two block borders, with character references decoded and white space
    turned into one blank. Regions that markup names as something other than main text are left out, but
    none only for a class, id or role if it holds a main element or an article; unclosed elements end with
    the element around them. Formulas and other inline content stay in their line, without markup.
    """
    markup, made = Markup(page or ""), LineBuilder()
    at = 0
    for start, end, name, closes, rest in markup.tags():
        made.text(markup.page[at:start])
        at = end
        if not name:
            continue
        if closes:
            made.end(name)
        elif name == "br":
            made.text(" ")
        elif name in RAW:
            if not rest.endswith("/") or name not in ("svg", "annotation", "annotation-xml"):
                markup.skip(name)
                at = markup.at
        else:
            made.begin(name, rest, name in VOID or rest.endswith("/"))
    made.text(markup.page[at:])
    return made.lines()


def common_places(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence of `a` and `b`.

    Equal ends are taken off first. Very long pairs are cut where a line that is unique in both stands,
    in longest increasing order, so that memory stays bounded.
    """
    low, high_a, high_b = 0, len(a), len(b)
    while low < min(high_a, high_b) and a[low] == b[low]:
        low += 1
    found = list(range(low))
    tail = []
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
        tail.append(high_a)
    inner_a, inner_b = a[low:high_a], b[low:high_b]
    shared = set(inner_a) & set(inner_b)
    # Lines that only one side holds are part of no common subsequence.
    keep_a = [i for i, x in enumerate(inner_a) if x in shared]
    keep_b = [x for x in inner_b if x in shared]
    found += [low + i for i in _lcs(keep_a, [inner_a[i] for i in keep_a], keep_b)]
    return found + tail[::-1]


def _lcs(places: list[int], a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return places if a[0] in b else []
    if len(a) * len(b) > MAX_LCS_CELLS:
        middle = len(a) // 2
        # Hirschberg: the best cut of b for the two halves of a, in memory of one row each.
        left = _lengths(a[:middle], b)
        right = _lengths(a[middle:][::-1], b[::-1])[::-1]
        cut = int(np.argmax(left + right))
        return _lcs(places[:middle], a[:middle], b[:cut]) + _lcs(places[middle:], a[middle:], b[cut:])
    other = np.array(b)
    rows = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for i, x in enumerate(a):
        rows[i + 1, 1:] = np.maximum.accumulate(np.maximum(rows[i, 1:], rows[i, :-1] + (other == x)))
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1] and rows[i, j] == rows[i - 1, j - 1] + 1:
            out.append(places[i - 1])
            i, j = i - 1, j - 1
        elif rows[i - 1, j] >= rows[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of `a` and each beginning of `b`."""
    other, row = np.array(b), np.zeros(len(b) + 1, dtype=np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (other == x)))
    return row


def main_lines(lines: list[tuple[int, bool, bool]], other: list[int] | None) -> list[bool]:
    """Which lines are main text, given the lines of the page with the nearest URL.

    `lines` are (hash, in main, in prose). Lines that the other page shares, in the same order, are template
    and go. Two things protect a shared line: that the page marks it as main text, since two pages may carry
    the same article; and that the page is a copy, which shares most of its running text, of which then
    nothing goes. A page without elements of running text has all its lines for it.
    """
    shared = set(common_places([x for x, _, _ in lines], other)) if other else set()
    kept = {k for k, (_, main, _) in enumerate(lines) if main}
    if not kept:
        running = [k for k, (_, _, prose) in enumerate(lines) if prose] or range(len(lines))
        if 2 * sum(k in shared for k in running) > len(running):
            kept = set(running)
    return [k not in shared or k in kept for k in range(len(lines))]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "html"):
        rows = [[(xxhash.xxh64_intdigest(t) >> 1, m, p) for t, m, p in lines_of(h.as_py())] for h in batch.column("html")]
        hashes = [[x for x, _, _ in r] for r in rows]
        kinds = [[2 * m + p for _, m, p in r] for r in rows]
        keys = [batch.column(c) for c in ("key", "host", "path")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(hashes, pa.list_(pa.int64())), pa.array(kinds, pa.list_(pa.int8()))],
            ["key", "host", "path", "hashes", "kinds"],
        )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for hashes, kinds, other in zip(*[batch.column(c) for c in ("hashes", "kinds", "other")], strict=True):
            lines = [(x, bool(k & 2), bool(k & 1)) for x, k in zip(hashes.as_py(), kinds.as_py(), strict=True)]
            out.append(main_lines(lines, other.as_py()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.list_(pa.bool_()))], ["key", "keep"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "html"):
        lines = [[t for t, _, _ in lines_of(page.as_py())] for page in batch.column("html")]
        columns = [batch.column(c) for c in ("page_id", "url", "key")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.list_(pa.string()))], ["page_id", "url", "key", "lines"])


def neighbours(pages: DataFrame) -> DataFrame:
    """key and other: for each of the settled distinct `pages` (key, host, path) the key of the nearest URL.

    Nearest is the next page of the host in the order of paths, or the one before for the last. Pages
    are dealt out by ranges of (host, path), so a large host spreads over many tasks; only the two end
    pages of each range are compared across ranges.
    """
    order = ["host", "path", "key"]
    # Written out, because the ranges must stay the same below.
    dealt = settle(pages.select(*order).repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*order)
    page = F.struct("host", "key")
    seen = dealt.select("range", *order, F.lead(page).over(inside).alias("next"), F.lag(page).over(inside).alias("last"))
    # One row per range.
    ends = dealt.groupBy("range").agg(F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"))
    across = Window.orderBy("range")
    near = ends.select(
        "range",
        F.struct(F.lead("low.host").over(across).alias("host"), F.lead("low.key").over(across).alias("key")).alias("after"),
        F.struct(F.lag("high.host").over(across).alias("host"), F.lag("high.key").over(across).alias("key")).alias("before"),
    )
    both = seen.join(near, "range").withColumns({"next": F.coalesce("next", "after"), "last": F.coalesce("last", "before")})
    return both.select(
        "key",
        F.when(F.col("next.host") == F.col("host"), F.col("next.key"))
        .when(F.col("last.host") == F.col("host"), F.col("last.key"))
        .alias("other"),
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages` (page_id, url, html), whole pages read.

    Lines of a page are aligned with those of the page whose URL path is nearest on the same host, by
    longest common subsequence; only line hashes travel. NULL or empty html gives an empty text. A page
    without a host, a NULL url among them, has the empty host. Rows that repeat url and html are one page
    when neighbours are sought and stay in the result. An empty table gives an empty result; further
    columns are ignored.
    """
    content = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("url", "html")]
    key = F.unhex(F.md5(F.concat(content[0], F.lit("\0"), content[1]).cast("binary")))
    named = pages.select("page_id", "url", "html", key.alias("key"))
    keyed = named.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    schema = "key binary, host string, path string, hashes array<bigint>, kinds array<tinyint>"
    parsed = settle(keyed.mapInArrow(_parsed, schema))
    distinct = parsed.groupBy("key").agg(*[F.first(c).alias(c) for c in ("host", "path", "hashes", "kinds")])
    distinct = settle(distinct)
    near = settle(neighbours(distinct))
    others = distinct.select(F.col("key").alias("other_key"), F.col("hashes").alias("other_hashes"))
    pairs = (
        distinct.select("key", "hashes", "kinds")
        .join(near, "key")
        .join(others, F.col("other") == F.col("other_key"), "left")
        .select("key", "hashes", "kinds", F.col("other_hashes").alias("other"))
    )
    kept = settle(pairs.mapInArrow(_compared, "key binary, keep array<boolean>"))
    kind = pages.schema["page_id"].dataType.simpleString()
    lines = named.mapInArrow(_texts, f"page_id {kind}, url string, key binary, lines array<string>")
    # Lines outside the named regions are all that travels with a page; one way at every size.
    text = F.array_join(F.filter("lines", lambda t, k: F.get("keep", k)), "\n\n")
    joined = lines.join(kept.hint("merge"), "key", "left")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
