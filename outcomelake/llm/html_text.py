"""Operator 5: main text of web pages by differencing pages of near-by URLs.

Pages are put in order of host and path.  Each is compared, line by line, with its
neighbours in that order, and lines of the longest common subsequences are template
text, inside articles as outside.  Markup names the part that is differenced (article,
else main, else what is in neither) and text that is never the page's own, such as
navigation, adverts and forms.  It also sets how much evidence a deletion needs: outside
article and main one neighbour, inside them all of the ``VOTERS`` nearest, as prose of one
article may well be repeated in the next.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelake.llm.common import append_columns, discard, numbered, stored

#: Pages of a block that is compared in one task; blocks overlap by ``VOTERS`` pages on either side.
BLOCK = 256
#: Pages that must all hold a line of an article or of main for it to be template text.
VOTERS = 8
#: Lines of so many words are prose: pages that share most of theirs are copies, not templates.
PROSE_WORDS = 25
#: Share of the words of two pages' own lines from which on the pages are copies and not compared.
COPY = 0.8

ARTICLE, MAIN, LOOSE, TEMPLATE = range(4)

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.S)

# Elements of HTML by how they take part in the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br input".split())
NEVER = frozenset("nav footer aside form button dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar note".split())
#: Names of classes and ids of template parts, alone or before a hyphen, and the ends of longer names.
NAMES = re.compile(
    r"(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay"
    r"|newsletter|subscribe|signup|nav|navbar|navigation|menu|breadcrumbs?|sidebar|footer|comments?|replies|reply|respond|disqus|share|sharing|social"
    r"|related|recommended|pagination|pager|widget|toolbar|skip)(?:[-_].*)?"
    r"|(?:site|page|main|top|left|right|global|primary|secondary|user|reader)[-_](?:nav|navigation|menu|footer|header|sidebar|comments?|masthead)|masthead|header", re.I)


def _role(tag: str, attributes: str, inside: int) -> int:
    """The part that an element's text belongs to, given that of its parent."""
    if inside == TEMPLATE or tag in NEVER or tag == "header" and inside == LOOSE:
        return TEMPLATE
    if attributes and tag not in ("html", "head", "body"):
        for name, *values, hidden in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), values[0] or values[1] or values[2]
            if hidden or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                return TEMPLATE
            if name == "role" and value.lower() in ROLES:
                return TEMPLATE
            if name in ("class", "id"):
                for part in value.split():
                    if NAMES.fullmatch(part) and not (part.lower() == "header" and inside != LOOSE):
                        return TEMPLATE
            if name == "role" and value.lower() in ("main", "article"):
                return min(inside, MAIN if value.lower() == "main" else ARTICLE)
    return min(inside, {"article": ARTICLE, "main": MAIN}.get(tag, inside))


def lines(page: str) -> list[tuple[int, str, bool]]:
    """The page's blocks of text in order, each with the part it belongs to and whether it is in a heading; one pass over the markup."""
    out: list[tuple[int, str, bool]] = []
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    role, parts, at = LOOSE, [], 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((role, text, any(opened[tag] for tag in HEADINGS)))
            parts.clear()

    size = len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            parts.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            parts.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = m[1] or m[4]
        if tag in RAW:
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag == "br":
            parts.append(" ")
        if tag not in INLINE:
            flush()
        if closing:
            if opened[tag]:
                flush_role = role
                while True:
                    name, outer = stack.pop()
                    opened[name] -= 1
                    if outer != flush_role:
                        flush()
                    role = flush_role = outer
                    if name == tag:
                        break
        elif tag not in VOID:
            inner = _role(tag, m[3] or m[6] or "", role)
            if inner != role:
                flush()
            stack.append((tag, role))
            opened[tag] += 1
            role = inner
    flush()
    return out


def common_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both; bit vectors stand for the rows of the table."""
    places: dict = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, s = [full], full
    for line in a:
        u = s & places.get(line, 0)
        s = ((s + u) | (s - u)) & full
        rows.append(s)
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    i, j, out = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append(i)
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return out[::-1]


class _Page:
    """A page of a block: its lines (as hashes), their numbers of words, the lines outside article and main, and the part that is its text."""

    def __init__(self, row) -> None:
        self.k1, self.k2, self.number, self.host = row.k1, row.k2, row.number, row.host
        self.lines, self.words, roles = row.lines.tolist(), row.words.tolist(), row.roles.tolist()
        self.part = part_of(roles)
        self.places = [k for k, role in enumerate(roles) if role == self.part]
        self.size = sum(self.words[k] for k in self.places)
        outside = [(line, n, role) for line, n, role in zip(self.lines, self.words, roles) if role > MAIN]
        self.outside = [line for line, _, _ in outside]
        self.loose = [k for k, (_, _, role) in enumerate(outside) if role == LOOSE]
        self.loose_size = sum(outside[k][1] for k in self.loose)


def template_lines(own: list, words: list[int], other: list) -> list[int]:
    """Places of the lines that differencing deletes: the shared ones, but no prose between copies."""
    shared = common_lines(own, other)
    prose = {k for k, n in enumerate(words) if n >= PROSE_WORDS}
    copies = 2 * len(prose.intersection(shared)) > len(prose)
    return [k for k in shared if not (copies and k in prose)]


def _copies(a: _Page, b: _Page) -> bool:
    """Whether the own lines of two pages are mostly the same."""
    shared = set(a.places).intersection(common_lines(a.lines, b.lines))
    return 2 * sum(a.words[i] for i in shared) >= COPY * (a.size + b.size)


def template_of(rows: list, k: int) -> list[int]:
    """Places of the template lines of page ``k``, by the nearest pages of its host that are no copies.

    Outside article and main one such page decides, before it, else after it.  Inside them
    lines must be shared with ``VOTERS`` of them that are no copies of each other; where there
    are fewer, nothing is deleted.
    """
    page = rows[k]
    inside = page.part != LOOSE
    if inside:
        near = [j for d in range(1, len(rows)) for j in (k - d, k + d) if 0 <= j < len(rows) and rows[j].host == page.host]
    else:
        near = [j for j in (*range(k - 1, -1, -1), *range(k + 1, len(rows))) if rows[j].host == page.host]
    # A page without article is not compared with the articles of others.
    lines, places, size = ("lines", "places", "size") if inside else ("outside", "loose", "loose_size")
    own, mine = getattr(page, lines), set(getattr(page, places))
    texts, left, voters = {own[i] for i in mine}, mine, []
    for other in (rows[j] for j in near):
        if getattr(other, lines) == own:
            continue
        if inside and texts.isdisjoint(other.lines):
            return []
        shared = common_lines(own, getattr(other, lines))
        if 2 * sum(page.words[i] for i in mine.intersection(shared)) >= COPY * (getattr(page, size) + getattr(other, size)):
            continue
        if not inside:
            return template_lines(own, page.words, other.outside)
        if any(voter.lines == other.lines or _copies(voter, other) for voter in voters):
            continue
        left = left.intersection(shared)
        voters.append(other)
        if not left or len(voters) == VOTERS:
            return sorted(left)
    return []


def part_of(roles: list[int]) -> int:
    """The innermost part that has any text."""
    return min([role for role in roles if role < LOOSE], default=LOOSE)


def main_text(found: list[tuple[int, str, bool]], deleted: set[int]) -> str:
    """Text of the innermost part that has any, without the lines at the places ``deleted``.

    A heading inside article or main goes only where all lines below it go, up to the next
    heading; an article of which nothing would be left stays.
    """
    part = part_of([role for role, _, _ in found])
    own = [(text, heading, k in deleted) for k, (role, text, heading) in enumerate(found) if role == part]
    kept, below = [], False
    for text, heading, gone in reversed(own):
        if not gone or heading and below and part != LOOSE:
            kept.append(text)
        below = not heading and (below or not gone)
    if not kept and part != LOOSE:
        return "\n".join(text for text, _, _ in own)
    return "\n".join(reversed(kept))


def _neighbours(pages: DataFrame) -> DataFrame:
    """Per page (``k1``, ``k2``) the places of its template lines.

    Numbers in the order of host, path and key cut the pages into blocks of one size,
    whatever their hosts, and each block also gets the ``VOTERS`` pages before and after it.
    Pages that have only copies of themselves in the block lose nothing.
    """
    order = ["host", "path", "k1", "k2"]
    placed = numbered(pages, order, "pages-in-order").drop("path")
    blocks = F.sequence(F.greatest(F.floor((F.col("number") - VOTERS) / BLOCK), F.lit(0)), F.floor((F.col("number") + VOTERS) / BLOCK))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        rows = [_Page(row) for row in group.sort_values("number").itertuples()]
        mine = group["block"].iloc[0]
        out = []
        for k, row in enumerate(rows):
            if row.number // BLOCK == mine:
                out.append((row.k1, row.k2, template_of(rows, k)))
        return pd.DataFrame(out, columns=["k1", "k2", "deleted"])

    return placed.withColumn("block", F.explode(blocks)).groupBy("block").applyInPandas(
        compare, "k1 bigint, k2 bigint, deleted array<int>")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][^:/?#]*://([^/?#]*)([^?#]*)", group)


def extract(pages: DataFrame, out: str = "text") -> DataFrame:
    """Add ``text``, the main text, to every page; a column of that name is replaced.

    Null and empty pages have empty text.  Pages of null or odd URLs share a host without
    name.  Equal rows are compared once and all get its result; other columns pass.
    """
    own = [c for c in pages.columns if c.lower() != out.lower()]
    key = ["page_id", "url", "html"]
    k1, k2 = F.xxhash64(F.lit(1), *key), F.xxhash64(*key[::-1], F.lit(2))

    def differenced(columns: dict[str, pa.Array]) -> list[pa.Array]:
        every = [lines(v.as_py() or "") for v in columns["html"]]
        # Lines are compared by their hashes, so that no text is shuffled for it.
        hashed = [[xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63) for _, text, _ in found] for found in every]
        return [
            pa.array(hashed, pa.list_(pa.int64())),
            pa.array([[text.count(" ") + 1 for _, text, _ in found] for found in every], pa.list_(pa.int32())),
            pa.array([[role for role, _, _ in found] for found in every], pa.list_(pa.int32())),
        ]

    keyed = pages.select(
        k1.alias("k1"), k2.alias("k2"), F.lower(_part(F.col("url"), 1)).alias("host"), _part(F.col("url"), 2).alias("path"), "html")
    numbers = T.ArrayType(T.IntegerType())
    seen = append_columns(keyed, [
        T.StructField("lines", T.ArrayType(T.LongType())), T.StructField("words", numbers), T.StructField("roles", numbers)], differenced, ["html"], ["k1", "k2", "host", "path"])
    seen, path = stored(seen, "lines")
    neighbours = _neighbours(seen.dropDuplicates(["k1", "k2"]))
    discard(pages.sparkSession, path)  # what is read from here on are the pages in order
    deleted = neighbours.where(F.size("deleted") > 0).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("deleted").alias("__deleted"))
    joined = pages.select(*own, k1.alias("__p1"), k2.alias("__p2")).join(
        deleted, (F.col("__p1") == F.col("__k1")) & (F.col("__p2") == F.col("__k2")), "left").select(*own, "__deleted")

    def text(columns: dict[str, pa.Array]) -> list[pa.Array]:
        return [pa.array([
            main_text(lines(page.as_py() or ""), set(gone.as_py() or ())) for page, gone in zip(columns["html"], columns["__deleted"])
        ], pa.string())]

    return append_columns(joined, [T.StructField(out, T.StringType())], text, ["html", "__deleted"], own)
