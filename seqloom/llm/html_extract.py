"""Main text of web pages: markup tells most of what isn't the article; pages of near URLs tell the rest.

A page becomes lines (its blocks of text), each marked as the article's, as known boilerplate (menus, footers, adverts,
forms, comments and the like) or as neither. Within each host, pages are sorted by URL path; a page's partner is the
neighbour whose path shares most with its own. Their lines are aligned by longest common subsequence, and a line that
both share is deleted, unless the markup says that it is the article's: sites repeat passages in articles, too. What is
left, in an article or beside it, is the text. Only where no partner tells the lines that markup doesn't place, markup
decides: they stay if no article encloses any text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import among, chunks, discard, pick, store

# How HTML's elements and the usual class names are taken.
SKIP = frozenset("script style noscript template iframe svg canvas object select option button input textarea head title audio video map datalist".split())
RAW = frozenset("script style title textarea noscript iframe".split())
CHROME = frozenset("nav footer aside form menu dialog".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Whole class names and ids, not parts of them: "has-sidebar" and "article-header" are none.
CHROME_NAMES = re.compile(r"(?:site-|page-|main-|top-|bottom-|left-|right-|global-|user-|reader-|post-|article-)?(?:ads?|advert|advertisement|adverts|banner|breadcrumbs?|comments?|comment-list|comments-area|cookies?|cookie-banner|cookie-notice|consent|copyright|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|popup|promo|promoted|related|related-posts|share|sharing|share-buttons|sidebar|signup|social|social-links|social-share|sponsor|sponsored|subscribe|toolbar|widget)(?:-(?:bar|block|box|container|list|menu|section|wrapper|area|item|links|\d+))?|(?:site-|page-|top-|global-)header|header", re.I)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MAIN_NAMES = re.compile(r"article|article-(?:body|content|text)|entry-content|main-content|post-(?:body|content)|story(?:-body)?", re.I)
_IMPLIED = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}

#: What may begin markup. Each alternative takes a fixed beginning; where it ends is looked for once, from there.
_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][A-Za-z0-9:-]*))")
#: A tag's attributes in turn: a name, and a value in quotes or without; quotes count only after an equals sign.
_ATTR = re.compile(r"[\s/]*+(?:(>)|([^\s/>=]=?[^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(\"|\Z)|'([^']*+)('|\Z)|([^\s>]*+)))?)")
_SPACE = re.compile(r"[\s\xa0]+")
ARTICLE, CHROME_LINE, OTHER = 0, 1, 2


def _attributes(html: str, at: int, quotes: dict[str, int]) -> tuple[int, dict[str, str], bool]:
    """(end, attributes, whether it closes itself) of the tag whose name ends at ``at``; the first of equal names counts.

    A value whose quote is never closed ends the tag at its first ">", so that stray quotes cost no text. ``quotes`` holds,
    for the page, from where on each quote no longer occurs, so that it isn't looked for again. The end is -1 if there is none.
    """
    out: dict[str, str] = {}
    n, end = len(html), at
    while m := _ATTR.match(html, end):
        if m[1]:
            return m.end(), out, html[m.end() - 2 : m.end() - 1] == "/" and not html[end : m.end() - 2].strip()
        quote = '"' if m[3] is not None else "'" if m[5] is not None else ""
        if quote and not (m[4] if m[3] is not None else m[6]):
            quotes[quote] = min(quotes.get(quote, n), m.start())
            stop = html.find(">", m.end(2))
            return (stop + 1 if stop >= 0 else -1), out, False
        if m.end() == end:
            break
        out.setdefault(m[2].lower(), m[3] or m[5] or m[7] or "")
        end = m.end()
    return -1, out, False


def lines(html: str | None) -> list[tuple[int, str]]:
    """(mark, text) of each block, in page order: character references decoded, white space single, none empty.

    Linear in the page's length. Tags that aren't closed, or closed too often, do no more harm than in browsers: an
    end tag closes up to its element if that is open, and is ignored if not.
    """
    html = html or ""
    out: list[tuple[int, str]] = []
    buf: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # element, mark, whether its text is skipped
    counts: dict[str, int] = {}
    mark, skip, at = OTHER, False, 0

    def flush() -> None:
        if buf:
            text = _SPACE.sub(" ", unescape("".join(buf))).strip()
            buf.clear()
            if text:
                out.append((mark, text))

    def close(name: str) -> None:
        nonlocal mark, skip
        while stack:
            top = stack.pop()[0]
            counts[top] -= 1
            if top == name:
                break
        mark, skip = (stack[-1][1], stack[-1][2]) if stack else (OTHER, False)

    pos, quotes = 0, {}
    while m := _OPEN.search(html, pos):
        if m[1] or m[2]:
            ends = html.find("-->", m.end()) + 3 if m[1] else html.find(">", m.end()) + 1
            end, attrs, closed = (ends if ends > (2 if m[1] else 0) else len(html)), {}, False
        else:
            end, attrs, closed = _attributes(html, m.end(), quotes)
        if m.start() > at and not skip:
            buf.append(html[at : m.start()])
        if end < 0:  # a tag that nothing ends: the rest is its own, as in browsers
            at = len(html)
            break
        pos = at = end
        name = (m[4] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        if m[3]:
            if counts.get(name):
                close(name)
            continue
        for other in _IMPLIED.get(name, "").split():
            if stack and stack[-1][0] == other:
                close(other)
        if name in VOID or closed:
            continue
        if name in RAW:  # its text ends only at its own end tag
            end = re.compile(rf"</{name}\s*>", re.I).search(html, pos)
            pos = at = end.end() if end else len(html)
            continue
        inner, hide = mark, skip or name in SKIP
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split() if attrs else []
        gone = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
        chrome = name in CHROME or attrs.get("role", "").lower() in CHROME_ROLES or (name == "header" and inner != ARTICLE) or (name not in ("html", "body") and any(map(CHROME_NAMES.fullmatch, names)))
        if gone or (chrome and name != "main"):
            inner = CHROME_LINE
        elif name == "main" or (inner != CHROME_LINE and (name == "article" or any(map(MAIN_NAMES.fullmatch, names)))):
            inner = ARTICLE
        stack.append((name, inner, hide))
        counts[name] = counts.get(name, 0) + 1
        mark, skip = inner, hide
    if at < len(html) and not skip:
        buf.append(html[at:])
    flush()
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """The places in ``a`` of a longest common subsequence with ``b``.

    Equal beginnings and ends are set aside. Of what is between, a row of the table of lengths is one whole number, a bit
    for each line of ``b`` that is 0 where the length grows; a row follows from the one above by a sum. Work is the
    product of the lengths over the bits of a machine word, however often lines repeat. Of the rows every so many are kept, and
    those between made again on the way back.
    """
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    mine, theirs = a[first : len(a) - last], b[first : len(b) - last]
    where: dict[int, int] = {}
    for j, x in enumerate(theirs):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(theirs)) - 1

    def rows(v: int, some: list[int]) -> Iterator[int]:
        for x in some:
            u = v & where.get(x, 0)
            v = ((v + u) | (v - u)) & full
            yield v

    step = max(1, int(len(mine) ** 0.5))
    kept = [full]
    for i in range(0, len(mine), step):
        for v in rows(kept[-1], mine[i : i + step]):
            pass
        kept.append(v)
    found, col = [], len(theirs)
    for part in range(len(kept) - 2, -1, -1):
        base = part * step
        table = [kept[part], *rows(kept[part], mine[base : base + step])]
        row = len(table) - 1
        while row and col:
            if table[row] >> (col - 1) & 1:
                col -= 1
            else:
                row -= 1
                if table[row] >> (col - 1) & 1:
                    col -= 1
                    found.append(first + base + row)
    return [*range(first), *reversed(found), *range(len(a) - last, len(a))]


def assemble(found: list[tuple[int, str]], gone: set[int] | None) -> str:
    """The text, in page order: the article's lines, and those that markup doesn't place and the partner doesn't share.

    ``gone`` has the places of shared lines. Without a partner it is None: then unplaced lines stay only if there is no article.
    """
    alone = gone is None and any(k == ARTICLE for k, _ in found)
    return "\n".join(t for i, (k, t) in enumerate(found) if k == ARTICLE or (k == OTHER and not alone and i not in (gone or ())))


def _near(keys: DataFrame) -> DataFrame:
    """(k, partner) for ``keys`` (k, host, path): of the two neighbours in a host's order of paths, the one whose path shares more leading parts; ties to the earlier.

    The order is one over all hosts, cut into ranges of about equal numbers, so that no host is one task's; what stands at
    a range's ends gets its neighbour from the range beside it.
    """
    parts = max(8, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = store(keys.repartitionByRange(parts, "host", "path", "k").withColumn("pid", F.spark_partition_id()), "urls")
    w = Window.partitionBy("pid").orderBy("host", "path", "k")
    page = F.struct("host", "path", "k")
    near = store(cut.withColumn("prev", F.lag(page).over(w)).withColumn("next", F.lead(page).over(w)), "near")
    discard(cut)
    # one row for each range: as many as there are partitions, whatever the input
    ends = near.groupBy("pid").agg(F.min(F.when(F.col("prev").isNull(), page)).alias("first"), F.max(F.when(F.col("next").isNull(), page)).alias("last"))
    order = Window.orderBy("pid")
    ends = ends.select("pid", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    near = near.join(F.broadcast(ends), "pid").select("k", "host", "path", F.coalesce("prev", "before").alias("p"), F.coalesce("next", "after").alias("n"))

    def alike(other: str):
        mine, theirs = F.split("path", "/"), F.split(F.col(other)["path"], "/")
        same = F.aggregate(F.zip_with(mine, theirs, lambda x, y: F.coalesce(x == y, F.lit(False))), F.struct(F.lit(True).alias("go"), F.lit(0).alias("n")), lambda acc, x: F.struct((acc["go"] & x).alias("go"), (acc["n"] + (acc["go"] & x).cast("int")).alias("n")), lambda acc: acc["n"])
        return F.when(F.col(other)["host"] == F.col("host"), same).otherwise(-1)

    a, b = F.coalesce(alike("p"), F.lit(-1)), F.coalesce(alike("n"), F.lit(-1))
    return near.select("k", F.when((a >= 0) & (a >= b), F.col("p")["k"]).when(b >= 0, F.col("n")["k"]).alias("partner")).where("partner is not null")


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id_col, url, text, n_chars) for every row.

    Null or empty html, and a page of which nothing is left, give an empty text. A page without a URL, or alone on its
    host, has no partner: markup alone decides. A page whose lines are all its partner's is a copy and proves nothing
    about the site, so none of its lines is deleted for that. Rows may repeat; extra columns take no part; an empty
    table gives no rows.
    """
    rows = pick(pages, id=id_col, url=url, html=html).withColumn("k", F.concat(F.hex(F.xxhash64("id", "url", "html")), F.lit("-"), F.hex(F.xxhash64(F.lit(7), "html", "url", "id"))))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    keys = rows.where("url is not null").select("k", host.alias("host"), path.alias("path")).where("host <> ''").dropDuplicates(["k"])

    def marks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 500):
            hashes, kinds = [], []
            for h in b.column(1).to_pylist():
                found = lines(h)
                hashes.append(np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for _, t in found], np.uint64).tobytes())
                kinds.append(bytes(k for k, _ in found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.binary()), pa.array(kinds, pa.binary())], ["k", "lines", "marks"])

    seen = store(rows.select("k", "html").mapInArrow(marks, "k string, lines binary, marks binary").dropDuplicates(["k"]), "lines")
    pairs = seen.join(_near(keys), "k").join(seen.select(F.col("k").alias("partner"), F.col("lines").alias("theirs")), "partner").select("k", "lines", "marks", "theirs")

    def align(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 500):
            ks, out = [], []
            for k, mine, kinds, theirs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if mine != theirs and OTHER in kinds:
                    shared = common(np.frombuffer(mine, np.uint64).tolist(), np.frombuffer(theirs, np.uint64).tolist())
                    ks.append(k)
                    out.append([i for i in shared if kinds[i] == OTHER])
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.string()), pa.array(out, pa.list_(pa.int32()))], ["k", "gone"])

    gone = store(pairs.mapInArrow(align, "k string, gone array<int>"), "gone")
    kind = next(f.dataType.simpleString() for f in rows.schema.fields if f.name == "id")

    def text(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, 500):
            drop = b.column(3).to_pylist() if b.num_columns > 3 else [None] * b.num_rows
            made = [assemble(lines(h), None if g is None else set(g)) for h, g in zip(b.column(2).to_pylist(), drop, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made, pa.string())], ["id", "url", "text"])

    schema, ids = f"id {kind}, url string, text string", gone.select(F.col("k").alias("id"))
    by_key = rows.select(F.col("k").alias("id"), F.struct("id", "url", "html").alias("row"))

    def flat(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return text(pa.RecordBatch.from_arrays(b.column(1).flatten(), ["id", "url", "html"]) for b in it)

    # pages without a partner, or without lines that markup doesn't place, aren't shuffled
    clear = among(by_key, ids, True, flat, schema)
    some = among(by_key, ids).join(gone, F.col("id") == gone["k"], "left").select("row.id", "row.url", "row.html", "gone").mapInArrow(text, schema)
    return clear.unionByName(some).select(F.col("id").alias(id_col), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
