"""Main text of pages: structure marks, and differencing against the nearest page by URL.

A page is cut into lines, one a block element. Each line is *boilerplate* (in
a menu, header, footer, sidebar, form, advert, notice or comment element or
one whose class, id or role says so), *article* (in ``article`` or ``main``,
but not in an ``article`` that is itself boilerplate or inside of it, as
comments and cards are) or *open*. Omitted end tags of paragraphs, list items
and table parts are implied at the next sibling. Pages of a host are put in order of their URL paths, each is paired
with its nearest neighbour in that order (the longer common path; the one
before at a tie), and the two lists of lines are aligned by their longest
common subsequence. Lines of the page in that subsequence are shared.

The article is what the page marks as such; in a page without a mark, the open
lines that are not shared. Differencing alone cannot give right results here:
adverts differ from page to page, so they are not shared, and articles share
sentences, so article lines are (README has the figures).

Pages of one host with equal lines are one page in the order, so a copy is
never anyone's neighbour. The order comes from a range shuffle of line hashes
(a few hundred bytes a page), which splits a hot host. Each range gets the
last row of the range before and the first of the one behind.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; truncated and unclosed markup is read as far as it goes; a page
without neighbours shares nothing; repeated rows get equal results; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as references
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.kernels import stored

#: Up to so many bytes the table of shared lines is broadcast.
BROADCAST_BYTES = 16 << 20
#: Bits of the largest subsequence table that is kept whole.
TABLE_BITS = 1 << 28

#: Elements whose content is not text of the page.
RAW = frozenset("script style title textarea template noscript iframe object svg math select xmp noembed noframes".split())
#: Elements that end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
#: Elements, roles and words of classes and ids that mark boilerplate.
DROP = frozenset("nav footer aside form menu dialog button head".split())
DROP_ROLES = frozenset("navigation contentinfo complementary search dialog alert alertdialog form menu menubar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices popup modal "
    "newsletter subscribe comment comments respond disqus share sharing social related recommended widget "
    "pagination pager toolbar login signup copyright".split())
#: The same outside an article only (an article may have a header of its own).
DROP_OUTSIDE = frozenset("header masthead topbar".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+(?:>|\Z)|</?[A-Za-z][^>]*+\Z|</[^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_WORD = re.compile(r"[a-z0-9]+")
#: An unquoted value at the end, to which a slash belongs.
_BARE_VALUE = re.compile(r"=\s*+[^\s\"'>/][^\s\"'>]*\Z")

#: Elements whose start ends an open paragraph.
END_PARAGRAPH = BLOCKS - frozenset("body caption head html legend tbody td tfoot th thead tr".split())
_CELLS, _SECTIONS = frozenset(("td", "th")), frozenset(("tr", "tbody", "thead", "tfoot"))
#: Of an element, the siblings whose end its start implies, and the elements that this does not reach over.
_ITEM_STOPS = BLOCKS - frozenset(("address", "div", "p"))
IMPLIED_ENDS = {
    "li": (frozenset(("li",)), _ITEM_STOPS - {"li"}),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), _ITEM_STOPS - {"dt", "dd"})),
    **dict.fromkeys(_CELLS, (_CELLS, frozenset(("tr", "table")))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (_SECTIONS, frozenset(("table",)))),
}
_PARAGRAPH = (frozenset(("p",)), frozenset("table td th caption button".split()))

#: FORM is boilerplate too, unless an article opens in it (some sites wrap whole pages in a form).
OPEN, BOILERPLATE, ARTICLE, FORM = 0, 1, 2, 3


def _mark(name: str, attributes: str, now: int) -> int:
    """The mark inside an element that starts under mark ``now``."""
    article = name in ("article", "main")
    # a page has one main, which no part of boilerplate holds; articles may also be comments or cards
    if now == BOILERPLATE and name != "main":
        return BOILERPLATE
    if name == "form" and now in (OPEN, FORM):
        return FORM
    if name in DROP or (name in DROP_OUTSIDE and now != ARTICLE):
        return BOILERPLATE
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                if name in ("html", "body"):
                    continue  # says what the page has, not what it is
                # an article's names may hold its topic or state (tag-social, no-comments): whole names only
                found = set(value.split() if article else _WORD.findall(value))
                if found & DROP_WORDS or (now != ARTICLE and found & DROP_OUTSIDE):
                    return BOILERPLATE
            elif key == "role":
                if value in DROP_ROLES or (value == "banner" and now != ARTICLE):
                    return BOILERPLATE
                if value == "main":
                    return ARTICLE
            elif (key == "hidden" and value != "until-found") or (key == "aria-hidden" and value == "true") \
                    or (key == "style" and "display:none" in value.replace(" ", "")):
                return BOILERPLATE
    return ARTICLE if article else now


def lines(page: str) -> list[tuple[str, int]]:
    """(text, mark) of every line that has text, in page order."""
    out: list[tuple[str, int]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = []
    depth: dict[str, int] = {}
    now, at, n = OPEN, 0, len(page)

    def end_line() -> None:
        text = " ".join(references.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append((text, now))

    def imply_end(ends: frozenset[str], stops: frozenset[str]) -> None:
        """Leave the outermost open element of ``ends`` that is not beyond one of ``stops``."""
        nonlocal now
        if not any(depth.get(e) for e in ends):
            return
        to = None
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                to = i
            elif stack[i][0] in stops:
                break
        if to is not None:
            now = stack[to][1]
            for opened, _ in stack[to:]:
                depth[opened] -= 1
            del stack[to:]

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        pieces.append(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1) or m.group(4))
        attributes = m.group(3) or m.group(6) or ""
        if name in ("svg", "math") and attributes.endswith("/") and not _BARE_VALUE.search(attributes):
            continue
        if name in RAW and not closing:
            ended = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = ended.start() if ended else n
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCKS:
            end_line()
        if not closing:
            if name in END_PARAGRAPH:
                imply_end(*_PARAGRAPH)
            if name in IMPLIED_ENDS:
                imply_end(*IMPLIED_ENDS[name])
        if name in VOID:
            continue
        if closing:
            if depth.get(name):
                while stack:
                    opened, before = stack.pop()
                    depth[opened] -= 1
                    if opened == name:
                        if name not in BLOCKS and before != now:
                            end_line()
                        now = before
                        break
        elif not attributes.endswith("/"):
            mark = _mark(name, attributes, now)
            if mark != now and name not in BLOCKS:
                end_line()  # an inline advert is a line of its own
            if name in BLOCKS or mark != now:
                stack.append((name, now))
                depth[name] = depth.get(name, 0) + 1
                now = mark
    end_line()
    return out


def _scores(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` with every prefix of ``b``."""
    bits = _last_row(a, b)[-1] if a else (1 << len(b)) - 1
    raw = np.unpackbits(np.frombuffer(bits.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - raw[:len(b)].astype(np.int64))])


def _last_row(a: list[int], b: list[int], keep: bool = False) -> list[int]:
    """Bit rows of the subsequence table: a zero at j where the length steps up at b[j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def common(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``.

    Bit-parallel rows; a table beyond 32 MB is split in halves of ``a``
    instead of being kept, so memory stays bounded for very long pages.
    """
    first = 0
    while first < len(a) and first < len(b) and a[first] == b[first]:
        first += 1
    last = 0
    while last < len(a) - first and last < len(b) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    head, tail = list(range(first)), list(range(len(a) - last, len(a)))
    x, y = a[first:len(a) - last], b[first:len(b) - last]
    if not x or not y:
        return head + tail
    if len(x) * len(y) > TABLE_BITS and len(x) > 1:
        half = len(x) // 2
        up = _scores(x[:half], y)
        down = _scores(x[half:][::-1], y[::-1])[::-1]
        cut = int((up + down).argmax())
        middle = common(x[:half], y[:cut]) + [half + i for i in common(x[half:], y[cut:])]
    else:
        rows = _last_row(x, y, keep=True)
        middle, j = [], len(y) - 1
        for i in range(len(x) - 1, -1, -1):
            while j >= 0 and rows[i] >> j & 1:  # no step here: the length is reached further left
                j -= 1
            if j < 0:
                break
            before = rows[i - 1] if i else (1 << len(y)) - 1
            if before >> j & 1:  # the step is new in this row: x[i] is matched
                middle.append(i)
                j -= 1
        middle.reverse()
    return head + [first + i for i in middle] + tail


_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)")


def host_path(url: str | None) -> tuple[str, str]:
    m = _URL.match(url or "")
    return (m.group(1).lower(), m.group(2)) if m else ("", url or "")


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, rows, urls, pages = (c.to_pylist() for c in batch.columns)
        hosts, paths, packed, marks, digests = [], [], [], [], []
        for url, page in zip(urls, pages, strict=True):
            host, path = host_path(url)
            own = lines(page or "")
            raw = np.array([xxhash.xxh3_64_intdigest(t) for t, _ in own], np.uint64).tobytes()
            # open lines decide only where nothing is marked as the article
            decides = not any(m == ARTICLE for _, m in own)
            hosts.append(host)
            paths.append(path)
            packed.append(raw)
            marks.append(bytes(1 if decides and m == OPEN else 0 for _, m in own))
            digests.append(xxhash.xxh3_128_hexdigest(raw))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(hosts, pa.string()),
             pa.array(paths, pa.string()), pa.array(packed, pa.binary()), pa.array(marks, pa.binary()),
             pa.array(digests, pa.string())], ["page_id", "row", "host", "path", "lines", "open", "digest"])


def _pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (place, host, path, digest), with the neighbouring ranges' border rows."""
    held: list[tuple] = []  # the last two rows

    def decide(row: tuple, before: tuple | None, after: tuple | None):
        near = [x for x in (before, after) if x is not None and x[0] == row[0] and x[1] == row[1]]
        if row[6] or not near:
            return None
        best = max(near, key=lambda x: len(os.path.commonprefix([x[2], row[2]])))  # the one before at a tie
        mine = np.frombuffer(row[4], np.uint64).tolist()
        shared = np.zeros(len(mine), bool)
        shared[common(mine, np.frombuffer(best[4], np.uint64).tolist())] = True
        gone = shared & (np.frombuffer(row[5], np.uint8) > 0)
        return (row[1], row[3], np.packbits(gone).tobytes(), int(shared.sum()), len(mine), int(gone.sum()))

    def answer(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
            ["host", "digest", "gone", "n_shared", "n_lines", "n_gone"])

    for batch in batches:
        found = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            if len(held) == 2:
                found.append(decide(held[0], None, held[1]))
            elif len(held) == 3:
                found.append(decide(held[1], held[0], held[2]))
                held.pop(0)
        yield answer([f for f in found if f])
    if held:
        f = decide(held[-1], held[-2] if len(held) > 1 else None, None)
        yield answer([f] if f else [])


def shared_lines(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (page_id, row, url, html): (page_id, row, host, digest) and, by (host, digest), the lines to delete."""
    keyed = stored(pages.select("page_id", "row", "url", "html").mapInArrow(
        _line_hashes, "page_id long, row long, host string, path string, lines binary, open binary, digest string"),
        "page-lines")
    order = ["host", "path", "digest"]
    distinct = keyed.groupBy("host", "digest").agg(
        F.min("path").alias("path"), F.first("lines").alias("lines"), F.first("open").alias("open"))
    dealt = stored(distinct.select("host", "path", "digest", "lines", "open").repartitionByRange(*order)
                   .sortWithinPartitions(*order).withColumn("place", F.spark_partition_id()), "page-order")
    borders = {r["place"]: r for r in dealt.groupBy("place").agg(
        F.min(F.struct(*order)).alias("lo"), F.max(F.struct(*order)).alias("hi")).collect()}  # one row a range
    places = sorted(borders)
    spark = pages.sparkSession
    sent = [(p, borders[p]["lo"], q) for q, p in zip(places, places[1:], strict=False)] \
        + [(p, borders[p]["hi"], q) for p, q in zip(places, places[1:], strict=False)]
    ghosts = spark.createDataFrame([(p, *b, q) for p, b, q in sent],
                                   "place int, host string, path string, digest string, goes int")
    extra = (dealt.join(F.broadcast(ghosts), ["place", *order])
             .select(F.col("goes").alias("place"), *order, "lines", "open", F.lit(True).alias("ghost")))
    rows = dealt.select("place", *order, "lines", "open", F.lit(False).alias("ghost")).unionByName(extra)
    found = (rows.repartition(max(len(places), 1), "place").sortWithinPartitions("place", *order)
             .mapInArrow(_pair, "host string, digest string, gone binary, n_shared long, n_lines long, n_gone long"))
    return keyed, found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, masks = (c.to_pylist() for c in batch.columns)
        texts = []
        for page, mask in zip(pages, masks, strict=True):
            own = lines(page or "")
            if any(m == ARTICLE for _, m in own):
                kept = [t for t, m in own if m == ARTICLE]
            else:
                gone = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(own)) if mask else np.zeros(len(own))
                kept = [t for (t, m), g in zip(own, gone, strict=True) if m == OPEN and not g]
            texts.append("\n\n".join(kept))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html).

    Only pages with lines to delete have a row in the deletion table. It is
    broadcast if its measured size is at most ``BROADCAST_BYTES``; beyond
    that the pages are shuffled to it.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.xxhash64("url", "html").alias("row"))
    keyed, found = shared_lines(base)
    cut = stored(found.where("n_gone > 0").select("host", "digest", "gone"), "page-cuts")
    masks = keyed.select("page_id", "row", "host", "digest").join(cut, ["host", "digest"]).select(
        "page_id", "row", "gone").distinct()
    size = masks.agg(F.sum(F.octet_length("gone") + 32).alias("b")).first()["b"] or 0
    joined = base.alias("p").join(
        (F.broadcast(masks) if size <= BROADCAST_BYTES else masks).alias("m"),
        F.col("p.page_id").eqNullSafe(F.col("m.page_id")) & (F.col("p.row") == F.col("m.row")), "left")
    return joined.select("p.page_id", "p.url", "p.html", "m.gone").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")
