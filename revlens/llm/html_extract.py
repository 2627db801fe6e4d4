"""HTML main-text extraction with nearest-URL page differencing.

A page becomes text lines, one per block element, each marked *declared* (inside an
article or main element), *open* (no such statement) or *chrome* (menus, headers,
footers, sidebars, notices, adverts, forms, comments by element, class, id or role).

Pages of a host are ordered by URL path; each is paired with the neighbour whose path
shares the longer prefix, and compared with the next ones on both sides too. The lines
of two pages are aligned by longest common subsequence: what they share is the template.
Open lines shared with the paired page are deleted; declared lines only when all of
several different neighbours share them in the same place, near copies not counted (two
articles may quote one line, or be copies). Chrome is dropped even when unique. All other
lines stay, in page order: open lines that differencing leaves are text of the page, whatever
stands beside them in a declared region.

Only line hashes take part in ordering and pairing: pages of a host with the same lines
are one class (placed at its smallest path), so that copies meet their nearest different
page; classes are range-partitioned by (host, path), so a host with a third of all pages spreads over many partitions, and
neighbours across partition ends are joined by running number.

Omitted end tags (p, li, dt, dd, option, table parts, head) are closed as HTML says, so a
mark ends with its own element.

Defined cases: null or empty html gives an empty text; without ``://`` a page has no
host and is not paired; rows with the same lines are one page for pairing, and what is
deleted from it is deleted from each of them.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from revlens.llm.common import arrow_rows, packed, small_side
from revlens.llm.url_rules import host_of, path_of
from revlens.session import materialize

DECLARED, OPEN, CHROME = 2, 1, 0
#: pages looked at on either side of a page
AROUND = 3
#: pages that cross to Python at a time while lines are compared: a worker keeps what its largest batch took
BATCH = 256

# HTML element and hint names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes plaintext".split())
DROPPED = frozenset("nav aside form head noscript template svg dialog menu button select object audio "
                    "video canvas footer header".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt "
                   "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
                   "menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
REGIONS = frozenset(("article", "main"))
NEVER_HINTED = frozenset(("html", "body", "main"))
#: a class or id that is one of these, or begins or ends with one ('sidebar-left')
HINTS = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
                  "banner cookie cookies consent gdpr sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                  "header masthead footer comment comments commentlist disqus".split())
#: a class or id that is exactly one of these: as part of a longer name they name content, too
#: ('share-prices', 'related-work', 'notice-period')
WHOLE_HINTS = frozenset("notice notices alert popup modal overlay newsletter subscribe signup login widget reply replies "
                        "respond share sharing social promotion pagination pager toolbar".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                  "toolbar".split())
# Omitted end tags: a start tag of the first set ends an open element of the second, unless
# one of the third (or, for a p, of SCOPES) lies between.
SCOPES = frozenset("table caption td th button object template marquee html select".split())
ENDS_P = frozenset("address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr legend li main menu nav ol p pre section summary table "
                   "ul".split())
_PLAIN = BLOCKS - frozenset(("address", "div", "p"))
_TABLES = frozenset(("table", "template", "html"))
IMPLIED = tuple((frozenset(a.split()), frozenset(b.split()), c) for a, b, c in (
    ("li", "li", (_PLAIN | SCOPES) - {"li"}), ("dt dd", "dt dd", (_PLAIN | SCOPES) - {"dt", "dd"}),
    ("option optgroup", "option", frozenset(("select", "datalist"))), ("optgroup", "optgroup", frozenset(("select",))),
    ("td th tr tbody thead tfoot", "td th caption colgroup", _TABLES), ("tr tbody thead tfoot", "tr", _TABLES),
    ("tbody thead tfoot", "tbody thead tfoot", _TABLES), ("tr td th", "colgroup", _TABLES)))
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
KEEPERS = frozenset("content main article body wrapper container page post entry text with has no without".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>",
                  re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PARTS = re.compile(r"[^a-z0-9]+")


def _is_chrome(tag: str, attrs: str, inside: bool) -> bool:
    if tag in DROPPED:
        return not (inside and tag == "header")
    if not attrs.strip() or tag in NEVER_HINTED:
        return False
    got = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
    if "hidden" in got or got.get("aria-hidden") == "true" or got.get("role") in ROLES:
        return True
    for name in f"{got.get('class', '')} {got.get('id', '')}".split():
        parts = [p for p in _PARTS.split(name) if p]
        if name in HINTS or name in WHOLE_HINTS or (parts and not KEEPERS.intersection(parts)
                             and (parts[0] in HINTS or parts[-1] in HINTS)):
            return True
    return False


def _close_implied(tag: str, stack: list[tuple[str, bool, bool, bool]]) -> None:
    """Remove from the stack the elements that a start tag ends by itself."""
    def close(names, barrier):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in barrier:
                return

    if stack and stack[-1][0] == "head" and tag not in IN_HEAD:
        stack.pop()
    for tags, names, barrier in IMPLIED:
        if tag in tags:
            close(names, barrier)
    if tag in ENDS_P:
        close(("p",), SCOPES)


def page_lines(page: str | None) -> list[tuple[int, str]]:
    """(mark, line) of every block of a page, in order."""
    if not page:
        return []
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, bool, bool]] = []   # element, chrome, declared, silent
    buffer: list[str] = []
    mark = OPEN

    def flush():
        if buffer:
            line = " ".join(html_lib.unescape("".join(buffer)).split())
            if line:
                out.append((mark, line))
            buffer.clear()

    at, low = 0, None
    while True:
        m = _TAG.search(page, at)
        _, chrome, declared, silent = stack[-1] if stack else ("", False, False, False)
        piece = page[at:m.start() if m else len(page)]
        if stack and stack[-1][0] == "head" and not piece.isspace() and piece:
            stack.pop()                            # text ends an open head
            _, chrome, declared, silent = stack[-1] if stack else ("", False, False, False)
        if piece and not silent:
            if not buffer:
                mark = CHROME if chrome else DECLARED if declared else OPEN
                if piece.isspace():
                    piece = ""
            if piece:
                buffer.append(piece)
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:                                   # end tag
            if tag in BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br" and buffer:
            buffer.append(" ")
        _close_implied(tag, stack)
        _, chrome, declared, silent = stack[-1] if stack else ("", False, False, False)
        if tag in VOID:
            continue
        if tag in RAW:                             # its content is no markup: skip to the end tag
            if low is None:
                low = page.lower()
                low = low if len(low) == len(page) else page
            end = low.find("</" + tag, at)
            at = len(page) if end < 0 else end
            continue
        own = _is_chrome(tag, m[3] or "", declared)
        # an inline advert or button is left out of its block; a block element ends one
        stack.append((tag, chrome or own, declared or tag in REGIONS or 'role="main"' in (m[3] or ""),
                      silent or (own and tag not in BLOCKS)))
    flush()
    return out


def common_lines(mine: list[int], other: list[int]) -> list[int]:
    """Positions of ``mine`` in a longest common subsequence with ``other``. Common ends
    are taken first; the rest is a longest increasing run over the matching positions."""
    n, m = len(mine), len(other)
    head = 0
    while head < n and head < m and mine[head] == other[head]:
        head += 1
    tail = 0
    while tail < n - head and tail < m - head and mine[n - 1 - tail] == other[m - 1 - tail]:
        tail += 1
    where: dict[int, list[int]] = {}
    for j in range(m - tail - 1, head - 1, -1):    # descending, so a line is used once
        where.setdefault(other[j], []).append(j)
    ends: list[int] = []
    links: list[tuple[int, int]] = []
    tops: list[int] = []
    for i in range(head, n - tail):
        for j in where.get(mine[i], ()):
            k = bisect_left(ends, j)
            links.append((i, tops[k - 1] if k else -1))
            if k == len(ends):
                ends.append(j)
                tops.append(len(links) - 1)
            else:
                ends[k], tops[k] = j, len(links) - 1
    middle, at = [], tops[-1] if tops else -1
    while at >= 0:
        i, at = links[at]
        middle.append(i)
    return [*range(head), *reversed(middle), *range(n - tail, n)]


@F.pandas_udf(StructType([StructField("hashes", ArrayType(LongType())), StructField("marks", ArrayType(ByteType())),
                          StructField("sizes", ArrayType(IntegerType())), StructField("same", StringType())]))
def _line_hashes(pages: pd.Series) -> pd.DataFrame:
    import xxhash
    rows = [page_lines(p) for p in pages]
    return pd.DataFrame({"hashes": [[xxhash.xxh3_64_intdigest(t) - (1 << 63) for _, t in r] for r in rows],
                         "marks": [[k for k, _ in r] for r in rows],
                         "sizes": [[len(t) for _, t in r] for r in rows],
                         "same": [xxhash.xxh3_128_hexdigest("\n".join(t for _, t in r)) for r in rows]})


def repeated_lines(mine: list[int], sizes: list[int], others: list[list[int]]) -> list[int]:
    """Positions of declared lines that every one of several different pages shares in the
    same place (counted from the start or the end of the region). A page that shares more
    than half of the lines and of their text is a near copy and no evidence."""
    common = []
    for o in others:
        at = common_lines(mine, o)
        if 2 * len(at) <= len(mine) or 2 * sum(sizes[i] for i in at) <= sum(sizes):
            common.append({i for i in at if i < len(o) and o[i] == mine[i]
                           or len(mine) - i <= len(o) and o[i - len(mine)] == mine[i]})
    return sorted(set.intersection(*common)) if len(common) > 1 else []


@F.pandas_udf(StructType([StructField("near", ArrayType(IntegerType())),
                          StructField("several", ArrayType(IntegerType()))]))
def _shared(mine: pd.Series, marks: pd.Series, sizes: pd.Series, other: pd.Series, bodies: pd.Series) -> pd.DataFrame:
    near, several = [], []
    for a, k, n, o, rest in zip(mine, marks, sizes, other, bodies):
        body = [i for i, mark in enumerate(k) if mark == DECLARED]
        near.append(common_lines(list(a), list(o)))
        several.append([body[i] for i in repeated_lines([a[i] for i in body], [n[i] for i in body],
                                                        [list(r) for r in rest])])
    return pd.DataFrame({"near": near, "several": several})


def template_lines(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(page, deleted): per different page the positions of the open lines it shares with
    its nearest page by URL and of the declared lines all pages around it share; pages that
    share none are left out."""
    rows = pages.select(F.xxhash64(F.col(url), F.col(html)).alias("page"), host_of(F.col(url)).alias("host"),
                        path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    lines = rows.where((F.col("host") != "") & F.col("html").isNotNull()).select(
        "page", "host", "path", _line_hashes("html").alias("l")).select("page", "host", "path", "l.*")
    with arrow_rows(pages.sparkSession, BATCH):
        lines = materialize(lines.dropDuplicates(["page", "host", "path"]), "page-lines")
    look = F.struct("hashes", "marks", "sizes")
    classes = lines.groupBy("host", "same").agg(F.min("path").alias("path"), F.min_by(look, "page").alias("l")) \
        .select("host", "path", "same", "l.*")
    order = ["host", "path", "same"]
    body = F.filter("hashes", lambda h, i: F.get("marks", i) == DECLARED)
    classes = classes.withColumn("body", body)
    ranged = materialize(classes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "page-order")
    here = F.struct("host", "path", "hashes", "body")
    inside = Window.partitionBy("part").orderBy(*order)
    steps = range(1, AROUND + 1)
    # running numbers: a partition's rows follow those of the partitions before it (one row of two
    # numbers per partition)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = materialize(sizes.select(F.col("part").alias("_part"), "n", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                                      .alias("before")), "page-parts")
    numbered = ranged.withColumn("i", F.row_number().over(inside)).join(before, F.col("part") == F.col("_part"))
    # the outermost rows of every partition: what precedes and follows them lies among them
    ends = materialize(numbered.where((F.col("i") <= AROUND) | (F.col("i") > F.col("n") - AROUND)).select(
        F.col("host").alias("_h"), F.col("same").alias("_s"), (F.col("before") + F.col("i")).alias("at"), here.alias("there")),
        "page-ends")
    wanted = ends.select("_h", "_s", "at", F.explode(F.array(*[F.lit(d) for k in steps for d in (-k, k)])).alias("d"))
    ends = wanted.join(ends.select((F.col("at")).alias("_at"), "there"), F.col("at") + F.col("d") == F.col("_at")) \
        .groupBy("_h", "_s").agg(*[F.first(F.when(F.col("d") == side * k, F.col("there")), ignorenulls=True).alias(f"{name}{k}")
                                   for name, side in (("b", -1), ("a", 1)) for k in steps])
    near = ranged.select("*", *[F.lag(here, k).over(inside).alias(f"p{k}") for k in steps],
                         *[F.lead(here, k).over(inside).alias(f"q{k}") for k in steps])
    near = near.join(small_side(materialize(ends, "page-ends")),
                     (F.col("host") == F.col("_h")) & (F.col("same") == F.col("_s")), "left")
    near = near.select("same", "host", "path", "hashes", "marks", "sizes",
                       *[F.coalesce(f"p{k}", f"b{k}").alias(f"p{k}") for k in steps],
                       *[F.coalesce(f"q{k}", f"a{k}").alias(f"q{k}") for k in steps])

    def closeness(side):
        same = F.col(side)["host"] == F.col("host")
        size = F.least(F.length("path"), F.length(F.col(side)["path"]))
        shared = F.size(F.filter(F.sequence(F.lit(0), size), lambda k: (k > 0) & (
            F.substring(F.col("path"), F.lit(1), k) == F.substring(F.col(side)["path"], F.lit(1), k))))
        return F.when(same, shared).otherwise(F.lit(-1))

    before = F.coalesce(closeness("p1"), F.lit(-1)) >= F.coalesce(closeness("q1"), F.lit(-1))
    others = F.array(F.when(before, F.col("p1")).otherwise(F.col("q1")), F.when(before, F.col("q1")).otherwise(F.col("p1")),
                     *[F.col(f"{side}{k}") for k in steps[1:] for side in "pq"])
    picked = near.select("host", "same", "hashes", "marks", "sizes", F.filter(
        others, lambda o: F.coalesce(o["host"] == F.col("host"), F.lit(False))).alias("o")).where(F.size("o") > 0)
    got = picked.select("host", "same", _shared("hashes", "marks", "sizes", F.col("o")[0]["hashes"], F.col("o.body")).alias("at"))
    with arrow_rows(pages.sparkSession, BATCH):
        got = materialize(got.select("host", "same", "at.*").where((F.size("near") > 0) | (F.size("several") > 0)),
                          "class-lines")
    # every copy by its own marks: equal lines may stand in different elements
    each = lines.join(got, ["host", "same"]).select("page", F.concat(
        F.filter("near", lambda i: F.get("marks", i) == OPEN),
        F.filter("several", lambda i: F.get("marks", i) == DECLARED)).alias("deleted"))
    return materialize(each.where(F.size("deleted") > 0).dropDuplicates(["page"]), "template-lines")


def main_text(lines: list[tuple[int, str]], deleted=()) -> str:
    """All lines that are neither chrome nor deleted by differencing."""
    gone = set(deleted)
    return "\n".join(t for i, (mark, t) in enumerate(lines) if mark != CHROME and i not in gone)


@F.pandas_udf(StringType())
def _extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, deleted in batches:
        yield pd.Series([main_text(page_lines(p), () if d is None else d) for p, d in zip(pages, deleted)],
                        dtype=object)


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(_row, text) of every row."""
    shared = template_lines(pages, url, html)
    rows = packed(pages).withColumn("page", F.xxhash64(F.col("_row")[url], F.col("_row")[html]))
    both = rows.join(shared, "page", "left")
    return both.select("_row", _extract(F.col("_row")[html], F.col("deleted")).alias("text"))
