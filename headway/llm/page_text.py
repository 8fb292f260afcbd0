"""Main text of web pages: nearest-URL page differencing over text lines.

A page becomes lines, one per block element. Lines inside an element that is
furniture by its tag, role or class are gone at once. The rest is compared with
the page of the same host whose URL path is nearest and that is no copy: the lines
are aligned by their longest common subsequence, and shared lines are deleted as
template text. This is done for every page. A check of what is left and deleted
follows where a page has an explicit article element: nothing outside it stays, and
its prose, which the contract keeps, comes back unless the alignments with all
neighbours, four on each side, four at least and copies aside, share it: that is a
notice or advert of the template, wherever it stands. Sentences that articles happen
to share stay; a line of links alone, a menu, goes by the nearest page. Inside an article an
element is furniture by its tag, by a whole class or role, or by one of a few
names in class, id or role, never by its label or a part of a class; a section
only by those names, a heading never. Pages of a
host with equal lines are one page for the pairing; a pair that shares most of its
text is a pair of copies too, and neither decides about the other.

The nearest page is a neighbour in the order of host and path: the one with the
longest common prefix, the closer one on a tie, then the earlier one. Where all
neighbours are copies and the host has pages beyond them, the next page before and
the next behind that have a near page stand in for them, and those near pages too.
Ranks in that order come from a range partitioning, so no host has to fit into one
task.

Defined results: a null or empty html gives an empty text; a page without a URL
or alone on its host has no partner; equal pages (same id, URL and html) are one
page for the pairing and all get the result; of pages with equal lines the least
path stands for all; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from posixpath import commonprefix

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import add_columns, stored

# HTML element names by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav noscript ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu title math audio video".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
_RAW_ENDS = {name: re.compile("</" + name, re.I | re.A) for name in RAW}
ARTICLE = frozenset(("article", "main"))
#: Words in a class, id or role that mark furniture, and those that mark the article.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus "
    "discussion footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "promoted related replies reply reactions respond share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription tags "
    "toolbar widget widgets complementary contentinfo search alert disclaimer".split())
CONTENT = frozenset("article articlebody content entry maincontent post postbody story storybody".split())
#: Classes, ids and roles that are furniture inside an article too, without hyphens, for sections as well.
INSIDE = frozenset(
    "comments commentsarea commentssection commentsection commentlist commentslist commentswrapper disquscomments disqusthread respond "
    "cookienotice cookiebanner cookieconsent adbanner adcontainer adslot adunit adwrapper advertisement sidebar sidebarwidget sharebuttons "
    "sharebar sharelinks socialshare sociallinks relatedposts relatedarticles relatedlinks sitefooter siteheader siteinfo newslettersignup".split())
#: A pair that shares this part of its open text is a pair of copies.
COPY_SHARE = 0.8
#: Neighbours on each side, and how many of them, copies aside, must be there to make a line of prose the template's.
NEIGHBOURS, WITNESSES = 4, 4
#: Pages, in their order, that a task compares with their neighbours; not fewer than NEIGHBOURS.
RUN = 4096

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>", re.S)
#: The same without tags: all that can still match where no ">" follows.
_UNCLOSED = re.compile(r"<!--.*$|<!\[CDATA\[.*$|<[!?](?:[^>]*)$", re.S)
#: Elements that belong to the article they stand in, whatever their class.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OWN = HEADINGS | {"section"}
#: Beginnings of class tokens that tell what stands beside an element, not what it is.
LAYOUT = ("no-", "has-", "with-", "without-", "no_", "has_", "with_", "without_")
_CLASSES = re.compile(r"(?<![\w-])(?:class|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_IDS = re.compile(r"(?<![\w-])id\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MARKS = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?until)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _role(name: str, attributes: str, inside: bool = False) -> str | None:
    """'drop' for furniture, 'keep' for the article, else None; ``inside`` an article little counts as furniture."""
    if name in DROPPED:
        return "drop"
    if name in ARTICLE:
        words = _marks(attributes, _CLASSES)
        return "drop" if words & FURNITURE and not words & CONTENT else "keep"
    if name == "header":
        return "drop"
    if "=" not in attributes and "hidden" not in attributes:
        return None
    if name not in ("body", "html") and _HIDDEN.search(attributes):
        return "drop"
    whole = _tokens(attributes)
    if inside:
        if name not in HEADINGS and (whole | _tokens(attributes, _IDS)) & INSIDE and not whole & CONTENT:
            return "drop"
        return "drop" if whole & FURNITURE and not whole & CONTENT and name not in OWN else None
    if whole & CONTENT and not whole & FURNITURE and name in ("div", "section", "td"):
        return "keep"
    words = _marks(attributes, _MARKS)
    if words & FURNITURE:
        return None if name in ("body", "html") else "drop"
    return "keep" if words & CONTENT and name in ("div", "section", "td") else None


def _tokens(attributes: str, pattern: re.Pattern | None = None) -> set[str]:
    """Whole tokens of class and role, or of what the pattern finds, lower case, without hyphens."""
    return {t.lower().replace("-", "").replace("_", "") for groups in (pattern or _CLASSES).findall(attributes) for t in "".join(groups).split()}


def _marks(attributes: str, pattern: re.Pattern) -> set[str]:
    """Words and tokens of the attributes that the pattern finds."""
    out = set()
    for groups in pattern.findall(attributes):
        for token in "".join(groups).split():
            if not token.lower().startswith(LAYOUT):
                out.update(w.lower() for w in _WORDS.findall(token))
                out.add(token.lower().replace("-", "").replace("_", ""))
    return out


def lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, inside an article, links alone) of each block of a page that is not furniture."""
    if not page:
        return []
    out, parts, stack = [], [], []  # the stack holds (name, dropped before it, article before it)
    dropped = article = False
    links, linked, plain = 0, False, False
    raw_until = None

    def flush():
        nonlocal linked, plain
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, article, linked and not plain))
            parts.clear()
        linked = plain = False

    def add(text):
        nonlocal linked, plain
        if not dropped and text:
            parts.append(text)
            if not text.isspace():
                if links:
                    linked = True
                else:
                    plain = True

    at = 0
    last = page.rfind(">")
    opened = Counter()  # names on the stack
    while True:
        if raw_until is not None:
            # nothing inside these elements is markup
            end = _RAW_ENDS[raw_until].search(page, at)
            at, raw_until = (end.start() if end else len(page)), None
        found = (_TOKEN if at <= last else _UNCLOSED).search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        name = found[2] if found.re is _TOKEN else None
        if name is None:
            if found[0].startswith("<![CDATA["):
                add(entities.escape(found[0][9:].removesuffix("]]>")))
            continue
        name, attributes = name.lower(), found[3]
        if name in BLOCK:
            flush()
        if found[1]:
            if opened[name]:
                while True:
                    entry = stack.pop()
                    opened[entry[0]] -= 1
                    dropped, article = entry[1], entry[2]
                    links -= entry[0] == "a"
                    if entry[0] == name:
                        break
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if name in ("p", "li", "td", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
            _, dropped, article = stack.pop()
            opened[name] -= 1
        role = _role(name, attributes, article)
        stack.append((name, dropped, article))
        opened[name] += 1
        links += name == "a"
        dropped = dropped or role == "drop"
        article = article or role == "keep"
        if name in RAW:
            raw_until = name
    flush()
    return out


def shared_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    places: dict = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    tails, links = [], []
    for i, x in enumerate(a):
        for j in reversed(places.get(x, ())):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def main_text(page: str | None, shared: list[int] | None = None, common: list[int] | None = None) -> str:
    """The page's own lines, joined by a space: without those at the places that ``differences`` gave, then checked against the article."""
    found = lines(page)
    shared, common = set(shared or ()), set(common or ())
    own = [i for i in range(len(found)) if i not in shared]
    if any(article for _, article, _ in found):
        # the article's prose comes back unless all neighbours share it
        back = [i for i in shared - common if not found[i][2]]
        own = [i for i in sorted([*own, *back]) if found[i][1]]
    else:
        own = [i for i in own if not found[i][2]]
    return " ".join(found[i][0] for i in own)


def _code(line: str) -> int:
    """A hash of 48 bits of a line, then 16 bits of its length."""
    import xxhash

    return (xxhash.xxh3_64_intdigest(line.encode()) & ~0xFFFF | min(len(line), 0xFFFF)) - (1 << 63)


def _codes(page: str | None) -> list[int]:
    """Codes of the lines outside furniture."""
    return [_code(text) for text, _, _ in lines(page)]


def compared(path: str, codes: list[int], others: list[tuple[str, list[int]]]) -> list[tuple[int, list[int]]]:
    """(which other page, places of the lines shared with it) of the other pages that are no copies, the nearest first.

    ``others`` are (path, codes) of pages of the host, in the order that counts where as much of the path is common.
    """
    whole = sum(x & 0xFFFF for x in codes)
    found = []
    for i in sorted(range(len(others)), key=lambda i: -len(commonprefix([path, others[i][0]]))):
        both = shared_lines(codes, others[i][1])
        if sum(codes[j] & 0xFFFF for j in both) < COPY_SHARE * whole:
            found.append((i, both))
    return found


def decided(found: list[tuple[int, list[int]]]) -> tuple[list[int], list[int]]:
    """Places of the lines shared with the nearest page of ``compared``, and of those shared with all of them."""
    if not found:
        return [], []
    shared = found[0][1]
    return shared, sorted(set(shared).intersection(*(both for _, both in found))) if len(found) >= WITNESSES else []


def differences(path: str, codes: list[int], others: list[tuple[str, list[int]]]) -> tuple[list[int], list[int]]:
    """Places of the lines shared with the nearest other page that is no copy, and of those shared with all others, copies aside."""
    return decided(compared(path, codes, others))


def _with_differences(rows: DataFrame) -> DataFrame:
    """Rows (.., path, codes, others) without others: shared, common, and the nearest of them that is no copy as near_path and near_codes."""
    def make():
        def run(rows):
            out = [], [], [], []
            for r in rows:
                others = [(o["path"], o["codes"]) for o in r["others"]]
                found = compared(r["path"], r["codes"], others)
                for column, value in zip(out, (*decided(found), *(others[found[0][0]] if found else (None, None))), strict=True):
                    column.append(value)
            return out
        return run

    columns = {"shared": "array<int>", "common": "array<int>", "near_path": "string", "near_codes": "array<bigint>"}
    keep = [c for c in rows.columns if c != "others"]
    return add_columns(rows.withColumn("input", F.struct("path", "codes", "others")), make, columns, text="input", keep=keep)


def beyond_copies(found: DataFrame) -> DataFrame:
    """The rows without a near page whose host goes on, compared anew with the next pages before and behind that have one, and with those pages' near ones."""
    own = F.struct(F.col("path").alias("path"), F.col("codes").alias("codes"))
    near = F.struct(F.col("near_path").alias("path"), F.col("near_codes").alias("codes"))
    known = F.when(F.col("near_path").isNotNull(), F.struct("host", own.alias("own"), near.alias("near")))
    rows = found.withColumn("run", F.floor(F.col("rank") / RUN)).withColumn("known", known)
    before, behind = (Window.partitionBy("run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1) for order in (F.asc("rank"), F.desc("rank")))
    inside = rows.withColumn("before", F.last("known", True).over(before)).withColumn("behind", F.last("known", True).over(behind))
    # what a run takes over from the runs beside it: one page per run
    ends = rows.where("known IS NOT NULL").groupBy("run").agg(F.min_by("known", "rank").alias("first"), F.max_by("known", "rank").alias("last"))
    ends = rows.select("run").distinct().join(F.broadcast(ends), "run", "left")
    before, behind = (Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1) for order in (F.asc("run"), F.desc("run")))
    ends = ends.select("run", F.last("last", True).over(before).alias("earlier"), F.last("first", True).over(behind).alias("later"))
    lonely = inside.where("known IS NULL AND beyond").join(F.broadcast(ends), "run")
    sides = F.coalesce("before", "earlier"), F.coalesce("behind", "later")
    pages = F.array(*(F.when(side["host"] == F.col("host"), side[name]) for name in ("own", "near") for side in sides))
    return _with_differences(lonely.select("host", "content", "rank", "path", "codes", F.filter(pages, lambda x: x.isNotNull()).alias("others")))


def page_differences(pages: DataFrame) -> DataFrame:
    """(host, content, shared, common) of the different pages of a host that have such lines, for rows (key, host, path, codes, content)."""
    size = pages.sparkSession.conf.get("spark.sql.shuffle.partitions")
    different = pages.groupBy("host", "content").agg(F.min(F.struct("path", "key", "codes")).alias("one")).select("host", "content", "one.*")
    ordered = stored(different.repartitionByRange(int(size), "host", "path", "key").sortWithinPartitions("host", "path", "key")
                     .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "pages-ordered")
    # the row numbers of a partition become ranks once the partitions before it are counted: one number per partition
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("row").alias("low")).orderBy("part").collect()
    offsets, total = [], 0
    for r in counts:
        offsets.append((r["part"], total - r["low"]))
        total += r["n"]
    shift = ordered.sparkSession.createDataFrame(offsets or [(-1, 0)], "part int, shift bigint")
    ranked = ordered.join(F.broadcast(shift), "part").withColumn("rank", F.col("row") + F.col("shift")).drop("part", "row", "shift", "key")
    # runs of ranks, each with the neighbours of its ends: no host has to fit into one task
    ends = F.array(*(F.floor((F.col("rank") + step) / RUN) for step in (-NEIGHBOURS, 0, NEIGHBOURS)))
    runs = Window.partitionBy("run").orderBy("rank")
    page = F.struct("host", "path", "codes")
    steps = [step for n in range(1, NEIGHBOURS + 1) for step in (-n, n)]
    beside = ranked.withColumn("run", F.explode(F.array_distinct(ends))).withColumn("beside", F.array(*(F.lead(page, n).over(runs) for n in steps)))
    others = F.transform(F.filter("beside", lambda x: x["host"] == F.col("host")), lambda x: F.struct(x["path"].alias("path"), x["codes"].alias("codes")))
    beyond = F.exists(F.slice("beside", -2, 2), lambda x: F.coalesce(x["host"] == F.col("host"), F.lit(False)))
    rows = beside.where(F.col("run") == F.floor(F.col("rank") / RUN)).select(
        "host", "content", "rank", "path", "codes", beyond.alias("beyond"), others.alias("others"))
    found = stored(_with_differences(rows), "pages-compared")
    parts = [found]
    if not found.where("near_path IS NULL AND beyond").isEmpty():
        parts.append(beyond_copies(found))
    parts = [x.where(F.size("shared") > 0).select("host", "content", "shared", "common") for x in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def html_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    base = pages.select("page_id", "url", "html").withColumn("key", F.xxhash64("page_id", "url", "html"))
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"
    coded = add_columns(base, lambda: lambda pages: [[_codes(p) for p in pages]], {"codes": "array<bigint>"}, text="html", keep=["key", "url"])
    coded = stored(coded.select("key", F.lower(F.regexp_extract("url", pattern, 1)).alias("host"), F.regexp_extract("url", pattern, 2).alias("path"), "codes")
                   .where("host <> '' AND size(codes) > 0").withColumn("content", F.xxhash64("codes")), "page-lines")
    found = stored(page_differences(coded), "page-differences")
    own = coded.select("key", "host", "content").distinct().join(found, ["host", "content"]).select("key", "shared", "common")
    joined = base.join(own, "key", "left").select("page_id", "url", F.struct("html", "shared", "common").alias("input"))

    def make():
        return lambda rows: [[main_text(r["html"], r["shared"], r["common"]) for r in rows]]

    out = add_columns(joined, make, {"text": "string"}, text="input", keep=["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
