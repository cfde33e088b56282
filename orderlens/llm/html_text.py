"""Main text of web pages by nearest-URL page differencing.

A page becomes text lines, one a block.  Lines in menus, headers, footers, sidebars, notices,
adverts, forms and comments are chrome where an element, a role or a whole class name says so (outside
articles also a whole id).  All other lines of every page are
aligned by longest common subsequence with those of the page's two neighbours, the nearest pages before
and after it in the order of URL paths within its host that have other lines, and what a neighbour shares is site furniture and deleted.  An ``article``
element is judged whole: one with a line of its own keeps all its lines (a licence line or a passage
that two articles share stays), one without is a card that the site repeats and deleted, unless the
page has less text left than its deleted articles hold.  A block whose name has a chrome word for a
part (``share-buttons``, ``social-history``) is unclear: inside an article its lines go one by one if a
neighbour shares them; outside, what is left of it stays only on a page that has no article or main text,
and an ``article`` or ``main`` that it wraps is none of it.

Defined results: a null html is empty; a null url has an empty host and path; pages of a host with the very
same lines (copies) that follow each other have the same neighbours and text; rows repeated whole are pages
of their own; tied and null ids and urls give a row each; pages of any length are read whole; an empty table gives
no rows; only the named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .url_filter import host_of, path_of

#: Element names of HTML, and words by which pages name their parts.
BLOCKS = frozenset("""address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
 optgroup option p pre search section summary table tbody td tfoot th thead title tr ul br""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("""head title script style noscript template nav header footer aside form button select textarea
 dialog menu svg math iframe object canvas audio video map search""".split())
CHROME_WORDS = frozenset("""ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo
 banner nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies
 consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login form search share sharing
 social related recommended comment comments disqus reply replies widget pagination pager skip hidden""".split())
#: Words that inside an article name its own heading.
HEADINGS = frozenset(["header", "masthead"])
#: First words of names that tell what stands beside an element, not what it is.
BESIDE = frozenset("no non not has with without".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: A start tag that ends an open element of these names.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body button div dl fieldset footer form header html main nav ol section table td th ul".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
OPEN, CHROME_LINE, ARTICLE, UNCLEAR = 0, 1, 2, 3
#: Numbers of lines that no article element judges: in unclear blocks outside articles, in main, in unclear blocks of articles.
ASIDE, MAIN, WITHIN = -1, -2, -3
#: Bytes of a line's digest.
DIGEST = 16


class Lines(HTMLParser):
    """Text lines of a page, each with the part of the page it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.units: list[int] = []  # of each line: the number of its innermost article element; ASIDE, MAIN, WITHIN; 0: none
        self.text: list[str] = []
        self.stack: list[tuple[str, int, int]] = []  # (element, part, article)
        self.part, self.unit, self.articles = OPEN, 0, 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            self.text = []
            if line and self.part != CHROME_LINE:
                self.lines.append((line, self.part))
                self.units.append(self.unit)

    def _pop_to(self, size: int) -> None:
        del self.stack[size:]
        _, self.part, self.unit = self.stack[-1] if self.stack else ("", OPEN, 0)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            names = ENDS.get(tag, set()) | ({"p"} if tag not in ("br", "option", "optgroup") else set())
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in names:
                    self._pop_to(i)
                    break
                if self.stack[i][0] in SCOPE and self.stack[i][0] not in names:
                    break
        if tag in VOID:
            return
        part, unit = self.part, self.unit
        if part != CHROME_LINE:
            if tag in ("article", "main"):
                if _is_chrome_itself(attrs):
                    part = CHROME_LINE
                elif tag == "article":
                    self.articles += 1
                    part, unit = ARTICLE, self.articles
                elif part != ARTICLE:
                    part, unit = ARTICLE, MAIN
            elif tag in CHROME and not (tag == "header" and part == ARTICLE):
                part = CHROME_LINE
            elif tag not in ("html", "body"):
                named = _names_chrome(attrs, part == ARTICLE)
                if named == CHROME_LINE:
                    part = CHROME_LINE
                elif named == UNCLEAR and part == OPEN:
                    part, unit = UNCLEAR, ASIDE
                elif named == UNCLEAR and unit > 0 and tag in BLOCKS:
                    unit = WITHIN
        if part != self.part:
            self.flush()
        self.stack.append((tag, part, unit))
        self.part, self.unit = part, unit

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # to browsers, <div/> is an open tag

    def handle_endtag(self, tag):
        block = tag in BLOCKS
        if block:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                if self.stack[i][1] != (self.stack[i - 1][1] if i else OPEN):
                    self.flush()
                self._pop_to(i)
                return
            if not block and name in BLOCKS:
                return

    def handle_data(self, data):
        if self.part != CHROME_LINE:
            self.text.append(data)


def _names_chrome(attrs, inside: bool) -> int:
    """CHROME_LINE if a whole class or id, a role or hiding says so, UNCLEAR if a part of a class or id does,
    else OPEN.  ``inside`` an article, ids are anchors of its text and do not count, nor do names of its heading."""
    found = OPEN
    for k, v in attrs:
        if (k == "class" or k == "id" and not inside) and v:
            for name in v.split():
                parts = [w.lower() for w in PARTS.findall(name)]
                words = CHROME_WORDS - HEADINGS if inside else CHROME_WORDS
                if name.lower() in words or "".join(parts) in words:
                    return CHROME_LINE
                if not words.isdisjoint(parts) and parts[0] not in BESIDE:
                    found = UNCLEAR
        elif k == "role" and v and v.strip().lower() in CHROME_ROLES:
            return CHROME_LINE
        elif k == "hidden" or k == "aria-hidden" and v == "true":
            return CHROME_LINE
    return found


def _is_chrome_itself(attrs) -> bool:
    """An article element may be a reader's comment or an advert: a whole class name says so."""
    return any(k == "class" and v and CHROME_WORDS & set(v.lower().split()) for k, v in attrs)


def page_of(html: str | None) -> Lines:
    page = Lines()
    if html:
        page.feed(html)
        page.close()
        page.flush()
    return page


def lines_of(html: str | None) -> list[tuple[str, int]]:
    """Lines that are not chrome, each with its part; without the unclear ones on a page with an article."""
    lines = page_of(html).lines
    return [x for x in lines if x[1] != UNCLEAR] if any(p == ARTICLE for _, p in lines) else lines


def shared_lines(a: list, b: list) -> set[int]:
    """Indexes of ``a``'s lines in a longest common subsequence with ``b`` (bit-parallel rows)."""
    in_a, in_b = set(a), set(b)
    ia = [i for i, x in enumerate(a) if x in in_b]
    b = [x for x in b if x in in_a]
    if not ia:
        return set()
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for i in ia:
        hit = row & places[a[i]]
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    # bit j of a row is 0 where taking b's line j lengthens the subsequence
    out, i, j = set(), len(ia), len(b)
    while i and j:
        if a[ia[i - 1]] == b[j - 1]:
            out.add(ia[i - 1])
            i, j = i - 1, j - 1
        elif rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
    return out


def deleted_lines(page: list, units: tuple[int, ...], sizes: list[int], neighbours: list[list]) -> set[int]:
    """Indexes of the lines of ``page`` that go: ``units`` are their articles, ``sizes`` their lengths."""
    gone: set[int] = set()
    for other in neighbours:
        gone |= shared_lines(page, other)
    own = {u for i, u in enumerate(units) if u > 0 and i not in gone}
    gone = {i for i in gone if units[i] not in own}
    cards = sum(sizes[i] for i in gone if units[i] > 0)
    if cards > sum(sizes) - sum(sizes[i] for i in gone):
        gone = {i for i in gone if units[i] <= 0}
    if any(u not in (0, ASIDE) and i not in gone for i, u in enumerate(units)):
        gone |= {i for i, u in enumerate(units) if u == ASIDE}
    return gone


def parse_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``lines`` (all that are not chrome) and ``units`` (of each: its article's number, or as in ``Lines``)."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema.fields]
    n = len(keep)

    def parse(batches):
        import pyarrow as pa
        for b in batches:
            found = [page_of(v.as_py()) for v in b.column(n)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array([[x for x, _ in p.lines] for p in found], pa.list_(pa.string())),
                                              pa.array([p.units for p in found], pa.list_(pa.int32()))], names=[*keep, "lines", "units"])

    return pages.select(*keep, pages[html_col].cast("string").alias("_html")).mapInArrow(
        parse, ", ".join([*fields, "lines array<string>", "units array<int>"]))


def _digests(rows: DataFrame) -> DataFrame:
    """``row, host, path, id, units`` of ``rows``, and for ``lines`` their digests (end to end) and lengths:
    pages are aligned by these, texts stay where they are."""
    kept = ["row", "host", "path", "id", "units"]

    def digest(batches):
        import pyarrow as pa
        for b in batches:
            lines = [v.as_py() for v in b.column(len(kept))]
            codes = [b"".join(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=DIGEST).digest() for x in p) for p in lines]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], pa.array(codes, pa.binary()),
                                              pa.array([[len(x) for x in p] for p in lines], pa.list_(pa.int32()))],
                                             names=[*kept, "codes", "sizes"])

    wide = rows.select("row", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "id", "units", "lines")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in wide.drop("lines").schema.fields]
    return wide.mapInArrow(digest, ", ".join([*fields, "codes binary", "sizes array<int>"]))


def _nearest_others(dealt: DataFrame) -> list[tuple[int, int]]:
    """(place, range it goes to): for each range the nearest row before it that is not of its first run, and the
    nearest after it that is not of its last.  The driver gets one small row a range."""
    keyed = dealt.select("part", "place", F.sha2(F.concat_ws("|", F.sha2("host", 256), F.hex("codes")), 256).alias("run"))
    found = keyed.groupBy("part").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.min_by("run", "place").alias("first_run"),
                                      F.max_by("run", "place").alias("last_run"))
    marks = sorted(found.collect(), key=lambda r: r["part"])
    if len(marks) < 2:
        return []
    of = F.broadcast(dealt.sparkSession.createDataFrame([(r["part"], r["first_run"], r["last_run"]) for r in marks],
                                                        "part int, first_run string, last_run string"))
    inner = keyed.join(of, "part").groupBy("part").agg(
        F.max(F.when(F.col("run") != F.col("last_run"), F.col("place"))).alias("before_last"),
        F.min(F.when(F.col("run") != F.col("first_run"), F.col("place"))).alias("after_first"))
    other = {r["part"]: r for r in inner.collect()}
    out = []
    for ranges, mine, theirs, at, inside in ((marks, "first_run", "last_run", "last", "before_last"),
                                             (marks[::-1], "last_run", "first_run", "first", "after_first")):
        found = None  # the nearest for the range before
        for a, b in zip(ranges, ranges[1:]):
            if a[theirs] != b[mine]:
                found = a[at]
            elif other[a["part"]][inside] is not None:
                found = other[a["part"]][inside]
            # else all of a is one run, which goes on in b
            if found is not None:
                out.append((found, b["part"]))
    return out


def _differenced(rows: DataFrame) -> DataFrame:
    """(row, keep) of the rows that lose a line: whether each line stays.

    Rows are dealt to ranges of (host, path).  A run is what follows each other with equal lines within a host;
    its rows share their neighbours.  Each range also gets the nearest row before it that is not of its first run
    and the nearest after it that is not of its last, so neighbours meet wherever a range or a run is cut,
    and a large host is spread."""
    order = ["host", "path", "id"]
    dealt = (_digests(rows).repartitionByRange(*order).sortWithinPartitions(*order)
             .select("row", "host", "units", "codes", "sizes", F.spark_partition_id().alias("part"),
                     F.monotonically_increasing_id().alias("place")))
    dealt = written(dealt, "url-order")  # the numbers stay as written
    nearby = _nearest_others(dealt)
    dealt = dealt.withColumn("wanted", F.lit(True))
    if nearby:
        steps = rows.sparkSession.createDataFrame(nearby, "place long, to int")
        context = dealt.join(F.broadcast(steps), "place").withColumn("part", F.col("to")).withColumn("wanted", F.lit(False))
        dealt = dealt.unionByName(context.drop("to"))

    def difference(batches):
        import pyarrow as pa
        types = pa.schema([("row", pa.int64()), ("keep", pa.list_(pa.bool_()))])

        def lines(run):
            return [run["codes"][i:i + DIGEST] for i in range(0, len(run["codes"]), DIGEST)]

        def runs():
            """The first row of each run of a range, with all its wanted rows' numbers by their units."""
            run = None
            for b in batches:
                for r in b.to_pylist():
                    if run is None or any(r[k] != run[k] for k in ("part", "host", "codes")):
                        if run is not None:
                            yield run
                        run = r | {"rows": {}}
                    if r["wanted"]:
                        run["rows"].setdefault(tuple(r["units"]), []).append(r["row"])
            if run is not None:
                yield run
            yield None

        before, here = None, None
        out: list[dict] = []
        for after in runs():
            if here is not None and here["rows"]:
                near = [lines(x) for x in (before, after)
                        if x is not None and x["host"] == here["host"] and x["part"] == here["part"]]
                page = lines(here)
                for units, members in here["rows"].items():
                    gone = deleted_lines(page, units, here["sizes"], near)
                    keep = [i not in gone for i in range(len(page))]
                    for row in members if gone else ():
                        out.append({"row": row, "keep": keep})
                        if len(out) >= 256:
                            yield pa.RecordBatch.from_pylist(out, schema=types)
                            out = []
            before, here = here, after
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=types)

    # a context row goes before or after the range's own by its place
    return (dealt.repartition("part").sortWithinPartitions("part", "place")
            .mapInArrow(difference, "row long, keep array<boolean>"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    parsed = written(parse_pages(rows, "html", ("id", "url")).withColumn("row", F.monotonically_increasing_id()), "parsed")
    kept = written(_differenced(parsed.filter(F.size("lines") > 0)), "kept-lines")
    text = F.array_join(F.filter("lines", lambda _, i: F.coalesce(F.get("keep", i), F.lit(True))), "\n")
    return (parsed.join(kept, "row", "left").withColumn("text", text)
            .select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")))
