"""Main text of web pages by wrapper induction.

A page's elements are merged by path: siblings with the same key (tag and class) are one slot. The pages of a host are
aligned to its commonest shape by simple tree matching. All slots are counted, whatever they are called: those whose text is the
same on the host's pages become template, varying ones content. Slots that pages fill with a varying number of small records
beside the main text (reader comments, teasers) go too. Tags, and names that are telling as whole words, settle what counts
leave open: an advert that changes with every page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiq.llm.common import materialize

LEAST_PAGES = 3  # on which a slot must be the same before it is template
_BROADCAST_CHARS = 4_000_000

# Elements by their use in HTML.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small "
                    "span strike strong sub sup time tt u var".split())
_NEVER = frozenset("head title script style noscript template iframe object svg canvas audio video nav aside form button select "
                   "textarea label fieldset footer dialog menu map".split())
_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
_HEAD_HOLDERS = frozenset("title style script noscript template".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption caption".split())
_ROOTS = frozenset("article main".split())
_CLOSED_BY_NEXT = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "td": "table", "th": "table", "tr": "table", "option": "select"}
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie "
                   "cookies consent gdpr notice notices alert popup modal overlay sidebar sidebars aside menu menus nav navbar "
                   "navigation breadcrumb breadcrumbs pagination pager footer comment comments disqus replies respond share sharing "
                   "social related recommended newsletter subscribe subscription widget widgets toolbar search login signup".split())
_PAGE_NAMES = frozenset("header masthead topbar".split())
# What may stand beside a telling part in a name like "site-footer" without changing what it says.
_PLAIN_PARTS = frozenset("area bar block bottom box container content global group inner item items left links list main outer page "
                         "panel primary right secondary section site slot text thread top unit wrap wrapper zone".split())
_PHRASAL = frozenset("label button".split())
_RECORDS = frozenset("div section li".split())
_SHORT = 40  # characters of the line that opens a record, on average
_USES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_PIECE = re.compile("[a-z]+")


def telling(token: str, names: frozenset) -> bool:
    """Whether a class or id says what its element is for: a listed word, alone or with words that say nothing else.

    "related-work", "notice-of-appeal" and "has-sidebar" are names of something else.
    """
    parts = _PIECE.findall(token)
    return any(p in names for p in parts) and all(p in names or p in _PLAIN_PARTS for p in parts)


class Page(HTMLParser):
    """A page as merged slots and blocks of text in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.keys, self.parents, self.children = ["page"], [-1], {}
        self.times = [1]  # elements of each slot
        self.rooted = [False]
        self.blocks: list[tuple[int, bool, bool, str]] = []  # slot, unwanted, inside a content root, text
        self._open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self._text: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag not in _HEAD:
            self._end_head(tag == "body")
        if tag in _VOID:
            self._text.append(" ")
            if tag not in ("br", "wbr", "img", "input"):
                self._flush()
            return
        names = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "hidden", "itemprop", "aria-hidden")}
        if tag not in _INLINE and not (tag in _PHRASAL and self._in_paragraph()):
            self._flush()
            self._close_before(tag)
        _, slot, unwanted, inside = self._open[-1]
        if tag in _PHRASAL and "hidden" not in names and self._in_paragraph():
            self._open.append((tag, slot, unwanted, inside))
            return
        tokens = f"{names.get('class', '')} {names.get('id', '')}".split()
        # Headings and paragraphs of a content root are content, whatever they are called.
        named = not (inside and tag in _PARAGRAPHS) and any(telling(t, _NAMES) for t in tokens)
        marked = (tag in _NEVER or named or names.get("role") in _USES or "hidden" in names
                  or names.get("aria-hidden") == "true")
        root = tag in _ROOTS or names.get("role") == "main" or names.get("itemprop") == "articlebody"
        marked |= not inside and (tag == "header" or any(telling(t, _PAGE_NAMES) for t in tokens))
        if marked and tag in {"html", "body", *_ROOTS}:
            marked = "hidden" in names
        if marked and not unwanted:
            self._flush()
        if tag not in _INLINE:
            key = ".".join([tag, *sorted(set(_PIECE.findall(names.get("class", ""))))[:3]])
            found = self.children.get((slot, key))
            if found is None:
                found = self.children[slot, key] = len(self.keys)
                self.keys.append(key)
                self.parents.append(slot)
                self.rooted.append(inside or root)
                self.times.append(0)
            slot = found
            self.times[slot] += 1
        self._open.append((tag, slot, unwanted or marked, inside or root))

    def _in_paragraph(self) -> bool:
        """Whether text here belongs to an open paragraph: a label or button in it is a part of the sentence."""
        for name, _, unwanted, _ in reversed(self._open):
            if name not in _INLINE and name not in _PHRASAL:
                return name in _PARAGRAPHS and not unwanted
        return False

    def _end_head(self, always):
        """End an open head, whose end tag may be left out; not from within what can stand in one, unless ``always``."""
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name == "head":
                self._flush()
                del self._open[i:]
                return
            if name == "body" or (name in _HEAD_HOLDERS and not always):
                return

    def _close_before(self, tag):
        """End what this element cannot be inside: a paragraph; of lists and tables, the item before."""
        limit = _CLOSED_BY_NEXT.get(tag)
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name == "p":
                del self._open[i:]
                break
            if name not in _INLINE:
                break
        if limit:
            for i in range(len(self._open) - 1, 0, -1):
                name = self._open[i][0]
                if name in limit.split():
                    break
                if name == tag or {name, tag} in ({"dt", "dd"}, {"td", "th"}) or (tag == "tr" and name in ("td", "th")):
                    del self._open[i:]
                    if tag != "tr" or name == "tr":
                        break

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self._text.append(" ")
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i][0] == tag:
                same = self._open[i][2] == self._open[i - 1][2]
                if not (same and (tag in _INLINE or tag in _PHRASAL)):
                    self._flush()
                del self._open[i:]
                return
            if tag in _INLINE and self._open[i][0] not in _INLINE:
                return

    def handle_data(self, data):
        if self._open[-1][0] == "head" and not data.isspace():
            self._end_head(False)
        self._text.append(data)

    def finish(self) -> Page:
        self.close()
        self._flush()
        return self

    def _flush(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            self._text = []
            if text:
                _, slot, unwanted, inside = self._open[-1]
                self.blocks.append((slot, unwanted, inside, text))

    def shape(self) -> str:
        """The slots as text, a child list in brackets behind each key; slots are numbered in order of appearance."""
        return "|".join(f"{p}>{k}" for p, k in zip(self.parents[1:], self.keys[1:]))


def parse(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    return page.finish()


def tree_of(shape: str) -> tuple[list[str], list[list[int]]]:
    """Keys and children of a shape's slots."""
    keys, children = ["page"], [[]]
    for item in shape.split("|") if shape else []:
        parent, _, key = item.partition(">")
        children[int(parent)].append(len(keys))
        keys.append(key)
        children.append([])
    return keys, children


def align(shape: str, reference: str) -> dict[int, int]:
    """Simple tree matching: the slots of one shape that correspond to slots of another, order kept, as many as can be."""
    keys_a, below_a = tree_of(shape)
    keys_b, below_b = tree_of(reference)
    scores: dict[tuple[int, int], int] = {}

    def table(a: int, b: int) -> list[list[int]]:
        rows = [[0] * (len(below_b[b]) + 1) for _ in range(len(below_a[a]) + 1)]
        for i, x in enumerate(below_a[a], 1):
            for j, y in enumerate(below_b[b], 1):
                rows[i][j] = max(rows[i - 1][j], rows[i][j - 1], rows[i - 1][j - 1] + scores.get((x, y), 0))
        return rows

    # Children have larger numbers than their parents, so pairs are done from the back.
    by_key: dict[str, list[int]] = {}
    for b in range(len(keys_b)):
        by_key.setdefault(keys_b[b], []).append(b)
    for a in range(len(keys_a) - 1, -1, -1):
        for b in by_key.get(keys_a[a], ()):
            scores[a, b] = 1 + table(a, b)[-1][-1]
    found, pending = {}, [(0, 0)]
    while pending:
        a, b = pending.pop()
        found[a] = b
        rows = table(a, b)
        i, j = len(below_a[a]), len(below_b[b])
        while i and j:
            x, y = below_a[a][i - 1], below_b[b][j - 1]
            if (x, y) in scores and rows[i][j] == rows[i - 1][j - 1] + scores[x, y]:
                pending.append((x, y))
                i, j = i - 1, j - 1
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return found


def record_slots(reference: str, stats: list[dict], template: set[int]) -> set[int]:
    """The slots of a reference that hold small records in varying number: comments, teasers.

    A record is an element of its own that opens with a short line which is no heading and has more text behind it; some page
    has several, another has more or fewer. A slot with half of the text that isn't template is the main text instead,
    and nothing inside a content root is a record.
    """
    keys, children = tree_of(reference)
    known = {r["slot"]: r for r in stats}
    rooted, below = [False] * len(keys), [0] * len(keys)
    for slot in range(len(keys)):
        own = known.get(slot)
        below[slot] = own["chars"] if own and slot not in template else 0
        for child in children[slot]:
            rooted[child] = rooted[slot] or keys[child].partition(".")[0] in _ROOTS
    for slot in range(len(keys) - 1, -1, -1):
        below[slot] += sum(below[c] for c in children[slot])
    found = set()
    for slot, own in known.items():
        tag = keys[slot].partition(".")[0]
        if rooted[slot] or tag not in _RECORDS or own["most"] < 2 or own["fewest"] == own["most"] or 2 * below[slot] >= below[0]:
            continue
        parts = [(own["chars"], "")] if own["chars"] else []
        parts += [(known[c]["chars"], keys[c].partition(".")[0]) for c in children[slot] if c in known and known[c]["chars"]]
        if len(parts) > 1 and not re.fullmatch("h[1-6]", parts[0][1]) and parts[0][0] <= _SHORT * own["times"]:
            found.add(slot)
    return found


def main_text(page: Page, template: set[int], records: frozenset | set = frozenset()) -> str:
    """The wanted blocks outside template and records, inside the content root where there is one, with blank lines between.

    A template slot takes what is below along only where all text there is template too; records go whole.
    """
    rooted = any(inside and not unwanted for _, unwanted, inside, _ in page.blocks)
    constant = [True] * len(page.keys)  # whether every text in or below a slot is template
    for slot, unwanted, _, _ in page.blocks:
        constant[slot] &= unwanted or slot in template
    for slot in range(len(page.keys) - 1, 0, -1):
        constant[page.parents[slot]] &= constant[slot]
    fixed, whole = [False] * len(page.keys), [False] * len(page.keys)
    for slot in range(1, len(page.keys)):
        # Paragraphs of a content root are content even where pages repeat them.
        safe = page.rooted[slot] and page.keys[slot].partition(".")[0] in _PARAGRAPHS | _ROOTS
        own = slot in template and not safe
        whole[slot] = whole[page.parents[slot]] or (own and constant[slot]) or (slot in records and not page.rooted[slot])
        fixed[slot] = own or whole[slot]
    return "\n\n".join(text for slot, unwanted, inside, text in page.blocks
                       if not unwanted and not fixed[slot] and (inside or not rooted))


_SLOTS = "array<struct<slot: int, digest: long, chars: long, times: long>>"
_SLOT = pa.list_(pa.struct([("slot", pa.int32()), ("digest", pa.int64()), ("chars", pa.int64()), ("times", pa.int64())]))


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, shape, slots) of every page: for each slot the digest and size of its own text, and its number of elements.

    All text counts, wanted or not. Slot 0 stands for the page; ``page`` is a digest of its wanted text, so that copies which
    differ in their adverts are one page.
    """
    for batch in batches:
        pages, shapes, slots = [], [], []
        for html in batch.column(1):
            page = parse(html.as_py())
            texts: list[list[str]] = [[] for _ in page.keys]
            for slot, _, _, text in page.blocks:
                texts[slot].append(text)
            shapes.append(page.shape())
            slots.append([(slot, xxhash.xxh64_intdigest("\n".join(parts)) >> 1, sum(map(len, parts)), page.times[slot])
                          for slot, parts in enumerate(texts)])
            wanted = "\n".join(f"{slot} {text}" for slot, unwanted, _, text in page.blocks if not unwanted)
            pages.append(xxhash.xxh64_intdigest(f"{shapes[-1]}\n{wanted}") >> 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(pages, pa.int64()), pa.array(shapes, pa.string()), pa.array(slots, _SLOT)],
            ["host", "page", "shape", "slots"])


_COUNTS = ["pages", "low", "high", "chars", "times", "fewest", "most"]


def _aligned_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of (host, shape, slot, counts, reference) as slots of the reference; those without a match are left out."""
    known: dict[tuple[str, str], dict[int, int]] = {}
    for batch in batches:
        shapes, slots, references = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("shape", "slot", "reference"))
        keep, to = [], []
        for i, (shape, slot, reference) in enumerate(zip(shapes, slots, references)):
            if (shape, reference) not in known:
                if len(known) > 1000:
                    known.clear()
                known[shape, reference] = align(shape, reference)
            if slot in known[shape, reference]:
                keep.append(i)
                to.append(known[shape, reference][slot])
        at = pa.array(keep, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(batch.schema.get_field_index(n)).take(at) for n in ("host", *_COUNTS)), pa.array(to, pa.int32())],
            ["host", *_COUNTS, "slot"])


def host_of(url):
    """A URL's host in lower case; empty for a null or odd one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def induce(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, reference, template, stats): each host's commonest shape, the slots of it that are template, and counts of all.

    A slot is template if it holds the same text on all pages that have it, at least ``LEAST_PAGES``, while another slot of
    the host varies. Copies of a page count once. Counts and least and greatest digests are aggregated, so a host with very many pages is no bottleneck.
    """
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    different = rows.mapInArrow(_slot_rows, f"host string, page long, shape string, slots {_SLOTS}").groupBy(
        "host", "page").agg(F.first(F.struct("shape", "slots")).alias("one"))
    slots = different.select("host", "one.shape", F.inline("one.slots"))
    seen = materialize(slots.groupBy("host", "shape", "slot").agg(
        F.count("*").alias("pages"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.sum("chars").alias("chars"),
        F.sum("times").alias("times"), F.min("times").alias("fewest"), F.max("times").alias("most")), "slots")
    references = seen.where("slot = 0").groupBy("host").agg(
        F.max(F.struct("pages", F.col("shape").alias("reference"))).alias("top"), F.sum("pages").alias("all")).select(
        "host", "top.reference", "all")
    merged = (seen.join(references.drop("all"), "host").mapInArrow(
        _aligned_rows, "host string, pages long, low long, high long, chars long, times long, fewest long, most long, slot int")
        .groupBy("host", "slot").agg(
            F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("chars").alias("chars"),
            F.sum("times").alias("times"), F.min("fewest").alias("fewest"), F.max("most").alias("most")))
    same = (F.col("low") == F.col("high")) & (F.col("pages") >= LEAST_PAGES) & (F.col("slot") > 0) & (F.col("chars") > 0)
    fixed = merged.groupBy("host").agg(
        F.collect_set(F.when(same, F.col("slot"))).alias("template"), F.max((F.col("low") != F.col("high")) & (F.col("slot") > 0)).alias("varies"),
        F.collect_list(F.struct("slot", "pages", "chars", "times", "fewest", "most")).alias("stats"))
    none = F.array().cast("array<int>")
    # A page without a slot has no element of it.
    stats = F.transform("stats", lambda s: s.withField("fewest", F.when(s["pages"] < F.col("all"), 0).otherwise(s["fewest"])))
    return materialize(references.join(fixed, "host", "left").select(
        "host", "reference", F.when(F.col("varies"), F.col("template")).otherwise(none).alias("template"), stats.alias("stats")), "wrappers")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) of every page; the text is empty where nothing is left.

    A null or empty page has an empty text; pages with a null url share a host of their own; repeated rows each keep
    their row. Truncated pages are read as far as they go.
    """
    wrappers = induce(pages, url, html)
    size = wrappers.agg(F.sum(F.length("reference") + 8 * F.size("template") + 48 * F.size("stats") + 100)).first()[0] or 0
    if size <= _BROADCAST_CHARS:
        wrappers = F.broadcast(wrappers)
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn(
        "host", host_of(F.col("url")))
    joined = rows.join(wrappers, "host", "left").select("id", "url", "html", "host", "reference", "template", "stats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], dict[int, int]] = {}
        induced: dict[str, tuple[str | None, set[int], set[int]]] = {}
        for batch in batches:
            out = []
            for row, (html_text, host) in enumerate(zip(batch.column(2), batch.column(3).to_pylist())):
                if host not in induced:
                    if len(induced) > 1000:
                        induced.clear()
                    reference, template, stats = (batch.column(i)[row].as_py() for i in (4, 5, 6))
                    template = set(template or ())
                    induced[host] = reference, template, record_slots(reference, stats, template) if reference and stats else set()
                reference, template, repeated = induced[host]
                page = parse(html_text.as_py())
                fixed, records = set(), set()
                if template or repeated:
                    shape = page.shape()
                    if (shape, reference) not in known:
                        if len(known) > 1000:
                            known.clear()
                        known[shape, reference] = align(shape, reference)
                    to = known[shape, reference]
                    fixed = {a for a, b in to.items() if b in template}
                    records = {a for a, b in to.items() if b in repeated}
                out.append(main_text(page, fixed, records))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], [key, "url", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return joined.mapInArrow(run, f"`{key}` {kind}, url string, text string")
