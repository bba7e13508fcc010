"""Main text of HTML pages: markup for what is explicit, a host-wide suffix
array for what is not.

A small per-page parser yields the page's visible blocks in order (scripts,
styles, comments, forms, head and hidden parts leave none), each with its
place: ``body`` inside an ``article`` or ``main`` element, ``chrome`` inside
navigation, page header or footer, sidebar, notice, advert, form or reader
comments, ``open`` elsewhere. White space inside a block becomes one space;
character references are decoded.

A page with ``body`` blocks has named its main text: all of it is kept,
however often it recurs on other pages. What stands outside is decided by
the host, on every page: the token streams of its pages (without body blocks) are put
together and their suffixes grouped by host and first ``LONG`` tokens. That
is a suffix array to the depth of LONG: its order inside the cluster is by
hash, and equal keys meet, which is all that a repeat of LONG tokens needs;
longer repeats are runs of such keys. A key that ``PAGES`` distinct pages of
the host have (both pages, of a host with two) covers its tokens. A block of
which all tokens are covered is boilerplate and goes; the other ``open``
blocks are kept whole, on pages that name a main text in their place before,
between or after it, so a quotation inside a
paragraph stays, and so does a passage that only two of many pages share. A
stream shorter than LONG is compared as a whole. Chrome blocks take part, so
that a menu that one page does not mark up goes with its marked-up copies;
they are never kept themselves.

Attributes are read as names and values (an unquoted value ends at white
space or ``>``; a quote that is never closed opens nothing). Only an
attribute *named* hidden hides. Outside the main part a class, id or role
names chrome by any of its words; inside it only if all its words do
(``related-posts``, not ``related-work``), and the id of a heading never.

Nulls: a null html or one without text gives ''; a null or hostless url
is a host of its own name (''). A page is known by the text of its blocks
outside chrome, whatever its url, so copies, mirrors and print views of it
do not make its text boilerplate.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LONG = 6  # tokens of a substring that counts as repeated
PAGES = 3  # distinct pages of a host that have it
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: elements whose content is never text of the page
SILENT = frozenset("script style noscript template iframe object svg canvas select textarea button form head title datalist dialog audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CHROME = frozenset("nav footer aside menu".split())
#: words of class, id or role that name a part outside the main text
CHROME_NAME = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|contentinfo|cookies?|consent|disqus|footer|masthead|menu|nav|navbar|navigation|newsletter|notices?|popup|promo|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[_-])",
    re.IGNORECASE,
)
#: names of which all words are of a part outside the main text, or of a box
CHROME_WHOLE = re.compile(
    r"(?:(?:ads?|advert\w*|banner|breadcrumbs?|comments?|contentinfo|complementary|cookies?|consent|disqus|footer|masthead|menu|nav|navbar|navigation|newsletter|notices?|popup|promo|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget|articles?|area|bar|block|box|buttons?|container|form|icons?|links?|list|posts?|section|signup|slot|stories|thread|unit|wrapper)(?:[_-]|$))+",
    re.IGNORECASE,
)
#: words of boxes alone name nothing
BOX_ONLY = re.compile(
    r"(?:(?:articles?|area|bar|block|box|buttons?|container|form|icons?|links?|list|posts?|section|signup|slot|stories|thread|unit|wrapper)(?:[_-]|$))+",
    re.IGNORECASE,
)
#: names that speak of another part ("no-sidebar", "has-comments")
ABOUT = re.compile(r"(?:no|not|has|have|with|without|hide|show|is)[_-]", re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
DISPLAY_NONE = re.compile(r"display\s*:\s*none", re.IGNORECASE)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[\s/]+|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)*))[^>]*(?:>|$)",
    re.DOTALL,
)
SPACE = re.compile(r"\s+")
BODY, OPEN, OFF = "body", "open", "chrome"


def _attributes(shown: str) -> dict[str, str]:
    """The attributes of a tag by lower-case name; of equal ones the first."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(shown):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(DISPLAY_NONE.search(attrs.get("style", "")))


def _place(tag: str, attrs: dict[str, str], inside: str) -> str:
    """The place of what stands in an element."""
    names = [n for key in ("class", "id", "role") if key != "id" or tag not in HEADINGS for n in attrs.get(key, "").split() if not ABOUT.match(n)]
    if tag in ("article", "main"):
        named = any(n.lower() in ("ad", "advert", "comment", "comments", "promo", "related") for n in names)
    elif inside == BODY:
        named = any(CHROME_WHOLE.fullmatch(n) and not BOX_ONLY.fullmatch(n) for n in names)
    else:
        named = tag not in ("html", "body") and any(CHROME_NAME.search(n) for n in names)
    if inside == OFF or tag in CHROME or tag in SILENT or named or _hidden(attrs):
        return OFF
    if tag == "header":
        return inside if inside == BODY else OFF
    if tag in ("article", "main") or attrs.get("role", "").lower() == "main":
        return BODY
    return inside


def blocks(html: str | None) -> list[tuple[str, str]]:
    """(place, text) of the page's blocks, in order."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str, bool]] = [("", OPEN, False)]  # tag, place, silent
    page, at = html or "", 0

    def flush() -> None:
        if held:
            text = SPACE.sub(" ", unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((stack[-1][1], text))

    while at < len(page):
        m = TOKEN.search(page, at)
        cut = m.start() if m else len(page)
        if cut > at and not stack[-1][2]:
            held.append(page[at:cut])
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag closes the innermost element of its name
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if any(t in BLOCKS or stack[depth][1] != stack[depth - 1][1] for t, _, _ in stack[depth:]):
                        flush()
                    del stack[depth:]
                    break
            else:
                if tag in BLOCKS:
                    flush()
            continue
        shown = m[3] or ""
        attrs = _attributes(shown) if shown else {}
        if tag == "br":
            held.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            flush()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd"):  # these end an open one of their kind
                kinds = {"li": ("li", "p"), "p": ("p",), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p")}.get(tag, ("dt", "dd", "p"))
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in kinds:
                        del stack[depth:]
                        break
                    if stack[depth][0] in ("ul", "ol", "table", "dl", "div", "article", "main", "section", "body", "blockquote"):
                        break
        place = _place(tag, attrs, stack[-1][1])
        if place != stack[-1][1]:
            flush()
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if shown.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, place, stack[-1][2] or tag in SILENT or _hidden(attrs)))
    flush()
    return out


def _key(tokens: list[str]) -> bytes:
    return hashlib.blake2b("\0".join(tokens).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def suffixes(found: list[dict]) -> Iterator[tuple[bytes, int]]:
    """(key, place in the stream) of a page's suffixes: the tokens of its
    blocks outside body, one after the other."""
    stream = [w for b in found if b["place"] != BODY for w in b["text"].split(" ")]
    for at in range(max(1, len(stream) - LONG + 1) if stream else 0):
        yield _key(stream[at : at + LONG]), at


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, pkey of the html, tkey of the text that is not
    chrome, blocks array of (place, text))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("place", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                shown = [[{"place": p, "text": t} for p, t in blocks(h)] for h in part.column(4).to_pylist()]
                tkeys = [_key([w for b in own if b["place"] != OFF for w in b["text"].split(" ")]) for own in shown]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(tkeys, pa.binary()), pa.array(shown, kind)], names=["page_id", "url", "host", "pkey", "tkey", "blocks"])

    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    pkey = F.unhex(F.md5(F.coalesce("html", F.lit(""))))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", host.alias("host"), pkey.alias("pkey"), "html").mapInArrow(run, f"page_id {kind}, url string, host string, pkey binary, tkey binary, blocks array<struct<place:string,text:string>>")


def suffix_array(pages: DataFrame) -> DataFrame:
    """(host, pkey, tkey, key, at): each page's suffixes outside body."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                rows = [(h, p, t, k, at) for h, p, t, own in zip(*[c.to_pylist() for c in batch.slice(lo, 1000).columns], strict=True) for k, at in suffixes(own)]
                kinds = (pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["host", "pkey", "tkey", "key", "at"])

    return pages.select("host", "pkey", "tkey", "blocks").mapInArrow(run, "host string, pkey binary, tkey binary, key binary, at int")


def repeated(pages: DataFrame) -> DataFrame:
    """(host, key) of the suffixes that enough distinct pages of a host have."""
    found = suffix_array(pages).groupBy("host", "key", "tkey").agg(F.lit(1).alias("one"))
    counts = found.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_host = pages.groupBy("host", "tkey").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    return counts.join(of_host, "host").where((F.col("n") >= PAGES) | (F.col("n") == F.col("all"))).select("host", "key")


def main_text(pages: DataFrame, shared: DataFrame) -> DataFrame:
    """(page_id, url, text): the body blocks of each page and its open blocks,
    less those that ``shared`` covers whole. Copies of a page have the same
    places, each once; a page without open blocks has nothing to be judged."""
    judged = pages.where(F.exists("blocks", lambda b: b["place"] == OPEN))
    covers = suffix_array(judged).join(shared, ["host", "key"], "left_semi").groupBy("host", "pkey").agg(F.collect_set("at").alias("covers"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for own, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                gone = {i for at in starts or () for i in range(at, at + LONG)}
                left, at = [], 0
                for b in own:
                    if b["place"] == BODY:
                        left.append(b["text"])
                        continue
                    tokens = b["text"].split(" ")
                    if b["place"] == OPEN and not all(i in gone for i in range(at, at + len(tokens))):
                        left.append(b["text"])
                    at += len(tokens)
                texts.append("\n".join(left))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    both = judged.join(covers, ["host", "pkey"], "left").select("page_id", "url", "blocks", "covers")
    body = F.transform(F.filter("blocks", lambda b: b["place"] == BODY), lambda b: b["text"])
    marked = pages.where(~F.exists("blocks", lambda b: b["place"] == OPEN)).select("page_id", "url", F.array_join(body, "\n").alias("text"))
    return marked.unionByName(both.mapInArrow(keep, f"page_id {kind}, url string, text string"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``."""
    found = stored(page_blocks(pages), "blocks")
    shared = stored(repeated(found), "suffixes")
    out = main_text(found, shared)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
