"""Operator 5: main text of web pages by site template removal.

Each page is tokenised once.  Structure rules leave out what is never article
text (scripts, menus, forms, ..., and elements whose class, id or role names
such a part).  Every container's and every prose element's subtree (tags
and text) is hashed.  Spark counts, per host, on how many different main texts'
pages a subtree occurs.  Main texts that are equal or nearly equal count once:
they meet in bands of min-hashes of their word pairs, links are kept where the
whole signatures agree to ``NEAR``, and linked texts are one group.  Site
template is, and is deleted with its blocks, a container (div, section, list,
...) on ``min_pages`` or more groups, and a prose element (p, heading, quote,
...) on ``prose_pages`` or more, if these are also at least ``share`` of the
host's groups: a passage, list or table that many articles share is no template.

Templates are counted and deleted on the whole page.  Of the blocks left, those
in article elements are the text where they hold at least ``ARTICLE`` of the
characters left (in main, if the page has such text); else all blocks left (in
main) are: an article element that is only a teaser does not displace the body.

Blocks end at block-level tags; white space inside a block (``<br>`` too)
becomes one space; character references are decoded; blocks are joined by one
newline in page order.

Defined cases: null or empty html gives an empty text of 0 characters; pages
without a host are not compared with others; unclosed tags, comments and quotes
run to the end of the page; a block names at most the ``MAX_AROUND`` innermost
containers and prose elements around it, all elements are followed at any depth;
repeated rows give equal texts; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, slices, stored
from tessera.llm.components import components

MAX_AROUND = 512
#: Min-hashes of a main text: bands of so many rows; of near-equal texts this share agrees at least.
BANDS, BAND_ROWS, NEAR = 20, 6, 0.76
#: Where a block stands (flags), and the share of the text that article elements must hold to be all of it.
IN_MAIN, IN_ARTICLE, ARTICLE = 1, 2, 1 / 3
_HASHES = np.random.default_rng(5).integers(0, 1 << 64, size=(2, BANDS * BAND_ROWS, 1), dtype=np.uint64) | np.uint64(1)
TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
                 r"""(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z)))""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
SPLIT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Never article text, wherever it stands.
LEFT_OUT = frozenset("""aside audio button canvas datalist dialog fieldset footer form head iframe input label math
menu nav noembed noframes noscript object option script select style svg template textarea title video""".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search
section summary table tbody td tfoot th thead tr ul""".split())
CONTAINER = frozenset("aside details div dl footer form header nav ol section table ul figure menu center".split())
PROSE = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
#: A start tag ends an open element of these (and what is open inside it), up to the element that bounds the search.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"), "option": ("option",)}
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
          "tbody": ("table",), "option": ("select", "datalist")}
#: Words of class, id or role that name a part which is not article text.
PARTS = frozenset("""ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted
banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended
recommendations share sharing social footer toolbar pagination pager skip search complementary contentinfo masthead
comment comments disqus reply replies respond discussion""".split())
COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())


class _Open:
    """An element that is not closed yet."""

    __slots__ = ("digest", "out", "parts", "place", "tag")

    def __init__(self, tag: str, out: bool, place: int):
        self.tag, self.out, self.place = tag, out, place  # out: left out; place: flags
        self.parts: list[str] = []
        self.digest = 0


def _names_part(attrs: str, among: frozenset) -> bool:
    for m in ATTR.finditer(attrs):
        k = m[1].lower()
        if k in ("class", "id", "role") and m[2]:
            if any(w.lower() in among for w in SPLIT.split(m[2].strip("\"'")) if w):
                return True
        elif k == "hidden" or k == "style" and m[2] and "display:none" in m[2].replace(" ", "").lower():
            return True
    return False


def page_blocks(html: str) -> tuple[list[tuple[str, int, list[int]]], dict[int, bool]]:
    """All blocks that are not left out, with the flags of their place and the subtree digests of
    the containers and prose elements they stand in; and the digests of all such elements with
    text, True for prose."""
    root = _Open("", False, 0)
    stack = [root]
    around: list[_Open] = []  # the open containers and prose elements
    opened: Counter = Counter()  # how many elements of each tag are open
    blocks: list[tuple[str, int, list[_Open]]] = []
    text: list[str] = []
    seen: dict[int, bool] = {}

    def end_block() -> None:
        if text:
            s = " ".join("".join(text).split())
            text.clear()
            if s:
                blocks.append((s, stack[-1].place, around[-MAX_AROUND:]))

    def close(n: int) -> None:
        """Close the elements above the first ``n``."""
        while len(stack) > n:
            if stack[-1].tag in BLOCK:
                end_block()
            e = stack.pop()
            opened[e.tag] -= 1
            if around and around[-1] is e:
                around.pop()
            if e.parts:
                e.digest = xxhash.xxh64_intdigest("\x00".join([e.tag, *e.parts])) - (1 << 63)
                stack[-1].parts.append(f"<{e.digest}>")
                if e.tag in CONTAINER or e.tag in PROSE:
                    seen[e.digest] = e.tag in PROSE

    def add(s: str) -> None:
        if s:
            s = unescape(s)
            if w := " ".join(s.split()):
                stack[-1].parts.append(w)
            if not stack[-1].out:
                text.append(s)

    pos, size = 0, len(html)
    while pos < size:
        m = TAG.search(html, pos)
        if m is None:
            add(html[pos:])
            break
        add(html[pos:m.start()])
        pos = m.end()
        tag = m["name"] and m["name"].lower()
        if not tag:
            continue
        if m["end"]:
            if opened[tag]:
                close(next(n for n in range(len(stack) - 1, 0, -1) if stack[n].tag == tag))
            elif tag in BLOCK:
                end_block()
            continue
        if tag == "br":
            if not stack[-1].out:
                text.append(" ")
            continue
        if tag in BLOCK:
            for n in range(len(stack) - 1 if opened["p"] else 0, 0, -1):  # a block ends an open paragraph
                if stack[n].tag == "p":
                    close(n)
                    break
                if stack[n].tag in BLOCK:
                    break
            end_block()
        if tag in ENDS:
            for n in range(len(stack) - 1, 0, -1):
                if stack[n].tag in ENDS[tag]:
                    close(n)
                    break
                if stack[n].tag in BOUNDS[tag]:
                    break
        if tag in VOID or m["attrs"].endswith("/>") and tag not in BLOCK:
            continue
        up = stack[-1]
        out = up.out or tag in LEFT_OUT or tag == "header" and not up.place & IN_ARTICLE
        if not out and tag not in ("html", "body", "main"):
            out = _names_part(m["attrs"], COMMENTS if tag == "article" else PARTS)
        place = up.place | (IN_ARTICLE if tag == "article" else IN_MAIN if tag == "main" else 0)
        if out:
            end_block()
        stack.append(_Open(tag, out, place))
        opened[tag] += 1
        if tag in CONTAINER or tag in PROSE:
            around.append(stack[-1])
        if tag in RAW:
            at = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, pos)
            stop = at.start() if at else size
            if s := html[pos:stop].strip():
                stack[-1].parts.append(s)
            pos = stop
    close(1)
    end_block()
    return [(s, place, [e.digest for e in inside]) for s, place, inside in blocks], seen


def chosen(blocks: list[tuple[str, int, list[int]]]) -> list[tuple[str, list[int]]]:
    """The blocks that are the text; ``chosen_text`` is the same on columns."""
    scope = [b for b in blocks if b[1] & IN_MAIN] or blocks
    article = [b for b in blocks if b[1] & IN_ARTICLE]
    if article and sum(len(b[0]) for b in article) >= ARTICLE * sum(len(b[0]) for b in scope):
        scope = article
    return [(s, inside) for s, _, inside in scope]


def parse(html: str) -> tuple[list[tuple[str, list[int]]], dict[int, bool]]:
    """Main blocks of a page by itself, and the digests as in ``page_blocks``."""
    blocks, seen = page_blocks(html)
    return chosen(blocks), seen


def chosen_text(blocks: Column) -> Column:
    """Texts of the blocks that are the text, joined by newlines."""
    def size(bs: Column) -> Column:
        return F.aggregate(bs, F.lit(0).cast("bigint"), lambda a, b: a + F.length(b["text"]))

    def choice(bs: Column) -> Column:
        main = F.filter(bs, lambda b: b["place"].bitwiseAND(IN_MAIN) != 0)
        article = F.filter(bs, lambda b: b["place"].bitwiseAND(IN_ARTICLE) != 0)
        scope = F.when(F.size(main) > 0, main).otherwise(bs)
        return F.when((F.size(article) > 0) & (size(article) >= ARTICLE * size(scope)), article).otherwise(scope)

    return F.array_join(F.transform(F.get(F.transform(F.array(blocks), choice), F.lit(0)), lambda b: b["text"]), "\n")


def signature(text: str) -> bytes:
    """Two bytes of each min-hash over the pairs of neighbouring words, the ends of the text included."""
    words = ["", *text.split(), ""]
    pairs = np.fromiter({xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(words, words[1:])}, dtype=np.uint64)
    low = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(pairs), 4096):
        h = pairs[i:i + 4096] * _HASHES[0] + _HASHES[1]
        h ^= h >> np.uint64(32)
        low = np.minimum(low, (h * _HASHES[1]).min(axis=1))
    return (low >> np.uint64(24)).astype("<u2").tobytes()


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].partition(":")[0].lower() if m else ""


def parsed_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, host, digest (of the html), content and signature (of the main
    text), blocks array<struct<text, place, inside array<bigint>>>, subtrees array<struct<digest, prose>>."""
    kept = only(pages, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.struct([("text", pa.string()), ("place", pa.int32()), ("inside", pa.list_(pa.int64()))])
        for b in slices(batches, 2):
            host = [host_of(u) for u in b.column(1).to_pylist()]
            digest, content, signatures, blocks, subtrees = [], [], [], [], []
            for h in b.column(2).to_pylist():
                found, seen = page_blocks(h or "")
                digest.append(xxhash.xxh64_intdigest(h or "") - (1 << 63))
                main = "\n".join(s for s, _ in chosen(found))
                content.append(xxhash.xxh64_intdigest(main) - (1 << 63))
                signatures.append(signature(main))
                blocks.append([{"text": s, "place": place, "inside": inside} for s, place, inside in found])
                subtrees.append([{"digest": d, "prose": p} for d, p in seen.items()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(host, pa.string()), pa.array(digest, pa.int64()), pa.array(content, pa.int64()),
                 pa.array(signatures, pa.binary()), pa.array(blocks, pa.list_(block)), pa.array(subtrees, pa.list_(pa.struct([("digest", pa.int64()), ("prose", pa.bool_())])))],
                [id_col, url_col, "host", "digest", "content", "signature", "blocks", "subtrees"])

    kinds = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in (id_col, url_col))
    return kept.mapInArrow(run, f"{kinds}, host string, digest bigint, content bigint, signature binary, "
                                "blocks array<struct<text:string,place:int,inside:array<bigint>>>, subtrees array<struct<digest:bigint,prose:boolean>>")


def text_groups(parsed: DataFrame) -> DataFrame:
    """(node, group): distinct main texts of a host (``node`` is the hash of both) with the
    least node of their near-equal texts; texts without such are left out."""
    texts = (parsed.filter("host <> ''").select(F.xxhash64("host", "content").alias("node"), "host", "signature")
             .dropDuplicates(["node"]))
    width = 2 * BAND_ROWS
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        "host", b, F.substring("signature", b * width + 1, F.lit(width)))))
    bands = stored(texts.select("node", band.alias("band")), "text-bands")
    # Links go to the least text of a band, so that a group of n has at most n - 1 links a band.
    first = bands.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "least")
    links = bands.join(first, "band").filter("node <> least").select("node", "least").distinct()
    sig = texts.select("node", "signature")
    links = (links.join(sig, "node").withColumnRenamed("signature", "s")
             .join(sig.select(F.col("node").alias("least"), F.col("signature").alias("t")), "least"))
    at = F.sequence(F.lit(0), F.lit(BANDS * BAND_ROWS - 1))
    equal = F.size(F.filter(at, lambda i: F.substring("s", i * 2 + 1, F.lit(2)) == F.substring("t", i * 2 + 1, F.lit(2))))
    near = links.filter(equal >= NEAR * BANDS * BAND_ROWS).select(F.col("node").alias("u"), F.col("least").alias("v"))
    return components(near).select(F.col("u").alias("node"), F.col("v").alias("group"))


def templates(parsed: DataFrame, min_pages: int = 5, prose_pages: int = 10, share: float = 0.5) -> DataFrame:
    """(host, subtree) of the subtrees that are site template."""
    named = parsed.filter("host <> ''").select("host", F.xxhash64("host", "content").alias("node"), "subtrees")
    named = named.join(text_groups(parsed), "node", "left").withColumn("group", F.coalesce("group", "node"))
    hosts = named.select("host", "group").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    found = (named.select("host", "group", F.explode("subtrees").alias("s")).select("host", "group", "s.*").distinct()
             .groupBy("host", F.col("digest").alias("subtree"), "prose").agg(F.count(F.lit(1)).alias("pages"))
             .filter(F.col("pages") >= F.when(F.col("prose"), prose_pages).otherwise(min_pages)).join(hosts, "host"))
    return found.filter(F.col("pages") >= share * F.col("all_pages")).select("host", "subtree").distinct()


def main_text(pages: DataFrame, min_pages: int = 5, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text``, ``n_chars`` bigint of every page."""
    parsed = stored(parsed_pages(pages, id_col, url_col, html_col), "parsed-pages", compression="zstd")
    around = F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["inside"])))
    # Stored tables have a known size: Spark broadcasts a small one, and then shuffles no pages.
    known = stored(templates(parsed, min_pages), "templates")
    hits = (parsed.select("host", "digest", F.explode(around).alias("subtree")).join(known, ["host", "subtree"])
            .groupBy("host", "digest").agg(F.collect_set("subtree").alias("gone")))
    out = parsed.join(stored(hits, "template-hits"), ["host", "digest"], "left")
    left = F.filter("blocks", lambda b: ~F.coalesce(F.arrays_overlap(b["inside"], F.col("gone")), F.lit(False)))
    out = out.select(id_col, url_col, chosen_text(left).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
