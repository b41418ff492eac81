"""Main text of web pages: markup says where the article is, a host's suffix array says what is template.

A page is cut into blocks (the text between block-level tags) in page order. A block's place gives its
kind: inside the article, outside it, or undecided. The token streams of a host's pages are concatenated
(one markup token at the head of each block, then its words) and their suffix array is sorted to the depth of
the shortest run that counts. Neighbours with that many tokens in common, on enough distinct pages of the
host, are long repeated substrings; what they cover is boilerplate. Undecided blocks that are covered go,
unique runs stay. Pages with equal text are one page, so that a copy is no evidence of a template. A host of
many bytes is dealt into shards by the hash of its pages' texts: each shard counts by a suffix array of its
own on how many distinct pages a run stands, the counts of all shards are added up, and the runs that stand on
enough pages of the whole host are handed back to its pages. So the size of a shard changes no result.

The article is, in this order: ``article`` elements, ``main`` (or ``role=main``, ``itemprop=articleBody``),
containers whose class or id say content, articles inside containers labelled as furniture, the whole
body. Plain blocks of an article are its own words and stay however often they are repeated; blocks in
containers of their own inside it are undecided, and so is the whole body of a page without an article.
A page that would lose all its undecided text keeps it: it is a copy, not a template.

Never part of the text: scripts, styles, forms, navigation, page headers, footers, asides, hidden
elements, and containers whose class, id or role name such furniture. Of a header inside an article the
headings stay. Character references are decoded, white space inside a block (``br`` included) is one
space. Null or empty html gives an empty text; a null url is a host of its own; repeated rows each give
a row; other columns are ignored, whatever their names; texts have no length limit.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textkit import flat_text, mix, runs, span_hashes, word_spans
from tidemark.scratch import materialise

RUN_TOKENS = 8  # the shortest repeated substring that counts
MIN_PAGES = 2
MIN_SHARE = 0.02  # of the distinct pages of a host
COVERED = 0.5  # share of a block's tokens from which it is boilerplate
SHARD_BYTES = 2 << 20

OWN, INSIDE, OUTSIDE, OPEN, FURNITURE = range(5)  # kinds of blocks

# Elements and words of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
FURNITURE_TAGS = frozenset("nav footer aside form button select dialog menu object audio video canvas".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertising advertisement advertisements alert banner breadcrumb breadcrumbs byline-links"
    " comment comments commentlist consent cookie cookies copyright disqus feedback footer footnav form gdpr header login"
    " masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination paywall"
    " popup privacy promo promoted promotion recommended related replies reply respond responses search share sharing"
    " sidebar signup social sponsor sponsored sponsors subscribe subscription teaser teasers toolbar topbar widget"
    " widgets".split()
)
CONTENT_WORDS = frozenset("article articlebody content entry main maincontent post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("div section table ul ol dl details figure".split())
# an open element of the first kind ends where one of the second begins
ENDED_BY = {
    "p": BLOCK - {"body", "html", "head"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
    "head": {"body"},
}
SCOPES = frozenset("table td th article section main body html ul ol dl div".split())

_TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))",
    re.S,
)
_BROKEN = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


class _Element:
    """An open element with what its place says: zone, furniture by tag or by name, header, signature."""

    __slots__ = ("name", "zone", "hard", "soft", "header", "signature")

    def __init__(self, name, zone, hard, soft, header, signature):
        self.name, self.zone, self.hard, self.soft = name, zone, hard, soft
        self.header, self.signature = header, signature


_TOP = _Element("", 9, False, False, False, ())
ARTICLE, MAIN, CONTENT, LABELLED, BODY = 0, 1, 2, 3, 9  # zones: where the article is, best first


def _words(*names: str) -> set[str]:
    found = set()
    for name in names:
        found.update(w.lower() for w in _WORD.findall(name))
        found.update(re.split(r"[^a-z0-9]+", name.lower()))
    return found


def _open(name: str, rest: str, above: _Element) -> _Element:
    """The element that a start tag opens."""
    values = {}
    if rest and rest != "/":
        for m in _ATTRIBUTE.finditer(rest):
            values.setdefault(m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "")
    named = _words(values.get("class", ""), values.get("id", "")) if "class" in values or "id" in values else set()
    role = values.get("role", "").lower()
    zone, soft, header = above.zone, above.soft, above.header
    hard = above.hard or name in FURNITURE_TAGS or role in FURNITURE_ROLES or "hidden" in values
    hard = hard or values.get("aria-hidden", "").lower() == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
    signature = above.signature
    if name in ("html", "body"):
        return _Element(name, zone, above.hard, soft, header, signature)
    main = name == "main" or role == "main" or values.get("itemprop", "").lower() == "articlebody"
    if name == "article" and zone != ARTICLE:
        zone = LABELLED if soft or named & FURNITURE_WORDS else ARTICLE
        soft, signature = False, ()
    elif main:
        zone, signature = min(zone, MAIN), signature if zone < MAIN else ()
        soft = soft and zone == ARTICLE
    else:
        inside = zone in (ARTICLE, LABELLED)
        if name == "header" or (inside and "header" in named):
            header, hard = True, hard or not inside
            named = named - {"header"}
        if named & FURNITURE_WORDS:
            soft = True
        elif named & CONTENT_WORDS:
            if zone > CONTENT and not soft:
                zone, signature = CONTENT, ()
        elif named and name in CONTAINERS:
            signature = (*signature, name + "." + ".".join(sorted(named)))
    return _Element(name, zone, hard, soft, header, signature)


def blocks(page: str) -> list[tuple[int, bool, tuple, str]]:
    """(zone, furniture, containers inside the zone, text) of each block with text, in page order."""
    out: list[tuple[int, bool, tuple, str]] = []
    stack: list[_Element] = []
    parts: list[str] = []
    heading = False

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                top = stack[-1] if stack else _TOP
                furniture = top.hard or top.soft or (top.header and not heading)
                out.append((top.zone, furniture, top.signature, text))

    position, size = 0, len(page)
    while position < size:
        start = page.find("<", position)
        if start < 0:
            parts.append(page[position:])
            break
        if start > position:
            parts.append(page[position:start])
        m = _TAG.match(page, start)
        if m is None:
            m = _BROKEN.match(page, start)  # a quote that is never closed
        if m is None:
            parts.append("<")
            position = start + 1
            continue
        position = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if m["end"]:
            if name in BLOCK:
                flush()
            if name in HEADINGS:
                heading = False
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
                if stack[depth].name in SCOPES and name not in SCOPES and name not in BLOCK:
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, position)
            if m["rest"].endswith("/") and name in ("svg", "math"):
                continue
            end = page.find(">", close.end()) if close else -1
            position = end + 1 if end >= 0 else size
            continue
        if name in BLOCK:
            flush()
            for depth in range(len(stack) - 1, -1, -1):
                if name in ENDED_BY.get(stack[depth].name, ()):
                    del stack[depth:]
                    break
                if stack[depth].name in SCOPES:
                    break
        if name in HEADINGS:
            heading = True
        if name not in VOID:
            stack.append(_open(name, m["rest"], stack[-1] if stack else _TOP))
    flush()
    return out


def classified(page: str) -> list[tuple[int, int, str]]:
    """(kind, hash of the containers, text) of each block."""
    found = blocks(page)
    zones = [zone for zone, furniture, _, _ in found if not furniture]
    best = min(zones, default=BODY)
    out = []
    for zone, furniture, signature, text in found:
        if best == BODY:
            kind = FURNITURE if furniture else OPEN
        elif furniture or zone != best:
            kind = OUTSIDE
        else:
            kind = INSIDE if signature else OWN
        out.append((kind, hash_of(signature), text))
    return out


@lru_cache(maxsize=1 << 16)
def hash_of(signature: tuple) -> int:
    """A number for the containers of a block, the same in every process."""
    flat = np.frombuffer(("/".join(signature) or "/").encode(), np.uint8)
    return int(span_hashes(flat, np.zeros(1, np.int64), np.array([len(flat)]))[0].view(np.int64))


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` tokens (a power of two), and each one's rank; equal heads share a rank.

    Ranks of heads of a length double to ranks of twice that length. A suffix shorter than ``depth`` goes
    before the longer ones it begins.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    length = 1
    while length < depth:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:] if length < len(rank) else 0
        rank = np.unique(rank * (len(tokens) + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        length *= 2
    return np.argsort(rank, kind="stable"), rank


def whole_heads(page: np.ndarray) -> np.ndarray:
    """Where RUN_TOKENS tokens begin that do not run into the next page."""
    n = len(page)
    whole = np.zeros(n, bool)
    if n >= RUN_TOKENS:
        whole[: n - RUN_TOKENS + 1] = page[: n - RUN_TOKENS + 1] == page[RUN_TOKENS - 1 :]
    return whole


def head_pages(tokens: np.ndarray, page: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads of RUN_TOKENS tokens, equal ones together; where runs of equal ones begin; the distinct pages of each run."""
    order, rank = suffix_array(tokens, RUN_TOKENS)
    order = order[whole_heads(page)[order]]
    by_page = order[np.lexsort((content[order], rank[order]))]
    edges = runs(rank[by_page])
    fresh = np.append(True, (np.diff(rank[by_page]) != 0) | (np.diff(content[by_page]) != 0))[: len(by_page)]
    sums = np.append(0, np.cumsum(fresh))
    return by_page, edges, sums[edges[1:]] - sums[edges[:-1]]


def spread(heads: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` tokens are among the RUN_TOKENS tokens from a head."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, heads, 1)
    np.add.at(change, heads + RUN_TOKENS, -1)
    return np.cumsum(change[:-1]) > 0


def head_hashes(tokens: np.ndarray) -> np.ndarray:
    """A number for the RUN_TOKENS tokens from each place that has as many."""
    h = np.zeros(max(len(tokens) - RUN_TOKENS + 1, 0), np.uint64)
    for i in range(RUN_TOKENS):
        h = mix(h + tokens[i : i + len(h)])
    return h.view(np.int64)


def repeated(tokens: np.ndarray, page: np.ndarray, content: np.ndarray, min_pages: int) -> np.ndarray:
    """Which tokens lie in a substring of RUN_TOKENS or more that stands on ``min_pages`` distinct pages.

    ``page`` (nondecreasing) is each token's page, ``content`` a number for the text of that page.
    """
    if len(tokens) < RUN_TOKENS:
        return np.zeros(len(tokens), bool)
    heads, edges, pages = head_pages(tokens, page, content)
    return spread(heads[np.repeat(pages >= min_pages, np.diff(edges))], len(tokens))


def page_contents(texts: pa.Array, pages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the blocks of each page begin, with their number at the end, and a hash of each page's text."""
    flat, at = flat_text(texts)
    whole = span_hashes(flat, at[:-1], at[1:])
    edges = runs(pages)
    position = mix(np.arange(len(pages), dtype=np.uint64) - np.repeat(edges[:-1], np.diff(edges)).astype(np.uint64))
    sums = np.append(np.uint64(0), np.cumsum(mix(whole ^ position), dtype=np.uint64))
    return edges, (sums[edges[1:]] - sums[edges[:-1]]).view(np.int64)


def judged_tokens(texts: pa.Array, kinds: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all blocks but plain ones of an article, and the block of each."""
    judged = np.flatnonzero(kinds != OWN)
    flat, at = flat_text(texts)
    starts, ends, block = word_spans(flat, at)
    own = kinds[block] != OWN
    words, block = span_hashes(flat, starts, ends)[own], block[own]
    tokens = np.concatenate([mix(signatures[judged].astype(np.int64).view(np.uint64)), words])
    where = np.concatenate([judged, block])
    order = np.argsort(where, kind="stable")  # the markup token goes before its block's words
    return tokens[order], where[order]


def template_blocks(
    texts: pa.Array, kinds: np.ndarray, signatures: np.ndarray, pages: np.ndarray, templates: np.ndarray | None = None
) -> np.ndarray:
    """Which blocks of pages are covered by repeated substrings; plain article blocks never are.

    ``templates`` are the hashes of the heads known to stand on enough pages; without them the pages are all of a host.
    """
    judged = np.flatnonzero(kinds != OWN)
    covered = np.zeros(len(kinds), bool)
    if not len(judged):
        return covered
    tokens, where = judged_tokens(texts, kinds, signatures)
    if templates is None:
        edges, contents = page_contents(texts, pages)
        text_of = np.unique(contents, return_inverse=True)[1]
        content = np.repeat(text_of, np.diff(edges))
        min_pages = max(MIN_PAGES, int(np.ceil(MIN_SHARE * len(np.unique(text_of)))))
        hit = repeated(tokens, pages[where], content[where], min_pages)
    else:
        known = np.flatnonzero(np.isin(head_hashes(tokens), templates))
        hit = spread(known[whole_heads(pages[where])[known]], len(tokens))
    total = np.bincount(where, minlength=len(kinds))
    covered[judged] = (np.bincount(where, weights=hit, minlength=len(kinds))[judged] >= COVERED * total[judged])
    return covered


def kept_blocks(kinds: np.ndarray, covered: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """The blocks of the main text; a page all of whose undecided text is covered, and has no other, keeps it."""
    undecided = (kinds == INSIDE) | (kinds == OPEN)
    keep = (kinds == OWN) | (undecided & ~covered)
    filled = np.bincount(pages, weights=keep, minlength=int(pages.max(initial=-1)) + 1) > 0
    return keep | (undecided & ~filled[pages]) if len(pages) else keep


def _parsed(pages: DataFrame) -> DataFrame:
    """The blocks of each page of ``page_id, url, host, html``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [classified(x or "") for x in part.column("html").to_pylist()]
                columns = [
                    *(part.column(name) for name in ("page_id", "url", "host")),
                    pa.array([[k for k, _, _ in f] for f in found], pa.list_(pa.int8())),
                    pa.array([[s for _, s, _ in f] for f in found], pa.list_(pa.int64())),
                    pa.array([[t for _, _, t in f] for f in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "kinds", "containers", "texts"])

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, host string, kinds array<tinyint>, containers array<bigint>, texts array<string>"
    return pages.mapInArrow(rows, schema)


def _page_tokens(pages: DataFrame) -> DataFrame:
    """Of each page with text of ``host, shards, html``: the hash of its text and the tokens of its judged blocks.

    Equal pages of one batch give a row only once.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple] = set()
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [classified(x or "") for x in part.column("html").to_pylist()]
                numbers = np.repeat(np.arange(len(found)), [len(f) for f in found])
                kinds, signatures = (np.array([b[i] for f in found for b in f], np.int64) for i in (0, 1))
                texts = pa.array([b[2] for f in found for b in f], pa.string())
                edges, contents = page_contents(texts, numbers)
                tokens, where = judged_tokens(texts, kinds, signatures)
                cuts = np.searchsorted(where, edges)
                hosts, shards = (part.column(name).to_pylist() for name in ("host", "shards"))
                out = []
                for page, content, a, b in zip(numbers[edges[:-1]].tolist(), contents.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                    row = hosts[page], content, tokens[a:b].tobytes()
                    if row not in seen:
                        seen.add(row)
                        out.append((hosts[page], content % shards[page], *row[1:]))
                columns = list(zip(*out)) if out else [[]] * 4
                kinds_of = (pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds_of)], ["host", "shard", "content", "tokens"]
                )

    return pages.mapInArrow(rows, "host string, shard long, content long, tokens binary")


def _shard_heads(shard: pa.Table) -> pa.Table:
    """On how many distinct pages of a shard each head of RUN_TOKENS tokens stands; for no head, how many pages there are."""
    content = shard.column("content").to_numpy()
    parts = [np.frombuffer(x, np.uint64) for x in shard.column("tokens").to_pylist()]
    sizes = [len(x) for x in parts]
    tokens, page = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
    heads, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(tokens) >= RUN_TOKENS:
        places, edges, n = head_pages(tokens, page, np.repeat(content, sizes))
        heads = head_hashes(tokens)[places[edges[:-1]]]
    return pa.table(
        {
            "host": pa.array([shard.column("host")[0].as_py()] * (len(heads) + 1), pa.string()),
            "head": pa.array([None, *heads.tolist()], pa.int64()),
            "n": pa.array([len(np.unique(content)), *n.tolist()], pa.int64()),
        }
    )


def host_templates(pages: DataFrame) -> DataFrame:
    """The heads that stand on enough distinct pages of their host, of pages ``host, shards, html``."""
    tokens = _page_tokens(pages)
    counts = materialise(tokens.groupBy("host", "shard").applyInArrow(_shard_heads, "host string, head long, n long"), "heads")
    sums = counts.groupBy("host", "head").agg(F.sum("n").alias("n"))
    share = F.greatest(F.lit(MIN_PAGES), F.ceil(F.lit(MIN_SHARE) * F.col("n")))
    needed = sums.filter("head IS NULL").select("host", share.alias("needed"))
    return sums.filter("head IS NOT NULL").join(needed, "host").filter("n >= needed").select("host", "head")


def _host_text(host: pa.Table) -> pa.Table:
    """The main texts of all pages of a host."""
    return _shard_text(host, None)


def _told_text(shard: pa.Table, templates: pa.Table) -> pa.Table:
    """The main texts of a host, or of one shard of a host whose templates are known."""
    dealt = shard.num_rows and shard.column("shards")[0].as_py() is not None
    return _shard_text(shard, templates.column("head").to_numpy() if dealt else None)


def _shard_text(shard: pa.Table, templates: np.ndarray | None) -> pa.Table:
    lists = [shard.column(name).combine_chunks() for name in ("kinds", "containers", "texts")]
    counts = lists[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    pages = np.repeat(np.arange(shard.num_rows), counts)
    kinds, containers = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists[:2])
    texts = lists[2].flatten()
    covered = template_blocks(texts, kinds, containers, pages, templates)
    keep = kept_blocks(kinds, covered, pages)
    lines = texts.to_pylist()
    ends = np.cumsum(counts).tolist()
    joined, begin = [], 0
    for end in ends:
        joined.append("\n".join(lines[i] for i in range(begin, end) if keep[i]))
        begin = end
    gone = np.bincount(pages, weights=covered, minlength=shard.num_rows).astype(np.int64)
    return pa.table(
        {
            "page_id": shard.column("page_id"),
            "url": shard.column("url"),
            "text": pa.array(joined, pa.string()),
            "n_chars": pa.array([len(t) for t in joined], pa.int64()),
            "n_blocks": pa.array(counts, pa.int64()),
            "n_template": pa.array(gone, pa.int64()),
        }
    )


def main_text(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, and of how many blocks (``n_blocks``) how many are template.

    One shuffle moves the texts. A host of more than ``shard_bytes`` of html is dealt over several shards; a
    shuffle of hashed tokens before, without the plain blocks of articles, finds the templates of such hosts.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    hosted = pages.select("page_id", "url", host.alias("host"), "html")
    sizes = hosted.groupBy(F.col("host").alias("big_host")).agg(F.sum(F.octet_length("html")).alias("bytes"))
    shards = F.ceil(F.col("bytes") / shard_bytes).alias("shards")
    big = materialise(sizes.filter(F.col("bytes") > shard_bytes).select("big_host", shards), "big_hosts")
    dealt = F.pmod(F.xxhash64("page_id", "url", "texts"), F.coalesce("shards", F.lit(1)))
    rows = _parsed(hosted).join(big, F.col("host") == F.col("big_host"), "left").withColumn("shard", dealt).drop("big_host")
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long, n_blocks long, n_template long"
    if big.isEmpty():
        return rows.drop("shards").groupBy("host", "shard").applyInArrow(_host_text, schema)
    known = big.withColumnRenamed("big_host", "host")
    found = host_templates(hosted.join(known, "host").select("host", "shards", "html"))
    templates = found.join(known, "host").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    templates = templates.select("host", F.col("shard").cast("long").alias("shard"), "head")
    both = rows.groupBy("host", "shard").cogroup(templates.groupBy("host", "shard"))
    return both.applyInArrow(_told_text, schema)
