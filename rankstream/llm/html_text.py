"""Main text of web pages, from their structure and from a suffix array over each host's pages.

A scanner turns markup into blocks of text, each with its zone: ``article`` for what lies in an
article (or main) element and not in a menu, header, footer, sidebar, notice, advert, form, script,
style or comment section, ``free`` for the same outside of any such element, and ``out`` for the rest.
All pages of a host go through its suffix array. The token streams of their ``article`` and ``free``
blocks are concatenated, and the suffix array is sorted as deep as the shortest repeat that counts, by
doubling. Runs of at least that many tokens that occur on distinct pages are boilerplate, unless a page of
the host has them inside its article: repeated passages of an article are content, on that page and on
pages that show it without the mark. An exact check by structure follows: of pages that mark an article its
blocks stay and ``free`` ones go, since unique words of a menu are no article, which repetition cannot tell.

Hosts are dealt to shards of bounded size, so a host with a third of all pages is many groups. Where a host
has several, the runs of its unmarked pages are looked up by hash on all pages of the host first, so shards
do not change the result.

Defined results: null and empty html give an empty text; truncated markup ends all open elements;
unknown elements are inline; a host-less url shares the empty host; equal pages are distinct pages
unless their page_id is equal, too. Rows with one page_id do not repeat each other, and each gets its own text.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import arrow_type, per_value, settle
from rankstream.llm.url_filter import host_of

REPEAT = 8  # tokens, a power of two
SHARD_PAGES = 2000
SEPARATOR = "\n\n"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.DOTALL)
_SPACE = re.compile(r"\s+")
_HINT = re.compile(r"[A-Za-z0-9]+")

# Fixed values of the markup language.
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_OUT = {"nav", "header", "footer", "aside", "form", "button", "head", "dialog", "menu"}
_BLOCK = set(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table "
    "tbody tfoot thead tr ul".split()
)
_CELL = {"td", "th", "br"}
# Names in class, id and role that mark an element as no part of the article.
_HINTS = set(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices comment comments sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs share sharing social related newsletter subscribe footer header popup modal "
    "complementary contentinfo search alert disclaimer".split()
)
_NEVER_HINTED = {"html", "body", "main", "article"}


def _hinted(name: str, attributes: str) -> bool:
    if "=" not in attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role"):
            tokens = {t.lower() for t in _HINT.findall("".join(values))}
            if name in _NEVER_HINTED and key != "role":
                tokens &= {"comment", "comments"}
            if tokens & _HINTS:
                return True
    return False


def blocks(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of the page's blocks, in order; white space is one space, ends are trimmed."""
    found: list[tuple[str, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, out, article

    def flush():
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out = any(o for _, o, _ in stack)
            inside = any(a for *_, a in stack)
            found.append(("out" if out else "article" if inside else "free", text))

    page, at = page or "", 0
    while at < len(page):
        tag = _TAG.search(page, at)
        if tag is None:
            parts.append(page[at:])
            break
        parts.append(page[at : tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        closing = bool(tag.group(1))
        if name in _RAW:
            if not closing and not tag.group(3).endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in _CELL:
            parts.append(" ")
        if name not in _BLOCK and name not in _OUT:
            # inline elements matter only where they mark what is no article
            if closing:
                if any(n == name for n, *_ in stack):
                    flush()
                    _pop(stack, name)
            elif name not in _VOID and _hinted(name, tag.group(3)):
                flush()
                stack.append((name, True, False))
            continue
        flush()
        if closing:
            _pop(stack, name)
        elif name not in _VOID:
            if stack and stack[-1][0] == "p":
                stack.pop()
            if name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            hinted = name in _OUT or _hinted(name, tag.group(3))
            if not tag.group(3).endswith("/"):
                stack.append((name, hinted, name in ("article", "main")))
    flush()
    return found


def _pop(stack: list, name: str) -> None:
    """Ends the innermost element of the name and all inside it; none, if there is none."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return
        if stack[i][2] and name not in ("html", "body"):
            return  # a stray end tag does not end the article around it


def repeated_runs(
    tokens: np.ndarray, page: np.ndarray, repeat: int = REPEAT,
    row: np.ndarray | None = None, article: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``repeat`` tokens start that occur on distinct pages and in no article, and where
    such that lie in an article somewhere.

    ``tokens`` are numbers of words, ``page`` the page of each, ``row`` its row (by default, the page);
    runs do not cross rows. ``article`` tells which tokens lie in an article. The suffix array is sorted
    to depth ``repeat`` by doubling: after k steps, rank is the order of the first 2**k tokens, so equal
    ranks are equal prefixes.
    """
    n, row = len(tokens), page if row is None else row
    if n < repeat:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rank, depth = tokens.astype(np.int64) + 1, 1
    while depth < repeat:
        later = np.zeros(n, np.int64)  # 0: past the end, or on another page
        same = row[depth:] == row[:-depth]
        later[:-depth] = np.where(same, rank[depth:], 0)
        pairs = rank * (later.max() + 1) + later
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64) + 1
        depth *= 2
    whole = np.zeros(n, bool)
    whole[: n - repeat + 1] = row[repeat - 1 :] == row[: n - repeat + 1]
    order = np.lexsort((page, rank))
    order = order[whole[order]]
    if not len(order):
        return order, order
    ranks, pages = rank[order], page[order]
    first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
    last = np.r_[first[1:], len(ranks)] - 1
    inside = np.zeros(n, bool) if article is None else _inside(article, repeat)
    content = np.logical_or.reduceat(inside[order], first)
    several = (pages[first] != pages[last]) & ~content
    size = last - first + 1
    return order[np.repeat(several, size)], order[np.repeat(content, size)]


def _inside(article: np.ndarray, repeat: int) -> np.ndarray:
    """From which places ``repeat`` tokens lie in articles; false where fewer are left."""
    sums = np.r_[0, np.cumsum(article)]
    found = np.zeros(len(article), bool)
    if len(article) >= repeat:
        found[: len(article) - repeat + 1] = sums[repeat:] - sums[:-repeat] == repeat
    return found


def _cover(n: int, starts: np.ndarray, repeat: int) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + repeat, -1)
    return np.cumsum(marks[:-1]) > 0


def repeated_tokens(tokens: np.ndarray, page: np.ndarray, repeat: int = REPEAT) -> np.ndarray:
    """Which tokens lie in :func:`repeated_runs`."""
    return _cover(len(tokens), repeated_runs(tokens, page, repeat)[0], repeat)


def run_hashes(texts: list[str], repeat: int) -> list[int]:
    """A signed 64-bit hash of the ``repeat`` tokens from each place of a page's blocks."""
    words = [word.encode() for text in texts for word in text.split(" ")]
    runs = (b" ".join(words[i : i + repeat]) for i in range(len(words) - repeat + 1))
    return [(xxhash.xxh64_intdigest(run) ^ 1 << 63) - (1 << 63) for run in runs]


def main_texts(
    pages: list[int], rows: list[list[tuple[bool, str]]], repeat: int = REPEAT,
    known: list[dict[int, bool] | None] | None = None,
) -> list[str]:
    """The text of each row: its blocks (in an article, text) without what other pages repeat.

    ``pages`` numbers the page of each row. ``known`` tells of the row's runs by hash whether they are
    content (else boilerplate), where all pages of the host were asked; None where these rows are all pages.
    """
    number: dict[str, int] = {}
    ids, sizes, article = [], [], []
    for blocks_ in rows:
        before = len(ids)
        for inside, text in blocks_:
            words = text.split(" ")
            ids.extend([number.setdefault(w, len(number)) for w in words])
            article.extend([inside] * len(words))
        sizes.append(len(ids) - before)
    row = np.repeat(np.arange(len(rows)), sizes)
    found = repeated_runs(
        np.array(ids, np.int64), np.array(pages, np.int64)[row], repeat, row, np.array(article, bool)
    )
    ends = np.cumsum(sizes)
    if known and any(k is not None for k in known):
        asked = np.array([k is not None for k in known])
        told: tuple[list[int], list[int]] = [], []
        for blocks_, runs, end, size in zip(rows, known, ends, sizes):
            digests = run_hashes([text for _, text in blocks_], repeat) if runs else ()
            for i, digest in enumerate(digests):
                if digest in runs:
                    told[runs[digest]].append(end - size + i)
        found = [np.r_[f[~asked[row[f]]], np.array(t, np.int64)] for f, t in zip(found, told)]
    boilerplate, content = (_cover(len(ids), starts, repeat) for starts in found)
    covered = boilerplate & ~content
    return [
        _checked(blocks_, covered[end - size : end])
        for blocks_, end, size in zip(rows, ends, sizes)
    ]


def _checked(blocks_: list[tuple[bool, str]], covered: np.ndarray) -> str:
    """What stays of a row: its article, whole; where it marks none, the tokens that are not covered."""
    own = [text for inside, text in blocks_ if inside]
    if own or not covered.any():
        return SEPARATOR.join(own or [text for _, text in blocks_])
    kept, at = [], 0
    for _, text in blocks_:
        words = text.split(" ")
        left = [w for w, out in zip(words, covered[at : at + len(words)]) if not out]
        at += len(words)
        if left:
            kept.append(" ".join(left))
    return SEPARATOR.join(kept)


SCANNED = schemas.struct(article=schemas.array(schemas.BOOLEAN), texts=schemas.array(schemas.STRING))
RUN = schemas.struct(run=schemas.LONG, inside=schemas.BOOLEAN)


def _scan(page: str | None):
    """The blocks that may be main text, and which of them lie in an article."""
    found = [(zone == "article", text) for zone, text in blocks(page) if zone != "out"]
    return [inside for inside, _ in found], [text for _, text in found]


scan = per_value(_scan, SCANNED)


def _runs(repeat: int, unmarked: bool):
    """The different runs of a page and whether it has them in an article; ``unmarked``: if it marks none."""

    def of(page: str | None):
        article, texts = _scan(page)
        if unmarked and any(article):
            return []
        flags = [inside for inside, text in zip(article, texts) for _ in text.split(" ")]
        inside = _inside(np.array(flags, bool), repeat)
        found: dict[int, bool] = {}
        for digest, whole in zip(run_hashes(texts, repeat), inside.tolist()):
            found[digest] = found.get(digest, False) or whole
        return [{"run": run, "inside": whole} for run, whole in found.items()]

    return per_value(of, schemas.array(RUN))


def _known(large: DataFrame, repeat: int) -> DataFrame | None:
    """Boilerplate and content runs of the unmarked pages of hosts with several shards, asked of all their pages.

    ``large`` (host, page, html) has the pages of these hosts. Gives host, page, runs; None if all pages
    mark an article.
    """

    def exploded(unmarked: bool) -> DataFrame:
        return large.select("host", "page", F.explode(_runs(repeat, unmarked)(F.col("html"))).alias("r")).select(
            "host", "page", "r.*"
        )

    asked = settle(exploded(True).select("host", "page", "run"), "asked")
    if asked.isEmpty():
        return None
    wanted = asked.select("host", "run").distinct()
    met = exploded(False).join(wanted, ["host", "run"], "left_semi")
    shared = met.groupBy("host", "run").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.max("inside").alias("inside")
    )
    judged = settle(shared.filter("inside OR low < high").select("host", "run", "inside"), "runs")
    return asked.join(judged, ["host", "run"]).groupBy("host", "page").agg(
        F.collect_set(F.struct("run", "inside")).alias("runs")
    )


def extracted(
    pages: DataFrame, repeat: int = REPEAT, shard_pages: int = SHARD_PAGES
) -> DataFrame:
    """page_id, url, text of every page (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host")
    ).withColumn("page", F.coalesce("page_id", F.lit(-1)))
    hosts = settle(
        rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_pages), "hosts"
    )
    shard = F.pmod(F.xxhash64("page_id", "url", "html"), F.ceil(F.col("n") / shard_pages).cast("long"))
    known = _known(rows.join(hosts, "host", "left_semi"), repeat)
    dealt = rows.join(hosts, "host", "left").withColumn("shard", F.coalesce(shard, F.lit(0)))
    nothing = F.when(F.col("n").isNotNull(), F.array().cast(schemas.array(RUN)))
    if known is None:
        dealt = dealt.withColumn("runs", nothing)
    else:
        dealt = dealt.join(known, ["host", "page"], "left").withColumn("runs", F.coalesce("runs", nothing))
    scanned = dealt.select("page_id", "url", "host", "shard", "page", "runs", scan(F.col("html")).alias("s"))
    kind = schemas.struct(page_id=schemas.LONG, url=schemas.STRING, text=schemas.STRING)

    def judge(group: pa.Table) -> pa.Table:
        found = group.select(["page", "runs", "article", "texts"]).to_pydict()
        blocks_ = [list(zip(a, t)) for a, t in zip(found["article"], found["texts"])]
        known = [r if r is None else {x["run"]: x["inside"] for x in r} for r in found["runs"]]
        texts = main_texts(found["page"], blocks_, repeat, known)
        made = pa.array(texts, arrow_type(schemas.STRING))
        return pa.table({"page_id": group["page_id"], "url": group["url"], "text": made})

    return scanned.select("page_id", "url", "host", "shard", "page", "runs", "s.*").groupBy(
        "host", "shard"
    ).applyInArrow(judge, kind)
