"""Benchmark decontamination by the q-gram lemma in diagonal bands, then banded alignment.

A document is contaminated by an item if some window of the item occurs in it with at most
``length // PER_EDIT`` edits (5 %). Windows are all runs of ``WINDOW`` characters, from every start, all
runs of ``WORDS`` whole words that are shorter than that, and the whole item where it is no longer. So a
passage of either length is found wherever in the item it starts. A window of w characters within k
edits shares at least w + 1 - q - q*k character q-grams with the region, and all of them lie on
diagonals (place in the document minus place in the item) at most k apart. So per document: q-grams that
the benchmark has are looked up, places are kept where enough hits lie close together, hits are collected
per item in overlapping diagonal bands of width 2(k+1), counted for each window there, and for windows
that reach the bound a banded alignment decides. Nothing but case and the kind of white space is folded.

Windows so short that the bound would be 0 or less share a q-gram of ``HALF`` characters, and are found by
those.

One pass hashes each text once and looks its q-grams up in a bit table of the whole benchmark's, of at
most ``2 ** MOST_BITS`` bits. The surroundings of places with enough hits, the passages, go on; texts do not
move. Passages meet the benchmark's q-grams in a join, which names the blocks of the benchmark they share
some with. A block holds about ``BLOCK_CHARS / 4`` characters of items, so that its index has a bounded
size, and takes its passages in portions of about ``PORTION``. Items longer than ``PIECE`` are cut into
pieces that overlap by more than a window. A larger benchmark makes more blocks, not more passes.

Defined results: null and empty texts match nothing; items shorter than ``Q`` characters are no
evidence and match nothing; an item repeated in the benchmark reports each of its ids; documents
with the same id share their rows; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import hidden, row_key, settle, unsized

Q = 12
HALF = 10
WINDOW = 80
STRIDE = 1
WORDS = 13
PIECE = 10_000
PER_EDIT = 20
BLOCK_CHARS = 1_000_000
PORTION = 5_000
MOST_BITS = 28
_BITS = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BATCH_CHARS = 500_000

LONG = schemas.LONG
GRAMS = schemas.struct(block=LONG, q=LONG, least=LONG, span=LONG, hash=LONG)
PASSAGES = schemas.struct(
    doc_id=LONG, k1=LONG, k2=LONG, start=LONG, text=schemas.STRING, hashes=schemas.array(LONG)
)
HITS = schemas.struct(
    doc_id=LONG, k1=LONG, k2=LONG, item_id=LONG, start=LONG, end=LONG, edits=LONG
)


def _folding() -> np.ndarray:
    """Lower case where it is one character, and one kind of white space."""
    table = np.arange(0x10000, dtype=np.uint32)
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        low = char.lower()
        table[code] = 32 if char.isspace() else ord(low) if len(low) == 1 else code
    return table


_TABLE: list[np.ndarray] = []


def fold(text: str) -> np.ndarray:
    """The text's code points, case and white space folded one to one."""
    if not _TABLE:
        _TABLE.append(_folding())
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if codes.size and codes.max() >= 0x10000:
        return np.where(codes < 0x10000, _TABLE[0][np.minimum(codes, 0xFFFF)], codes)
    return _TABLE[0][codes]


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the ``q`` characters from each place; q is 10 or 12."""
    if codes.size < q:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power = [_BASE]
        for _ in range(3):
            power.append(power[-1] * power[-1])
        one = codes.astype(np.uint64) + np.uint64(1)
        two = one[:-1] * power[0] + one[1:]
        four = two[:-2] * power[1] + two[2:]
        eight = four[:-4] * power[2] + four[4:]
        if q == HALF:
            return (eight[:-2] * power[1] + two[8:]) * power[3]
        return (eight[:-4] * power[2] + four[8:]) * _BASE


class Piece:
    """A part of an item with its windows; ``first`` and ``last`` tell whether its ends are the item's."""

    def __init__(self, item: int, text: str, first: bool = True, last: bool = True):
        self.item, self.codes = item, fold(text)
        size = int(self.codes.size)
        if size <= WINDOW:
            found = {(0, size)}
        else:
            found = {(s, WINDOW) for s in (*range(0, size - WINDOW, STRIDE), size - WINDOW)}
        spaces = np.r_[True, self.codes == 32, True]
        begins = np.flatnonzero(spaces[:-2] & ~spaces[1:-1])
        ends = np.flatnonzero(~spaces[1:-1] & spaces[2:]) + 1
        for start, end in zip(begins.tolist(), ends[WORDS - 1 :].tolist()):
            whole = (start > 0 or first) and (end < size or last)  # a piece may cut a word
            if whole and end - start < WINDOW:
                found.add((start, end - start))
        self.start, self.length = np.array(sorted(found), np.int64).T
        self.edits = self.length // PER_EDIT
        # by the lemma; where it says nothing the item is one short window, told by shorter grams
        self.q = Q if (self.length + 1 - Q - Q * self.edits > 0).all() else HALF
        self.shared = self.length + 1 - self.q - self.q * self.edits
        self.span = int((self.length + self.edits).max())


def _dense(places: np.ndarray, least: int, reach: int) -> np.ndarray:
    """Places of hits that have enough hits within one window's reach, before or after."""
    if places.size < least:
        return places[:0]
    close = places[least - 1 :] - places[: places.size - least + 1] < reach
    marks = np.zeros(places.size + 1, np.int64)  # runs of `least` hits that lie close
    starts = np.flatnonzero(close)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + least, -1)
    return places[np.cumsum(marks[:-1]) > 0]


class _Grams:
    """The grams of one length of some pieces."""

    def __init__(self, q: int, pieces: list[Piece]):
        self.q, self.pieces = q, pieces
        hashes = [gram_hashes(p.codes, q) for p in pieces]
        sizes = [h.size for h in hashes]
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.piece = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.place = np.concatenate([np.arange(s) for s in sizes])[order]
        self.present = np.zeros(1 << _BITS, bool)
        self.present[self.hashes >> np.uint64(64 - _BITS)] = True
        self.each = np.array([int(p.shared.min()) for p in pieces])
        self.edits = max(int(p.edits.max()) for p in pieces)

    def search(self, codes, owner, origin, any_window, found) -> None:
        hashes = gram_hashes(codes, self.q)
        maybe = np.flatnonzero(self.present[hashes >> np.uint64(64 - _BITS)])
        places = _dense(maybe, int(self.each.min()), max(p.span for p in self.pieces))
        left = np.searchsorted(self.hashes, hashes[places], "left")
        count = np.searchsorted(self.hashes, hashes[places], "right") - left
        if not count.sum():
            return
        rows = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(
            np.cumsum(count) - count, count
        )
        where, piece, place = np.repeat(places, count), self.piece[rows], self.place[rows]
        who, half = owner[where].astype(np.int64), self.edits + 1
        diagonal = where + origin[who] - place  # of the whole text, so that bands are the same
        for shifted in (0, 1):  # every spread of k diagonals lies whole in one of two bands
            band = (diagonal + shifted * half) // (2 * half)
            order = np.lexsort((place, band, piece, who))
            key = np.stack([who, piece, band])[:, order]
            cut = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
            ends = np.r_[cut[1:], order.size]
            for at in np.flatnonzero(ends - cut >= self.each[key[1, cut]]).tolist():
                hits = np.unique(place[order[cut[at] : ends[at]]])
                text, number, which = key[:, cut[at]].tolist()
                if text >= 0:
                    low = (2 * which - shifted) * half - int(origin[text])
                    self._verified(codes, owner, text, self.pieces[number], hits, low, any_window, found)

    def _verified(self, codes, owner, text, piece, hits, low, any_window, found) -> None:
        """Adds the piece's windows that match on the diagonals from ``low`` on."""
        last = piece.start + piece.length - self.q
        n = np.searchsorted(hits, last, "right") - np.searchsorted(hits, piece.start)
        for row in np.flatnonzero(n >= piece.shared).tolist():
            first, length, budget = (int(x[row]) for x in (piece.start, piece.length, piece.edits))
            start = max(0, first + low - budget)
            end = min(codes.size, first + low + 2 * (self.edits + 1) + length + budget)
            mine = np.flatnonzero(owner[start:end] == text)
            if not mine.size:
                continue
            start, end = start + int(mine[0]), start + int(mine[-1]) + 1
            edits, a, b = align(piece.codes[first : first + length], codes[start:end], budget)
            if edits <= budget:
                found.add((text, piece.item, start + a, start + b, edits))
                if any_window:
                    return


class Index:
    """A bounded number of pieces, given as (item, text) and, for parts, first and last."""

    def __init__(self, pieces: list[tuple]):
        found = [Piece(*p) for p in pieces]
        by_length = {q: [p for p in found if p.q == q and p.codes.size >= Q] for q in (Q, HALF)}
        self.grams = [_Grams(q, some) for q, some in by_length.items() if some]

    def search(
        self, codes: np.ndarray, owner: np.ndarray, origin: np.ndarray, any_window: bool = False
    ) -> list[tuple[int, int, int, int, int]]:
        """(owner, item, start, end, edits) over concatenated texts; -1 owns separators.

        ``origin`` is added to a place to get that in the owner's whole text, for each owner and last
        for separators. ``any_window`` ends the search of a band at its first match.
        """
        found: set[tuple[int, int, int, int, int]] = set()
        for grams in self.grams:
            grams.search(codes, owner, origin, any_window, found)
        return sorted(found)


def _least_edits(window: list[int], region: list[int]) -> int:
    """Least edits of the window against any part of the region, a column of the table at a time in bits."""
    at: dict[int, int] = {}
    for i, char in enumerate(window):
        at[char] = at.get(char, 0) | 1 << i
    full, last = (1 << len(window)) - 1, 1 << (len(window) - 1)
    up, down, score = full, 0, len(window)
    best = score
    for char in region:
        x = at.get(char, 0) | down
        flat = ((up + (x & up)) ^ up) | x
        more, less = (down | ~(up | flat)) & full, up & flat
        if more & last:
            score += 1
        elif less & last:
            score -= 1
            best = min(best, score)
        shifted = more << 1
        down, up = shifted & flat & full, (less << 1 | ~(shifted | flat)) & full
    return best


def align(window: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int, int]:
    """Least edits of the whole window against a part of the region, with the part's bounds.

    Ends free in the region. Rows hold only cells that can stay within the budget, which bounds
    the width to the region's slack plus the budget; more than the budget returns budget + 1.
    """
    needle, hay = window.astype("<u4").tobytes(), region.astype("<u4").tobytes()
    at = hay.find(needle)
    while at >= 0 and at % 4:
        at = hay.find(needle, at + 1)
    if at >= 0:
        return 0, at // 4, at // 4 + window.size
    far = budget + 1
    text = region.tolist()
    if _least_edits(window.tolist(), text) > budget:
        return far, 0, 0
    row = {j: (0, j) for j in range(len(text) + 1)}  # column: (edits, where the part starts)
    for char in window.tolist():
        following: dict[int, tuple[int, int]] = {}
        for j, (cost, begin) in row.items():
            step = (cost + 1, begin)  # window character dropped
            if step[0] < far and step < following.get(j, (far, 0)):
                following[j] = step
            if j < len(text):
                step = (cost + (text[j] != char), begin)
                if step[0] < far and step < following.get(j + 1, (far, 0)):
                    following[j + 1] = step
        for j in sorted(following):  # region characters skipped, left to right
            cost, begin = following[j]
            while cost + 1 < far and j < len(text) and (cost + 1, begin) < following.get(j + 1, (far, 0)):
                cost, j = cost + 1, j + 1
                following[j] = (cost, begin)
        row = following
        if not row:
            return far, 0, 0
    edits, begin, end = min((cost, begin, j) for j, (cost, begin) in row.items())
    return edits, begin, end


def _search_passages(
    index: Index, passages: Iterable[tuple[int, str]], any_window: bool = False
) -> list[tuple[int, int, int, int, int]]:
    """(number, item, start, end, edits) of passages given as (start in the text, passage).

    Passages are searched together up to a bounded number of characters.
    """
    found: list[tuple[int, int, int, int, int]] = []
    group: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def run():
        parts, owners, origin, at = [], [], [], 0
        gap = np.zeros(1, np.uint32)
        for order, (_, start, codes) in enumerate(group):
            origin.append(start - at)
            parts += [codes, gap]
            owners += [np.full(codes.size, order, np.int32), np.full(1, -1, np.int32)]
            at += codes.size + 1
        shifts = np.array([*origin, 0], np.int64)
        for order, item, start, end, edits in index.search(
            np.concatenate(parts), np.concatenate(owners), shifts, any_window
        ):
            found.append((group[order][0], item, start + origin[order], end + origin[order], edits))

    for number, (start, text) in enumerate(passages):
        group.append((number, start, fold(text)))
        size += len(text)
        if size >= _BATCH_CHARS:
            run()
            group, size = [], 0
    if group:
        run()
    return sorted(set(found))


# -- the benchmark -------------------------------------------------------------------------


def pieces(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, start, text, first, last): overlapping pieces that cover every item whole."""
    content, length = F.col(f"`{text}`"), F.char_length(F.col(f"`{text}`"))
    step = PIECE - 2 * WINDOW
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), length - 2 * WINDOW - 1), F.lit(step))
    placed = benchmark.filter(length >= Q).select(
        F.col(f"`{key}`").cast("long").alias("item"), content.alias("content"), length.alias("size"),
        F.explode(starts).alias("start"),
    )
    return placed.select(
        "item", "start", F.substring("content", F.col("start") + 1, F.lit(PIECE)).alias("text"),
        (F.col("start") == 0).alias("first"), (F.col("start") + PIECE >= F.col("size")).alias("last"),
    )


def _blocks(benchmark: DataFrame) -> DataFrame:
    """The pieces with the number of their block."""
    cut = settle(pieces(benchmark), "pieces")
    total = cut.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (BLOCK_CHARS // 4)))
    return cut.withColumn("block", F.pmod(F.xxhash64("item", "start", "text"), F.lit(blocks)).cast("long"))


def _grams_of(batches):
    for batch in batches:
        for row in batch.to_pylist():
            piece = Piece(row["item"], row["text"], row["first"], row["last"])
            hashes = np.unique(gram_hashes(piece.codes, piece.q)).view(np.int64)
            fixed = (row["block"], piece.q, int(piece.shared.min()), piece.span)
            yield pa.RecordBatch.from_arrays(
                [*(pa.repeat(pa.scalar(v, pa.int64()), hashes.size) for v in fixed), pa.array(hashes)],
                names=GRAMS.fieldNames(),
            )


class Filter:
    """Bit tables that tell which hashes may be grams, with what ``_dense`` asks of them, per length."""

    def __init__(self, grams: DataFrame):
        count = grams.select("hash").distinct().count()
        self.bits = min(MOST_BITS, max(18, (16 * count).bit_length()))
        asked = grams.groupBy("q").agg(F.min("least"), F.max("span")).collect()
        self.lengths = {q: (least, span) for q, least, span in asked}  # two rows at most
        slot = F.shiftrightunsigned("hash", 64 - self.bits)
        words = grams.select("q", F.shiftright(slot, 15).alias("word"), slot.bitwiseAND(32767).alias("bit"))
        found = words.groupBy("q", "word").agg(F.bitmap_construct_agg("bit").alias("set")).collect()
        self.tables = {q: np.zeros(1 << (self.bits - 3), np.uint8) for q in self.lengths}
        for row in found:  # bounded by the bits of the tables
            self.tables[row["q"]][row["word"] * 4096 : (row["word"] + 1) * 4096] = np.frombuffer(row["set"], np.uint8)

    @property
    def reach(self) -> int:
        """Characters to either side of a hit that a window around it and its edits can take."""
        return 2 * (max((span for _, span in self.lengths.values()), default=0) + Q)

    def hits(self, codes: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Places with enough hits around them, and their hashes."""
        hashes = gram_hashes(codes, q)
        slots = hashes >> np.uint64(64 - self.bits)
        table = self.tables[q]
        maybe = (table[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1
        places = _dense(np.flatnonzero(maybe), *self.lengths[q])
        return places, hashes[places].view(np.int64)


def passages_of(known: Filter, text: str) -> list[tuple[int, str, np.ndarray]]:
    """(start, passage, hashes) of a whole text; long texts are hashed in overlapping steps."""
    places, hashes = [], []
    for at in range(0, len(text), _BATCH_CHARS):
        codes = fold(text[at : at + _BATCH_CHARS + known.reach])
        for q in known.lengths:
            where, found = known.hits(codes, q)
            places.append(where + at)
            hashes.append(found)
    if not places or not sum(p.size for p in places):
        return []
    place, found = np.concatenate(places), np.concatenate(hashes)
    order = np.argsort(place, kind="stable")
    place, found = place[order], found[order]
    cuts = np.flatnonzero(np.r_[True, np.diff(place) > 2 * known.reach])
    made = []
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), place.size]):
        start = max(0, int(place[low]) - known.reach)
        made.append((start, text[start : int(place[high - 1]) + known.reach + Q], np.unique(found[low:high])))
    return made


def _scanning(sent):
    def scan(batches):
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):  # one text at a time is a Python object
                text = batch.column(3)[i].as_py()
                keys = [batch.column(c)[i].as_py() for c in range(3)] if text else []
                rows += [(*keys, *p) for p in passages_of(sent.value, text or "")]
            columns = list(zip(*rows)) if rows else [()] * len(PASSAGES.fields)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=PASSAGES.fieldNames()
            )

    return scan


def _searching(any_window: bool):
    def search(passages: pa.Table, cut: pa.Table) -> pa.Table:
        if passages.num_rows and cut.num_rows:
            items = cut.sort_by([("item", "ascending"), ("start", "ascending")]).to_pylist()
            index = Index([(r["item"], r["text"], r["first"], r["last"]) for r in items])
            given = zip(passages.column("start").to_pylist(), passages.column("text").to_pylist())
            hits = _search_passages(index, given, any_window)
        else:
            hits = []
        columns = list(zip(*hits)) if hits else [()] * 5
        which = pa.array(columns[0], pa.int64())
        return pa.table(
            [*(passages.column(c).take(which) for c in ("doc_id", "k1", "k2")),
             *(pa.array(c, pa.int64()) for c in columns[1:])],
            names=HITS.fieldNames(),
        )

    return search


def _hits(keyed: DataFrame, benchmark: DataFrame, any_window: bool) -> DataFrame:
    """Matched windows of documents given as (doc_id, k1, k2, text)."""
    cut = settle(_blocks(benchmark), "blocks")
    grams = settle(cut.mapInArrow(_grams_of, GRAMS), "grams")
    sent = keyed.sparkSession.sparkContext.broadcast(Filter(grams))  # bounded by MOST_BITS
    passages = settle(
        keyed.mapInArrow(_scanning(sent), PASSAGES).withColumn("number", F.monotonically_increasing_id()),
        "passages",
    )
    asked = passages.select("number", F.explode("hashes").alias("hash")).distinct()
    known = grams.select("hash", "block").distinct()
    pairs = settle(asked.join(unsized(known), "hash").select("number", "block").distinct(), "pairs")
    loads = settle(
        pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / PORTION).alias("portions")), "loads"
    )
    portion = F.pmod(F.xxhash64("number"), F.col("portions")).alias("portion")
    dealt = passages.drop("hashes").join(pairs, "number").join(loads, "block")
    dealt = dealt.select("block", portion, *[f.name for f in PASSAGES.fields if f.name != "hashes"])
    portions = loads.select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("portion")
    )
    each = portions.alias("p").join(cut, "block").select("p.block", "p.portion", *cut.drop("block").columns)
    by = ["block", "portion"]
    return dealt.groupBy(*by).cogroup(each.groupBy(*by)).applyInArrow(_searching(any_window), HITS)


def regions(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, item_id, start, end, windows, edits: one row per contaminated (document, item).

    ``start`` and ``end`` bound all matched windows, in characters of the text; ``edits`` is the
    least of a window.
    """
    none = F.lit(0).cast("long")
    keyed = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), none.alias("k1"), none.alias("k2"),
        F.col(f"`{text}`").alias("text"),
    )
    return _hits(keyed, benchmark, False).groupBy("doc_id", "item_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.count_distinct("start", "end", "edits").alias("windows"), F.min("edits").alias("edits"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark passage."""
    k1, k2 = row_key(docs)
    none = F.lit(0).cast("long")
    keyed = docs.select(none.alias("doc_id"), k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text"))
    dirty = settle(_hits(keyed, benchmark, True).select("k1", "k2").distinct(), "dirty")
    first, second = hidden("a"), hidden("b")
    lost = dirty.select(F.col("k1").alias(first), F.col("k2").alias(second))
    kept = docs.withColumn(first, k1).withColumn(second, k2).join(lost, [first, second], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
