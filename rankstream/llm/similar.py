"""Pairs of texts with Jaccard similarity of 0.8 or more of their word shingles, without loss.

A text is the set of the XXH64 hashes of its five-word shingles. All sets are sorted by one global
order. Of two sets with similarity t or more, the first ``n - ceil(t * n) + 1`` elements of each
share at least one (prefix filter), so candidates are the sets that meet in such an element. Behind
the first element that two similar sets share there must be room for all others they share
(positional filter). What passes is compared by the parities of the sets' elements in ``BITS`` slots: two sets
have at least as many elements apart as slots differ. What is left is compared by its whole sets. The order is free. First come the shingles
of the lowest quarter of hashes, those that fewest texts hold before others: they are counted in all texts, so
that a text whose first elements are its own makes no candidates, however many texts there are. Others follow,
and last those that a sample of the texts repeats.

Groups: equal sets are one class first. Pairs that the search by fingerprints proposes (module
``simhash``) are compared before all others, and what they link is not searched again. Members of an
element are then compared with one of them, its hub, in some rounds with other hubs, as long as they lie
in different components: that links a large group of near copies by a few pairs a member. Only members
whose components differ after that are compared with each other. No pair across components is left out.

Limits: texts with few counted shingles of their own reach into elements that are not counted. Those that many
such texts share make candidates by the square of the members that pass the positional filter and are not
linked to each other.

Defined results: null, empty and blank texts have the empty set and are one class; texts of fewer words
than a shingle are one shingle, their whole sequence. Equal sets are one class whatever the texts' white
space and case. Long texts are sets like any other. No rows give no links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import per_value, shuffles_dropped, unsized, working
from rankstream.llm.components import connected_components

SHINGLE = 5
SEED = 42
# Similarity as a fraction of whole numbers, so that its bounds are exact: 4 / 5.
TOP, BOTTOM = 4, 5
# Shingles below this hash, a quarter of them, are counted in all texts.
EDGE = -(1 << 62)
BITS = 1024
# Sampled texts, and how many shingles of at least COMMON sampled texts are put last.
SAMPLE, LAST, COMMON = 20_000, 100_000, 3

# Rounds of comparing with hubs, and how many hubs a large group has in one.
ROUNDS, HUBS = 2, 4

SIGNATURE = schemas.struct(
    cls=schemas.LONG, fp=schemas.LONG, n=schemas.LONG, counted=schemas.LONG,
    prefix=schemas.array(schemas.LONG), odd=schemas.array(schemas.LONG),
)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The text's different shingle hashes as sorted signed longs; none for wordless texts."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64).view(np.int64)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    hashes = (digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :]))
    return np.unique(np.fromiter(hashes, np.uint64, len(words) - shingle + 1).view(np.int64))


def shingles(text: Column) -> Column:
    return per_value(lambda t: shingle_set(t).tolist(), schemas.array(schemas.LONG))(text)


def _odd(own: np.ndarray) -> list[int]:
    """A bit for each slot that holds an odd number of elements, as longs."""
    odd = np.bincount(own & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _signature(
    last: Callable[[], tuple[np.ndarray, np.ndarray]], fingerprint: Callable[[np.ndarray], int]
):
    def of(text: str | None):
        own, (common, ranks) = shingle_set(text), last()
        if not own.size:
            return {"cls": 0, "fp": 0, "n": 0, "counted": 0, "prefix": [], "odd": _odd(own)}
        rank = np.zeros(own.size, np.int64)
        if common.size:
            at = np.minimum(np.searchsorted(common, own), common.size - 1)
            rank = np.where(common[at] == own, ranks[at], 0)
        keep = own.size + 1 + (-TOP * own.size) // BOTTOM
        counted = int(((rank == 0) & (own < EDGE)).sum())
        prefix = own[np.lexsort((own, rank))[: max(keep, counted)]]
        cls = np.array([xxhash.xxh64_intdigest(own.tobytes(), SEED)], np.uint64).view(np.int64)[0]
        fp = fingerprint(own.view(np.uint64))
        return {
            "cls": int(cls), "fp": fp, "n": int(own.size), "counted": counted, "prefix": prefix.tolist(),
            "odd": _odd(own),
        }

    return of


def signature(
    texts: DataFrame, text: Column, salt: Column, fingerprint: Callable[[np.ndarray], int]
) -> Column:
    """Class, fingerprint of the set, size, first elements and parities of each text.

    The elements are all its ``counted`` elements, and as many others as its prefix may need besides; a sample of
    ``texts`` tells which come last.
    """
    with shuffles_dropped(texts.sparkSession), working(texts.sparkSession) as step:
        dealt = F.pmod(salt, F.lit(max(1, -(-texts.count() // SAMPLE)))) == 0
        sampled = texts.filter(dealt).select(F.explode(shingles(text)).alias("token"))
        often = sampled.groupBy("token").count().filter(F.col("count") >= COMMON)
        # stored first: each task would send the driver as many rows
        rows = step(often.orderBy(F.col("count").desc(), "token").limit(LAST), "common").toArrow()
    tokens, counts = (rows.column(c).to_numpy() for c in ("token", "count"))
    order = np.argsort(tokens)
    sent = texts.sparkSession.sparkContext.broadcast((tokens[order], counts[order]))
    return per_value(_signature(lambda: sent.value, fingerprint), SIGNATURE, once=True)(text)


def members(elements: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(cls, n, token, left): the elements of prefixes that several classes hold.

    ``elements`` (cls, n, counted, at, token) holds what :func:`signature` gives, repeated or not. ``left``
    counts a set's elements from the token on.
    """
    met = stage(
        elements.groupBy("token")
        .agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count(F.lit(1)).alias("often"))
        .filter("low < high").select("token", "often"),
        "met",
    )
    early = F.col("at") < F.col("counted")
    sets = elements.join(unsized(met), "token").groupBy("cls", "n", "counted").agg(
        F.array_sort(F.collect_set(F.when(early, F.struct("often", "token")))).alias("early"),
        F.collect_set(F.when(~early, F.struct("at", "token"))).alias("late"),
    )
    # before the counted elements that others hold too lie those that the set alone has
    own = F.col("counted") - F.size("early")
    placed = F.concat(
        F.transform(
            "early", lambda e, i: F.struct((F.col("n") - own - i).alias("left"), e["token"].alias("token"))
        ),
        F.transform("late", lambda e: F.struct((F.col("n") - e["at"]).alias("left"), e["token"].alias("token"))),
    )
    rows = sets.select("cls", "n", F.explode(placed).alias("e")).select("cls", "n", "e.token", "e.left")
    inside = F.col("left") * BOTTOM >= F.col("n") * TOP  # within the prefix
    return stage(rows.filter(inside), "members")


def _close(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and parities do not tell apart; no similar one is lost."""
    a, b = (
        sketches.select(F.col("cls").alias(x), F.col("n").alias(f"{x}_n"), F.col("odd").alias(f"{x}_odd"))
        for x in "ab"
    )
    differ = [F.bit_count(F.col("a_odd")[i].bitwiseXOR(F.col("b_odd")[i])) for i in range(BITS // 64)]
    apart = F.greatest(sum(differ[1:], differ[0]), F.abs(F.col("a_n") - F.col("b_n")))
    near = apart * (TOP + BOTTOM) <= (BOTTOM - TOP) * (F.col("a_n") + F.col("b_n"))
    return pairs.join(a, "a").join(b, "b").filter(near).select("a", "b")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    a = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("at"))
    b = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("bt"))
    both = F.size(F.array_intersect("at", "bt"))
    enough = both * (TOP + BOTTOM) >= TOP * (F.size("at") + F.size("bt"))
    return pairs.join(a, "a").join(b, "b").filter(enough).select("a", "b")


def _meets(other: DataFrame) -> Column:
    """Whether members of one token can be similar, by sizes and by the token's places.

    ``left`` counts the elements from the token on. The first element that two similar sets share
    leaves room for all they must share, so a pair is found at least there.
    """
    size, rest = F.col("n"), F.col("left")
    o_size, o_rest = other["o_n"], other["o_left"]
    fits = F.least(size, o_size) * BOTTOM >= F.greatest(size, o_size) * TOP
    return fits & (F.least(rest, o_rest) * (TOP + BOTTOM) >= (size + o_size) * TOP)


def roots(
    members: DataFrame,
    proposed: DataFrame,
    sketches: DataFrame,
    sets_of: Callable[[DataFrame], DataFrame],
    stage: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """(cls, root) of classes that have a similar one.

    ``members`` (cls, n, token, left) comes from :func:`members`. ``proposed`` (a, b) holds pairs to compare first, ``sketches``
    (cls, n, odd) the sizes and parities of all classes. ``sets_of`` gives
    (cls, tokens), the whole sets, for a frame of classes; ``stage`` stores a step's rows and reads
    them back.
    """
    def compared(pairs: DataFrame, label: str) -> DataFrame:
        with working(pairs.sparkSession) as step:  # whole sets are large, and of no use afterwards
            close = step(_close(pairs, sketches), f"{label}-close")
            wanted = close.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
            return stage(_similar(close, step(sets_of(wanted), f"{label}-sets")), label)

    tried = stage(proposed.distinct(), "proposed")
    known = connected_components(compared(tried, "near"), stage).toDF("cls", "root")

    open_ = _split(members, known, stage)

    def named(rows: DataFrame) -> DataFrame:
        others = [F.col(c).alias(f"o_{c}") for c in rows.columns if c != "token"]
        return unsized(rows.select("token", *others))

    def pairs_of(met_pairs: DataFrame) -> DataFrame:
        ends = F.least("cls", "o_cls").alias("a"), F.greatest("cls", "o_cls").alias("b")
        return met_pairs.select(*ends).distinct()

    for number in range(ROUNDS):
        # first the members with the least before the token: of copies with edits, whose own elements
        # come first, those with fewest; then a few for all the tokens of a large group
        draw = F.xxhash64("cls", F.pmod("token", F.lit(HUBS)), F.lit(number))
        order = F.struct((F.col("n") - F.col("left")).alias("before"), draw) if not number else draw
        drawn = open_.groupBy("token").agg(F.min_by(F.struct("cls", "n", "left", "root"), order).alias("hub"))
        hubs = named(drawn.select("token", "hub.*"))
        fresh = pairs_of(open_.join(hubs, "token").filter(_apart() & _meets(hubs)))
        fresh = stage(fresh.join(tried, ["a", "b"], "left_anti"), f"tried{number}")
        known = _joined(known, compared(fresh, f"linked{number}"), stage)
        tried = tried.unionByName(fresh)
        open_ = _split(open_.drop("root"), known, stage)
    other = named(open_)
    across = open_.join(other, "token").filter(
        (F.col("o_cls") < F.col("cls")) & _apart() & _meets(other)
    )
    rest = stage(pairs_of(across).join(tried, ["a", "b"], "left_anti"), "rest")
    return _joined(known, compared(rest, "more"), stage)


def _apart() -> Column:
    return F.col("root") != F.col("o_root")


def _joined(
    known: DataFrame, links: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """The components ``known`` (cls, root) with the links (a, b) as well: only roots are searched again."""
    a = known.select(F.col("cls").alias("a"), F.col("root").alias("a_root"))
    b = known.select(F.col("cls").alias("b"), F.col("root").alias("b_root"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
    )
    moved = connected_components(between, stage)
    carried = known.join(moved.toDF("root", "least"), "root", "left").select(
        "cls", F.coalesce("least", "root").alias("root")
    )
    fresh = moved.toDF("cls", "root").join(known, "cls", "left_anti")
    return stage(carried.unionByName(fresh), "known")


def _split(
    members: DataFrame, known: DataFrame, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Members with the ``root`` of their component, of tokens that still lie in several."""
    placed = members.join(known, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    split = (
        placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low < high").select("token")
    )
    return stage(placed.join(split, "token", "left_semi"), "open")
