"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint is the bitwise majority over the XXH64 hashes of its word shingles. Two
fingerprints link when they differ in at most ``radius`` bits. Equal fingerprints are grouped first,
so copies cost one row however many there are.

Search: the 64 bits are cut into segments, each with a radius of its own, such that the radii plus
one add up to more than the linking radius. Two linked fingerprints then lie within some segment's
radius. For each segment the table holds every fingerprint under its segment value, and every
fingerprint asks for the values in a small Hamming ball around its own; as the two values differ in
at most one bit, only the side that lacks the bit has to ask. Matches are kept after comparing all
64 bits.

Hot values: where a segment value is shared by more fingerprints than ``hot``, comparing all of them
would grow with the square. There the ball is enumerated over the whole fingerprint instead:
two fingerprints lie within 4 bits exactly if some 64-bit point lies within 2 bits of both. Each
member emits the points near it that have this segment value, and members that meet in a point
link to the least of them. This costs a fixed number of rows per member, and at most a ball's worth
of members can meet in one point, whatever the input. No link is lost either way.

Near copies of the pipeline (:func:`deduplicated`): each different set of five-word shingles has a
fingerprint, and the same search, with one bit in every segment, proposes for each fingerprint the
nearest one that it meets and the least. They link if their whole sets are similar. Members of a hot
value meet a few of them, its hubs, instead of each other. Similar sets whose fingerprints the search
does not bring together are linked by module ``similar``, which leaves out what is linked already.

Defined results: null and wordless texts have fingerprint zero, which links like any other. A
component's id is its smallest doc_id; documents without an id get it too, and a component without
any id has null. Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm import similar
from rankstream.llm.common import checkpoint, hidden, per_value, row_key, settle, unsized, working
from rankstream.llm.components import connected_components

Segments = tuple[tuple[int, int], ...]

SHINGLE = 4
SEED = 42
# Bits of the segments, lowest first, with the radius searched in each: 1 + 1 + 0 + 3 > 4.
SEGMENTS: Segments = ((21, 1), (21, 1), (22, 0))
RADIUS = 4
HOT = 64
# The pipeline's search: one bit in every segment, and pairs of at most WIDE bits are proposed. Texts of
# similarity 0.8 are about 10 bits apart; of unrelated fingerprints that meet, one pair in 1,000 is as near.
NEAR_SEGMENTS: Segments = ((21, 1), (21, 1), (22, 1))
WIDE = 12


def _fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    return majority([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])])


def majority(hashes: list[int] | np.ndarray) -> int:
    """The bits that are set in over half of the unsigned hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # long texts in steps
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int.from_bytes(majority.tobytes(), "little")


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of whole texts as a signed long with the same 64 bits."""
    return per_value(lambda t: _long(_fingerprint(t, shingle)), schemas.LONG)(text)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _segments(segments: Segments) -> list[tuple[int, int, int, int]]:
    """(index, lowest bit, bits, radius)"""
    found, low = [], 0
    for index, (bits, radius) in enumerate(segments):
        found.append((index, low, bits, radius))
        low += bits
    return found


def _long(value: int) -> int:
    """The signed long with the value's 64 bits."""
    return value - (1 << 64) if value >> 63 else value


def _mask(low: int, bits: int) -> int:
    return _long(((1 << bits) - 1) << low)


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(_long(v)).cast("long") for v in values])


def _balls(fps: DataFrame, flips: list[list[int]]) -> DataFrame:
    """(key, fp, point) for every flip of the fp's bits: the segment's bits stay the key's."""
    return fps.select(
        "seg", "key", "fp",
        F.explode(
            F.transform(
                F.element_at(F.array(*[_longs(f) for f in flips]), F.col("seg") + 1),
                lambda flip: F.col("base").bitwiseXOR(flip),
            )
        ).alias("point"),
    )


def _asked(index: int, low: int, bits: int, own: Column, both: bool) -> Column:
    """The segment values with one bit more than the fingerprint's own, and with one less for ``both``."""
    single = _longs([1 << b for b in range(low, low + bits)])
    lacking = single if both else F.filter(single, lambda bit: F.col("fp").bitwiseAND(bit) == 0)
    return F.transform(
        lacking, lambda bit: F.struct(F.lit(index).alias("seg"), own.bitwiseXOR(bit).alias("key"))
    )


def _entries(
    fps: DataFrame, segments: Segments, both: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(fp, seg, key): the values that fingerprints are held under, and those that they ask for besides.

    Of two values that differ in a bit only the side that lacks it asks, unless ``both`` shall.
    """
    members, askers = [], []
    for index, low, bits, radius in _segments(segments):
        own = F.col("fp").bitwiseAND(F.lit(_mask(low, bits)))
        entry = F.struct(F.lit(index).alias("seg"), own.alias("key"))
        members.append(entry)
        if radius:
            askers.append(_asked(index, low, bits, own, both))
    table = fps.select("fp", F.explode(F.array(*members)).alias("e")).select("fp", "e.seg", "e.key")
    probes = fps.select("fp", F.explode(F.concat(*askers)).alias("e")).select("fp", "e.seg", "e.key")
    return table, probes


def _links(fps: DataFrame, hot: int) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within the radius of each other.

    Pairs of cold segment values come as such; in hot ones members link to the least of a point.
    """
    table, probes = _entries(fps, SEGMENTS)
    sizes = settle(table.groupBy("seg", "key").count().filter(F.col("count") > hot), "hot").drop("count")

    cold = table.join(sizes, ["seg", "key"], "left_anti")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS
    others = cold.withColumnRenamed("fp", "other")
    shared = cold.alias("c").join(others, ["seg", "key"]).filter((F.col("fp") < F.col("other")) & near)
    asked = probes.join(others, ["seg", "key"]).filter(near)

    # whole-fingerprint balls inside hot values: two flips for members, one for askers
    rest = [[b for b in range(64) if not low <= b < low + bits] for _, low, bits, _ in _segments(SEGMENTS)]
    one = [[0, *(1 << b for b in free)] for free in rest]
    two = [o + [1 << x | 1 << y for i, x in enumerate(free) for y in free[:i]]
           for o, free in zip(one, rest)]
    masks = F.array(*[F.lit(_mask(low, bits)) for _, low, bits, _ in _segments(SEGMENTS)])
    outside = F.bitwise_not(F.element_at(masks, F.col("seg") + 1))
    based = F.col("fp").bitwiseAND(outside).bitwiseOR(F.col("key"))
    inside = table.join(sizes, ["seg", "key"], "left_semi").withColumn("base", based)
    beside = probes.join(sizes, ["seg", "key"], "left_semi").withColumn("base", based)
    points = _balls(inside, two).unionByName(_balls(beside, one))
    least = F.min("fp").over(Window.partitionBy("point"))
    met = points.select("fp", "point").withColumn("other", least).filter("fp <> other")
    pairs = [df.select("fp", "other") for df in (shared, asked, met)]
    return pairs[0].unionByName(pairs[1]).unionByName(pairs[2])


def roots(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(fp, root) for distinct fingerprints that have a neighbour; others are their own root."""
    linked = connected_components(_links(fps, hot))
    return linked.select(F.col("node").alias("fp"), "root")


def components(prints: DataFrame, hot: int = HOT) -> DataFrame:
    """``prints`` (doc_id, fp) with ``component_id``."""
    classes = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = classes.join(roots(classes.select("fp"), hot), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    prints = settle(
        docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprint(F.col(f"`{text}`")).alias("fp")),
        "prints",
    )
    return components(prints).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def proposed(
    fps: DataFrame, stage: Callable[[DataFrame, str], DataFrame], hot: int = HOT
) -> DataFrame:
    """Pairs (a, b), a < b: each fingerprint with the nearest that the search meets, and the least.

    At most two pairs for each fingerprint, however many lie near. Those in a hot value are met by its
    hubs only. A segment value is one row with all that are met in it, at most ``hot``, and of these an
    asker keeps the nearest and the least: rows grow with the fingerprints, not with their pairs.
    """
    best = _best(_meetings(fps, stage, hot))
    pairs = best.select("x", F.explode(F.array("near.y", "least")).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _best(meetings: DataFrame) -> DataFrame:
    """(x, near, least) of each fingerprint."""
    return meetings.groupBy("x").agg(F.min("near").alias("near"), F.min("least").alias("least"))


def _meetings(
    fps: DataFrame, stage: Callable[[DataFrame, str], DataFrame], hot: int
) -> DataFrame:
    """(x, near, least): a row for each segment value in which the fingerprint x meets others.

    Both sides of a pair ask, so that each finds the other in its own rows.
    """
    table, probes = _entries(fps, NEAR_SEGMENTS, both=True)
    hubs = F.array_distinct(F.array(F.min("fp"), F.min_by("fp", F.xxhash64("fp", "seg"))))
    shared = stage(
        table.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("members"), hubs.alias("hubs"))
        .filter(F.col("members") > hot).drop("members"),
        "hubs",
    )
    cold = table.join(shared, ["seg", "key"], "left_anti")
    held = cold.groupBy("seg", "key").agg(F.collect_list("fp").alias("others")).unionByName(
        shared.withColumnRenamed("hubs", "others")
    )

    def bits(other: Column) -> Column:
        return F.bit_count(F.col("fp").bitwiseXOR(other))

    near = F.transform(
        F.filter("others", lambda y: (F.col("fp") != y) & (bits(y) <= WIDE)),
        lambda y: F.struct(bits(y).alias("bits"), y.alias("y")),
    )
    asked = table.unionByName(probes).join(unsized(held), ["seg", "key"])
    met = asked.select(F.col("fp").alias("x"), near.alias("met"))
    return met.filter(F.size("met") > 0).select(
        "x", F.array_min("met").alias("near"), F.array_min("met.y").alias("least")
    )


def _proposed_classes(classes: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Pairs (a, b) of classes (cls, fp): those of one fingerprint with its least, which stands for it."""
    owners = stage(classes.groupBy("fp").agg(F.min("cls").alias("own")), "owners")
    same = classes.join(owners, "fp").filter("cls <> own").select("own", "cls")
    a = owners.select(F.col("fp").alias("a"), F.col("own").alias("a_cls"))
    b = owners.select(F.col("fp").alias("b"), F.col("own").alias("b_cls"))
    near = proposed(owners.select("fp"), stage).join(a, "a").join(b, "b").select("a_cls", "b_cls")
    pairs = same.union(near).toDF("x", "y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each group of similar texts, that with the smallest id (ids before nulls).

    Groups are the components of all pairs whose five-word shingles have Jaccard similarity 0.8 or
    more: those that the multi-index search proposes, and the rest from module ``similar``. op2's
    components of 4 bits are far stricter.
    Among rows with the same id a hash of the row decides; equal rows stay once.
    """
    with working(docs.sparkSession) as stage:
        losers = settle(_losers(docs, text, key, stage), "losers")
    first, second = hidden("a"), hidden("b")
    k1, k2 = row_key(docs)
    keyed = docs.withColumn(first, k1).withColumn(second, k2)
    lost = losers.select(F.col("k1").alias(first), F.col("k2").alias(second))
    kept = keyed.join(lost, [first, second], "left_anti")
    return kept.dropDuplicates([first, second]).select(*[F.col(f"`{c}`") for c in docs.columns])


def _losers(
    docs: DataFrame, text: str, key: str, stage: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Row keys (k1, k2) of the documents that a better one of their group replaces."""
    first, second = hidden("a"), hidden("b")
    k1, k2 = row_key(docs)
    content = F.col(f"`{text}`")
    print_ = similar.signature(docs, content, k1, lambda hashes: _long(majority(hashes)))
    with working(docs.sparkSession) as step:  # the elements are large; few are shared
        signed = step(
            docs.select(
                F.col(f"`{key}`").alias("doc_id"), print_.alias("s"), k1.alias("k1"), k2.alias("k2")
            ).select("doc_id", "s.*", "k1", "k2"),
            "signed",
        )
        prints = stage(signed.select("doc_id", "cls", "k1", "k2"), "prints")
        rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")
        classes = stage(
            signed.groupBy("cls").agg(
                *[F.first(c).alias(c) for c in ("fp", "n", "odd")],  # one set, one value of each
                F.min(rank).alias("best"),
            ),
            "classes",
        )
        elements = signed.select("cls", "n", "counted", F.posexplode("prefix").alias("at", "token"))
        members = similar.members(elements, stage)

    def sets_of(wanted: DataFrame) -> DataFrame:
        rows = classes.join(unsized(wanted), "cls").select(
            "cls", F.col("best.k1").alias(first), F.col("best.k2").alias(second)
        )
        texts = docs.select(content.alias("text"), k1.alias(first), k2.alias(second))
        # equal rows hold equal texts; one is enough
        found = texts.join(rows, [first, second]).dropDuplicates([first, second])
        return found.select("cls", similar.shingles(F.col("text")).alias("tokens"))

    linked = similar.roots(
        members, _proposed_classes(classes.select("cls", "fp"), stage),
        classes.select("cls", "n", "odd"), sets_of, stage,
    )
    rooted = classes.select("cls", "best").join(linked, "cls", "left").withColumn(
        "root", F.coalesce("root", "cls")
    )
    winners = rooted.groupBy("root").agg(F.min("best").alias("winner"))
    placed = prints.select("cls", rank.alias("own")).join(rooted.select("cls", "root"), "cls")
    lost = placed.join(winners, "root").filter(F.col("own") != F.col("winner"))
    return lost.select("own.k1", "own.k2").distinct()
