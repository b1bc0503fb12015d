"""Substring dedup: words covered by fixed-length windows that an earlier document holds as well.

A window is ``WINDOW`` consecutive words. It is removed from a document if its word sequence also
starts in a document with a smaller id; removed windows merge into maximal intervals of words.
Windows are judged on the input, not on what is left.

Hashing: a window's hash is the Rabin-Karp polynomial of its words' XXH64 hashes, modulo 2^64, in two
lanes with bases of their own (128 bits together). Prefix sums give all windows of a text at once.

Counting: texts with equal word sequences form a class, and all members but those with the least id
are covered whole. Of the others, a window can repeat only if its mark does, the least hash of the
``MARK``-word grams in it, and a text has about one mark in four windows. So marks are counted first,
and windows are hashed in full and counted only where the mark lies in two classes. Equal windows
have equal marks, so no window is lost. Each count is combined before its shuffle, and the least id
of a window is joined back to its places, so that a window shared by a third of the documents is
spread over many tasks. Working tables are dropped at the end.

Defined results: null, empty and blank texts have no words; texts shorter than a window lose none.
Windows repeated within one document only, or among rows of one id, stay. A document without an id
loses what any document with an id holds, and takes nothing from others. Repeated rows get a row
each; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import arrow_type, row_key, settle, working

WINDOW = 13
MARK = 7
# Odd bases of the two lanes and the multiplier that gives the second lane words of its own.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_CHUNK = 256  # texts that become Python objects at a time

LONGS = schemas.array(schemas.LONG)
SPANS = schemas.array(schemas.struct(start=schemas.LONG, end=schemas.LONG))
PRINT = schemas.struct(
    doc_id=schemas.LONG, k1=schemas.LONG, k2=schemas.LONG, w1=schemas.LONG, w2=schemas.LONG,
    n_words=schemas.LONG, digest=schemas.STRING, marks=LONGS,
)
PLACE = schemas.struct(
    w1=schemas.LONG, w2=schemas.LONG, first=schemas.LONG, start=schemas.INT, h1=schemas.LONG,
    h2=schemas.LONG,
)

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, from exponent 0 to ``n`` at least."""
    known = _POWERS.get(base)
    if known is None or len(known[0]) <= n:
        size = max(2 * n, 1 << 12)
        known = tuple(
            np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]).cumprod(dtype=np.uint64)
            for b in (base, pow(base, -1, 1 << 64))
        )
        _POWERS[base] = known
    return known


def word_values(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolled(values: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """The hash of the ``width`` words from each start on; none for shorter texts."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    if lane:
        values = (values ^ (values >> np.uint64(29))) * _MIX
    power, inverse = _powers(_BASES[lane], len(values))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * inverse[: len(values)], dtype=np.uint64)])
    return (sums[width:] - sums[:-width]) * power[width - 1 : len(values)]


def window_marks(values: np.ndarray, window: int, mark: int) -> np.ndarray:
    """For each window the least hash of its grams, as signed longs."""
    grams, count = rolled(values, mark), len(values) - window + 1
    if count < 1:
        return np.empty(0, np.int64)
    least = grams[:count].copy()
    for at in range(1, window - mark + 1):
        np.minimum(least, grams[at : at + count], out=least)
    return least.view(np.int64)


def covered(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Which words the windows at ``starts`` cover."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def spans(mask: np.ndarray) -> list[dict[str, int]]:
    """Maximal intervals of covered words: first word and the word after the last."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _rows(fn: Callable[..., Iterator[tuple]], kind) -> Callable:
    """A mapInArrow function that calls ``fn`` with one row at a time and sends rows on in chunks."""
    fields = [(f.name, arrow_type(f.dataType)) for f in kind.fields]

    def mapped(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                made = [row for i in range(part.num_rows) for row in fn(*(c[i] for c in part.columns))]
                columns = zip(*made) if made else [[]] * len(fields)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, (_, t) in zip(columns, fields)],
                    names=[name for name, _ in fields],
                )

    return mapped


def _print(window: int, mark: int):
    def of(doc_id, k1, k2, text):
        words = (text.as_py() or "").encode().split()  # bytes split at \x20 and \x09-\x0D only
        whole = xxhash.xxh3_128_digest(b" ".join(words))
        w1, w2 = np.frombuffer(whole, np.int64)
        marks = np.unique(window_marks(word_values(words), window, mark))
        yield (
            doc_id.as_py(), k1.as_py(), k2.as_py(), int(w1), int(w2), len(words), _digest(words), marks,
        )

    return of


def _places(window: int, mark: int):
    """Rows of the hashed windows of each text whose mark is among ``shared``, in whole arrays."""
    names = PLACE.fieldNames()

    def mapped(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                w1, w2, first, shared, text = (c[i] for c in batch.columns)
                values = word_values(text.as_py().encode().split())
                known = np.sort(shared.values.to_numpy())
                marks = window_marks(values, window, mark)
                at = np.minimum(np.searchsorted(known, marks), len(known) - 1)
                starts = np.flatnonzero(known[at] == marks)
                h1, h2 = (rolled(values, window, lane)[starts].view(np.int64) for lane in (0, 1))
                same = [pa.repeat(pa.scalar(v.as_py(), pa.int64()), len(starts)) for v in (w1, w2, first)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(starts.astype(np.int32)), pa.array(h1), pa.array(h2)], names=names
                )

    return mapped


def _cut(window: int, with_text: bool, starts: Column, text: Column) -> Column:
    """n_removed, digest and text of the kept words, and the removed intervals."""
    kind = schemas.struct(
        n_removed=schemas.LONG, digest=schemas.STRING, kept=schemas.STRING, spans=SPANS
    )
    made = arrow_type(kind)

    def of(places, content):
        words = content.as_py().encode().split()
        gone = covered(places.values.to_numpy(), len(words), window)
        kept = [w for w, g in zip(words, gone.tolist()) if not g]
        text_of = b" ".join(kept).decode() if with_text else None
        return {"n_removed": int(gone.sum()), "digest": _digest(kept), "kept": text_of, "spans": spans(gone)}

    @F.arrow_udf(kind)
    def applied(places: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array((of(p, t) for p, t in zip(places, texts)), type=made)

    return applied.asNondeterministic()(starts, text)


def _shared_marks(prints: DataFrame, stage) -> DataFrame:
    """(w1, w2, shared): of each class the marks that another class has as well."""
    marks = prints.select("w1", "w2", F.explode("marks").alias("mark"))
    met = stage(
        marks.groupBy("mark").agg(F.min("w1").alias("low"), F.max("w1").alias("high"))
        .filter("low < high").select("mark"),
        "marks",
    )
    return marks.join(met, "mark").groupBy("w1", "w2").agg(F.collect_set("mark").alias("shared"))


def _removed(texts: DataFrame, prints: DataFrame, classes: DataFrame, window: int, mark: int, stage):
    """(w1, w2, starts): the first words of removed windows, for the first text of each class."""
    wanted = stage(classes.join(_shared_marks(prints, stage), ["w1", "w2"]), "wanted")
    found = texts.join(wanted, ["k1", "k2"]).select("w1", "w2", "first", "shared", "text")
    places = stage(found.mapInArrow(_places(window, mark), PLACE), "places")
    least = stage(
        places.groupBy("h1", "h2").agg(
            F.min("first").alias("least"), F.max("first").alias("most"),
            F.count_if(F.col("first").isNull()).alias("unnamed"),
        ).filter("least < most OR least IS NOT NULL AND unnamed > 0").select("h1", "h2", "least"),
        "least",
    )
    later = F.col("first").isNull() | (F.col("least") < F.col("first"))
    repeated = places.join(least, ["h1", "h2"]).filter(later)
    return repeated.groupBy("w1", "w2").agg(F.collect_list("start").alias("starts"))


def repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
    mark: int = MARK, with_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, digest, spans and kept of every document.

    ``digest`` is the SHA-256 of the kept words joined by one space, ``spans`` the removed intervals
    of words. ``kept`` is the text of the kept words, null where nothing is removed and the document's
    own text stands, and null throughout without ``with_text``.
    """
    keyed = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    k1, k2 = row_key(keyed)
    rows = keyed.select("doc_id", k1.alias("k1"), k2.alias("k2"), "text")
    texts = rows.select("k1", "k2", "text")
    with working(docs.sparkSession) as stage:
        prints = stage(rows.mapInArrow(_rows(_print(window, mark), PRINT), PRINT), "prints")
        # of each class the row with the least id, rows without one last
        best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2")).alias("b")
        classes = stage(
            prints.groupBy("w1", "w2").agg(best)
            .select("w1", "w2", F.col("b.doc_id").alias("first"), "b.k1", "b.k2"),
            "classes",
        )
        removed = stage(_removed(texts, prints, classes, window, mark, stage), "removed")
        lookup = classes.join(removed, ["w1", "w2"]).select("w1", "w2", "k1", "k2", "starts")
        made = _cut(window, with_text, F.col("starts"), F.col("text"))
        # equal rows hold equal texts; one is enough
        cut = stage(
            texts.join(lookup, ["k1", "k2"]).select("w1", "w2", made.alias("c"))
            .dropDuplicates(["w1", "w2"]),
            "cut",
        )
        firsts = classes.select("w1", "w2", "first").join(cut, ["w1", "w2"], "left")
        own = prints.select("doc_id", "w1", "w2", "n_words", "digest").join(firsts, ["w1", "w2"])
        copy = (
            (F.col("n_words") >= window) & F.col("first").isNotNull()
            & (F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id")))
        )
        n, whole = F.col("n_words"), F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))
        return settle(
            own.select(
                "doc_id", "n_words",
                F.when(copy, n).otherwise(F.coalesce("c.n_removed", F.lit(0).cast("long"))).alias("n_removed"),
                F.when(copy, _digest([])).otherwise(F.coalesce("c.digest", "digest")).alias("digest"),
                F.when(copy, F.array(whole)).otherwise(
                    F.coalesce("c.spans", F.array().cast(SPANS))
                ).alias("spans"),
                F.when(copy, "" if with_text else None).otherwise(F.col("c.kept")).alias("kept"),
            ),
            "repeats",
        )
