"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class k holds pieces longer than C/(k+1) and at most
C/k tokens, and a bin of class k takes exactly k of them, whichever they are. Workers therefore need
nothing but their pieces' rank in a class to fill bins on their own: ranks come from the counts per
(input partition, class), which are few. As documents may be cut, a piece of class k whose bin would
waste much is cut first: its head becomes exactly C // (k+1) tokens, which fills a bin of k+1 heads
to within k tokens, and the rest goes on; rests of class ``FINEST`` and above stay whole and waste
less than 1/(FINEST+1) of themselves. The last, incomplete bins of all classes are emptied and
their pieces packed together, longest first into the first sequence with room. Class k leaves fewer
than k pieces there, so their number has a bound that only the capacity sets.

Defined results: null and empty texts are one token, the end id. Repeated rows are documents of
their own; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import checkpoint, settle

CAPACITY = 2048
END_ID = 1
FINEST = 8

PIECES = schemas.struct(
    doc_id=schemas.LONG, start=schemas.LONG, length=schemas.LONG, ids_crc32=schemas.LONG,
    doc_tokens=schemas.LONG, part=schemas.INT, kind=schemas.INT, rank=schemas.LONG,
)


class Ids:
    """Token ids of texts, as little-endian unsigned 32-bit integers.

    ``tokenizer_file`` is a byte-level BPE of the ``tokenizers`` library. Its vocabulary and merge
    order are handed to ``tiktoken``, which gives the same ids at several times the speed; a
    tokenizer for which it would not (other steps, or other ids for probes) is used as it is. So
    are texts that hold an added token, such as an end mark, which the library makes one id.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        self.fast = _fast_encoding(tokenizer_file)
        probes = [t for t in _PROBES if not self._holds_added(t)]
        if self.fast and any(self._quick(t) != self._plain(t) for t in probes):
            self.fast = None

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _quick(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text)

    def _holds_added(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def of(self, text: str) -> bytes:
        # runs of this length without white space are beyond the quick path's pattern matching
        quick = self.fast and not self._holds_added(text) and (
            len(text) < LONG_RUN or not _RUN.search(text)
        )
        ids = self._quick(text) if quick else self._plain(text)
        return np.array(ids, "<u4").tobytes()


# Fixed value: how byte-level BPE splits text.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 10_000
_RUN = re.compile(rf"\S{{{LONG_RUN},}}|\s{{{LONG_RUN},}}")
_PROBES = (
    "", " ", "a  b", "don't  stop\n\n 12345 x!?", "<|endoftext|>", "Ünïcödé 漢字 𝒜", " \t\r\n a \u00a0b",
    "THE the tHe 's 'S", "\x00\x1c~", "e\u0301 ΑΒΓ привет",
)


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, others from 256 up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _fast_encoding(tokenizer_file: str):
    """The same vocabulary for the quick library; None for another kind of tokenizer."""
    import tiktoken

    with open(tokenizer_file, encoding="utf-8") as file:
        kind = json.load(file)
    splits = kind.get("pre_tokenizer") or {}
    special = {t["content"] for t in kind.get("added_tokens", [])}
    if kind["model"].get("type") != "BPE" or splits.get("type") != "ByteLevel":
        return None
    byte = _byte_of_char()
    ranks = {
        bytes(byte[c] for c in token): rank
        for token, rank in kind["model"]["vocab"].items()
        if token not in special and all(c in byte for c in token)
    }
    return tiktoken.Encoding("packing", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})


_IDS: dict[str, Ids] = {}


def _ids(tokenizer_file: str) -> Ids:
    if tokenizer_file not in _IDS:
        _IDS[tokenizer_file] = Ids(tokenizer_file)
    return _IDS[tokenizer_file]


def cuts(length: int, capacity: int = CAPACITY, finest: int = FINEST) -> list[int]:
    """Lengths of a document's pieces, in order."""
    found = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        kind = capacity // rest
        head = capacity // (kind + 1)
        if kind >= finest or capacity - kind * rest <= kind:
            found.append(rest)  # fills its bin well enough
            break
        found.append(head)
        rest -= head
    return found


def pieces(
    docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, finest: int = FINEST,
) -> DataFrame:
    """One row per piece; ``part``, ``kind`` and ``rank`` place it among its worker's pieces."""
    picked = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        part, ranks = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(texts), 256):  # bounded memory, whatever the batch
                rows = []
                for i in range(at, min(at + 256, len(texts))):
                    doc, text = ids[i].as_py(), texts[i].as_py()
                    data = (_ids(tokenizer_file).of(text) if text else b"") + end
                    total, start = len(data) // 4, 0
                    for length in cuts(total, capacity, finest):
                        kind = capacity // length
                        rank = ranks.get(kind, 0)
                        ranks[kind] = rank + 1
                        crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                        rows.append((doc, start, length, crc, total, part, kind, rank))
                        start += length
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if f.dataType == schemas.INT else pa.int64())
                     for c, f in zip(columns, PIECES.fields)],
                    names=PIECES.fieldNames(),
                )

    return picked.mapInArrow(cut, PIECES)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; sequence ids are gapless from 0.

    ``cut`` must be stored: ranks count its rows as written.
    """
    counts = cut.groupBy("kind", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = checkpoint(counts)  # one row per input partition and class
    before = F.sum("n").over(
        Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("kind", "part", F.coalesce(before, F.lit(0)).alias("before"))
    classes = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    # at most 2 * sqrt(capacity) classes: the rows of this window are few by construction
    full = classes.withColumn("bins", F.floor(F.col("total") / F.col("kind")))
    by_class = Window.orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("base", F.coalesce(F.sum("bins").over(by_class), F.lit(0)))
    full = settle(full, "classes")
    filled = int(full.agg(F.coalesce(F.sum("bins"), F.lit(0))).first()[0])

    ranked = (
        cut.join(settle(starts, "starts"), ["kind", "part"])
        .join(F.broadcast(full), "kind")  # bounded as above
        .withColumn("place", F.col("before") + F.col("rank"))
    )
    whole = ranked.filter(F.col("place") < F.col("bins") * F.col("kind"))
    left = ranked.filter(F.col("place") >= F.col("bins") * F.col("kind"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    bin_order = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    binned = whole.withColumn(
        "sequence_id", (F.col("base") + F.floor(F.col("place") / F.col("kind"))).cast("long")
    )
    single = binned.filter("kind = 1").withColumn("offset", F.lit(0).cast("long"))
    shared = binned.filter("kind > 1").withColumn(
        "offset", F.coalesce(F.sum("length").over(bin_order), F.lit(0))
    )

    def first_fit(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "kind", "place"], ascending=[False, True, True])
        room: list[int] = []
        spots = []
        for length in rest["length"]:
            at = next((i for i, free in enumerate(room) if free >= length), len(room))
            if at == len(room):
                room.append(capacity)
            spots.append((filled + at, capacity - room[at]))
            room[at] -= length
        rest["sequence_id"], rest["offset"] = zip(*spots)
        return rest[columns]

    # one group, whose size the number of classes bounds
    loose = left.groupBy().applyInPandas(
        first_fit, schemas.struct(**dict.fromkeys(columns, schemas.LONG))
    )
    return single.select(columns).unionByName(shared.select(columns)).unionByName(loose)


def packed(
    docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, finest: int = FINEST,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    cut = settle(pieces(docs, tokenizer_file, key, text, capacity, finest), "pieces")
    return place(cut, capacity)
