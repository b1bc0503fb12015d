"""Packing: an exact round trip through the tokenizer's own ids."""

import random
import struct
import zlib

import pytest
from tokenizers import Tokenizer

from rankstream.llm import catalog, packing

DOCS = "doc_id long, text string"
SPACES = [" ", "  ", "\n", " \n", "\t ", " ", "  ", "\x1c ", "\r\n "]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(catalog.tokenizer_file())


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(2)
    pieces = ["the", "don't", "Ünï", "漢字", "12345", "!!", "'s", "<|endoftext|>", "é", "𝒜", "a"] + SPACES
    texts = ["", " ", "  ", " a", "a ", "a  b", "'s 's", "a" * 50_000, " " * 50_000 + "x", "!" * 30_000]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(2000)]
    texts += ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "x" * 20_000 + "<|endoftext|>"]
    ids = packing.Ids(catalog.tokenizer_file())
    assert ids.fast
    assert list(struct.unpack("<4I", ids.of("x <|endoftext|> y"))) == [87, 220, 50256, 331]
    for text in texts:
        data = ids.of(text)
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(data) // 4}I", data)) == want, text[:50]


def test_cuts_cover_and_waste_little():
    for length in range(1, 5000):
        parts = packing.cuts(length)
        assert sum(parts) == length and all(0 < p <= packing.CAPACITY for p in parts)
        for part in parts:
            kind = packing.CAPACITY // part
            assert kind >= packing.FINEST or packing.CAPACITY - kind * part <= kind


def check(rows, docs, tokenizer, capacity=packing.CAPACITY):
    """Every id once, gapless sequences within the capacity, right digests."""
    ids = {}
    for doc, text in docs:
        ids.setdefault(doc, []).append(
            [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        )
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for doc, pieces in by_doc.items():
        whole = ids[doc][0]
        assert all(w == whole for w in ids[doc])
        copies = len(ids[doc])
        assert sum(p.length for p in pieces) == copies * len(whole)
        for p in pieces:
            part = whole[p.start : p.start + p.length]
            assert p.doc_tokens == len(whole) and len(part) == p.length
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        places = sorted(p.start for p in pieces)
        assert all(places.count(x) == copies for x in places)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for spots in by_sequence.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity


def test_round_trip(spark, tokenizer):
    rng = random.Random(4)
    texts = [None, "", "a", "word " * 3000]
    texts += [" ".join(rng.choice(["alpha", "beta", "γ", "12"]) for _ in range(rng.randint(1, 1500)))
              for _ in range(60)]
    docs = list(enumerate(texts)) + [(7, texts[7])]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], DOCS + ", length long, kind int")
    check(packing.packed(df.repartition(5), catalog.tokenizer_file()).collect(), docs, tokenizer)


def test_empty_table(spark):
    assert packing.packed(spark.createDataFrame([], DOCS), catalog.tokenizer_file()).collect() == []


def test_query_packs_everything_with_little_padding(spark, sf_dir, tokenizer):
    rows = catalog.QUERIES["op5_harmonic_packing"](spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, docs, tokenizer)
    sequences = 1 + max(r.sequence_id for r in rows)
    assert sum(r.length for r in rows) > 0.97 * sequences * packing.CAPACITY
