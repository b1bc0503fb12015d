"""Decontamination against direct edit distances."""

import random

import numpy as np

from rankstream.llm import decontaminate as d

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(rng.choice(WORDS), k=rng.randint(2, 6))) for _ in range(n))


def least_edits(window, region):
    """Least edits of the window against any part of the region, by the full table."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(window, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        rng.choice([lambda: chars.insert(at, "#"), lambda: chars.pop(at),
                    lambda: chars.__setitem__(at, "#")])()
    return "".join(chars)


def test_align_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(300):
        window = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        region = "".join(rng.choice("ab") for _ in range(rng.randint(0, 15)))
        want = least_edits(window, region)
        for budget in (0, 1, 3):
            edits, start, end = d.align(d.fold(window), d.fold(region), budget)
            assert min(edits, budget + 1) == min(want, budget + 1)
            if edits <= budget:
                assert least_edits(window, region[start:end]) == edits


def cut(text):
    if len(text) <= d.WINDOW:
        return [text]
    starts = {*range(0, len(text) - d.WINDOW + 1, d.STRIDE), len(text) - d.WINDOW}
    return [text[s : s + d.WINDOW] for s in sorted(starts)]


def direct_pairs(docs, items):
    found = set()
    for doc, text in docs:
        for item, passage in items:
            for window in cut(passage or "") if passage and len(passage) >= d.Q else ():
                if least_edits(window.lower(), " ".join((text or "").lower().split("\n"))) <= len(window) // d.PER_EDIT:
                    found.add((doc, item))
    return found


def test_search_finds_exactly_what_the_full_table_finds(spark):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.choice([3, 8, 15, 30]))) for i in range(8)]
    items += [(90, items[0][1]), (91, None), (92, ""), (93, "short"), (94, items[3][1][:20])]
    docs = [(0, None), (1, ""), (2, prose(rng, 60))]
    for number in range(3, 30):
        item, passage = rng.choice(items[:8])
        piece = edited(rng, passage, rng.choice([0, 1, 3, 6, 12]))
        if rng.random() < 0.3:
            piece = piece.upper().replace(" ", "\n")
        docs.append((number, f"{prose(rng, 10)} {piece} {prose(rng, 10)}"))
    docs.append((3, docs[3][1]))
    documents = spark.createDataFrame(
        [(*row, 1, "h", 2) for row in docs], "doc_id long, text string, k1 int, hashes string, start int"
    )
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.regions(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == direct_pairs(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    clean = d.clean(documents, benchmark)
    dirty = {r.doc_id for r in got}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if i not in dirty)


def test_blocks_find_the_same(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, prose(rng, 30)) for i in range(12)]
    docs = [(i, prose(rng, 20) + items[i][1] + prose(rng, 5)) for i in range(12)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, d.regions(documents, benchmark).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 1500)
    monkeypatch.setattr(d, "PORTION", 2)
    assert d._blocks(benchmark).select("block").distinct().count() > 3
    assert sorted(map(tuple, d.regions(documents, benchmark).collect())) == whole
    assert d.clean(documents, benchmark).count() == 0
    monkeypatch.setattr(d, "MOST_BITS", 18)
    monkeypatch.setattr(d, "_BATCH_CHARS", 100)
    assert sorted(map(tuple, d.regions(documents, benchmark).collect())) == whole


def searched(index, texts, any_window=False):
    return d._search_passages(index, [(0, t or "") for t in texts], any_window)


def test_short_items_with_every_edit(spark):
    """Items of 12 to 30 characters, whole and with each single edit, in the middle of a text."""
    rng = random.Random(12)
    items = [(n, "".join(rng.choices("abcdefghij klmnop", k=n))) for n in range(12, 31)]
    docs = []
    for item, text in items:
        made = {text}
        for at in range(item):
            made |= {text[:at] + text[at + 1 :], text[:at] + "#" + text[at:], text[:at] + "#" + text[at + 1 :]}
        docs += [(len(docs) + i, f"%%%% {t} %%%%") for i, t in enumerate(sorted(made))]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.regions(documents, benchmark).collect()}
    assert got == direct_pairs(docs, items)
    assert {i for _, i in got if i >= 20} == set(range(20, 31))
    kept = {r.doc_id for r in d.clean(documents, benchmark).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    no_items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "text " * 50)], "doc_id long, text string")
    assert d.regions(none, no_items).collect() == []
    assert d.regions(some, no_items).collect() == []
    assert d.clean(some, no_items).count() == 1


def test_long_texts_and_wide_characters():
    passage = "𝒜bc déf " * 12
    index = d.Index([(1, w) for w in cut(passage)])
    long = "filler words " * 100_000 + passage.upper() + " tail"
    hits = searched(index, ["x", long, None, passage])
    assert {h[0] for h in hits} == {1, 3}
    assert min(h[4] for h in hits if h[0] == 1) == min(h[4] for h in hits if h[0] == 3) == 0
    assert np.array_equal(d.fold("A\tİ"), d.fold("a İ"))


def test_quoted_passages_are_found_from_every_start():
    """Verbatim passages of 13 words and of 80 characters, slid over all starts of the items."""
    rng = random.Random(21)
    items = [(i, prose(rng, n)) for i, n in enumerate([14, 40])]
    index = d.Index(items)
    for item, text in items:
        words = text.split(" ")
        passages = [" ".join(words[i : i + 13]) for i in range(len(words) - 12)]
        passages += [text[i : i + 80] for i in range(len(text) - 79)]
        docs = [f"{prose(rng, 9)} {p} {prose(rng, 9)}" for p in passages]
        found = searched(index, docs)
        assert {h[0] for h in found if h[1] == item} == set(range(len(docs)))
        assert {h[0] for h in searched(index, docs, any_window=True)} == set(range(len(docs)))


def test_items_in_pieces_find_the_same(spark, monkeypatch):
    rng = random.Random(22)
    item = prose(rng, 300)
    words = item.split(" ")
    docs = [(i, f"x {' '.join(words[i : i + 13])} y") for i in range(0, 288, 3)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    whole = sorted(map(tuple, d.regions(documents, benchmark).collect()))
    assert len(whole) == len(docs)
    monkeypatch.setattr(d, "PIECE", 300)
    assert d.pieces(benchmark).count() > 5
    assert sorted(map(tuple, d.regions(documents, benchmark).collect())) == whole
