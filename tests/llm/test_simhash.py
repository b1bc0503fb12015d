"""SimHash near-duplicates against a direct computation."""

import random
import time

import numpy as np
import pytest
import xxhash

from rankstream.llm import common, decontaminate, similar, simhash
from rankstream.llm.common import settle
from rankstream.llm.components import connected_components
from rankstream.session import shared_folder
from rankstream.sinks import folders

DOCS = "doc_id long, text string"


def direct_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def direct_components(prints):
    """Component ids of (doc_id, fingerprint) rows by comparing all pairs."""
    parent = {f: f for _, f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(b)] = root(a)
    least = {}
    for doc, f in prints:
        if doc is not None:
            least[root(f)] = min(doc, least.get(root(f), doc))
    return sorted(((d, f, least.get(root(f))) for d, f in prints), key=repr)


TEXTS = [
    None, "", " \n", "one", "One", "two words", "a b c d e", "A B\tC\nD e", "x " * 200_000,
    "İstanbul ẞ é É one two three four five", "  no break \u0085 space",
    "one two three four", "one two three four", "word\x1cword other words here now",
]


def test_fingerprints(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), DOCS)
    found = df.select("doc_id", simhash.fingerprint(df.text).alias("f")).collect()
    assert [r.f % 2**64 for r in found] == [direct_fingerprint(t) for t in TEXTS]


@pytest.mark.parametrize("hot", [0, 3, 64])
def test_components_lose_no_link(spark, hot):
    """Chains, clusters and strangers, with every segment value cold, mixed or hot."""
    rng = random.Random(hot)
    prints, number = [], 0
    for cluster in range(12):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12])):
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << bit
            for _ in range(rng.choice([1, 1, 3])):
                prints.append((rng.choice([None, number, number, number]), f))
                number += 1
    rng.shuffle(prints)
    signed = [(d, f - 2**64 if f >> 63 else f) for d, f in prints]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    found = simhash.components(df, hot).collect()
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=repr)
    assert got == direct_components(prints)


def test_dense_cluster(spark):
    """Many fingerprints within a few bits of each other, all in hot values."""
    rng = random.Random(5)
    base = rng.getrandbits(63)
    prints = [(i, base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63))) for i in range(120)]
    df = spark.createDataFrame(prints, "doc_id long, fp long")
    got = sorted((r.doc_id, r.fp, r.component_id) for r in simhash.components(df, 8).collect())
    assert got == sorted(direct_components(prints))


def meet(a, b):
    """Whether the pipeline's search brings two fingerprints together, with all values cold."""
    parts = [((a ^ b) >> low & (1 << bits) - 1).bit_count() for low, bits in ((0, 21), (21, 21), (42, 22))]
    return a != b and min(parts) <= 1 and (a ^ b).bit_count() <= 12


def proposals(spark, fps, hot):
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    return [(r.a, r.b) for r in simhash.proposed(df, settle, hot).collect()]


def test_search_proposes_the_nearest_and_the_least(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(63) for _ in range(40)}
    for f in list(fps):
        for _ in range(rng.choice([0, 1, 3, 9])):
            for bit in rng.sample(range(63), rng.randint(1, 9)):
                f ^= 1 << bit
            fps.add(f)
    want = set()
    for f in fps:
        met = [o for o in fps if meet(f, o)]
        for other in [min(met, key=lambda o: ((f ^ o).bit_count(), o)), min(met)] if met else []:
            want.add((min(f, other), max(f, other)))
    got = proposals(spark, fps, 1000)
    assert len(want) > 60 and sorted(got) == sorted(want)


def test_members_of_hot_values_meet_through_hubs(spark):
    """300 fingerprints that share two segments: a few pairs a member connect them all."""
    rng = random.Random(4)
    base = rng.getrandbits(63)
    fps = {base ^ sum(1 << b for b in rng.sample(range(42, 63), 4)) for _ in range(300)}
    pairs = proposals(spark, fps, 16)
    assert len(pairs) <= 2 * len(fps) and all(meet(a, b) for a, b in pairs)
    linked = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert sorted(map(tuple, linked.collect())) == sorted((f, min(fps)) for f in fps)


@pytest.mark.parametrize("size", [30, 60])
def test_meetings_grow_with_the_fingerprints(spark, size):
    """A group whose segment values are all cold: a row for each value asked for, none for each pair."""
    rng = random.Random(size)
    base = rng.getrandbits(63)
    fps = set()
    while len(fps) < size:
        fps.add(base ^ sum(1 << b for b in rng.sample(range(42, 63), 4)))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    rows = simhash._meetings(df, settle, 64).collect()
    # two segments are equal; of the third, one value of its own and those of one bit's difference
    assert 2 * size <= len(rows) <= (2 + 1 + 22) * size
    pairs = sum(meet(a, b) for a in fps for b in fps)
    assert pairs == size * (size - 1) and len({r.x for r in rows}) == size
    if size == 60:
        assert len(rows) < pairs  # the pairs of two values had been 4 * pairs rows


def test_components_leave_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in blocks.getAllFiles().mkString(",").split(",") if "/shuffle_" in f}

    before = files()
    edges = spark.range(300).selectExpr("id a", "id + 1 b").repartition(4)
    found = connected_components(edges)
    for _ in range(40):  # files go soon after the query
        left = files() - before
        if not left:
            break
        time.sleep(0.25)
    assert not left
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(301)]


def test_links_join_known_components(spark):
    """Later links are searched between roots only and give the components of all links."""
    rng = random.Random(9)
    for first, later in [(30, 25), (0, 10), (25, 0)]:
        links = [(rng.randrange(80), rng.randrange(80)) for _ in range(first + later)]
        a, b = (spark.createDataFrame(x, "a long, b long") for x in (links[:first], links[first:]))
        known = connected_components(a).toDF("cls", "root")
        searched = []

        def stage(df, label):
            made = settle(df, label)
            if label == "edges" and not searched:
                searched.append({n for r in made.collect() for n in r})
            return made

        got = {tuple(r) for r in similar._joined(known, b, stage).collect()}
        assert got == {tuple(r) for r in connected_components(a.unionByName(b)).collect()}
        inner = {r.cls for r in known.collect() if r.cls != r.root}
        assert not searched[0] & inner


def test_near_copies_are_linked_by_the_search(spark, monkeypatch):
    """Without the prefix search, the copies whose fingerprints meet are still dropped."""
    exact = similar.roots
    monkeypatch.setattr(
        similar, "roots", lambda tokens, *others: exact(tokens.limit(0), *others)
    )
    rng = random.Random(7)

    def direct(text):
        hashes = [xxhash.xxh64_intdigest(" ".join(s), 42) for s in word_set(text)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows, want = [], []
    for number in range(0, 80, 2):
        words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
        copy = list(words)
        for at in rng.sample(range(200), 1 + number % 3):
            copy[at] = "other"
        pair = [" ".join(words), " ".join(copy)]
        prints = [direct(t) for t in pair]
        rows += zip((number, number + 1), pair)
        want += [number] if prints[0] == prints[1] or meet(*prints) else [number, number + 1]
    got = simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id for r in got) == want
    assert 40 < len(want) < 60  # most of the 40 copies, not all


def test_query_columns_and_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    clash = spark.createDataFrame([(1, "a b", 5, 6)], DOCS + ", fp long, component_id long")
    row = simhash.near_duplicates(clash).first()
    assert (row.doc_id, row.component_id) == (1, 1)
    assert row.fingerprint == f"{direct_fingerprint('a b'):016x}"


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "a b c d e f", "y"),
            (None, "a b c d e f", "z"), (None, "other words", "p"), (7, None, "n"), (8, "", "n")]
    df = spark.createDataFrame(rows, DOCS + ", fp string")
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, "a b c d e f", "y"), (None, "other words", "p"), (7, None, "n")], key=repr
    )


def test_components_of_graphs(spark):
    def of(edges, kind="long"):
        df = spark.createDataFrame(edges, f"a {kind}, b {kind}")
        return sorted(map(tuple, connected_components(df).collect()))

    chain = [(i, i + 1) for i in range(40)]
    assert of(chain) == [(i, 0) for i in range(41)]
    assert of([]) == []
    assert of([(5, 5), (None, 3), (2, 1), (1, 2), (1, 2)]) == [(1, 1), (2, 1)]
    star = [(0, i) for i in range(1, 300)] + [(1000, 1001)]
    assert of(star) == [(i, 0) for i in range(300)] + [(1000, 1000), (1001, 1000)]
    assert of([("b", "a"), ("c", "b")], "string") == [("a", "a"), ("b", "a"), ("c", "a")]


def word_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_all_pairs(rows):
    """Ids that stay, from the exact similarity of every pair."""
    sets, parent = [word_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(least.values())


@pytest.mark.parametrize("sample", [20_000, 10])
def test_all_texts_of_similarity_four_fifths_are_linked(spark, monkeypatch, sample):
    """Edited copies around 0.8, chains of them, a large group and a shared passage."""
    monkeypatch.setattr(similar, "SAMPLE", sample)
    rng = random.Random(11)
    def word():
        return "".join(rng.choices("abcdefgh", k=4))

    shared = [word() for _ in range(60)]
    texts = [None, "", "one two", "One  two", "one two three"]
    for size in [8, 30, 60, 100, 100, 100, 200, 200, 400]:
        words = [word() for _ in range(size)]
        for _ in range(8):
            if rng.random() < 0.5:
                words = list(words)
            copy = words if rng.random() < 0.3 else list(words)
            for at in rng.sample(range(size), rng.randint(0, max(1, size // 35))):
                copy[at] = word()
            texts.append(" ".join(copy))
    texts += [" ".join([*shared, *[word() for _ in range(rng.randint(5, 60))]]) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()
    want = kept_by_all_pairs(rows)
    assert sorted(r.doc_id for r in got) == want
    assert len(want) < len(rows) - 20


def stored_steps(monkeypatch):
    """Label and number of rows of each step that is stored from now on."""
    found, stored = [], common._stored

    def noted(df, path):
        made = stored(df, path)
        found.append((path.rsplit("/llm-", 1)[-1].rsplit("-", 1)[0], made.count()))
        return made

    monkeypatch.setattr(common, "_stored", noted)
    return found


def words_of(rng, size):
    return ["".join(rng.choices("abcdefgh", k=5)) for _ in range(size)]


def test_texts_with_elements_of_their_own_make_no_candidates(spark, monkeypatch):
    """A passage that the sample misses is in all texts; none is compared but the two that are similar."""
    monkeypatch.setattr(similar, "COMMON", 1000)
    rng = random.Random(13)
    passage = words_of(rng, 20)
    texts = [[*words_of(rng, 120), *passage] for _ in range(60)]
    texts.append([*texts[0][:50], "other", *texts[0][51:]])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = stored_steps(monkeypatch)
    kept = simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(60))
    tried = [n for label, n in found if label in ("proposed", "tried0", "tried1", "rest")]
    assert len(tried) == 4 and sum(tried) <= 2


def test_only_close_pairs_are_compared_by_whole_sets(spark, monkeypatch):
    """Texts whose similarity is about 0.7 by a passage: their whole sets are not read, the others' are."""
    monkeypatch.setattr(similar, "COMMON", 1000)
    rng = random.Random(17)
    passage = words_of(rng, 200)
    texts = [[*words_of(rng, 35), *passage] for _ in range(30)]
    texts.append([*texts[3][:100], "other", *texts[3][101:]])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = stored_steps(monkeypatch)
    kept = simhash.deduplicated(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(30))
    sets = [n for label, n in found if label.endswith("-sets")]
    assert len(sets) == 4 and 2 <= sum(sets) <= 8


def test_parities_lose_no_similar_pair(spark):
    rng = random.Random(19)
    sketches, pairs, want = [], [], set()
    for number in range(0, 160, 2):
        size = rng.choice([1, 6, 9, 60, 700, 3000])
        first = [rng.getrandbits(63) for _ in range(size)]
        second = list(first)
        for at in rng.sample(range(size), min(size, rng.choice([0, 1, size // 9, size // 2]))):
            second[at] = rng.getrandbits(63)
        second += [rng.getrandbits(63) for _ in range(rng.choice([0, 0, size // 8]))]
        for cls, own in ((number, first), (number + 1, second)):
            sketches.append((cls, len(set(own)), similar._odd(np.array(sorted(set(own)), np.int64))))
        pairs.append((number, number + 1))
        a, b = set(first), set(second)
        if 10 * len(a & b) >= 8 * len(a | b):
            want.add(pairs[-1])
    sketches = spark.createDataFrame(sketches, "cls long, n long, odd array<long>")
    got = {tuple(r) for r in similar._close(spark.createDataFrame(pairs, "a long, b long"), sketches).collect()}
    assert want <= got and len(want) > 30 and len(got) < 70


def test_whole_sets_go_when_they_are_compared(spark, monkeypatch):
    left = []
    joined = similar._joined

    def seen(known, links, stage):
        folder = f"{shared_folder(spark)}/rankstream"
        left.extend(n for n in folders.children(spark, folder) if "-sets-" in n or "llm-signed-" in n)
        return joined(known, links, stage)

    monkeypatch.setattr(similar, "_joined", seen)
    rng = random.Random(23)
    texts = [" ".join(words_of(rng, 80)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate([*texts, texts[0] + " more"])]
    before = set(left)
    assert simhash.deduplicated(spark.createDataFrame(rows, DOCS)).count() == 6
    assert not before and not left


def children(node):
    return [node.children().apply(i) for i in range(node.children().size())]


def explodes(node):
    """Whether the node's size is guessed from an explode; a join's guess is a product, never too low."""
    if "Join" in node.nodeName():
        return False
    return "Generate" in node.nodeName() or any(map(explodes, children(node)))


def exploded_broadcasts(df):
    """Broadcast sides of joins, as first planned, that hold an explode."""
    found, nodes = [], [df._jdf.queryExecution().sparkPlan()]
    while nodes:
        node = nodes.pop()
        nodes += children(node)
        if node.nodeName().startswith("BroadcastHashJoin"):
            side = node.left() if node.buildSide().toString() == "BuildLeft" else node.right()
            if explodes(side):
                found.append(side.toString())
    return found


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    """The planner sizes an explode as its input, which stored tables show compressed besides."""
    wrong, stored = {}, common._stored

    def planned(df, path):
        label = path.rsplit("/llm-", 1)[-1].rsplit("-", 1)[0]
        if found := exploded_broadcasts(df):
            wrong[label] = found
        return stored(df, path)

    monkeypatch.setattr(common, "_stored", planned)
    rng = random.Random(29)
    texts = [" ".join(words_of(rng, 80)) for _ in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0] + " more"])], DOCS)
    assert simhash.deduplicated(docs).count() == 6
    items = spark.createDataFrame([(1, texts[1][:200])], "item_id long, text string")
    assert decontaminate.clean(docs, items).count() == 6
    wrong.pop("dirty", None)  # there the explode makes the numbers of a block's portions, a few rows
    assert not wrong
