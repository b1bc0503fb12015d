"""Repeated windows against a table of every window as words."""

import hashlib
import random

import numpy as np
import pytest

from rankstream.llm import repeats

DOCS = "doc_id long, text string"


def direct(rows, window=13):
    """(doc_id, n_words, n_removed, digest, spans) by comparing windows as tuples of words."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, words in split:
        if i is not None:
            for at in range(len(words) - window + 1):
                key = tuple(words[at : at + window])
                first[key] = min(i, first.get(key, i))
    found = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            least = first.get(tuple(words[at : at + window]))
            if least is not None and (i is None or least < i):
                gone.update(range(at, at + window))
        kept = [w for at, w in enumerate(words) if at not in gone]
        starts = [at for at in sorted(gone) if at - 1 not in gone]
        ends = [at + 1 for at in sorted(gone) if at + 1 not in gone]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        found.append((i, len(words), len(gone), digest, list(zip(starts, ends))))
    return sorted(found, key=repr)


def run(df, **options):
    rows = repeats.repeats(df, **options).collect()
    for r in rows:
        if r.kept is not None:
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.digest
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.digest,
                    [(s.start, s.end) for s in r.spans]) for r in rows), key=repr)


def corpus(rng):
    words = [f"w{i}" for i in range(400)]

    def fresh(n):
        return rng.choices(words, k=n)

    passages = [fresh(n) for n in (13, 14, 20, 60)]
    rows = []
    for i in range(60):
        text = fresh(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(passages)[: rng.choice([12, 13, 60])] + fresh(rng.randint(0, 5))
        rows.append((i, rng.choice([" ", "\n", " \t x "]).join(text)))
    near = fresh(200)
    for i in range(60, 90):
        edited = list(near)
        edited[rng.randrange(200)] = "edit"
        rows.append((i, " ".join(edited if i % 3 else near)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_windows(spark, seed):
    rows = corpus(random.Random(seed))
    assert run(spark.createDataFrame(rows, DOCS)) == direct(rows)


def test_odd_rows(spark):
    """Nulls, blanks, repeated ids and rows, texts without an id, a very long text, other columns."""
    long = " ".join(f"v{i % 9973}" for i in range(200_000))
    line = " ".join("abcdefghijklmnop")
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, line), (4, line), (4, line + " more"), (4, "x " + line),
        (5, line + " " + line), (None, line), (None, "z " + line), (None, "own words " * 20),
        (None, "own words " * 20), (6, "a a " * 40), (7, "a a " * 8), (8, long), (9, long),
        (10, "one two"), (11, "A " + line), (12, "no\x1cbreak " + line.upper()), (13, line.upper()),
        (-5, "İ é " + line.upper()),
    ]
    df = spark.createDataFrame([(*r, 1, "m", 2) for r in rows], DOCS + ", first int, marks string, k1 int")
    assert run(df) == direct(rows)
    assert run(df, with_text=False) == direct(rows)


def test_other_widths(spark):
    rows = corpus(random.Random(5))
    df = spark.createDataFrame(rows, DOCS)
    assert run(df, window=4, mark=2) == direct(rows, 4)
    assert run(df, window=3, mark=3) == direct(rows, 3)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], DOCS)) == []


def test_rolling_hash():
    """The same words have the same hash at every place, in texts of every length."""
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    for lane, base in enumerate(repeats._BASES):
        got = repeats.rolled(values, 5, lane)
        digits = [int(v) for v in values[777:782]]
        if lane:
            digits = [((v ^ (v >> 29)) * int(repeats._MIX)) % 2**64 for v in digits]
        assert int(got[777]) == sum(v * pow(base, 4 - i, 2**64) for i, v in enumerate(digits)) % 2**64
        assert (repeats.rolled(values[777:800], 5, lane) == got[777:796]).all()
    assert repeats.rolled(values[:4], 5).size == 0
