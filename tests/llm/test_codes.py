"""Vector codes against a comparison of every part with every entry, in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from rankstream.llm import codes

ROWS = "vec_id long, embedding array<double>, label int"


def direct(rows):
    """The contract's rows from (vec_id, vector, label), all distances taken."""
    kept = [(i, [math.floor(4096 * c) for c in v], lab) for i, v, lab in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    width = len(kept[0][1]) // 8 if kept else 0
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    part = lambda x, p: x[p * width : (p + 1) * width]
    books = [[part(x, p) for _, x, _ in first] for p in range(8)]

    def near(y, p):
        return min((sum((a - b) ** 2 for a, b in zip(y, e)), i) for i, e in enumerate(books[p]))

    for _ in range(6):
        chosen = [[near(part(x, p), p)[1] for _, x, _ in kept] for p in range(8)]
        new = []
        for p in range(8):
            entries = []
            for i, old in enumerate(books[p]):
                own = [part(x, p) for (_, x, _), c in zip(kept, chosen[p]) if c == i]
                entries.append([sum(col) // len(own) for col in zip(*own)] if own else old)
            new.append(entries)
        books = new
    found = [[near(part(x, p), p) for p in range(8)] for _, x, _ in kept]
    digest = hashlib.sha256(
        ",".join(str(c) for p in books for e in p for c in e).encode()
    ).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), err, by_label[lab])
         for (i, _, lab), f, err in zip(kept, found, errors)), key=repr
    ), digest


def run(df):
    coded, books = codes.compressed(df)
    picked = codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error")
    return sorted(map(tuple, picked.collect()), key=repr), books and books.digest()


def vectors(rng, n, width=16, wide=1.0):
    return [[rng.gauss(0, wide) for _ in range(width)] for _ in range(n)]


@pytest.mark.parametrize("wide", [1.0, 1e-3, 3e4])
def test_codes(spark, wide):
    """Gaussian vectors; tiny ones, whose integers tie; and ones beyond the quick integers."""
    rng = random.Random(3)
    rows = [(i, v, rng.choice([None, 1, 2])) for i, v in enumerate(vectors(rng, 150, 16, wide))]
    rng.shuffle(rows)
    assert run(spark.createDataFrame(rows, ROWS)) == direct(rows)


def test_odd_rows(spark):
    """Rows without a usable vector, repeated rows and ids, a null id; clashing column names."""
    rng = random.Random(4)
    good = vectors(rng, 12, 8)
    rows = [(i, v, None) for i, v in enumerate(good)]
    rows += [(3, good[3], None), (3, good[5], 7), (None, good[1], 7)]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [1.0] * 7 + [None], 1), (-4, [math.nan] * 8, 1),
           (-5, [math.inf] * 8, 1), (90, [1.0] * 16, 1)]
    df = spark.createDataFrame(
        [(*r, "x", 1, [0]) for r in rows + bad], ROWS + ", code string, error int, near array<int>"
    )
    assert run(df) == direct(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert run(empty) == ([], None)
    assert run(spark.createDataFrame([(1, [1.0] * 9, 2), (2, None, 2)], ROWS)) == ([], None)


def test_bounds_prune_and_keep_ties():
    rng = np.random.default_rng(1)
    entries = rng.integers(-2000, 2000, (16, 8))
    entries[9] = entries[4]
    parts = np.concatenate([entries[rng.integers(0, 16, 2000)] + rng.integers(-90, 90, (2000, 8)), entries])
    pivots = codes.choose_pivots(entries)
    which, best, taken = codes.nearest(parts, codes.to_pivots(parts, pivots), entries, pivots)
    squares = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (which == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
    assert taken < 0.4 * squares.size
