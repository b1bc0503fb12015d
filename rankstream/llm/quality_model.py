"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts (lengths, character classes, repetition, variety) are binned at quantiles;
trees grow level by level on gradient histograms of the logistic loss, and come out flattened into
arrays (feature, threshold, children, value), which numpy traverses for all rows of a batch at once.

Fitting uses at most ``MAX_ROWS`` labelled rows, those with the smallest hash of their id, so the
driver holds a bounded matrix; scoring is a map over all documents with the trees in the closure.

Defined results: null and empty texts have statistics of zero and a score like any other; documents
labelled more than once count once, with the label they have most (ties: the higher); null labels and
ids teach nothing; without usable labels every score is 0.5; repeated rows get a row each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas

MAX_ROWS = 20_000
TREES, DEPTH, BINS, RATE, SHRINK, LEAST = 60, 4, 64, 0.2, 1.0, 10
FEATURES = (
    "log_words", "word_length", "log_lines", "words_per_line", "upper", "digits", "punctuation",
    "symbols", "exclamations", "bars", "other", "distinct_words", "repeated_windows",
    "repeated_lines", "longest_word", "top_word", "sentences", "capital_words",
)
_PUNCTUATION, _SYMBOLS = b".,;:?'\"()-", b"#*$%&<>{}[]\\^~=+_/@`"
_CLASS = np.zeros(256, np.int64)
for _code in range(256):
    _byte = bytes([_code])
    _CLASS[_code] = (
        1 if _byte.isupper() else 2 if _byte.isdigit() else 3 if _byte in _PUNCTUATION
        else 4 if _byte in _SYMBOLS else 5 if _byte == b"!" else 6 if _byte == b"|"
        else 7 if _code < 32 and not _byte.isspace() else 0
    )
_CAPITAL = re.compile(rb"\b[A-Z][A-Z]+\b")


def statistics(text: str | None) -> list[float]:
    """The features of one whole text."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digit, punctuation, symbol, shout, bar, other = np.bincount(
        _CLASS, weights=counts, minlength=8
    )[1:8]
    visible = sum(map(len, words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    bag: dict[bytes, int] = {}
    for word in words:
        bag[word] = bag.get(word, 0) + 1
    return [
        float(np.log1p(n)), visible / n, float(np.log1p(len(lines))), n / len(lines), upper / visible,
        digit / visible, punctuation / visible, symbol / visible, shout / n, bar / n, other / visible,
        len(bag) / n, 1 - len(set(windows)) / len(windows) if windows else 0.0,
        1 - len(set(lines)) / len(lines), float(max(map(len, words))), max(bag.values()) / n,
        (data.count(b".") + data.count(b"?")) / n, len(_CAPITAL.findall(data)) / n,
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """All trees' nodes in flat arrays; a leaf is its own child, so depth steps reach every leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, all rows and trees a level at a time."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
    rate: float = RATE,
) -> Trees:
    """Boosted trees on the logistic loss; splits come from histograms of gradients."""
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    n, width = x.shape
    if n:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
        flat = binned + np.arange(width) * bins
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, hessian = y - p, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            update = np.zeros(n)
            _grow(nodes, np.arange(n), flat, binned, gradient, hessian, cuts, bins, depth, rate, update)
            margin += update
    empty = np.zeros(0, np.int64)
    columns = list(zip(*nodes)) if nodes else [empty] * 5
    feature, threshold, left, right, value = (np.array(c) for c in columns)
    return Trees(
        feature.astype(np.int64), threshold.astype(float), left.astype(np.int64),
        right.astype(np.int64), value.astype(float), np.array(roots, np.int64), base,
        depth if nodes else 0,
    )


def _grow(nodes, rows, flat, binned, gradient, hessian, cuts, bins, depth, rate, update) -> int:
    """Adds the subtree of these rows; returns its node."""
    index = len(nodes)
    g, h = gradient[rows].sum(), hessian[rows].sum()
    value = rate * g / (h + SHRINK)
    nodes.append([0, 0.0, index, index, value])
    best = (1e-6, None, None)
    if depth and len(rows) >= 2 * LEAST:
        width, size = flat.shape[1], flat.shape[1] * bins
        places = flat[rows].ravel()
        sums = [
            np.bincount(places, weights=np.repeat(v[rows], width), minlength=size).reshape(width, bins)
            for v in (gradient, hessian)
        ]
        count = np.bincount(places, minlength=size).reshape(width, bins)
        gl, hl, nl = (a.cumsum(axis=1)[:, :-1] for a in (*sums, count))
        gain = gl**2 / (hl + SHRINK) + (g - gl) ** 2 / (h - hl + SHRINK) - g**2 / (h + SHRINK)
        gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -np.inf
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        if gain[f, b] > best[0]:
            best = (gain[f, b], int(f), int(b))
    if best[1] is None:
        update[rows] = value
        return index
    _, f, b = best
    goes_left = binned[rows, f] <= b
    nodes[index] = [f, float(cuts[f][b]), 0, 0, 0.0]
    inner = (flat, binned, gradient, hessian, cuts, bins, depth - 1, rate, update)
    nodes[index][2] = _grow(nodes, rows[goes_left], *inner)
    nodes[index][3] = _grow(nodes, rows[~goes_left], *inner)
    return index


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.encode(key.cast("string"), "utf-8")) % 4


def training_rows(
    docs: DataFrame, labels: DataFrame, target: str = "quality", held_out: int = 2,
    most: int = MAX_ROWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a bounded sample outside the held-out fold."""
    votes = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .filter(fold(F.col("doc_id")) != held_out)
        .groupBy("doc_id")
        .agg(F.avg(F.col(target).cast("double")).alias("share"))
        .select("doc_id", (F.col("share") >= 0.5).cast("int").alias("label"))
    )
    chosen = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    picked = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows

    def measure(batches):
        for batch in batches:
            x = pa.array(list(matrix(t.as_py() for t in batch["text"])), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], x], ["doc_id", "label", "x"])

    kind = schemas.struct(doc_id=schemas.LONG, label=schemas.INT, x=schemas.array(schemas.DOUBLE))
    one = picked.mapInArrow(measure, kind).groupBy("doc_id").agg(
        F.max_by("label", "x").alias("label"), F.max("x").alias("x")
    )
    rows = sorted(one.collect())  # bounded by `most`
    x = np.array([r.x for r in rows], np.float64).reshape(-1, len(FEATURES))
    return x, np.array([r.label for r in rows], np.float64)


def score(text: Column, trees: Trees) -> Column:
    """Scores of whole texts, 0 to 1."""

    @F.arrow_udf(schemas.DOUBLE)
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(trees.scores(matrix(t.as_py() for t in texts)))

    return scored(text)


def scored(docs: DataFrame, labels: DataFrame, cut: float = 0.7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    trees = fit(*training_rows(docs, labels, held_out=held_out))
    return docs.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == held_out, F.lit(False)).alias("held_out"),
        score(F.col("text"), trees).alias("score"),
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))
