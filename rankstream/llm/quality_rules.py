"""Quality rules: fixed base rules, then thresholds adapted to each language and source.

Each document has four base counts. Documents that pass the base rules feed a mergeable quantile
sketch per (lang, source): an integer histogram whose bucket bounds are exact up to 1/32, so that
sketches merge by adding counts, map-side first. A rule's fence lies at an outer quantile of the
group's own sketch, plus a multiple of the gap between an inner and the outer one, at least of the
sketch's bucket there. Fences are pulled toward that of the language, and those toward that of all
documents, with the weight n / (n + PULL) for n documents, so that they move with the data at every
size. The fences are joined back and filter the documents.

Defined results: a null text has no words and fails the base rules; null languages and sources
are groups of their own; repeated rows are judged one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankstream import schemas
from rankstream.llm.common import hidden, per_value, settle

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = schemas.struct(**dict.fromkeys((*BASE, "n_lines"), schemas.LONG))
_SYMBOL = re.compile(r"[#*$%&|<>]")


@dataclass(frozen=True)
class Rule:
    """A share in thousandths and the quantiles, in percent, that its fence is made of."""

    name: str
    numerator: str
    denominator: str
    inner: int
    outer: int

    @property
    def below(self) -> bool:
        """Whether small shares are rejected."""
        return self.outer < self.inner


# Shares that most documents have at zero are judged by the tail of those that do not.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 50, 75),
    Rule("dup_lines", "n_dup_lines", "n_lines", 95, 99),
    Rule("repeats", "n_repeat_words", "n_words", 95, 99),
    Rule("long_words", "word_chars", "n_words", 50, 75),
    Rule("short_words", "word_chars", "n_words", 50, 25),
)
REACH = 10
PULL = 100
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _counts(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * 6
    words = text.encode().split()  # bytes split at \x20 and \x09-\x0D only
    joined = b"".join(words)
    lines = [line for line in text.split("\n") if line.encode().split()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        seen, twice = set(), set()
        for window in windows:
            (twice if window in seen else seen).add(window)
        end = 0  # words before this place are counted
        for start, window in enumerate(windows):
            if window in twice:
                repeated += start + 3 - max(start, end)
                end = start + 3
    return (
        len(words),
        len(joined.decode()),
        len(_SYMBOL.findall(text)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
    )


def statistics(text: Column) -> Column:
    """The base counts of whole texts."""
    return per_value(_counts, STATISTICS, once=True)(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _share(rule: Rule, counts: str) -> Column:
    top, bottom = (F.col(f"{counts}.{c}") for c in (rule.numerator, rule.denominator))
    return F.floor(1000 * top / F.greatest(bottom, F.lit(1))).cast("long")


def _shift(value: Column) -> Column:
    return F.greatest(F.lit(0), F.length(F.bin(value)) - 6)


def _bucket(value: Column) -> Column:
    """The lower bound of the value's bucket: its six leading bits."""
    shift = _shift(value)
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def _width(value: Column) -> Column:
    """The width of the value's bucket."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _shift(value))


def _sketches(measured: DataFrame, counts: str, language: str, source: str) -> DataFrame:
    """Rows (level, lang, source, rule, bucket, n): histograms of groups, languages and all."""
    values = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), _bucket(_share(r, counts)).alias("bucket"))
          for r in RULES]
    )
    passed = measured.filter(~base_failed(F.col(f"{counts}.n_words"),
                                          F.col(f"{counts}.n_repeat_words")))
    fine = (
        passed.select(F.col(f"`{language}`").alias("lang"), F.col(f"`{source}`").alias("source"),
                      F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.rule", "v.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return settle(fine, "sketch")


def _fences(sketch: DataFrame, keys: list[str], reach: int) -> DataFrame:
    """Per group and rule: documents, and the fence of its own sketch."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    # a sketch has some hundred buckets at most, however many documents it stands for
    arrays = merged.groupBy(*keys, "rule").agg(
        F.sum("n").alias("total"),
        F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("buckets"),
    )

    def quantile(which: str) -> Column:
        """The first bucket at which the running count reaches the rule's share."""
        percents = F.create_map(*[F.lit(x) for r in RULES for x in (r.name, getattr(r, which))])
        percent = percents[F.col("rule")]
        found = F.aggregate(
            F.col("buckets"),
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at")),
            lambda acc, b: F.struct(
                (acc.seen + b.n).alias("seen"),
                F.coalesce(
                    acc["at"],
                    F.when((acc.seen + b.n) * 100 >= F.col("total") * percent, b.bucket),
                ).alias("at"),
            ),
        )
        return found["at"]

    placed = arrays.select(*keys, "rule", "total", quantile("inner").alias("q_in"), quantile("outer").alias("q_out"))
    spread = F.greatest(F.abs(F.col("q_out") - F.col("q_in")), _width(F.col("q_out")))
    way = F.when(F.col("rule").isin([r.name for r in RULES if r.below]), -1).otherwise(1)
    return placed.select(*keys, "rule", "total", (F.col("q_out") + way * reach * spread).alias("fence"))


def _pulled(total: Column, fence: Column, toward: Column, pull: int) -> Column:
    """The mean of two fences, the first weighted by its documents and the second by ``pull``."""
    return F.floor((total * fence + pull * toward) / (total + pull))


def thresholds(sketch: DataFrame, reach: int = REACH, pull: int = PULL) -> DataFrame:
    """One row per (lang, source) with the fence of each rule, in thousandths."""

    def level(keys: list[str], prefix: str) -> DataFrame:
        made = _fences(sketch, keys, reach)
        return made.select(*[F.col(c).alias(f"{prefix}{c}") for c in made.columns])

    fine, language, whole = level(["lang", "source"], ""), level(["lang"], "l_"), level([], "w_")
    joined = fine.join(
        language, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rule") == F.col("l_rule"))
    ).join(whole, F.col("rule") == F.col("w_rule"))
    by_language = _pulled(F.col("l_total"), F.col("l_fence"), F.col("w_fence"), pull)
    chosen = joined.withColumn("chosen", _pulled(F.col("total"), F.col("fence"), by_language, pull))
    return chosen.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("chosen"))).alias(r.name) for r in RULES]
    )


def judge(
    docs: DataFrame, measured: DataFrame | None = None, counts: str = "counts",
    language: str = "lang", source: str = "source", text: str = "text",
) -> DataFrame:
    """``docs`` with the struct ``counts`` and the booleans ``base_failed`` and ``kept`` in it.

    ``measured`` may hold the counts of the same documents, to spare a pass for the sketches.
    """
    if measured is None:
        sketched = docs.select(
            F.col(f"`{language}`"), F.col(f"`{source}`"), statistics(F.col(f"`{text}`")).alias(counts)
        )
        docs = docs.withColumn(counts, statistics(F.col(f"`{text}`")))
    else:
        sketched, docs = measured, measured
    fences = settle(thresholds(_sketches(sketched, counts, language, source)), "fences")
    lang, src = hidden("lang"), hidden("source")
    names = {r.name: hidden(r.name) for r in RULES}
    fences = fences.select(
        F.col("lang").alias(lang), F.col("source").alias(src),
        *[F.col(k).alias(v) for k, v in names.items()],
    )
    failed = base_failed(F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words"))
    verdict = ~failed
    for rule in RULES:
        share, fence = _bucket(_share(rule, counts)), F.col(names[rule.name])
        inside = share >= fence if rule.below else share <= fence
        verdict = verdict & F.coalesce(inside, F.lit(True))
    joined = docs.join(
        fences,
        F.col(f"`{language}`").eqNullSafe(F.col(lang)) & F.col(f"`{source}`").eqNullSafe(F.col(src)),
        "left",
    )
    verdicts = F.struct(F.col(f"{counts}.*"), failed.alias("base_failed"), verdict.alias("kept"))
    return joined.withColumn(counts, verdicts).drop(lang, src, *names.values())


def filtered(docs: DataFrame) -> DataFrame:
    """The documents that all rules keep, with their own columns."""
    name = hidden("counts")
    judged = judge(docs, counts=name)
    return judged.filter(F.col(f"{name}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
