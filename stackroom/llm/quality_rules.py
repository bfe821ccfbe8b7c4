"""Quality rules whose cutoffs are chosen on labelled holdouts, with a bound on falsely rejected documents.

A rule rejects a document whose ratio lies above the rule's cutoff. For each stratum (language) the cutoffs of all rules
are tightened along one fixed path, a step of one rule at a time, from the most lenient on. A point of the path is
proven if the exact binomial test rejects "more than ``risk`` of the good documents would be rejected by any of the
rules" on the good labelled documents of the stratum; the path is left at the first point that is not proven (a fixed
sequence of tests needs no correction of its own), and the last proven point gives the cutoffs. The whole ``risk`` is
there for all rules together. Strata are tested side by side, so the error is divided by their number; those with fewer
labels than a test without any false rejection needs are not tested, have no cutoffs, and all their documents pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_by_row

SYMBOLS = b"#*$%&|<>"
WHITE_SPACE = b" \t\n\x0b\x0c\r"

#: Cutoffs of each rule, lenient to strict; a document is rejected above the cutoff.
LADDERS: dict[str, tuple[float, ...]] = {
    "symbol_ratio": (8.0, 4.0, 2.0, 1.0, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02, 0.01, 0.005),
    "duplicate_line_ratio": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02),
    "repeat_word_ratio": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05, 0.02),
    "mean_word_length": (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.0, 6.0),
}

#: (rule, cutoff) in the order in which cutoffs are tightened: every rule's first step, every rule's second, and so on.
PATH = [
    (rule, LADDERS[rule][step])
    for step in range(max(map(len, LADDERS.values())))
    for rule in LADDERS
    if step < len(LADDERS[rule])
]

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class RiskSpec:
    """``risk``: most good documents of a stratum that all rules together may reject. ``error``: chance that any bound is wrong."""

    risk: float = 0.02
    error: float = 0.05

    def fewest(self) -> int:
        """Good labels below which no test can prove anything."""
        return math.ceil(math.log(self.error) / math.log1p(-self.risk))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    distinct = len(number)
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct >= 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    hit = np.isin(windows, again)
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def count_text(text: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a text in UTF-8; null has none of anything."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(WHITE_SPACE)]
    letters = text.translate(None, WHITE_SPACE)
    chars = len(letters) if letters.isascii() else len(letters.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def text_counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and ``COUNTS`` of every document, whole texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("stratum", pa.string()), *((c, pa.int64()) for c in COUNTS)])
    rows = docs.select(F.col("doc_id").cast("long"), F.col(stratum).cast("string"), F.col("text").cast("binary"))
    sql = "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)
    return rows.mapInArrow(row_by_row(lambda i, s, t: (i, s, *count_text(t)), schema), sql)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / words,
        "duplicate_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_word_ratio": F.col("n_repeat_words") / words,
        "mean_word_length": F.col("word_chars") / words,
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), exact up to rounding, summed from the largest term down."""
    if n <= 0 or k >= n:
        return 1.0
    term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    if k > n * p:  # the upper tail is the short one: P(X > k)
        total, i, value = 0.0, k, math.exp(term)
        while i < n:
            value *= (n - i) / (i + 1) * p / (1 - p)
            i += 1
            total += value
            if value < 1e-18 * max(total, 1e-300):
                break
        return max(0.0, 1.0 - total)
    total, i, value = 0.0, k, 1.0
    while i >= 0 and value > 1e-18 * total:
        total += value
        value *= i / (n - i + 1) * (1 - p) / p
        i -= 1
    return min(1.0, math.exp(term) * total)


def ladder_counts(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """For each stratum and point of the path: good labelled documents, and how many of them the rules would reject there.

    Documents that the base rules reject anyway do not count. One aggregation with partial sums; a row per stratum
    leaves it.
    """
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long")).distinct()
    held = counts.where(~base_failed()).join(good, "doc_id", "left_semi")
    values = ratios()
    # The first point of the path that rejects a document; all later ones reject it too.
    first = F.least(*(F.when(values[rule] > cutoff, point).otherwise(len(PATH)) for point, (rule, cutoff) in enumerate(PATH)))
    met = held.withColumn("first", first)
    above = [F.sum((F.col("first") <= point).cast("long")).alias(f"to_{point}") for point in range(len(PATH))]
    points = [F.struct(F.lit(point).alias("point"), F.col(f"to_{point}").alias("rejected")) for point in range(len(PATH))]
    return met.groupBy("stratum").agg(F.count("*").alias("n"), *above).select("stratum", "n", F.inline(F.array(*points)))


def choose_cutoffs(ladders: DataFrame, strata: int, spec: RiskSpec) -> DataFrame:
    """stratum and the cutoff of each rule at the last proven point (null: none)."""
    error = spec.error / max(strata, 1)

    @F.pandas_udf("boolean")
    def proven(n: pd.Series, rejected: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(k), int(m), spec.risk) <= error for m, k in zip(n, rejected)], dtype=bool)

    tested = ladders.withColumn("proven", proven("n", "rejected"))
    broken = tested.groupBy("stratum").agg(F.coalesce(F.min(F.when(~F.col("proven"), F.col("point"))), F.lit(len(PATH))).alias("broken"))
    # Cutoffs fall along the path, so the least before the broken point is the one that stands.
    reached = {
        rule: F.least(*(F.when(F.col("broken") > point, cutoff) for point, (r, cutoff) in enumerate(PATH) if r == rule), F.lit(None).cast("double"))
        for rule in LADDERS
    }
    return broken.select("stratum", *(value.alias(f"{rule}_cutoff") for rule, value in reached.items()))


def judge(docs: DataFrame, labels: DataFrame, spec: RiskSpec = RiskSpec(), stratum: str = "lang") -> DataFrame:
    """Counts, ratios, cutoffs and verdict of every document.

    Null text counts as empty; a null stratum is a stratum of its own; repeated rows are each judged; labels of
    documents that are not there, and null labels, are not used. Without labels only the base rules reject.
    """
    counts = materialize(text_counts(docs, stratum), "quality-counts")
    ladders = ladder_counts(counts, labels)
    ladders = materialize(ladders, "quality-ladders")
    strata = ladders.where(F.col("n") >= spec.fewest()).select("stratum").distinct().count()
    cutoffs = choose_cutoffs(ladders, strata, spec).withColumnRenamed("stratum", "of")
    values = ratios()
    over = F.lit(False)
    for rule, value in values.items():
        over = over | F.coalesce(value > F.col(f"{rule}_cutoff"), F.lit(False))
    judged = counts.join(cutoffs, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    return judged.withColumns({**values, "base_failed": base_failed(), "kept": ~base_failed() & ~over})
