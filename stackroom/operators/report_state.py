"""Reports kept by increments: batches of reviews are added to a state, corrections taken away, and reports read from it.

The state counts reviews that are alike in all that reports use: title, day, score and price. Counts add up whatever the
order of batches, a correction is a batch of negative counts, and least and greatest values come from counts that are
left, so they are right after a correction too. A batch is one more part of a versioned table, in proportion to the
batch; ``compact`` adds parts up. A batch is published under its name, and one that is there already is not added twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.operators import reports
from stackroom.sources.versions import Versions

ALIKE = ("title_hash", "review_date", "review_score", "price")
BATCHES = "batches"


class ReviewState:
    def __init__(self, store: Versions):
        self.store = store

    def batches(self) -> list[str]:
        """Names of the batches in the state."""
        return self.store.manifest()["notes"].get(BATCHES, [])

    def add(self, batch: str, reviews: DataFrame, removed: DataFrame | None = None) -> bool:
        """Add a batch, and take away reviews that were added before; False if the state has a batch of that name."""
        number = self.store.number()
        manifest = self.store.manifest(number)
        known = manifest["notes"].get(BATCHES, [])
        if batch in known:
            return False
        change = _signed(reviews, 1)
        if removed is not None:
            change = change.unionAll(_signed(removed, -1))
        part = self.store.stage(_added_up(change))
        self.store.publish([*manifest["parts"], part], {BATCHES: [*known, batch]}, number)
        return True

    def compact(self) -> None:
        """One part for all, with what is left of each count."""
        number = self.store.number()
        part = self.store.stage(_added_up(self.store.read()))
        self.store.publish([part], self.store.manifest(number)["notes"], number)

    def counts(self) -> DataFrame:
        """Reviews that are there, as (title_hash, review_date, review_score, price, n)."""
        return _added_up(self.store.read()).filter("n > 0")

    def book_performance(self, books: DataFrame) -> DataFrame:
        rated = self.counts().groupBy("title_hash").agg(
            F.sum("n").alias("review_count"),
            _mean("review_score"),
            F.min("review_score").alias("min_review_score"),
            F.max("review_score").alias("max_review_score"),
            F.min("review_date").alias("first_review_date"),
            F.max("review_date").alias("last_review_date"),
            _mean("price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        return reports.performance_of(books, rated)

    def category_summary(self, books: DataFrame) -> DataFrame:
        scored = self.counts().groupBy("title_hash").agg(
            F.coalesce(F.sum(_number("review_score")), F.lit(0)).alias("scores"),
            F.sum(F.col("review_score") * F.col("n")).alias("score_sum"),
        )
        return reports.categories_of(books, scored)

    def review_daily(self) -> DataFrame:
        """Titles of a day are distinct rows of the state, so counting them takes no second look at reviews."""
        per_title = self.counts().filter("review_date IS NOT NULL")
        return per_title.groupBy("review_date").agg(
            F.sum("n").alias("review_count"),
            F.count_distinct("title_hash").alias("reviewed_book_count"),
            _mean("review_score"),
            _mean("price"),
            F.coalesce(F.sum(_number("price")), F.lit(0)).alias("priced_review_count"),
        )


def _signed(reviews: DataFrame, sign: int) -> DataFrame:
    """A count for each review, to be added up once: most reviews are like no other, and every aggregate holds them all."""
    return reviews.select(*ALIKE, F.lit(sign).cast("long").alias("n"))


def _added_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*ALIKE).agg(F.sum("n").alias("n")).filter("n <> 0")


def _number(name: str) -> Column:
    """How many reviews have a value there."""
    return F.when(F.col(name).isNotNull(), F.col("n"))


def _mean(name: str) -> Column:
    return F.round(F.sum(F.col(name) * F.col("n")) / F.sum(_number(name)), 2).alias(f"avg_{name}")
