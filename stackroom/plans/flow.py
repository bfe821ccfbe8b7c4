"""The whole flow, lazily or with every layer written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stackroom.operators import reports
from stackroom.operators.checks import enforce, summarize
from stackroom.operators.defaults import fill_defaults
from stackroom.operators.enrich import enrich
from stackroom.operators.quarantine import eligible, rejects
from stackroom.operators.serving import serve
from stackroom.operators.standardize import standardize
from stackroom.plans import bookstore as rules
from stackroom.plans.bookstore import BOOKS, REVIEWS
from stackroom.plans.layers import Layer, Release, Run, Source, run_layers
from stackroom.plans.jobs import report_checks, report_relationship
from stackroom.sources.raw_csv import read_raw_csv
from stackroom.sources.tables import LAYER_SETTINGS, Assets
from stackroom.sources.workspace import free_shuffles


def silver_books(raw: DataFrame) -> DataFrame:
    """Standardize, fill, enrich: flags are set after defaults are filled."""
    return (
        raw.transform(standardize, rules.BOOKS_SILVER)
        .transform(fill_defaults, rules.BOOKS_DEFAULTS)
        .transform(enrich, rules.BOOKS_QUALITY)
    )


def silver_reviews(raw: DataFrame) -> DataFrame:
    return (
        raw.transform(standardize, rules.REVIEWS_SILVER)
        .transform(fill_defaults, rules.REVIEWS_DEFAULTS)
        .transform(enrich, rules.REVIEWS_QUALITY)
    )


@dataclass(frozen=True)
class Gold:
    books: DataFrame
    reviews: DataFrame
    reviews_science: DataFrame

    def book_performance(self) -> DataFrame:
        return reports.book_performance(self.books, self.reviews)

    def category_summary(self) -> DataFrame:
        return reports.category_summary(self.books, self.reviews)

    def review_daily(self) -> DataFrame:
        return reports.review_daily(self.reviews)


def gold_of(books: DataFrame, reviews: DataFrame) -> Gold:
    """Serving tables from eligible books and enriched reviews (reviews are not quarantined)."""
    return Gold(
        books=serve({"books": books}, rules.BOOKS_ANALYTICS),
        reviews=serve({"reviews": reviews}, rules.REVIEWS_ANALYTICS),
        reviews_science=serve({"reviews": reviews}, rules.REVIEWS_SCIENCE),
    )


def lazy_flow(raw_books: DataFrame, raw_reviews: DataFrame) -> Gold:
    """From raw tables to serving tables as one plan, nothing written."""
    return gold_of(silver_books(raw_books).transform(eligible, rules.BOOKS_QUARANTINE), silver_reviews(raw_reviews))


# The asset names of both data sets. An asset lies in the folder data set / asset below the root.
ASSETS = {
    BOOKS: (
        "raw_csv", "bronze_full", "silver_standardized", "silver_defaults_filled", "silver_quality_enriched",
        "silver_eligible", "silver_quarantine", "gold_books_serving_da",
    ),
    REVIEWS: (
        "raw_csv", "bronze_full", "silver_standardized", "silver_defaults_filled", "silver_quality_enriched",
        "gold_reviews_serving_da", "gold_reviews_serving_ds",
    ),
}


def assets_under(root: str) -> Assets:
    return Assets({d: {a: f"{root}/{d}/{a}" for a in assets} for d, assets in ASSETS.items()})


def run_flow(
    spark: SparkSession,
    assets: Assets,
    reports_path: str,
    gate: bool = True,
    every_layer: bool = True,
    rows_per_file: int | None = None,
    as_of: date | None = None,
    compression: str = "zstd",
) -> dict[str, int]:
    """Run from raw CSV to gold on files; returns the rows of each table written.

    Every layer holds the texts once more, so tables are written with ``LAYER_SETTINGS`` and ``compression``, and shuffle files go with their stage.

    Each stage reads what the one before wrote. With ``every_layer`` off, standardize,
    fill and enrich are one plan and only its result is written, which saves two
    writes and two reads of each table. With ``gate`` on, a failed critical check
    stops the run after its summary and samples are stored.
    """
    written: dict[str, int] = {}

    def store(df: DataFrame, dataset: str, asset: str, **options) -> DataFrame:
        written[f"{dataset}/{asset}"] = assets.write(df, dataset, asset, **{**LAYER_SETTINGS, "compression": compression, **options})
        free_shuffles(spark)
        return assets.read(spark, dataset, asset)

    def layer(df: DataFrame, dataset: str, asset: str) -> DataFrame:
        return store(df, dataset, asset) if every_layer else df

    def silver(dataset, contract, standard, defaults, quality) -> DataFrame:
        raw = read_raw_csv(spark, assets.path(dataset, "raw_csv"), contract)
        bronze = store(raw, dataset, "bronze_full", max_records_per_file=rows_per_file)
        clean = layer(bronze.transform(standardize, standard), dataset, "silver_standardized")
        filled = layer(clean.transform(fill_defaults, defaults), dataset, "silver_defaults_filled")
        return store(filled.transform(enrich, quality), dataset, "silver_quality_enriched")

    def check(df: DataFrame, suite) -> None:
        folder = f"{reports_path}/{suite.dataset_name}"
        paths = (f"{folder}/summary", f"{folder}/failed_rows")
        counts = report_checks(df, suite, *paths, "parquet", "parquet", gate=gate, as_of=as_of)
        written.update({f"{suite.dataset_name}/{name}": rows for name, rows in counts.items()})

    books = silver(BOOKS, rules.BOOKS_CONTRACT, rules.BOOKS_SILVER, rules.BOOKS_DEFAULTS, rules.BOOKS_QUALITY)
    good = store(eligible(books, rules.BOOKS_QUARANTINE), BOOKS, "silver_eligible")
    store(rejects(books, rules.BOOKS_QUARANTINE), BOOKS, "silver_quarantine")
    check(books, rules.BOOKS_CHECKS)

    reviews = silver(
        REVIEWS, rules.REVIEWS_CONTRACT, rules.REVIEWS_SILVER, rules.REVIEWS_DEFAULTS, rules.REVIEWS_QUALITY
    )
    check(reviews, rules.REVIEWS_CHECKS)

    folder = f"{reports_path}/relationship"
    paths = (f"{folder}/summary", f"{folder}/failed_rows")
    counts = report_relationship(reviews, good, rules.TITLE_RELATIONSHIP, *paths, "parquet", "parquet", gate=gate)
    written.update({f"relationship/{name}": rows for name, rows in counts.items()})

    gold = gold_of(good, reviews)
    store(gold.books, BOOKS, "gold_books_serving_da")
    store(gold.reviews, REVIEWS, "gold_reviews_serving_da")
    store(gold.reviews_science, REVIEWS, "gold_reviews_serving_ds")
    return written


def _layers() -> list[Layer]:
    """The flow as layers: each clean table is one plan from its first layer."""
    eligible_rules, books = rules.BOOKS_QUARANTINE, f"{BOOKS}/silver_quality_enriched"
    reviews, good = f"{REVIEWS}/silver_quality_enriched", f"{BOOKS}/silver_eligible"
    silver = {
        BOOKS: (silver_books, (rules.BOOKS_SILVER, rules.BOOKS_DEFAULTS, rules.BOOKS_QUALITY)),
        REVIEWS: (silver_reviews, (rules.REVIEWS_SILVER, rules.REVIEWS_DEFAULTS, rules.REVIEWS_QUALITY)),
    }
    first = [Layer(f"{d}/bronze_full", (d,), lambda raw: raw, (c,)) for d, c in CONTRACTS.items()]
    clean = [Layer(f"{d}/silver_quality_enriched", (f"{d}/bronze_full",), build, given) for d, (build, given) in silver.items()]
    served = [
        (f"{BOOKS}/gold_books_serving_da", good, "books", rules.BOOKS_ANALYTICS),
        (f"{REVIEWS}/gold_reviews_serving_da", reviews, "reviews", rules.REVIEWS_ANALYTICS),
        (f"{REVIEWS}/gold_reviews_serving_ds", reviews, "reviews", rules.REVIEWS_SCIENCE),
    ]
    return [
        *first,
        *clean,
        Layer(good, (books,), lambda df: eligible(df, eligible_rules), (eligible_rules,)),
        Layer(f"{BOOKS}/silver_quarantine", (books,), lambda df: rejects(df, eligible_rules), (eligible_rules,)),
        *[Layer(name, (of,), lambda df, i=i, spec=spec: serve({i: df}, spec), (spec,)) for name, of, i, spec in served],
    ]


CONTRACTS = {BOOKS: rules.BOOKS_CONTRACT, REVIEWS: rules.REVIEWS_CONTRACT}


def resume_flow(
    spark: SparkSession, assets: Assets, root: str, gate: bool = True, done: Callable[[str], None] = lambda name: None
) -> Run:
    """The flow from raw CSV to gold below ``root``, from the first layer on whose inputs or rules have changed.

    With ``gate`` on, a failed critical check raises before anything is released. Read the result with ``released_gold``.
    """

    def source(dataset: str) -> Source:
        path = assets.path(dataset, "raw_csv")
        return Source(path, lambda: read_raw_csv(spark, path, CONTRACTS[dataset]))

    def check(tables: Mapping[str, DataFrame]) -> None:
        for dataset, suite in ((BOOKS, rules.BOOKS_CHECKS), (REVIEWS, rules.REVIEWS_CHECKS)):
            enforce(summarize(tables[f"{dataset}/silver_quality_enriched"], suite))

    return run_layers(spark, root, {d: source(d) for d in CONTRACTS}, _layers(), check if gate else lambda tables: None, done)


def released_gold(spark: SparkSession, root: str) -> Gold:
    """Serving tables of the newest release, all of one run."""
    release = Release(spark, root)
    return Gold(
        books=release.read(f"{BOOKS}/gold_books_serving_da"),
        reviews=release.read(f"{REVIEWS}/gold_reviews_serving_da"),
        reviews_science=release.read(f"{REVIEWS}/gold_reviews_serving_ds"),
    )


def stored_gold(spark: SparkSession, assets: Assets) -> Gold:
    return Gold(
        books=assets.read(spark, BOOKS, "gold_books_serving_da"),
        reviews=assets.read(spark, REVIEWS, "gold_reviews_serving_da"),
        reviews_science=assets.read(spark, REVIEWS, "gold_reviews_serving_ds"),
    )
