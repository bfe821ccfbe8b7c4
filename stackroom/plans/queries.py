"""One query for each operator, over the test tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.operators import checks, relationship
from stackroom.operators.defaults import fill_defaults
from stackroom.operators.enrich import EnrichSpec, enrich
from stackroom.operators.profile import first_rows, table_profile
from stackroom.operators.quarantine import eligible, rejects
from stackroom.operators.report_state import ReviewState
from stackroom.operators.serving import ServingSpec, serve
from stackroom.operators.standardize import StandardizeSpec, standardize
from stackroom.operators.surrogate import SurrogateKey, assign_keys, assign_stable_keys, extend_keys
from stackroom.plans import bookstore as rules
from stackroom.plans import flow
from stackroom.plans.jobs import JOBS
from stackroom.plans.fixtures import raw_books, raw_reviews, table
from stackroom.sources.csv_ranges import read_records
from stackroom.sources.raw_csv import CSV_DEFAULTS, CsvContract, read_in_ranges, read_parts, read_raw_csv
from stackroom.sources.sized import file_sizes, write_sized
from stackroom.sources.tables import Assets, read_table, write_failed_rows, write_summary, write_table
from stackroom.sources.versions import Versions
from stackroom.sources.workspace import SHARED_FOLDER, free_shuffles, new_folder
from stackroom.streaming.tables import arrive, repeated_key_rows

# A check that no book fails.
PRICED = checks.Check(name="score_not_negative", type="non_negative", severity="critical", column="completeness_score")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name; an underscore at the end only keeps an operator's name free.

    Epoch seconds are read as UTC.
    """

    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        _give_folder(spark)
        return without_zone(build(spark, folder))

    QUERIES[build.__name__.removesuffix("_")] = run
    return run


def _give_folder(spark: SparkSession) -> None:
    """A local session without a shared folder gets one for its queries; on a cluster the setting must be there."""
    given = spark.conf.get(SHARED_FOLDER, None) or spark.sparkContext.getCheckpointDir()
    if not given and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stackroom-"))


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as plain UTC clock readings, which compare the same everywhere."""
    zoned = {name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"}
    return df.withColumns(zoned) if zoned else df


# --- source -----------------------------------------------------------------------------------

DOCUMENTS_CONTRACT = CsvContract(
    (("review/text", "text"), ("doc id", "doc_id"), ("lang", "language"), ("source", "source"))
)


@query
def csv_ingest(spark, folder):
    """Documents as quoted multi-line CSV with odd header names, picked by name out of order."""
    path = new_folder(spark, "csv_ingest")
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("doc id"), "lang", F.col("text").alias("review/text"), "n_chars", "source"
    )
    write_table(
        documents,
        path,
        "csv",
        escape=CSV_DEFAULTS["escape"],
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return read_raw_csv(spark, path, DOCUMENTS_CONTRACT)


# Text in a file of ``csv_one_file``, which one task writes.
ONE_FILE_BYTES = 512 << 20


@query
def csv_one_file(spark, folder):
    """Documents as one multi-line CSV file (another for each half GB) with each text once and twice, read in ranges; were
    there several for a file?"""
    path = new_folder(spark, "csv_one_file")
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    size = documents.agg(F.sum(F.octet_length("text") * F.lit(3).cast("long"))).first()[0] or 0
    files = -(-size // ONE_FILE_BYTES) or 1
    dealt = documents.repartition(files) if files > 1 else documents.coalesce(1)
    whole = dealt.select("doc_id", "text", F.repeat("text", 2).alias("twice"), "lang")
    write_table(whole, path, "csv", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    contract = CsvContract((("lang", "language"), ("twice", "twice"), ("text", "text"), ("doc_id", "doc_id")))
    ranges = read_records(spark, path, contract.reader_options()).ranges
    return read_in_ranges(spark, path, contract).withColumn("in_ranges", F.lit(ranges > files))


@query
def csv_bad_records(spark, folder):
    """Documents as CSV records without a header, of which every seventh each has a field too many, too few, or text after a quote.

    Good rows have no reasons; bad records come as they stand in the file.
    """
    path = new_folder(spark, "csv_bad_records")
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    whole = F.concat_ws(",", text, "doc_id", "lang")
    kind = F.col("doc_id") % 7
    record = (
        F.when(kind == 3, F.concat(whole, F.lit(",extra")))
        .when(kind == 4, text)
        .when(kind == 5, F.concat_ws(",", F.concat(text, F.lit("tail")), "doc_id", "lang"))
        .otherwise(whole)
    )
    records = table(spark, folder, "documents").orderBy("doc_id").select(record.alias("value"))
    write_table(records, path, "text")
    contract = CsvContract((("_c0", "text"), ("_c1", "doc_id"), ("_c2", "lang")), {"header": False})
    good, bad = read_parts(spark, path, contract)
    shaped = bad.select(F.col("record").alias("text"), F.lit(None).cast("string").alias("doc_id"), F.lit(None).cast("string").alias("lang"), "reasons")
    return good.withColumn("reasons", F.lit("")).unionAll(shaped)


@query
def csv_table(spark, folder):
    """A table written and read back as header CSV: every column is text. Price and date take their types again."""
    path = new_folder(spark, "csv_table")
    orders = table(spark, folder, "orders")
    write_table(orders, path, "csv")
    typed = {name: F.col(name).cast(orders.schema[name].dataType) for name in ("o_totalprice", "o_orderdate")}
    return read_table(spark, path, "csv").withColumns(typed)


# --- sinks ------------------------------------------------------------------------------------

ROWS_PER_FILE = 500


def _stored_lines(spark, folder):
    """All line items as ORC, in folders by return flag, spread over seven tasks, at most so many rows in a file."""
    path = new_folder(spark, "sink")
    lines = table(spark, folder, "lineitem")
    settings = {"partitions": 7, "partition_by": ("l_returnflag",), "max_records_per_file": ROWS_PER_FILE}
    write_table(lines, path, "orc", compression="zlib", **settings)
    return spark.read.orc(path)


@query
def sink_orc_partitioned(spark, folder):
    return _stored_lines(spark, folder)


@query
def sink_file_layout(spark, folder):
    """Rows by folder, and whether every file keeps to the cap and every folder has the files the cap asks for."""
    files = _stored_lines(spark, folder).groupBy("l_returnflag", F.input_file_name().alias("file")).count()
    counted = files.groupBy("l_returnflag").agg(
        F.sum("count").alias("rows"), F.max("count").alias("most"), F.count(F.lit(1)).alias("files")
    )
    enough = F.col("files") >= F.ceil(F.col("rows") / ROWS_PER_FILE)
    return counted.select("l_returnflag", "rows", (F.col("most") <= ROWS_PER_FILE).alias("capped"), enough.alias("spread"))


TARGET_BYTES = 100_000


def _sized_lines(spark, folder, folders):
    """All line items by a skewed column, of which one value holds half, in files of so many bytes."""
    path = new_folder(spark, "sized")
    mode = F.when(F.col("l_orderkey") % 2 == 0, "any").otherwise(F.concat(F.lit("line "), "l_linenumber"))
    lines = table(spark, folder, "lineitem").withColumn("mode", mode)
    write_sized(lines, path, ["mode"], TARGET_BYTES, folders, sample_rows=4000)
    return spark.read.parquet(path)


@query
def sink_sized_folders(spark, folder):
    """Rows by folder, and whether its files are within a quarter of the target; a folder too small for two has one."""
    files = file_sizes(_sized_lines(spark, folder, folders=True), "mode")
    near = F.abs(F.col("bytes") / TARGET_BYTES - 1) <= 0.25
    one = (F.count(F.lit(1)) == 1) & (F.max("bytes") < 1.6 * TARGET_BYTES)
    return files.groupBy("mode").agg(F.sum("rows").alias("rows"), (F.every(near) | one).alias("sized"))


@query
def sink_sized_packed(spark, folder):
    """Rows by value, and whether all files that hold it are within a quarter of the target."""
    lines = _sized_lines(spark, folder, folders=False)
    near = F.abs(F.col("_metadata.file_size") / TARGET_BYTES - 1) <= 0.25
    return lines.groupBy("mode").agg(F.count(F.lit(1)).alias("rows"), F.every(near).alias("sized"))


@query
def sink_report(spark, folder):
    """Summary (one CSV file) and failing rows (a folder for each check) stored and read back; one check passes."""
    root = new_folder(spark, "report")
    books = flow.silver_books(raw_books(spark, folder))
    suite = replace(rules.BOOKS_VALIDITY, checks=(*rules.BOOKS_VALIDITY.checks, PRICED))
    write_summary(checks.summarize(books, suite), f"{root}/summary")
    write_failed_rows(checks.failed_rows(books, suite).drop("title_hash"), f"{root}/failed", "parquet")
    summary = read_table(spark, f"{root}/summary", "csv")
    typed = {c.name: F.col(c.name).cast(c.dataType) for c in checks.summarize(books, suite).schema}
    stored = read_table(spark, f"{root}/failed").groupBy("check_name").agg(F.count(F.lit(1)).alias("stored_rows"))
    return summary.withColumns(typed).join(stored, "check_name", "left").fillna({"stored_rows": 0})


@query
def sink_snapshot(spark, folder):
    """The first rows of a named table that was stored as CSV, by the snapshot job."""
    path = new_folder(spark, "snapshot")
    write_table(table(spark, folder, "supplier"), path, "csv")
    config = {"dataset_name": "supplier", "asset_name": "all", "input_format": "csv", "sample_rows": 25, "order_by": ["s_name"]}
    return JOBS["snapshot"](spark, config, Assets({"supplier": {"all": path}})).sample


# --- silver -----------------------------------------------------------------------------------


@query
def standardize_books(spark, folder):
    spec = replace(rules.BOOKS_SILVER, passthrough_columns=("book_no", "title", "not_there"))
    return standardize(raw_books(spark, folder), spec)


@query
def standardize_reviews(spark, folder):
    """Every review with the whole text of its document, if there is one."""
    return standardize(raw_reviews(spark, folder, every_text=True), rules.REVIEWS_SILVER)


@query
def standardize_append(spark, folder):
    """Append mode: a later rule reads an earlier target, and helper columns are dropped."""
    spec = StandardizeSpec.from_dict(
        {
            "output_mode": "append",
            "drop_columns_after_transform": ["image_url", "preview_link", "info_link", "description", "absent"],
            "column_rules": [
                {"source": "title", "target": "title", "trim": True, "blank_to_null": True, "lower": True},
                {
                    "source": "published_date_raw",
                    "target": "published_date",
                    "trim": True,
                    "parse_mode": "multi_format_date",
                },
                {"source": "published_date", "target": "published_year", "parse_mode": "year_from_date"},
                {"source": "ratings_count_raw", "target": "ratings_count", "target_type": "double"},
            ],
        }
    )
    return standardize(raw_books(spark, folder), spec)


@query
def fill_defaults_(spark, folder):
    books = standardize(raw_books(spark, folder), rules.BOOKS_SILVER)
    return fill_defaults(books, rules.BOOKS_DEFAULTS)


@query
def fill_defaults_raw(spark, folder):
    """Defaults on raw columns: blanks are filled too, other edges stay."""
    reviews = raw_reviews(spark, folder)
    return fill_defaults(reviews, rules.REVIEWS_DEFAULTS)


@query
def enrich_books(spark, folder):
    return flow.silver_books(raw_books(spark, folder)).drop("title_hash")


@query
def enrich_reviews(spark, folder):
    return flow.silver_reviews(raw_reviews(spark, folder)).drop("title_hash")


@query
def hash_key(spark, folder):
    """Per key: is the hash null, and how many hashes does it have. Hash values are tested elsewhere."""
    spec = EnrichSpec.from_dict(
        {
            "hash_rules": [{"source": "title_key", "target": "title_hash", "method": "xxhash64"}],
            "flag_rules": [{"source": "title_hash", "target": "has_hash", "rule": "is_not_null"}],
        }
    )
    books = standardize(raw_books(spark, folder), rules.BOOKS_SILVER)
    return (
        enrich(books, spec)
        .groupBy("title_key", "has_hash")
        .agg(F.count_distinct("title_hash").alias("hashes"), F.count(F.lit(1)).alias("books"))
    )


@query
def surrogate_key(spark, folder):
    """Repeated values share a number; the numbered column moves to the front."""
    spec = SurrogateKey("p_name", "name_key", start_at=100, require_unique_source=False)
    return assign_keys(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), spec)


@query
def surrogate_key_unique(spark, folder):
    """Unique values with nulls, through the standardize rules; the source column goes."""
    spec = StandardizeSpec.from_dict(
        {
            "output_mode": "select_targets_only",
            "passthrough_columns": ["book_no"],
            "column_rules": [
                {"source": "image_url", "target": "image_url", "trim": True},
                {"source": "preview_link", "target": "preview_link", "trim": True, "blank_to_null": True},
            ],
            "surrogate_key": {
                "source": "preview_link",
                "target": "link_key",
                "method": "row_number_sorted",
                "drop_source_after_create": True,
            },
        }
    )
    return standardize(raw_books(spark, folder), spec)


@query
def surrogate_key_batches(spark, folder):
    """Orders numbered in two batches, those with returned lines first: all keep the number they were given."""
    spec = SurrogateKey("l_orderkey", "order_no", start_at=1, require_unique_source=False)
    store = Versions(spark, new_folder(spark, "order_numbers"))
    lines = table(spark, folder, "lineitem")
    extend_keys(lines.where("l_returnflag = 'R'"), spec, store)
    return assign_stable_keys(lines, spec, store)


@query
def quarantine_eligible(spark, folder):
    books = flow.silver_books(raw_books(spark, folder))
    return eligible(books, rules.BOOKS_QUARANTINE).drop("title_hash")


@query
def quarantine_rejects(spark, folder):
    """Three required columns, so that each reason occurs."""
    spec = replace(rules.BOOKS_QUARANTINE, required=("title", "title_key", "published_date"))
    books = flow.silver_books(raw_books(spark, folder))
    return rejects(books, spec).drop("title_hash")


# --- checks -----------------------------------------------------------------------------------


def _both(spark, folder):
    return flow.silver_books(raw_books(spark, folder)), flow.silver_reviews(raw_reviews(spark, folder))


def _summaries(spark, folder, books_suite, reviews_suite):
    books, reviews = _both(spark, folder)
    return checks.summarize(books, books_suite).unionAll(checks.summarize(reviews, reviews_suite))


@query
def dq_summary_completeness(spark, folder):
    return _summaries(spark, folder, rules.BOOKS_COMPLETENESS, rules.REVIEWS_COMPLETENESS)


@query
def dq_summary_validity(spark, folder):
    return _summaries(spark, folder, rules.BOOKS_VALIDITY, rules.REVIEWS_VALIDITY)


@query
def dq_summary_consistency(spark, folder):
    """The hash rule, and one that fails: a scored review without a price."""
    price = checks.Check(
        name="price_required_when_scored",
        type="requires_when_present",
        severity="critical",
        required_column="price",
        when_present_column="review_score",
    )
    suite = replace(rules.REVIEWS_CONSISTENCY, checks=(*rules.REVIEWS_CONSISTENCY.checks, price))
    return _summaries(spark, folder, rules.BOOKS_CONSISTENCY, suite)


LINE_KEY = checks.CheckSuite.from_dict(
    {
        "dataset_name": "lineitem",
        "quality_dimension": "uniqueness",
        "checks": [
            {
                "name": "order_line_unique",
                "type": "duplicate_key",
                "key_columns": ["l_orderkey", "l_linenumber"],
                "severity": "critical",
            },
            {
                "name": "quantity_non_negative",
                "type": "non_negative",
                "column": "l_quantity",
                "severity": "warning",
                "quality_dimension": "validity",
            },
        ],
    }
)


@query
def dq_summary_uniqueness(spark, folder):
    """Repeated titles, ids and composite keys; one check names a dimension of its own."""
    both = _summaries(spark, folder, rules.BOOKS_UNIQUENESS, rules.REVIEWS_UNIQUENESS)
    return both.unionAll(checks.summarize(table(spark, folder, "lineitem"), LINE_KEY))


def _mixed_suite():
    return replace(rules.BOOKS_CHECKS, checks=rules.BOOKS_CHECKS.checks + rules.BOOKS_COMPLETENESS.checks)


@query
def dq_failed_rows(spark, folder):
    """Every failing book of every kind of check; a book may fail several."""
    books = flow.silver_books(raw_books(spark, folder))
    return checks.failed_rows(books, _mixed_suite()).drop("title_hash")


SAMPLE_ORDER = ("review_no", "review_line", "id", "review_score", "price", "review_date", "user_id")


def _numbered_reviews(spark, folder):
    """Enriched reviews that keep the numbers of their source line."""
    spec = replace(rules.REVIEWS_SILVER, passthrough_columns=("review_no", "review_line", "id"))
    reviews = standardize(raw_reviews(spark, folder), spec).transform(fill_defaults, rules.REVIEWS_DEFAULTS)
    return enrich(reviews, rules.REVIEWS_QUALITY)


@query
def dq_failed_sample(spark, folder):
    """The first 25 failing reviews per check."""
    suite = replace(
        rules.REVIEWS_VALIDITY, checks=tuple(replace(c, sample_limit=25) for c in rules.REVIEWS_VALIDITY.checks)
    )
    return checks.failed_samples(_numbered_reviews(spark, folder), suite, SAMPLE_ORDER).drop("title_hash")


@query
def dq_failed_duplicate_key(spark, folder):
    return checks.rows_with_repeated_key(table(spark, folder, "lineitem"), LINE_KEY.key_checks[0])


@query
def dq_gate_rollup(spark, folder):
    return checks.roll_up(_summaries(spark, folder, rules.BOOKS_CHECKS, rules.REVIEWS_CHECKS))


@query
def relationship_summary(spark, folder):
    """Reviews against eligible books on the hash, and line items against parts, which is complete."""
    books, reviews = _both(spark, folder)
    lines = relationship.RelationshipSpec(
        check_name="line_part_must_exist",
        left_dataset_name="lineitem",
        left_key="l_partkey",
        right_dataset_name="part",
        right_key="p_partkey",
        severity="warning",
    )
    titles = relationship.coverage(reviews, eligible(books, rules.BOOKS_QUARANTINE), rules.TITLE_RELATIONSHIP)
    return titles.unionAll(
        relationship.coverage(table(spark, folder, "lineitem"), table(spark, folder, "part"), lines)
    )


@query
def relationship_missing_keys(spark, folder):
    books, reviews = _both(spark, folder)
    spec = replace(rules.TITLE_RELATIONSHIP, left_key="title_key", right_key="title_key")
    return relationship.missing_keys(reviews, eligible(books, rules.BOOKS_QUARANTINE), spec)


@query
def relationship_sample(spark, folder):
    books, reviews = _both(spark, folder)
    spec = replace(rules.TITLE_RELATIONSHIP, left_key="title_key", right_key="title_key", sample_limit=20)
    return relationship.missing_key_sample(reviews, eligible(books, rules.BOOKS_QUARANTINE), spec)


@query
def table_profile_(spark, folder):
    books = flow.silver_books(raw_books(spark, folder))
    reviews = flow.silver_reviews(raw_reviews(spark, folder))
    return table_profile(books.drop("title_hash")).unionAll(table_profile(reviews.drop("title_hash")))


@query
def table_head(spark, folder):
    """The first rows by order number."""
    return first_rows(table(spark, folder, "orders"), 20, ["o_orderkey"])


# --- serving ----------------------------------------------------------------------------------


@query
def serve_books_analytics(spark, folder):
    books = flow.silver_books(raw_books(spark, folder))
    good = eligible(books, rules.BOOKS_QUARANTINE)
    return serve({"books": good}, rules.BOOKS_ANALYTICS).drop("title_hash")


@query
def serve_reviews_analytics(spark, folder):
    reviews = flow.silver_reviews(raw_reviews(spark, folder))
    return serve({"reviews": reviews}, rules.REVIEWS_ANALYTICS).drop("title_hash")


@query
def serve_reviews_science(spark, folder):
    reviews = flow.silver_reviews(raw_reviews(spark, folder))
    return serve({"reviews": reviews}, rules.REVIEWS_SCIENCE).drop("title_hash")


def _labelled(spark, folder, condition):
    spec = ServingSpec.from_dict(
        {
            "serving": {
                "base_input": "documents",
                "joins": [{"right_input": "labels", "left_on": ["doc_id"], "right_on": ["doc_id"]}],
                "filters": [
                    {"column": "quality", "condition": condition},
                    {"column": "lang", "condition": "is_not_null"},
                ],
                "select_columns": ["doc_id", "text", "lang", "quality", "toxic"],
            }
        }
    )
    return serve({name: table(spark, folder, name) for name in ("documents", "labels")}, spec)


@query
def serve_filter_not_null(spark, folder):
    return _labelled(spark, folder, "is_not_null")


@query
def serve_filter_null(spark, folder):
    return _labelled(spark, folder, "is_null")


def _title_join(how, *selected):
    """A query that joins reviews to books on the title key; both sides have null and lone keys."""

    def build(spark, folder):
        books, reviews = _both(spark, folder)
        spec = ServingSpec.from_dict(
            {
                "base_input": "reviews",
                "joins": [
                    {
                        "right_input": "books",
                        "right_select_columns": ["title_key", "publisher", "published_date"],
                        "left_on": ["title_key"],
                        "right_on": ["title_key"],
                        "how": how,
                    }
                ],
                "select_columns": ["title_key", "review_score", "review_date", *selected],
            }
        )
        return serve({"books": books, "reviews": reviews}, spec)

    build.__name__ = f"serve_join_{how.removeprefix('left_')}"
    return query(build)


for _how in ("inner", "left", "right", "full"):
    _title_join(_how, "publisher", "published_date")
for _how in ("left_semi", "left_anti"):
    _title_join(_how)


@query
def serve_join_diff_keys(spark, folder):
    """Other key names and a right join: right-only rows come without a key."""
    spec = ServingSpec.from_dict(
        {
            "base_input": "reviews",
            "joins": [
                {
                    "right_input": "books",
                    "right_select_columns": ["book_key", "categories", "authors"],
                    "left_on": ["title_key"],
                    "right_on": ["book_key"],
                    "how": "right",
                }
            ],
            "select_columns": ["title_key", "price", "categories", "authors"],
        }
    )
    books, reviews = _both(spark, folder)
    return serve({"books": books.withColumnRenamed("title_key", "book_key"), "reviews": reviews}, spec)


@query
def serve_join_chain(spark, folder):
    """Line items with order, customer, nation and region."""

    def to(right, left_key, right_key, *columns):
        return {
            "right_input": right,
            "right_select_columns": [right_key, *columns],
            "left_on": [left_key],
            "right_on": [right_key],
            "how": "left",
            "right_unique": True,
        }

    spec = ServingSpec.from_dict(
        {
            "base_input": "lineitem",
            "joins": [
                to("orders", "l_orderkey", "o_orderkey", "o_custkey", "o_orderstatus"),
                to("customer", "o_custkey", "c_custkey", "c_name", "c_nationkey"),
                to("nation", "c_nationkey", "n_nationkey", "n_name", "n_regionkey"),
                to("region", "n_regionkey", "r_regionkey", "r_name"),
            ],
            "select_columns": ["l_orderkey", "l_linenumber", "o_orderstatus", "c_name", "n_name", "r_name"],
        }
    )
    names = ("lineitem", "orders", "customer", "nation", "region")
    return serve({name: table(spark, folder, name) for name in names}, spec)


@query
def serve_dedupe(spark, folder):
    """One line per order and line number: the one shipped first."""
    spec = ServingSpec.from_dict(
        {
            "base_input": "lineitem",
            "select_columns": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity"],
            "deduplicate_on": ["l_orderkey", "l_linenumber"],
            "deduplicate_order": ["l_shipdate"],
        }
    )
    return serve({"lineitem": table(spark, folder, "lineitem")}, spec)


@query
def serve_dedupe_text(spark, folder):
    """One document per text: the one with the lowest number."""
    spec = ServingSpec.from_dict(
        {
            "base_input": "documents",
            "select_columns": ["doc_id", "text", "lang", "source"],
            "deduplicate_on": ["text"],
        }
    )
    return serve({"documents": table(spark, folder, "documents")}, spec)


# --- streams ----------------------------------------------------------------------------------


# Row groups of arriving files. A task reads whole row groups, so a batch of few files with one each keeps few cores busy.
# The size is that of compressed pages.
ARRIVING_ROW_GROUP = 2 << 20


def _in_drops(spark, folder, label, df, parts, build):
    """``df`` arrives in files dropped three times, each taken by a run of its own with one checkpoint; what was written."""
    root = new_folder(spark, label)
    for part in parts:
        write_table(df.filter(part), f"{root}/arriving", mode="append", compression="zstd", parquet_block_size=ARRIVING_ROW_GROUP)
        free_shuffles(spark)
        arrive(spark, f"{root}/arriving", df.schema, build, f"{root}/table", f"{root}/checkpoint", files_at_once=2)
    return read_table(spark, f"{root}/table")


@query
def stream_silver_reviews(spark, folder):
    """Raw reviews in three drops, standardized, filled and enriched as they come."""
    parts = ("review_line < 3", "review_line IN (3, 4)", "review_line > 4")
    return _in_drops(spark, folder, "stream_reviews", raw_reviews(spark, folder), parts, flow.silver_reviews).drop("title_hash")


@query
def stream_quarantine(spark, folder):
    """Raw books in three drops: those held back, with their reasons."""

    spec = replace(rules.BOOKS_QUARANTINE, required=("title", "title_key", "published_date"))

    def held_back(raw):
        return rejects(flow.silver_books(raw), spec)

    parts = ("ratings_count_raw IS NULL", "ratings_count_raw = 'n/a'", "ratings_count_raw <> 'n/a'")
    return _in_drops(spark, folder, "stream_books", raw_books(spark, folder), parts, held_back).drop("title_hash")


@query
def stream_duplicate_key(spark, folder):
    """Parts in three drops: those whose name came before or comes again."""
    name = replace(LINE_KEY.key_checks[0], key_columns=("p_name",))
    parts = ("p_size < 15", "p_size BETWEEN 15 AND 30", "p_size > 30")
    return _in_drops(spark, folder, "stream_keys", table(spark, folder, "part"), parts, lambda stream: repeated_key_rows(stream, name))


# --- reports ----------------------------------------------------------------------------------


def _gold(spark, folder):
    return flow.lazy_flow(raw_books(spark, folder), raw_reviews(spark, folder))


@query
def view_book_performance(spark, folder):
    return _gold(spark, folder).book_performance().drop("title_hash")


@query
def view_category_summary(spark, folder):
    return _gold(spark, folder).category_summary()


@query
def view_review_daily(spark, folder):
    return _gold(spark, folder).review_daily()


def _in_batches(spark, folder):
    """Gold tables, and the state after three batches: old reviews, the others, and a correction of all scores of 1 to 2.

    The second arrives twice, and parts are added up before the third.
    """
    gold = _gold(spark, folder)
    state = ReviewState(Versions(spark, new_folder(spark, "review_state")))
    reviews = gold.reviews
    old = F.coalesce(F.year("review_date") < 2004, F.lit(False))
    state.add("old", reviews.filter(old))
    for _ in range(2):
        state.add("recent", reviews.filter(~old))
    state.compact()
    wrong = reviews.filter("review_score = 1")
    state.add("correction", wrong.withColumn("review_score", F.lit(2).cast(reviews.schema["review_score"].dataType)), wrong)
    return gold, state


@query
def view_book_performance_batches(spark, folder):
    gold, state = _in_batches(spark, folder)
    return state.book_performance(gold.books).drop("title_hash")


@query
def view_category_summary_batches(spark, folder):
    gold, state = _in_batches(spark, folder)
    return state.category_summary(gold.books)


@query
def view_review_daily_batches(spark, folder):
    return _in_batches(spark, folder)[1].review_daily()


def _raw_files(spark, folder, root):
    """Books and reviews as raw CSV files, compressed: each is read whole by one task."""
    assets = flow.assets_under(root)
    for dataset, contract, raw in (
        (rules.BOOKS, rules.BOOKS_CONTRACT, raw_books(spark, folder)),
        (rules.REVIEWS, rules.REVIEWS_CONTRACT, raw_reviews(spark, folder)),
    ):
        named = raw.select(*[F.col(target).alias(source) for source, target in contract.columns])
        assets.write(named, dataset, "raw_csv", fmt="csv", escape=CSV_DEFAULTS["escape"], compression="gzip")
    return assets


@query
def medallion_end_to_end(spark, folder):
    """Raw CSV through every layer on files, checks reported, then the performance report."""
    root = new_folder(spark, "flow")
    assets = _raw_files(spark, folder, root)
    flow.run_flow(spark, assets, f"{root}/reports", gate=False)
    return flow.stored_gold(spark, assets).book_performance().drop("title_hash")


class _Stopped(Exception):
    """A run that ended between two layers."""


@query
def medallion_resumed(spark, folder):
    """The flow stopped after its clean books, and run again: the report, how many layers were kept, and how many built."""
    root = new_folder(spark, "layers")
    assets = _raw_files(spark, folder, root)

    def stop(name):
        if name == f"{rules.BOOKS}/silver_quality_enriched":
            raise _Stopped

    try:
        flow.resume_flow(spark, assets, f"{root}/layers", gate=False, done=stop)
    except _Stopped:
        pass
    run = flow.resume_flow(spark, assets, f"{root}/layers", gate=False)
    report = flow.released_gold(spark, f"{root}/layers").book_performance().drop("title_hash")
    return report.withColumns({"layers_kept": F.lit(len(run.kept)), "layers_built": F.lit(len(run.built))})
