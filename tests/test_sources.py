"""CSV contract, tables, writers and the flow on files."""

from types import SimpleNamespace

import pytest
from conftest import tables_dir

from stackroom.operators.checks import QualityGateError
from stackroom.plans import bookstore, flow
from stackroom.plans.fixtures import raw_books, raw_reviews
from stackroom.sources import workspace
from stackroom.sources.raw_csv import CsvContract, read_raw_csv
from stackroom.sources.tables import Assets, read_table, write_failed_rows, write_summary, write_table

CONTRACT = CsvContract.from_dict(
    {
        "source_type": "csv",
        "output_type": "parquet",
        "csv_options": {"header": True, "all_varchar": True, "multiLine": True},
        "columns": [{"source": "review/text", "target": "text"}, {"source": "Id", "target": "id"}],
    }
)


def csv_file(tmp_path, content):
    path = tmp_path / "in.csv"
    path.write_text(content, encoding="utf-8", newline="")
    return str(path)


def test_csv_columns_are_text_and_picked_by_name(spark, tmp_path):
    path = csv_file(tmp_path, 'Extra,Id,review/text\n9, 007 ,"two\nlines, ""quoted"""\n8,2.50,\n')
    df = read_raw_csv(spark, path, CONTRACT)
    assert df.dtypes == [("text", "string"), ("id", "string")]
    assert df.collect() == [('two\nlines, "quoted"', "007"), (None, "2.50")]


def test_csv_options(spark, tmp_path):
    contract = CsvContract((("a", "a"), ("b", "b")), {"delimiter": ";", "ignoreLeadingWhiteSpace": False})
    path = csv_file(tmp_path, "a;b\n x ;1,5\n")
    assert read_raw_csv(spark, path, contract).collect() == [(" x", "1,5")]


def test_missing_source_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="review/text"):
        read_raw_csv(spark, csv_file(tmp_path, "Id\n1\n"), CONTRACT)


@pytest.mark.parametrize(
    "config",
    [
        {"columns": []},
        {"columns": [{"source": "a", "target": "x"}, {"source": "a", "target": "y"}]},
        {"columns": [{"source": "a", "target": "x"}, {"source": "b", "target": "x"}]},
        {"columns": [{"source": "a", "target": "x"}], "source_type": "json"},
        {"columns": [{"source": "a", "target": "x"}], "output_type": "csv"},
    ],
)
def test_bad_contracts(config):
    with pytest.raises(ValueError):
        CsvContract.from_dict(config)


def test_tables_by_name_or_path(spark, tmp_path):
    assets = Assets({"d": {"a": str(tmp_path / "a")}})
    df = spark.range(10)
    assert assets.write(df, "d", "a") == 10
    assert assets.read(spark, "d", "a").count() == 10
    other = str(tmp_path / "b")
    assert assets.write(df.limit(3), "d", "a", path=other, fmt="csv") == 3
    assert assets.read(spark, "d", "a", "csv", path=other).dtypes == [("id", "string")]
    for names in (("x", "a"), ("d", "x")):
        with pytest.raises(KeyError):
            assets.read(spark, *names)
    with pytest.raises(ValueError):
        read_table(spark, other, "json")


def test_write_modes_formats_and_layout(spark, tmp_path):
    df = spark.range(0, 100, 1, 7)
    path = str(tmp_path / "t")
    write_table(df, path, partitions=3, compression="gzip", parquet_block_size=1 << 20, parquet_page_size=1 << 16)
    files = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]
    assert len(files) == 3 and all(".gz." in f for f in files)
    write_table(df, path, mode="append")
    assert spark.read.parquet(path).count() == 200
    write_table(df, path, max_records_per_file=10)
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("part-")]) >= 10
    for fmt in ("json", "orc"):
        assert write_table(df, str(tmp_path / fmt), fmt) == 100
        assert spark.read.format(fmt).load(str(tmp_path / fmt)).count() == 100
    assert write_table(df.limit(0), str(tmp_path / "none")) == 0


def test_small_results(spark, tmp_path):
    summary = spark.range(0, 4, 1, 4)
    assert write_summary(summary, str(tmp_path / "s")) == 4
    assert len([p for p in (tmp_path / "s").iterdir() if p.name.startswith("part-")]) == 1
    failed = spark.createDataFrame([("a", 1), ("b", 2)], "check_name string, n int")
    write_failed_rows(failed, str(tmp_path / "f"), "parquet")
    write_failed_rows(failed.filter("check_name = 'a'"), str(tmp_path / "f"), "parquet")
    assert spark.read.parquet(str(tmp_path / "f")).collect() == [(1, "a")], "rows of a check that passes now must go"
    for write in (write_summary, write_failed_rows):
        with pytest.raises(ValueError):
            write(failed, str(tmp_path / "x"), "orc")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_failed_rows_without_any_can_be_read(spark, tmp_path, fmt):
    none = spark.createDataFrame([], "check_name string, n int")
    assert write_failed_rows(none, str(tmp_path / "f"), fmt) == 0
    again = read_table(spark, str(tmp_path / "f"), fmt)
    assert again.count() == 0 and sorted(again.columns) == ["check_name", "n"]


def test_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    named = SimpleNamespace(conf={workspace.SHARED_FOLDER: "s3://shared"}, sparkContext=Context())
    monkeypatch.setattr(workspace.atexit, "register", lambda *_: None)
    assert workspace.new_folder(named, "x").startswith("s3://shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(SimpleNamespace(conf={}, sparkContext=Context()))
    assert workspace.shared_folder(spark) == workspace.shared_folder(spark)


@pytest.fixture(scope="module")
def raw_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("flow"))
    assets = flow.assets_under(root)
    folder = tables_dir()
    for dataset, contract, raw in (
        (bookstore.BOOKS, bookstore.BOOKS_CONTRACT, raw_books(spark, folder)),
        (bookstore.REVIEWS, bookstore.REVIEWS_CONTRACT, raw_reviews(spark, folder)),
    ):
        named = raw.selectExpr(*[f"`{t}` AS `{s}`" for s, t in contract.columns])
        assets.write(named, dataset, "raw_csv", fmt="csv", escape='"')
    return root


@pytest.mark.parametrize("every_layer", [True, False])
def test_flow_on_files_equals_the_lazy_flow(spark, raw_root, every_layer):
    assets = flow.assets_under(raw_root)
    written = flow.run_flow(spark, assets, f"{raw_root}/reports", gate=False, every_layer=every_layer)
    books = written["books_data/silver_quality_enriched"]
    assert books == written["books_data/silver_eligible"] + written["books_data/silver_quarantine"]
    assert ("books_data/silver_standardized" in written) == every_layer

    folder = tables_dir()
    lazy = flow.lazy_flow(raw_books(spark, folder), raw_reviews(spark, folder))
    stored = flow.stored_gold(spark, assets)
    for report in ("book_performance", "category_summary", "review_daily"):
        a, b = getattr(lazy, report)(), getattr(stored, report)()
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert stored.reviews_science.columns[-1] == "title_hash"


def test_gate_stops_the_flow_after_storing_reports(spark, raw_root):
    reports = f"{raw_root}/gated"
    with pytest.raises(QualityGateError, match="review_score_in_allowed_set"):
        flow.run_flow(spark, flow.assets_under(raw_root), reports, every_layer=False)
    summary = spark.read.parquet(f"{reports}/books_rating/summary")
    assert summary.filter("severity = 'critical' AND status = 'failed'").count() == 3
    assert spark.read.parquet(f"{reports}/books_rating/failed_rows").count() > 0
