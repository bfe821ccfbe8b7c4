"""Layered runs: resume after a stop, rebuild what has changed, and show readers one run at a time."""

import random
from dataclasses import replace

import pytest
from conftest import tables_dir
from pyspark.sql import functions as F

from stackroom.operators.checks import QualityGateError
from stackroom.plans import bookstore as rules
from stackroom.plans import flow, layers
from stackroom.plans.fixtures import raw_books, raw_reviews
from stackroom.plans.layers import Layer, Release, Source, run_layers
from stackroom.sources.tables import LAYER_SETTINGS, Assets
from stackroom.sources.versions import Versions


class Stopped(Exception):
    pass


@pytest.fixture
def numbers(spark, tmp_path):
    """Two sources and three layers: a from x, b from y, c from both."""
    root = str(tmp_path / "layers")
    for name, n in (("x", 3), ("y", 4)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / name))
    sources = {name: Source(str(tmp_path / name), lambda name=name: spark.read.parquet(str(tmp_path / name))) for name in "xy"}
    built = []

    def noted(name, build):
        return lambda *inputs: built.append(name) or build(*inputs)

    plan = [
        Layer("a", ("x",), noted("a", lambda x: x.selectExpr("id * 10 AS id"))),
        Layer("b", ("y",), noted("b", lambda y: y.selectExpr("id * 100 AS id"))),
        Layer("c", ("a", "b"), noted("c", lambda a, b: a.unionAll(b))),
    ]
    return root, sources, plan, built, tmp_path


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_second_run_builds_nothing(spark, numbers):
    root, sources, plan, built, _ = numbers
    first = run_layers(spark, root, sources, plan)
    assert first.built == ["a", "b", "c"] == built and first.release == 1
    second = run_layers(spark, root, sources, plan)
    assert second.kept == ["a", "b", "c"] and built == ["a", "b", "c"] and second.release == 1
    assert ids(Release(spark, root).read("c")) == [0, 0, 10, 20, 100, 200, 300]


@pytest.mark.parametrize("after", ["a", "b", "c"])
def test_a_stopped_run_goes_on(spark, numbers, after):
    root, sources, plan, built, _ = numbers

    def stop(name):
        if name == after:
            raise Stopped

    with pytest.raises(Stopped):
        run_layers(spark, root, sources, plan, done=stop)
    assert not Release(spark, root).tables, "nothing is seen of a run that stopped"
    rest = run_layers(spark, root, sources, plan)
    assert built == ["a", "b", "c"] and rest.kept == ["a", "b", "c"][: "abc".index(after) + 1]
    assert len(ids(Release(spark, root).read("c"))) == 7


def test_a_stop_while_a_layer_is_built(spark, numbers):
    root, sources, plan, built, _ = numbers
    fails = [plan[0], replace(plan[1], build=lambda y: y.select(F.raise_error(F.lit("lost")).cast("long").alias("id"))), plan[2]]
    with pytest.raises(Exception, match="lost"):
        run_layers(spark, root, sources, fails)
    assert run_layers(spark, root, sources, plan).kept == ["a"]


def test_only_what_hangs_on_a_change_is_built(spark, numbers):
    root, sources, plan, built, path = numbers
    run_layers(spark, root, sources, plan)
    spark.range(1).write.mode("append").parquet(str(path / "y"))
    run = run_layers(spark, root, sources, plan)
    assert (run.kept, run.built, run.release) == (["a"], ["b", "c"], 2)
    changed = [replace(plan[0], rules=("other",)), *plan[1:]]
    assert run_layers(spark, root, sources, changed).built == ["a", "c"]
    assert run_layers(spark, root, sources, plan).built == ["a", "c"], "and back again"


def test_readers_see_one_run(spark, numbers):
    root, sources, plan, _, path = numbers
    run_layers(spark, root, sources, plan)
    reader = Release(spark, root)
    seen = {}

    def look(name):
        seen[name] = [ids(Release(spark, root).read(n)) for n in "abc"]

    before = [ids(reader.read(n)) for n in "abc"]
    spark.range(50, 51).write.mode("append").parquet(str(path / "x"))
    run_layers(spark, root, sources, plan, done=look)
    assert all(x == before for x in seen.values()), "while layers are built"
    assert [ids(reader.read(n)) for n in "abc"] == before, "and for who came before"
    assert 500 in ids(Release(spark, root).read("c"))
    with pytest.raises(KeyError):
        reader.read("z")


def test_a_failed_check_keeps_the_release(spark, numbers):
    root, sources, plan, built, path = numbers
    run_layers(spark, root, sources, plan)
    spark.range(1).write.mode("append").parquet(str(path / "x"))

    def refuse(tables):
        assert tables["c"].count() == 8
        raise ValueError("no good")

    with pytest.raises(ValueError, match="no good"):
        run_layers(spark, root, sources, plan, check=refuse)
    assert Release(spark, root).read("c").count() == 7
    run = run_layers(spark, root, sources, plan)
    assert run.kept == ["a", "b", "c"] and run.release == 2 and Release(spark, root).read("c").count() == 8


def test_plans_that_make_no_sense(spark, numbers):
    root, sources, plan, _, _ = numbers
    for wrong in ([plan[2]], [plan[0], plan[0]], [replace(plan[0], name="x")]):
        with pytest.raises(ValueError, match="layer"):
            run_layers(spark, root, sources, wrong)


def test_book_flow(spark, tmp_path, monkeypatch):
    """Stopped after the first clean table; other reviews; a gate that fails; the same report as the flow in one plan."""
    folder, root = tables_dir(), str(tmp_path / "layers")
    assets = flow.assets_under(str(tmp_path))
    books, reviews = raw_books(spark, folder), raw_reviews(spark, folder)
    for dataset, raw in ((rules.BOOKS, books), (rules.REVIEWS, reviews.filter("review_line < 3"))):
        named = raw.selectExpr(*[f"`{t}` AS `{s}`" for s, t in flow.CONTRACTS[dataset].columns])
        assets.write(named, dataset, "raw_csv", fmt="csv", escape='"')
    assert len(flow.resume_flow(spark, assets, root, gate=False).built) == 9
    named = reviews.selectExpr(*[f"`{t}` AS `{s}`" for s, t in flow.CONTRACTS[rules.REVIEWS].columns])
    assets.write(named, rules.REVIEWS, "raw_csv", fmt="csv", escape='"')
    with pytest.raises(QualityGateError):
        flow.resume_flow(spark, assets, root)
    one_plan = flow.lazy_flow(books, reviews.filter("review_line < 3")).review_daily()
    kept = flow.released_gold(spark, root).review_daily()
    assert kept.exceptAll(one_plan).count() == one_plan.exceptAll(kept).count() == 0, "the release before"
    run = flow.resume_flow(spark, assets, root, gate=False)
    assert not run.built and run.release == 2
    one_plan, now = flow.lazy_flow(books, reviews).review_daily(), flow.released_gold(spark, root).review_daily()
    assert now.exceptAll(one_plan).count() == one_plan.exceptAll(now).count() == 0
    stricter = replace(rules.BOOKS_QUARANTINE, required=("title",))
    monkeypatch.setattr(rules, "BOOKS_QUARANTINE", stricter)
    changed = flow.resume_flow(spark, assets, root, gate=False).built
    assert {n.split("/")[1] for n in changed} == {"silver_eligible", "silver_quarantine", "gold_books_serving_da"}
    assert layers.RELEASE not in Release(spark, root).tables


def test_raw_files_and_layers_are_compressed(spark, tmp_path):
    from pathlib import Path

    from stackroom.plans import bookstore, flow, queries
    from stackroom.sources.raw_csv import _wants_ranges, read_raw_csv
    from stackroom.sources.versions import Versions

    assets = queries._raw_files(spark, "/root/testdata/sf0.001", str(tmp_path / "flow"))
    raw = assets.path(bookstore.REVIEWS, "raw_csv")
    assert all(f.name.endswith(".csv.gz") for f in Path(raw).glob("part-*"))
    options = bookstore.REVIEWS_CONTRACT.reader_options()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert not _wants_ranges(spark, raw, options), "a compressed file has one range"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = read_raw_csv(spark, raw, bookstore.REVIEWS_CONTRACT).count()
    written = flow.run_flow(spark, assets, str(tmp_path / "reports"), gate=False)
    assert written[f"{bookstore.REVIEWS}/bronze_full"] == rows > 0
    layers = [p for p in (tmp_path / "flow").rglob("*.parquet")]
    Versions(spark, str(tmp_path / "table")).append(spark.range(3))
    layers += (tmp_path / "table").rglob("*.parquet")
    assert all(p.name.endswith(".zstd.parquet") for p in layers)


def test_layers_of_the_flow_are_written_with_the_settings_of_layers(spark, tmp_path):
    class First(Assets):
        def write(self, df, dataset, asset, path=None, **options):
            raise Stopped(options)

    assets = First(flow.assets_under(str(tmp_path)).paths)
    raw = tmp_path / rules.BOOKS / "raw_csv"
    raw.mkdir(parents=True)
    names = [source for source, _ in rules.BOOKS_CONTRACT.columns]
    (raw / "books.csv").write_text(",".join(names) + "\n" + ",".join("x" for _ in names) + "\n")
    with pytest.raises(Stopped) as stop:
        flow.run_flow(spark, assets, str(tmp_path / "reports"))
    assert LAYER_SETTINGS.items() <= stop.value.args[0].items()


def test_a_version_holds_a_repeated_text_once(spark, tmp_path):
    """2 MB of texts, each as 8 kB of hexadecimal digits, four times over, a hundred others between."""
    texts = [(i, random.Random(i // 400 * 100 + i % 100).randbytes(4000).hex()) for i in range(2000)]
    store = Versions(spark, str(tmp_path / "table"))
    store.replace(spark.createDataFrame(texts, "i int, x string").coalesce(1))
    assert sum(f.stat().st_size for f in (tmp_path / "table").rglob("*.parquet")) < 4e6
    assert {tuple(r) for r in store.read().collect()} == set(texts)
