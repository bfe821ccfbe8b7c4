"""Files of a wanted size."""

import pytest
from pyspark.sql import functions as F

from stackroom.sources.sized import file_sizes, write_sized

TARGET = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one value, several of middle size, many small ones, null; helper names taken; unlike widths."""
    kind = "case when id % 3 = 0 then 'hot' when id % 3 = 1 then 'mid ' || id % 4 when id % 50 = 2 then null else 'small ' || id % 40 end"
    text = "case when id % 3 = 0 then sha2(cast(id as string), 512) else md5(cast(id as string)) end"
    return spark.range(60_000).selectExpr("id", f"{kind} kind", f"{text} value_0", "1 first", "2 value").repartition(9).cache()


def test_folders_have_files_near_the_target(spark, skewed, tmp_path):
    path = str(tmp_path / "out")
    assert write_sized(skewed, path, ["kind"], TARGET, sample_rows=3000) == 60_000
    out = spark.read.parquet(path)
    assert sorted(out.columns) == sorted(skewed.columns)
    assert out.select(skewed.columns).exceptAll(skewed).isEmpty()
    by_kind = {}
    for r in file_sizes(out, "kind").collect():
        by_kind.setdefault(r.kind, []).append(r.bytes)
    assert len(by_kind) > 20 and None in by_kind and len(by_kind["hot"]) > 10
    for sizes in by_kind.values():
        near = all(abs(size / TARGET - 1) <= 0.25 for size in sizes)
        assert near or len(sizes) == 1 and sizes[0] < 1.6 * TARGET


def test_packed_files_share_small_values_and_part_large_ones(spark, skewed, tmp_path):
    path = str(tmp_path / "out")
    write_sized(skewed, path, ["kind"], TARGET, folders=False, sample_rows=3000)
    out = spark.read.parquet(path)
    assert out.exceptAll(skewed).isEmpty() and out.count() == 60_000
    files = file_sizes(out).collect()
    assert len(files) > 20 and all(abs(f.bytes / TARGET - 1) <= 0.25 for f in files)
    ranges = out.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.coalesce("kind", F.lit(""))).alias("low"), F.max(F.coalesce("kind", F.lit(""))).alias("high")
    )
    ordered = sorted((r.low, r.high) for r in ranges.collect())
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    assert any(low != high for low, high in ordered) and ordered.count(("hot", "hot")) > 8


def test_small_empty_and_refused(spark, tmp_path):
    one = spark.createDataFrame([(1, float("nan")), (2, -0.0), (3, 0.0), (4, None)], "n int, x double")
    path = str(tmp_path / "one")
    assert write_sized(one, path, ["x"], 10**6, folders=False) == 4
    assert len(file_sizes(spark.read.parquet(path)).collect()) == 1
    assert write_sized(one.limit(0), str(tmp_path / "none"), ["x"], 10**6, folders=False) == 0
    with pytest.raises(ValueError, match="more than 2"):
        write_sized(one, path, ["n"], most_values=2)
    with pytest.raises(ValueError, match="target"):
        write_sized(one, path, ["n"], 0)
