"""Files that keep arriving: the rows of one batch run, whatever the drops, also after a stop and a restart."""

import random
from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stackroom.operators.checks import Check, rows_with_repeated_key
from stackroom.plans import bookstore as rules
from stackroom.plans import flow, queries
from stackroom.streaming.tables import arrive, read_arriving, repeated_key_rows, write_arrived

KEY = Check("u", "duplicate_key", "warning", key_columns=("k", "g"))
ROWS = [(i % 7 if i % 5 else None, "ab"[i % 2], f"row {i}") for i in range(60)] + [(100, "a", "once"), (101, "a", "x"), (101, "a", "x")]
SCHEMA = "k int, g string, x string"


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "checkpoint")}


def drop(spark, place, rows, schema=SCHEMA, files=2):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(place["in"])


def run(spark, place, build, schema, **options):
    return arrive(spark, place["in"], schema, build, place["out"], place["checkpoint"], **options)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("files_at_once", [None, 1])
def test_repeated_keys_over_drops(spark, place, files_at_once):
    whole = spark.createDataFrame(ROWS, SCHEMA)
    for part in (ROWS[:10], ROWS[10:30], ROWS[30:]):
        drop(spark, place, part)
        run(spark, place, lambda s: repeated_key_rows(s, KEY), whole.schema, files_at_once=files_at_once)
    found = spark.read.parquet(place["out"])
    assert found.columns == ["k", "g", "x"]
    assert rows(found) == rows(rows_with_repeated_key(whole, KEY))


def test_key_last_and_rows_in_one_drop(spark, place):
    check = replace(KEY, key_columns=("x",))
    whole = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "a", "q"), (4, None, "p")], SCHEMA)
    drop(spark, place, whole.collect(), files=1)
    run(spark, place, lambda s: repeated_key_rows(s, check), whole.schema)
    assert rows(spark.read.parquet(place["out"])) == rows(rows_with_repeated_key(whole, check))


def test_nothing_new_writes_nothing(spark, place):
    drop(spark, place, ROWS[:10])
    schema = spark.createDataFrame([], SCHEMA).schema
    assert run(spark, place, lambda s: s.filter("k > 1"), schema) == 10
    before = rows(spark.read.parquet(place["out"]))
    assert run(spark, place, lambda s: s.filter("k > 1"), schema) == 0
    assert rows(spark.read.parquet(place["out"])) == before


def test_a_batch_that_failed_is_written_once(spark, place):
    """The run dies in its second batch, after rows of it were written; the next run takes that batch again."""
    drop(spark, place, [(i, "a", str(i)) for i in range(20)], files=1)
    schema = spark.createDataFrame([], SCHEMA).schema
    run(spark, place, lambda s: s, schema)
    drop(spark, place, [(i, "a", str(i)) for i in range(20, 40)], files=4)
    dies = F.when(F.col("k") == 39, F.raise_error(F.lit("executor gone")).cast("int")).otherwise(F.col("k"))
    with pytest.raises(Exception, match="executor gone"):
        run(spark, place, lambda s: s.withColumn("k", dies), schema)
    run(spark, place, lambda s: s, schema)
    assert sorted(r.k for r in spark.read.parquet(place["out"]).collect()) == list(range(40))


RAW_BOOK = "book_no long, " + ", ".join(f"{target} string" for _, target in rules.BOOKS_CONTRACT.columns)


def test_clean_books_in_drops_equal_one_batch(spark, place):
    names = [t for _, t in rules.BOOKS_CONTRACT.columns]
    odd = [None, "  ", " A  title ", "2001-11", "199?", "-3.0", "['Fiction']"]
    data = [(i, *(odd[(i * 3 + j) % len(odd)] for j in range(len(names)))) for i in range(50)]
    whole = spark.createDataFrame(data, RAW_BOOK)
    for part in (data[:5], data[5:6], data[6:]):
        drop(spark, place, part, RAW_BOOK)
        run(spark, place, flow.silver_books, whole.schema, files_at_once=1)
    assert rows(spark.read.parquet(place["out"])) == rows(flow.silver_books(whole))


def test_stream_stays_a_stream(spark, place):
    drop(spark, place, ROWS)
    stream = read_arriving(spark, place["in"], spark.createDataFrame([], SCHEMA).schema)
    assert stream.isStreaming and repeated_key_rows(stream, KEY).isStreaming
    assert write_arrived(stream, place["out"], place["checkpoint"]) == len(ROWS)


def test_cores_share_the_two_files_of_a_batch(spark, tmp_path, monkeypatch):
    """A task reads whole row groups, so files that arrive have several, and every batch keeps to two files."""
    monkeypatch.setattr(queries, "new_folder", lambda spark, label: str(tmp_path / label))
    lines = spark.range(0, 400_000, 1, 4).selectExpr("id", "sha2(cast(id as string), 256) x", "sha2(cast(-id as string), 256) y")
    out = queries._in_drops(spark, None, "drops", lines, ("id % 2 = 0", "id % 2 = 1"), lambda stream: stream)
    assert out.exceptAll(lines).isEmpty() and out.count() == 400_000
    files = list((tmp_path / "drops" / "arriving").glob("*.parquet"))
    assert len(files) == 8 and min(pq.ParquetFile(f).num_row_groups for f in files) > 1
    batches = [n for n in (tmp_path / "drops" / "checkpoint" / "commits").iterdir() if n.name.isdigit()]
    assert len(batches) == 4


def test_a_table_that_arrives_holds_a_repeated_text_once(spark, place):
    """2 MB of texts, each as 8 kB of hexadecimal digits, four times over, a hundred others between."""
    texts = [(i, random.Random(i // 400 * 100 + i % 100).randbytes(4000).hex()) for i in range(2000)]
    schema = "i int, x string"
    spark.createDataFrame(texts, schema).coalesce(1).write.parquet(place["in"])
    run(spark, place, lambda s: s, spark.createDataFrame([], schema).schema)
    files = list(Path(place["out"]).glob("*.parquet"))
    assert sum(f.stat().st_size for f in files) < 4e6 and spark.read.parquet(place["out"]).exceptAll(spark.createDataFrame(texts, schema)).isEmpty()
    assert {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files if pq.ParquetFile(f).num_row_groups} == {"ZSTD"}
