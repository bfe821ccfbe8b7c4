"""What the driver holds for byte pairs."""

import tracemalloc

import public_tokenizers

from stackroom.llm.byte_bpe import BpeSpec, RankMap, word_table


def test_merges_do_not_become_python_objects(spark):
    maps = RankMap(BpeSpec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))
    tracemalloc.start()
    table = maps.merges(spark)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
    assert maps.merges(spark) is table
    row = table.selectExpr("size(merges.maps) AS buckets", "size(merges.pieces) AS pieces").first()
    assert (row.buckets, row.pieces) == (maps.spec.buckets, max(maps.ranks.values()) + 1)


def test_word_table_is_compressed(spark):
    words = spark.range(20_000).selectExpr("concat('word ', id) AS word", "2L AS n_ids", "concat(id, ',', id) AS ids", "concat('word ', id) AS decoded")
    table = word_table(words)
    assert len(table) < words.toArrow().nbytes / 2
