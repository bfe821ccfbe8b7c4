"""Benchmark decontamination: a prefix-filtered join of item-sized windows with documents, in DataFrame functions only.

A window is ``window`` consecutive words of an item, or the whole of a shorter item. A document holds a window if all
its words occur in order side by side. Full containment is asked for, so the necessary prefix of a window in the order
of rarity is its rarest word; the second rarest is a second condition. Rarity counts every word of every document.

1. count how often each word of the benchmark occurs in all documents; a window with a word that never occurs is out;
2. find the rarest word of each window in the documents; its place gives the only place where the window can start,
   which must leave room for the whole window (length and positional bounds), and the second rarest word must stand
   at its distance;
3. compare the words there with the windows exactly, by a join on the words themselves.

Only eight-byte hashes and offsets of benchmark words are broadcast, in blocks of at most about ``block_rows`` rows,
so the size of a broadcast has a bound whatever the size of the benchmark.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, before A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class DecontaminateSpec:
    """``hit_share``: a document is contaminated if this share of its words, or more, is hit (in parts of 100)."""

    window: int = 13
    hit_share: int = 5
    block_rows: int = 500_000


def words_of(text: Column) -> Column:
    """Words in their own letters; the separators leave at most an empty first and last piece."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def token(word: Column) -> Column:
    """Hash of a word in lower letters of all scripts: equal for words that are equal once A-Z are lower-cased."""
    return F.xxhash64(F.lower(word))


def item_windows(items: DataFrame, spec: DecontaminateSpec) -> DataFrame:
    """item_id (as text), key (the window's words, A-Z lower-cased) and words of each distinct window of each item."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - spec.window + 1, F.lit(1)))
    rows = words.select("item_id", "w", F.explode(starts).alias("start"))
    rows = rows.select("item_id", F.slice("w", F.col("start"), F.lit(spec.window)).alias("words"))
    return rows.withColumn("key", ascii_lower(F.array_join("words", " "))).dropDuplicates(["item_id", "key"])


def blocks(df: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """``df`` in parts of about ``rows`` rows or fewer, rows with one key together."""
    parts = -(-df.count() // rows)
    return [df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def document_words(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text (documents that share an id stay apart), and the words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("w"))


def rarest_words(windows: DataFrame, docs: DataFrame, spec: DecontaminateSpec) -> DataFrame:
    """Distinct (h, at, h2, at2, len): the hashes and places of the two rarest words of windows that can occur."""
    placed = windows.dropDuplicates(["key"]).select("key", F.size("words").alias("len"), F.posexplode("words").alias("at", "word"))
    placed = placed.select("key", "len", "at", token(F.col("word")).alias("h"))
    wanted = materialize(placed.select("h").distinct(), "benchmark-words")
    met = docs.select(F.explode(words_of(F.col("text"))).alias("word")).select(token(F.col("word")).alias("h"))
    counted = [met.join(F.broadcast(part), "h").groupBy("h").count() for part in blocks(wanted, "h", spec.block_rows)]
    if not counted:
        return placed.select("h", "at", F.col("h").alias("h2"), F.col("at").alias("at2"), "len").limit(0)
    rarity = placed.join(union(counted), "h", "left")
    ordered = rarity.groupBy("key", "len").agg(F.sort_array(F.collect_list(F.struct("count", "at", "h"))).alias("order"))
    ordered = ordered.where(F.col("order")[0]["count"].isNotNull())
    first, second = F.col("order")[0], F.coalesce(F.get("order", F.lit(1)), F.col("order")[0])
    return ordered.select(first["h"].alias("h"), first["at"].alias("at"), second["h"].alias("h2"), second["at"].alias("at2"), "len").distinct()


def candidates(docs: DataFrame, rare: DataFrame, spec: DecontaminateSpec) -> DataFrame:
    """Places of documents where a window may stand: doc_id, text_hash, start, len, key (the words there)."""
    placed = document_words(docs).select("doc_id", "text_hash", "w", F.posexplode("w").alias("pos", "word"))
    placed = placed.withColumn("h", token(F.col("word"))).drop("word")
    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("len") <= F.size("w"))
    found = [
        placed.join(F.broadcast(part), "h").where(fits).where(token(F.get("w", start + F.col("at2"))) == F.col("h2"))
        for part in blocks(rare, "h", spec.block_rows)
    ]
    # Spark may compute the words before it has tested the start.
    key = ascii_lower(F.array_join(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("len")), " "))
    if not found:
        none = placed.select("doc_id", "text_hash", "pos").limit(0)
        return none.select("doc_id", "text_hash", F.col("pos").alias("start"), F.col("pos").alias("len"), F.lit("").alias("key"))
    return union(found).select("doc_id", "text_hash", start.alias("start"), "len", key.alias("key"))


def covered(spans: Column) -> Column:
    """Words under spans (start, len), overlaps counted once."""

    def add(state, span):
        end = span["start"] + span["len"]
        more = F.greatest(end - F.greatest(span["start"], state["reach"]), F.lit(0))
        return F.struct((state["total"] + more).alias("total"), F.greatest(state["reach"], end).alias("reach"))

    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach")), add)["total"]


def decontaminate(docs: DataFrame, items: DataFrame, spec: DecontaminateSpec = DecontaminateSpec()) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items (sorted ids) and contaminated of every document, whole texts.

    Null or empty text has no words and is not contaminated; items without words have no windows; an item without an
    id hits words but is not listed. Repeated documents each keep a row; equal items are all listed. An empty
    benchmark hits nothing.
    """
    windows = materialize(item_windows(items, spec), "benchmark-windows")
    rare = materialize(rarest_words(windows, docs, spec), "rarest-words")
    hits = candidates(docs, rare, spec).join(windows.select("key", "item_id"), "key")
    per_doc = hits.groupBy("doc_id", "text_hash").agg(
        covered(F.collect_set(F.struct("start", "len"))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    per_doc = per_doc.withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    base = document_words(docs).select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    joined = base.join(per_doc, same, "left").drop("hit_id", "hit_hash")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.withColumns(
        {
            "n_hit": n_hit,
            "items": F.coalesce("items", F.array().cast("array<string>")),
            "contaminated": (n_hit > 0) & (100 * n_hit >= spec.hit_share * F.col("n_words")),
        }
    )


def keep_clean(docs: DataFrame, items: DataFrame, spec: DecontaminateSpec = DecontaminateSpec()) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = decontaminate(docs, items, spec).where("contaminated").select("doc_id", "text_hash").alias("found")
    same = F.col("docs.doc_id").cast("long").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64("docs.text") == F.col("found.text_hash"))
    return docs.alias("docs").join(found, same, "left_anti")
