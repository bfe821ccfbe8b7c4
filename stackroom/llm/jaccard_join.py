"""Size-aware heavy-light Jaccard join of word-shingle sets.

Two sets link if 100 * |A & B| >= ``percent`` * |A | B|; with 75 percent at most a quarter of a set is missing from a
set it links with. Copies share a set, so only distinct sets are joined. Sets without a chance go first; what is left
is split by size:

* light sets (few shingles) list their subsets: a link of overlap k means a common subset of k shingles, and two sets
  of the right sizes that share such a subset do link, with nothing to verify. All sets of a subset link with the
  smallest of them, or not at all;
* heavy sets scan inverted lists of the rarest quarter of each set's shingles (plus one), where every link must meet;
  sizes and positions bound what is worth comparing, and pairs are verified on the whole sets.

The boundary is the size at which listing subsets of the smaller and scanning lists for the larger sets costs least,
by counts over all sets.

Only the classes of linked sets are wanted, so lists are not turned into all their pairs: each list first offers its
members to the set with the fewest unshared shingles (in a group of copies that is the original), and later only pairs
whose sets are still in different classes are compared, once each.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.columns import field, hashable, row_hash
from stackroom.operators.joins import join_per_key

from .common import discard, materialize, slices
from .components import components
from .shingles import WordHashes, shingle_hashes


@dataclass(frozen=True)
class JoinSpec:
    percent: int = 75
    #: No set above this size lists subsets, whatever the costs.
    most_light: int = 24
    #: Prefixes are cut so that linked sets have one ``common``-th of their shingles in common there.
    common: int = 6

    def missing(self, n: int) -> int:
        """Most shingles of a set of ``n`` that a linked set may lack."""
        return n - -(-self.percent * n // 100)


def missing(n: Column, spec: JoinSpec) -> Column:
    return (n - F.ceil(n * spec.percent / 100)).cast("int")


def enough(overlap: Column, n: Column, m: Column, spec: JoinSpec) -> Column:
    """Is ``overlap`` enough for sets of ``n`` and ``m``?"""
    return (100 + spec.percent) * overlap >= spec.percent * (n + m)


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def set_prefixes(docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """doc_id, n (set size), signature of the set (16 bytes) and its first shingles in the order of their hashes.

    The order of hashes is common to all sets. The first missing(n) + c shingles of linked sets have c in common.
    """

    def run(batches):
        words = WordHashes()
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "n": pa.array([len(s) for s in sets], pa.int32()),
                    "signature": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    "prefix": long_lists([s[: spec.missing(len(s)) + -(-len(s) // spec.common)] for s in sets]),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, n int, signature binary, prefix array<long>")


def promising(sets: DataFrame, spec: JoinSpec) -> DataFrame:
    """(set_id, n) of the documents whose prefixes share enough shingles with prefixes of other sets.

    Copies do not count as others: sets are told apart by a hash of their signatures. A partner has at least percent * n
    shingles, so its prefix was cut for at least that share of n / ``common`` in common.
    """
    rows = sets.select("doc_id", F.xxhash64("signature").alias("of"), F.explode("prefix").alias("shingle"))
    shared = rows.groupBy("shingle").agg(F.min("of").alias("first"), F.max("of").alias("last"))
    shared = materialize(shared.where("first < last").select("shingle"), "shared-prefix-shingles")
    found = join_per_key(rows.drop("of"), shared, ["shingle"], "inner").groupBy("doc_id").count()
    needed = F.ceil(F.ceil(F.col("n") * spec.percent / 100) / spec.common)
    counted = sets.select("doc_id", "n").join(found, "doc_id")
    chosen = materialize(counted.where(F.col("count") >= needed).select(F.col("doc_id").alias("set_id"), "n"), "promising-documents")
    discard(shared)
    return chosen


def whole_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """set_id, n and all shingles of the chosen sets."""

    def run(batches):
        words = WordHashes()
        for batch in slices(batches):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch.column(2).to_pylist()]
            yield pa.record_batch({"set_id": batch.column(0), "n": batch.column(1), "shingles": long_lists(sets)})

    texts = docs.select(F.col("doc_id").cast("long").alias("set_id"), F.col("text").cast("string").cast("binary").alias("text"))
    joined = chosen.join(texts, "set_id").select("set_id", "n", "text")
    return joined.mapInArrow(run, "set_id long, n int, shingles array<long>")


def ordered_sets(sets: DataFrame, spec: JoinSpec) -> DataFrame:
    """set_id, n, lone (shingles that no other set has), shared (all others, rarest first) and cost (list rows to scan).

    Sets with more lone shingles than a link may miss are out.
    """
    rows = sets.select("set_id", F.explode("shingles").alias("shingle"))
    counts = materialize(rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "shingle-counts")
    counted = join_per_key(rows, counts, ["shingle"], "inner")
    grouped = counted.groupBy("set_id").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("order"))
    grouped = sets.select("set_id", "n").join(grouped, "set_id")
    lone = (F.col("n") - F.size("order")).alias("lone")
    left = grouped.select("set_id", "n", lone, "order").where(F.col("lone") <= missing(F.col("n"), spec))
    prefix = F.slice("order", F.lit(1), missing(F.col("n"), spec) + 1 - F.col("lone"))
    cost = F.aggregate(prefix, F.lit(0).cast("long"), lambda total, x: total + x["df"])
    ordered = materialize(left.select("set_id", "n", "lone", F.col("order.shingle").alias("shared"), cost.alias("cost")), "ordered-sets")
    discard(counts)
    return ordered


def subsets(n: int, shared: int, spec: JoinSpec) -> int:
    """Subsets that a light set lists: all sizes that an overlap can have."""
    return sum(comb(shared, k) for k in range(n - spec.missing(n), n + 1))


def choose_boundary(sets: DataFrame, spec: JoinSpec) -> int:
    """Largest light size: least total of subsets listed for sizes up to it and list rows scanned for larger sizes."""
    small = sets.where(F.col("n") <= spec.most_light)
    costs = small.groupBy("n", F.size("shared").alias("s")).agg(F.count("*").alias("sets"), F.sum("cost").alias("scan")).collect()
    light = {n: sum(r["sets"] * subsets(n, r["s"], spec) for r in costs if r["n"] == n) for n in range(spec.most_light + 1)}
    heavy = {n: sum(r["scan"] for r in costs if r["n"] == n) for n in range(spec.most_light + 1)}
    total = lambda limit: sum(light[n] if n <= limit else heavy[n] for n in light)
    return min(range(spec.most_light + 1), key=lambda limit: (total(limit), -limit))


def light_links(sets: DataFrame, boundary: int, spec: JoinSpec) -> DataFrame:
    """Links (a, b) among sets up to ``boundary``, each to the smallest set with the same subset, no verification needed."""

    def run(batches):
        for batch in slices(batches, 64):
            out = [
                (set_id, n, list(part))
                for set_id, n, shared in zip(*(batch.column(i).to_pylist() for i in range(3)))
                for k in range(n - spec.missing(n), len(shared) + 1)
                for part in combinations(sorted(shared), k)
            ]
            columns = list(zip(*out)) or [(), (), ()]
            types = (pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["set_id", "n", "part"])

    light = sets.where(F.col("n") <= boundary).select("set_id", "n", "shared")
    rows = light.mapInArrow(run, "set_id long, n int, part array<long>")
    least = rows.groupBy("part").agg(F.min(F.struct("n", "set_id")).alias("least"), F.count("*").alias("sets"))
    met = join_per_key(rows, least.where("sets > 1"), ["part"], "inner")
    links = met.where(enough(F.size("part"), F.col("n"), F.col("least.n"), spec) & (F.col("set_id") != F.col("least.set_id")))
    return links.select(F.col("set_id").alias("a"), F.col("least.set_id").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, spec: JoinSpec) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets. Lone shingles cannot be common and are left out."""
    side = lambda name: sets.select(F.col("set_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("shared").alias(f"of_{name}"))
    both = join_per_key(join_per_key(pairs, side("a"), ["a"], "inner"), side("b"), ["b"], "inner")
    overlap = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(enough(overlap, F.col("n_a"), F.col("n_b"), spec)).select("a", "b")


def near_size(n: Column, m: Column, spec: JoinSpec) -> Column:
    return 100 * F.least(n, m) >= spec.percent * F.greatest(n, m)


def heavy_links(sets: DataFrame, light: DataFrame, boundary: int, spec: JoinSpec) -> DataFrame:
    """Links found by scanning inverted lists, beside ``light``; as many as the classes need."""
    prefix = F.slice("shared", F.lit(1), missing(F.col("n"), spec) + 1 - F.col("lone"))
    lists = sets.select("set_id", "n", "lone", prefix.alias("prefix"))
    lists = lists.select("set_id", "n", "lone", "prefix", F.posexplode("prefix").alias("at", "shingle"))
    narrow = materialize(lists.drop("prefix"), "inverted-lists")
    hub = narrow.groupBy("shingle").agg(F.min(F.struct("lone", "n", "set_id")).alias("hub"), F.count("*").alias("rows")).where("rows > 1")
    offered = join_per_key(narrow, hub, ["shingle"], "inner").where(F.col("set_id") != F.col("hub.set_id"))
    offered = offered.where(near_size(F.col("n"), F.col("hub.n"), spec)).groupBy("set_id").agg(F.collect_set("hub").alias("hubs"))
    # The likeliest hubs will do here: whatever they do not bring together is compared below.
    offered = offered.select(F.col("set_id").alias("a"), F.explode(F.slice(F.array_sort("hubs"), 1, 2)).alias("hub"))
    pairs = materialize(offered.select("a", F.col("hub.set_id").alias("b")), "offered-pairs")
    links = materialize(verified(pairs, sets, spec).unionAll(light), "hub-links")
    discard(pairs)

    classes = components(links)
    own = classes.select(F.col("id").alias("set_id"), "component")
    classed = join_per_key(narrow, own, ["set_id"], "left").withColumn("component", F.coalesce("component", "set_id"))
    classed = materialize(classed, "classed-lists")
    discard(narrow)
    discard(classes)
    open_ = classed.groupBy("shingle").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("shingle")
    rest = join_per_key(classed, open_, ["shingle"], "inner")
    rest = materialize(join_per_key(rest, sets.select("set_id", prefix.alias("prefix")), ["set_id"], "inner"), "open-lists")
    discard(classed)
    a, b = rest.alias("x"), rest.alias("y")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    left = lambda v: v("n") - v("lone") - v("at")  # noqa: E731  shingles of the set from this one on
    meet = (
        (x("shingle") == y("shingle"))
        & (x("set_id") < y("set_id"))
        & (x("component") != y("component"))
        & (F.greatest(x("n"), y("n")) > boundary)
        & near_size(x("n"), y("n"), spec)
        # only where the two meet first, which is also where the bound on what is left is right
        & enough(F.least(left(x), left(y)), x("n"), y("n"), spec)
        & (F.get(F.array_intersect(x("prefix"), y("prefix")), F.lit(0)) == x("shingle"))
    )
    pairs = materialize(a.join(b, meet).select(x("set_id").alias("a"), y("set_id").alias("b")), "open-pairs")
    discard(rest)
    found = materialize(verified(pairs, sets, spec), "open-links")
    discard(pairs)
    return links.unionAll(found)


def link_classes(docs: DataFrame, spec: JoinSpec = JoinSpec()) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id that links reach) of every document, whole texts.

    Null, empty and blank texts have no shingles and link with nothing; copies link. Ids are taken as unique;
    repeated rows each keep a row. A row without an id takes no part and gets no class.
    """
    prefixes = materialize(set_prefixes(docs, spec), "set-prefixes")
    one = prefixes.where("n > 0 and doc_id is not null").groupBy("signature").agg(F.min("doc_id").alias("set_id"))
    one = materialize(one, "distinct-sets")
    many = promising(prefixes.where("n > 0 and doc_id is not null"), spec)
    chosen = materialize(many.join(one.select("set_id"), "set_id", "left_semi"), "promising-sets")
    discard(many)
    # The shingles of prefixes have done their work; what else is asked of a document is a few bytes.
    named = materialize(prefixes.drop("prefix"), "set-names")
    discard(prefixes)
    whole = materialize(whole_sets(docs, chosen), "whole-sets")
    discard(chosen)
    sets = ordered_sets(whole, spec)
    discard(whole)
    boundary = choose_boundary(sets, spec)
    light = light_links(sets, boundary, spec)
    links = heavy_links(sets, light, boundary, spec)
    classes = components(links)
    discard(sets)
    discard(links)
    heads = one.join(classes.withColumnRenamed("id", "set_id"), "set_id", "left")
    heads = heads.select("signature", F.coalesce("component", "set_id").alias("component"))
    rows = join_per_key(named, heads, ["signature"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, spec: JoinSpec = JoinSpec()) -> DataFrame:
    """The rows of ``docs`` with the least id of their class, one for each id; rows without an id stay."""
    heads = link_classes(docs, spec).where("doc_id = component_id").select(F.col("doc_id").alias("head")).distinct()
    kept = docs.alias("d").join(heads.alias("h"), F.col("d.doc_id") == F.col("h.head"), "left_semi")
    # Of rows with one id that with the least hash of its other columns stays.
    others = [c for c in hashable(docs) if c != "doc_id"]
    if not others:
        return kept.dropDuplicates(["doc_id"]).unionByName(docs.where(F.col("doc_id").isNull()))
    row = F.struct(*[field(c) for c in docs.columns])
    kept = kept.groupBy("doc_id").agg(F.min_by(row, row_hash(others)).alias("row")).select("row.*")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
