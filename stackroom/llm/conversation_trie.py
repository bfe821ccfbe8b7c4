"""Prefix trie of conversations: which of them open with the same turns, and how many words a shared prefix spares.

Turns are taken as 128-bit digests, and a prefix as the exclusive or of the digests of (turn, its place), so a prefix has
one key whatever road led to it. Conversations are grouped by blocks of ``block`` turns first: a row for each block of a
conversation, grouped by the key of all that goes up to the block's end. What is left is one row for each different block.
Only where several different blocks follow one prefix can a node lie between; only those are opened, and their turns
grouped, weighted by the conversations that have the block. A block without siblings is a chain of nodes as it is.

Numbers of a node's subtree are sums over its members. Each node belongs to its smallest member, whose nodes are the lower
end of its path; so a member's nodes lie all below a node, or, for the smallest member, from that node on. Texts are not
shuffled, and no conversation, node or group of equal conversations has to fit one task: running totals are cut into
ranges, and the ids of conversations that end in one node are joined by stretches before one hash runs over them.

What happens to odd rows: rows without a conversation id are left out; a null role or text is empty; turns of equal number go
by their digests, so repeated rows are turns of their own; turns without a number come first. No conversations, no nodes.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.operators.joins import join_per_key

from .common import materialize
from .running import running

WORD = r"[^\x20\x09-\x0D]+"
KEY = ("k1", "k2")
UP = ("up1", "up2")


@dataclass(frozen=True)
class TrieSpec:
    """``block``: turns hashed together; ``id_bits``: ends are joined by stretches of 2**id_bits ids."""

    block: int = 4
    id_bits: int = 16

    def __post_init__(self) -> None:
        if self.block < 1 or not 1 <= self.id_bits <= 20:
            raise ValueError("a block has a turn at least, a stretch 2 to 2**20 ids")


def number_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, words): the turns of each conversation from 1 on, as digest and number of words."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *(F.xxhash64(F.lit(i), role, text).alias(f"d{i}") for i in (1, 2)),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.lit(1).cast("long").alias("depth"),
    )
    numbered = running(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")], sums=["depth"])
    return numbered.select("conv_id", F.col("run_depth").alias("depth"), "d1", "d2", "words")


def share_openings(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt: the first h turns are those of conversation c - c % every, if it has them; h is crc32(c) % most.

    A conversation gives at most ``most`` - 1 turns to ``every`` others.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    members = turns.where("depth = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("giver"))
    heads = turns.where(F.col("depth") < most).withColumnRenamed("conv_id", "giver")
    given = members.join(heads, "giver").where("depth <= h").select("conv_id", "depth", "d1", "d2", "words")
    got = members.join(heads.groupBy("giver").agg(F.max("depth").alias("has")), "giver", "left")
    short = got.select("conv_id", (F.col("h") - F.least("h", F.coalesce("has", F.lit(0)))).alias("missing")).where("missing > 0")
    own = join_per_key(turns.where(F.col("depth") > h), short, ["conv_id"], "left")
    own = own.withColumn("depth", F.col("depth") - F.coalesce("missing", F.lit(0)))
    return given.unionAll(own.select("conv_id", "depth", "d1", "d2", "words"))


def _hash_ends(batches):
    """For ``mapInArrow`` over (key, part) rows sorted by key and stretch: the SHA-256 of a key's parts, comma-joined."""
    key, running_hash, out = None, None, []

    def rows():
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=[*KEY, "sha"])

    for batch in batches:
        for a, b, part in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("part")):
            if (a, b) == key:
                running_hash.update(b",")
            else:
                if key is not None:
                    out.append((*key, running_hash.hexdigest()))
                key, running_hash = (a, b), hashlib.sha256()
            running_hash.update(part.as_buffer())
        yield rows()
        out = []
    if key is not None:
        out.append((*key, running_hash.hexdigest()))
        yield rows()


def _ends(members: DataFrame, prefixes: DataFrame, spec: TrieSpec) -> DataFrame:
    """(k1, k2, sha) of every node where a conversation ends."""
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*KEY), "depth").alias("at"))
    at = join_per_key(members.select("conv_id"), last, ["conv_id"], "left")
    keyed = at.select("conv_id", *(F.coalesce(F.col(f"at.{k}"), F.lit(0)).alias(k) for k in KEY), F.shiftright("conv_id", spec.id_bits).alias("stretch"))
    parts = keyed.groupBy(*KEY, "stretch").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("part"))
    return parts.repartition(*KEY).sortWithinPartitions(*KEY, "stretch").select(*KEY, "part").mapInArrow(_hash_ends, "k1 long, k2 long, sha string")


def _opened(blocks: DataFrame, *columns: str | Column) -> DataFrame:
    """A row for each turn of each block, with the key of the prefix that ends there and of the one before."""
    return blocks.select(*columns, "diverges", F.inline("turns"))


def _nodes(opened: DataFrame, *sums: str) -> DataFrame:
    """Nodes by key: those of blocks that diverge meet, those of lone blocks stand as they are."""
    first = [c for c in opened.columns if c not in (*KEY, *sums, "diverges", "conv_id")]
    least = [F.min("conv_id").alias("conv_id")] if "conv_id" in opened.columns else []
    met = opened.where("diverges").groupBy(*KEY).agg(*least, *(F.sum(c).alias(c) for c in sums), *(F.first(c).alias(c) for c in first))
    return met.unionByName(opened.where("NOT diverges").drop("diverges"))


def prefix_trie(members: DataFrame, turns: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """A row for each node, from the root on: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``members`` has every conversation (conv_id) once, ``turns`` their turns (conv_id, depth from 1 on, d1, d2, words).
    """
    keyed = turns.withColumns({k: F.xxhash64(F.lit(i), "d1", "d2", "depth") for i, k in enumerate(("x1", "x2"), 3)})
    found = running(keyed, "conv_id", [F.col("depth")], xors=["x1", "x2"])
    before = {up: F.col(f"run_x{i}").bitwiseXOR(F.col(f"x{i}")) for i, up in enumerate(UP, 1)}
    prefixes = found.select("conv_id", "depth", "words", *(F.col(f"run_x{i}").alias(k) for i, k in enumerate(KEY, 1)), *(c.alias(n) for n, c in before.items()))

    # Blocks of each conversation, then different blocks with the conversations that have them.
    turn = F.struct("depth", *KEY, *UP, "words")
    own = prefixes.groupBy("conv_id", F.floor((F.col("depth") - 1) / spec.block).alias("place")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    own = own.select("conv_id", "turns", F.element_at("turns", -1).alias("last"))
    own = materialize(own.select("conv_id", *(F.col(f"last.{k}").alias(f"end{i}") for i, k in enumerate(KEY, 1)), "turns"), "blocks")
    blocks = own.groupBy("end1", "end2").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns"))
    opens = [F.col("turns")[0][up].alias(f"open{i}") for i, up in enumerate(UP, 1)]
    blocks = materialize(blocks.select("*", *opens), "different-blocks")
    siblings = blocks.groupBy("open1", "open2").agg((F.count("*") > 1).alias("diverges"))
    blocks = materialize(join_per_key(blocks, siblings, ["open1", "open2"], "inner"), "blocks-with-siblings")
    nodes = _nodes(_opened(blocks, "n_convs", "conv_id"), "n_convs")
    root = members.groupBy().agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"),
        *(F.lit(0).cast("long").alias(k) for k in KEY), *(F.lit(None).cast("long").alias(u) for u in UP),
    ).where("n_convs > 0")
    columns = ["conv_id", "depth", *KEY, *UP, "n_convs", "words"]
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    nodes = running(nodes.select(*columns).unionAll(root.select(*columns)).select("*", saved), "conv_id", [F.col("depth")], sums=["saved"])
    nodes = materialize(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(*(F.col(u).alias(k) for u, k in zip(UP, KEY))).agg(F.count("*").alias("n_children"))
    children = materialize(children, "children")

    # What each conversation brings to the nodes it is a member of: all its own nodes save, and the leaf that is its own.
    leaf = join_per_key(nodes, children, list(KEY), "left").groupBy("conv_id").agg(
        F.sum("saved").alias("all_saved"), F.count_if(F.col("n_children").isNull()).alias("leaves")
    )
    brought = join_per_key(own.select("conv_id", "end1", "end2"), leaf, ["conv_id"], "inner").groupBy("end1", "end2").agg(
        F.sum("all_saved").alias("all_saved"), F.sum("leaves").alias("leaves")
    )
    weighed = _nodes(_opened(blocks.join(brought, ["end1", "end2"]), "all_saved", "leaves").select(*KEY, "diverges", "all_saved", "leaves"), "all_saved", "leaves")
    whole = leaf.groupBy().agg(F.sum("all_saved").alias("all_saved"), F.sum("leaves").alias("leaves")).where("leaves IS NOT NULL")
    weighed = weighed.select(*KEY, "all_saved", "leaves").unionAll(whole.select(*(F.lit(0).cast("long").alias(k) for k in KEY), "all_saved", "leaves"))

    facts = (
        nodes.select(*KEY, F.struct("conv_id", "depth", "n_convs", "saved", "run_saved", *UP).alias("node"))
        .unionByName(children, allowMissingColumns=True)
        .unionByName(weighed, allowMissingColumns=True)
        .unionByName(_ends(members, prefixes, spec), allowMissingColumns=True)
    )
    named = ("n_children", "all_saved", "leaves", "sha")
    met = facts.groupBy(*KEY).agg(F.max("node").alias("node"), *(F.max(c).alias(c) for c in named)).select(*KEY, "node.*", *named)
    parents = nodes.select(*(F.col(k).alias(u) for k, u in zip(KEY, UP)), F.col("conv_id").alias("parent_conv_id"))
    return join_per_key(met, parents, list(UP), "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("all_saved") - F.col("run_saved") + F.col("saved")).alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, spec: TrieSpec = TrieSpec()) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) after ``share_openings``."""
    turns = number_turns(conversations)
    return prefix_trie(turns.where("depth = 1").select("conv_id"), share_openings(turns), spec)
