"""Byte-level BPE by Spark's higher-order functions, over a constant table of merges, on distinct words.

Texts are cut into words by the tokenizer's pattern. Each distinct word is encoded once: a fold over the word's bytes
merges, step by step, the leftmost adjacent pair of lowest rank. Pieces are numbers, their ranks: a pair of pieces is a
key of the table of merges, whose value is the rank of the joined piece. The table is a column of one row, an array of
small maps chosen by the remainder of the key, since Spark searches a map from front to back. A scalar subquery brings it
into the expression, so that plans and their descriptions do not hold its text. Words of more than ``long_word`` bytes,
for which a fold would take quadratic time, are merged by the same rules with a heap in a small helper, and a word that
is a piece itself is looked up. Decoding looks every id up in the list of pieces and concatenates them.

The most frequent words of all documents (``common_words`` of them, a fixed number, so that their table may go to every
task) are encoded once for all. Every other word is encoded once in each document that has it, in place: no row is
capped, and neither texts nor words are shuffled but for the counts.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stackroom.functions.columns import free_name

from .common import materialize, slices

LATIN = "ISO-8859-1"
#: Ranks are below this; a pair of pieces has the key left * SPAN + right.
SPAN = 1 << 20
#: Stands for the rank of pieces that do not join.
NONE = SPAN - 1


@dataclass(frozen=True)
class BpeSpec:
    """``ranks``: path of a rank file (base64 piece and rank in each line); ``pattern``: what cuts texts into words."""

    ranks: str
    pattern: str
    common_words: int = 300_000
    long_word: int = 256
    buckets: int = 131_071


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def words_of(text: Column, pattern: str) -> Column:
    """Matches of the pattern in order; white space as Unicode has it."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class RankMap:
    """Ranks as a table of one row for Spark, and as a dictionary for the driver, long words and pieces."""

    def __init__(self, spec: BpeSpec):
        self.spec, self.ranks = spec, read_ranks(spec.ranks)
        self.table: DataFrame | None = None
        if max(self.ranks.values(), default=0) >= NONE:
            raise ValueError(f"{spec.ranks}: ranks of {NONE} or more")
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"{spec.ranks}: no rank for bytes {missing}")

    def merges(self, spark: SparkSession) -> DataFrame:
        """One row, one column: merges (maps from the key of a pair to SPAN times the rank of both joined) and pieces by rank.

        It goes to Spark as Arrow: as Python objects the maps take several times their size on the driver.
        """
        if self.table is None:
            ranks, buckets = self.ranks, self.spec.buckets
            keys, values = array("q"), array("q")
            pieces = [""] * (max(ranks.values()) + 1)
            for piece, rank in ranks.items():
                pieces[rank] = piece.decode("latin-1")
                for i in range(1, len(piece)):
                    left, right = ranks.get(piece[:i]), ranks.get(piece[i:])
                    if left is not None and right is not None:
                        keys.append(left * SPAN + right)
                        values.append(rank * SPAN)
            key, value = np.frombuffer(keys, np.int64), np.frombuffer(values, np.int64)
            bucket = key % buckets
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.append(0, np.bincount(bucket, minlength=buckets))).astype(np.int32)
            maps = pa.MapArray.from_arrays(pa.array(ends), pa.array(key[order]), pa.array(value[order]))
            whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (maps, pa.array(pieces, pa.string()))]
            row = pa.StructArray.from_arrays(whole, names=["maps", "pieces"])
            self.table = spark.createDataFrame(pa.table({"merges": row}))
        return self.table

    def use(self, rows: DataFrame, name: str, then: Callable[[Merges], Column]) -> DataFrame:
        """``rows`` and an expression over the table. The optimizer puts the subquery in the place of its column, used once."""
        table = free_name("merges", rows)
        met = rows.withColumn(table, self.merges(rows.sparkSession).scalar())
        found = let(F.col(table), lambda m: then(Merges(m["maps"], m["pieces"], self.spec.buckets)))
        return met.select(*rows.columns, found.alias(name))


@dataclass(frozen=True)
class Merges:
    """Encoding and decoding over merges (an array of maps) and a list of pieces by rank."""

    maps: Column
    pieces: Column
    buckets: int

    def scaled(self, left: Column, right: Column) -> Column:
        """Rank of two pieces joined, times SPAN; that of NONE if it has none or if one of them is null."""
        key = left * F.lit(SPAN) + right
        found = F.try_element_at(F.get(self.maps, (key % F.lit(self.buckets)).cast("int")), key)
        return F.coalesce(found, F.lit(NONE * SPAN))

    def merge(self, pieces: Column) -> Column:
        """The pieces of a word after all merges, from its single bytes."""

        # An element is a piece, plus SPAN times the rank of it joined with the piece before: one array is cut and put
        # together again at each step, which is most of the work.
        def rank(element: Column) -> Column:
            return F.shiftright(element, 20)

        def piece(element: Column) -> Column:
            return element.bitwiseAND(F.lit(SPAN - 1))

        def step(state: Column, _: Column) -> Column:
            return let(
                rank(F.array_min(state)),
                lambda least: F.when(least == NONE, state).otherwise(
                    let(F.array_position(F.transform(state, rank), least).cast("int"), lambda at: merged(state, least, at))
                ),
            )

        def merged(x: Column, least: Column, at: Column) -> Column:
            new = F.array(self.scaled(piece(F.get(x, at - 3)), least) + least)
            after = piece(F.get(x, at))
            after = F.when(at < F.size(x), F.array(self.scaled(least, after) + after)).otherwise(F.array().cast("array<bigint>"))
            return F.flatten(F.array(F.slice(x, F.lit(1), at - 2), new, after, F.slice(x, at + 2, F.size(x))))

        bytes_ = pieces.cast("array<bigint>")
        start = let(bytes_, lambda p: F.transform(p, lambda q, i: self.scaled(F.get(p, i - 1), q) + q))
        folded = F.aggregate(F.sequence(F.lit(2), F.size(pieces)), start, step)
        return F.when(F.size(pieces) < 2, pieces).otherwise(F.transform(folded, lambda x: piece(x).cast("int")))

    def decode(self, ids: Column) -> Column:
        """The bytes of a list of ids."""
        return F.encode(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i)), ""), LATIN)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs: for words too long for the fold."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left, j = pieces[i], after[i]
        if left is None or j >= n or len(left) + len(pieces[j]) != size:
            continue
        pieces[i], pieces[j] = left + pieces[j], None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and pieces[a] + pieces[b] in ranks:
                both = pieces[a] + pieces[b]
                heapq.heappush(heap, (ranks[both], a, len(both)))
    return [ranks[p] for p in pieces if p is not None]


def byte_ids(ranks: dict[bytes, int]) -> np.ndarray:
    """The rank of each byte."""
    return np.array([ranks[bytes([b])] for b in range(256)], np.int32)


def single_bytes(words: pa.StringArray, ids: np.ndarray) -> pa.ListArray:
    """The ranks of each word's bytes. ``words`` is no slice of another array."""
    _, ends, raw = words.buffers()
    ends = np.frombuffer(ends, np.int32)[: len(words) + 1]
    raw = np.frombuffer(raw or b"", np.uint8)[: ends[-1]]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[raw]))


def encode_words(words: DataFrame, maps: RankMap) -> DataFrame:
    """word, n_ids, ids (decimal, joined by commas) and decoded (the ids' bytes) for each row of distinct ``words``."""
    ranks, long_word = maps.ranks, maps.spec.long_word

    def run(batches):
        singles = byte_ids(ranks)
        for batch in slices(batches, 4096):
            texts = batch.column(0).to_pylist()
            raw = [t.encode() for t in texts]
            done = [merge_long(w, ranks) if len(w) > long_word or w in ranks else None for w in raw]
            bytes_ = single_bytes(pa.array([t if d is None else "" for t, d in zip(texts, done)], pa.string()), singles)
            yield pa.record_batch([batch.column(0), pa.array(done, pa.list_(pa.int32())), bytes_], names=["word", "done", "bytes"])

    def coded(m: Merges) -> Column:
        tokens = F.coalesce(F.col("done"), m.merge(F.col("bytes")))
        return let(
            tokens,
            lambda ids: F.struct(F.size(ids).alias("n_ids"), joined_ids(ids).alias("ids"), m.decode(ids).cast("string").alias("decoded")),
        )

    rows = words.select("word").mapInArrow(run, "word string, done array<int>, bytes array<int>")
    return maps.use(rows, "coded", coded).select("word", "coded.*")


def word_table(words: DataFrame) -> bytes:
    """Encoded words as one Arrow stream, for tasks to read; compressed, since the driver holds it several times."""
    table = words.toArrow()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    del table
    return out.getvalue().to_pybytes()


def split_known(rows: DataFrame, table: bytes, maps: RankMap) -> DataFrame:
    """Each document as pieces of known ids and texts, with the words between them that are still to be encoded.

    ``rare`` lists each unknown word of the document once, as the ranks of its bytes; ``which`` says which of them stands
    after each piece.
    """
    shared, ranks, long_word = rows.sparkSession.sparkContext.broadcast(table), maps.ranks, maps.spec.long_word
    schema = pa.schema(
        [
            ("n_known", pa.int64()), ("ids", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
            ("which", pa.list_(pa.int32())), ("rare", pa.list_(pa.list_(pa.int32()))),
        ]
    )

    def known_words() -> tuple[dict[str, int], pa.Array, pa.Array, np.ndarray]:
        """Row of each known word (the common ones, and pieces that are whole words) in ids, texts and numbers of ids."""
        common = pa.ipc.open_stream(shared.value).read_all().combine_chunks()
        place = {word: i for part in common["word"].chunks for i, word in enumerate(part.to_pylist())}
        more = {}
        for piece, rank in ranks.items():
            try:
                word = piece.decode()
            except UnicodeDecodeError:
                continue
            if word not in place:
                more[word] = str(rank)
        place.update(zip(more, range(len(place), len(place) + len(more))))
        ids = pa.concat_arrays([*common["ids"].chunks, pa.array(more.values(), pa.string())])
        texts = pa.concat_arrays([*common["decoded"].chunks, pa.array(more.keys(), pa.string())])
        return place, ids, texts, np.append(common["n_ids"].to_numpy(), np.ones(len(more), np.int64))

    def found(words: pa.Array, known: tuple, texts_of: dict[int, bytes]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """ids, texts and numbers of ids of distinct words; 0 ids where a word is still to be encoded."""
        place, ids, texts, count = known
        row = np.array([place.get(w, -1) for w in words.to_pylist()], np.int64)
        at = pa.array(row, mask=row < 0)
        ids, texts, count = ids.take(at), texts.take(at), np.where(row < 0, 0, count[row])
        long = (row < 0) & (pc.binary_length(words).to_numpy() > long_word)
        if long.any():
            merged = [merge_long(w.encode(), ranks) for w in words.filter(pa.array(long)).to_pylist()]
            ids = pc.replace_with_mask(ids, long, pa.array([",".join(map(str, m)) for m in merged]))
            decoded = [b"".join(texts_of[i] for i in m).decode("utf-8", "replace") for m in merged]
            texts = pc.replace_with_mask(texts, long, pa.array(decoded))
            count[long] = list(map(len, merged))
        return ids, texts, count

    def split(words: pa.ListArray, known: tuple, singles: np.ndarray, texts_of: dict[int, bytes]) -> list[pa.Array]:
        flat = words.flatten().cast(pa.string()).dictionary_encode()
        ends = np.cumsum([0, *words.value_lengths().to_numpy()])
        distinct, at = flat.dictionary, flat.indices.to_numpy()
        ids, texts, count = found(distinct, known, texts_of)
        count = count[at]
        gaps = np.flatnonzero(count == 0)
        before = np.cumsum(np.append(0, count != 0))  # known words before each place
        # A run of known words begins with its document or after a gap; it may be empty.
        runs = np.sort(np.concatenate([ends[:-1], gaps]), kind="stable")
        run_ends = pa.array(np.append(before[runs], before[-1]).astype(np.int32))
        kept = pa.array(at[count != 0])
        gap_ends = np.searchsorted(gaps, ends)
        per_text = pa.array((gap_ends + np.arange(len(ends))).astype(np.int32))

        def joined(values: pa.Array, mark: str) -> pa.Array:
            return pa.ListArray.from_arrays(per_text, pc.binary_join(pa.ListArray.from_arrays(run_ends, values.take(kept)), mark))

        owner = np.repeat(np.arange(len(words)), np.diff(gap_ends))
        pairs, which = np.unique(owner * len(distinct) + at[gaps], return_inverse=True)
        rare_ends = np.searchsorted(pairs, np.arange(len(words) + 1) * len(distinct))
        rare = single_bytes(pc.take(distinct, pa.array(pairs % max(len(distinct), 1))), singles)
        return [
            pa.array(np.diff(np.cumsum(np.append(0, count))[ends])),
            joined(ids, ","),
            joined(texts, ""),
            pa.ListArray.from_arrays(pa.array(gap_ends.astype(np.int32)), pa.array((which - rare_ends[owner]).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(rare_ends.astype(np.int32)), rare),
        ]

    def run(batches):
        known, singles, texts_of = known_words(), byte_ids(ranks), {rank: piece for piece, rank in ranks.items()}
        for batch in slices(batches):
            columns = [c.cast(f.type) for c, f in zip(split(batch.column(1), known, singles, texts_of), schema)]
            yield pa.record_batch([batch.column(0), *columns], names=["row", *schema.names])

    rows = rows.select("row", words_of(F.col("text"), maps.spec.pattern).alias("words"))
    types = StructType.fromDDL("n_known long, ids array<string>, texts array<string>, which array<int>, rare array<array<int>>")
    return rows.mapInArrow(run, StructType([rows.schema["row"], *types.fields]))


def joined_ids(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def encode_documents(docs: DataFrame, spec: BpeSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep``, n_tokens, ids (text, joined by commas), decoded (text) of every document, whole texts.

    Null text is empty and has no tokens; repeated rows are each encoded; special tokens are ordinary text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), *keep).alias("row"), text)
    counts = rows.select(F.explode(words_of(F.col("text"), spec.pattern)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # Longer words are encoded in place: the table that every worker holds is bounded in bytes as well.
    counts = counts.where(F.octet_length("word") <= spec.long_word)
    common = materialize(counts.orderBy(F.desc("n"), "word").limit(spec.common_words).select("word"), "bpe-common-words")
    maps = RankMap(spec)
    table = word_table(materialize(encode_words(common.repartition(rows.sparkSession.sparkContext.defaultParallelism), maps), "bpe-words"))
    parts = split_known(rows, table, maps)

    def whole(merges: Merges, encoded: Column) -> Column:
        def between(pieces: str, word: Callable[[Column], Column]) -> Column:
            pairs = F.transform("which", lambda k, i: F.array(F.get(pieces, i), word(F.get(encoded, k))))
            return F.concat(F.flatten(pairs), F.slice(pieces, F.lit(-1), F.lit(1)))

        return F.struct(
            F.aggregate("which", F.col("n_known"), lambda n, k: n + F.size(F.get(encoded, k))).alias("n_tokens"),
            F.array_join(F.array_remove(between("ids", joined_ids), ""), ",").alias("ids"),
            F.array_join(between("texts", lambda ids: merges.decode(ids).cast("string")), "").alias("decoded"),
        )

    coded = maps.use(parts, "coded", lambda m: let(F.transform("rare", m.merge), lambda ids: whole(m, ids)))
    return coded.select("row.*", "coded.*")
