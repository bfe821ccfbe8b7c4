"""Exact substring de-duplication with merged Burrows-Wheeler transforms.

A byte goes if it is covered by a string of ``size`` bytes that also starts in a document with a smaller id. Whether a
string starts elsewhere is found in stages, none of which loses a match:

1. Copies of whole texts are set aside: the one with the least id stands for all, the others go as a whole.
2. Every string has an anchor, a hash of the ``gram``-byte piece of least hash in it and of half the other bytes of a string beside
   that piece: those before it, if the string holds them, else those after it. Equal strings have equal anchors, so
   only anchors that different texts share matter. Neighbouring strings mostly have the same anchor; together they are
   a segment of at most ``size + most_strings - 1`` bytes.
3. Segments with shared anchors are gathered by hash, equal ones as one row with the least id.
4. The distinct segments of an anchor, if there are several, meet in one bucket with their bytes. A bucket is cut into shards; each shard's suffixes are
   sorted and give its transform. The transforms are merged by refining an interleave: round k takes, in the order by
   the first k-1 bytes, the byte before each suffix, and sorts by it stably, which is the order by the first k bytes
   (two rounds are one sort by both bytes).
   Places where the order by k bytes sets neighbours apart bound the common prefixes. After ``size`` rounds, rows
   without such a place between them have a common prefix of ``size`` bytes: a repeated interval. Its least id is the
   answer for all its strings. No suffix is compared again after its shard was sorted.
5. An anchor with very many different segments (a frequent word between different neighbours) is not brought into one
   bucket: its strings are grouped one by one, with partial minima.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.operators.joins import join_per_key

from .common import discard, materialize, mix, slices
from .jaccard_join import long_lists


@dataclass(frozen=True)
class SubstringSpec:
    """``gram``: bytes of the piece that an anchor is chosen by; short ones are shared by chance, long ones are more. A bucket holds about ``bucket_rows`` segments."""

    size: int = 50
    gram: int = 16
    most_strings: int = 35
    bucket_rows: int = 8000
    shard_rows: int = 1000


BYTES = mix(np.arange(1, 257, dtype=np.uint64))
#: The low bits of a gram's hash, where its place is kept.
PLACE = np.uint64((1 << 32) - 1)
FACTOR = mix(np.arange(400, 401, dtype=np.uint64))[0] | np.uint64(1)
STEPS = tuple(int(x) | 1 for x in mix(np.arange(301, 331, dtype=np.uint64)))
#: Bytes of texts that are looked at in one go, so that arrays stay in a core's cache, and segments that are merged in one go.
PACK = 1 << 15
MERGED = 2000
#: Bytes and the end mark.
SYMBOLS = 257


class Powers:
    """The first powers of a factor, worked out once for all texts of a task."""

    def __init__(self, factor: np.uint64):
        self.factor, self.known = factor, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if n > len(self.known):
            out = np.full(max(n, 2 * len(self.known)), self.factor, np.uint64)
            out[0] = 1
            self.known = np.multiply.accumulate(out, out=out)
        return self.known[:n]


FORTH, BACK = Powers(FACTOR), Powers(np.uint64(pow(int(FACTOR), -1, 1 << 64)))


def packs(texts: list[bytes], most: int = PACK) -> Iterator[slice]:
    """Neighbouring texts of about ``most`` bytes together, or one longer text."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > most:
            yield slice(first, i)
            first, size = i, 0
        size += len(text)
    if texts:
        yield slice(first, len(texts))


def anchor_runs(texts: list[bytes], spec: SubstringSpec) -> tuple[np.ndarray, ...]:
    """(start, strings, anchor) of neighbouring strings with one anchor; ``start`` is a place in all texts on end. Then the
    number of the text each is in. A string lies within one text.
    """
    raw, ends = b"".join(texts), np.cumsum([0, *map(len, texts)])
    if len(raw) < spec.size:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    doubled, size = BYTES[np.frombuffer(raw, np.uint8)], 1
    hashed, done = None, 0
    while True:
        if spec.gram & size:  # this power of two is a part of the gram
            hashed = doubled if hashed is None else hashed[: len(doubled) - done] * np.uint64(STEPS[size]) + doubled[done:]
            done += size
        if 2 * size > spec.gram:
            break
        doubled = doubled[:-size] * np.uint64(STEPS[size - 1]) + doubled[size:]
        size *= 2
    # The low bits hold the place of a gram, which also orders equal ones: the first counts.
    least, width, window = (mix(hashed) & ~PLACE) | np.arange(len(hashed), dtype=np.uint64), 1, spec.size - spec.gram + 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    whole = np.ones(len(least), bool)
    for a, b in zip(ends.tolist(), ends[1:].tolist()):
        whole[max(a, b - spec.size + 1) : b] = False
    at = np.flatnonzero(whole)
    # A string has half of what it holds besides the gram on one side of it at least: to the left if it is there.
    gram, more = (least[at] & PLACE).astype(np.int64), (spec.size - spec.gram) // 2
    first = np.where(gram - at >= more, gram - more, gram)
    change = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(at) else np.empty(0, np.int64)
    anchors = segment_hashes(raw, first[change], np.full(len(change), spec.gram + more))
    of = np.searchsorted(ends, at[change], "right") - 1
    apart = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (of[1:] != of[:-1])]) if len(change) else np.empty(0, bool)
    change, anchors, of = change[apart], anchors[apart], of[apart]
    return at[change], np.diff(np.append(change, len(at))), anchors, of


def string_anchors(raw: bytes, spec: SubstringSpec) -> np.ndarray:
    """The anchor of the string that starts at each byte."""
    _, strings, anchors, _ = anchor_runs([raw], spec)
    return np.repeat(anchors, strings)


def segment_runs(start: np.ndarray, strings: np.ndarray, spec: SubstringSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one anchor cut into segments: the run, the first string and the number of strings of each."""
    parts = -(-strings // spec.most_strings)
    run = np.repeat(np.arange(len(strings)), parts)
    skipped = spec.most_strings * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return run, start[run] + skipped, np.minimum(strings[run] - skipped, spec.most_strings)


def text_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and whole (SHA-256 of the text)."""
    text = F.coalesce("text", F.lit(b""))
    return raw_texts(docs).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("whole"))


def text_anchors(docs: DataFrame, spec: SubstringSpec) -> DataFrame:
    """doc_id and the distinct anchors of each text."""

    def run(batches):
        for batch in slices(batches):
            texts, found = [t or b"" for t in batch.column(1).to_pylist()], []
            for part in packs(texts):
                _, _, anchors, of = anchor_runs(texts[part], spec)
                cuts = np.searchsorted(of, np.arange(1, part.stop - part.start))
                found += map(np.unique, np.split(anchors, cuts))
            yield pa.record_batch({"doc_id": batch.column(0), "anchors": long_lists(found)})

    return raw_texts(docs).mapInArrow(run, "doc_id long, anchors array<long>")


def raw_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def shared_anchors(texts: DataFrame) -> DataFrame:
    """(doc_id, anchors): the anchors of each text that a text with another id has too."""
    rows = texts.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = rows.groupBy("anchor").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = materialize(shared.where("first < last").select("anchor"), "shared-anchors")
    met = rows.join(shared, "anchor")  # what was written is not placed by its key: both sides are shuffled as they are
    chosen = materialize(met.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors")), "chosen-texts")
    discard(shared)
    return chosen


def segment_hashes(raw: bytes, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each piece of ``raw``: polynomials of hashed bytes, all from one running sum; equal pieces of any text have equal ones."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[np.frombuffer(raw, np.uint8)] * FORTH(len(raw)), out=sums[1:])
    # Every piece is brought to the power that the text's start has.
    return mix((sums[first + length] - sums[first]) * BACK(len(raw) + 1)[first] + length.astype(np.uint64))


def shared_segments(docs: DataFrame, chosen: DataFrame, spec: SubstringSpec) -> DataFrame:
    """doc_id, start, strings, anchor and hash, for every segment of the chosen texts with a shared anchor; no bytes yet."""

    def run(batches):
        for batch in slices(batches, 64):
            found = []
            doc_ids, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            for part in packs(texts):
                start, strings, anchors, of = anchor_runs(texts[part], spec)
                # What one text wants is shared, so another text that has it wants it too.
                wanted = batch.column(1).slice(part.start, part.stop - part.start).flatten().to_numpy().view(np.uint64)
                hit = np.isin(anchors, wanted)
                start, strings, anchors, of = start[hit], strings[hit], anchors[hit], of[hit]
                run, first, count = segment_runs(start, strings, spec)
                hashed = segment_hashes(b"".join(texts[part]), first, count + spec.size - 1).view(np.int64)
                begin = np.cumsum([0, *map(len, texts[part])])[of[run]]
                found.append(np.stack([doc_ids[part][of[run]], first - begin, count, anchors[run].view(np.int64), hashed]))
            rows = np.concatenate([np.empty((5, 0), np.int64), *found], axis=1)
            yield pa.record_batch(list(map(pa.array, rows)), names=["doc_id", "start", "strings", "anchor", "hash"])

    rows = chosen.join(raw_texts(docs), "doc_id").select("doc_id", "anchors", "text")
    return rows.mapInArrow(run, "doc_id long, start long, strings long, anchor long, hash long")


def segment_bytes(docs: DataFrame, segments: DataFrame, spec: SubstringSpec) -> DataFrame:
    """anchor, hash, rows, first and segment: the bytes of segments at (first, start), from the texts of the documents ``first``."""
    schema = pa.schema([("anchor", pa.int64()), ("hash", pa.int64()), ("rows", pa.int64()), ("first", pa.int64()), ("segment", pa.binary())])

    def run(batches):
        for batch in slices(batches, 64):
            out = [[] for _ in schema]
            places = batch.column(1)
            start, strings, anchor, hashed, rows_ = (x.to_pylist() for x in places.flatten().flatten())
            ends = np.cumsum([0, *places.value_lengths().to_pylist()]).tolist()
            for doc_id, raw, i, j in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), ends, ends[1:]):
                out[0] += anchor[i:j]
                out[1] += hashed[i:j]
                out[2] += rows_[i:j]
                out[3] += [doc_id] * (j - i)
                out[4] += [raw[a : a + n + spec.size - 1] for a, n in zip(start[i:j], strings[i:j])]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    per_text = segments.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list(F.struct("start", "strings", "anchor", "hash", "rows")).alias("places"))
    rows = per_text.join(raw_texts(docs).dropDuplicates(["doc_id"]), "doc_id").select("doc_id", "places", "text")
    return rows.mapInArrow(run, "anchor long, hash long, rows long, first long, segment binary")


def shard_transform(segments: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the segments (as places in their concatenation, an end mark after each), sorted by ``size`` symbols at least,
    and the two symbols before each as one number, where a segment's end comes before its start.

    Symbols are bytes plus one, the end mark is 0. ``segments`` are sorted, so equal suffixes stand in their order.
    """
    ends = np.cumsum([len(s) + 1 for s in segments])
    symbols = np.zeros(ends[-1], np.int64)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
    n = len(symbols)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - 1 - np.arange(n)  # symbols up to the end mark
    # Seven symbols of nine bits make the first key; later ones join two ranks.
    key = np.zeros(n, np.int64)
    for i in range(7):
        key[: n - i] |= np.where(left[: n - i] >= i, symbols[i:], 0) << (9 * (6 - i))
    rank = _ranks(key)
    known = 7
    while known < size and known <= left.max():
        further = np.where(left >= known, rank[np.minimum(np.arange(n) + known, n - 1)], 0)
        rank = _ranks(rank * (rank.max() + 1) + further)
        known *= 2
    order = np.argsort(rank * n + np.arange(n))
    before = np.concatenate([[0], symbols[:-1]])
    further = np.concatenate([[0], before[:-1]])
    further[np.append(0, ends[:-1])] = symbols[ends - 2]
    return order, (further * SYMBOLS + before)[order]


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The number of each key among the different ones in order."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
    return ranks


def merge_transforms(shards: list[tuple[np.ndarray, np.ndarray]], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Refine the interleave of the shards: suffixes (as rows of all shards' suffix lists on end) in the order by their first
    ``rounds`` symbols, and the number of the interval of equal prefixes each one is in.

    Two rounds at a time: a stable sort by both symbols before a suffix is one by the nearer and then one by the further.
    """
    sizes = [len(order) for order, _ in shards]
    two = np.concatenate([b for _, b in shards])
    two, one = _numbered(two, SYMBOLS**2), _numbered(two % SYMBOLS, SYMBOLS)
    shard = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) <= 256 else np.uint16), sizes)
    interval = np.zeros(len(shard), np.int32 if len(shard) < 1 << 31 else np.int64)
    for before in [two] * (rounds // 2) + [one] * (rounds % 2):
        symbol = np.empty_like(before)
        symbol[np.argsort(shard, kind="stable")] = before  # each shard's symbols in their own order
        order = np.argsort(symbol, kind="stable")
        shard, interval, sorted_symbol = shard[order], interval[order], symbol[order]
        apart = (sorted_symbol[1:] != sorted_symbol[:-1]) | (interval[1:] != interval[:-1])
        interval = np.concatenate([[0], np.cumsum(apart, dtype=interval.dtype)], dtype=interval.dtype)
    rows = np.empty(len(shard), np.int64)
    rows[np.argsort(shard, kind="stable")] = np.arange(len(shard))
    return rows, interval


def _numbered(symbols: np.ndarray, most: int) -> np.ndarray:
    """Symbols below ``most`` by their numbers among those there are: small ones are sorted byte by byte."""
    used = np.zeros(most, bool)
    used[symbols] = True
    number = np.cumsum(used) - 1
    return number.astype(np.min_scalar_type(number[-1]))[symbols]


def least_owners(segments: list[bytes], owners: np.ndarray, spec: SubstringSpec) -> list[np.ndarray]:
    """For each string of each segment: the least owner of any segment that has the string. ``segments`` are distinct."""
    order = sorted(range(len(segments)), key=segments.__getitem__)
    shards, of, at, base = [], [], [], 0
    count = -(-len(order) // spec.shard_rows)
    for i in range(count):
        part = order[i::count]
        found = shard_transform([segments[j] for j in part], spec.size)
        lengths = np.array([len(segments[j]) + 1 for j in part])
        owner_row = np.repeat(np.array(part), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        of.append(owner_row[found[0]])
        at.append(place[found[0]])
        shards.append(found)
    rows, interval = merge_transforms(shards, spec.size)
    of, at = np.concatenate(of)[rows], np.concatenate(at)[rows]
    strings = np.array([len(s) - spec.size + 1 for s in segments])
    whole = at < strings[of]
    of, at, interval = of[whole], at[whole], interval[whole]
    first = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
    least = np.minimum.reduceat(owners[of], first)
    least = np.repeat(least, np.diff(np.append(first, len(of))))
    base = np.concatenate([[0], np.cumsum(strings)])
    out = np.empty(base[-1], np.int64)
    out[base[of] + at] = least
    return np.split(out, base[1:-1])


#: ``least``: least doc_id of any string of the segment; ``firsts``: of each string, null if they are the same.
OWNERS = "anchor long, hash long, least long, strings long, firsts array<long>"


def merged_buckets(segments: DataFrame, buckets: int, spec: SubstringSpec) -> DataFrame:
    """OWNERS of segments (anchor, hash, segment, first); an anchor lies in one bucket."""

    def merge(table: pa.Table) -> pa.Table:
        # Segments of different anchors have no string in common: whole anchors, some at a time, fit a core's cache.
        table = table.sort_by("anchor")
        raw, owners, anchors = table["segment"].to_pylist(), table["first"].to_numpy(), table["anchor"].to_numpy()
        starts, at, firsts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])), 0, []
        while at < len(raw):
            later = starts[np.searchsorted(starts, at + MERGED) :]
            to = int(later[0]) if len(later) else len(raw)
            firsts += least_owners(raw[at:to], owners[at:to], spec)
            at = to
        least, strings = [int(f.min()) for f in firsts], list(map(len, firsts))
        differ = pa.array([None if f.max() == m else f for f, m in zip(firsts, least)], pa.list_(pa.int64()))
        columns = [table["anchor"], table["hash"], pa.array(least, pa.int64()), pa.array(strings, pa.int64()), differ]
        return pa.table(columns, names=["anchor", "hash", "least", "strings", "firsts"])

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    # Equal segments lie in one row already, and so do equal (anchor, segment): segments of a bucket are distinct
    # because a segment's strings all have the segment's anchor.
    rows = segments.select("anchor", "hash", "segment", "first", bucket)
    return rows.groupBy("bucket").applyInArrow(merge, OWNERS)


def single_strings(segments: DataFrame, spec: SubstringSpec) -> DataFrame:
    """The same for anchors with very many segments: every string on its own, least owner by partial minima."""
    places = F.sequence(F.lit(1), F.length("segment") - spec.size + 1)
    rows = segments.select("anchor", "hash", "segment", "first", F.explode(places).alias("at"))
    rows = rows.select("anchor", "hash", "at", "first", F.substring("segment", F.col("at"), F.lit(spec.size)).alias("string"))
    least = rows.groupBy("string").agg(F.min("first").alias("least"))
    met = join_per_key(rows.drop("first"), least, ["string"], "inner")
    ordered = F.array_sort(F.collect_list(F.struct("at", "least")))
    found = met.groupBy("anchor", "hash").agg(ordered.alias("o"), F.min("least").alias("least"), F.count("*").alias("strings"))
    return found.select("anchor", "hash", "least", "strings", F.col("o.least").alias("firsts"))


def first_owners(docs: DataFrame, segments: DataFrame, spec: SubstringSpec) -> DataFrame:
    """OWNERS: for each string of each distinct segment the least doc_id that has the string."""
    place = F.struct(F.col("doc_id").alias("first"), "start", "strings")
    distinct = segments.groupBy("anchor", "hash").agg(F.min(place).alias("place")).select("anchor", "hash", "place.*")
    distinct = materialize(distinct, "distinct-segments")
    counts = distinct.groupBy("anchor").agg(F.count("*").alias("rows"))
    counted = materialize(join_per_key(distinct, counts, ["anchor"], "inner"), "counted-segments")
    discard(distinct)
    firsts = F.lit(None).cast("array<long>").alias("firsts")
    alone = materialize(counted.where("rows = 1").select("anchor", "hash", F.col("first").alias("least"), "strings", firsts), "lone-segments")
    many = materialize(segment_bytes(docs, counted.where("rows > 1"), spec), "segment-bytes")
    discard(counted)
    few, frequent = many.where(F.col("rows") <= spec.bucket_rows), many.where(F.col("rows") > spec.bucket_rows)
    buckets = -(-few.count() // spec.bucket_rows)
    # One after the other, so that the shuffle files of one are gone when those of the next are written.
    found = alone.unionByName(materialize(single_strings(frequent, spec), "frequent-owners"))
    if buckets:
        found = found.unionByName(materialize(merged_buckets(few, buckets, spec), "string-owners"))
    discard(many)
    return found


def earlier(strings: Column, firsts: Column, doc_id: Column) -> Column:
    """Bit i: string i starts in a smaller document. Without ``firsts`` all ``strings`` do."""
    bits = F.transform(firsts, lambda f, i: F.when(f < doc_id, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    every = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (F.lit(64) - strings).cast("int"))
    return F.when(firsts.isNull(), every).otherwise(F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)))


def remaining(texts: list[bytes], copies: list[bool | None], hits: pa.ListArray, spec: SubstringSpec) -> tuple[list, list, list]:
    """Bytes removed, runs of them, and what stays of each text; a hit is the first of some strings and bits of those that go."""
    lengths = hits.value_lengths().fill_null(0).to_numpy()
    begin = np.cumsum([0, *map(len, texts)])
    of = np.repeat(np.arange(len(texts)), lengths)
    start, bits = (x.to_numpy() for x in hits.flatten().flatten())
    hit, bit = np.nonzero(np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    at = begin[of[hit]] + start[hit] + bit
    at = at[at + spec.size <= begin[of[hit] + 1]]  # of rows that share an id another one may be longer
    gone = np.bincount(at, minlength=begin[-1] + 1) - np.bincount(at + spec.size, minlength=begin[-1] + 1)
    off = np.cumsum(gone[:-1]) > 0
    head = off.copy()
    head[1:] &= ~off[:-1]
    inside = begin[:-1][begin[:-1] < begin[-1]]
    head[inside] = off[inside]
    removed, runs = (np.diff(np.concatenate([[0], np.cumsum(x)])[begin]).tolist() for x in (off, head))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    kept = [raw[i:j][~off[i:j]].tobytes() if n else t for t, n, i, j in zip(texts, removed, begin.tolist(), begin[1:].tolist())]
    for i in np.flatnonzero([bool(c) for c in copies]).tolist():
        removed[i], runs[i], kept[i] = len(texts[i]), 1, b""
    return removed, runs, kept


def remove_repeats(docs: DataFrame, spec: SubstringSpec = SubstringSpec()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every document, whole texts.

    Null text is empty. Texts shorter than ``size`` keep all bytes. Rows that share an id count as one document: none
    removes another. A row without an id keeps all bytes and removes none.
    """
    texts = materialize(text_hashes(docs.where(F.col("doc_id").isNotNull())), "texts")
    heads = texts.where(F.col("n_bytes") >= spec.size).groupBy("whole").agg(F.min("doc_id").alias("head"))
    heads = materialize(heads, "distinct-texts")
    # Copies have the strings of the text that stands for them.
    first = raw_texts(docs).join(heads.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi")
    anchors = materialize(text_anchors(first, spec), "text-anchors")
    chosen = shared_anchors(anchors)
    discard(anchors)
    segments = materialize(shared_segments(docs, chosen, spec), "segments")
    discard(chosen)
    owners = first_owners(docs, segments, spec)
    met = segments.select("doc_id", "start", "anchor", "hash").join(owners, ["anchor", "hash"]).where("least < doc_id")
    bits = met.select("doc_id", "start", earlier(F.col("strings"), F.col("firsts"), F.col("doc_id")).alias("bits"))
    hits = bits.groupBy("doc_id").agg(F.collect_set(F.struct("start", "bits")).alias("hits"))
    copies = join_per_key(texts.select("doc_id", "whole"), heads, ["whole"], "inner").where("doc_id > head")
    marks = hits.withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc_id", F.lit(None).cast(hits.schema["hits"].dataType).alias("hits"), F.lit(True).alias("copy"))
    )
    marks = marks.groupBy("doc_id").agg(F.max("copy").alias("copy"), F.first("hits", ignorenulls=True).alias("hits"))
    marks = materialize(marks, "removed-strings")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches):
        for batch in slices(batches, 64):
            texts, copies = [t or b"" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist()
            found = [remaining(texts[part], copies[part], batch.column(3).slice(part.start, part.stop - part.start), spec) for part in packs(texts)]
            columns = [[x for part in found for x in part[i]] for i in range(3)]
            columns = [batch.column(0), list(map(len, texts)), *columns]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = raw_texts(docs).join(marks, "doc_id", "left").select("doc_id", "text", "copy", "hits")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
