"""Fill-in-middle: cut each text at two code points and put the pieces in another order around sentinels.

The cut is a lookup in a learned rank index. Texts are UTF-8 bytes, and the byte offset of code point r among all
boundaries of a buffer is a step function of r that is nearly straight. ``RankIndex`` fits it with straight segments,
each within ``epsilon`` bytes of every boundary it covers, and stores what is left as one signed byte for each boundary.
A cut is predicted by its segment and corrected by its residual, which gives the boundary itself, never one nearby.

What happens to odd rows: a null or empty text is plain and stays as it is (null is taken as empty); a null id is hashed as
the seed followed by a colon; repeated ids are cut alike where their texts have as many code points; other columns are
not looked at. A text of any length is one row of one task; tasks hold some megabytes of text, or one text, at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text in one buffer; a longer text has a buffer of its own.
BUFFER_BYTES = 1 << 22

#: Points of a segment that are fitted at one time.
RUN = 1 << 14


@dataclass(frozen=True)
class FimSpec:
    """``plain_from`` and ``spm_below`` are percentages: of all texts, 100 - plain_from stay plain; of the others, spm_below go suffix first."""

    seed: str = "1"
    plain_from: int = 90
    spm_below: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    epsilon: int = 31

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or any(len(m) != 3 or m[0] != "<" or m[2] != ">" or m[1] in "<>" for m in marks):
            raise ValueError("sentinels are three different characters, each between < and >")
        if not 1 <= self.epsilon <= 126:
            raise ValueError("a residual has one byte: epsilon is from 1 to 126")


def boundaries(data: np.ndarray) -> np.ndarray:
    """Byte offset of every code point of UTF-8 bytes, and the end."""
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


class RankIndex:
    """Offsets by rank, as straight segments (first rank, first offset, slope) and one residual byte for each rank."""

    def __init__(self, offsets: np.ndarray, epsilon: int = 31):
        self.size = len(offsets)
        firsts, slopes = [], []
        start = 0
        while start < self.size:
            length, slope = _cone(offsets, start, epsilon)
            firsts.append(start)
            slopes.append(slope)
            start += length
        self.first_rank = np.array(firsts, np.int64)
        self.first_offset = offsets[self.first_rank] if self.size else np.zeros(0, np.int64)
        self.slope = np.array(slopes, np.float64)
        self.residual = np.empty(self.size, np.int8)
        for i, (start, stop) in enumerate(zip(firsts, [*firsts[1:], self.size])):
            for a in range(start, stop, RUN):
                ranks = np.arange(a, min(a + RUN, stop))
                self.residual[a : a + len(ranks)] = offsets[ranks] - self._on_line(np.int64(i), ranks)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        return self._on_line(np.searchsorted(self.first_rank, ranks, "right") - 1, ranks)

    def _on_line(self, segment: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        ahead = self.slope[segment] * (ranks - self.first_rank[segment])
        return self.first_offset[segment] + np.floor(ahead + 0.5).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact: the prediction plus the stored residual."""
        return self.predict(ranks) + self.residual[ranks]


def _cone(y: np.ndarray, start: int, epsilon: int) -> tuple[int, float]:
    """How many points from ``start`` on one line through the first of them meets within ``epsilon``, and its slope.

    Each point narrows the cone of slopes that meet it; the segment ends before the point that empties the cone. Points
    are taken in runs that double up to ``RUN``, so a segment costs time in proportion to its length.
    """
    low, high, done, run = -np.inf, np.inf, 1, 64
    while start + done < len(y):
        part = y[start + done : start + done + run]
        steps = np.arange(done, done + len(part))
        rise = part - y[start]
        lows = np.maximum.accumulate(np.maximum((rise - epsilon) / steps, low))
        highs = np.minimum.accumulate(np.minimum((rise + epsilon) / steps, high))
        fits = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(part)
        if fits:
            low, high = lows[fits - 1], highs[fits - 1]
        done += fits
        if fits < len(part):
            break
        run = min(2 * run, RUN)
    return done, (low + high) / 2 if done > 1 else 0.0


def _groups(sizes: list[int], most: int):
    """Ranges of rows with ``most`` bytes together, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _arranged(joined: bytes, sizes: list[int], low: np.ndarray, high: np.ndarray, forms: list[str], spec: FimSpec) -> list[bytes]:
    """The output of each of the texts that ``joined`` holds one after another; ``low`` and ``high`` are code points of a text."""
    p, s, m = (x.encode() for x in (spec.prefix, spec.suffix, spec.middle))
    offsets = boundaries(np.frombuffer(joined, np.uint8))
    index = RankIndex(offsets, spec.epsilon)
    ends = np.cumsum(sizes)
    first = np.searchsorted(offsets, ends - sizes)  # rank of each text's first code point
    one, two = index.offsets(first + low).tolist(), index.offsets(first + high).tolist()
    out = []
    for form, a, b, c, d in zip(forms, (ends - sizes).tolist(), one, two, ends.tolist()):
        if form == "psm":
            out.append(b"".join((p, joined[a:b], s, joined[c:d], m, joined[b:c])))
        elif form == "spm":
            out.append(b"".join((s, joined[c:d], p, joined[a:b], m, joined[b:c])))
        else:
            out.append(joined[a:d])
    return out


def _arranger(spec: FimSpec):
    """For ``mapInArrow``: (text, n_bytes, low, high, form, ...) becomes (output, low, high, form, ...)."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("n_bytes").to_pylist()
            for start, stop in _groups(sizes, BUFFER_BYTES):
                part = batch.slice(start, stop - start)
                low, high = (part.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
                joined = b"".join(part.column("text").to_pylist())
                out = _arranged(joined, sizes[start:stop], low, high, part.column("form").to_pylist(), spec)
                names = [n for n in batch.schema.names if n not in ("text", "n_bytes")]
                yield pa.record_batch([pa.array(out, pa.binary()), *(part.column(n) for n in names)], names=["output", *names])

    return run


def _draw(digest: Column, place: int) -> Column:
    """The 8-digit group of a hex digest as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")


def rearrange(docs: DataFrame, spec: FimSpec = FimSpec()) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output, for every row of ``docs``.

    The cuts and the form depend on the id, the seed and the number of code points alone.
    """
    text = F.coalesce("text", F.lit(""))
    marked = F.lit(False)
    for mark in (spec.prefix, spec.suffix, spec.middle):
        marked |= text.contains(mark)
    digest = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = docs.select("doc_id", text.alias("text"), F.char_length(text).cast("long").alias("n"), digest.alias("digest"), marked.alias("marked"))
    one, two = (_draw(F.col("digest"), i) % (F.col("n") + 1) for i in (0, 1))
    is_plain = (F.col("n") == 0) | F.col("marked") | (_draw(F.col("digest"), 2) % 100 >= spec.plain_from)
    form = F.when(is_plain, "plain").when(_draw(F.col("digest"), 3) % 100 < spec.spm_below, "spm").otherwise("psm")
    cut = drawn.select(
        F.col("text").cast("binary").alias("text"), F.octet_length("text").cast("long").alias("n_bytes"),
        F.least(one, two).alias("low"), F.greatest(one, two).alias("high"), form.alias("form"), "n", "doc_id",
    )
    names = f"output binary, low long, high long, form string, n long, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    moved = cut.mapInArrow(_arranger(spec), names)
    split = F.col("form") != "plain"
    return moved.select(
        "doc_id", "n", "form", F.when(split, F.col("low")).alias("prefix_chars"), F.when(split, F.col("high") - F.col("low")).alias("middle_chars"),
        F.col("output").cast("string").alias("output"),
    )


def restored(output: Column, form: Column, spec: FimSpec = FimSpec()) -> Column:
    """The text that became ``output``: its pieces between sentinels, in their first order.

    No text that was cut has a sentinel, and none can arise where pieces meet sentinels: two of them never overlap.
    """
    pieces = F.split(output, "|".join(rf"\Q{mark}\E" for mark in (spec.prefix, spec.suffix, spec.middle)), -1)
    piece = lambda i: F.get(pieces, F.lit(i))
    return (
        F.when(form == "psm", F.concat(piece(1), piece(3), piece(2)))
        .when(form == "spm", F.concat(piece(2), piece(3), piece(1)))
        .otherwise(output)
    )
