"""Language-model scores of whole texts by a hidden Markov model trained on the corpus itself.

Tokens are the words of a text, A-Z lower-cased, and one end. A hidden state emits a word class, one of ``classes`` buckets
of the words' 64-bit hashes, or the end; within its class a word has its share of the training tokens. That share does not
depend on the state, so it leaves the recursion: the score of a text is the exact probability of its classes, by scaled
forward recursion over all state paths, times the shares of its words. Baum-Welch rounds run over every training text:
tasks add up expected counts of starts, moves and emissions, Spark sums them by class, and the driver divides them, which
takes ``classes`` x ``states`` numbers at any size of the corpus.

Counts of words come from all training texts by a group-by. A word with at least one in ``hot_share`` training tokens
(there cannot be more than ``hot_share`` of them) is looked up in a table that each task gets; all other words meet their
counts in a join, whose keys are then rare among the training tokens.

What happens to odd rows: a null text is an empty one, which has the end alone; rows without an id are trained on, since no
remainder holds them out, and scored; repeated rows count each time and are scored each; other columns are not looked at.
Without training texts every token is unknown, and the base score is that of its formula with N and V of 0. Words are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.operators.joins import join_per_key

from .common import materialize
from .hidden_markov import Counts, Model, add_counts, forward

#: What stands for the end of a text; no word is empty.
END = b""
#: Tokens of the texts that a task works on together; a longer text alone.
TOKENS_AT_ONCE = 1 << 18
#: Different words that a task numbers before it hands on their counts and starts anew.
WORDS_AT_ONCE = 500_000


@dataclass(frozen=True)
class HmmSpec:
    """``prior``: tokens of corpus frequencies that each state is given beside those it emits; ``stay``: first chance that a state is kept."""

    states: int = 6
    classes: int = 16_384
    rounds: int = 4
    stay: float = 0.9
    prior: float = 2000.0
    hot_share: int = 250_000
    modulus: int = 5
    held_out: int = 1
    seed: int = 20

    def __post_init__(self) -> None:
        if not (self.states > 0 and 0 < self.classes < 65_535 and self.rounds >= 0):
            raise ValueError("states and classes are positive, classes below 65535, rounds not negative")


@dataclass
class Frequencies:
    """Sums over the training tokens: all of them, different ones, both by class (the end has none), and counts of frequent words by hash."""

    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    hot_words: np.ndarray
    hot_counts: np.ndarray

    def log_class(self) -> np.ndarray:
        """Per class the logarithm of what word counts plus a half are divided by; words that were not seen have one place a class."""
        return np.append(np.log10(self.class_tokens + 0.5 * (self.class_words + 1)), 0.0)


class _Numbers(dict):
    """Number of each word met so far, and the words' hashes in that order."""

    def __init__(self):
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def _tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def _numbered(batches, column: str):
    """(rows, numbers of their tokens, tokens by row, numbering) for slices of ``TOKENS_AT_ONCE`` tokens or one row."""
    numbers = _Numbers()
    for batch in batches:
        texts, held, sizes, start, count = batch.column(column), [], [], 0, 0
        for i in range(batch.num_rows):
            words = _tokens(texts[i].as_py())
            held.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
            count += len(words)
            if count >= TOKENS_AT_ONCE or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), np.concatenate(held), np.array(sizes), numbers
                held, sizes, start, count = [], [], i + 1, 0
                if len(numbers) > WORDS_AT_ONCE:
                    numbers = _Numbers()


def _counter(batches):
    """For ``mapInArrow``: (word, n), each word once for each numbering."""
    total, numbering = np.zeros(0, np.int64), None

    def rows():
        hashes = np.array(numbering.hashes, np.uint64).view(np.int64)
        for a in range(0, len(hashes), 1 << 16):
            yield pa.record_batch([pa.array(hashes[a : a + (1 << 16)]), pa.array(total[a : a + (1 << 16)])], names=["word", "n"])

    for _, tokens, _, numbers in _numbered(batches, "text"):
        if numbering is not None and numbers is not numbering:
            yield from rows()
            total = np.zeros(0, np.int64)
        numbering = numbers
        new = np.bincount(tokens, minlength=len(numbers))
        new[: len(total)] += total
        total = new
    if numbering is not None:
        yield from rows()


def word_class(hashes: np.ndarray, classes: int) -> np.ndarray:
    """Class of each word; the end has the one after the last."""
    out = (hashes % np.uint64(classes)).astype(np.uint16)
    out[hashes == np.uint64(xxhash.xxh3_64_intdigest(END))] = classes
    return out


def _encoder(spec: HmmSpec, found: Frequencies):
    """For ``mapInArrow``: (..., text) becomes (..., n_tokens, classes, logs and number of frequent words, rare words and how often)."""
    hot_logs = np.log10(found.hot_counts + 0.5)

    def run(batches):
        numbering, classes, logs, hot = None, np.zeros(0, np.uint16), np.zeros(0), np.zeros(0, bool)
        for part, tokens, sizes, numbers in _numbered(batches, "text"):
            if numbers is not numbering:
                numbering, classes, logs, hot = numbers, np.zeros(0, np.uint16), np.zeros(0), np.zeros(0, bool)
            hashes = np.array(numbers.hashes[len(classes) :], np.uint64)
            classes = np.append(classes, word_class(hashes, spec.classes))
            place = np.searchsorted(found.hot_words, hashes)
            there = np.append(found.hot_words, np.uint64(0))[place] == hashes if len(found.hot_words) else np.zeros(len(hashes), bool)
            there &= place < len(found.hot_words)
            logs = np.append(logs, np.where(there, np.append(hot_logs, 0.0)[place], 0.0))
            hot = np.append(hot, there)
            row = np.repeat(np.arange(len(sizes)), sizes)
            known = np.bincount(row, hot[tokens], len(sizes)).astype(np.int64)
            rare = ~hot[tokens]
            pairs, often = np.unique(row[rare] * len(hot) + tokens[rare], return_counts=True)
            words = np.array(numbers.hashes, np.uint64).view(np.int64)[pairs % len(hot)] if len(pairs) else np.zeros(0, np.int64)
            ends = np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(hot)).astype(np.int32)
            coded, cuts = classes[tokens], np.concatenate(([0], np.cumsum(sizes)))
            kept = [part.column(n) for n in part.schema.names if n != "text"]
            yield pa.record_batch(
                [
                    *kept,
                    pa.array(sizes, pa.int64()),
                    pa.array([coded[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    pa.array(np.bincount(row, logs[tokens], len(sizes))),
                    pa.array(known),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(words)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(often.astype(np.int64))),
                ],
                names=[n for n in part.schema.names if n != "text"] + ["n_tokens", "classes", "hot_logs", "hot_known", "rare", "rare_often"],
            )

    return run


def _sequences(batches):
    """(rows, steps, sizes) for slices of ``TOKENS_AT_ONCE`` tokens or one row."""
    for batch in batches:
        held, start = 0, 0
        sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False)
        for i, size in enumerate(sizes.tolist()):
            held += size
            if held >= TOKENS_AT_ONCE or i == batch.num_rows - 1:
                part = batch.slice(start, i + 1 - start)
                yield part, np.frombuffer(b"".join(part.column("classes").to_pylist()), np.uint16), sizes[start : i + 1]
                held, start = 0, i + 1


def _expecter(model: Model):
    """For ``mapInArrow``: a task's expected counts as rows (place, one column a state): classes, then moves, starts, and the logarithm."""

    def run(batches):
        counts, seen = Counts.empty(model.states, len(model.emit)), False
        for _, steps, sizes in _sequences(batches):
            add_counts(counts, model, steps, sizes)
            seen = True
        if seen:
            log = np.full((1, model.states), counts.log)
            rows = np.vstack([counts.emit, counts.move, counts.start[None, :], log])
            place = np.flatnonzero(rows.any(1))
            columns = [pa.array(place), *(pa.array(rows[place, k]) for k in range(model.states))]
            yield pa.record_batch(columns, names=["place", *(f"s{k}" for k in range(model.states))])

    return run


def _scorer(model: Model, log_class: np.ndarray):
    """For ``mapInArrow``: (..., classes) becomes (..., log10 of the classes' probability, log10 of what word counts are divided by)."""

    def run(batches):
        for part, steps, sizes in _sequences(batches):
            row = np.repeat(np.arange(len(sizes)), sizes)
            names = [n for n in part.schema.names if n != "classes"]
            paths = forward(model, steps, sizes) / np.log(10)
            columns = [*(part.column(n) for n in names), pa.array(paths), pa.array(np.bincount(row, log_class[steps], len(sizes)))]
            yield pa.record_batch(columns, names=[*names, "log_paths", "log_shares"])

    return run


def held_out(doc_id: Column, spec: HmmSpec) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % spec.modulus == spec.held_out, F.lit(False))


def count_words(docs: DataFrame, spec: HmmSpec) -> DataFrame:
    """(word, n) of the training tokens: hash and count, the end among them."""
    training = docs.where(~held_out(F.col("doc_id"), spec)).select(F.col("text").cast("binary").alias("text"))
    counted = training.mapInArrow(_counter, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequencies(counts: DataFrame, spec: HmmSpec) -> Frequencies:
    """Collects a row for each class, and frequent words: at most ``hot_share``, 16 bytes each."""
    end = int(np.uint64(xxhash.xxh3_64_intdigest(END)).view(np.int64))
    place = F.when(F.col("word") == end, spec.classes).otherwise(
        F.pmod(F.shiftrightunsigned("word", 1) % spec.classes * 2 + F.col("word").bitwiseAND(1), F.lit(spec.classes))
    )
    by_class = counts.groupBy(place.alias("place")).agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).collect()
    tokens, words = np.zeros(spec.classes + 1, np.int64), np.zeros(spec.classes + 1, np.int64)
    for r in by_class:
        tokens[r.place], words[r.place] = r.tokens, r.words
    total = int(tokens.sum())
    hot = counts.where(F.col("n") * spec.hot_share >= total).toArrow()
    hashes = hot.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Frequencies(total, int(words.sum()), tokens[:-1], words[:-1], hashes[order], hot.column("n").to_numpy()[order])


def first_model(found: Frequencies, spec: HmmSpec) -> Model:
    """States that mostly stay, and corpus frequencies that each state bends at random."""
    rng = np.random.default_rng(spec.seed)
    common = _common(found)
    emit = common[:, None] * rng.lognormal(0.0, 1.0, (len(common), spec.states))
    k = spec.states
    move = np.full((k, k), (1 - spec.stay) / max(k - 1, 1)) if k > 1 else np.ones((1, 1))
    if k > 1:
        np.fill_diagonal(move, spec.stay)
    return Model(np.full(k, 1 / k), move, emit / emit.sum(0))


def _common(found: Frequencies) -> np.ndarray:
    """Share of each class, and of the end, in the training tokens, none of them 0."""
    n = np.append(found.class_tokens, found.tokens - found.class_tokens.sum()) + 0.5
    return n / n.sum()


def improve(model: Model, training: DataFrame, found: Frequencies, spec: HmmSpec) -> tuple[Model, float]:
    """One round of Baum-Welch over all training sequences; also the logarithm of their probability before it."""
    columns = [f"s{k}" for k in range(model.states)]
    expected = training.select("n_tokens", "classes").mapInArrow(_expecter(model), "place long, " + ", ".join(f"{c} double" for c in columns))
    sums = expected.groupBy("place").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    classes, k = len(model.emit), model.states
    rows = np.zeros((classes + k + 2, k))
    rows[sums.column("place").to_numpy()] = np.column_stack([sums.column(c).to_numpy() for c in columns])
    emit = rows[:classes] + spec.prior * _common(found)[:, None]
    move, start = rows[classes : classes + k] + 1.0, rows[classes + k] + 1.0
    return Model(start / start.sum(), move / move.sum(1)[:, None], emit / emit.sum(0)), float(rows[-1, 0])


def train(training: DataFrame, found: Frequencies, spec: HmmSpec) -> Model:
    model = first_model(found, spec)
    for _ in range(spec.rounds):
        model, _ = improve(model, training, found, spec)
    return model


def encode(docs: DataFrame, found: Frequencies, spec: HmmSpec) -> DataFrame:
    """A row for each row of ``docs``: its own ``row`` number, the id, and the tokens as classes and rare words."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", held_out(F.col("doc_id"), spec).alias("held_out"), F.col("text").cast("binary").alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        _encoder(spec, found),
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, classes binary, hot_logs double, hot_known long, rare array<long>, rare_often array<long>",
    )


def score_documents(docs: DataFrame, spec: HmmSpec = HmmSpec()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs`` (doc_id, text).

    ``base_score`` is the logarithm (base 10) of the text's probability by smoothed word frequencies, ``score`` that of
    the hidden Markov model.
    """
    counts = materialize(count_words(docs, spec), "word-counts")
    found = frequencies(counts, spec)
    coded = materialize(encode(docs, found, spec), "tokens")
    model = train(coded.where("NOT held_out"), found, spec)

    pairs = coded.select("row", F.inline(F.arrays_zip(F.col("rare").alias("word"), F.col("rare_often").alias("often"))))
    seen = counts.where(F.col("n") * spec.hot_share < found.tokens)
    met = join_per_key(pairs, seen, ["word"], "left").groupBy("row").agg(
        F.sum(F.col("often") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("often")).otherwise(0)).alias("rare_known"),
    )
    kept = ["row", "doc_id", "held_out", "n_tokens", "hot_logs", "hot_known"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = coded.select(*kept, "classes").mapInArrow(
        _scorer(model, found.log_class()),
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, hot_logs double, hot_known long, log_paths double, log_shares double",
    )
    all_logs = F.col("hot_logs") + F.coalesce("rare_logs", F.lit(0.0))
    # The end has a class of its own: its count is no share of anything.
    end_log = float(np.log10(_end_count(found) + 0.5))
    size = float(np.log10(found.tokens + 0.5 * (found.distinct + 1)))
    return scored.join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(found.tokens).cast("long").alias("train_tokens"),
        (all_logs - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("log_paths") + all_logs - F.lit(end_log) - F.col("log_shares")).alias("score"),
    )


def _end_count(found: Frequencies) -> int:
    return found.tokens - int(found.class_tokens.sum())
