"""A hidden Markov model over word classes, in numpy: scaled forward recursion and Baum-Welch counts of many sequences at once.

Sequences are cut into chunks of ``CHUNK`` steps. A chunk's product of transition and emission matrices is found for all
chunks side by side; what enters and leaves a chunk follows from the products before and after it. This is the exact
recursion, for sequences of any length, and a long sequence is as parallel as many short ones. All is done on some thousand
chunks at a time: besides them, memory holds a matrix for each chunk of the sequences at hand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHUNK = 64
#: Chunks that are worked on at one time.
BLOCK = 4096
#: Steps between two scalings of a product; probabilities of so many steps do not underflow.
SCALE_EVERY = 8


@dataclass
class Model:
    """``start`` (states), ``move`` (states, states) and ``emit`` (classes, states), whose rows, rows and columns sum to 1."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @property
    def states(self) -> int:
        return len(self.start)


class Chunks:
    """Where the chunks of sequences of the given sizes lie, longest first."""

    def __init__(self, sizes: np.ndarray):
        self.per_sequence = -(-sizes // CHUNK)
        first = np.cumsum(self.per_sequence) - self.per_sequence
        sequence = np.repeat(np.arange(len(sizes)), self.per_sequence)
        place = np.arange(len(sequence)) - first[sequence]
        size = np.minimum(CHUNK, sizes[sequence] - place * CHUNK)
        order = np.argsort(-size, kind="stable")
        self.start = ((np.cumsum(sizes) - sizes)[sequence] + place * CHUNK)[order]
        self.size, self.opens = size[order], (place == 0)[order]
        self.at = np.empty(len(order), np.int64)  # of a chunk in order of text: its place in this order
        self.at[order] = np.arange(len(order))
        self.first = first

    def blocks(self):
        for a in range(0, len(self.size), BLOCK):
            yield slice(a, min(a + BLOCK, len(self.size)))

    def by_place(self):
        """For place 0, 1, ... the sequences that have a chunk there, and those chunks."""
        longest = np.argsort(-self.per_sequence, kind="stable")
        counts = self.per_sequence[longest]
        for place in range(int(counts[0]) if len(counts) else 0):
            held = longest[: np.searchsorted(-counts, -place, "left")]
            yield held, self.at[self.first[held] + place]


def _active(size: np.ndarray) -> list[int]:
    """How many of the chunks, longest first, have a step 0, 1, ..."""
    return [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]


def products(model: Model, steps: np.ndarray, chunks: Chunks) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of each chunk, scaled, and the logarithm of its scale. The first step of a sequence has no transition."""
    k = model.states
    out, logs = np.empty((len(chunks.size), k, k)), np.zeros(len(chunks.size))
    for block in chunks.blocks():
        start, size, opens = chunks.start[block], chunks.size[block], chunks.opens[block]
        p = np.where(opens[:, None, None], np.eye(k), model.move) * model.emit[steps[start]][:, None, :]
        log = np.zeros(len(start))
        active = _active(size)
        for t, m in enumerate(active):
            if t:
                moved = (p[:m].reshape(-1, k) @ model.move).reshape(m, k, k)
                np.multiply(moved, model.emit[steps[start[:m] + t]][:, None, :], out=p[:m])
            if t % SCALE_EVERY == SCALE_EVERY - 1 or t == len(active) - 1:
                scale = p.sum((1, 2))
                p /= scale[:, None, None]
                log += np.log(scale)
        out[block], logs[block] = p, log
    return out, logs


def forward(model: Model, steps: np.ndarray, sizes: np.ndarray, chunks: Chunks | None = None, with_entries: bool = False):
    """Natural logarithm of the probability of each sequence; with_entries: also the matrices and the state shares before each chunk."""
    chunks = chunks or Chunks(sizes)
    matrices, logs = products(model, steps, chunks)
    shares = np.tile(model.start, (len(sizes), 1))
    total = np.zeros(len(sizes))
    entries = np.empty((len(chunks.size), model.states)) if with_entries else None
    for held, at in chunks.by_place():
        if with_entries:
            entries[at] = shares[held]
        after = np.einsum("sk,skl->sl", shares[held], matrices[at])
        scale = after.sum(1)
        shares[held] = after / scale[:, None]
        total[held] += np.log(scale) + logs[at]
    return (total, matrices, entries) if with_entries else total


@dataclass
class Counts:
    """Expected counts of starts, moves and emissions under a model, and the logarithm of the probability."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    log: float = 0.0

    @classmethod
    def empty(cls, states: int, classes: int) -> Counts:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((classes, states)))


def add_counts(counts: Counts, model: Model, steps: np.ndarray, sizes: np.ndarray) -> None:
    """Add the expected counts of some sequences: forward and backward recursion within chunks, from what enters and leaves them."""
    chunks = Chunks(sizes)
    total, matrices, entries = forward(model, steps, sizes, chunks, True)
    counts.log += float(total.sum())
    behind = np.ones((len(sizes), model.states))
    exits = np.empty_like(entries)
    for held, at in reversed(list(chunks.by_place())):
        exits[at] = behind[held]
        before = np.einsum("skl,sl->sk", matrices[at], behind[held])
        behind[held] = before / before.sum(1)[:, None]
    moves = np.zeros_like(model.move)
    for block in chunks.blocks():
        start, size, opens = chunks.start[block], chunks.size[block], chunks.opens[block]
        entry, beta = entries[block], exits[block].copy()
        active = _active(size)
        shares = np.empty((len(active), len(start), model.states))
        share = np.where(opens[:, None], entry, entry @ model.move) * model.emit[steps[start]]
        for t, m in enumerate(active):
            if t:
                share = (shares[t - 1, :m] @ model.move) * model.emit[steps[start[:m] + t]]
            shares[t, :m] = share / share.sum(1)[:, None]
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            seen = model.emit[steps[start[:m] + t]] * beta[:m]
            if t:
                before, ahead = shares[t - 1, :m], seen
            else:
                before, ahead = entry[~opens], seen[~opens]
            scale = ((before @ model.move) * ahead).sum(1)
            moves += before.T @ (ahead / scale[:, None])
            both = shares[t, :m] * beta[:m]
            shares[t, :m] = both / both.sum(1)[:, None]
            earlier = seen @ model.move.T
            beta[:m] = earlier / earlier.sum(1)[:, None]
        counts.start += shares[0][opens].sum(0)
        there = np.arange(len(active))[:, None] < size
        classes = steps[(start + np.arange(len(active))[:, None])[there]]
        for k in range(model.states):
            counts.emit[:, k] += np.bincount(classes, shares[:, :, k][there], len(counts.emit))
    counts.move += model.move * moves
