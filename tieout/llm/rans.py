"""Range asymmetric numeral systems over token ids, in numpy.

A shared table gives every token that occurs a frequency out of ``2**bits``. A
block of tokens is coded alone: token i goes to lane i modulo ``LANES``, every
lane is a 64-bit state, and states that grow too large shed 32-bit words into one
stream in the order in which a decoder asks for them. Many blocks are coded at a
time, so that a step of the loop works on a wide array.

Checkpoints keep the states and the place in the stream every ``STRIDE`` steps.
What lies between two checkpoints decodes without the rest of its block, and must
end in exactly the states of the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANES = 32
#: Tokens of a block, and steps between checkpoints.
BLOCK, STRIDE = 65_536, 512
LOW = np.uint64(1 << 31)
HALF = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequencies by token (0: does not occur), their running sums, and the token of every slot."""

    bits: int
    freq: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        """Scale counts to a power of two; whatever occurs keeps at least one slot."""
        counts = np.asarray(counts, np.float64)
        seen = np.flatnonzero(counts)
        bits = max(12, int(len(seen)).bit_length() + 4)
        freq = np.zeros(len(counts), np.int64)
        if not len(seen):
            return cls(bits, freq)
        spare = 2**bits - len(seen)
        share = counts[seen] / counts[seen].sum() * spare
        whole = np.floor(share).astype(np.int64)
        left = spare - int(whole.sum())  # goes to the largest remainders, ties to the smaller token
        whole[np.argsort(whole - share, kind="stable")[:left]] += 1
        freq[seen] = whole + 1
        return cls(bits, freq)

    def __post_init__(self) -> None:
        # one token more than there are: it owns every slot, so that coding it changes no state
        f = np.append(self.freq, 2**self.bits)
        start = np.append(np.cumsum(self.freq) - self.freq, 0)
        for name, value in (("wide", f.astype(np.uint64)), ("start", start.astype(np.uint64))):
            object.__setattr__(self, name, value)
        object.__setattr__(self, "slot", np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq))

    @property
    def idle(self) -> int:
        return len(self.freq)


@dataclass(frozen=True)
class Block:
    """A coded block: number of tokens, words, states and place in the words at every checkpoint."""

    n: int
    words: np.ndarray
    states: np.ndarray
    places: np.ndarray


def steps_of(n: int) -> int:
    return -(-n // LANES)


def encode(table: Table, blocks: list[np.ndarray]) -> list[Block]:
    """Code each block of tokens (at least one token each)."""
    steps = [steps_of(len(b)) for b in blocks]
    high = max(steps)
    tokens = np.full((len(blocks), high * LANES), table.idle, np.int32)
    for row, b in zip(tokens, blocks):
        row[: len(b)] = b
    tokens = np.ascontiguousarray(tokens.reshape(len(blocks), high, LANES).transpose(1, 0, 2))
    bits, x = np.uint64(table.bits), np.full(tokens.shape[1:], LOW, np.uint64)
    shed = np.zeros(tokens.shape, bool)
    word = np.zeros(tokens.shape, np.uint32)
    kept = np.zeros((-(-high // STRIDE), *x.shape), np.uint64)
    room = np.uint64(63 - table.bits)
    for t in range(high - 1, -1, -1):
        f = table.wide[tokens[t]]
        full = x >= f << room
        if full.any():
            shed[t] = full
            word[t] = x & np.uint64(0xFFFFFFFF)
            x = np.where(full, x >> HALF, x)
        q = x // f
        x = (q << bits) + (x - q * f) + table.start[tokens[t]]
        if t % STRIDE == 0:
            kept[t // STRIDE] = x
    shed, word = shed.transpose(1, 0, 2), word.transpose(1, 0, 2)
    out = []
    for i, b in enumerate(blocks):
        marks = -(-steps[i] // STRIDE)
        per = np.concatenate(([0], np.cumsum(shed[i].sum(axis=1))))
        out.append(Block(len(b), word[i][shed[i]], kept[:marks, i], per[np.arange(marks) * STRIDE].astype(np.uint32)))
    return out


def decode(table: Table, blocks: list[Block]) -> list[np.ndarray]:
    """The tokens of each block; raises ValueError where a stretch does not end as its checkpoints say."""
    units = [(i, c) for i, b in enumerate(blocks) for c in range(len(b.places))]
    words = np.concatenate([b.words for b in blocks] + [np.zeros(LANES, np.uint32)]).astype(np.uint64)
    base = np.cumsum([0] + [len(b.words) for b in blocks])
    size = np.array([min(blocks[i].n - c * STRIDE * LANES, STRIDE * LANES) for i, c in units])
    at = np.array([base[i] + int(blocks[i].places[c]) for i, c in units])
    end = np.array([base[i] + (int(blocks[i].places[c + 1]) if c + 1 < len(blocks[i].places) else len(blocks[i].words)) for i, c in units])
    x = np.array([blocks[i].states[c] for i, c in units], np.uint64)
    aim = np.array([blocks[i].states[c + 1] if c + 1 < len(blocks[i].places) else np.full(LANES, LOW) for i, c in units])
    bits, mask = np.uint64(table.bits), np.uint64(2**table.bits - 1)
    high, whole = steps_of(int(size.max())), int(size.min()) // LANES
    out = np.empty((high, len(units), LANES), np.int32)
    lane = np.arange(LANES)
    for t in range(high):
        low = x & mask
        token = table.slot[low.astype(np.int64)]
        out[t] = token
        y = table.wide[token] * (x >> bits) + low - table.start[token]
        ask = y < LOW
        if t >= whole:  # lanes behind the end of their stretch keep their state
            live = t * LANES + lane < size[:, None]
            y, ask = np.where(live, y, x), ask & live
        rank = np.cumsum(ask, axis=1)
        take = np.minimum(at[:, None] + rank - 1, len(words) - 1)
        x = np.where(ask, (y << HALF) | words[take], y)
        at = at + rank[:, -1]
    if not (np.array_equal(x, aim) and np.array_equal(at, end)):
        raise ValueError("a coded block does not end as its checkpoints say")
    out = out.transpose(1, 0, 2).reshape(len(units), -1)
    parts: list[list[np.ndarray]] = [[] for _ in blocks]
    for (i, _), row, n in zip(units, out, size.tolist()):
        parts[i].append(row[:n])
    return [np.concatenate(p) for p in parts]
