"""Static range asymmetric numeral system over token ids, many lanes at a time.

A block is a run of ids. Its lanes take the ids in turn, each with a state of its own, and all
lanes share one frequency table and one stream of 32-bit words. Blocks don't depend on each
other, so any of them can be decoded alone; several are coded at once for speed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANES = 256
BLOCK_IDS = 1 << 16
TOGETHER = 8
#: Ids below this are counted and numbered by a table, larger ones by sorting.
TABLED = 1 << 22
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Table:
    """Ids and their shares of 2 ** bits."""

    symbols: np.ndarray
    shares: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        if len(ids) and int(ids.max()) < TABLED:
            counts = np.bincount(ids)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        bits = max(16, int(len(symbols)).bit_length() + 2)
        whole = 1 << bits
        shares = np.maximum(1, counts * whole // max(1, counts.sum())).astype(np.int64)
        order = np.argsort(-shares, kind="stable")
        rest = whole - int(shares.sum())
        if rest > 0 and len(shares):
            shares[order[0]] += rest
        for at in order:
            if rest >= 0:
                break
            less = min(-rest, int(shares[at]) - 1, max(1, int(shares[at]) // 2))
            shares[at] -= less
            rest += less
        return cls(symbols.astype(np.uint32), shares.astype(np.uint64), bits)

    def starts(self) -> np.ndarray:
        return np.cumsum(self.shares) - self.shares


def _codes(ids: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The place of each id among the symbols."""
    if not len(symbols) or int(symbols[-1]) >= TABLED:
        return np.searchsorted(symbols, ids)
    places = np.zeros(int(symbols[-1]) + 1, np.int64)
    places[symbols] = np.arange(len(symbols))
    return places[ids]


def encode(ids: np.ndarray, table: Table) -> list[bytes]:
    """The blocks: final states of the lanes, then words in the order of decoding."""
    codes = _codes(ids, table.symbols)
    whole = len(ids) // BLOCK_IDS
    out: list[bytes] = []
    for lo in range(0, whole, TOGETHER):
        hi = min(whole, lo + TOGETHER)
        part = codes[lo * BLOCK_IDS : hi * BLOCK_IDS]
        out += _encode(part.reshape(hi - lo, -1, LANES), table)
    if len(rest := codes[whole * BLOCK_IDS :]):
        rest = np.concatenate([rest, np.zeros(-len(rest) % LANES, rest.dtype)])
        out += _encode(rest.reshape(1, -1, LANES), table)
    return out


def _encode(codes: np.ndarray, table: Table) -> list[bytes]:
    blocks, steps, _ = codes.shape
    shares, starts = table.shares, table.starts()
    bits, top = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full((blocks, LANES), _LOW)
    words = np.zeros((blocks, steps, LANES), np.uint32)
    sent = np.zeros((blocks, steps, LANES), bool)
    for t in range(steps - 1, -1, -1):
        share, start = shares[codes[:, t]], starts[codes[:, t]]
        full = state >= share << top
        words[:, t], sent[:, t] = state & _MASK, full
        state = np.where(full, state >> _WORD, state)
        times = state // share
        state = (times << bits) + (state - times * share) + start
    return [
        state[b].astype("<u8").tobytes() + words[b][sent[b]].astype("<u4").tobytes()
        for b in range(blocks)
    ]


def decode(blocks: list[bytes], counts: list[int], table: Table) -> np.ndarray:
    """The ids of consecutive blocks, given how many each has."""
    slots = np.repeat(np.arange(len(table.symbols)), table.shares.astype(np.int64))
    out = []
    for lo in range(0, len(blocks), TOGETHER):
        group = list(zip(blocks[lo : lo + TOGETHER], counts[lo : lo + TOGETHER], strict=True))
        full = [g for g in group if g[1] == BLOCK_IDS]
        for part in (full, *[[g] for g in group[len(full) :]]):
            if part:
                out += _decode(*zip(*part, strict=True), table, slots)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _decode(blocks, counts, table: Table, slots: np.ndarray) -> list[np.ndarray]:
    n, steps = len(blocks), -(-max(counts) // LANES)
    shares, starts = table.shares, table.starts()
    bits, low = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state = np.array([np.frombuffer(b, "<u8", LANES) for b in blocks], np.uint64)
    streams = [np.frombuffer(b, "<u4", offset=8 * LANES) for b in blocks]
    words = np.zeros((n, max(map(len, streams)) + 1), np.uint64)
    for b, stream in enumerate(streams):
        words[b, : len(stream)] = stream
    read = np.zeros((n, 1), np.int64)
    row = np.arange(n)[:, None]
    codes = np.zeros((n, steps, LANES), np.int64)
    for t in range(steps):
        slot = state & low
        code = slots[slot.astype(np.int64)]
        codes[:, t] = code
        state = shares[code] * (state >> bits) + slot - starts[code]
        short = state < _LOW
        place = read + np.cumsum(short, axis=1) - 1
        # A spoiled stream may want more words than it has; the check below tells.
        more = words[row, np.minimum(np.where(short, place, 0), words.shape[1] - 1)]
        state = np.where(short, (state << _WORD) | more, state)
        read += short.sum(axis=1, keepdims=True)
    if (state != _LOW).any() or any(r != len(s) for r, s in zip(read[:, 0], streams, strict=True)):
        raise ValueError("a block doesn't decode to its beginning")
    return [table.symbols[codes[b].reshape(-1)[:c]] for b, c in enumerate(counts)]
