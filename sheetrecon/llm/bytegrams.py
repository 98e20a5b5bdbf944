"""Byte n-grams of texts: counting in tasks, and lookup of values by n-gram
from hash arrays of bounded size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .common import segment_sums, words

#: Byte that starts (order - 1 times) and ends a text; words never hold it.
EDGE = b"\n"
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Distinct n-grams of batches that a task holds before it merges them.
HELD = 1 << 20
#: Entries of one broadcast array (12 bytes each).
ENTRIES = 4 << 20


def framed(text: bytes, order: int, bare: bool = False) -> bytes:
    """Words joined by one space between edge bytes (no word: empty, or with ``bare``
    the edges)."""
    tokens = words(text)
    return EDGE * (order - 1) + b" ".join(tokens) + EDGE if tokens or bare else b""


def gram_codes(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (first byte highest) of the n-grams of each framed part, and how
    many each part has (its bytes and the end)."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    lengths = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(lengths - (order - 1), 0)
    kind = np.uint32 if order <= 4 else np.uint64
    if not counts.sum():
        return np.zeros(0, kind), counts
    size = len(data) - order + 1
    code = data[:size].astype(kind)
    for i in range(1, order):
        code <<= kind(8)
        code |= data[i:i + size]
    inside = np.ones(len(data), bool)
    ends = np.cumsum(lengths)[lengths > 0]
    for i in range(1, order):
        inside[ends - i] = False
    return code[inside[:size]], counts


def group_hash(name: str | None) -> int:
    """32-bit number of a group (language) name; null is a group of its own."""
    return xxhash.xxh32_intdigest("\x00" if name is None else name)


def keyed(codes: np.ndarray, groups: np.ndarray, order: int) -> np.ndarray:
    """Uniform 64-bit keys of (group hash, n-gram); one to one while the groups' hashes
    differ in the bits that the n-gram leaves (24 of them for five bytes)."""
    return (codes.astype(np.uint64) | groups << np.uint64(8 * order)) * MIX


class HashArray:
    """Values by 64-bit key: keys sorted, with the start of each range of high
    bits, so a lookup reads one short run of the array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.start = np.append(self.start, len(keys)).astype(np.int32)

    def get(self, keys: np.ndarray, missing: float) -> np.ndarray:
        out = np.full(len(keys), missing, np.float32)
        if not len(self.keys):
            return out
        bucket = (keys >> self.shift).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        todo = None  # all, then those not found yet
        while True:
            live = at < end
            if not live.all():
                todo = np.flatnonzero(live) if todo is None else todo[live]
                at, end, keys = at[live], end[live], keys[live]
            if not len(at):
                return out
            same = self.keys[at] == keys
            where = np.flatnonzero(same) if todo is None else todo[same]
            out[where] = self.values[at[same]]
            rest = ~same
            todo = np.flatnonzero(rest) if todo is None else todo[rest]
            at, end, keys = at[rest] + 1, end[rest], keys[rest]


class GramCounter:
    """Counts n-grams by group within a task; holds the distinct ones only."""

    def __init__(self, order: int):
        self.order, self.held, self.size = order, {}, 0

    def add(self, group, parts: list[bytes]) -> None:
        codes, _ = gram_codes(parts, self.order)
        if len(codes):
            grams, counts = np.unique(codes, return_counts=True)
            self.held.setdefault(group, []).append((grams, counts))
            self.size += len(grams)
            if self.size > HELD:
                self.merge()

    def merge(self) -> None:
        self.size = 0
        for group, parts in self.held.items():
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([c for _, c in parts])).astype(np.int64)
            self.held[group] = [(grams, counts)]

    def batches(self, group_type: pa.DataType):
        self.merge()
        for group, [(grams, counts)] in self.held.items():
            for at in range(0, len(grams), 1 << 16):
                g, c = grams[at:at + (1 << 16)], counts[at:at + (1 << 16)]
                yield pa.record_batch({"grp": pa.array([group] * len(g), group_type),
                                       "gram": pa.array(g.astype(np.int64)), "n": pa.array(c.astype(np.int64))})


def doc_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return segment_sums(values.astype(np.float64), counts)
