"""Cuts texts into runs of byte windows that share their least q-gram, so that equal windows fall under one key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

#: Bytes of text that are looked at together, and the base (odd, so invertible) of the rolling hash.
SLAB = 1 << 18
BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(b: int) -> np.ndarray:
        out = np.full(n, b & (1 << 64) - 1, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return of(BASE), of(pow(BASE, -1, 1 << 64))


def gram_hashes(data: np.ndarray, q: int, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A mixed 64-bit hash of the q bytes from each position on."""
    up, down = powers
    n = len(data) - q + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[q:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def window_extreme(x: np.ndarray, w: int, least: bool = True) -> np.ndarray:
    """Least (or greatest) of each w neighbours: running extremes of blocks of w, from both ends."""
    f, pad = (np.minimum, ~np.uint64(0)) if least else (np.maximum, np.uint64(0))
    n = len(x) - w + 1
    blocks = np.full(-(-len(x) // w) * w, pad, np.uint64)
    blocks[: len(x)] = x
    rows = blocks.reshape(-1, w)
    ahead = f.accumulate(rows, axis=1).reshape(-1)
    back = f.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return f(back[:n], ahead[w - 1 : w - 1 + n])


class Runs(NamedTuple):
    """Parts of texts and, of each run: its text, its part, where it starts in the part and the part in the text, how
    many windows it has, their least hash, and whether that may occur in it more than once."""

    parts: list[bytes]
    text: np.ndarray
    part: np.ndarray
    start: np.ndarray
    shift: np.ndarray
    windows: np.ndarray
    least: np.ndarray
    own: np.ndarray


class SuperWords:
    """Runs of neighbouring windows of `span` bytes whose least hash of q bytes is one value."""

    def __init__(self, span: int, q: int):
        self.span, self.q = span, q
        self.powers = powers(SLAB + 2 * span)

    def slab(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, windows, least hash, own): of texts laid end to end. own: the run's least q-gram may occur in it
        more than once, so that its windows may equal each other. No run leaves its text."""
        span, w = self.span, self.span - self.q + 1
        empty = np.zeros(0, np.int64)
        if len(data) < span:
            return empty, empty, np.zeros(0, np.uint64), np.zeros(0, bool)
        h = gram_hashes(data, self.q, self.powers)
        m = window_extreme(h, w)
        n = len(m)
        inside = np.ones(n, bool)
        for e in ends:  # windows that would leave their text
            inside[max(0, e - span + 1) : max(0, min(n, e))] = False
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (m[1:] != m[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], n)
        gaps = np.flatnonzero(~inside)
        if len(gaps):
            at = np.searchsorted(gaps, start)
            stop = np.minimum(stop, np.where(at < len(gaps), gaps[np.minimum(at, len(gaps) - 1)], n))
        # positions whose hash is the least of some window; equal neighbours among them repeat in one run
        padded = np.concatenate([np.zeros(w - 1, np.uint64), m, np.zeros(w - 1, np.uint64)])
        chosen = np.flatnonzero(window_extreme(padded, w, False)[: len(h)] == h)
        equal = np.append(h[chosen[1:]] == h[chosen[:-1]], False).cumsum() if len(chosen) else np.zeros(1, np.int64)
        lo = np.searchsorted(chosen, start)
        hi = np.searchsorted(chosen, stop - 1 + w)
        before = np.where(lo > 0, equal[np.maximum(lo - 1, 0)], 0)
        own = (hi - lo >= 2) & (equal[np.maximum(hi - 2, 0)] > before)
        return start, stop - start, m[start], own

    def runs(self, texts: Iterable[bytes]) -> Iterator[Runs]:
        """The runs of all texts, a few texts at a time; long texts go slab by slab, with overlap."""
        group: list[tuple[int, int, bytes]] = []
        size = 0
        for k, t in enumerate(texts):
            if len(t) < self.span:
                continue
            for at in range(0, max(1, len(t) - self.span + 1), SLAB):
                part = t[at : at + SLAB + self.span - 1]
                if group and size + len(part) > SLAB + self.span:
                    yield self._flush(group)
                    group, size = [], 0
                group.append((k, at, part))
                size += len(part)
        if group:
            yield self._flush(group)

    def _flush(self, group: list[tuple[int, int, bytes]]) -> Runs:
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        start, windows, least, own = self.slab(np.frombuffer(b"".join(p for _, _, p in group), np.uint8), ends)
        part = np.searchsorted(ends, start, side="right")
        return Runs([p for _, _, p in group], np.array([k for k, _, _ in group])[part], part, start - (ends - sizes)[part], np.array([at for _, at, _ in group])[part], windows, least.view(np.int64), own)
