"""Hashes of the words of many texts at once, over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1_000_000
PIECE_BYTES = 250_000
ODD = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bytes(separators: bytes) -> np.ndarray:
    """Which byte values belong to words. Separators are ASCII, so no character is cut."""
    keep = np.ones(256, bool)
    keep[list(separators)] = False
    return keep


#: Words end at white space.
SPACED = word_bytes(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words are of letters and digits, and of all that is not ASCII.
ALNUM = word_bytes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(ODD), -1, 2**64))
            steps = np.full(n - 1, ODD), np.full(n - 1, inverse)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(s, dtype=np.uint64)]) for s in steps)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of bytes by powers of an odd number; a difference of two, taken to power 0, hashes what is between."""
    up, _ = _powers.get(len(data))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)])


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Group:
    """Words of the texts ``first`` to ``first + len(bounds) - 1``; those of text i lie at bounds[i]:bounds[i + 1]."""

    first: int
    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    lowered: np.ndarray

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n words in a row, by their first word, and which of them lie inside one text."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        out = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            out = out * ODD + mix(self.hashes[k : total - n + 1 + k] + np.uint64(k))
        inside = np.ones(total - n + 1, bool)
        for b in self.bounds[1:-1]:
            inside[max(0, b - n + 1) : b] = False
        return mix(out + np.uint64(n)), inside

    def word(self, k: int) -> str:
        return self.lowered[self.starts[k] : self.ends[k]].tobytes().decode()


def _piece(lowered: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges = np.diff(keep[lowered].astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return spans_hash(prefix_sums(lowered), starts, ends), starts, ends


def _hash_all(lowered: np.ndarray, keep: np.ndarray) -> list[np.ndarray]:
    """In pieces that end between words, so that memory for sums is bounded."""
    parts, at = [], 0
    while at < len(lowered) or not parts:
        end = at + PIECE_BYTES
        while end < len(lowered) and (gap := np.flatnonzero(~keep[lowered[end : end + 65_536]])).size == 0:
            end += 65_536
        end = len(lowered) if end >= len(lowered) else end + int(gap[0])
        h, s, e = _piece(lowered[at:end], keep)
        parts.append((h, s + at, e + at))
        at = end
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def groups(texts: pa.Array, keep: np.ndarray) -> Iterator[Group]:
    """The texts (null: empty) in groups of about a million bytes, or one large text each."""
    held: list[bytes] = []
    size = first = 0

    def make() -> Group:
        lengths = np.array([len(t) + 1 for t in held])
        lowered = LOWER[np.frombuffer(b"\n".join(held), np.uint8)]
        hashes, starts, ends = _hash_all(lowered, keep)
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        return Group(first, bounds, hashes, starts, ends, lowered)

    for text in texts:
        data = (text.as_py() or "").encode()
        if held and size + len(data) > GROUP_BYTES:
            yield make()
            first, held, size = first + len(held), [], 0
        held.append(data)
        size += len(data)
    if held:
        yield make()
