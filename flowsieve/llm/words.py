"""Vectorised word scanning: places and 64-bit hashes of all words of many texts at once.

Words are runs of bytes other than the six ASCII blanks. The hash is a
polynomial over random byte values modulo 2**64, taken from prefix sums and
mixed at the end, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np

_RANDOM = np.random.default_rng(20)
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (int(_RANDOM.integers(1 << 61, 1 << 62)) << 2 | 3) & (2**64 - 1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text scanned at once; a longer text is cut at blanks.
CHUNK = 1 << 18


class Words(NamedTuple):
    """Words of a group of texts: hash, first byte, last byte, and the text each belongs to (as offsets)."""

    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    offsets: np.ndarray  # words of text i are at offsets[i]:offsets[i + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def run(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def _scan(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buffer = np.frombuffer(raw, np.uint8)
    blank = np.ones(len(buffer) + 2, np.int8)
    blank[1:-1] = _BLANK[buffer]
    edges = np.flatnonzero(np.diff(blank))
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(16, (len(buffer) + 1).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_VALUE[buffer] * power[: len(buffer)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, buffer[starts], buffer[ends - 1], starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text cut at blanks into pieces of about a chunk; a word is never cut."""
    at = 0
    while at < len(raw):
        end = at + CHUNK
        while end < len(raw) and not _BLANK[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


def scan(texts: Iterable[bytes]) -> Words:
    """Words of the texts. Memory is a small multiple of a chunk plus 10 bytes a word."""
    parts: list[tuple] = []
    counts: list[int] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            found = _scan(b"\n".join(group))
            bounds = np.cumsum([0, *[len(g) + 1 for g in group]])
            counts.extend(np.diff(np.searchsorted(found[3], bounds)).tolist())
            parts.append(found[:3])
        group, held = [], 0

    for raw in texts:
        if len(raw) > CHUNK:
            flush()
            own = [_scan(piece)[:3] for piece in _pieces(raw)]
            parts.extend(own)
            counts.append(sum(len(p[0]) for p in own))
            continue
        group.append(raw)
        held += len(raw)
        if held >= CHUNK:
            flush()
    flush()
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.uint8)]
    return Words(*columns, np.cumsum([0, *counts]))
