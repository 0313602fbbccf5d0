"""Words of many texts at once, as numpy arrays, for use inside tasks.

A word is a run of bytes other than ASCII white space, with A-Z lowered. Words
are known by a 64-bit polynomial hash of random byte values, shingles by a mix
of their words' hashes. Texts are taken whole; a long one is scanned in parts
cut at white space, so the scan holds some arrays of about ``PART_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 19
LOT_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * BASE)[_LOWER]
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, PART_BYTES + 1024)
        table = np.full(size, BASE, dtype=np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


def _parts(data: bytes) -> Iterator[bytes]:
    """Parts of about PART_BYTES, cut after white space; a longer word stays whole."""
    at = 0
    while len(data) - at > PART_BYTES:
        view = np.frombuffer(data, np.uint8, count=min(len(data) - at - PART_BYTES, PART_BYTES), offset=at + PART_BYTES)
        gaps = np.flatnonzero(_SPACE[view])
        end = at + PART_BYTES + (int(gaps[0]) + 1 if len(gaps) else len(view))
        while not len(gaps) and end < len(data) and not _SPACE[data[end - 1]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    edge = np.diff(np.concatenate(([0], (~_SPACE[data]).view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the number of its words."""
    hashes, owners, joined, sizes, held, total = [], [], [], [], 0, 0

    def flush() -> None:
        nonlocal held
        if joined:
            data = np.frombuffer(b" ".join(joined), np.uint8)
            power = _power_table(len(data) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[data] * power[:len(data)], dtype=np.uint64)))
            start, end = spans(data)
            # Multiplied up to the same power wherever the word stands.
            hashes.append(mix64((sums[end] - sums[start]) * power[len(data) - start] * _unit(len(data))))
            bounds = np.cumsum([len(x) + 1 for x in joined])
            owners.append(np.asarray(sizes)[np.searchsorted(bounds, start, side="right")])
        joined.clear(), sizes.clear()
        held = 0

    for i, text in enumerate(texts):
        total = i + 1
        for part in _parts((text or "").encode("utf-8", "surrogatepass")):
            if held + len(part) > PART_BYTES:
                flush()
            joined.append(part)
            sizes.append(i)
            held += len(part) + 1
    flush()
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(total, np.int64)
    return np.concatenate(hashes), np.bincount(np.concatenate(owners), minlength=total)


def _unit(length: int) -> np.uint64:
    """The power that makes hashes of scans of different lengths comparable."""
    inverse = pow(int(BASE), -1, 1 << 64)
    return np.uint64(pow(inverse, length, 1 << 64))


def shingle_sets(texts: Iterable[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``words``-word shingles; a shorter text is one shingle."""
    hashes, counts = word_hashes(texts)
    k = np.uint64(0xD6E8FEB86659FD93)
    rolled = hashes[:max(0, len(hashes) - words + 1)].copy()
    for step in range(1, words):
        rolled = mix64(rolled * k + hashes[step:len(rolled) + step])
    at = 0
    for n in counts:
        if n >= words:
            yield np.unique(rolled[at:at + n - words + 1])
        elif n:
            short = np.full(1, n, dtype=np.uint64)
            for i in range(at, at + n):
                short = mix64(short * k + hashes[i:i + 1])
            yield short
        else:
            yield np.zeros(0, np.uint64)
        at += n


def _slices(sizes: list[int], limit: int) -> Iterator[slice]:
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield slice(at, i)
            at, held = i, 0
        held += size + 1
    if at < len(sizes):
        yield slice(at, len(sizes))


def by_bytes(texts: list, limit: int = LOT_BYTES) -> Iterator[slice]:
    """Slices of a list of texts with about ``limit`` characters each, one text at least."""
    return _slices([len(t) if t else 0 for t in texts], limit)


def lots(column: pa.Array, limit: int = LOT_BYTES) -> Iterator[tuple[slice, list[str | None]]]:
    """Slices of an Arrow column of texts with about ``limit`` bytes each, and their texts; only one slice's texts are Python's at a time."""
    for part in _slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield part, column[part].to_pylist()
