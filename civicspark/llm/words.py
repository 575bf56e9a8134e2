"""Words of many texts hashed at once, straight from Arrow's buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed in one go: their arrays stay in cache. A longer text is cut between words.
CHUNK = 1 << 18
STEP = 0x9E3779B97F4A7C15
#: A random number for each byte value.
BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``STEP`` and of its inverse; those of the usual chunk are kept."""
    if n in _POWERS:
        return _POWERS[n]
    out = []
    for base in (STEP, pow(STEP, -1, 2**64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    if n == CHUNK:
        _POWERS[n] = out[0], out[1]
    return out[0], out[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32) if len(column) else np.zeros(1, np.int64)
    bounds = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2] if len(column) else None
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def _cut(data: np.ndarray, bounds: np.ndarray, lo: int, end: int) -> int:
    """Where the next chunk ends: at a text's end or a white space, never inside a word."""
    hi = lo + CHUNK
    if hi >= end:
        return end
    at = int(bounds[np.searchsorted(bounds, hi, "right") - 1])
    if at > lo:
        return at
    piece = data[lo:hi]
    gaps = np.flatnonzero((piece == 32) | ((piece >= 9) & (piece <= 13)))
    if len(gaps):
        return lo + int(gaps[-1]) + 1
    stop = int(bounds[np.searchsorted(bounds, lo, "right")])
    while hi < stop and not (data[hi] == 32 or 9 <= data[hi] <= 13):
        hi += 1
    return hi


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each word with A-Z lower-cased, the index of each text's first word (one more
    entry than texts), and the place of each word's last byte.

    A word's hash is a polynomial over its bytes, taken from running sums, so a chunk of texts
    needs a handful of array operations and no loop over words.
    """
    hashes, starts, lasts = [], [], []
    lo, end = int(bounds[0]), int(bounds[-1])
    while lo < end:
        hi = _cut(data, bounds, lo, end)
        piece = data[lo:hi]
        piece = piece + (((piece >= 65) & (piece <= 90)).astype(np.uint8) << 5)
        word = ~((piece == 32) | ((piece >= 9) & (piece <= 13)))
        edge = np.zeros(len(piece) + 1, bool)
        inside = bounds[np.searchsorted(bounds, lo) : np.searchsorted(bounds, hi, "right")] - lo
        edge[inside] = True
        edge[0] = edge[-1] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:-1]
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:-1]
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        powers, inverse = _powers(max(CHUNK, 1 << (len(piece) - 1).bit_length()))
        total = np.cumsum(BYTE[piece] * powers[: len(piece)])
        before = np.where(first > 0, total[first - 1], np.uint64(0))
        hashes.append(mix((total[last] - before) * inverse[first] + (last - first).astype(np.uint64)))
        starts.append(first + lo)
        lasts.append(last + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), bounds), np.concatenate(lasts)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words of each text, repeats included, and the index of each
    text's first. A text of fewer words has one shingle, its whole sequence; one without words none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    at = np.concatenate([[0], np.cumsum(n)])
    index = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
    left = np.repeat(first[1:], n) - index
    out = np.zeros(len(index), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for j in range(width):
        factor = np.uint64((STEP * (2 * j + 3)) & (2**64 - 1) | 1)
        out += np.where(left > j, padded[index + j] * factor, np.uint64(0))
    return mix(out + np.minimum(left, width).astype(np.uint64)), at


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts have about ``most`` bytes; a longer text is a run of its own."""
    _, bounds = text_bytes(batch[column])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Whole groups of rows sorted by ``keys``, whatever the batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        if held and any(held[-1][k][-1].as_py() != batch[k][0].as_py() for k in keys):
            new = np.concatenate([[0], new])
        at = 0
        for cut in new:
            held.append(batch.slice(at, cut - at))
            yield pa.concat_batches(held)
            held, at = [], int(cut)
        held.append(batch.slice(at))
    if held:
        yield pa.concat_batches(held)
