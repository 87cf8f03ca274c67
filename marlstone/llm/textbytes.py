"""Words and their hashes from Arrow text columns, whole batches at a time in numpy.

A word is a run of bytes that a 256-entry table marks; a second table folds
bytes (lower case, say) before hashing.  UTF-8 keeps ASCII separators out of
other characters, so bytes do where the separators are ASCII.

Hashes are differences of running polynomial sums modulo 2^64, scrambled, so
no word is handled by itself.  Texts are worked on in blocks of a megabyte,
cut between words: memory does not grow with the batch or with a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def table(separators: bytes) -> np.ndarray:
    """True for every byte but these."""
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


def lower_ascii() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


#: Fixed by the contracts: words are runs of anything but these.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than texts); nulls are empty texts."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in pieces of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _cut(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, at: int) -> int:
    """End of the block that starts at ``at``: never inside a word unless the word alone is longer than a block."""
    target = at + BLOCK
    if target >= len(data):
        return len(data)
    k = np.searchsorted(offsets, target, "right") - 1
    start = int(offsets[k])
    gaps = np.flatnonzero(~is_word[data[max(start, at + 1) : target]])
    if gaps.size:
        return max(start, at + 1) + int(gaps[-1])
    if start > at:
        return start
    stop = int(offsets[k + 1])
    for a in range(target, stop, BLOCK):
        gaps = np.flatnonzero(~is_word[data[a : min(stop, a + BLOCK)]])
        if gaps.size:
            return a + int(gaps[0])
    return stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of all texts, in order."""
    parts = list(_blocks(data, offsets, is_word, fold))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _blocks(data, offsets, is_word, fold) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    at = 0
    while at < len(data):
        stop = _cut(data, offsets, is_word, at)
        piece = fold[data[at:stop]]
        inside = is_word[data[at:stop]]
        # Where a text begins, a word cannot go on from the text before.
        begins = np.zeros(len(piece) + 1, dtype=bool)
        lo, hi = np.searchsorted(offsets, [at, stop], "left")
        begins[offsets[lo:hi] - at] = True
        begins[-1] = True
        before = np.concatenate([[False], inside[:-1]])
        after = np.concatenate([inside[1:], [False]])
        starts = np.flatnonzero(inside & (~before | begins[:-1]))
        ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        if len(piece) > BLOCK:  # a word longer than a block, at most one blank before it
            hashes = np.array([int.from_bytes(hashlib.blake2b(piece[s:e].tobytes(), digest_size=8).digest(), "little") for s, e in zip(starts, ends, strict=True)], dtype=np.uint64)
        else:
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum((piece.astype(np.uint64) + _U(1)) * _POWER[: len(piece)], out=sums[1:])
            hashes = mix((sums[ends] - sums[starts]) * _INVERSE[starts] ^ (ends - starts).astype(np.uint64))
        if len(starts):
            yield starts + at, ends + at, hashes
        at = stop


def word_places(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of all texts, in order; the bytes between are ``data[is_word[data]]``."""
    inside = is_word[data]
    # Where a text begins, a word cannot go on from the text before.
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | begins[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | begins[1:])) + 1
    return starts, ends


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of the words of each text among all words."""
    return np.searchsorted(starts, offsets, "left")


def summed(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each ``bounds[i]:bounds[i + 1]``, modulo 2^64; empty stretches have 0."""
    out = np.zeros(len(bounds) - 1, dtype=values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out


def sequence_hashes(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for the words of each text in their order."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
    one = summed(mix(hashes + mix(place + _U(1))), bounds)
    two = summed(mix((hashes ^ _U(0xD6E8FEB86659FD93)) * (_U(2) * place + _U(1))), bounds)
    return one, two


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and their offsets by text.

    A text with fewer words, but at least one, has its whole sequence as its
    only shingle.
    """
    count = np.diff(bounds)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(out_bounds[-1], dtype=np.uint64)
    long = np.flatnonzero(count >= width)
    first = np.repeat(bounds[:-1], made) + np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], made)
    length = np.repeat(np.minimum(count, width), made)
    for j in range(width):
        use = np.flatnonzero(length > j) if len(long) < len(count) else slice(None)
        out[use] = mix(out[use] * _U(0x9FB21C651E98DF25) + hashes[first[use] + j] + _U(j + 1))
    return out, out_bounds


def _majority(hashes: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Bits set in more than half of the hashes of each stretch, counted in numbers of ``width`` bits side by side."""
    count = np.diff(bounds).astype(np.uint64)
    low = np.uint64((1 << width) - 1)
    mask = np.uint64(sum(1 << at for at in range(0, 64, width)))
    out = np.zeros(len(count), dtype=np.uint64)
    for k in range(width):
        ones = summed(hashes >> np.uint64(k) & mask, bounds)
        for at in range(0, 64, width):
            out |= (np.uint64(2) * (ones >> np.uint64(at) & low) > count).astype(np.uint64) << np.uint64(at + k)
    return out


def simhash(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit SimHash of the hashes of each stretch, every occurrence with weight one: bits set in over half of them; zero for none."""
    count = np.diff(bounds)
    out = _majority(hashes, bounds, 8)
    # What those counters cannot hold is counted again in wider ones.
    for width, least in ((16, 1 << 8), (32, 1 << 16)):
        long = np.flatnonzero(count >= least)
        if len(long):
            inside = np.zeros(len(count), dtype=bool)
            inside[long] = True
            out[long] = _majority(hashes[np.repeat(inside, count)], np.concatenate([[0], np.cumsum(count[long])]), width)
    return out
