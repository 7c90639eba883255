"""Word hashes of whole texts, vectorised over the texts of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer text is a group of its own.
GROUP_BYTES = 1 << 19

# Word bytes by the two rules of the contracts, after lower-casing A-Z.
_bytes = np.arange(256)
NOT_SPACE = ~((_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D)))
ALNUM = (_bytes >= 0x80) | ((_bytes >= 0x30) & (_bytes <= 0x39)) | ((_bytes >= 0x61) & (_bytes <= 0x7A))

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def multipliers(n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers, the same everywhere."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


@dataclass
class Words:
    """Words of a group of texts in order: hash, byte span, and where each text's words begin."""

    first_row: int
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # of text k: words bounds[k] to bounds[k + 1]
    text_starts: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def hashed_words(first_row: int, texts: list[bytes | None], is_word: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    joined = b"\n".join([t or b"" for t in texts])
    if lower:
        joined = joined.lower()
    lengths = np.fromiter((len(t) if t else 0 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate(([0], np.cumsum(lengths + 1)))
    buf = np.frombuffer(joined, dtype=np.uint8)
    mask = is_word[buf] if len(buf) else np.zeros(0, dtype=bool)
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if len(starts):
        lens = ends - starts
        letters = buf[mask].astype(np.uint64) + np.uint64(1)
        firsts = np.cumsum(lens) - lens
        powers = np.cumprod(np.full(int(lens.max()), _BASE, dtype=np.uint64))
        within = np.arange(len(letters)) - np.repeat(firsts, lens)
        hashes = mixed(np.add.reduceat(letters * powers[within], firsts) ^ lens.astype(np.uint64))
    else:
        hashes = np.zeros(0, dtype=np.uint64)
    bounds = np.searchsorted(starts, text_starts)
    bounds[-1] = len(starts)
    return Words(first_row, buf, starts, ends, hashes, bounds, text_starts)


def groups_of(texts: list[bytes | None], is_word: np.ndarray = NOT_SPACE, lower: bool = True) -> Iterator[Words]:
    """``texts`` in groups of bounded bytes, in order."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if k > first and size + n > GROUP_BYTES:
            yield hashed_words(first, texts[first:k], is_word, lower)
            first, size = k, 0
        size += n + 1
    if first < len(texts):
        yield hashed_words(first, texts[first:], is_word, lower)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def window_hashes(hashes: np.ndarray, offsets: tuple[int, ...], salt: int = 0) -> np.ndarray:
    """Of each position, the hash of the words at ``offsets`` from it; as long as all offsets fit in."""
    n = max(0, len(hashes) - offsets[-1])
    out = np.full(n, np.uint64(salt), dtype=np.uint64)
    for o, m in zip(offsets, multipliers(len(offsets)), strict=True):
        out += hashes[o : o + n] * m
    return mixed(out)


def int64_list(parts: list[np.ndarray]) -> pa.Array:
    """A list<int64> column from arrays of 64-bit words."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
