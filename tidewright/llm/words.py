"""Words of whole text columns as numpy arrays: used inside Arrow batches, where Spark has dealt out the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidewright.llm.common import remembered

_rng = np.random.default_rng(20240601)
#: Fixed random weights of byte values, and odd multipliers of the polynomial hashes (all arithmetic is modulo 2**64).
BYTE_WEIGHTS = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE_BYTE, BASE_A, BASE_B = (np.uint64(int(x) * 8 + 3) for x in _rng.integers(2**58, 2**60, 3))
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: For matching regardless of punctuation: words of letters, digits and bytes of multi-byte characters.
LETTERS_DIGITS = np.zeros(256, dtype=bool)
LETTERS_DIGITS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32
BLOCK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse, as far as asked for."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 2**64))
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, dtype=np.uint64)]), dtype=np.uint64) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_byte_powers, _powers = Powers(BASE_BYTE), {"a": Powers(BASE_A), "b": Powers(BASE_B)}


class Sums:
    """Prefix sums of a sequence of hashes: the hash of any stretch of it in constant time."""

    def __init__(self, hashes: np.ndarray, which: str = "a"):
        up, self.down = _powers[which].to(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


class Block:
    """Consecutive rows of a text column: data (bytes), offsets of rows; starts, ends (in data) and row of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int, word_bytes: np.ndarray = NOT_SPACE):
        self.data, self.offsets, self.first_row, self.n_rows = data, offsets, first_row, len(offsets) - 1
        word = word_bytes[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        at = offsets[:-1][offsets[:-1] < len(data)]
        begins[at] = word[at]
        at = offsets[1:][offsets[1:] > 0] - 1
        ends[at] = word[at]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(offsets, self.starts, side="right") - 1
        #: First word of each row, and one past the last row's.
        self.first = np.searchsorted(self.row, np.arange(self.n_rows + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; long rows are taken in stretches, so memory stays within a few blocks."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + BLOCK_BYTES)))
            base = self.starts[i]
            piece = self.data[base : self.ends[j - 1]]
            up, down = _byte_powers.to(len(piece) + 1)
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(BYTE_WEIGHTS[piece] * up[: len(piece)], out=sums[1:])
            b, e = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = mix((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
            i = j
        return out


def blocks(texts: pa.Array, lower: bool = False, word_bytes: np.ndarray = NOT_SPACE) -> Iterator[Block]:
    """The rows of an Arrow string array in blocks of about BLOCK_BYTES (a longer row is a block of its own); null is empty."""
    remembered("blocks")
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK_BYTES, side="right")) - 1)
        piece = raw[offsets[i] : offsets[j]]
        yield Block(ASCII_LOWER[piece] if lower else piece, offsets[i : j + 1] - offsets[i], i, word_bytes)
        i = j
