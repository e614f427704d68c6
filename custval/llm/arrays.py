"""NumPy views of Arrow batches: bytes, words and word hashes.

The helpers work on blocks of whole texts (about ``BLOCK_BYTES``; one longer
text is a block of its own), so the temporary arrays stay small whatever the
size of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

#: space, \t, \n, \v, \f, \r
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: a nonzero random value per byte, zero for white space
BYTE_VALUES = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
WORD_VALUES = np.where(_IS_SPACE, _U(0), BYTE_VALUES)
#: places in a word whose byte hashes come from a table
_PLACES = 64


def placed(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit number for each (value, place), zero for value zero.

    A word's hash is the sum over its bytes.  Each byte's part depends on its
    place through a full mix, not a product, so no two words cancel by their
    pattern as they would in a polynomial modulo a power of two.
    """
    out = mix64(mix64(values + places.astype(_U) * _U(0x9E3779B97F4A7C15)) ^ values)
    return np.where(values != 0, out, _U(0))


_TABLES: dict[bytes, np.ndarray] = {}


def _table(values: np.ndarray) -> np.ndarray:
    """``placed`` of every byte at the first places, flat by place and byte; made once for each set of values."""
    key = values.tobytes()
    if key not in _TABLES:
        _TABLES[key] = placed(np.tile(values, _PLACES), np.repeat(np.arange(_PLACES), 256))
    return _TABLES[key]


def binary_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary Arrow column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.binary())
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null(b"")
    wide = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    width = np.int64 if wide else np.int32
    offsets = np.frombuffer(col.buffers()[1], width)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of whole texts of about ``size`` bytes."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


class Words:
    """Words of a block: start and end bytes, the text each is in, and a 64-bit hash.

    ``values`` has a number per byte, zero for what separates words (by default
    white space ``[\\x20\\x09-\\x0D]``); words are equal if their numbers are.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, values: np.ndarray = WORD_VALUES):
        n = len(data)
        word = (values != 0)[data]
        inner = np.zeros(n + 1, bool)          # position i continues the word of position i - 1
        inner[1:n] = word[1:] & word[:-1]
        cut = offsets[1:-1]
        inner[cut[cut < n]] = False
        self.starts = np.flatnonzero(word & ~inner[:n])
        self.ends = np.flatnonzero(word & ~inner[1:]) + 1
        #: words of text i are first[i] .. first[i + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        if len(self.starts) == 0:
            self.hash = np.empty(0, _U)
            return
        lead = self.starts[0]
        nexts = np.append(self.starts[1:], n)
        rel = np.arange(lead, n) - np.repeat(self.starts, nexts - self.starts)
        body = data[lead:]
        near = np.minimum(rel, _PLACES - 1) * 256 + body
        parts = _table(values)[near]                    # what lies behind a word separates words, of number zero
        far = np.flatnonzero(rel >= _PLACES)
        if len(far):
            parts[far] = placed(values[body[far]], rel[far])
        self.hash = mix64(np.add.reduceat(parts, self.starts - lead))


def window_hashes(words: Words, size: int, base: np.uint64 = _U(0xD1342543DE82EF95)) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of every window of ``size`` consecutive words of one text: (first word, hash)."""
    h, n = words.hash, len(words.hash) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, _U)
    first = np.flatnonzero(words.doc[:n] == words.doc[size - 1:])
    total = np.zeros(n, _U)
    for k in range(size):
        total *= base
        total += h[k: k + n]
    return first, mix64(total[first])
