"""Words of whole texts in flat arrays, and hashes of many runs of bytes at once.

A word is a maximal run of digits, letters a-z (A-Z become these) and characters beyond ASCII,
or of all but white space. The characters beyond ASCII are bytes of 128 or more in UTF-8, so texts
are cut on bytes.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cache, reduce
from operator import xor

import numpy as np
import pyarrow as pa
import xxhash

ASCII_WORD = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[list(ASCII_WORD)] = True
IN_WORD[128:] = True
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[list(b" \t\n\x0b\x0c\r")] = False
LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)

CRC_POLYNOMIAL = 0xEDB88320  # of the usual crc32, lowest bit first
POSITIONS = 64  # distances from the end with a table of their own


@dataclass(frozen=True)
class Words:
    """Words of several texts: their bytes without anything between them, and their borders."""

    data: np.ndarray  # uint8
    starts: np.ndarray  # int64, one more than there are words
    per_text: np.ndarray  # int64, number of words of each text

    def array(self) -> pa.Array:
        """The words as an Arrow array of strings."""
        buffers = [None, pa.py_buffer(self.starts), pa.py_buffer(self.data)]
        return pa.Array.from_buffers(pa.large_string(), len(self.starts) - 1, buffers)

    def text_of(self) -> np.ndarray:
        """Number of the text that each word is from."""
        return np.repeat(np.arange(len(self.per_text)), self.per_text)


def words_of(texts: pa.Array, in_word: np.ndarray = IN_WORD) -> Words:
    """Words of an array of strings; null has none. ``in_word`` tells which bytes a word has."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", dtype=np.uint8)[at[0] : at[-1]]
    borders = at - at[0]
    inside = in_word[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = borders[:-1][borders[:-1] < len(raw)]
    begins[first] = inside[first]  # a word never runs on into the next text
    kept = LOWER[raw[inside]]
    starts = np.append(np.flatnonzero(begins[inside]), len(kept)).astype(np.int64)
    per_text = np.diff(np.searchsorted(np.flatnonzero(begins), borders))
    return Words(kept, starts, per_text)


# --- 64-bit hashes of words ------------------------------------------------------------

BYTES_AT_ONCE = 1 << 20  # bytes of words hashed together


@cache
def _byte_numbers() -> np.ndarray:
    """A fixed random number for a byte at a place in a word, at 256 * place + byte."""
    places = range(256 * POSITIONS)
    return np.array([xxhash.xxh3_64_intdigest(p.to_bytes(4, "little")) for p in places], np.uint64)


def word_hash(word: bytes) -> int:
    """Hash of one word: exclusive or of the numbers of its bytes; xxh3 of a long word."""
    if len(word) > POSITIONS:
        return xxhash.xxh3_64_intdigest(word)
    numbers = _byte_numbers()
    return reduce(xor, (int(numbers[256 * i + b]) for i, b in enumerate(word)), 0)


def word_hashes(words: Words) -> np.ndarray:
    """``word_hash`` of every word."""
    data, starts = words.data, words.starts
    sizes = np.diff(starts)
    out = np.empty(len(sizes), dtype=np.uint64)
    first = 0
    while first < len(sizes):
        # Whole words of about BYTES_AT_ONCE bytes; a longer one comes alone, and is hashed below.
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + BYTES_AT_ONCE, "right")) - 1)
        if starts[last] - starts[first] <= BYTES_AT_ONCE:
            own = starts[first:last] - starts[first]
            block = data[starts[first] : starts[last]]
            place = np.arange(len(block)) - np.repeat(own, sizes[first:last])
            at = (np.minimum(place, POSITIONS - 1) << 8) + block
            out[first:last] = np.bitwise_xor.reduceat(_byte_numbers()[at], own)
        first = last
    for i in np.flatnonzero(sizes > POSITIONS):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i + 1]].tobytes())
    return out


# --- crc32 -----------------------------------------------------------------------------
#
# Apart from a constant of the length, crc32 is linear: it is the exclusive or of what every
# byte contributes by its value and its distance from the end.


@cache
def _contributions() -> np.ndarray:
    """What a byte at a distance from the end adds, at 256 * distance + byte."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(CRC_POLYNOMIAL), one >> 1)
    rows = [one]
    for _ in range(POSITIONS - 1):
        rows.append(one[rows[-1] & 0xFF] ^ (rows[-1] >> 8))
    return np.concatenate(rows)


@cache
def _length_constants() -> np.ndarray:
    return np.array([zlib.crc32(bytes(n)) for n in range(POSITIONS + 1)], dtype=np.uint32)


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of the spans of bytes that begin at ``starts``; spans may overlap."""
    out = np.zeros(len(starts), dtype=np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= POSITIONS))
    if len(short):
        n = lengths[short]
        ends = np.cumsum(n)
        inner = np.arange(ends[-1]) - np.repeat(ends - n, n)
        place = (np.repeat(n, n) - 1 - inner) * 256 + data[np.repeat(starts[short], n) + inner]
        sums = np.bitwise_xor.reduceat(_contributions()[place], ends - n)
        out[short] = sums ^ _length_constants()[n]
    for i in np.flatnonzero(lengths > POSITIONS):
        out[i] = _long_crc32(data[starts[i] : starts[i] + lengths[i]])
    return out


def _long_crc32(span: np.ndarray) -> int:
    """crc32 of one long span: blocks of ``POSITIONS`` bytes, then pairs of neighbours folded.

    Zero bytes in front add nothing, so the first block and an odd block are filled with them.
    """
    blocks = np.zeros((-(-len(span) // POSITIONS), POSITIONS), dtype=np.uint8)
    blocks.reshape(-1)[-len(span) :] = span
    distance = np.arange(POSITIONS - 1, -1, -1) * 256
    sums = np.zeros(len(blocks), dtype=np.uint32)
    for a in range(0, len(blocks), 1 << 14):
        part = _contributions()[blocks[a : a + (1 << 14)] + distance]
        sums[a : a + (1 << 14)] = np.bitwise_xor.reduce(part, axis=1)
    # Moving a sum over the zeros of one block: its four bytes are bytes of the message.
    move = _contributions().reshape(POSITIONS, 256)[POSITIONS - 1 - np.arange(4)]
    while len(sums) > 1:
        if len(sums) % 2:
            sums = np.append(np.uint32(0), sums)
        sums = _moved(move, sums[::2]) ^ sums[1::2]
        move = _moved(move, move)
    return int(sums[0]) ^ zlib.crc32(bytes(len(span)))


def _moved(move: np.ndarray, sums: np.ndarray) -> np.ndarray:
    found = move[0][sums & 0xFF]
    for p in range(1, 4):
        found = found ^ move[p][(sums >> np.uint32(8 * p)) & 0xFF]
    return found
