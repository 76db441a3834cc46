"""Words, windows and lines of many texts at once, as numpy arrays over their UTF-8 bytes.

A word class is a table of 256 entries: 0 for bytes that separate words, else the byte a word
keeps (so a table can also lower-case). Bytes of 128 and more always belong to words, hence a
class that names ASCII characters only acts on whole code points. Hashes have 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 (splitmix64's constants)."""
    z = values.astype(_U, copy=True)
    z ^= z >> _U(30)
    z *= _U(0xBF58476D1CE4E5B9)
    z ^= z >> _U(27)
    z *= _U(0x94D049BB133111EB)
    z ^= z >> _U(31)
    return z


_BYTE = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


_tables: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and its inverse: one pair of tables per process, of the largest n so far."""
    if not _tables or len(_tables[0]) <= n:
        size = 1 << int(n).bit_length()
        _tables[:] = [_powers(_BASE, size), _powers(_INVERSE, size)]
    return _tables[0], _tables[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    up, down = _power_tables(max(1 << 16, len(data)))
    prefix = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=prefix[1:], dtype=_U)
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the n + 1 offsets of the texts; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    if not len(texts) or buffer is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(buffer, dtype=np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def byte_class(separators: str, lower: bool = False) -> np.ndarray:
    """Table of a word class from its ASCII separators."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A"): ord("Z") + 1] += 32
    table[[ord(c) for c in separators]] = 0
    table[0] = 0 if "\0" in separators else 255  # 255 is no UTF-8 byte, so NUL stays a letter of its own
    return table


#: Words are what white space of ASCII separates.
SPACED = byte_class(" \t\n\v\f\r")
#: Words are runs of digits, letters and non-ASCII characters, lower-cased in ASCII.
PLAIN = byte_class("".join(chr(i) for i in range(128) if not chr(i).isalnum()), lower=True)


@dataclass
class Words:
    """Words in order: document index, byte span, hash; first[i] is document i's first word."""

    data: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of `size` words that lies in one document."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        total = np.zeros(n, dtype=_U)
        for k in range(size):
            total *= _U(_BASE)
            total += self.hash[k: k + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1:])
        return at, mixed(total[at] + _U(size))


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    data, offsets = text_bytes(texts)
    kept = table[data]
    inside = kept != 0
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[filled] = inside[filled]
    finishes[filled[1:] - 1] = inside[filled[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(kept, doc, start, end, span_hashes(kept, start, end), first)


def per_document(weights: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer weights per document index."""
    return np.bincount(doc, weights=weights, minlength=n).astype(np.int64)


def joined_words(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one blank after each, and where each word begins and ends there."""
    lengths = words.end - words.start
    end = np.cumsum(lengths + 1) - 1
    begin = end - lengths
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    at = np.repeat(begin - words.start, lengths) + (inside := np.repeat(words.start - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum()))
    out[at] = words.data[inside]
    return out.tobytes(), begin, end


def code_points(data: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, and after the last one."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
