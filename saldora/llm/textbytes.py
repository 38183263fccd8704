"""Vectorised helpers on UTF-8 bytes, for use inside Arrow tasks.

A slice is a run of documents whose bytes lie next to each other: ``data`` (uint8) and
``offsets`` (document i is ``data[offsets[i]:offsets[i + 1]]``). Working on slices of about
a megabyte bounds the memory of a task whatever the size of its partition; one longer
document is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_GOLD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2 ** 64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    x = x + np.uint64(_GOLD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(256, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** 0..n and the inverses, modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = max(1 << n.bit_length(), 1 << 16) + 1
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        have = _powers[base] = (both[0], both[1])
    return have


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE):
    """64-bit hash of each ``codes[start:end]``; equal content gives equal hashes."""
    n = len(codes)
    power, inverse = _power(base, n)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(codes * power[:n], out=total[1:])
    size = (ends - starts).astype(np.uint64)
    return mix((total[ends] - total[starts]) * inverse[starts] + size * np.uint64(_GOLD))


def window_hashes(codes: np.ndarray, width: int, base: int = 0xA3EC647659359ACD) -> np.ndarray:
    """Hash of every run of ``width`` codes, by its first position."""
    if len(codes) < width:
        return np.zeros(0, dtype=np.uint64)
    starts = np.arange(len(codes) - width + 1)
    return span_hashes(codes, starts, starts + width, base)


def byte_table(other: bytes) -> np.ndarray:
    """True for bytes of words: all but ``other``."""
    table = np.ones(256, dtype=bool)
    table[list(other)] = False
    return table


SPACE = byte_table(b" \t\n\x0b\x0c\r")


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACE):
    """Starts and ends of the words of a slice, and how many words lie before each document."""
    inside = table[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_BYTE_CODE[data], starts, ends)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.fill_null("") if not pa.types.is_binary(column.type) else column.fill_null(b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, bytes_ = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bytes_, dtype=np.uint8) if bytes_ else np.zeros(0, dtype=np.uint8)
    return data, offsets


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, data, offsets) of runs of rows with about ``most`` bytes of ``column``; null is empty."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        data, offsets = _buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(n, max(at + 1, to))
            own = offsets[at : to + 1]
            yield batch.slice(at, to - at), data[own[0] : own[-1]], own - own[0]
            at = to
