"""Words of whole Arrow text columns as arrays of 64-bit hashes, vectorised over many documents at once.

Texts are handled as UTF-8 bytes; null counts as empty. Work goes in pieces of about one megabyte, cut between documents
and, in longer documents, at word breaks, so memory does not follow the length of a text."""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
LONG_WORD = 4096

SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: everything in ASCII but letters and digits
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = True
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False

_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(LONG_WORD, 0xD6E8FEB86659FD93, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x + _BASE
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the n + 1 offsets at which its texts begin and end."""
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `most` bytes; a longer document stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, min(stop, n)
        start = min(stop, n)


def _hash(data: np.ndarray, begins: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word, its hash); a word also begins at each position in `begins`."""
    inside = ~breaks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[begins < len(data)]
    first[begins] = inside[begins]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    heads = np.flatnonzero(first[at])
    starts = at[heads]
    lengths = np.diff(np.append(heads, len(at)))
    within = np.arange(len(at)) - np.repeat(heads, lengths)
    values = (LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * POWERS[np.minimum(within, LONG_WORD - 1)]
    hashes = mix(np.add.reduceat(values, heads))
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = LOWER[data[starts[i]:starts[i] + lengths[i]]].tobytes()
        hashes[i] = np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64)[0]
    return starts, hashes


def word_hashes(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of the documents, A-Z lower-cased; number of words of each document)."""
    begin, end = int(offsets[0]), int(offsets[-1])
    if len(offsets) > 2 or end - begin <= 2 * PIECE:
        starts, hashes = _hash(data[begin:end], offsets[:-1] - begin, breaks)
        return hashes, np.diff(np.searchsorted(starts, offsets - begin, "left"))
    found = []
    while begin < end:
        stop = min(begin + PIECE, end)
        if stop < end:
            back = np.flatnonzero(breaks[data[begin:stop]])
            if len(back):
                stop = begin + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(breaks[data[stop:end]])
                stop = stop + int(ahead[0]) if len(ahead) else end
        found.append(_hash(data[begin:stop], np.zeros(1, np.int64), breaks)[1])
        begin = stop
    hashes = np.concatenate(found)
    return hashes, np.array([len(hashes)])


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; the last k - 1 places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total = mix(total) + hashes[j:n + j]
    return mix(total)


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct k-word shingles; with fewer words the whole sequence as one; without words none."""
    grams, at = ngrams(hashes, k), 0
    for n in counts.tolist():
        if n >= k:
            yield np.unique(grams[at:at + n - k + 1])
        elif n:
            yield mix(ngrams(hashes[at:at + n], n) + np.uint64(n))
        else:
            yield np.zeros(0, np.uint64)
        at += n
