"""Texts as ragged numpy arrays: their different words, and values put back in their places."""

from __future__ import annotations

import numpy as np
import xxhash

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LANES = 3  # words of up to 24 bytes are compared as three integers
_MASK = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def distinct_parts(
    joined: bytes, starts: np.ndarray, ends: np.ndarray
) -> tuple[list[bytes], np.ndarray]:
    """The different parts of a sequence of bytes, and each part's place among them.

    Parts are brought together by a 64-bit mix of their bytes and then
    compared in full.
    """
    lengths = ends - starts
    padded = joined + bytes(8 * _LANES)
    view = np.ndarray(len(joined) + 8 * (_LANES - 1) + 1, "<u8", padded, strides=(1,))
    lanes = [
        view[starts + 8 * i] & _MASK[np.clip(lengths - 8 * i, 0, 8)] for i in range(_LANES)
    ]
    key = lengths.astype(np.uint64)
    for lane, odd in zip(lanes, _ODD, strict=True):
        key = (key ^ lane) * odd
        key ^= key >> np.uint64(29)
    long = np.flatnonzero(lengths > 8 * _LANES)
    words = [joined[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    key[long] = [xxhash.xxh3_64_intdigest(word) for word in words]

    _, first, place = np.unique(key, return_index=True, return_inverse=True)
    same = lengths[first][place] == lengths
    for lane in lanes:
        same &= lane[first][place] == lane
    unique = [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    same = same.all() and all(
        unique[i] == word for i, word in zip(place[long].tolist(), words, strict=True)
    )
    if not same:  # two parts with one mix
        parts = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        unique = sorted(set(parts))
        number = {part: i for i, part in enumerate(unique)}
        place = np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))
    return unique, place


def distinct_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words of all texts, each word's place among them, and words before each text.

    Words are runs without ASCII white space.
    """
    joined = b" %b " % b" ".join(texts)
    gap = _GAP[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    at = np.cumsum([1] + [len(text) + 1 for text in texts])
    unique, place = distinct_parts(joined, starts, ends)
    return unique, place, np.searchsorted(starts, at)


def taken(flat: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array one after the other, and where each begins; the end comes last."""
    begin = np.cumsum(sizes) - sizes
    size = sizes[place]
    upto = np.r_[0, np.cumsum(size)]
    index = np.repeat(begin[place] - upto[:-1], size)
    index += np.arange(len(index))
    return flat[index], upto


def spread(values: list[bytes], place: np.ndarray, before: np.ndarray) -> list[bytes]:
    """For each text, the 32-bit values of its words one after the other."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    flat, upto = taken(np.frombuffer(b"".join(values), "<u4"), sizes, place)
    raw = flat.tobytes()
    cuts = (4 * upto[before]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
