"""Character trigram counts as MLlib's chain of RegexTokenizer (pattern ""), NGram(3) and HashingTF makes them.

A character is a UTF-16 unit, a half of a pair counts as "?", the term is the
three characters joined by blanks, its bucket the MurmurHash3 (seed 42) of the
term's UTF-8 bytes.  The chain makes a string for each character and each
trigram; here the buckets of a piece of texts are computed as whole arrays.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from quarry.functions.arrow import pieces

#: Trigrams of one text that are hashed at a time.
TEXT_STEP = 1 << 20


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)


def hash_trigrams(a: np.ndarray, b: np.ndarray, c: np.ndarray, num_features: int) -> np.ndarray:
    """Bucket of each term "a b c", characters given as UTF-16 units that are no halves of pairs."""
    def utf8(u):
        u = u.astype(np.uint64)
        two = u >> 6 | 0xC0 | (u & 63 | 0x80) << 8
        three = u >> 12 | 0xE0 | (u >> 6 & 63 | 0x80) << 8 | (u & 63 | 0x80) << 16
        return np.where(u < 0x80, u, np.where(u < 0x800, two, three)), np.uint64(1) + (u > 0x7F) + (u > 0x7FF)

    (x, nx), (y, ny), (z, nz) = utf8(a), utf8(b), utf8(c)
    at = nx + ny + 2  # of the third character, 4 to 8
    low = x | np.uint64(32) << nx * 8 | y << nx * 8 + 8 | np.uint64(32) << at * 8 - 8
    low |= np.where(at < 8, z << np.minimum(at, 7) * 8, 0)
    high = z >> 64 - at * 8
    size = (at + nz).astype(np.uint32)  # 5 to 11 bytes: one or two blocks of four, the rest is a tail
    one, two, three = (low & 0xFFFFFFFF).astype(np.uint32), (low >> 32).astype(np.uint32), high.astype(np.uint32)

    def block(h, k):
        h = h ^ _mixed(k)
        return (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)

    h = block(np.full(len(one), 42, np.uint32), one)
    h = np.where(size < 8, h ^ _mixed(two), block(h, two) ^ _mixed(three)) ^ size
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return (h ^ h >> np.uint32(16)).view(np.int32) % np.int32(num_features)


@functools.lru_cache(maxsize=2)
def _ascii_buckets(num_features: int) -> np.ndarray:
    code = np.arange(1 << 21, dtype=np.int32)
    return hash_trigrams(code >> 14, code >> 7 & 127, code & 127, num_features)


def _buckets(units: np.ndarray, num_features: int) -> np.ndarray:
    """Bucket of the trigram that starts at each unit but the last two."""
    code = (units[:-2] & 127).astype(np.int32) << 14
    code |= (units[1:-1] & 127).astype(np.int32) << 7
    code |= units[2:] & 127
    out = _ascii_buckets(num_features)[code]
    if units.dtype != np.uint8:
        other = units > 127
        at = np.flatnonzero(other[:-2] | other[1:-1] | other[2:])
        out[at] = hash_trigrams(units[at], units[at + 1], units[at + 2], num_features)
    return out


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of the texts end to end, and each text's number of them; one byte a unit if all are ASCII."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if ends[0] == ends[-1]:
        return np.zeros(0, np.uint8), np.diff(ends)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    if data.max() < 0x80:
        return data, np.diff(ends)
    before = np.concatenate([[0], np.cumsum(((data & 0xC0) != 0x80) + (data >= 0xF0).view(np.int8), dtype=np.int64)])
    units = np.frombuffer(data.tobytes().decode().encode("utf-16-le"), np.uint16)
    return np.where(units >> 11 == 0xD800 >> 11, np.uint16(ord("?")), units), np.diff(before[ends - ends[0]])


def _counts(texts: pa.Array, num_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets in ascending order, their counts, number of buckets) of each text, end to end."""
    units, sizes = _units(texts)
    if len(sizes) == 1:  # of any length
        total = np.zeros(num_features, np.int64)
        for start in range(0, len(units) - 2, TEXT_STEP):
            total += np.bincount(_buckets(units[start:start + TEXT_STEP + 2], num_features), minlength=num_features)
        found = np.flatnonzero(total)
        return found, total[found], np.array([len(found)])
    ends = np.cumsum(sizes)
    inside = np.ones(len(units), bool)  # the trigram does not run into the next text
    inside[ends[sizes > 0] - 1] = inside[ends[sizes > 1] - 2] = False
    kind = np.uint32 if len(sizes) * num_features < 1 << 32 else np.uint64
    key = np.repeat(np.arange(len(sizes), dtype=kind) * kind(num_features), np.maximum(sizes - 2, 0))
    if len(key):
        key += _buckets(units, num_features)[inside[:-2]].astype(kind)
        key.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    found = key[first]
    return found % kind(num_features), np.diff(np.append(first, len(key))), np.bincount(found // kind(num_features), minlength=len(sizes))


def trigram_vectors(texts: pa.Array, num_features: int) -> pa.Array:
    """The sparse vector (in the storage form of MLlib's vector type) of each text, lower-cased before; no text may be null."""
    if texts.null_count:
        raise ValueError("a text is null")
    out = [pa.StructArray.from_arrays([pa.array([], t) for t in (pa.int8(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()))],
                                      ["type", "size", "indices", "values"])]
    for piece in pieces([pa.RecordBatch.from_arrays([texts], ["t"])]):
        found, count, sizes = _counts(piece.column(0), num_features)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        out.append(pa.StructArray.from_arrays([
            pa.array(np.zeros(len(sizes)), pa.int8()), pa.array(np.full(len(sizes), num_features), pa.int32()),
            pa.ListArray.from_arrays(ends, pa.array(found.astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(count.astype(np.float64)))], ["type", "size", "indices", "values"]))
    return pa.concat_arrays(out)
