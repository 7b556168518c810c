"""Word sets, their hashes and their parity fingerprints, batch-wise in Arrow.

Words are runs of letters, digits and underscores, lower-cased.  A word set is
identified by a 64-bit commutative hash; its fingerprint has 256 bits, each the
parity of the number of words that fall on it.  Two sets that differ in ``d``
words have fingerprints at a Hamming distance of at most ``d``, so a Hamming
radius derived from a Jaccard limit never loses a pair.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"\w+")
FP_BITS = 256
FP_BYTES = FP_BITS // 8
_CACHE: dict[str, int] = {}
_CACHE_MAX = 300_000


def word_hash(word: str) -> int:
    h = _CACHE.get(word)
    if h is None:
        if len(_CACHE) > _CACHE_MAX:
            _CACHE.clear()
        h = _CACHE[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1
    return h


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of each text, concatenated, and their counts."""
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    find, get = WORD.findall, word_hash
    for i, t in enumerate(texts):
        if t:
            ws = set(find(t.lower()))
            counts[i] = len(ws)
            flat.extend(map(get, ws))
    return np.array(flat, dtype=np.uint64), counts


def set_hashes(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signed 64-bit hash of each word set; 0 for an empty one."""
    out = np.zeros(len(counts), np.uint64)
    if len(flat):
        some = counts > 0
        starts = (np.cumsum(counts) - counts)[some]
        with np.errstate(over="ignore"):
            s = np.add.reduceat(mix(flat + np.uint64(0x9E3779B97F4A7C15)), starts)
            out[some] = mix(s + counts[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out.view(np.int64)


def fingerprints(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parity fingerprints, one row of 32 bytes for each set."""
    n = len(counts)
    doc = np.repeat(np.arange(n, dtype=np.int64), counts)
    bits = np.bincount(doc * FP_BITS + (flat & np.uint64(FP_BITS - 1)).astype(np.int64), minlength=n * FP_BITS)
    return np.packbits((bits & 1).astype(np.uint8).reshape(n, FP_BITS), axis=1)


def fp_array(rows: np.ndarray) -> pa.Array:
    buf = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    offsets = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * FP_BYTES).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, buf])


def fp_words(column: pa.Array) -> np.ndarray:
    """Binary column of fingerprints as an (n, 4) array of 64-bit words."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, FP_BYTES // 8)


def slices(batch_iter, size: int = 2048):
    """Cuts Arrow batches so that the per-batch bit matrices stay small."""
    for b in batch_iter:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)


def list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def jaccard(left: str | None, right: str | None) -> float:
    """Share of common words; 0 where either side has none."""
    a, b = set(WORD.findall((left or "").lower())), set(WORD.findall((right or "").lower()))
    both = len(a & b)
    return both / (len(a) + len(b) - both) if both else 0.0
