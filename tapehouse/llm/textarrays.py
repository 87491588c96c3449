"""Text of an Arrow batch as flat byte arrays: words, hashes, shingles.

Everything works on the UTF-8 bytes of many documents at once: ``data`` is
one uint8 array, ``offs`` the document boundaries in it. Hashing runs over
blocks of bounded size, so a very long text costs no more memory per byte
than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK = 1 << 18
#: An odd multiplier for the polynomial hash and the splitmix64 constants.
PRIME, INVERSE_STEPS = 0x9E3779B97F4A7C15, 6
MIX_1, MIX_2, GAMMA = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
NULL_ID = np.iinfo(np.int64).max

_tables: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = x ^ (x >> U64(30))
    x *= U64(MIX_1)
    x ^= x >> U64(27)
    x *= U64(MIX_2)
    x ^= x >> U64(31)
    return x


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_string())
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string()).cast(pa.large_binary())
    else:
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = col.buffers()
    offs = np.frombuffer(buffers[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def ids(col) -> np.ndarray:
    """int64 ids; a null id becomes ``NULL_ID``, larger than any other."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.int64()), NULL_ID).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    """Back from ``ids``: ``NULL_ID`` becomes null."""
    values = np.asarray(values, np.int64)
    return pa.array(values, mask=values == NULL_ID)


def slices(offs: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    if "lower" not in _tables:
        t = np.arange(256, dtype=np.uint8)
        t[65:91] += 32
        _tables["lower"] = t
    return _tables["lower"][data]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (runs of bytes other than 0x20 and 0x09-0x0D)
    and each document's range in them."""
    if "word" not in _tables:
        t = np.ones(256, bool)
        t[[0x20, 9, 10, 11, 12, 13]] = False
        _tables["word"] = t
    w = _tables["word"][data]
    full = offs[:-1] < offs[1:]
    first, last = offs[:-1][full], offs[1:][full] - 1
    begin, end = w.copy(), w.copy()
    begin[1:] &= ~w[:-1]
    begin[first] = w[first]
    end[:-1] &= ~w[1:]
    end[last] = w[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_tables.get("pow", ())) < n:
        size = max(n, BLOCK)
        inverse = PRIME  # Newton steps give the inverse of an odd number modulo 2**64
        for _ in range(INVERSE_STEPS):
            inverse = inverse * (2 - PRIME * inverse) % (1 << 64)
        for name, base in (("pow", PRIME), ("inv", inverse)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=U64)
        _tables["byte"] = mix(np.arange(1, 257, dtype=U64) * U64(GAMMA))
    return _tables["pow"], _tables["inv"], _tables["byte"]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans are sorted by start and by end."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        hi = int(ends[j - 1])
        power, inverse, byte = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum(byte[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(U64) * U64(MIX_1)
        i = j
    return mix(out)


def shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words by document, and the document offsets in them.

    A document of fewer words gives its whole sequence as one; one without
    words gives none.
    """
    starts, ends, at = words(data, offs)
    h = span_hash(data, starts, ends)
    counts = np.diff(at)
    weights = mix(np.arange(1, k + 1, dtype=U64) * U64(GAMMA)) | U64(1)
    n = len(h)
    size = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_offs = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(out_offs[-1], U64)
    short = (counts > 0) & (counts < k)
    slot = out_offs[:-1][short]
    if n >= k:
        doc = np.repeat(np.arange(len(counts)), counts)
        acc = np.zeros(n - k + 1, U64)
        for j in range(k):
            acc += h[j : n - k + 1 + j] * weights[j]
        inside = np.ones(len(out), bool)
        inside[slot] = False
        out[inside] = mix(acc[doc[: n - k + 1] == doc[k - 1 :]])
    for c in range(1, k):
        which = np.flatnonzero(counts == c)
        acc = np.full(len(which), c, U64) * U64(MIX_2)
        for j in range(c):
            acc += h[at[which] + j] * weights[j]
        out[out_offs[which]] = mix(acc)
    return out, out_offs


def unique_sorted(values: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's values sorted and without repeats (``values`` is sorted in place)."""
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offs[:-1][offs[:-1] < offs[1:]]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], total[offs]
