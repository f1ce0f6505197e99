"""Word shingles of whole texts as sorted 64-bit hashes, a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lowered, cut at ASCII white space), and where each text's words begin and end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w) for w in names), np.uint64, len(names))
    # no word is empty, but a text of white space alone gives an empty one
    real = np.fromiter(map(bool, names), bool, len(names))
    which = coded.indices.to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    got = hashes[which]
    if not real.all():
        keep = real[which]
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[keep], minlength=len(counts))
        got = got[keep]
    return got, np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``size`` words, sorted; a shorter text is one shingle, one without words none."""
    h, ends = words(texts)
    n = len(h)
    with np.errstate(over="ignore"):
        whole = np.zeros(max(n - size + 1, 0), np.uint64)
        for i in range(size):
            whole = mix(whole * _ODD[0] + h[i : n - size + 1 + i] + np.uint64(i + 1)) if len(whole) else whole
        out = []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(whole[a : b - size + 1]))
            elif b > a:
                short = np.zeros(1, np.uint64)
                for i in range(a, b):
                    short = mix(short * _ODD[0] + h[i : i + 1] + np.uint64(101 + i - a))
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out
