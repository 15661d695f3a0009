"""Sets of word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from codeloom.llm.arrowtext import mix, random_numbers, text_bytes, word_hashes


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and where each text's start (one more than texts).

    A text with fewer words than a shingle has its whole sequence as its one shingle; without words it has none.
    """
    hashed, firsts = word_hashes(*text_bytes(column))
    counts = np.diff(firsts)
    factors = random_numbers(words + 1, 101) | np.uint64(1)
    total = len(hashed)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(firsts), np.int64)
    summed = np.zeros(total, np.uint64)
    for j in range(words):
        summed[:max(0, total - j)] += hashed[j:] * factors[j]
    place = np.arange(total) - np.repeat(firsts[:-1], counts)
    whole = place <= np.repeat(counts, counts) - words
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        at = firsts[short]
        own = counts[short].astype(np.uint64) * factors[words]
        for j in range(words - 1):
            there = counts[short] > j
            own[there] += hashed[at[there] + j] * factors[j]
        summed[at] = own
        whole[at] = True
    marked = np.zeros(total + 1, np.int64)
    np.cumsum(whole, out=marked[1:])
    raw, bounds = mix(summed[whole]), marked[firsts]
    sets = [np.unique(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    starts = np.zeros(len(firsts), np.int64)
    np.cumsum([len(s) for s in sets], out=starts[1:])
    return np.concatenate(sets) if sets else raw, starts
