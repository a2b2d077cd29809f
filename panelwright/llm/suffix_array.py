"""Exact removal of repeated byte strings by a sampled suffix array with bucket-pointer refinement.

The suffixes worth sorting are those in windows whose least q-gram repeats (``repeats``). They start in buckets
of equal q-grams. A bucket is refined by sorting its suffixes on the bucket identifiers that stand a bucket's
depth later; that doubles the depth, and the refined identifiers serve as the pointers of the next pass. A
suffix alone in its bucket is done and keeps its identifier. At the depth of a window, equal identifiers are
equal windows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Units, kept_parts, later_of_equal, spans_of
from .shared import Prefix


def refine_buckets(data: np.ndarray, depth: int, goal: int) -> np.ndarray:
    """Bucket identifiers of the spans of ``goal`` bytes at each position; past the end they mean nothing."""
    _, bucket, size = np.unique(Prefix(data).grams(depth), return_inverse=True, return_counts=True)
    bucket = bucket.astype(np.int64)
    while depth < goal:
        step = min(depth, goal - depth)
        n = len(bucket) - step
        own = bucket[:n]
        open_ = np.flatnonzero(size[own] > 1)
        pair = own[open_] * len(size) + bucket[step:][open_]
        _, finer, count = np.unique(pair, return_inverse=True, return_counts=True)
        refined = np.empty(n, np.int64)
        closed = np.flatnonzero(size[own] == 1)
        refined[open_] = finer
        refined[closed] = len(count) + np.arange(len(closed))
        bucket, size = refined, np.concatenate((count, np.ones(len(closed), np.int64)))
        depth += step
    return bucket


def refine(units: Units, texts: list[bytes], counts: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0, *map(len, texts)])[:-1]
    bucket = refine_buckets(data, max(1, units.window // 4), units.window)
    at = spans_of(begin, counts)
    nth = spans_of(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
    return later_of_equal(bucket[at], np.repeat(doc, counts), np.repeat(pos, counts) + nth)


def remove_repeats(docs: DataFrame, length: int = 100, gram: int = 32, hot: int = 20_000, blocks: int | None = None) -> DataFrame:
    """Cut every byte covered by a string of ``length`` bytes that also starts earlier.

    Takes (doc_id, text), whatever else is there. Gives doc_id, n_units (bytes), n_removed, n_spans, kept (bytes,
    since a cut may fall inside a character). See ``repeats`` for nulls, ties and repeated rows.
    """
    return kept_parts(docs, Units(False, length, min(gram, length)), refine, hot, blocks)
