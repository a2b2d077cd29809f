"""Exact removal of repeated word sequences by prefix-partitioned suffix trees.

Suffixes are dealt out by a prefix: the least q-gram of words in a window where its group fits into memory, the
whole window where it does not (``repeats``). Inside a group, prefixes grow word by word until their suffixes
fit a subtree. A subtree is kept as its sorted suffixes with the common prefix of neighbours; its internal
nodes of at least the window's depth are maximal repeats, whose leaves but the first are removed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Units, kept_parts, later_of_equal, spans_of

SUBTREE = 1 << 14


def prefix_groups(suffixes: np.ndarray, rows: np.ndarray, depth: int = 0, most: int = SUBTREE):
    """Groups of at most ``most`` suffixes with a common prefix, longer prefixes where groups are large."""
    if len(rows) <= most or depth == suffixes.shape[1]:
        yield rows
        return
    word = suffixes[rows, depth]
    order = np.argsort(word, kind="stable")
    few: list[np.ndarray] = []
    held = 0
    for part in np.split(rows[order], np.flatnonzero(np.diff(word[order])) + 1):
        if len(part) > most:
            yield from prefix_groups(suffixes, part, depth + 1, most)
            continue
        if held + len(part) > most:
            yield np.concatenate(few)
            few, held = [], 0
        few.append(part)
        held += len(part)
    if few:
        yield np.concatenate(few)


def subtree(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in order, and for each but the first the depth of its lowest common node with the leaf before."""
    order = np.lexsort(suffixes.T[::-1])
    differs = suffixes[order[1:]] != suffixes[order[:-1]]
    depth = np.where(differs.any(axis=1), differs.argmax(axis=1), suffixes.shape[1])
    return order, depth


def refine(units: Units, texts: list[bytes], counts: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    seq, bounds, *_ = units.split(texts)
    word = np.unique(seq, return_inverse=True)[1].astype(np.int32)
    at = spans_of(bounds[:-1], counts)
    suffixes = np.lib.stride_tricks.sliding_window_view(word, units.window)
    doc, pos = np.repeat(doc, counts), np.repeat(pos, counts) + spans_of(np.zeros(len(counts), np.int64), counts).astype(np.uint64)
    late = np.zeros(len(at), bool)
    for rows in prefix_groups(suffixes, at):
        where = np.searchsorted(at, rows)
        order, depth = subtree(suffixes[at[where]])
        node = np.empty(len(where), np.int64)
        node[order] = np.cumsum(np.append(True, depth < units.window))
        late[where] = later_of_equal(node, doc[where], pos[where])
    return late


def remove_repeats(docs: DataFrame, length: int = 20, gram: int = 6, hot: int = 20_000, blocks: int | None = None) -> DataFrame:
    """Cut every word covered by a sequence of ``length`` words that also starts earlier; words are the runs of
    bytes other than 09-0D and 20.

    Takes (doc_id, text), whatever else is there. Gives doc_id, n_units (words), n_removed, n_spans, kept (words
    joined by a blank, UTF-8). See ``repeats`` for nulls, ties and repeated rows.
    """
    return kept_parts(docs, Units(True, length, min(gram, length)), refine, hot, blocks)
