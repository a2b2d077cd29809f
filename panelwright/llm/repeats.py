"""Frame of the two exact substring operators: which windows of W units also start earlier in the corpus.

Every window of W units is marked by the q-gram in it that has the least hash. Equal windows have equal marks,
and neighbouring windows mostly share one, so a document is a short list of *runs* (windows with one mark).

1. Blocks send their distinct marks; buckets answer with those that occur more than once.
2. Blocks send the runs with such marks: where they start, and the text they span. Of runs with equal text only
   a block's first is sent. A bucket compares whole runs first: all but the first of equal runs are repeats.
   Where a mark has several different runs, the operator's own method (``refine``) compares their windows.
3. Blocks cut what is covered.

A mark with more than ``hot`` runs would crowd a bucket. Its windows travel alone, by the hash of all W units;
a block sends each distinct window once.

Order is (doc_id, start). Rows with one doc_id count as one document's parts, in the order of their texts. Rows
without doc_id come last, by their number among the block's rows without one, then by block. Null text is empty. Texts of less than W units have no windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .shared import Prefix, block_count, bucket_rows, chunks, in_blocks, mix, raw_texts, sorted_rows, word_spans

NO_ID = np.iinfo(np.int64).max
MARKS = "block int, bucket int, marks binary, counts binary"
FOUND = "block int, marks binary, hot binary"
RUNS = "bucket int, block int, kind int, mark binary, hash binary, doc binary, pos binary, n binary, size binary, text binary, text_size int"
FLAGS = "block int, doc binary, pos binary, n binary"
KEPT = "doc_id long, n_units long, n_removed long, n_spans long, kept binary"
CONTEXT, DONE, WINDOW = 0, 1, 2


@dataclass(frozen=True)
class Units:
    """Windows of ``window`` bytes or words, marked by one of their grams of ``gram``."""

    words: bool
    window: int
    gram: int

    def split(self, texts: list[bytes]):
        """(units as 64-bit values, first unit of each text and the end, start and stop byte of each unit, bytes)."""
        glue = b" " if self.words else b""
        data = glue.join(texts)
        raw = np.frombuffer(data, np.uint8)
        ends = np.cumsum([0, *(len(t) + len(glue) for t in texts)])
        if not self.words:
            at = np.arange(len(raw) + 1)
            return raw, ends, at[:-1], at[1:], data
        start, stop = word_spans(raw)
        seq = Prefix(raw).spans(start, stop)
        for i in np.flatnonzero(stop - start > 512):
            seq[i] = xxhash.xxh64_intdigest(data[start[i] : stop[i]], 7)
        return seq, np.searchsorted(start, ends), start, stop, data


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours: running minima inside rows of w, forwards and backwards."""
    n = len(x)
    rows = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = x
    rows = rows.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def runs(seq: np.ndarray, bounds: np.ndarray, units: Units):
    """(first window, last window, mark, prefix sums) of each run; windows stay inside one document.

    The mark of a window is its leftmost gram of least hash; a run is the windows that share that very gram.
    Hash (high 40 bits) and place are compared as one number, so the text is taken in slices of 2**23 units.
    """
    size, none = units.window, np.zeros(0, np.int64)
    n = len(seq) - size + 1
    if n <= 0:
        return none, none, np.zeros(0, np.uint64), None
    prefix = Prefix(seq)
    grams, reach = prefix.grams(units.gram), size - units.gram
    low = np.uint64((1 << 24) - 1)
    at = []
    for base in range(0, n, 1 << 23):
        piece = grams[base : base + (1 << 23) + reach]
        at.append((sliding_min((piece & ~low) | np.arange(len(piece), dtype=np.uint64), reach + 1) & low).astype(np.int64) + base)
    at = np.concatenate(at)[:n] if len(at) == 1 else np.concatenate([x[: 1 << 23] for x in at])[:n]
    edge = np.zeros(n + 1, np.int64)
    inner = bounds[1:-1]
    np.add.at(edge, np.minimum(np.maximum(inner - size + 1, 0), n), 1)
    np.add.at(edge, np.minimum(inner, n), -1)
    valid = np.cumsum(edge[:-1]) == 0
    begin = valid.copy()
    begin[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    first = np.flatnonzero(begin)
    bad = np.append(np.flatnonzero(~valid), n)
    last = np.minimum(np.append(first[1:], n), bad[np.searchsorted(bad, first)]) - 1
    return first, last, grams[at[first]], prefix


def spans_of(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the given spans, one after the other."""
    size = size.astype(np.int64)
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def pack(values, kind) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def parts(columns, kind) -> tuple[np.ndarray, np.ndarray]:
    """Packed columns as one array, and each one's length."""
    arrays = [np.frombuffer(x, kind) for x in columns]
    return np.concatenate(arrays) if arrays else np.zeros(0, kind), np.array([len(a) for a in arrays], np.int64)


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """True where sorted rows begin a new group."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new


def block_rows(table: pa.Table):
    """A block in order: doc ids, place among rows with the same id, texts."""
    table = sorted_rows(table)
    doc = table.column("doc_id").fill_null(NO_ID).to_numpy().astype(np.int64)
    new = np.flatnonzero(group_starts(doc))
    place = np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc))))
    return table, doc, place.astype(np.uint64), raw_texts(table)


def ranked(doc: np.ndarray, pos: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Numbers in the order of documents. Rows without doc_id have a place in their block only; of those with the
    same place, the one in the first block comes first."""
    if not (doc == NO_ID).any():
        return doc
    place = pos >> np.uint64(40)
    order = np.lexsort((block, place, doc))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(group_starts(doc[order], place[order], block[order]))
    return rank


def table_of(names: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in names.split(", "))])
    return pa.table([list(c) for c in zip(*rows)] if rows else [[] for _ in schema], schema=schema)


def flag_rows(block, doc, pos, n):
    """Flags for each block, as rows."""
    order = np.argsort(block, kind="stable")
    cut = np.flatnonzero(np.diff(block[order])) + 1
    for p in np.split(order, cut) if len(order) else ():
        yield int(block[p[0]]), pack(doc[p], np.int64), pack(pos[p], np.uint64), pack(n[p], np.uint32)


def kept_parts(docs: DataFrame, units: Units, refine: Callable, hot: int = 20_000, blocks: int | None = None) -> DataFrame:
    """(doc_id, n_units, n_removed, n_spans, kept) for each row of ``docs`` (doc_id, text).

    ``refine(units, texts, counts, doc, pos)`` gets different runs (doc: ``ranked``) and tells for each of their windows
    whether an equal window comes earlier.
    """
    n = blocks or block_count(docs)
    rows = in_blocks(docs, n)

    def send_marks(group: pa.Table) -> pa.Table:
        _, _, _, texts = block_rows(group)
        found = [np.zeros(0, np.uint64)]
        for a, b in chunks(texts):
            seq, bounds, *_ = units.split(texts[a:b])
            found.append(runs(seq, bounds, units)[2])
        marks, counts = np.unique(np.concatenate(found), return_counts=True)
        block = group.column("block")[0].as_py()
        return table_of(MARKS, [(block, bucket, pack(marks[p], np.uint64), pack(counts[p], np.uint32)) for bucket, p in bucket_rows(mix(marks), n)])

    def find_repeated(group: pa.Table) -> pa.Table:
        marks, sizes = parts(group.column("marks").to_pylist(), np.uint64)
        counts, _ = parts(group.column("counts").to_pylist(), np.uint32)
        known, inverse = np.unique(marks, return_inverse=True)
        total = np.bincount(inverse, weights=counts)[inverse]
        out, ends = [], np.cumsum(sizes)
        for block, a, b in zip(group.column("block").to_pylist(), ends - sizes, ends):
            got, times = marks[a:b], total[a:b]
            if (times > 1).any():
                out.append((block, pack(got[(times > 1) & (times < hot)], np.uint64), pack(got[times >= max(hot, 2)], np.uint64)))
        return table_of(FOUND, out)

    def send_runs(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return table_of(RUNS, [])
        _, doc, place, texts = block_rows(left)
        wanted = np.sort(parts(right.column("marks").to_pylist(), np.uint64)[0])
        frequent = np.sort(parts(right.column("hot").to_pylist(), np.uint64)[0])
        block = left.column("block")[0].as_py()
        cols, snippets, windows = [], [], []
        for a, b in chunks(texts):
            seq, bounds, start, stop, data = units.split(texts[a:b])
            first, last, mark, prefix = runs(seq, bounds, units)
            if not len(first):
                continue
            of = np.searchsorted(bounds, first, side="right") - 1
            pos = (place[a + of] << np.uint64(40)) | (first - bounds[of]).astype(np.uint64)
            mine = np.flatnonzero(in_sorted(mark, wanted))
            f, e = first[mine], last[mine] + units.window
            cols.append((mark[mine], prefix.spans(f, e), doc[a + of[mine]], pos[mine], (last - first + 1)[mine]))
            snippets += [data[i:j] for i, j in zip(start[f], stop[e - 1])]
            more = np.flatnonzero(in_sorted(mark, frequent))
            if len(more):
                count = (last - first + 1)[more]
                at = spans_of(first[more], count)
                windows.append((prefix.spans(at, at + units.window), np.repeat(doc[a + of[more]], count), spans_of(pos[more].astype(np.int64), count).astype(np.uint64)))
        out = []
        if cols:
            mark, text_hash, doc_of, pos, count = (np.concatenate(c) for c in zip(*cols))
            order = np.lexsort((pos, doc_of, text_hash, mark))
            new = group_starts(mark[order], text_hash[order], count[order])
            again, order = order[~new], order[new]
            if len(again):
                out.append((block % n, block, DONE, b"", b"", pack(doc_of[again], np.int64), pack(pos[again], np.uint64), pack(count[again], np.uint32), b"", b"", 0))
            for bucket, p in bucket_rows(mix(mark[order]), n):
                p = order[p]
                texts_of = [snippets[i] for i in p]
                text = b"".join(texts_of)
                out.append((bucket, block, CONTEXT, pack(mark[p], np.uint64), pack(text_hash[p], np.uint64), pack(doc_of[p], np.int64), pack(pos[p], np.uint64), pack(count[p], np.uint32), pack([len(t) for t in texts_of], np.uint32), pa.compress(text, "zstd", asbytes=True), len(text)))
        if windows:
            h, doc_of, pos = (np.concatenate(c) for c in zip(*windows))
            order = np.lexsort((pos, doc_of, h))
            new = group_starts(h[order])
            again, order = order[~new], order[new]
            if len(again):
                out.append((block % n, block, DONE, b"", b"", pack(doc_of[again], np.int64), pack(pos[again], np.uint64), pack(np.ones(len(again)), np.uint32), b"", b"", 0))
            for bucket, p in bucket_rows(mix(h[order]), n):
                p = order[p]
                out.append((bucket, block, WINDOW, b"", pack(h[p], np.uint64), pack(doc_of[p], np.int64), pack(pos[p], np.uint64), b"", b"", b"", 0))
        return table_of(RUNS, out)

    def compare(group: pa.Table) -> pa.Table:
        rows_of = group.to_pylist()
        out = [(r["block"], r["doc"], r["pos"], r["n"]) for r in rows_of if r["kind"] == DONE]
        alone = [r for r in rows_of if r["kind"] == WINDOW]
        if alone:
            h, sizes = parts([r["hash"] for r in alone], np.uint64)
            doc, pos = parts([r["doc"] for r in alone], np.int64)[0], parts([r["pos"] for r in alone], np.uint64)[0]
            block = np.repeat([r["block"] for r in alone], sizes)
            order = np.lexsort((pos, ranked(doc, pos, block), h))
            late = order[~group_starts(h[order])]
            out += flag_rows(block[late], doc[late], pos[late], np.ones(len(late), np.uint32))
        rest = [r for r in rows_of if r["kind"] == CONTEXT]
        if rest:
            mark, sizes = parts([r["mark"] for r in rest], np.uint64)
            text_hash, doc = parts([r["hash"] for r in rest], np.uint64)[0], parts([r["doc"] for r in rest], np.int64)[0]
            pos, count = parts([r["pos"] for r in rest], np.uint64)[0], parts([r["n"] for r in rest], np.uint32)[0]
            length = parts([r["size"] for r in rest], np.uint32)[0].astype(np.int64)
            block = np.repeat([r["block"] for r in rest], sizes)
            rank = ranked(doc, pos, block)
            order = np.lexsort((pos, rank, count, text_hash, mark))
            new = group_starts(mark[order], text_hash[order], count[order])
            late = order[~new]
            out += flag_rows(block[late], doc[late], pos[late], count[late])
            order = order[new]
            begin = np.flatnonzero(group_starts(mark[order]))
            several = np.repeat(np.diff(np.append(begin, len(order))) > 1, np.diff(np.append(begin, len(order))))
            order = order[several]
            if len(order):
                text = b"".join(bytes(pa.decompress(r["text"], r["text_size"], "zstd")) if r["text_size"] else b"" for r in rest)
                end = np.cumsum(length)
                early = refine(units, [text[end[i] - length[i] : end[i]] for i in order], count[order], rank[order], pos[order])
                owner = np.repeat(order, count[order])
                nth = spans_of(np.zeros(len(order), np.int64), count[order])
                hit = np.flatnonzero(early)
                if len(hit):
                    joined = (np.diff(hit) == 1) & (owner[hit[1:]] == owner[hit[:-1]])
                    head = hit[np.append(True, ~joined)]
                    tail = hit[np.append(~joined, True)]
                    who = owner[head]
                    out += flag_rows(block[who], doc[who], pos[who] + nth[head].astype(np.uint64), (tail - head + 1).astype(np.uint32))
        return table_of(FLAGS, out)

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(KEPT, [])
        table, doc, place, texts = block_rows(left)
        at_doc, at_pos = parts(right.column("doc").to_pylist(), np.int64)[0], parts(right.column("pos").to_pylist(), np.uint64)[0]
        count = parts(right.column("n").to_pylist(), np.uint32)[0].astype(np.int64)
        order = np.lexsort((at_pos, at_doc))
        at_doc, at_pos, count = at_doc[order], at_pos[order], count[order]
        where, at_place = (at_pos & np.uint64((1 << 40) - 1)).astype(np.int64), at_pos >> np.uint64(40)
        out = []
        for i, t in enumerate(texts):
            lo, hi = np.searchsorted(at_doc, doc[i]), np.searchsorted(at_doc, doc[i], side="right")
            if hi > lo:
                same = np.flatnonzero(at_place[lo:hi] == place[i]) + lo
            else:
                same = ()
            unit = t.split() if units.words else t
            if not len(same):
                out.append((len(unit), 0, 0, b" ".join(unit) if units.words else t))
                continue
            edge = np.zeros(len(unit) + 1, np.int32)
            np.add.at(edge, where[same], 1)
            np.add.at(edge, where[same] + count[same] - 1 + units.window, -1)
            gone = np.cumsum(edge[:-1]) > 0
            kept = b" ".join([w for w, g in zip(unit, gone.tolist()) if not g]) if units.words else np.frombuffer(t, np.uint8)[~gone].tobytes()
            out.append((len(unit), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), kept))
        rest = table_of(KEPT.split(", ", 1)[1], out)
        return pa.table([table.column("doc_id"), *rest.columns], names=["doc_id", *rest.column_names])

    marks = rows.groupBy("block").applyInArrow(send_marks, MARKS)
    repeated = marks.repartition(n, "bucket").groupBy("bucket").applyInArrow(find_repeated, FOUND)
    sent = rows.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(send_runs, RUNS)
    flags = sent.repartition(n, "bucket").groupBy("bucket").applyInArrow(compare, FLAGS)
    return rows.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(cut, KEPT)


def in_sorted(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return known[at] == x


def later_of_equal(name: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For windows with a name each: is there an equal one that comes earlier?"""
    order = np.lexsort((pos, doc, name))
    late = np.zeros(len(name), bool)
    late[order] = ~group_starts(name[order])
    return late
