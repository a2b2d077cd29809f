"""Removal of repeated and nearly repeated lines by a segment-partition edit join.

Two lines within ``edits`` changes of one character have a segment in common when one is cut into edits + 1
segments: each line sends the segments of its own partition (index side) and, for each shorter length within the
threshold, the substrings that could be a segment there (probe side; only starts that leave enough edits for both
ends). Keys meet in buckets; lines with a common key are compared by a banded bit-parallel automaton.

1. Equal lines: blocks send a digest of each distinct line; buckets find the first one in the corpus.
2. First lines send their keys; a bucket finds keys that several lines share with an index side among them.
   If more than ``crowd`` lines share a key, what is left of them without the shared segment must be within the
   threshold too, so they are joined once more by keys of that rest.
3. The texts of such lines meet by key and are compared; a key that is still crowded is compared in pieces.
4. Links join lines to components. A line stays if it is the first of its component in the order (doc_id, line).

Equal lines go whatever their length. Lines of less than ``least_chars`` characters are not compared for near ones,
since a few changes turn them into anything. Blank lines (nothing but white space) are left alone, as are null
texts. Lines are what stands between line feeds. Rows without doc_id come last, repeated rows count as parts of one document in the order of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .repeats import block_rows, group_starts, pack, table_of
from .shared import Prefix, block_count, bucket_rows, mix, row_block, stage

LINES = "block int, bucket int, digest binary, doc binary, pos binary, line binary"
LATE = "block int, kind int, key long, crowded int, line binary"
KEYS = "block int, bucket int, key binary, line binary"
MET = "kind int, block int, group long, line int, doc long, pos long, index int, text string"
FOUND_T = pa.schema([("a", pa.struct([("doc", pa.int64()), ("pos", pa.int64()), ("block", pa.int32()), ("line", pa.int32())])), ("b", pa.struct([("doc", pa.int64()), ("pos", pa.int64()), ("block", pa.int32()), ("line", pa.int32())]))])
NODE = "struct<doc: long, pos: long, block: int, line: int>"
IS_LATE, ASKED = 0, 1
INDEX = np.uint32(1 << 31)


def within(a: str, b: str, k: int) -> bool:
    """Are a and b at most k changes apart? Bit t of a row stands for the prefix of ``a`` that is t - k longer
    than what was read of ``b``; row e holds what can be reached with e changes."""
    m, n = len(a), len(b)
    if abs(m - n) > k:
        return False
    if a == b:
        return True
    lo, most = 0, min(m, n)
    step = most
    while step:
        if lo + step <= most and a[lo : lo + step] == b[lo : lo + step]:
            lo += step
        else:
            step //= 2
    hi, most = 0, most - lo
    step = most
    while step:
        if hi + step <= most and a[m - hi - step : m - hi] == b[n - hi - step : n - hi]:
            hi += step
        else:
            step //= 2
    a, b = a[lo : m - hi], b[lo : n - hi]
    m, n = len(a), len(b)
    if not m or not n:
        return True
    full = (1 << (2 * k + 1)) - 1
    rows = [((1 << (e + 1)) - 1) << k & full for e in range(k + 1)]
    for i in range(n):
        match, c = 0, b[i]
        for t in range(max(0, k - i), min(2 * k + 1, m - i + k)):
            if a[i - k + t] == c:
                match |= 1 << t
        new = [rows[0] & match]
        for e in range(1, k + 1):
            before = rows[e - 1]
            new.append(((rows[e] & match) | before | before >> 1 | new[e - 1] << 1) & full)
        rows = new
        if not rows[k]:
            return False
    return bool(rows[k] >> (m - n + k) & 1)


def segment(length, i: int, count: int):
    """Start and size of segment i of ``count`` even ones, the longer ones last."""
    base, longer = length // count, length % count
    first_long = count - longer
    return i * base + np.maximum(0, i - first_long), base + (i >= first_long)


def line_keys(units: np.ndarray, start: np.ndarray, length: np.ndarray, edits: int):
    """(key, line, is index, start and size in the line) of all keys of lines inside ``units`` (code points)."""
    prefix = Prefix(units)
    count = edits + 1
    for less in range(edits + 1):
        target = length - less
        for i in range(count):
            at, size = segment(target, i, count)
            low = np.maximum(np.maximum(at - i, at + less - (count - 1 - i)), 0)
            high = np.minimum(np.minimum(at + i, at + less + (count - 1 - i)), length - size)
            for shift in range(-edits, 2 * edits + 1):
                s = at + shift
                rows = np.flatnonzero((s >= low) & (s <= high) & (target > 0))
                if len(rows):
                    begin = start[rows] + s[rows]
                    key = prefix.spans(begin, begin + size[rows])
                    key = mix(key ^ mix(target[rows].astype(np.uint64) * np.uint64(64) + np.uint64(i)))
                    yield key, rows, less == 0 and shift == 0, s[rows], size[rows]


def code_points(lines: list[str]):
    data = "".join(lines)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.frombuffer(data.encode("utf-32-le"), np.uint32), np.cumsum(length) - length, length


class Block:
    """Lines of a block in order. ``first``: the numbers of those that are not blank and that no equal line
    precedes in the block."""

    def __init__(self, table: pa.Table):
        self.table, self.doc, self.place, texts = block_rows(table)
        self.lines = [None if t is None else t.split("\n") for t in self.table.column("text").to_pylist()]
        self.first: list[int] = []
        self.text: list[str] = []
        self.row: list[int] = []
        self.nth: list[int] = []
        self.again: set[int] = set()
        self.offset: list[int] = []
        seen, number = set(), 0
        for i, lines in enumerate(self.lines):
            self.offset.append(number)
            for j, line in enumerate(lines or ()):
                if line and not line.isspace():
                    if line in seen:
                        self.again.add(number)
                    else:
                        seen.add(line)
                        self.first.append(number)
                        self.text.append(line)
                        self.row.append(i)
                        self.nth.append(j)
                number += 1

    def order(self, some) -> tuple[np.ndarray, np.ndarray]:
        """doc and position of first lines."""
        row = np.array(self.row, np.int64)[some]
        return self.doc[row], (self.place[row] << np.uint64(40)) | np.array(self.nth, np.uint64)[some]


def rest_keys(text: str, at: int, size: int, edits: int):
    """Keys of a line without a shared segment: (key, is index)."""
    units, start, length = code_points([text[:at] + text[at + size :]])
    if not length[0]:
        return [(0, True)]
    return [(int(k), index) for keys, _, index, _, _ in line_keys(units, start, length, edits) for k in keys]


def blocks_of(docs: DataFrame, n: int) -> DataFrame:
    """Like ``in_blocks``, with all other columns in one struct."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(
        row_block(n).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("_"))).alias("rest"),
    ).repartition(n, "block")


def candidates(rows: DataFrame, n: int, edits: int, least_chars: int, crowd: int) -> DataFrame:
    """Rows of two kinds: lines that an equal one precedes in another block, and lines that share a key."""

    def send_lines(group: pa.Table) -> pa.Table:
        b = Block(group)
        digest = b"".join(xxhash.xxh128_digest(t) for t in b.text)
        key = np.frombuffer(digest, "<u8").reshape(-1, 2)
        doc, pos = b.order(slice(None))
        number = np.array(b.first, np.uint32)
        block = group.column("block")[0].as_py()
        return table_of(LINES, [(block, bucket, pack(key[p], np.uint64), pack(doc[p], np.int64), pack(pos[p], np.uint64), pack(number[p], np.uint32)) for bucket, p in bucket_rows(np.ascontiguousarray(key[:, 0]), n)])

    def find_late(group: pa.Table) -> pa.Table:
        cols = {c: [np.frombuffer(x, k) for x in group.column(c).to_pylist()] for c, k in (("digest", np.uint64), ("doc", np.int64), ("pos", np.uint64), ("line", np.uint32))}
        size = [len(x) for x in cols["doc"]]
        key, doc, pos = np.concatenate(cols["digest"]).reshape(-1, 2), np.concatenate(cols["doc"]), np.concatenate(cols["pos"])
        from_block = np.repeat(group.column("block").to_numpy(), size)
        order = np.lexsort((from_block, pos, doc, key[:, 1], key[:, 0]))
        late = np.zeros(len(doc), bool)
        late[order] = ~group_starts(key[order, 0], key[order, 1])
        out = []
        for block, lines, flags in zip(group.column("block").to_pylist(), cols["line"], np.split(late, np.cumsum(size)[:-1])):
            if flags.any():
                out.append((block, IS_LATE, 0, 0, pack(lines[flags], np.uint32)))
        return table_of(LATE, out)

    def late_of(table: pa.Table) -> set[int]:
        return {x for kind, line in zip(table.column("kind").to_pylist(), table.column("line").to_pylist()) if kind == IS_LATE for x in np.frombuffer(line, np.uint32).tolist()}

    def fresh(b: Block, late: set[int]) -> np.ndarray:
        return np.array([i for i, x in enumerate(b.first) if x not in late and len(b.text[i]) >= least_chars], np.int64)

    def send_keys(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(KEYS, [])
        b = Block(left)
        mine = fresh(b, late_of(right))
        keys, lines = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        number = np.array(b.first, np.uint32)
        for part in np.array_split(mine, max(1, len(mine) // 2000)):
            units, start, length = code_points([b.text[i] for i in part])
            for k, rows_of, index, _, _ in line_keys(units, start, length, edits):
                keys.append(k)
                lines.append(number[part[rows_of]] | (INDEX if index else np.uint32(0)))
        keys, lines = np.concatenate(keys), np.concatenate(lines)
        block = left.column("block")[0].as_py()
        return table_of(KEYS, [(block, bucket, pack(keys[p] & np.uint64(0xFFFFFFFF), np.uint32), pack(lines[p], np.uint32)) for bucket, p in bucket_rows(keys, n)])

    def meet(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        key = [np.frombuffer(x, np.uint32) for x in group.column("key").to_pylist()]
        block = np.repeat(group.column("block").to_numpy(), [len(x) for x in key])
        key, line = np.concatenate(key), np.concatenate([np.frombuffer(x, np.uint32) for x in group.column("line").to_pylist()])
        index, line = line >= INDEX, line & ~INDEX
        order = np.lexsort((line, block, key))
        key, block, line, index = key[order], block[order], line[order], index[order]
        new = group_starts(key)
        of = np.cumsum(new) - 1
        different = group_starts(key, block, line)
        size, has_index = np.bincount(of, weights=different), np.bincount(of, weights=index)
        keep = np.flatnonzero(different & ((size > 1) & (has_index > 0))[of])
        crowded = size[of[keep]] > crowd
        out = [(int(b), ASKED, (bucket << 32) | int(k), int(c), pack([x], np.uint32)) for b, k, c, x in zip(block[keep], key[keep], crowded, line[keep])]
        return table_of(LATE, out)

    def send_texts(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return table_of(MET, [])
        late = late_of(right)
        block = left.column("block")[0].as_py()
        out = [(IS_LATE, block, None, x, None, None, None, None) for x in sorted(late)]
        asked = [r for r in right.to_pylist() if r["kind"] == ASKED]
        if asked:
            b = Block(left)
            where = {x: i for i, x in enumerate(b.first)}
            doc, pos = b.order(slice(None))
            for r in asked:
                for x in np.frombuffer(r["line"], np.uint32).tolist():
                    i = where[x]
                    groups = [(r["key"], 2)]
                    if r["crowded"]:
                        units, start, length = code_points([b.text[i]])
                        shared = {(int(s), int(z)) for k, _, _, at, size in line_keys(units, start, length, edits) for q, s, z in zip(k, at, size) if int(((q >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)) << 32 | int(q & np.uint64(0xFFFFFFFF)) == r["key"]}
                        groups = sorted({(xxhash.xxh64_intdigest(f"{r['key']} {k}") - (1 << 63), int(index)) for s, z in shared for k, index in rest_keys(b.text[i], s, z, edits)})
                    for g, index in groups:
                        out.append((ASKED, block, g, x, int(doc[i]), int(pos[i]), index, b.text[i]))
        return table_of(MET, out)

    lines = rows.groupBy("block").applyInArrow(send_lines, LINES)
    late = lines.repartition(n, "bucket").groupBy("bucket").applyInArrow(find_late, LATE)
    keys = rows.groupBy("block").cogroup(late.groupBy("block")).applyInArrow(send_keys, KEYS)
    asked = keys.repartition(n, "bucket").groupBy("bucket").applyInArrow(meet, LATE)
    return rows.groupBy("block").cogroup(late.unionByName(asked).groupBy("block")).applyInArrow(send_texts, MET)


def compare(met: DataFrame, edits: int, crowd: int) -> DataFrame:
    """Links (a, b) between lines that share a key; crowded keys in pieces, each pair of pieces in a task."""
    asked = met.where(F.col("kind") == ASKED).drop("kind")
    large = asked.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("group", F.ceil(F.col("n") / crowd).cast("int").alias("pieces"))
    own = F.pmod(F.xxhash64("block", "line"), F.coalesce("pieces", F.lit(1))).cast("int")
    spread = asked.join(large, "group", "left").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
    spread = spread.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other"))

    def run(group: pa.Table) -> pa.Table:
        rows = {(r["block"], r["line"]): r for r in group.to_pylist()}
        by_length = sorted(rows.values(), key=lambda r: (len(r["text"]), r["block"], r["line"]))
        split = group.column("x")[0].as_py() != group.column("y")[0].as_py()
        node = lambda r: {k: r[k] for k in ("doc", "pos", "block", "line")}
        out = []
        for i, r in enumerate(by_length):
            for s in by_length[i + 1 :]:
                if len(s["text"]) - len(r["text"]) > edits:
                    break
                if not (split and s["own"] == r["own"]) and within(r["text"], s["text"], edits):
                    out.append((node(r), node(s)))
        return pa.table([pa.array([p[0] for p in out], FOUND_T.types[0]), pa.array([p[1] for p in out], FOUND_T.types[1])], schema=FOUND_T)

    return spread.groupBy("group", "x", "y").applyInArrow(run, f"a {NODE}, b {NODE}").distinct()


def dedup_lines(docs: DataFrame, edits: int = 2, least_chars: int = 20, crowd: int = 256, blocks: int | None = None) -> DataFrame:
    """(doc_id, text, rest, n_lines, n_removed, n_near) for each row of ``docs``: the text without repeated lines,
    how many went, and how many of those because of a line that is near but not equal. ``rest`` holds the other
    columns."""
    n = blocks or block_count(docs)
    rows = blocks_of(docs, n)
    met = stage(candidates(rows, n, edits, least_chars, crowd), "lines")
    links = stage(compare(met, edits, crowd), "line-links")
    near = components(links).where("node != component").select(F.col("node.block").alias("block"), F.col("node.line").alias("line"), F.lit(ASKED).alias("kind"))
    gone = met.where(F.col("kind") == IS_LATE).select("block", "line", "kind").unionByName(near)
    schema = T.StructType([*rows.drop("block").schema.fields, *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_near"))])

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left)
        near_here = {x for x, k in zip(right.column("line").to_pylist(), right.column("kind").to_pylist()) if k == ASKED}
        remove = b.again | near_here | set(right.column("line").to_pylist())
        texts, counts, removed, close = [], [], [], []
        for offset, lines in zip(b.offset, b.lines):
            if lines is None:
                texts.append(None)
                lines = []
            else:
                texts.append("\n".join(line for j, line in enumerate(lines, offset) if j not in remove))
            numbers = range(offset, offset + len(lines))
            counts.append(len(lines))
            removed.append(sum(j in remove for j in numbers))
            close.append(sum(j in near_here for j in numbers))
        long = lambda x: pa.array(x, pa.int64())
        return pa.table([b.table.column("doc_id"), pa.array(texts, pa.string()), b.table.column("rest"), long(counts), long(removed), long(close)], names=["doc_id", "text", "rest", "n_lines", "n_removed", "n_near"])

    return rows.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(cut, schema)


def drop_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the repeated lines out of its texts and the same columns; n_chars, if there, counts anew."""
    out = dedup_lines(docs, **how)
    cells = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        cells["n_chars"] = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("rest.n_chars"))
    return out.select(*[cells.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])
