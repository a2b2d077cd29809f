"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the arrays P[i] = sum of c[j] * B**j for j < i, modulo two primes, answer whether any
two spans are equal in constant time; the longest common extension of two places is found by halving. The
fingerprint of a text is the hash of its whole span and sketches: the least distinct hashes of its spans of
GRAM code points (if it has SHORT_TEXT or more), of SHORT_GRAM, and of single ones. The likeness of two fingerprints
is the share of common spans among the least hashes of both, by the longest spans that both have sketches of; 1 for
equal texts.

``fingerprints`` meets each document with the next one in descending doc_id by dealing documents out in ranges of
ids and sending the first document of each range to the range before it, too; partitions are streamed, so that a
range has no size limit. Rows without doc_id come after all others, rows with one doc_id in the order of their
texts' hashes. Null text is empty; an empty text has empty sketches, which are like nothing but itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import block_count, mix, worker_cache

PRIMES = (np.uint64((1 << 31) - 1), np.uint64(2147483629))
BASES = (1103515245, 1566083941)
GRAM, SHORT_GRAM, SHORT_TEXT = 8, 3, 32
#: Size of the grams of a sketch, and the shortest text that has it.
SKETCHES = ((GRAM, SHORT_TEXT), (SHORT_GRAM, SHORT_GRAM), (1, 1))
SKETCH = 64
BLOCK_BYTES = 8 << 20
MOST_RANGES = 100_000
NO_ID = -(1 << 63)


def powers(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of base k and of its inverse, by doubling."""
    cache = worker_cache().setdefault("powers", {})
    if k not in cache or len(cache[k][0]) < n:
        p, out = int(PRIMES[k]), []
        for base in (BASES[k], pow(BASES[k], -1, p)):
            x = np.ones(1, np.uint64)
            while len(x) < n:
                x = np.concatenate((x, x * np.uint64(pow(base, len(x), p)) % PRIMES[k]))
            out.append(x)
        cache[k] = tuple(out)
    return cache[k]


class Prefixes:
    """Prefix arrays of several texts laid end to end."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.stop = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        self.start = np.append(0, self.stop)[:-1]
        n = len(points)
        self.sums, self.down = [], []
        for k, p in enumerate(PRIMES):
            up, down = powers(n + 1, k)
            terms = np.zeros(n + 1, np.uint64)
            terms[1:] = (points + np.uint64(1)) * up[:n] % p
            self.sums.append(np.cumsum(terms) % p)
            self.down.append(down)

    def hashes(self, start: np.ndarray, stop: np.ndarray, k: int) -> np.ndarray:
        p = PRIMES[k]
        return (self.sums[k][stop] + p - self.sums[k][start]) % p * self.down[k][start] % p

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A number for each span; equal spans have equal numbers, others differ but for one in 2**61."""
        return self.hashes(start, stop, 0) << np.uint64(31) | self.hashes(start, stop, 1)

    def grams(self, size: int) -> np.ndarray:
        """Hashes of the spans of ``size``."""
        p, sums, down = PRIMES[0], self.sums[0], self.down[0]
        n = max(0, len(sums) - size)
        return mix((sums[size:] + p - sums[:n]) * down[:n] % p) >> np.uint64(32)

    def sketches(self) -> list[tuple[np.ndarray, ...]]:
        """Sketches of each text by falling size of gram; empty ones where the text is too short."""
        by_size = []
        for size, shortest in SKETCHES:
            grams = self.grams(size)
            by_size.append([least(grams[a : b - size + 1] if b - a >= shortest else grams[:0]) for a, b in zip(self.start.tolist(), self.stop.tolist())])
        return list(zip(*by_size))


def least(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH least distinct values."""
    few = 4 * SKETCH
    if len(hashes) > 2 * few:
        some = np.unique(np.partition(hashes, few)[:few])
        if len(some) > SKETCH:
            return some[:SKETCH]
    return np.unique(hashes)[:SKETCH]


def common_extension(a: Prefixes, i: np.ndarray, a_stop: np.ndarray, b: Prefixes, j: np.ndarray, b_stop: np.ndarray) -> np.ndarray:
    """How far the texts agree from places i of a and j of b on, inside the given stops."""
    low, high = np.zeros(len(i), np.int64), np.minimum(a_stop - i, b_stop - j)
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = a.spans(i, i + middle) == b.spans(j, j + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def written(whole: int, sketches: tuple[np.ndarray, ...]) -> str:
    """The whole text's hash, then each sketch after its number of hashes."""
    return f"{whole:016x}" + "".join(f"{len(s):02x}" + s.astype(">u4").tobytes().hex() for s in sketches)


def read(fingerprint: str) -> tuple[int, tuple[np.ndarray, ...]]:
    data, at, sketches = bytes.fromhex(fingerprint), 8, []
    for _ in SKETCHES:
        stop = at + 1 + 4 * data[at]
        sketches.append(np.frombuffer(data[at + 1 : stop], ">u4").astype(np.uint64))
        at = stop
    return int(fingerprint[:16], 16), tuple(sketches)


def likeness(a: tuple[int, tuple[np.ndarray, ...]], b: tuple[int, tuple[np.ndarray, ...]]) -> float:
    if a[0] == b[0] and all(map(np.array_equal, a[1], b[1])):
        return 1.0
    x, y = next(((x, y) for x, y in zip(a[1], b[1]) if len(x) and len(y)), (a[1][-1], b[1][-1]))
    union = np.union1d(x, y)[:SKETCH]
    both = np.intersect1d(x, y, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union)) if len(union) else 0.0


def fingerprint(texts: list[str]) -> tuple[Prefixes, list[tuple[int, tuple[np.ndarray, ...]]]]:
    p = Prefixes(texts)
    return p, list(zip(p.spans(p.start, p.stop).tolist(), p.sketches()))


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_start_edited long, same_start_next long"
OUT_T = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("same_start_edited", pa.int64()), ("same_start_next", pa.int64())])


def compare(ids: list, texts: list[str]) -> pa.RecordBatch:
    """A result for each text but the last, whose successor is not known."""
    own, prints = fingerprint(texts)
    edits = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts, texts[1:])]
    edited, edited_prints = fingerprint(edits)
    n = len(edits)
    with_edited = common_extension(own, own.start[:n], own.stop[:n], edited, edited.start, edited.stop)
    with_next = common_extension(own, own.start[:n], own.stop[:n], own, own.start[1:], own.stop[1:])
    cols = (
        ids[:n], [len(t) for t in texts[:n]], [hashlib.sha256(t.encode()).hexdigest() for t in edits],
        [written(*x) for x in prints[:n]], [written(*x) for x in edited_prints],
        [likeness(a, b) for a, b in zip(prints, edited_prints)], [likeness(a, b) for a, b in zip(prints, prints[1:])],
        with_edited, with_next,
    )
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, OUT_T.types)], schema=OUT_T)


def fingerprints(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): fingerprints of the text and of its edited form (the last third replaced
    by the start of the next document), likenesses, and the lengths of the common starts."""
    n = min(MOST_RANGES, block_count(docs, block_bytes))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    cuts = [i / n for i in range(1, n)] or [0.5]
    shape = docs.agg(F.max(key).alias("most"), F.percentile_approx(key, cuts, F.lit(max(10_000, 20 * n))).alias("cuts")).first()
    most = shape["most"]
    bounds = np.array(sorted({c for c in shape["cuts"] or () if c < most}), np.int64)

    def greatest(batches):
        for b in batches:
            keys = np.sort(b.column("key").to_numpy())
            part = np.searchsorted(bounds, keys)
            last = np.flatnonzero(np.append(part[1:] != part[:-1], True)) if len(part) else part
            yield pa.RecordBatch.from_arrays([pa.array(part[last].astype(np.int32)), pa.array(keys[last])], names=["part", "key"])

    # The percentiles are doubles, which may be no ids at all: ranges end with the greatest id up to each.
    ends = docs.select(key.alias("key")).mapInArrow(greatest, "part int, key long").groupBy("part").agg(F.max("key").alias("key")).collect() if len(bounds) else ()
    limits = np.array(sorted(r["key"] for r in ends if r["key"] < most), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((limits, most))

    def deal(batches):
        """Ranges end with a limit, their greatest id; the document with that id also goes to the range above,
        the greatest of all to the lowest range."""
        limits, most = shared.value
        for b in batches:
            keys = b.column("key").to_numpy()
            part = np.searchsorted(limits, keys)
            at_limit = np.append(limits, most)[part] == keys
            guests = np.flatnonzero(at_limit)
            rows = np.concatenate((np.arange(len(keys)), guests))
            to = np.concatenate((part, np.where(keys[guests] == most, 0, part[guests] + 1)))
            guest = np.repeat([0, 1], [len(keys), len(guests)])
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(guest.astype(np.int32)), b.column("key").take(take), b.column("tie").take(take), b.column("doc_id").take(take), b.column("text").take(take)], names=["part", "guest", "key", "tie", "doc_id", "text"])

    def meet(batches):
        part, done = None, True
        ids: list = []
        texts: list[str] = []
        size = 0
        for b in batches:
            for p, guest, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
                if p != part:
                    if not done:
                        raise RuntimeError(f"range {part} has no document that follows it")
                    part, done, ids, texts, size = p, False, [], [], 0
                if done:
                    continue
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1])
                if guest or size > 1 << 20 and len(texts) > 1:
                    yield compare(ids, texts)
                    ids, texts, size, done = ids[-1:], texts[-1:], len(texts[-1]), bool(guest)
        if not done:
            raise RuntimeError(f"range {part} has no document that follows it")

    rows = docs.select(key.alias("key"), F.xxhash64("text").alias("tie"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.mapInArrow(deal, "part int, guest int, key long, tie long, doc_id long, text string")
    placed = dealt.repartition(n, "part").sortWithinPartitions("part", "guest", F.desc("key"), "tie")
    return placed.mapInArrow(meet, OUT)
