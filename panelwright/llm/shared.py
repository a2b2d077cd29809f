"""What the operators of this package share: the written-stage folder, blocks of documents, buckets of keys.

Block and bucket: a *block* is a few MB of whole documents, chosen by a hash of the row, so that a task that
is computed again gets the same rows. Inside a block Python may pre-aggregate. What must meet across blocks
(words, hashes) travels as packed arrays, one row per (block, bucket) with something in it; a *bucket* is a
range of key hashes. A block or bucket is bounded by parameters, never by how often a key occurs, because
each block sends a key once.
"""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BLOCK_BYTES = 4 << 20
#: Bytes of text that are hashed at once: their arrays of 64-bit words take some 20 times as much.
SMALL = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a single-process session may lack the setting."""
    root = spark.conf.get(CHECKPOINT, None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError(f"set {CHECKPOINT} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="panelwright-")
        spark.conf.set(CHECKPOINT, root)
    return root.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs do not depend on lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Rows go to Python in batches of at most ``most`` bytes, unless the session has a setting of its own. Spark's
    64 MB are held several times by each task, outside the heap, and such large pieces are not all given back."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, most)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number, to size blocks with."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, -(-text_bytes(docs) // block_bytes))


def row_block(n: int) -> Column:
    """All rows of a doc_id share a block; rows without one are spread by their text."""
    return F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(n)).cast("int")


def in_blocks(docs: DataFrame, n: int) -> DataFrame:
    """(block, doc_id, text), dealt by block. Used several times in a plan, Spark shuffles it once."""
    return docs.select(row_block(n).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartition(n, "block")


def sorted_rows(table: pa.Table) -> pa.Table:
    """A block's rows in one order, however they arrived: by doc_id, rows without one last, then by text."""
    return table.take(pa.compute.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")]))


def raw_texts(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [x or b"" for x in table.column("text").cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Prefix sums of b[i] * BASE**i modulo 2**64 over a byte array: the hash of any span in a few operations.

    Spans of up to about a thousand bytes only; for longer ones this modulus has known collisions.
    """

    BASE = 0x5851F42D4C957F2D
    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) < n:
            size = max(n, 2 * len(cls._up))
            up, down = np.full(size, cls.BASE, np.uint64), np.full(size, pow(cls.BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            cls._up, cls._down = np.cumprod(up), np.cumprod(down)
        return cls._up, cls._down

    def __init__(self, data: np.ndarray):
        n = len(data)
        up, self.down = self.powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])

    def grams(self, q: int) -> np.ndarray:
        """The hash of each span of q bytes."""
        n = len(self.sums) - q
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[q:] - self.sums[:n]) * self.down[:n])


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of bytes other than 09-0D and 20."""
    edge = np.diff(np.concatenate(([True], SPACE[data], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def runs(sizes: list[int], most: int):
    """Runs (first, last) of items of about ``most`` in all, a larger item alone."""
    first = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield first, len(sizes)


def chunks(texts: list[bytes], most: int = 1 << 20):
    """Runs (first, last) of documents of about ``most`` bytes, a longer document alone."""
    return runs([len(t) for t in texts], most)


def parts(batches, most: int = 1 << 20):
    """The batches in slices of about ``most`` bytes of text: of a large batch, only a part is ever in Python objects."""
    for b in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0).to_pylist()
        for lo, hi in runs(sizes, most):
            yield b.slice(lo, hi - lo)


def bucket_rows(keys: np.ndarray, n: int):
    """Order by bucket (the high bits of a key), and the slices: (bucket, selection)."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut) if len(order) else ():
        yield int(bucket[part[0]]), part



def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True) if data else b""


def unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True) if data else b""


def pack_strings(strings: list[bytes]) -> tuple[bytes, bytes]:
    """Lengths and contents, each compressed."""
    return squeeze(np.fromiter(map(len, strings), np.uint32, len(strings)).tobytes()), squeeze(b"".join(strings))


def unpack_strings(lengths: bytes, contents: bytes) -> list[bytes]:
    data = unsqueeze(contents)
    stop = np.cumsum(np.frombuffer(unsqueeze(lengths), np.uint32), dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *stop], stop)]


def worker_cache() -> dict:
    """What a Python worker keeps from task to task."""
    return vars(sys.modules.setdefault("panelwright_worker_cache", types.ModuleType("panelwright_worker_cache")))
