"""Byte-level BPE by a global distinct-word shuffle.

A block of documents explodes its texts into pre-tokens with positions: its distinct words, and the word's number
at each position. Each distinct word goes once to the bucket of its hash. A bucket merges each distinct word
once for the whole corpus and sends the ids back to the blocks that asked. The block then puts the ids together
by position. Decoding joins the token-byte table, whose size is that of the vocabulary file.

Blocks are named by their content and follow the order of the input files; an input without a fixed order (the
result of a shuffle) should be written before it is encoded, as the stages of the pipeline are.

Null text counts as empty: no ids, no bytes. Rows are neither merged nor dropped; repeated rows give repeated
results. A document of any length is one row of a block of its own size. Bytes that no rank covers fail, as in
any rank file that lacks single bytes.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import block_count, bucket_rows, pack_strings, parts, raw_texts, squeeze, unpack_strings, unsqueeze, worker_cache

BLOCK_BYTES = 8 << 20
BLOCKS = "block long, doc_id array<long>, n_bytes binary, counts binary, codes binary, lengths binary, words binary"
WORDS = "block long, bucket int, lengths binary, words binary"
CODES = "block long, bucket int, sizes binary, ids binary"
BLOCKS_T = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("n_bytes", "counts", "codes", "lengths", "words"))])
WORDS_T = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lengths", pa.binary()), ("words", pa.binary())])
CODES_T = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("sizes", pa.binary()), ("ids", pa.binary())])
ENCODED = "doc_id long, n_bytes long, ids array<int>"
ENCODED_T = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int32()))])


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token, blank, id."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    """The merges of one pre-token, made once in a worker."""
    cache = worker_cache()
    if cache.get("encoding_key") != (len(ranks), pattern, hash(frozenset(ranks.items()))):
        cache["encoding_key"] = (len(ranks), pattern, hash(frozenset(ranks.items())))
        cache["encoding"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return cache["encoding"]


def narrow(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the greatest needs, compressed; the first byte tells the width."""
    width = 1 if (most := int(x.max(initial=0))) < 256 else 2 if most < 65536 else 4
    return bytes([width]) + squeeze(x.astype(f"<u{width}").tobytes())


def widen(data: bytes) -> np.ndarray:
    return np.frombuffer(unsqueeze(data[1:]), f"<u{data[0]}")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, blocks: int | None = None, block_bytes: int = BLOCK_BYTES, then=None, schema: str = ENCODED) -> DataFrame:
    """(doc_id, n_bytes, ids) for each row of ``docs`` (doc_id, text); ``then`` may turn each block's rows into
    others of the given schema before they leave the worker."""
    n = blocks or block_count(docs, block_bytes)
    table = docs.sparkSession.sparkContext.broadcast(ranks)

    def explode(batches):
        find = regex.compile(pattern).findall
        for b in parts(batches, block_bytes):
            texts = raw_texts(b)
            number: dict[str, int] = {}
            at = [np.fromiter((number.setdefault(w, len(number)) for w in find(t.decode())), np.uint32) for t in texts]
            ids = b.column("doc_id").cast(pa.int64())
            name = xxhash.xxh3_64(repr(ids.to_pylist()).encode())
            for t in texts:
                name.update(t)
            lengths, words = pack_strings([w.encode() for w in number])
            cells = (name.intdigest() - (1 << 63), ids.to_pylist(), squeeze(np.array([len(t) for t in texts], np.int64).tobytes()), narrow(np.array([len(x) for x in at])), narrow(np.concatenate(at)), lengths, words)
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, BLOCKS_T.types)], schema=BLOCKS_T)

    def in_buckets(words: list[bytes]):
        return bucket_rows(np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)), n)

    def send(group: pa.Table) -> pa.Table:
        words = unpack_strings(group.column("lengths")[0].as_py(), group.column("words")[0].as_py())
        block = group.column("block")[0].as_py()
        out = [(block, bucket, *pack_strings([words[i] for i in part])) for bucket, part in in_buckets(words)]
        return pa.table([list(c) for c in zip(*out)] or [[], [], [], []], schema=WORDS_T)

    def encode_once(group: pa.Table) -> pa.Table:
        known: dict[bytes, list[int]] = {}
        ids_of = encoding(table.value, pattern).encode_ordinary
        sizes, ids = [], []
        for lengths, words in zip(group.column("lengths").to_pylist(), group.column("words").to_pylist()):
            got = []
            for w in unpack_strings(lengths, words):
                if (code := known.get(w)) is None:
                    code = known[w] = ids_of(w.decode())
                got.append(code)
            sizes.append(narrow(np.fromiter(map(len, got), np.uint32, len(got))))
            ids.append(narrow(np.fromiter(chain.from_iterable(got), np.uint32)))
        return pa.table([group.column("block"), group.column("bucket"), pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())], schema=CODES_T)

    def put_back(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            words = unpack_strings(row["lengths"], row["words"])
            size, start = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            codes_of = {b: (s, i) for b, s, i in zip(*(right.column(c).to_pylist() for c in ("bucket", "sizes", "ids")))}
            flat, held = [np.zeros(0, np.int32)], 0
            for bucket, part in in_buckets(words):
                sizes, ids = (widen(x) for x in codes_of[bucket])
                size[part] = sizes
                start[part] = held + np.cumsum(sizes, dtype=np.int64) - sizes
                flat.append(ids.astype(np.int32))
                held += len(ids)
            flat = np.concatenate(flat)
            codes, counts = widen(row["codes"]), widen(row["counts"])
            ends = np.cumsum(counts, dtype=np.int64)
            lists = []
            for lo, hi in zip((ends - counts).tolist(), ends.tolist()):
                m = size[codes[lo:hi]]
                stop = np.cumsum(m)
                lists.append(flat[np.repeat(start[codes[lo:hi]] - stop + m, m) + np.arange(stop[-1])] if len(m) else flat[:0])
            offsets = np.cumsum([0, *map(len, lists)])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists)))
            out.append(pa.table([pa.array(row["doc_id"], pa.int64()), pa.array(np.frombuffer(unsqueeze(row["n_bytes"]), np.int64)), ids], schema=ENCODED_T))
        table = pa.concat_tables(out) if out else ENCODED_T.empty_table()
        return then(table) if then else table

    rows = docs.select("doc_id", "text").mapInArrow(explode, BLOCKS).repartition(n, "block")
    words = rows.groupBy("block").applyInArrow(send, WORDS)
    codes = words.repartition(n, "bucket").groupBy("bucket").applyInArrow(encode_once, CODES)
    return rows.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(put_back, schema)


def token_bytes(ranks: dict[bytes, int]) -> np.ndarray:
    """The token-byte table, by id."""
    out = np.full(max(ranks.values(), default=0) + 1, None, object)
    for t, i in ranks.items():
        out[i] = t
    return out


def join_bytes(lists: pa.ListArray, token: np.ndarray) -> list[bytes | None]:
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    return [b"".join(token[flat[i:j]].tolist()) if ok else None for i, j, ok in zip(at[:-1], at[1:], lists.is_valid().to_pylist())]


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that a column of ids stands for; null ids give null. The token-byte table has one row per
    id, so that each batch holds its hash side whole."""
    table = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        token = token_bytes(table.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(join_bytes(b.column(ids), token), pa.binary())], [*b.schema.names, out])

    return encoded.mapInArrow(run, schema)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same_bytes boolean"
DIGESTS_T = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("same_bytes", pa.bool_())])


def encode_digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encodes, decodes, and gives counts, digests of ids and of decoded bytes, whether as many bytes came back as
    went in, and the ids if asked for."""
    kind = DIGESTS_T.append(pa.field("ids", pa.list_(pa.int32()))) if keep_ids else DIGESTS_T
    table = docs.sparkSession.sparkContext.broadcast(ranks)

    def digest(rows: pa.Table) -> pa.Table:
        cache = worker_cache()
        if cache.get("bytes_of") is not table.value:
            cache["bytes_of"], cache["bytes"] = table.value, token_bytes(table.value)
        out = []
        for b in rows.to_batches(max_chunksize=256):
            ids = b.column("ids")
            packed, at = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            digests = [hashlib.sha256(packed[i:j]).hexdigest() for i, j in zip(at[:-1], at[1:])]
            decoded = join_bytes(ids, cache["bytes"])
            same = [len(x) == n for x, n in zip(decoded, b.column("n_bytes").to_pylist())]
            cols = [b.column("doc_id"), np.diff(at), digests, [hashlib.sha256(x).hexdigest() for x in decoded], same, ids]
            out.append(pa.table([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kind.types)], schema=kind))
        return pa.concat_tables(out) if out else kind.empty_table()

    return encode(docs, ranks, pattern, then=digest, schema=DIGESTS + ", ids array<int>" * keep_ids)
