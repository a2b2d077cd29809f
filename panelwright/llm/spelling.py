"""Spelling variants by a bit-sliced position index.

Words that differ by one inserted, deleted or replaced letter agree on one half of the shorter one: its first or
its last half. So every word goes to a few *buckets*, named by a length and the half that is shared; a bucket of
more than ``CROWDED`` words is halved again inside the part that is left, until it fits or one letter is left,
when the alphabet bounds it. A pair that shares both halves is kept in the bucket of the first one only, so each
pair is found once.

A bucket's words are columns of bits: for each position and letter a bitset over the words, ordered by falling
count. For all words of a block of buckets at once, word-parallel recurrences carry three sets of words: those
without error so far, those with one replacement, and those shifted by one letter (inserted or deleted). The
number of bits set is the number of near words, and the first bit set is the most frequent of them.

Null and empty texts have no words; rows without doc_id count as rows of the empty id; repeated rows count again;
texts and runs of any length are whole. Ties of counts go to the smaller word in code-point order. An empty table
gives no words. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

LEAST = 7
#: Letters of a run, as a pattern.
LETTERS = "A-Za-zÀ-ÿ"
CROWDED = 4096
BLOCK_WORDS = 512
BLOCK_LETTERS = 1 << 22
NEAR = "word string, n_near long, form_n long, form string"
NEAR_T = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
#: The shorter length, letters shared at the start and at the end, and how many may not be shared at the start.
SHAPE = ("m", "a", "b", "cap")
FREE = 1 << 30


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, run) for each run of at least ``least`` letters; only A-Z are lower-cased."""
    found = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return docs.select("doc_id", found.alias("run")).select("doc_id", F.translate("run", upper, upper.lower()).alias("run"))


def misspelt(rows: DataFrame, every: int = 31) -> DataFrame:
    """(word): a run loses one letter if ``every`` divides the crc32 of its document and itself."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("left(run, CAST(h % length(run) AS INT))"), F.substring("run", at + 2, F.length("run")))
    return rows.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST, often: int = 2) -> DataFrame:
    """(word, n): words of at least ``least`` letters that occur ``often`` times."""
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)


def _halves(rows: DataFrame) -> DataFrame:
    """Each word of a bucket in the two buckets of the next halves: of what is shared before and after them, ``a``
    and ``b`` letters, one grows by half of what is left of ``m``. In the second one a pair does not count that
    shares ``cap`` letters at its start; where all do, there is nothing to find."""
    half = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("cap").alias("cap"))
    last = F.struct(F.col("a").alias("a"), (F.col("b") + half).alias("b"), F.least("cap", F.col("a") + half).alias("cap"))
    rows = rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("to")).select("word", "n", "m", "to.*").where("a < cap")
    return rows.withColumn("key", _bucket())


def _bucket() -> Column:
    return F.concat(F.expr("left(word, a)"), F.lit(" "), F.expr("right(word, b)"))


def buckets(words: DataFrame, least: int = LEAST, crowded: int = CROWDED) -> DataFrame:
    """(word, n, m, a, b, cap, key): the buckets of each word; none holds more than ``crowded`` words but those with
    one letter left."""
    start = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")).where(F.col("m") >= least)
    rows = stage(_halves(start.withColumns({"a": F.lit(0), "b": F.lit(0), "cap": F.lit(FREE)})), "buckets")
    done = None
    while True:
        full = rows.groupBy(*SHAPE, "key").agg(F.count(F.lit(1)).alias("c")).where((F.col("c") > crowded) & (F.col("m") - F.col("a") - F.col("b") > 1))
        full = stage(full.select(*SHAPE, "key", F.lit(True).alias("full")), "crowded")
        if full.isEmpty():
            return rows if done is None else done.unionByName(rows)
        told = rows.join(full, [*SHAPE, "key"], "left")
        fit = told.where("full is null").drop("full")
        done = fit if done is None else done.unionByName(fit)
        rows = stage(_halves(told.where("full")), "buckets")


def near_sets(mids: list[str], groups: np.ndarray, m: int, cap: int) -> np.ndarray:
    """Bits (word, word): which words differ by one letter, of words whose shared letters are cut off. ``m`` is the
    length of the shorter ones left (the others have one more), ``groups`` their buckets, ``cap`` the number of
    equal letters at the start that rules a pair out. Bits follow the order of ``mids``."""
    count = len(mids)
    width = -(-count // 64)
    long = np.fromiter((len(x) > m for x in mids), bool, count)
    flat = np.frombuffer("".join(x if len(x) > m else x + "\0" for x in mids).encode("utf-32-le"), np.uint32)
    alphabet, codes = np.unique(flat, return_inverse=True)
    letters = codes.reshape(count, m + 1)
    place, bit = np.arange(count) // 64, np.uint64(1) << (np.arange(count) % 64).astype(np.uint64)

    def slices(labels: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros((size, width), np.uint64)
        np.bitwise_or.at(out, (labels, place), bit)
        return out

    at = [slices(letters[:, i], len(alphabet)) for i in range(m + 1)]  # (letter, words): the index of a position
    of_length = slices(long.astype(np.intp), 2)
    here = slices(groups, int(groups.max()) + 1)[groups]
    exact, replaced, inserted, deleted = here, np.zeros_like(here), np.zeros_like(here), np.zeros_like(here)
    same_start = here if cap <= 0 else None
    for i in range(m + 1):
        before = exact
        if i < m:
            mine, next_one = at[i][letters[:, i]], at[i + 1][letters[:, i]]
            replaced = (replaced & mine) | (before & ~mine)
            inserted = (inserted | before) & next_one
            exact = before & mine
        # a longer word drops its letter i: what follows meets the others one place to the left
        deleted = (deleted & at[i - 1][letters[:, i]] if i else deleted) | before
        if i + 1 == cap:
            same_start = exact
    longer = inserted | exact
    found = np.where(long[:, None], deleted & of_length[0], (replaced & of_length[0]) | (longer & of_length[1]))
    return found & ~same_start if same_start is not None else found


def _blocks(batches):
    """Whole buckets of one shape, about ``BLOCK_WORDS`` words or ``BLOCK_LETTERS`` letters together."""
    shape, held, size = None, [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in (*SHAPE, "key", "n", "word"))):
            if held and (row[:4] != shape or (row[4] != held[-1][4] and (len(held) >= BLOCK_WORDS or size >= BLOCK_LETTERS))):
                yield held
                held, size = [], 0
            shape = row[:4]
            held.append(row)
            size += len(row[6])
    if held:
        yield held


def _lowest(bits: np.ndarray) -> np.ndarray:
    """The number of the first bit set of each row that has one."""
    word = (bits != 0).argmax(axis=1)
    cell = bits[np.arange(len(bits)), word]
    return word * 64 + np.log2((cell & (~cell + np.uint64(1))).astype(np.float64)).astype(np.int64)


def _near(batches):
    for rows in _blocks(batches):
        m, a, b, cap = rows[0][:4]
        rows = sorted(rows, key=lambda r: (-r[5], r[6]))
        members = Counter(r[4] for r in rows)
        rows = [r for r in rows if members[r[4]] > 1]
        if not rows:
            continue
        number = {key: i for i, key in enumerate({r[4] for r in rows})}
        groups = np.array([number[r[4]] for r in rows])
        words = [r[6] for r in rows]
        found = near_sets([w[a : len(w) - b] for w in words], groups, m - a - b, cap - a)
        counts = np.bitwise_count(found).sum(axis=1)
        hit = np.flatnonzero(counts)
        if len(hit):
            best = _lowest(found[hit])
            cols = [[words[i] for i in hit], counts[hit], [rows[i][5] for i in best], [words[i] for i in best]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, NEAR_T.types)], schema=NEAR_T)


def near_words(words: DataFrame, least: int = LEAST, crowded: int = CROWDED) -> DataFrame:
    """(word, n_near, form_n, form): how many words differ by one letter, and the most frequent of them."""
    rows = buckets(words, least, crowded)
    rows = rows.repartition(*SHAPE, "key").sortWithinPartitions(*SHAPE, "key").select(*SHAPE, "key", "n", "word")
    found = rows.mapInArrow(_near, NEAR)
    # the greatest count first, then the smallest word of it
    most = found.groupBy("word", "form_n").agg(F.sum("n_near").alias("n_near"), F.min("form").alias("form"))
    return most.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.max("form_n").alias("form_n"), F.max_by("form", "form_n").alias("form"))


def variants(words: DataFrame, least: int = LEAST, times: int = 10, crowded: int = CROWDED) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n): the form of a word is its most frequent near
    word if that occurs ``times`` as often; the root is the last of its forms."""
    words = stage(words, "words")
    near = near_words(words, least, crowded)
    told = words.join(near, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    has = F.col("form_n") >= times * F.col("n")
    told = stage(told.withColumns({"form": F.when(has, F.col("form")), "form_n": F.when(has, F.col("form_n"))}), "near")
    step = told.where("form is not null").select(F.col("word").alias("at"), F.col("form").alias("next"))
    going = stage(step.select(F.col("at").alias("word"), F.col("next").alias("at")), "forms")
    ended = None
    while True:  # each form occurs ``times`` as often as the one before, so chains are short
        moved = stage(going.join(step, "at", "left"), "forms")
        last = moved.where("next is null").select("word", F.col("at").alias("root"))
        ended = last if ended is None else ended.unionByName(last)
        going = moved.where("next is not null").select("word", F.col("next").alias("at"))
        if going.isEmpty():
            break
    return told.join(ended, "word", "left").withColumn("root", F.coalesce("root", "word"))
