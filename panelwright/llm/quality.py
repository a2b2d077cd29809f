"""Text quality as a Bradley-Terry model: documents win or lose against each other.

Each labelled pair (winner of label 1, loser of label 0) gives a difference of features; logistic loss on those
differences gives a weight for each feature, and a document's strength is its weighted sum. Features are hashed
byte pairs and triples of the whole text, as square roots of their shares, and the share of words that repeat one
just before them. A few fictitious bytes without grams keep short texts near strength 0. The threshold is the quantile
of strength that the share of label 0 asks for, over all documents with a usable label: the middle between the
strengths at that place and the next one, selected exactly in Spark (equal strengths there are the threshold
themselves). Scores are strengths on the logistic scale, moved so that the threshold gets ``cut``.

The fit takes at most ``most`` labelled rows of each label, the first ones by a hash of doc_id, in one task; everything else
covers all rows, the threshold too. Texts are measured where they lie, 256 at a time; only doc_id and strength are
shuffled. A text of any length is measured whole. Null and empty texts have no features and get the score of strength 0. Rows without doc_id are
scored and count as held out. With no pair to learn from, every score is ``cut``. A doc_id labelled twice counts
by its least label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.selection import order_statistics
from .shared import SMALL, Prefix, chunks, parts, raw_texts, stage, unused, word_spans

SIZE = 1 << 12
BACK = 3
#: So many bytes of nothing are added to each text: a few words say little.
PRIOR = 64
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text: 2 * SIZE gram values, then how often a word equals one of the BACK words before it."""
    out = np.zeros((len(texts), 2 * SIZE + BACK), np.float32)
    for a, b in chunks(texts, SMALL):
        data = b" ".join(texts[a:b])
        whole = np.frombuffer(data, np.uint8)
        raw = whole.astype(np.uint32)
        two = raw[:-1] * np.uint32(256) + raw[1:]
        three = two[:-1] * np.uint32(256) + raw[2:]
        two = (two * np.uint32(0x9E3779B1)) >> np.uint32(20)
        three = (three * np.uint32(0x85EBCA77)) >> np.uint32(20)
        start, stop = word_spans(whole)
        word = Prefix(whole).spans(start, stop)
        first = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts[a:b])]))
        again = [np.append(0, np.cumsum(np.append(np.zeros(min(d, len(word)), bool), word[d:] == word[:-d]))) for d in range(1, BACK + 1)]
        at = 0
        for i in range(a, b):
            n = len(texts[i])
            lo, hi = first[i - a], first[i - a + 1]
            if n > 1:
                out[i, :SIZE] = np.sqrt(np.bincount(two[at : at + n - 1], minlength=SIZE) / (n + PRIOR))
            if n > 2:
                out[i, SIZE : 2 * SIZE] = np.sqrt(np.bincount(three[at : at + n - 2], minlength=SIZE) / (n + PRIOR))
            for d in range(1, BACK + 1):
                if hi - lo > d:
                    out[i, 2 * SIZE + d - 1] = np.sqrt((again[d - 1][hi] - again[d - 1][lo + d]) / (hi - lo + PRIOR / 8))
            at += n + 1
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    threshold: float
    cut: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for a, b in chunks(texts):
            for lo in range(a, b, 256):
                strength = features(texts[lo : min(lo + 256, b)]) @ self.weights - self.threshold
                out.append(1 / (1 + (1 / self.cut - 1) * np.exp(-np.clip(strength.astype(float), -500, 500))))
        return np.concatenate(out)


def pairs(winners: int, losers: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row of the longer side meets ``rounds`` of the other, spread evenly."""
    n = max(winners, losers)
    i = np.tile(np.arange(n), rounds)
    shift = np.repeat(np.arange(rounds) * 7919 + 1, n)
    return (i % winners, (i + shift) % losers) if winners >= losers else ((i + shift) % winners, i % losers)


def learn(x: np.ndarray, win: np.ndarray, lose: np.ndarray, steps: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Weights of least logistic loss on x[win] - x[lose], by accelerated gradient steps."""
    w = np.zeros(x.shape[1], np.float32)
    before, rate = w, 2.0
    for k in range(steps):
        v = w + np.float32(k / (k + 3)) * (w - before)
        u = x @ v
        pull = 1 / (1 + np.exp(np.clip(u[win] - u[lose], -50, 50)))
        each = np.bincount(win, pull, len(x)) - np.bincount(lose, pull, len(x))
        before, w = w, (v + np.float32(rate) * ((each / len(win)).astype(np.float32) @ x - np.float32(decay) * v)).astype(np.float32)
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3, most: int = 1000, rounds: int = 8) -> Model:
    """``docs`` has doc_id and text, ``labels`` doc_id and ``label`` (1 wins over 0)."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(label).alias("won"))
    share = known.agg(F.avg("won")).first()[0]
    if share is None or share in (0, 1):
        return Model(np.zeros(2 * SIZE + BACK, np.float32), 0.0, cut)
    order = F.xxhash64("doc_id", F.lit(1))
    chosen = [known.where(F.col("won") == side).orderBy(order, "doc_id").limit(most) for side in (1, 0)]
    chosen = chosen[0].unionByName(chosen[1])
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for b in parts(batches):
            x = features(raw_texts(b)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("won").cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "won", "x"])

    def weigh(table):
        order = pa.compute.sort_indices(table.select(["doc_id"]), sort_keys=[("doc_id", "ascending")]).to_numpy()
        won = table.column("won").to_numpy()[order]
        if len(set(won.tolist())) < 2:
            return pa.table({"weights": pa.array([], pa.binary())})
        x, place = np.empty((len(won), 2 * SIZE + BACK), np.float32), np.argsort(order)
        for i, row in zip(place, (v for c in table.column("x").chunks for v in c)):
            x[i] = np.frombuffer(row.as_buffer(), np.float16)
        good, bad = np.flatnonzero(won == 1), np.flatnonzero(won == 0)
        win, lose = pairs(len(good), len(bad), rounds)
        return pa.table({"weights": pa.array([learn(x, good[win], bad[lose]).tobytes()], pa.binary())})

    # the chosen rows meet in one task; the driver gets the weights only
    measured = rows.select("doc_id", "won", "text").mapInArrow(run, "doc_id long, won int, x binary")
    learned = measured.groupBy().applyInArrow(weigh, "weights binary").first()
    if learned is None:
        return Model(np.zeros(2 * SIZE + BACK, np.float32), 0.0, cut)
    w = np.frombuffer(learned[0], np.float32)
    return Model(w, threshold(labelled_strengths(docs, known, w)), cut)


def labelled_strengths(docs: DataFrame, known: DataFrame, weights: np.ndarray) -> DataFrame:
    """(won, strength) of every document that ``known`` (doc_id, won) has a label for, as a written table."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for b in parts(batches):
            texts = raw_texts(b)
            each = [features(texts[lo : lo + 256]) @ shared.value for lo in range(0, len(texts), 256)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate([np.zeros(0), *each]))], names=["doc_id", "strength"])

    measured = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, strength double")
    return stage(measured.join(known.select(F.col("doc_id").cast("long").alias("doc_id"), "won"), "doc_id").select("won", "strength"), "strengths")


def threshold(strengths: DataFrame) -> float:
    """With z rows of label 0: the middle between the z-th and the next strength from below."""
    zeros = strengths.where("won = 0").count()
    one = strengths.select(F.lit(0).alias("all"), "strength")
    found = order_statistics(one, ["all"], ["strength"], lambda n: [F.greatest(F.lit(1), F.least(n, F.lit(zeros))), F.least(n, F.lit(zeros + 1))])
    low, high = found.first()["values"]
    return (low + high) / 2


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of ``docs`` (text among them) and the score of each row; an equally named column gives way."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches):
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.scores(raw_texts(b)))], names=[*b.schema.names, column])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns."""
    model = fit(docs, labels, **how)
    name = unused(docs, "score")
    return score(docs, model, name).where(F.col(name) >= model.cut).drop(name)
