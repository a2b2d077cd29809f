"""Conversation prefix trie by fixed-length block hashing.

The turns of a conversation are cut into blocks of ``BLOCK`` turns. A block's digest covers its turns and its
number; a path is the sum of the digests up to a block, in two lanes of 60 bits, so that running sums give it and
no conversation has to be read from its start by one task. Conversations are grouped by path first. Only the
distinct blocks that follow one path are then cut at turn boundaries, and only where several of them
(siblings) follow it are the cuts grouped once more; a block without siblings is a chain of nodes as it is.

A node is named by its smallest member and its depth. The nodes a conversation names are a tail of its own
path, so that what is summed over a subtree is a sum over members: of what each member names, less what the
smallest one names above. No step goes through the trie level by level.

Rows without conv_id belong to no conversation and are left out; a null role or text is empty. Turns go by number,
null first; turns with equal numbers by a digest of role and text, and repeated rows are turns of their own. An
empty table has no nodes, not even a root. A text of any length is only digested and counted. Columns other than
conv_id, turn, role and text are ignored. A conversation of any length, a turn shared by any number of
conversations and any number of equal conversations are spread: positions and paths are running sums in slots
of ``SLOT`` entries, and the ids of equal conversations are joined in chunks before they are digested.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage

BLOCK = 8
SLOT_BITS = 8
CHUNK_BITS = 10
ROOT = "0:0:0"
ENDS = "key string, n_ends long, ends_sha256 string"
ENDS_T = pa.schema([("key", pa.string()), ("n_ends", pa.int64()), ("ends_sha256", pa.string())])


def running(df: DataFrame, by: str, slot: Column, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds the sum of each column of ``sums`` over the rows of ``by`` before a row: inside its slot, and of the
    slots before. ``slot`` must not decrease with ``order``."""
    df = df.withColumn("slot", slot)
    before = Window.partitionBy(by).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(by, "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(by, "slot").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    offsets = totals.select(by, "slot", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}__") for n in sums])
    own = df.withColumns({n: F.coalesce(F.sum(c).over(within), F.lit(0)) for n, c in sums.items()})
    return own.join(offsets, [by, "slot"]).withColumns({n: F.col(n) + F.col(f"{n}__") for n in sums}).drop("slot", *[f"{n}__" for n in sums])


def spread(df: DataFrame, length: Column) -> DataFrame:
    """A row for each slot of 0 .. length - 1, to be joined with rows that carry their slot."""
    return df.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.greatest(length - 1, F.lit(0)).cast("long"), SLOT_BITS))))


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos, digest, chars) with positions from 0, and conversations (conv_id, n_turns)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )
    rows = stage(rows, "turns")
    slot = F.coalesce(F.shiftright("turn", SLOT_BITS), F.lit(-(1 << 62)))
    placed = running(rows, "conv_id", slot, ["turn", "digest"], {"pos": F.lit(1).cast("long")})
    turns = stage(placed.select("conv_id", "pos", "digest", "chars"), "turns")
    return turns, turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def graft(turns: DataFrame, convs: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Give each conversation c the first h turns of conversation c - c % every in place of its own first h, with
    h = crc32(c) % most: a corpus whose conversations share starts. Returns turns and conversations."""
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most - 1)).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head"))
    plan = convs.select("conv_id", "n_turns", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"))
    plan = plan.join(heads, "base", "left").withColumn("head", F.slice("head", F.lit(1), F.col("h")))
    plan = stage(plan.withColumn("m", F.greatest(F.size("head"), F.lit(0)).cast("long")), "heads")
    shifts = spread(plan.where("n_turns > h").select("conv_id", "h", "m", "n_turns"), F.col("n_turns")).drop("n_turns")
    own = turns.withColumn("slot", F.shiftright("pos", SLOT_BITS)).join(shifts, ["conv_id", "slot"]).where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "chars")
    lengths = plan.select("conv_id", (F.col("m") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(plan.select("conv_id", F.inline("head"))), lengths


def _lanes(digest: Column) -> list[Column]:
    return [F.conv(F.substring(digest, i, 15), 16, 10).cast("decimal(20,0)") for i in (1, 16)]


def _key(j: Column | int) -> Column:
    """A node inside a block by what leads to it; at the block's end the path itself, as the next block names it."""
    inside = F.md5(F.concat("parent", F.array_join(F.slice("cells.digest", F.lit(1), F.greatest(F.lit(1), j)), "")))
    return F.when(j == 0, F.col("parent")).when(j == BLOCK, F.col("path")).otherwise(inside)


def blocks_of(turns: DataFrame) -> DataFrame:
    """(conv_id, k, cells, parent, path): each block of each conversation, between the paths before and after it."""
    blocks = turns.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("k")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("cells"))
    one, two = _lanes(F.md5(F.concat_ws(":", F.col("k").cast("string"), F.array_join("cells.digest", ""))))
    summed = running(blocks.withColumns({"l1": one, "l2": two}), "conv_id", F.shiftright("k", SLOT_BITS), ["k"], {"s1": F.col("l1"), "s2": F.col("l2")})
    name = lambda k, *lanes: F.concat_ws(":", k.cast("string"), *[x.cast("decimal(30,0)").cast("string") for x in lanes])
    return summed.select(
        "conv_id", "k", "cells",
        name(F.col("k"), F.col("s1"), F.col("s2")).alias("parent"),
        name(F.col("k") + 1, F.col("s1") + F.col("l1"), F.col("s2") + F.col("l2")).alias("path"),
    )


def _refine(groups: DataFrame, sums: dict[str, Column], keep: dict[str, Column]) -> DataFrame:
    """Distinct blocks cut at their turns; blocks with siblings are summed by what leads to a cut."""
    cuts = groups.select("*", F.posexplode("cells").alias("j", "cell")).withColumn("j", F.col("j") + 1)
    cuts = cuts.select(_key(F.col("j")).alias("key"), _key(F.col("j") - 1).alias("parent_key"), (F.col("k") * BLOCK + F.col("j")).alias("depth"), F.col("cell.chars").alias("chars"), "lone", *sums)
    names = [*keep, *sums]
    merged = cuts.where("not lone").groupBy("key").agg(*[F.min(c).alias(n) for n, c in keep.items()], *[f.alias(n) for n, f in sums.items()])
    return cuts.where("lone").select("key", *names).unionByName(merged.select("key", *names))


def ends_of(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, n_ends, ends_sha256): of the conversations that end at a node, in numerical order."""
    last = blocks.withColumn("key", _key(F.size("cells"))).groupBy("conv_id").agg(F.max_by("key", "k").alias("key"))
    rows = last.unionByName(convs.where("n_turns = 0").select("conv_id", F.lit(ROOT).alias("key")))
    chunks = rows.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("key", "chunk", F.size("ids").cast("long").alias("n"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def digest(batches):
        key, n, state = None, 0, None
        for b in batches:
            out = []
            for k, m, ids in zip(*(b.column(c).to_pylist() for c in ("key", "n", "ids"))):
                if k == key:
                    n += m
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((key, n, state.hexdigest()))
                    key, n, state = k, m, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), ENDS_T.types)], schema=ENDS_T)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((key, n, state.hexdigest()), ENDS_T.types)], schema=ENDS_T)

    return chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "n", "ids").mapInArrow(digest, ENDS)


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each distinct start of conversations, from ``turns`` (conv_id, pos, digest, chars) and ``convs``
    (conv_id, n_turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points that members after the first need not send again, over the subtree), n_ends and
    ends_sha256 (of the ids of members that end there)."""
    blocks = stage(blocks_of(turns), "blocks")
    groups = blocks.groupBy("parent", "k", "path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.any_value("cells").alias("cells"))
    groups = stage(groups, "paths")
    alone = groups.groupBy("parent").agg(F.count(F.lit(1)).alias("c"), F.min("path").alias("path")).where("c = 1").select("path", F.lit(True).alias("lone"))
    groups = groups.join(alone, "path", "left").withColumn("lone", F.coalesce("lone", F.lit(False)))
    groups = stage(groups, "paths")
    keep = {c: F.col(c) for c in ("parent_key", "depth", "chars")}
    nodes = _refine(groups, {"n": F.sum("n"), "first": F.min("first")}, keep)
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")).where("n > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent_key"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), "n", "first")
    nodes = stage(nodes.unionByName(root), "nodes")
    children = nodes.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "saved": (F.col("n") - 1) * F.col("chars")})
    nodes = stage(nodes, "nodes")

    # what a conversation names, summed over the members of each node
    named = nodes.groupBy(F.col("first").alias("conv_id")).agg(F.sum("saved").alias("w"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"))
    named = named.where("w > 0 or leaf > 0").join(convs, "conv_id")
    by_block = spread(named, F.ceil(F.col("n_turns") / BLOCK)).select("conv_id", "slot", "w", "leaf")
    weighed = blocks.select("conv_id", "path", F.shiftright("k", SLOT_BITS).alias("slot")).join(by_block, ["conv_id", "slot"]).groupBy("path").agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf"))
    sums = _refine(groups.join(weighed, "path", "left"), {"w": F.sum("w"), "leaf": F.sum("leaf")}, {})
    sums = sums.unionByName(named.agg(F.sum("w").alias("w"), F.sum("leaf").alias("leaf")).select(F.lit(ROOT).alias("key"), "w", "leaf"))

    above = running(nodes, "first", F.shiftright("depth", SLOT_BITS), ["depth"], {"above": F.col("saved")})
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("first").alias("parent_conv_id"))
    out = above.join(sums, "key", "left").join(ends_of(blocks, convs), "key", "left").join(parents, "parent_key", "left")
    return out.select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("leaf", F.lit(0).cast("long")).alias("n_leaves"),
        (F.coalesce("w", F.lit(0).cast("long")) - F.col("above")).alias("saved_tokens"),
        F.coalesce("n_ends", F.lit(0).cast("long")).alias("n_ends"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
