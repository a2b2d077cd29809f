"""MinHash near-duplicates on an LSH forest.

Texts with equal shingle sets form a class, known by a 128-bit digest; everything below works on classes. Each
tree of the forest orders the signatures by another permutation of their places. All trees are sorted at once by
(region, order), a region being the classes of a tree that share its first ``depth`` places; a large region
simply spans several sorted partitions.

First pass: a class proposes its most similar neighbour of longest common prefix. How deep that prefix has to
reach depends on the region: in a small one every member is a neighbour, in a large one those next in order, and
the member closest to the region's most frequent values. The proposals are confirmed on full shingle sets, and
give most components.
Second pass, the exact rest: wherever a region still holds different components, all its members of different
components are compared by signature and confirmed on full sets; a region too large for one task is cut into
pieces, each of which meets the pieces of members outside the region's main component.

Two texts at the threshold of 0.85 share the first 4 places of one of 16 trees but for 1 in 100,000, at 0.8 the
first 3; the comparison of signatures loses fewer.

Rows without text or words have no class, are linked with nothing and kept. Rows are in the order of doc_id, those
without one last, then of their texts' hashes; the first of a component is kept and names it (null if it has no
doc_id). Repeated rows share a class and a fate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import LOWER, SMALL, Prefix, chunks, mix, parts, raw_texts, stage, unused, word_spans

TREES = 16
HASHES = 64
#: Members of a region that one task compares all with all, in the second pass and in the first.
REGION_TASK = 1024
SMALL_REGION = 64
#: Neighbours in order on either side, in larger regions.
NEXT = 4
MULTIPLIERS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
SKETCH = "doc_id long, text_hash long, n_shingles long, node binary, signature binary"
SKETCH_T = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("signature", pa.binary())])
LAST = (1 << 63) - 1
#: A text with at least one word.
WORDED = r"[^\x20\x09-\x0D]"


def permutations(depth: int) -> np.ndarray:
    """The order of places in each tree: its own first ones, then all others, each time in another order."""
    out = []
    for t in range(TREES):
        own = np.arange(t * depth, (t + 1) * depth) % HASHES
        rest = np.setdiff1d(np.arange(HASHES), own)
        out.append(np.concatenate((own, rest[np.argsort(mix(rest.astype(np.uint64) + np.uint64(1000 * (t + 1))))])))
    return np.array(out)


def least_equal(percent: int) -> int:
    """About 4.5 standard deviations below the expected number of agreeing places."""
    p = percent / 100
    return int(HASHES * p - 4.5 * (HASHES * p * (1 - p)) ** 0.5)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; fewer words make one, no words none."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts, SMALL):
        data = b" ".join(texts[a:b])
        raw = LOWER[np.frombuffer(data, np.uint8)]
        start, stop = word_spans(raw)
        seq = Prefix(raw).spans(start, stop)
        for i in np.flatnonzero(stop - start > 512):
            seq[i] = xxhash.xxh64_intdigest(raw[start[i] : stop[i]].tobytes(), 7)
        bounds = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts[a:b])]))
        prefix = Prefix(seq)
        grams = prefix.grams(size)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo >= size:
                out.append(np.unique(grams[lo : hi - size + 1]))
            else:
                out.append(prefix.spans(np.array([lo]), np.array([hi])) if hi > lo else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of 16 bits for each set that isn't empty."""
    flat, at = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), HASHES), np.uint16)
    for k in range(HASHES):
        least = np.minimum.reduceat((flat ^ MULTIPLIERS[-1 - k]) * MULTIPLIERS[k], at)
        out[:, k] = mix(least) >> np.uint64(48)
    return out


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """Set size, class and signature of each row (doc_id, text)."""

    def run(batches):
        for b in parts(batches):
            sets = shingle_sets(raw_texts(b), size)
            full = [s for s in sets if len(s)]
            sign = iter(signatures(full)) if full else iter(())
            node = [xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets]
            sign = [next(sign).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array(sign, pa.binary())], schema=SKETCH_T)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, SKETCH)


def forest(classes: DataFrame, depth: int, with_order: bool) -> DataFrame:
    """(region, node[, ordered]) of each class in each tree."""
    orders = permutations(depth)
    schema = "region long, node binary" + ", ordered binary" * with_order

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sign = np.frombuffer(b"".join(b.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
            for t, order in enumerate(orders):
                moved = np.ascontiguousarray(sign[:, order].astype(">u2"))
                region = np.full(len(moved), t + 1, np.uint64)
                for k in range(depth):
                    region = mix(region * np.uint64(1 << 16) + moved[:, k].astype(np.uint64))
                cols = [pa.array(region.view(np.int64)), b.column("node")]
                if with_order:
                    cols.append(pa.array([r.tobytes() for r in moved], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=["region", "node", "ordered"][: len(cols)])

    return classes.select("node", "signature").mapInArrow(run, schema)


def agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Agreeing places of each row of x with each row of y."""
    if len(x) * len(y) < 5000:
        return (x[:, None, :] == y[None, :, :]).sum(axis=2)
    out = np.zeros((len(x), len(y)), np.uint8)
    for k in range(x.shape[1]):
        out += x[:, k, None] == y[None, :, k]
    return out


def closest(sign: np.ndarray) -> int:
    """The member that has most of the members' most frequent values."""
    some = sign[:: max(1, len(sign) // 512)]
    usual = np.array([np.bincount(some[:, k]).argmax() for k in range(some.shape[1])])
    return int((sign == usual).sum(axis=1).argmax())


def propose(nodes: list[bytes], sign: np.ndarray, least: int):
    """The most similar neighbour (hub, member) of each member of a piece of a region."""
    m = len(nodes)
    if m <= SMALL_REGION:
        same = agree(sign, sign)
        np.fill_diagonal(same, 0)
        partner, best = same.argmax(axis=1), same.max(axis=1)
    else:
        hub = closest(sign)
        partner, best = np.full(m, hub), (sign == sign[hub]).sum(axis=1)
        best[hub] = 0
        for d in range(1, NEXT + 1):
            near = (sign[d:] == sign[:-d]).sum(axis=1)
            for mine, other in ((np.arange(d, m), np.arange(m - d)), (np.arange(m - d), np.arange(d, m))):
                better = near > best[mine]
                best[mine[better]], partner[mine[better]] = near[better], other[better]
    for i in np.flatnonzero(best >= least):
        yield nodes[partner[i]], nodes[i], int(best[i])


PROPOSED = "hub binary, member binary, equal int"
PROPOSED_T = pa.schema([("hub", pa.binary()), ("member", pa.binary()), ("equal", pa.int32())])


def proposals(trees: DataFrame, partitions: int, least: int) -> DataFrame:
    """Pairs (hub, member, equal), and (null, member, null) for every class that shares a region at all."""

    def run(batches):
        region, nodes, rows, first = None, [], [], True

        def close(edge):
            out = list(propose(nodes, np.frombuffer(b"".join(rows), ">u2").reshape(-1, HASHES).astype(np.uint16), least)) if len(nodes) > 1 else []
            if len(nodes) > 1 or (nodes and edge):
                out += [(None, x, None) for x in nodes]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PROPOSED_T.types)], schema=PROPOSED_T) if out else None

        for b in batches:
            keys = b.column("region").to_numpy()
            node, ordered = b.column("node").to_pylist(), b.column("ordered").to_pylist()
            cut = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else [0]
            for lo, hi in zip(cut[:-1], cut[1:]):
                if keys[lo] != region or len(nodes) >= REGION_TASK:
                    if (got := close(first or keys[lo] == region)) is not None:
                        yield got
                    first = region is None or keys[lo] == region
                    region, nodes, rows = keys[lo], [], []
                nodes += node[lo:hi]
                rows += ordered[lo:hi]
        if (got := close(True)) is not None:
            yield got

    return trees.repartitionByRange(partitions, "region", "ordered", "node").sortWithinPartitions("region", "ordered", "node").mapInArrow(run, PROPOSED)


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int, per_task: int = 64) -> DataFrame:
    """The pairs (hub, member) whose full sets are similar enough. A hub's set meets ``per_task`` members at a time."""
    groups = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / per_task).cast("int").alias("groups"))
    dealt = pairs.join(groups, "hub").select("hub", "member", F.pmod(F.xxhash64("member"), "groups").cast("int").alias("part"))
    members = dealt.join(texts.withColumnRenamed("node", "member"), "member").select("hub", "part", F.lit(1).alias("role"), F.col("member").alias("node"), "text")
    hubs = dealt.select("hub", "part").distinct().join(texts.withColumnRenamed("node", "hub"), "hub").select("hub", "part", F.lit(0).alias("role"), F.col("hub").alias("node"), "text")

    def run(batches):
        hub, own = None, None
        for b in batches:
            out = []
            keys, roles, nodes = (b.column(c).to_pylist() for c in ("hub", "role", "node"))
            for key, role, node, s in zip(keys, roles, nodes, shingle_sets(raw_texts(b), size)):
                if role == 0:
                    hub, own = key, s
                    continue
                if key != hub:
                    raise RuntimeError("a member came without its hub")
                if 100 * (both := np.intersect1d(own, s, assume_unique=True).size) >= percent * (len(own) + len(s) - both):
                    out.append((hub, node))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*out) if out else ((), ()))], names=["a", "b"])

    both = members.unionByName(hubs)
    return both.repartition("hub", "part").sortWithinPartitions("hub", "part", "role", "node").mapInArrow(run, "a binary, b binary")


def missing_links(classes: DataFrame, texts: DataFrame, label: DataFrame, depth: int, least: int, size: int, percent: int) -> DataFrame:
    """Links (a, b) between different components, from every region that holds several.

    A region's members are cut into pieces, and those outside its main component into guest pieces; each piece
    meets each guest piece in a task of its own. The task compares signatures, confirms on full sets what
    connects components that it has not connected yet, and so sends fewer links than it has members.
    """
    keys = forest(classes, depth, False).join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = keys.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    main = F.max(F.struct("n", "component"))
    mixed = each.groupBy("region").agg(F.sum("n").alias("n"), main["component"].alias("main"), main["n"].alias("n_main"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    count = lambda c: F.ceil(c / REGION_TASK).cast("int")
    mixed = mixed.select("region", "main", count(F.col("n")).alias("pieces"), count(F.col("n") - F.col("n_main")).alias("guest_pieces"))
    rows = keys.join(mixed, "region").withColumn("odd", F.col("component") != F.col("main"))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    hosts = rows.select("region", own("pieces").alias("piece"), F.when(F.col("pieces") == 1, 1).otherwise(F.col("guest_pieces")).alias("g"), "node", "component", "odd", F.lit(False).alias("guest"))
    hosts = hosts.withColumn("guests", every("g")).drop("g")
    guests = rows.where("pieces > 1 AND odd").select("region", every("pieces").alias("piece"), "node", "component", "odd", F.lit(True).alias("guest"), own("guest_pieces").alias("guests"))
    dealt = hosts.unionByName(guests).join(classes.select("node", "signature").join(texts, "node"), "node")

    def run(group: pa.Table) -> pa.Table:
        node, comp = group.column("node").to_pylist(), group.column("component").to_pylist()
        parent = {c: c for c in comp}

        def find(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        sign = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
        odd, guest, raw = group.column("odd").to_numpy(), group.column("guest").to_numpy(), raw_texts(group)
        asks, host = np.flatnonzero(guest if guest.any() else odd), np.flatnonzero(~guest)
        sets: dict[int, frozenset] = {}

        def full(i):
            if i not in sets:
                sets[i] = frozenset(shingle_sets([raw[i]], size)[0].tolist())
            return sets[i]

        out = []
        for lo in range(0, len(asks), 256):
            mine = asks[lo : lo + 256]
            for x, y in zip(*(z.tolist() for z in np.nonzero(agree(sign[mine], sign[host]) >= least))):
                i, j = int(mine[x]), int(host[y])
                if (p := find(comp[i])) != (q := find(comp[j])):
                    a, b = full(i), full(j)
                    small, large = sorted((len(a), len(b)))
                    if 100 * small >= percent * large and 100 * (both := len(a & b)) >= percent * (small + large - both):
                        parent[p] = q
                        out.append((node[i], node[j]))
        return pa.table([pa.array(c, pa.binary()) for c in (zip(*out) if out else ((), ()))], names=["a", "b"])

    return dealt.groupBy("region", "piece", "guests").applyInArrow(run, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = 5, depth: int = 4) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text): linked are
    texts with 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles."""
    least = least_equal(percent)
    rows = stage(sketch(docs.select("doc_id", "text"), size), "sketch")
    first = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "text_hash")
    classes = stage(rows.where("node IS NOT NULL").groupBy("node").agg(F.min(first).alias("first"), F.min("signature").alias("signature")), "classes")
    partitions = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    proposed = stage(proposals(forest(classes, depth, True), partitions, least), "proposals")
    shared = stage(classes.join(proposed.where("hub IS NULL").select(F.col("member").alias("node")).distinct(), "node"), "members")
    wanted = shared.select("node", F.col("first.id").alias("id"), F.col("first.text_hash").alias("text_hash"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    texts = stage(keyed.join(wanted, ["id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "texts")
    best = proposed.where("hub IS NOT NULL").groupBy("member").agg(F.max(F.struct("equal", "hub"))["hub"].alias("hub"))
    best = best.groupBy(F.least("hub", "member").alias("x"), F.greatest("hub", "member").alias("y")).agg(F.max("hub").alias("hub"))
    best = best.select("hub", F.when(F.col("hub") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("member"))
    links = stage(confirm(best, texts, size, percent), "links")
    more = stage(missing_links(shared, texts, components(links), depth, least, size, percent), "links")
    whole = components(links.unionByName(more))
    named = classes.select("node", "first").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(smallest, "component").select("node", "smallest")
    alone = F.col("node").isNull()
    component_id = F.when(alone, F.col("doc_id")).when(F.col("smallest.id") < LAST, F.col("smallest.id"))
    kept = alone | ((F.coalesce("doc_id", F.lit(LAST)) == F.col("smallest.id")) & (F.col("text_hash") == F.col("smallest.text_hash")))
    return rows.join(named, "node", "left").select("doc_id", "text_hash", "n_shingles", component_id.alias("component_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, size: int = 5, depth: int = 3) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of rows with equal doc_id and text, the first by a hash of all
    columns (maps aside). Rows without any word are all kept; they are neither joined nor ranked."""
    found = near_duplicates(docs, percent, size, depth).where("kept AND n_shingles > 0")
    id_, hash_, order, nth = (unused(docs, c) for c in ("id", "hash", "order", "nth"))
    kept = found.select(F.coalesce("doc_id", F.lit(LAST)).alias(id_), F.col("text_hash").alias(hash_)).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    worded = F.coalesce(F.col("text").rlike(WORDED), F.lit(False))
    rows = docs.where(worded).withColumns({
        id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), hash_: F.xxhash64("text"),
        order: F.xxhash64(*[c for c, (_, kind) in zip(names, docs.dtypes) if "map<" not in kind]),
    }).join(kept, [id_, hash_])
    # a filter on the first place lets each map task send one row of a group
    first = F.row_number().over(Window.partitionBy(id_, hash_).orderBy(order))
    return rows.withColumn(nth, first).where(F.col(nth) == 1).select(*names).union(docs.where(~worded))
