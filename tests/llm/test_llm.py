"""Each operator against brute force, over rows with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelwright.llm import bpe, decontaminate, line_dedup, lsh_forest, prefix_hash, quality, queries, repeats, suffix_array, suffix_tree, token_counts, url_filter
from panelwright.llm.components import components

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
rng = random.Random(11)


def word():
    return "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))


def prose(n):
    return " ".join(word() for _ in range(n))


def corpus():
    """(doc_id, text): copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    base = [prose(rng.randint(3, 120)) for _ in range(40)]
    passage = prose(45)
    out = []
    for t in base:
        out.append(t)
        if rng.random() < 0.4:
            out.append(t)
        if rng.random() < 0.4:
            w = t.split()
            w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
        if rng.random() < 0.3:
            out.append(f"{prose(6)}\n{passage}\n{prose(6)}")
    out += [None, "", " \t\n", "a", "ab cd", "x" * 250, "ab" * 200, "ab " * 90, prose(20_000), "Edge \u00c9 \u0130 don't 've <|endoftext|> 12 \U0001f600 日本語\u2028x"]
    rows = [(i * 3 - 7, t) for i, t in enumerate(out)]
    return rows + rows[:3] + [(None, base[0]), (None, None), (rows[5][0], base[7])]


ROWS = corpus()
UNIQUE = sorted({d: t for d, t in reversed(ROWS) if d is not None}.items())


@pytest.fixture(scope="module")
def all_rows(spark):
    return spark.createDataFrame([(d, t, "x", 1, 0) for d, t in ROWS], "doc_id long, text string, block string, hash int, score int").repartition(5)


@pytest.fixture(scope="module")
def unique_rows(spark):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in UNIQUE], "doc_id long, text string, bucket string, node int").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


# 1 ------------------------------------------------------------------------------------------------------------


def test_bpe(spark, all_rows, none):
    ranks = bpe.read_ranks(RANKS)
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    want = Counter((d, tuple(own.encode_ordinary(t or ""))) for d, t in ROWS)
    got = bpe.decode(bpe.encode(all_rows, ranks, public_tokenizers.PATTERN, blocks=3, block_bytes=5000), ranks).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert Counter((r.doc_id, bytes(r.decoded)) for r in got) == Counter((d, (t or "").encode()) for d, t in ROWS)
    digests = bpe.encode_digests(all_rows, ranks, public_tokenizers.PATTERN, keep_ids=True).collect()
    assert all(r.same_bytes and r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() for r in digests)
    assert bpe.encode_digests(none, ranks, public_tokenizers.PATTERN).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [0, 1])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(nulls, ranks).collect()} == {1: None, 2: bytearray(own.decode_bytes([0, 1]))}


# 2 ------------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op2_bradley_terry"](spark, SF.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in rows.items())
    held = [(rows[x.doc_id], x.quality) for x in labels if rows[x.doc_id].held_out]
    assert sum(r.predicted == q for r, q in held) > 0.95 * len(held)


def test_quality_cases(spark, all_rows, none):
    labels = spark.createDataFrame([(d, i % 2) for i, (d, _) in enumerate(UNIQUE)] + [(None, 1), (UNIQUE[0][0], 1), (10**9, 0), (UNIQUE[1][0], None)], "doc_id long, quality int")
    model = quality.fit(all_rows, labels)
    scored = quality.score(all_rows, model, "quality_score")
    assert scored.columns == [*all_rows.columns, "quality_score"] and scored.count() == len(ROWS)
    assert scored.where("quality_score < 0 OR quality_score > 1 OR quality_score IS NULL").count() == 0
    kept = quality.keep_good(all_rows, labels)
    assert kept.columns == all_rows.columns and {r.score for r in kept.collect()} <= {0}
    assert quality.score(none, model).count() == 0
    nothing = quality.fit(none, labels.limit(0))
    assert {r.s for r in quality.score(all_rows, nothing, "s").collect()} == {0.3}
    assert quality.fit(none, labels).threshold == 0
    one_side = quality.fit(all_rows, labels.where("quality = 1"))
    assert quality.keep_good(all_rows, labels.where("quality = 1")).count() == len(ROWS) and one_side.threshold == 0


def test_quality_reads_no_held_out_label(spark, all_rows):
    labels = pd.DataFrame({"doc_id": [d for d, _ in UNIQUE], "quality": [i % 2 for i in range(len(UNIQUE))]})
    swapped = labels.assign(quality=[1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q for d, q in zip(labels.doc_id, labels.quality)])
    a, b = (quality.fit(all_rows, spark.createDataFrame(x)) for x in (labels, swapped))
    assert np.array_equal(a.weights, b.weights) and a.threshold == b.threshold


# 3 ------------------------------------------------------------------------------------------------------------


def common_start(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_fingerprints(spark, unique_rows, all_rows, none):
    got = by_id(prefix_hash.fingerprints(unique_rows, block_bytes=2000), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "same_start_edited", "same_start_next")
    down = UNIQUE[::-1]
    prints = defaultdict(set)
    for (d, t), (_, after) in zip(down, down[1:] + down[:1]):
        t, after = t or "", after or ""
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        n, sha, own, other, near, _, same, same_next = got[d]
        assert (n, sha, same, same_next) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), common_start(t, edited), common_start(t, after))
        prints[t].add(own)
        assert (own == other) == (t == edited) and (near == 1) >= (t == edited)
        if len(t) > 200:
            a, b = ({x[i : i + 8] for i in range(len(x) - 7)} for x in (t, edited))
            assert abs(near - len(a & b) / len(a | b)) < 0.3
    assert all(len(x) == 1 for x in prints.values()) and len({next(iter(x)) for x in prints.values()}) == len(prints)
    assert prefix_hash.fingerprints(all_rows).count() == len(ROWS)
    assert prefix_hash.fingerprints(none).count() == 0
    alone = prefix_hash.fingerprints(unique_rows.where("text = 'ab cd'")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1


def test_fingerprints_of_ids_beyond_doubles(spark):
    rows = [(d, t or "") for d, t in UNIQUE]
    small = prefix_hash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2000)
    want = {r.doc_id: tuple(r)[1:] for r in small.collect()}
    for base, step in ((2**61 + 1, 1), (-(2**62) - 1, 1), (2**40 + 1, 2**52 + 1)):
        large = {base + step * d: d for d, _ in rows}
        docs = spark.createDataFrame([(base + step * d, t) for d, t in rows], "doc_id long, text string").repartition(3)
        got = {large[r.doc_id]: tuple(r)[1:] for r in prefix_hash.fingerprints(docs, block_bytes=2000).collect()}
        assert got == want


def test_likeness_of_texts_on_both_sides_of_a_size():
    def like(a, b):
        prints = prefix_hash.fingerprint([a, b])[1]
        assert [prefix_hash.written(*prefix_hash.read(prefix_hash.written(*x))) for x in prints] == [prefix_hash.written(*x) for x in prints]
        return prefix_hash.likeness(*prints)

    def share(a, b, size):
        a, b = ({x[i : i + size] for i in range(len(x) - size + 1)} for x in (a, b))
        return len(a & b) / len(a | b)

    t = "abcdefghijklmnopqrstuvwxyz0123456"
    for a, b, size in ((t, t[:22] + "!?", 3), (t, t[:31], 3), (t[:31], t[:30], 3), (t[:3], t[:2], 1), ("ab", "ac", 1), (t, t + t, 8), (t, "a", 1), (t, "", 1)):
        assert like(a, b) == like(b, a) == share(a, b, size)
    assert like("", "") == like(t, t) == 1 and like(t, t[:31]) > 0.9


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=30), st.text("ab", max_size=30))
def test_common_extension(a, b):
    p, q = prefix_hash.Prefixes([a]), prefix_hash.Prefixes([b])
    zero = np.zeros(1, np.int64)
    assert prefix_hash.common_extension(p, zero, p.stop, q, zero, q.stop)[0] == common_start(a, b)


# 4 ------------------------------------------------------------------------------------------------------------


def shingles(t, size=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def reach(nodes, linked):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def near(sets, percent):
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                yield a, b


@pytest.mark.parametrize(("percent", "depth"), [(85, 4), (80, 3)])
def test_near_duplicates(spark, percent, depth):
    local, rows = random.Random(percent), []
    for _ in range(12):
        t = [word() + word() for _ in range(local.randint(20, 150))]
        for _ in range(local.randint(1, 8)):
            u = list(t)
            for _ in range(local.randint(0, 3)):
                u[local.randrange(len(u))] = word() + word()
            rows.append(" ".join(u))
            t = u if local.random() < 0.5 else t
    rows = list(enumerate(rows)) + [(1000 + i, t) for i, (_, t) in enumerate(UNIQUE)]
    sets = {d: shingles(t) for d, t in rows}
    component = reach(sets, near(sets, percent))
    got = by_id(lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), percent, depth=depth), "n_shingles", "component_id", "kept")
    assert got == {d: (len(s), component[d], component[d] == d) for d, s in sets.items()}


def test_near_duplicates_of_awkward_rows(spark, all_rows, none):
    kept = lsh_forest.keep_one(all_rows)
    assert kept.columns == all_rows.columns
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    full = {k: n for k, n in rows.items() if shingles(k[1])}
    assert set(full.values()) == {1} and rows[(None, None)] == 1 and (None, ROWS[0][1]) not in rows
    texts = [t for _, t in full]
    assert len(set(texts)) == len(texts)
    assert lsh_forest.near_duplicates(none).count() == 0
    only = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in lsh_forest.near_duplicates(only).select("component_id", "kept").collect()] == [(None, True)] * 2
    assert lsh_forest.keep_one(only).count() == 1


def test_large_regions_are_compared_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION_TASK", 4)
    monkeypatch.setattr(lsh_forest, "SMALL_REGION", 2)
    monkeypatch.setattr(lsh_forest, "NEXT", 1)
    t = [word() + word() for _ in range(100)]
    rows = []
    for i in range(40):
        u = list(t)
        for k in range(i % 3):
            u[(7 * i + 31 * k) % 100] = word() + word()
        rows.append((i, " ".join(u)))
    sets = {d: shingles(x) for d, x in rows}
    component = reach(sets, near(sets, 85))
    assert by_id(lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "component_id") == {d: (c,) for d, c in component.items()}


def test_rest_of_a_cut_region_shares_it(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION_TASK", 4)
    regions = [0] * 4 + [1] * 5 + [2] * 3
    signed = [(r, np.full(lsh_forest.HASHES, i, ">u2").tobytes(), bytes([i])) for i, r in enumerate(regions)]
    trees = spark.createDataFrame(signed, "region long, ordered binary, node binary")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, 4)
    try:
        got = {r.member[0] for r in lsh_forest.proposals(trees, 1, lsh_forest.HASHES).collect() if r.hub is None}
    finally:
        spark.conf.set(size, before)
    assert got == set(range(12))


class Mapped:
    """A frame that only notes what would run in a task."""

    def __getattr__(self, name):
        return lambda *args, **how: self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_a_large_batch_is_held_in_parts(spark):
    one = pa.record_batch({"doc_id": pa.array(range(8000)), "text_hash": pa.array(range(8000)), "text": ["some words of a text " * 100] * 7999 + [None]})
    task = lsh_forest.sketch(Mapped(), 5).run
    list(task([one.slice(0, 10)]))
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in task([one]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 8000
    assert most < 24 << 20


def test_pipeline_bounds_its_batches(spark):
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(size, None)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    try:
        spark.conf.unset(size)
        corpus_pipeline.fresh_lines(spark, docs, SF)
        assert spark.conf.get(size) == "8m"
        spark.conf.set(size, "3m")
        corpus_pipeline.fresh_lines(spark, docs, SF)
        assert spark.conf.get(size) == "3m"
    finally:
        spark.conf.unset(size)
        if before is not None:
            spark.conf.set(size, before)


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(50, 40), (41, 50), (60, 60), (None, 3), (50, 40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 40: 40, 41: 40, 50: 40}


# 5 ------------------------------------------------------------------------------------------------------------


def item_words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def test_contamination(spark, unique_rows, all_rows, none):
    texts = dict(UNIQUE)
    some = [d for d, t in UNIQUE if t and 15 < len(item_words(t)) < 100][:4]
    items = [(i, texts[d]) for i, d in enumerate(some)] + [(90, prose(30)), (91, "ab CD"), (92, None), (93, "..."), (94, "x" * 250), (None, texts[some[0]]), (95, "ab " * 12)]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc int")
    want = {}
    for d, t in UNIQUE:
        w, hit, names = item_words(t), set(), set()
        for i, x in items:
            x = item_words(x)
            n = min(10, len(x))
            windows = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if x else ()
            for k in range(len(w) - n + 1) if x else ():
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names.add("" if i is None else str(i))
        want[d] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    got = by_id(decontaminate.contamination(unique_rows, bench), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == want and sum(x[4] for x in want.values()) > 4
    assert decontaminate.contamination(all_rows, bench).count() == len(ROWS)
    assert decontaminate.contamination(unique_rows, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    left = decontaminate.drop_contaminated(all_rows, bench)
    assert left.columns == all_rows.columns
    bad = {t for d, t in UNIQUE if want[d][4]}
    assert Counter(r.text for r in left.collect()) == Counter(t for _, t in ROWS if t not in bad)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "c q a b"), (3, "a x x x x x b c"), (4, None)], "doc_id long, text string")
    wanted = spark.createDataFrame([(0, ["a", "b", "c"])], "phrase_id long, phrase array<string>")
    terms = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, term long")
    index = decontaminate.postings(docs, terms)
    for within in range(1, 9):
        want = set()
        for d, t in ((1, "a x b y c"), (2, "c q a b"), (3, "a x x x x x b c")):
            w = t.split()
            if any(set("abc") <= set(w[i : i + within]) for i in range(len(w))):
                want.add(d)
        got = decontaminate.near_matches(wanted, index, terms, within)
        assert {r.doc for r in got.collect()} == want


# 6 ------------------------------------------------------------------------------------------------------------


def test_url_filter(spark):
    urls = [None, "", "example.org/es/", "http://", "http://Example.ORG/es/1?x#y", "https://a.example.org/en/12", "ftp://example.org.evil.net/es/", "x://com/fr/", "x://b.com/de/?q", "x://q.org", "x://q.org/", "x://notexample.org/es/", "a://b://c.com/fr/", "x://example.org/en/1", "x://example.org?es/", "x://É.org/É"]
    rules = [*queries.URL_RULES, (None, "/x", "block"), ("org", None, "block"), ("org", "/", "allow")]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)] + [(4, urls[4], "r")], "page_id long, url string, rule string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")

    def judged(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fit = [(h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
        return host, path, *best

    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, frame).collect())
    assert got == Counter([(i, *judged(u)) for i, u in enumerate(urls)] + [(4, *judged(urls[4]))])
    assert url_filter.judge(pages, frame.limit(0), "block").where("rule IS NULL AND verdict = 'block'").count() == len(urls) + 1
    assert url_filter.judge(pages.limit(0), frame).count() == 0


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 200
    block, _ = url_filter.probes(F.col("key"), blocks)
    listed = url_filter.bloom(keys.where("key < 'k5'"), blocks)
    passed = keys.withColumn("block", block).join(listed, "block").where(url_filter.may_hold(F.col("key"), blocks))
    assert keys.where("key < 'k5'").join(passed, "key", "left_anti").count() == 0
    assert passed.where("key >= 'k5'").count() < 150


# 7 ------------------------------------------------------------------------------------------------------------


def test_token_counts(spark, all_rows, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    definition, library = open(path, encoding="utf-8").read(), Tokenizer.from_file(path)
    want = Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in ROWS)
    assert Counter(map(tuple, token_counts.token_counts(all_rows, definition).collect())) == want
    assert token_counts.token_counts(none, definition).count() == 0


PIECES = st.lists(st.sampled_from([*"ab 'sS12\n\t\x1c\x85\u00a0\u3000éÉİΣσß日٣Ⅷ😀.,!<|>", "<|startoftext|>", "<|endoftext|>", "'ll", "the", "e\u0301", "\u1c89"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_pieces(text):
    test_pieces.own = getattr(test_pieces, "own", None) or (lambda d: (token_counts.Pieces(d, token_counts.prove(d)), Tokenizer.from_str(d)))(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    own, library = test_pieces.own
    assert own.count(text) == len(library.encode(text, add_special_tokens=False).ids)


# 8 and 10 -----------------------------------------------------------------------------------------------------


def without_repeats(rows, size, split, join):
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        unit = split((t or "").encode())
        gone = [False] * len(unit)
        for s in range(len(unit) - size + 1):
            w = bytes(unit[s : s + size]) if isinstance(unit, bytes) else tuple(unit[s : s + size])
            if w in seen:
                gone[s : s + size] = [True] * size
            seen.add(w)
        out[d] = (len(unit), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), join([u for u, g in zip(unit, gone) if not g]))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_array(unique_rows, all_rows, none, hot):
    got = by_id(suffix_array.remove_repeats(unique_rows, hot=hot, blocks=4), "n_units", "n_removed", "n_spans", "kept")
    assert {d: (*v[:3], bytes(v[3])) for d, v in got.items()} == without_repeats(UNIQUE, 100, bytes, bytes)
    assert suffix_array.remove_repeats(all_rows, hot=hot).count() == len(ROWS)
    assert suffix_array.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [20_000, 3])
def test_suffix_tree(unique_rows, all_rows, none, hot, monkeypatch):
    got = by_id(suffix_tree.remove_repeats(unique_rows, hot=hot, blocks=4), "n_units", "n_removed", "n_spans", "kept")
    assert {d: (*v[:3], bytes(v[3])) for d, v in got.items()} == without_repeats(UNIQUE, 20, bytes.split, b" ".join)
    repeated = suffix_tree.remove_repeats(all_rows, hot=hot).where("doc_id = -7").collect()
    assert len(repeated) == 2 and sorted(r.n_removed > 0 for r in repeated) == [False, len(ROWS[0][1].split()) >= 20]
    assert suffix_tree.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize("blocks", [1, 3])
def test_rows_without_id_keep_one_of_each_passage(spark, hot, blocks):
    local = random.Random(3)
    fresh = lambda n: " ".join(f"{local.getrandbits(40):x}" for _ in range(n))
    passages = [fresh(25) for _ in range(6)]
    texts = [f"{fresh(local.randint(1, 30))} {local.choice(passages)} {fresh(3)}" for _ in range(900)]
    texts += [t for t in local.sample(texts, 300) for _ in range(2)]
    docs = spark.createDataFrame([(None if i % 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = {w for t in texts for w in t.split()}
    out = [bytes(r.kept).split() for r in suffix_tree.remove_repeats(docs, hot=hot, blocks=blocks).collect()]
    assert len(out) == len(texts) and {w.decode() for x in out for w in x} == words
    windows = Counter(tuple(x[i : i + 20]) for x in out for i in range(len(x) - 19))
    assert max(windows.values()) == 1
    out = [bytes(r.kept) for r in suffix_array.remove_repeats(docs, hot=hot, blocks=blocks).collect()]
    everything = b"\n".join(out)
    assert len(out) == len(texts) and all(everything.count(p.encode()[20:-20]) == 1 for p in passages)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=12, max_size=60))
def test_prefix_groups_and_buckets(seq):
    data = np.array(seq, np.uint8)
    n = len(seq) - 8 + 1
    want = [seq[i : i + 8] for i in range(n)]
    bucket = suffix_array.refine_buckets(data, 2, 8)
    assert all((bucket[i] == bucket[j]) == (want[i] == want[j]) for i in range(n) for j in range(n))
    suffixes = np.lib.stride_tricks.sliding_window_view(data.astype(np.int32), 8)
    node = {}
    for k, rows in enumerate(suffix_tree.prefix_groups(suffixes, np.arange(n), most=3)):
        order, depth = suffix_tree.subtree(suffixes[rows])
        for r, x in zip(rows[order], np.cumsum(np.append(True, depth < 8))):
            node[int(r)] = (k, int(x))
    assert sorted(node) == list(range(n))
    assert all((node[i] == node[j]) == (want[i] == want[j]) for i in range(n) for j in range(n))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 99), min_size=1, max_size=80), st.integers(1, 9))
def test_sliding_min(x, w):
    if len(x) >= w:
        assert repeats.sliding_min(np.array(x, np.uint64), w).tolist() == [min(x[i : i + w]) for i in range(len(x) - w + 1)]


# 9 ------------------------------------------------------------------------------------------------------------


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9), st.integers(0, 3))
def test_within(a, b, k):
    assert line_dedup.within(a, b, k) == (edit_distance(a, b) <= k)


def lines_case(count):
    local = random.Random(5)
    base = [" ".join(word() for _ in range(local.randint(5, 9))) for _ in range(count)]
    out = []
    for i in range(60):
        text = []
        for _ in range(local.randint(1, 6)):
            x = list(local.choice(base))
            for _ in range(local.randint(0, 3)):
                k = local.randrange(len(x))
                local.choice([lambda: x.insert(k, "é"), lambda: x.pop(k), lambda: x.__setitem__(k, "z")])()
            text.append("".join(x))
        out.append((i, "\n".join(text)))
    return out + [(100, None), (101, ""), (102, "\n\n"), (103, base[0] + "\n"), (104, "x" * 5000), (105, "x" * 4999 + "y")]


@pytest.mark.parametrize("crowd", [256, 2])
def test_line_dedup(spark, crowd, none):
    rows = lines_case(12)
    first = {}
    for d, t in rows:
        for j, x in enumerate(t.split("\n") if t is not None else ()):
            if len(x) >= 12:
                first.setdefault(x, (d, j))
    where = {v: x for x, v in first.items()}
    order = sorted(where)
    component = reach(order, ((a, b) for i, a in enumerate(order) for b in order[i + 1 :] if abs(len(where[a]) - len(where[b])) <= 2 and line_dedup.within(where[a], where[b], 2)))
    want = {}
    for d, t in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for j, x in enumerate(lines) if len(x) < 12 or (first[x] == (d, j) and component[(d, j)] == (d, j))]
        want[d] = (None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept))
    docs = spark.createDataFrame([(d, t, 7, "s", -1) for d, t in rows], "doc_id long, text string, line int, block string, n_chars long").repartition(3)
    got = by_id(line_dedup.dedup_lines(docs, least_chars=12, crowd=crowd, blocks=3), "text", "n_lines", "n_removed")
    assert got == want
    out = line_dedup.drop_lines(docs, least_chars=12, crowd=crowd)
    assert out.columns == docs.columns
    assert all((r.line, r.block, r.n_chars) == (7, "s", -1 if r.text is None else len(r.text)) for r in out.collect())
    assert line_dedup.drop_lines(none).count() == 0


def test_line_dedup_of_awkward_rows(all_rows):
    out = line_dedup.drop_lines(all_rows)
    assert out.columns == all_rows.columns and out.count() == len(ROWS)
    lines = [x for r in out.collect() if r.text for x in r.text.split("\n") if len(x) >= 20]
    assert len(lines) == len(set(lines))


@pytest.mark.parametrize("blocks", [1, 4])
def test_short_lines_that_are_equal_go(spark, blocks):
    rows = [(i, f"Ok.\n\n \t\nline {i}\n日本語です\nOk.") for i in range(9)]
    got = by_id(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), blocks=blocks), "text", "n_lines", "n_removed", "n_near")
    assert got == {i: ("Ok.\n\n \t\nline 0\n日本語です" if i == 0 else f"\n \t\nline {i}", 6, 1 if i == 0 else 3, 0) for i in range(9)}


# queries and pipeline -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(queries.ORACLES[name]).df()
    key = list(got.columns[:1])
    pd.testing.assert_frame_equal(got.sort_values(key).reset_index(drop=True), want[got.columns].sort_values(key).reset_index(drop=True), check_dtype=False)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, before, SF)
        assert after.columns == docs.columns, name
        assert after.join(before, "doc_id", "left_anti").count() == 0
        path = corpus_pipeline.stage(after, "test")
        if name == "MinHash near-dedup":
            sets = {r.doc_id: shingles(r.text) for r in before.collect()}
            assert {r.doc_id for r in path.collect()} == {d for d, c in reach(sets, near(sets, 80)).items() if c == d}
        before = path
    texts = {r.doc_id: r.text for r in before.collect()}
    own = bpe.encoding(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    final = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: list(r.ids) for r in final} == {d: own.encode_ordinary(t) for d, t in texts.items()}
    assert all(r.same_bytes and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in final)


def test_threshold_over_all_labelled_rows(spark):
    rng = np.random.default_rng(3)
    strength = np.round(rng.normal(size=4001), 2)
    won = (strength + rng.normal(size=4001) > 0.4).astype(int)
    rows = spark.createDataFrame(pd.DataFrame({"won": won, "strength": strength}))
    ordered, z = np.sort(strength), int((won == 0).sum())
    assert quality.threshold(rows) == (ordered[z - 1] + ordered[z]) / 2


def test_threshold_uses_rows_beyond_the_fit(spark):
    """Two rows of each label are fitted, the threshold parts all rows by the share of label 0."""
    texts = [(i, ("good words here " if i % 3 else "zzz qqq xxx ") * (3 + i % 7)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    model = quality.fit(docs, labels, most=2)
    usable = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    got = {r.doc_id: r.score >= model.cut for r in quality.score(docs, model).collect()}
    assert sum(not got[i] for i in usable) == sum(i % 3 == 0 for i in usable)


def test_fitted_rows_stay_off_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("good words here " if i % 3 else "zzz qqq xxx ") * (3 + i % 7)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    for name in ("toArrow", "toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(docs), name, lambda *_: pytest.fail("rows on the driver"))
    model = quality.fit(docs, labels)
    assert np.any(model.weights)


def test_kept_row_does_not_depend_on_partitions(spark):
    rows = [(7, "the same few words again and again", f"x{i}") for i in range(40)] + [(None, None, f"n{i}") for i in range(9)] + [(8, " \t", "blank")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    seen = {tuple(sorted((r.extra for r in lsh_forest.keep_one(docs.repartition(n)).collect()))) for n in (1, 3, 7)}
    assert len(seen) == 1
    (kept,) = seen
    assert len(kept) == 13 and sum(e.startswith("x") for e in kept) == 1


def test_near_occurrences(spark):
    items = spark.createDataFrame([("a", "red green blue"), ("b", "one one two"), ("c", None), ("d", "")], "item_id string, text string")
    docs = spark.createDataFrame(
        [(1, "x BLUE y red green z"), (2, "red green and then a long way to blue"), (3, "two one"), (None, "green, red; blue"), (4, None), (5, ""), (3, "two one")],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item, r.start, r.stop) for r in decontaminate.near_occurrences(docs, items, 4).collect()}
    assert got == {(1, "a", 1, 4), (3, "b", 0, 1), (None, "a", 0, 2)}
    assert decontaminate.near_occurrences(docs, items.limit(0), 4).isEmpty() and decontaminate.near_occurrences(docs.limit(0), items, 4).isEmpty()
