"""The prefix trie, the source mix and the spelling variants against brute force, over awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelwright.llm import mixing, prefix_trie, queries, spelling

SF = "/root/testdata/sf0.001"
rng = random.Random(5)


# 11 -----------------------------------------------------------------------------------------------------------


def conversations():
    """Shared starts of 0 to 30 turns, one conversation of 700 turns and its copy, null and repeated rows."""
    out = []
    trunk = [("user" if i % 2 else None, f"turn {i % 7}" * (i % 5)) for i in range(700)]
    for c in [*range(-3, 60), 100, 200, 201, 305, 10**12, 10**12 + 1]:
        shared = rng.choice([0, 1, 2, 8, 9, 16, 17, 30])
        own = [(rng.choice(["user", "bot"]), rng.choice(["yes", "no", "", None])) for _ in range(rng.choice([0, 1, 3, 9]))]
        turns = trunk[:shared] + own or [("user", None)]
        out += [(c, t - 5, *x) for t, x in enumerate(turns)]
    for c in (70, 71):
        out += [(c, t, *x) for t, x in enumerate(trunk)]
    out += [(80, None, "user", "first"), (80, 3, "b", "tie"), (80, 3, "a", "tie"), (80, 3, "a", "tie"), (80, -9, None, None), (None, 1, "user", "nobody's")]
    return out + [(81, 1, "user", "x" * 100_000), (82, 1, "user", "x" * 100_000)]


def brute_trie(convs: dict[int, list]) -> dict:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        saved[p] += sum(saved[q] for q in children[p])
    out = {}
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out[min(m), len(p)] = (parent, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return out


def in_order(rows) -> dict[int, list]:
    out = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out[c].append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    return {c: [x[3] for x in sorted(v)] for c, v in out.items()}


NODE = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[c] for c in NODE) for r in rows}
    assert len(out) == len(rows)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, slot int").repartition(3)


def test_trie(spark):
    rows = conversations()
    want = brute_trie(in_order(rows))
    assert max(d for _, d in want) == 700
    assert nodes(prefix_trie.trie(*prefix_trie.ordered_turns(table(spark, rows)))) == want


def test_grafted_trie(spark):
    rows = conversations()
    own = in_order(rows)
    cut = lambda c: zlib.crc32(str(c).encode()) % 6
    floor = lambda c: c - (abs(c) % 100) * (1 if c > 0 else -1)
    built = {c: own.get(floor(c), [])[: cut(c)] + v[cut(c) :] for c, v in own.items()}
    assert not all(built.values())  # some have no turn left
    assert nodes(prefix_trie.trie(*prefix_trie.graft(*prefix_trie.ordered_turns(table(spark, rows))))) == brute_trie(built)


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(*prefix_trie.graft(*prefix_trie.ordered_turns(none))).count() == 0


def test_many_equal_conversations(spark):
    """Their ids go through several chunks."""
    rows = [(c, t, "user", "same") for c in range(5000) for t in range(2)]
    got = nodes(prefix_trie.trie(*prefix_trie.ordered_turns(table(spark, rows))))
    assert got == brute_trie(in_order(rows))


# 12 -----------------------------------------------------------------------------------------------------------


def filled(totals: list[int]) -> list[float]:
    """Shares of 5, 2, 1 of all, cut at three times a source, the rest shared out again."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(totals))]
    target, open_ = [0.0] * len(totals), set(range(len(totals)))
    while open_:
        rest = sum(totals) - sum(target[i] for i in range(len(totals)) if i not in open_)
        share = rest / sum(weight[i] for i in open_)
        above = {i for i in open_ if weight[i] * share > 3 * totals[i]}
        if not above:
            for i in open_:
                target[i] = weight[i] * share
            break
        for i in above:
            target[i] = 3.0 * totals[i]
        open_ -= above
    return target


def mixed(spark):
    words = lambda n: " ".join("w" * (1 + i % 3) for i in range(n))
    rows = [(i, words(rng.randint(0, 80)), f"s{rng.randrange(9)}") for i in range(600)]
    rows += [(None, words(7), "s3")] * 9000 + [(5, words(12), "s\U0001f600")] * 3 + [(i, words(4), "s￿") for i in range(700, 720)]
    rows += [(800, None, "s1"), (801, " \t\n", "s1"), (802, words(30_000), "s2"), (803, words(9), None), (None, words(9), None), (804, "", "empty"), (805, None, "empty")]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, size string, copies int").repartition(4)


def test_mix(spark):
    rows, df = mixed(spark)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = Counter()
    for _, t, s in rows:
        totals[s] += size(t)
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, filled([totals[s] for s in order])))
    got = mixing.mix(df).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((d, s, size(t)) for d, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in order:  # as near as any choice of up to three copies of each document
        reach = 1
        for _, t, x in rows if s != "s3" else ():
            for _ in range(3 * (x == s)):
                reach |= reach << size(t)
        best = min((abs(i - round(want[s])) for i in range(reach.bit_length()) if reach >> i & 1), default=0)
        assert abs(taken[s] - round(want[s])) == (best if s != "s3" else 0)
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert Counter(map(tuple, mixing.mix(df, seed=1).collect())) != Counter(map(tuple, got))


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")).collect()
    assert {(r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in blank} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_fit_lengths():
    """As near as any choice of documents, by brute force over subset sums."""
    draw = random.Random(3)
    for _ in range(300):
        size = np.array(draw.sample(range(1, 60), draw.randint(1, 6)))
        count = np.array([draw.randint(1, 4) for _ in size])
        sums = {0}
        for a, n in zip(size.tolist(), count.tolist()):
            sums = {s + a * k for s in sums for k in range(n + 1)}
        budget = draw.randint(0, int(size @ count))
        took = mixing.fit_lengths(size, count, budget)
        assert (took >= 0).all() and (took <= count).all()
        assert abs(int(size @ took) - budget) == min(abs(s - budget) for s in sums)
        part = mixing.fit_lengths(size, count, budget, reserve=20)
        assert (part <= count).all() and abs(int(size @ part) - budget) <= size.max()


def test_lengths_are_spent_in_proportion():
    size, count = np.arange(1, 401), np.full(400, 50)
    took = mixing.fit_lengths(size, count, int(size @ count) // 4)
    assert size @ took == int(size @ count) // 4
    assert abs(took[200:].sum() / count[200:].sum() - 0.25) < 0.01


# 13 -----------------------------------------------------------------------------------------------------------


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(n: dict[str, int]) -> dict:
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def rows_of(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("crowded", [3, 40, 4096])
def test_variants(spark, crowded):
    draw = random.Random(crowded)
    words = {"".join(draw.choice("abé") for _ in range(draw.choice([7, 7, 8, 8, 9]))): draw.choice([2, 3, 25, 300, 4000]) for _ in range(400)}
    words |= {"a" * k: 10**k for k in range(7, 12)} | {"x" * 3000: 2, "x" * 2999: 50, "yx" * 1500: 2, "þ" * 7: 9, "Œ" * 7: 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(spelling.variants(df, crowded=crowded)) == brute_variants(words)


def test_runs_and_cuts(spark):
    rows = [(i, " ".join(draw_word() for _ in range(60))) for i in range(120)]
    rows += [(None, "ABCDEFGÉ abcdefgÉ x1abcdefgé" * 3), (3, None), (4, ""), (5, "z" * 50_000 + " " + "z" * 50_000), (6, "İstanbulian 123 straße×lang"), (6, "İstanbulian 123 straße×lang")]
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    want = brute_variants({w: k for w, k in count.items() if len(w) >= 7 and k >= 2})
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    assert rows_of(spelling.variants(spelling.vocabulary(spelling.misspelt(spelling.runs(df))))) == want


def draw_word():
    return rng.choice(["Internation", "international", "Éclairage", "eclairage", "working", "workings", "Xworking", "overtake"])


def test_no_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(spelling.misspelt(spelling.runs(none)))).count() == 0


# the registered queries -----------------------------------------------------------------------------------------


def test_queries_run(spark):
    assert queries.op11_prefix_trie(spark, SF).columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    mix = queries.op12_source_mix(spark, SF).toPandas()
    assert len(mix) == 200 and abs(mix.taken.sum() - mix["size"].sum()) <= 20
    assert queries.op13_spelling_variants(spark, SF).columns == ["word", "n", "n_near", "form", "form_n", "root"]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_spelling_variants"])
def test_queries_match_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(cur.fetchall())
