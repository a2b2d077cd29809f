"""The registered queries of this package, with DuckDB statements where SQL can express them."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers

from pyspark.sql import functions as F

from . import bpe, decontaminate, line_dedup, lsh_forest, mixing, prefix_hash, prefix_trie, quality, spelling, suffix_array, suffix_tree, token_counts, url_filter
from .shared import documents

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


@register
def op1_bpe_round_trip(spark, sf_dir):
    """Ids of every text by the rank file, and the bytes decoded from them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


@register
def op5_decontamination(spark, sf_dir):
    """Words of each document that lie inside a 10-word window of a benchmark item."""
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
CONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL} AS w FROM benchmark),
phrases AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
spans AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, spans.n AS n, item FROM spans JOIN phrases USING (phrase)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
oracle("op5_decontamination", CONTAMINATION_SQL)

#: Host, path prefix and verdict of each rule.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@register
def op6_url_filter(spark, sf_dir):
    """The longest rule that fits each page's URL, and its verdict."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


oracle(
    "op6_url_filter",
    r"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES """
    + ", ".join(map(str, URL_RULES))
    + r"""),
rest AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
judged AS (
    SELECT page_id, host, path, (SELECT max_by({'rule': rule_host || rule_path, 'verdict': verdict}, length(rule_host || rule_path)) FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best FROM parts)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
""",
)


@register
def op7_token_counts(spark, sf_dir):
    """Bytes and tokens of every text."""
    counts = token_counts.token_counts(documents(spark, sf_dir), Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


@register
def op8_suffix_array_dedup(spark, sf_dir):
    """Bytes left when every byte of a repeated 100-byte string but the first is cut."""
    kept = suffix_array.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op10_suffix_tree_dedup(spark, sf_dir):
    """Words left when every word of a repeated sequence of 20 words but the first is cut."""
    kept = suffix_tree.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op4_lsh_forest(spark, sf_dir):
    """Components of texts whose 5-word shingle sets have a similarity of 0.85 or more."""
    return lsh_forest.near_duplicates(documents(spark, sf_dir)).drop("text_hash")


@register
def op9_line_dedup(spark, sf_dir):
    """Texts without lines that repeat an earlier one with at most two changes."""
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_removed", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register
def op2_bradley_terry(spark, sf_dir):
    """Quality score of every text, learned from pairs of labelled ones."""
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))


@register
def op3_prefix_hashes(spark, sf_dir):
    """Fingerprints of every text and of its edited form, and how like they are."""
    return prefix_hash.fingerprints(documents(spark, sf_dir))


@register
def op11_prefix_trie(spark, sf_dir):
    """Every distinct start of the conversations rebuilt on shared first turns."""
    turns, convs = prefix_trie.ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    nodes = prefix_trie.trie(*prefix_trie.graft(turns, convs))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


#: The CRC-32 of a text of ASCII characters.
CRC32_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
oracle(
    "op11_prefix_trie",
    f"""
WITH t AS (
    SELECT conv_id, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'digest': digest, 'chars': length(text)}} ORDER BY turn NULLS FIRST, digest) AS w FROM t GROUP BY conv_id),
planned AS (SELECT conv_id, w, conv_id - conv_id % 100 AS base, CAST({CRC32_SQL.format("CAST(conv_id AS VARCHAR)")} % 6 AS INTEGER) AS h FROM own),
rebuilt AS (SELECT p.conv_id, list_concat(coalesce(b.w[1:p.h], []), p.w[p.h + 1:]) AS w FROM planned p LEFT JOIN own b ON b.conv_id = p.base),
starts AS (
    SELECT conv_id, d, len(w) AS n_turns, CASE WHEN d = 0 THEN 0 ELSE w[d].chars END AS chars, md5(d || array_to_string(list_transform(w[1:d], lambda x: x.digest), '')) AS node,
        CASE WHEN d > 0 THEN md5((d - 1) || array_to_string(list_transform(w[1:d - 1], lambda x: x.digest), '')) END AS parent
    FROM (SELECT conv_id, w, unnest(range(len(w) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
        sha256(coalesce(string_agg(CASE WHEN n_turns = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM starts GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
    SELECT s.node, sum(n.saved) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
    FROM starts s JOIN nodes n ON n.conv_id = s.conv_id AND n.depth >= s.d LEFT JOIN kids k ON k.node = n.node GROUP BY s.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
    CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes p ON p.node = n.parent
""",
)


@register
def op13_spelling_variants(spark, sf_dir):
    """Words of at least seven letters, their near words and the form they are a variant of."""
    words = spelling.vocabulary(spelling.misspelt(spelling.runs(documents(spark, sf_dir))))
    return spelling.variants(words).select("word", "n", "n_near", "form", "form_n", "root")


#: The CRC-32 of any text, over its UTF-8 bytes.
CRC32_BYTES_SQL = CRC32_SQL.replace("list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT))", "list_transform(range(1, octet_length(encode({0})) + 1), lambda i: CAST('0x' || substr(hex(encode({0})), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))")
oracle(
    "op13_spelling_variants",
    rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, run, count(*) AS c FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, c, {CRC32_BYTES_SQL.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN run[1:CAST(h % length(run) AS BIGINT)] || run[CAST(h % length(run) AS BIGINT) + 2:] ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cut AS MATERIALIZED (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
    SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, (min({{'m': -m, 'other': other}})).other AS form, max(m) AS form_n FROM near GROUP BY word),
told AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS root, 0 AS k FROM told UNION ALL SELECT s.word, t.form, k + 1 FROM steps s JOIN told t ON t.word = s.root WHERE t.form IS NOT NULL)
SELECT t.word, n, n_near, form, form_n, root FROM told t JOIN (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word) USING (word)
""",
)


@register
def op12_source_mix(spark, sf_dir):
    """Words that a mix by source weights takes of each document."""
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
