"""Benchmark decontamination on a positional inverted index, in DataFrame operations only.

The test side (benchmark items) names the terms; the index holds the postings (term, document, position) of
those terms over the whole corpus and is written once. A phrase is looked up from its rarest term: its postings,
shifted to the start of the phrase, are the candidates; the lists of the next rarer terms, shifted likewise, are
intersected with them; whole words confirm what is left.

A document is known by (doc_id, hash of its text), so repeated rows share postings and each gets the result;
rows without doc_id are told apart by their text. Null or wordless texts have no postings and no hits; null or
wordless items have no phrases; items without item_id count as an item named by the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_ID = -(1 << 63)
#: Test-side tables of at most so many rows are sent to all executors; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """A-Z in lower case; runs of digits, letters and everything beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN_WORDS), "")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, text) of rows (doc_id, text)."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text")


def small(df: DataFrame) -> DataFrame:
    """A broadcast side if its counted rows stay within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def phrases(items: DataFrame, window: int) -> DataFrame:
    """(item, phrase): each run of ``window`` words of an item; an item of fewer words is one phrase."""
    split = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.lit(window), F.size("w"))
    at = split.select("item", "w", size.alias("n"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("i"))
    return at.select("item", F.slice("w", F.col("i"), F.col("n")).alias("phrase")).distinct()


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc, text_hash, pos) of every occurrence of a term (term, word) in ``docs`` (doc_id, text)."""
    every = keyed(docs).select("doc", "text_hash", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return every.join(small(terms), "word").select("term", "doc", "text_hash", "pos")


def find_phrases(docs: DataFrame, wanted: DataFrame, index: DataFrame, terms: DataFrame, lists: int = 3) -> DataFrame:
    """(phrase_id, doc, text_hash, start, n): every place where a phrase (phrase_id, phrase) occurs."""
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    slots = wanted.select("phrase_id", F.size("phrase").alias("n"), F.posexplode("phrase").alias("offset", "word")).join(terms, "word").join(frequency, "term", "left")
    ranked = slots.groupBy("phrase_id", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term"))).alias("by_rarity"))
    ranked = stage(ranked.where(F.col("by_rarity")[0]["df"] > 0), "phrases")
    found = None
    for k in range(lists):
        one = F.get("by_rarity", F.lit(k))
        if found is None:
            first = small(ranked.select("phrase_id", one["term"].alias("term"), one["offset"].alias("offset")))
            found = index.join(first, "term").select("phrase_id", "doc", "text_hash", (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")
            continue
        following = ranked.select("phrase_id", one["term"].alias("term"), one["offset"].alias("offset"))
        asked = found.join(small(following), "phrase_id").withColumn("pos", F.col("start") + F.col("offset"))
        lists_k = index.join(small(following.where("term IS NOT NULL").select("term").distinct()), "term")
        more = asked.where("term IS NOT NULL").join(lists_k, ["doc", "text_hash", "term", "pos"], "left_semi")
        found = more.unionByName(asked.where("term IS NULL")).select("phrase_id", "doc", "text_hash", "start")
    asked = found.join(small(wanted.select("phrase_id", "phrase")), "phrase_id").groupBy("doc", "text_hash").agg(F.collect_set(F.struct("phrase_id", "start", "phrase")).alias("asked"))
    whole = keyed(docs).join(asked, ["doc", "text_hash"]).select("doc", "text_hash", words(F.col("text")).alias("w"), "asked")
    sure = F.filter("asked", lambda a: F.slice("w", a["start"] + 1, F.size(a["phrase"])) == a["phrase"])
    return whole.select("doc", "text_hash", F.explode(sure).alias("a")).select("a.phrase_id", "doc", "text_hash", "a.start", F.size("a.phrase").alias("n")).distinct()


def near_matches(wanted: DataFrame, index: DataFrame, terms: DataFrame, within: int) -> DataFrame:
    """(phrase_id, doc, text_hash, start, stop): spans of at most ``within`` words, from a posting of the rarest
    term, that hold every distinct term of a phrase in any order."""
    slots = wanted.select("phrase_id", F.explode(F.array_distinct("phrase")).alias("word")).join(terms, "word")
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    need = slots.join(frequency, "term", "left").groupBy("phrase_id").agg(F.count(F.lit(1)).alias("need"), F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term"))["term"].alias("rarest"))
    anchor = index.join(small(need), index.term == F.col("rarest")).select("phrase_id", "need", "doc", "text_hash", F.col("pos").alias("at"))
    cell = F.floor(F.col("pos") / within)
    near = anchor.withColumn("cell", F.explode(F.array(*[F.floor(F.col("at") / within) + d for d in (-1, 0, 1)])))
    listed = index.join(small(slots.select("phrase_id", "term")), "term").withColumn("cell", cell)
    both = near.join(listed, ["phrase_id", "doc", "text_hash", "cell"]).where(F.abs(F.col("pos") - F.col("at")) < within)
    each = both.groupBy("phrase_id", "need", "doc", "text_hash", "at").agg(F.array_sort(F.collect_set(F.struct("pos", "term"))).alias("hits"))
    spans = each.select("*", F.explode(F.transform("hits", lambda h: h["pos"])).alias("start"))
    inside = F.filter("hits", lambda h: (h["pos"] >= F.col("start")) & (h["pos"] < F.col("start") + within))
    good = spans.withColumn("inside", inside).where((F.size(F.array_distinct(F.transform("inside", lambda h: h["term"]))) == F.col("need")) & (F.col("start") <= F.col("at")) & (F.col("at") < F.col("start") + within))
    return good.select("phrase_id", "doc", "text_hash", "start", F.array_max(F.transform("inside", lambda h: h["pos"])).alias("stop")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame]:
    """(phrase_id, doc, text_hash, start, n) of every item window in ``docs``, and (phrase_id, item)."""
    listed = phrases(items, window)
    wanted = stage(listed.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "wanted")
    terms = stage(wanted.select(F.explode("phrase").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    index = stage(postings(docs, terms), "postings")
    return stage(find_phrases(docs, wanted, index, terms), "found"), listed.join(wanted, "phrase").select("phrase_id", "item")


def near_occurrences(docs: DataFrame, items: DataFrame, within: int, window: int = 10) -> DataFrame:
    """(doc_id, text_hash, item, start, stop): spans of at most ``within`` words of ``docs`` (doc_id, text) that hold
    every distinct word of a phrase of an item (item_id, text), in any order; see :func:`near_matches`. Items without
    words and texts without them give nothing; rows of equal doc_id and text count once."""
    listed = stage(phrases(items, window), "listed")
    wanted = stage(listed.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "wanted")
    terms = stage(wanted.select(F.explode("phrase").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()), "terms")
    index = stage(postings(docs, terms), "postings")
    spans = near_matches(wanted, index, terms, within).join(small(listed.join(wanted, "phrase").select("phrase_id", "item")), "phrase_id")
    return spans.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "text_hash", "item", "start", "stop").distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, all columns."""
    found, _ = occurrences(docs.select("doc_id", "text"), items, window)
    id_, hash_ = unused(docs, "id"), unused(docs, "hash")
    hit = found.select(F.col("doc").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    rows = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), hash_: F.xxhash64("text")})
    return rows.join(hit, [id_, hash_], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurring phrase), n_items, items_sha256,
    contaminated."""
    found, item_of = occurrences(docs, items, window)
    places = F.array_distinct(F.flatten(F.transform(F.collect_list(F.struct("start", "n")), lambda p: F.sequence(p["start"], p["start"] + p["n"] - 1))))
    hit = found.groupBy("doc", "text_hash").agg(F.size(places).alias("n_hit"))
    named = found.select("doc", "text_hash", "phrase_id").distinct().join(small(item_of), "phrase_id").groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = hit.join(named, ["doc", "text_hash"])
    all_docs = keyed(docs).select("doc", "text_hash", F.size(words(F.col("text"))).alias("n_words"))
    out = all_docs.join(result, ["doc", "text_hash"], "left")
    return out.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
