"""From raw documents to token ids: quality, lines, near-duplicates, benchmark passages, encoding.

Each stage takes all that the one before kept, as written Parquet. Documents of low quality go; repeated lines
go; of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the first by doc_id stays;
documents with a benchmark passage go; what is left is encoded, and decoded again to prove it.

The stages set the session's Arrow batches to 8 MB, unless it has a setting of its own.
"""

from __future__ import annotations

import public_tokenizers

from panelwright.llm import bpe, decontaminate, line_dedup, lsh_forest, quality
from panelwright.llm.shared import small_batches, stage

#: A learned model and byte-level merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def good_quality(spark, docs, sf_dir):
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def fresh_lines(spark, docs, sf_dir):
    small_batches(spark)
    return line_dedup.drop_lines(docs)


def one_of_each(spark, docs, sf_dir):
    small_batches(spark)
    return lsh_forest.keep_one(docs)


def uncontaminated(spark, docs, sf_dir):
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark, docs, sf_dir):
    small_batches(spark)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", fresh_lines),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("byte-level BPE", token_ids),
]


def run(spark, sf_dir):
    """All stages, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
