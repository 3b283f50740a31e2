"""The corpus pipeline: language, near duplicates, benchmark passages, mix, packed token rows.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage as Parquet
to the shared checkpoint folder and reads it again as the next one's input.
Every stage bounds the bytes of an Arrow batch first, so that the memory of a
task does not follow the length of the texts.
"""

from __future__ import annotations

from riskloom.llm import decontaminate, jaccard_join, langid, mixing, packing
from riskloom.llm.common import cut, read_table, small_batches


def language(spark, docs, sf_dir):
    """Documents whose language is told by a clear margin; dictionaries from the rows that are not held out."""
    small_batches(spark)
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark, docs, sf_dir):
    """One document of each component of similarity 0.8 or more."""
    small_batches(spark)
    return jaccard_join.keep_one(docs)


def benchmark_free(spark, docs, sf_dir):
    """Documents without any 10-word window of a benchmark item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), mode="document")


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix of the sources takes them."""
    small_batches(spark)
    return mixing.mix(docs)


def packed(spark, docs, sf_dir):
    """Packed rows of token ids."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free),
          ("mixed", mixed), ("packed", packed)]

#: compression and tokenizer stages are not SQL; tests hold every stage against brute force instead
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
