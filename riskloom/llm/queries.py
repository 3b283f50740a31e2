"""Registry of the subpackage: one query per operator over its whole table, and their SQL."""

from __future__ import annotations

from riskloom.llm.collocations import op13_collocations
from riskloom.llm.decontaminate import op3_decontaminate
from riskloom.llm.hard_negatives import op12_hard_negatives
from riskloom.llm.jaccard_join import op8_jaccard_join
from riskloom.llm.langid import op4_langid
from riskloom.llm.line_dedup import op11_line_dedup
from riskloom.llm.license_scan import op6_license_scan
from riskloom.llm.mixing import op9_mixing
from riskloom.llm.packing import op10_packing
from riskloom.llm.quality_hosts import op7_quality_hosts
from riskloom.llm.suffix_dedup import op5_suffix_dedup
from riskloom.llm.token_count import op2_token_counts
from riskloom.llm.toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_token_counts, op3_decontaminate, op4_langid, op5_suffix_dedup, op6_license_scan,
    op7_quality_hosts, op8_jaccard_join, op9_mixing, op10_packing,
    op11_line_dedup, op12_hard_negatives, op13_collocations)}


def pipeline(spark, sf_dir):
    """The whole corpus pipeline over the documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {**QUERIES, "pipeline": pipeline}
