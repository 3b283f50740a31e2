"""Cases that the operators' own tests leave out: plain language ID, empty tables, null and very long texts."""

import math
import re

import zstandard
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import jaccard_join, langid, license_scan, packing, suffix_dedup, token_count
from riskloom.llm.common import held_out


def plain_language(text, dicts):
    """(language, score, margin) with dictionaries built anew for every piece, straight from the definition."""
    if text is None or not re.search(r"[^\W\d_]", text):
        return "und", 0.0, 0.0
    low = " ".join(re.split(r"[^a-z\x80-\U0010ffff]+", text.lower())).strip(" ").encode()
    sizes = []
    for _, raw in dicts:
        total = 0
        for i in range(0, len(low), langid.PIECE):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                3, source_size=langid.PIECE, dict_size=len(raw), strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=3,
                write_content_size=False, write_checksum=False, write_dict_id=False)
            d.precompute_compress(compression_params=params)
            total += len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(low[i:i + langid.PIECE]))
        sizes.append(total)
    best = min(sizes)
    at = sizes.index(best)
    margin = (min(sizes[:at] + sizes[at + 1:]) - best) / best
    return dicts[at][0], 1 / (1 + math.exp(-langid.SHARPNESS * min(margin, 1.0))), margin


def test_language_against_a_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    dicts = langid.fit(docs)
    got = {r["doc_id"]: r for r in langid.op4_langid(spark, SF_SMALL).collect()}
    right = n = 0
    for r in docs.withColumn("out", held_out(F.col("doc_id"))).collect():
        lang, score, margin = plain_language(r["text"], dicts)
        g = got[r["doc_id"]]
        assert (g["lang_pred"], g["held_out"]) == (lang, r["out"]), r["doc_id"]
        assert abs(g["score"] - score) < 1e-12 and abs(g["margin"] - margin) < 1e-12
        if r["out"] and lang != "und":
            n, right = n + 1, right + (lang == r["lang"])
    assert n > 30 and right >= 0.95 * n


def test_empty_tables(spark, make_docs, sf):  # noqa: F811
    import corpus_pipeline
    none = make_docs([])
    bench = spark.createDataFrame([], "item_id string, text string")
    d = sf(documents=none, benchmark=bench)
    assert token_count.op2_token_counts(spark, d).collect() == []
    assert license_scan.op6_license_scan(spark, d).collect() == []
    out = corpus_pipeline.run(spark, d)
    assert out.count() == 0 and "ids" in out.columns


def test_null_texts_through_the_pipeline(spark, sf):  # noqa: F811
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    nulls = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("text", F.lit(None).cast("string"))
    d = sf(documents=docs.unionByName(nulls), benchmark=spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    with_nulls, without = corpus_pipeline.run(spark, d), corpus_pipeline.run(spark, SF_SMALL)
    ids = lambda out: sorted(x for r in out.select("doc_ids").collect() for x in r["doc_ids"])
    assert ids(with_nulls) == ids(without)


def test_very_long_texts(spark, make_docs):
    """Texts of 150 KB and more: one line, one word, repeated sentences."""
    sentence = "the quick brown fox jumps over the lazy dog and runs away from it "
    long = sentence * 2500
    other = " ".join(f"w{i * 7919 % 100_003}" for i in range(30_000))
    rows = [(1, long), (2, long + "with another end"), (3, "x" * 200_000), (4, other), (5, other + " more"), (6, "short text")]
    docs = make_docs(rows)
    # near duplicates: 4 and 5 share nearly all shingles, 1 and 2 the few different ones of their sentence
    kept = {r["doc_id"] for r in jaccard_join.keep_one(docs).collect()}
    assert kept == {1, 3, 4, 6}
    # suffix dedup: whatever starts twice goes, the rest stays
    lost = {r["doc_id"]: r for r in suffix_dedup.dedup(docs.select("doc_id", "text")).collect()}
    assert lost[3]["n_removed"] == 200_000 and lost[6]["n_removed"] == 0
    assert lost[4]["n_removed"] == len(other) and lost[5]["n_removed"] == len(other)
    # packing: lossless cuts
    enc = packing.load_encoding(packing.TOKENIZER)
    back = {}
    for r in packing.pack(docs).collect():
        for d, s, part in packing.unpack(r["ids"], r["cu_seqlens"], r["doc_ids"], r["seg_starts"]):
            back.setdefault(d, []).append((s, part.tolist()))
    for i, text in rows:
        whole = [x for _, part in sorted(back[i]) for x in part]
        assert whole == enc.encode_ordinary(text), i
    # token counts: every text has one row, long repeats cost in proportion
    n = {r["doc_id"]: r for r in token_count.token_counts(docs, ["doc_id"]).collect()}
    assert set(n) == {1, 2, 3, 4, 5, 6}
