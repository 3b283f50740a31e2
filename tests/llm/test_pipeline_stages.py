"""The corpus pipeline: every stage against brute force on its own input, and the whole run."""

from collections import Counter, defaultdict

from conftest import SF_SMALL
from llm_fixtures import make_docs, sf  # noqa: F401
from riskloom.llm import langid, packing
from test_decontaminate import brute as hits
from test_jaccard_join import brute as groups
from test_mixing_quality import targets, words


def test_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "benchmark_free", "mixed", "packed"]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    now = docs
    for name, stage in P.STAGES:
        before = [r.asDict() for r in now.collect()]
        out = stage(spark, now, SF_SMALL)
        if name != "packed":
            assert out.columns == docs.columns
        after = [r.asDict() for r in out.collect()]
        ids = Counter(r.get("doc_id") for r in after)
        if name == "language":
            judge = langid.Compressors(langid.fit(now))
            keep = {r["doc_id"] for r in before if judge.judge(langid.letters(r["text"]))[2] >= langid.MIN_MARGIN}
            assert set(ids) == keep and len(keep) >= 0.95 * len(before)
        elif name == "near_duplicates":
            assert set(ids) == {c for _, c in groups([(r["doc_id"], r["text"]) for r in before]).values()}
        elif name == "benchmark_free":
            bad = {k for k, v in hits([(r["doc_id"], r["text"]) for r in before], bench).items() if v[4]}
            assert bad and set(ids) == {r["doc_id"] for r in before} - bad
        elif name == "mixed":
            size, total = {}, Counter()
            for r in before:
                size[r["doc_id"]] = len(words(r["text"]))
                total[r["source"]] += size[r["doc_id"]]
            want, most, taken = targets(total), defaultdict(int), Counter()
            for r in before:
                most[r["source"]] = max(most[r["source"]], size[r["doc_id"]])
            for r in after:
                taken[r["source"]] += size[r["doc_id"]]
            assert max(ids.values()) <= 3
            assert all(abs(taken[s] - want[s]) <= most[s] for s in want)
        else:
            enc = packing.load_encoding(packing.TOKENIZER)
            got = Counter()
            for r in after:
                for d, s, part in packing.unpack(r["ids"], r["cu_seqlens"], r["doc_ids"], r["seg_starts"]):
                    got[d, s, tuple(part.tolist())] += 1
            want = Counter()
            for r in before:
                t = enc.encode_ordinary(r["text"])
                want.update((r["doc_id"], i, tuple(t[i:i + packing.WIDTH])) for i in range(0, len(t), packing.WIDTH))
            assert got == want
        if name != "packed":
            now = spark.createDataFrame(after, docs.schema)


def test_run(spark):
    import __spark_entry__ as E
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and "ids" in out.columns


def test_stages_bound_their_batches(spark, make_docs, monkeypatch):
    """Every stage, whatever its operator does, leaves batches of BATCH_BYTES at most; a smaller bound stays."""
    from unittest.mock import MagicMock

    import corpus_pipeline as P
    import pyarrow as pa
    from riskloom.llm.common import BATCH_BYTES
    for operator in ("langid", "jaccard_join", "decontaminate", "mixing", "packing"):
        monkeypatch.setattr(P, operator, MagicMock())
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = make_docs([(i, "word " * 4000) for i in range(600)], 1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    try:
        for name, stage in P.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, SF_SMALL)
            got = [r["n"] for r in docs.select("text").mapInArrow(sizes, "n bigint").collect()]
            assert len(got) > 1 and max(got) < 1.5 * BATCH_BYTES, name
            spark.conf.set(key, "1m")
            stage(spark, docs, SF_SMALL)
            assert spark.conf.get(key) == "1m", name
    finally:
        spark.conf.set(key, before)
