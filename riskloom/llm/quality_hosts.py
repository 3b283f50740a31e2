"""Host-level quality rules: document rule failures summed by host, shrunk, joined back.

Every text gets its base measures in one pass. A host's failure rate is
shrunk towards the rate of all hosts with a beta prior whose strength is
estimated from the spread between hosts (method of moments): a host with few
documents stays near the common rate, a large one keeps its own. A host
whose shrunk rate exceeds ``max_rate`` fails, and with it its documents.

Hosts are partially aggregated before the shuffle, so a host with a third of
all rows costs one row per task; the verdicts are joined back to the narrow
measures, broadcast while the number of hosts is under a bound.

Defined cases: a null or empty text has no words and fails the base rules; a
null host is a host of its own; repeated rows count each; without spread
between hosts (one host, or no failures) the prior is so strong that every
host has the common rate; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import ASCII_SPACE, bounded_broadcast, cut, map_text, read_table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MAX_HOST_RATE = 0.5
SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = ASCII_SPACE + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more in the text.

    Windows are named exactly by doubling: the name of 2k words is the rank
    of the pair of names of its halves.
    """
    n = len(words)
    if n < window + 1:
        return 0
    number: dict[bytes, int] = {}
    names = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = 1
    while size < window:
        pairs = names[:-size] * np.int64(int(names.max()) + 1) + names[size:]
        names = np.unique(pairs, return_inverse=True)[1]
        size *= 2
    start = np.flatnonzero(np.bincount(names)[names] > 1)
    if not len(start):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    dup = 0
    lines = text.split(b"\n")
    if len(lines) > 1:
        with_word = [x for x in lines if x and not x.isspace()]
        dup = len(with_word) - len(set(with_word))
    return (len(words), len(text.translate(None, _NOT_COUNTED)),
            len(text) - len(text.translate(None, SYMBOLS)), dup, repeat_words(words))


def measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus the five base measures of every whole text."""
    def make():
        def f(texts):
            rows = [measure(t) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(5)]
        return f
    return map_text(docs, keep, make, MEASURES, text=text)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(flags: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, failures, rate, host_failed) from (host, failed): empirical beta prior over the hosts.

    With N rows, K hosts, common rate m and S = sum n_i (p_i - m)^2, the
    moment estimate of the intra-host correlation is
    rho = (S / (m (1 - m)) - (K - 1)) / (N - sum n_i^2 / N - (K - 1));
    the prior counts as 1 / rho - 1 rows.
    """
    by = flags.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("failures"))
    by = cut(by, "host-rates")
    n, p = F.col("n").cast("double"), F.col("failures") / F.col("n")
    total = by.agg(F.sum("n").alias("N"), F.sum("failures").alias("f"), F.count(F.lit(1)).alias("K"),
                   F.sum(n * n).alias("nn"), F.sum(n * p * p).alias("npp")).first()
    prior, m = prior_rows(total["N"] or 0, total["f"] or 0, total["K"], total["nn"] or 0.0, total["npp"] or 0.0)
    rate = (F.col("failures") + F.lit(prior * m)) / (n + F.lit(prior))
    return by.select("host", "n", "failures", rate.alias("host_rate"), (rate > max_rate).alias("host_failed"))


def prior_rows(N: int, f: int, K: int, nn: float, npp: float) -> tuple[float, float]:
    """(prior strength in rows, common rate) by moments; strength is kept within [1e-3, 1e6]."""
    if not N:
        return 1e6, 0.0
    m = f / N
    spread = m * (1 - m)
    free = N - nn / N - (K - 1)
    if spread <= 0 or free <= 0:
        return 1e6, m
    rho = ((npp - N * m * m) / spread - (K - 1)) / free
    return (1e6 if rho <= 0 else min(1e6, max(1e-3, 1 / rho - 1))), m


def judge(docs: DataFrame, host: F.Column, keep: list[str], max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``keep`` columns, base measures, base_failed, host_rate, host_failed and kept, per document."""
    flat = docs.select(*keep, F.col("text"), host.cast("string").alias("host"))
    base = cut(measures(flat, [*keep, "host"]).withColumn("base_failed", base_failed()), "host-base")
    verdict = host_verdicts(base.select("host", F.col("base_failed").alias("failed")), max_rate)
    side = verdict.select(F.col("host").alias("of_host"), "host_rate", "host_failed")
    out = base.join(bounded_broadcast(side, verdict.count()), F.col("host").eqNullSafe(F.col("of_host")))
    return out.drop("of_host").withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


def url_host(url: F.Column) -> F.Column:
    """The host of a page address, lower-cased, without user and port: the host column for ``pages``."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def op7_quality_hosts(spark, sf_dir):
    """All documents, judged by their own base rules and by their host (the source)."""
    got = judge(read_table(spark, sf_dir, "documents"), F.col("source"), ["doc_id"])
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "host_rate")
