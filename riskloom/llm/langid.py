"""Language identification by compression: per-language zstandard raw-content dictionaries.

A text is compressed once with every language's dictionary; the language
whose dictionary gives the smallest output is predicted. The text is cut
into pieces of ``PIECE`` bytes, each compressed on its own, so that a long
text cannot become its own dictionary; all pieces of the whole text count.
The margin is the gap to the second language relative to the smallest size;
a text with a margin under ``min_margin`` is rejected.

The dictionaries are fitted on a bounded sample of the labelled rows:
about ``SAMPLE_ROWS`` distinct texts a language, chosen by a hash of the text, with
``SLICE_CHARS`` characters each from a hashed offset, cut at ``DICT_BYTES``.
The broadcast is at most DICT_BYTES times the number of languages.

Defined cases: a null text, or one without a letter, is ``und`` with score
0 and rejected; equal sizes go to the language with more training rows, then
by name; without any labelled row every text is ``und``; an empty table gives
an empty result; repeated rows are judged each alike.
"""

from __future__ import annotations

import math

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import has_letter, held_out, map_text, read_table

SAMPLE_ROWS = 256
SLICE_CHARS = 1000
DICT_BYTES = 64 << 10
PIECE = 2048
#: from labelled training rows that are in no dictionary (check_s, 300 a language, cut to 640 characters): 1 % of the
#: rightly predicted texts have a margin under 0.06, half a percent under 0.038, while half of the few wrong ones are
#: under 0.07; texts of a language left out of the dictionaries are under 0.035 in 90 % and under 0.057 in 95 %
MIN_MARGIN = 0.04
#: score = 1 / (1 + exp(-SHARPNESS * margin)) of the best against the second language
SHARPNESS = 60.0
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def dictionaries(train: DataFrame, sample_rows: int = SAMPLE_ROWS, slice_chars: int = SLICE_CHARS,
                 dict_bytes: int = DICT_BYTES) -> list[tuple[str, bytes]]:
    """[(language, raw dictionary)], most frequent language first; ``train`` has text and lang."""
    rows = train.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("lang", "text")
    # copies of a text give one slice, so the share is of distinct texts
    texts = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    sizes = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).collect()
    counts = [(r["lang"], r["texts"]) for r in sorted(sizes, key=lambda r: (-r["n"], r["lang"]))]
    if not counts:
        return []
    # keep a row when its hash lies below a share that gives about sample_rows texts of its language
    share = F.create_map(*[x for lang, n in counts for x in (F.lit(lang), F.lit(min(1.0, sample_rows / n)))])
    h = F.xxhash64("text")
    unit = F.pmod(h, F.lit(1 << 30)) / float(1 << 30)
    start = 1 + F.pmod(F.xxhash64("text", F.lit("offset")),
                       F.greatest(F.lit(1), F.length("text") - slice_chars).cast("long"))
    picked = (rows.filter(unit < F.element_at(share, F.col("lang")))
              .select("lang", h.alias("h"), F.substring(F.col("text"), start.cast("int"), F.lit(slice_chars)).alias("part"))
              .distinct().collect())
    parts: dict[str, list] = {lang: [] for lang, _ in counts}
    for r in sorted(picked, key=lambda r: (r["lang"], r["h"], r["part"])):
        parts[r["lang"]].append(letters(r["part"]))
    # raw content matches best near its end; short languages simply have shorter dictionaries
    return [(lang, b" ".join(parts[lang])[:dict_bytes]) for lang, _ in counts if parts[lang]]


def letters(text: str) -> bytes:
    """Lower-cased text whose runs of ASCII non-letters are one space: marks and digits say nothing of a language."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


class Compressors:
    """One zstandard compressor per language, its dictionary digested once."""

    def __init__(self, dicts: list[tuple[str, bytes]], piece: int = PIECE) -> None:
        self.langs = [x for x, _ in dicts]
        self.by, self.piece = [], piece
        for _, raw in dicts:
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            # short matches (4 bytes) carry most of what tells languages apart
            params = zstandard.ZstdCompressionParameters.from_level(
                3, source_size=piece, dict_size=len(raw), strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=3,
                write_content_size=False, write_checksum=False, write_dict_id=False)
            d.precompute_compress(compression_params=params)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))

    def sizes(self, text: bytes) -> list[int]:
        parts = [text[i:i + self.piece] for i in range(0, len(text), self.piece)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.by]

    def judge(self, text: bytes) -> tuple[str, float, float]:
        """(language, score, margin)."""
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        second = sizes[order[1]] if len(order) > 1 else 2 * best
        margin = (second - best) / best
        return self.langs[order[0]], 1 / (1 + math.exp(-SHARPNESS * min(margin, 1.0))), margin


def identify(docs: DataFrame, dicts: list[tuple[str, bytes]], keep: list[str], min_margin: float = MIN_MARGIN,
             text: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred, score, margin and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(dicts)
    cols = [f"c{i}" for i in range(len(keep))]
    flat = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, cols)],
                       F.when(has_letter(F.col(f"`{text}`")), F.col(f"`{text}`")).alias("text_in"))

    def make():
        judge = Compressors(sent.value).judge if sent.value else None

        def f(texts):
            rows = [("und", 0.0, 0.0) if t is None or judge is None else judge(letters(t.decode()))
                    for t in texts]
            return ([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
                    [r[0] == "und" or r[2] < min_margin for r in rows])
        return f

    out = map_text(flat, cols, make, "lang_pred string, score double, margin double, rejected boolean", text="text_in")
    return out.toDF(*keep, "lang_pred", "score", "margin", "rejected")


def fit(docs: DataFrame) -> list[tuple[str, bytes]]:
    """Dictionaries from the documents that are not held out."""
    return dictionaries(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))


def accepted(docs: DataFrame, dicts: list[tuple[str, bytes]], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without the rejected documents; columns unchanged."""
    cols = docs.columns
    inner = docs.toDF(*[f"d{i}" for i in range(len(cols))])
    got = identify(inner, dicts, inner.columns, min_margin, text=f"d{cols.index('text')}")
    return got.filter(~F.col("rejected")).select(*inner.columns).toDF(*cols)


def op4_langid(spark, sf_dir):
    """The language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    got = identify(docs.select("doc_id", "text"), fit(docs), ["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")
