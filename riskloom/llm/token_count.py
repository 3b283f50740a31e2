"""Count-only Viterbi: the number of unigram pieces of a text without building the pieces.

An Aho-Corasick automaton over the vocabulary reports every piece that ends
at a position; dynamic programming carries the best score and the piece
count of that path. Tie rules are those of the ``tokenizers`` unigram model:
at a position the longest piece is tried first and a later one must be
strictly better; a character that is no piece itself costs the lowest score
minus 10; runs of such characters fall back to bytes, each byte one piece,
where the vocabulary has all byte pieces, and are one unknown piece where it
has not. Scores are doubles.

White space is marked as in the tokenizer (each space is the start mark of
the next word, the first word gets one), and words are counted apart, since
the tokenizer splits there too. A word met before is looked up in a table
that is emptied when it holds ``memo`` words, so memory is bounded.

The vocabulary file is a parameter; nothing is trained.

Defined cases: null and empty texts have 0 pieces; ties as above; repeated
rows count alike; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_text, read_table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO = 400_000


def load_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """[(piece, score)] by id, and the id of the unknown piece."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class PieceCounter:
    def __init__(self, vocab: list[tuple[str, float]], memo: int = MEMO) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocab) - UNKNOWN_PENALTY
        names = {p for p, _ in vocab}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.memo: dict[str, int] = {}
        self.most = memo

    def word(self, word: str) -> int:
        """Pieces of one marked word."""
        n = len(word)
        score: list[float] = [0.0] + [0.0] * n
        count = [0] * (n + 1)
        unk = [False] * (n + 1)  # the best path into this position ends with an unknown character
        seen = [False] * (n + 1)
        at = 0
        single = [False] * (n + 1)

        def close(end: int) -> None:
            """All pieces that end at ``end`` have been tried: the unknown character comes last."""
            if single[end]:
                return
            s = score[end - 1] + self.unknown
            if not seen[end] or s > score[end]:
                if self.bytes:
                    c = count[end - 1] + len(word[end - 1].encode())
                else:
                    c = count[end - 1] + (0 if unk[end - 1] else 1)
                score[end], count[end], unk[end], seen[end] = s, c, True, True

        for last, (size, value) in self.automaton.iter(word):
            end = last + 1
            while at < last:  # positions without another match
                at += 1
                close(at)
            s = score[end - size] + value
            if size == 1:
                single[end] = True
            if not seen[end] or s > score[end]:
                score[end], count[end], unk[end], seen[end] = s, count[end - size] + 1, False, True
        while at < n:
            at += 1
            close(at)
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0] and len(words) > 1:
            words = words[1:]  # a leading space is itself the first mark
        memo, total = self.memo, 0
        for w in words:
            c = memo.get(w)
            if c is None:
                if len(memo) >= self.most:
                    memo.clear()
                c = memo[w] = self.word(MARK + w)
            total += c
        return total


@lru_cache(maxsize=1)
def counter_for(path: str) -> PieceCounter:
    """One counter per worker process, kept from task to task."""
    return PieceCounter(load_vocabulary(path)[0])


def token_counts(docs: DataFrame, keep: list[str], tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """``keep`` columns plus n_tokens."""
    def make():
        counter = counter_for(tokenizer)
        return lambda texts: ([counter.text(None if t is None else t.decode()) for t in texts],)
    return map_text(docs, keep, make, "n_tokens bigint", text=text)


def op2_token_counts(spark, sf_dir):
    """Unigram pieces of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return token_counts(docs, ["doc_id"]).select("doc_id", F.col("n_tokens"))
