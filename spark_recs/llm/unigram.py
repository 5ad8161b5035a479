"""Token counts by unigram dynamic programming over a trie of pre-tokens.

A text's words (runs of non-space) get the word mark in front.  The best
segmentation of a word into pieces has the largest sum of piece scores; its
forward score at a place depends on the prefix up to there only.  A task sorts
the distinct words it hasn't met yet: neighbours in this order share their
longest common prefix, and the stack of forward scores along the current word
is the current path of the words' trie.  So each trie node is scored once, and
the number of pieces at a word's end (its terminal count) is stored and looked
up for every further occurrence.

Pieces and ranks are those of a sentencepiece model file; it has no unigram
probabilities, so a piece's score is -log(rank + 2.7), Zipf and Mandelbrot's
law.  A character that is no piece costs its UTF-8 bytes as byte pieces, scored
below all others.  Of equal scores the segmentation with fewer pieces counts.

Defined results: null or blank text has no words and no tokens; equal doc_ids
are counted separately; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.text import process_state
from spark_recs.llm.tokens import text_slices, vocabulary_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHE_WORDS = 800_000
SLICE_BYTES = 4 << 20
OUT = "doc_id long, n_words long, n_tokens long, neg_log_score double"


class Unigram:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.score = {p: -math.log(r + 2.7) for r, p in enumerate(names)}
        self.byte = -math.log(len(names) + 2.7) - 1
        lengths: dict[str, set[int]] = {}
        for p in names:
            lengths.setdefault(p[-2:], set()).add(len(p))
            if len(p) > 1:
                lengths.setdefault(p[-1:], set())
        self.lengths = {k: tuple(sorted(v)) for k, v in lengths.items()}
        self.known: dict[str, tuple[int, float]] = {}

    def insert(self, words: list[str]) -> None:
        """Stores the terminal counts of words not known yet."""
        score, lengths, known = self.score, self.lengths, self.known
        best, count, last = [0.0], [0], ""
        for word in sorted(words):
            n = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                n += 1
            del best[n + 1:], count[n + 1:]
            for i in range(n + 1, len(word) + 1):
                c = word[i - 1]
                s = score.get(c)
                if s is None:
                    k = len(c.encode("utf-8", "replace"))
                    top, pieces = best[i - 1] + k * self.byte, count[i - 1] + k
                else:
                    top, pieces = best[i - 1] + s, count[i - 1] + 1
                if i > 1:
                    for k in lengths.get(word[i - 2: i], ()):
                        if k > i:
                            break
                        s = score.get(word[i - k: i])
                        if s is not None:
                            s += best[i - k]
                            if s > top or (s == top and count[i - k] + 1 < pieces):
                                top, pieces = s, count[i - k] + 1
                best.append(top)
                count.append(pieces)
            known[word] = (count[-1], -best[-1])
            last = word

    def counts(self, texts: list[str | None]) -> list[tuple[int, int, float]]:
        """(words, tokens, -score) of each text."""
        split = [[MARK + w for w in t.split()] if t else [] for t in texts]
        need = set().union(*split) if split else set()
        fresh = [w for w in need if w not in self.known]
        if len(self.known) + len(fresh) > CACHE_WORDS:  # start anew with what these texts need
            self.known.clear()
            fresh = list(need)
        self.insert(fresh)
        out = []
        for words in split:
            got = [self.known[w] for w in words]
            out.append((len(words), sum([g[0] for g in got]), math.fsum([g[1] for g in got])))
        return out


def _count(path: str):
    def run(batches):
        model = process_state(f"unigram:{path}", lambda: Unigram(path))
        for b in batches:
            for i, j, texts in text_slices(b.column(1), SLICE_BYTES):
                words, tokens, score = zip(*model.counts(texts))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array([round(s, 6) for s in score], pa.float64())],
                    ["doc_id", "n_words", "n_tokens", "neg_log_score"])
    return run


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and the segmentation's -score of each row of `docs`."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(_count(path or vocabulary_path(MODEL)), OUT)
