"""Token counts of documents under a unigram model, by a trie of distinct pre-tokens.

The best segmentation of a word is found by a forward pass over its characters.
Words that begin alike share that beginning's scores: the distinct pre-tokens
are walked as a trie, in order, each node scored once; a word's end stores its
count, and a document adds up the counts of its words.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks the beginning of a pre-token in the vocabulary.
START = "▁"
#: Pre-tokens counted by one Python worker before it starts afresh, and words taken together.
MEMORY, GROUP = 500_000, 200_000


class Unigram:
    """Piece scores; a character outside them is as many tokens as it has UTF-8 bytes, each scored `unknown`."""

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        #: Every ending of a piece: no piece ends where the text behind is not one.
        self.endings = {p[i:] for p in scores for i in range(len(p))}
        self.counts: dict[str, int] = {}

    def count(self, words: set[str]) -> None:
        """Store the counts of distinct words: the trie of START + word, depth first."""
        path, best, tokens = "", [0.0], [0]
        scores, endings = self.scores, self.endings
        for word in sorted(words):
            piece = START + word
            shared = 0
            for a, b in zip(path, piece):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for d in range(shared + 1, len(piece) + 1):
                size = len(piece[d - 1].encode("utf-8", "surrogatepass"))
                top, n = best[d - 1] + self.unknown * size, tokens[d - 1] + size
                for start in range(d - 1, -1, -1):
                    part = piece[start:d]
                    if part not in endings:
                        break
                    score = scores.get(part)
                    if score is not None:
                        found = best[start] + score
                        if found > top or found == top and tokens[start] + 1 < n:
                            top, n = found, tokens[start] + 1
                best.append(top)
                tokens.append(n)
            path = piece
            self.counts[word] = tokens[-1]

    def of_texts(self, texts) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        out, group, held = [], [], 0

        def close():
            if len(self.counts) > MEMORY:
                self.counts.clear()
            self.count(set().union(*group) - self.counts.keys())
            known = self.counts.__getitem__
            out.extend((len(g), sum(map(known, g))) for g in group)

        for text in texts:
            group.append((text or "").split())
            held += len(group[-1])
            if held >= GROUP:
                close()
                group, held = [], 0
        if group:
            close()
        return out


@lru_cache(maxsize=2)
def ranked_unigram(path: str) -> Unigram:
    """A unigram model over a SentencePiece vocabulary file, kept while a Python worker lives.

    No public unigram model is at hand, and none is trained: the pieces of a BPE
    file are scored by Zipf's law over their rank, which the file states.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {
        model.id_to_piece(i): -model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and model.get_score(i) > -1e8
    }
    norm = math.log(sum(1 / (r + 1) for r in rank.values()))
    scores = {p: -math.log(r + 1) - norm for p, r in rank.items()}
    return Unigram(scores, min(scores.values()) - 10)


def counts(text: Column, path: str) -> Column:
    """(n_words, n_tokens) of a whole text. White space separates pre-tokens; null and empty texts have none of either."""

    def of(texts: pa.Array) -> pa.Array:
        found = ranked_unigram(path).of_texts(t.as_py() for t in texts)
        return pa.StructArray.from_arrays(
            [pa.array([w for w, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], ["n_words", "n_tokens"]
        )

    return F.arrow_udf(of, "struct<n_words:bigint,n_tokens:bigint>")(text)


def with_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add `n_words` and `n_tokens` to every row; nothing is moved."""
    counted = docs.withColumn("_counts", counts(F.col(text), path))
    return counted.withColumns({"n_words": F.col("_counts.n_words"), "n_tokens": F.col("_counts.n_tokens")}).drop("_counts")


def by_source(docs: DataFrame, path: str, by: list[str], text: str = "text") -> DataFrame:
    """Documents, words and tokens per group, combined before the shuffle."""
    return with_counts(docs.select(*by, text), path, text).groupBy(*by).agg(
        F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.sum("n_tokens").alias("n_tokens")
    )
