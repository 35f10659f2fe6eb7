"""Token counts of a unigram language model by dynamic programming over a trie.

The distinct pre-tokens of a batch are inserted in a trie. The forward score of a node, that of the best
segmentation of the path to it, depends on the path alone, so it is computed once for all pre-tokens that share
the prefix. Where a pre-token ends, the node's token count is stored, and documents add up the counts of theirs.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import map_batches

SPACE = "▁"
#: A character outside the vocabulary costs this much more than the rarest piece, and is written as bytes.
UNKNOWN_COST = 10.0
#: Terminal counts in each of two generations that a worker process keeps between batches.
REMEMBERED = 250_000
LONGEST_KEY = 256


def zipf_scores(path: str) -> dict[str, float]:
    """Log probabilities of the text pieces of a vocabulary file, by Zipf's law on their order in it.

    The file is a byte-pair vocabulary, whose order is that of frequency; it has no probabilities of its own.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (r + 1) for r in range(len(kept))))
    return {piece: -math.log(r + 1) - total for r, piece in enumerate(kept)}


class Unigram:
    """Token counts under given piece scores."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_COST
        # every ending of a piece: the search for pieces that end at a node walks up while the walk is in here
        self.endings = dict.fromkeys((piece[i:] for piece in scores for i in range(len(piece))), -math.inf) | scores
        self.counts: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def add(self, words: set[str]) -> None:
        """Stores the token count of each word, read with the space mark in front as after white space.

        In sorted order the words of a trie come depth first, so the trie's current path is all that is
        held: ``best[d]`` and ``tokens[d]`` belong to its node at depth ``d``, and the part of it that the
        next word shares is not computed again.
        """
        scores, ending, unknown, counts = self.scores, self.endings.get, self.unknown, self.counts
        path, best, tokens = "", [0.0], [0]
        for plain in sorted(words):
            word = SPACE + plain
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :]
            del tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top, count, start = -math.inf, 0, end - 1
                score = ending(word[start:end])
                while score is not None:
                    if best[start] + score >= top:  # at a tie the longest last piece
                        top, count = best[start] + score, tokens[start] + 1
                    if not start:
                        break
                    start -= 1
                    score = ending(word[start:end])
                if word[end - 1] not in scores and best[end - 1] + unknown > top:
                    top = best[end - 1] + unknown
                    count = tokens[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                best.append(top)
                tokens.append(count)
            path = word
            counts[plain] = tokens[-1]

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        if len(self.counts) > REMEMBERED:
            self.old, self.counts = self.counts, {}
        split = [text.split() if text else [] for text in texts]
        held, old = self.counts, self.old
        new = set().union(*split).difference(held)
        known = new & old.keys()
        held.update((word, old[word]) for word in known)
        new -= known
        long = {w for w in new if len(w) > LONGEST_KEY}
        self.add(new)
        found = [(len(words), sum(map(held.__getitem__, words))) for words in split]
        for word in long:
            del held[word]
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> Unigram:
    """One counter per worker process and vocabulary file."""
    return Unigram(zipf_scores(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of each whole text; null and empty texts count 0, repeated rows one by one.

    A null doc_id stays null, other columns are not read, and an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> dict:
        found = counter(path).count(batch.column(1).to_pylist())
        return {
            "doc_id": batch.column(0),
            "n_pretokens": pa.array([n for n, _ in found], pa.int64()),
            "n_tokens": pa.array([n for _, n in found], pa.int64()),
        }

    columns = "doc_id long, n_pretokens long, n_tokens long"
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, columns)
