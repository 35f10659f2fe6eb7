"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language inside the tasks and sums them in Spark; only the model (languages x
buckets) reaches the driver. It is broadcast as a matrix of log probabilities. Documents are scored in batches: the
n-grams of each are counted into a row of a matrix, and the columns that any of them uses are multiplied with
the model's rows, so memory follows buckets and languages, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import keep_rows, map_batches

BUCKETS = 1 << 14
LONGEST = 3
#: The model is broadcast: more languages than this raise, they are not dropped (1000 take 64 MB).
MOST_LANGUAGES = 1000
SMOOTHING = 0.5
UNKNOWN = "und"
#: Below this posterior no language has a majority, and a filtering stage rejects the document.
LEAST_SCORE = 0.5
#: Characters whose n-grams are scored at a time: bounds memory however long a text is.
CHARACTERS = 1 << 20
#: Documents whose counts are multiplied with the model at a time.
SCORED = 64

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Buckets of all 1- to 3-grams of the lower-cased text that hold a letter, in portions; others count as a space."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    codes = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)]))
    for begin in range(0, len(codes), CHARACTERS):
        part = codes[begin : begin + CHARACTERS + LONGEST - 1]
        own = min(CHARACTERS, len(codes) - begin)
        real = part != 32
        found, key, some = [], np.zeros(len(part), np.uint32), np.zeros(len(part), bool)
        for n in range(1, LONGEST + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            key = key[:m] * np.uint32(0x01000193) ^ part[n - 1 :]
            some = some[:m] | real[n - 1 :]
            mixed = (key + np.uint32(n)) * np.uint32(0x9E3779B1)
            found.append((mixed >> np.uint32(32 - buckets.bit_length() + 1))[:own][some[:own]])
        yield np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """Log probabilities: ``gram`` is (buckets, languages), ``prior`` is (languages,)."""

    languages: tuple[str, ...]
    gram: np.ndarray
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language and its posterior for each text; ties go to the name that sorts first."""
        scores = np.zeros((len(texts), len(self.languages)))
        known = np.zeros(len(texts), bool)
        for at in range(0, len(texts), SCORED):
            counts = np.zeros((len(texts[at : at + SCORED]), len(self.gram)))
            for i, text in enumerate(texts[at : at + SCORED]):
                for part in grams(text, len(self.gram)) if text else ():
                    if len(part):
                        known[at + i] = True
                        counts[i] += np.bincount(part, minlength=len(self.gram))
            used = np.flatnonzero(counts.any(axis=0))
            scores[at : at + len(counts)] = counts[:, used] @ self.gram[used].astype(np.float64)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        scores += self.prior
        best = scores.argmax(axis=1) if len(texts) else np.zeros(0, int)
        weight = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1) if len(texts) else np.zeros(0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, weight, 0.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1. A row without id counts as held out: nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, buckets: int = BUCKETS) -> Model:
    """A model of all rows that have a text and a language. Without such rows it knows no language."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in counts:
                    if len(counts) >= MOST_LANGUAGES:
                        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
                    counts[lang] = np.zeros(buckets, np.int64)
                rows[lang] = rows.get(lang, 0) + 1
                for part in grams(text, buckets):
                    counts[lang] += np.bincount(part, minlength=buckets)
        for lang, held in counts.items():
            used = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(used) + 1), pa.string()),
                    pa.array(np.concatenate(([-1], used)), pa.int32()),
                    pa.array(np.concatenate(([rows[lang]], held[used])), pa.int64()),
                ],
                names=["lang", "bucket", "n"],
            )

    rows = docs.where("text is not null and lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    summed = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One binary row per language: bounded by MOST_LANGUAGES x buckets, whatever the number of documents.
    per = summed.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    found = sorted(per.limit(MOST_LANGUAGES + 1).collect(), key=lambda r: r.lang)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    languages = tuple(r.lang for r in found)
    gram, prior = np.zeros((buckets, len(found))), np.zeros(len(found))
    for i, r in enumerate(found):
        for bucket, n in r.counts:
            if bucket < 0:
                prior[i] = n
            else:
                gram[bucket, i] = n
    gram += SMOOTHING
    gram = np.log(gram / gram.sum(axis=0, keepdims=True)) if len(found) else gram
    return Model(languages, gram.astype(np.float32), np.log(prior / prior.sum()) if len(found) else prior)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, in its whole text.

    A null text or one without a letter is ``und`` with score 0, and so is every text if the model knows no
    language. Repeated rows are predicted one by one; ``lang``, ``source`` and ``doc_id`` are no inputs, a null doc_id
    stays null, other columns are not read, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        names, scores = shared.value.predict(batch.column(1).to_pylist())
        return {"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": scores}

    columns = "doc_id long, lang_pred string, score double"
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, columns)


def drop_unknown(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows whose text has a language, with a posterior of at least ``least_score``; columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def accept(texts: list) -> np.ndarray:
        names, scores = shared.value.predict(texts)
        return (np.array(names, object) != UNKNOWN) & (scores >= least_score)

    return keep_rows(docs, "text", accept)
