"""Quality rules as weak supervision.

Each rule votes good, bad, or abstains. The votes of a document are one of at most ``3 ** rules`` patterns, and
Spark counts the patterns: these counts are all that expectation-maximisation needs to estimate how accurate
each rule is, without labels. A document is kept by its posterior probability of being good.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import keep_rows, map_batches, stored

SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 3
LEAST_WORDS = 50
BAD, GOOD, ABSTAIN = 0, 1, 2
LEAST_POSTERIOR = 0.5

FEATURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letters",
    "n_upper",
    "n_marks",
    "n_distinct",
)


def features(text: str | None) -> tuple[int, ...]:
    """``FEATURES`` of a whole text; a null text has none of anything."""
    if not text:
        return (0,) * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    spaces = sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters, upper = _letters(text, raw)
    return (
        n,
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        letters,
        upper,
        text.count("!") + text.count("?"),
        len(set(words)),
    )


def _letters(text: str, raw: bytes) -> tuple[int, int]:
    """How many letters, and how many of them upper case: a letter changes with its case."""
    codes = np.frombuffer(raw, np.uint8) if len(raw) == len(text) else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    upper, letter = _case_table()
    return int(letter[codes].sum()), int(upper[codes].sum())


_tables: tuple[np.ndarray, np.ndarray] | None = None


def _case_table() -> tuple[np.ndarray, np.ndarray]:
    global _tables
    if _tables is None:
        codes = range(0x110000)
        _tables = (
            np.fromiter((chr(c).isupper() for c in codes), bool, len(codes)),
            np.fromiter((chr(c).isalpha() for c in codes), bool, len(codes)),
        )
    return _tables


def _repeated(words: list[bytes], size: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of three words found at least twice in the text, the first time included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == n:
        return 0
    count = Counter(windows)
    repeated = np.fromiter((count[w] > 1 for w in windows), bool, n)
    covered = np.zeros(len(words), bool)
    for shift in range(size):
        covered[shift : shift + n] |= repeated
    return int(covered.sum())


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _between(value: np.ndarray, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))


Table = dict[str, np.ndarray]


def few_symbols(t: Table) -> np.ndarray:
    x = _share(t["n_symbols"], t["n_words"])
    return _between(x, x <= 0.02, x > 0.1)


def word_length(t: Table) -> np.ndarray:
    x = _share(t["word_chars"], t["n_words"])
    return _between(x, (x >= 3.5) & (x <= 8), (x < 2.5) | (x > 12))


def few_repeated_lines(t: Table) -> np.ndarray:
    x = _share(t["n_dup_lines"], t["n_lines"])
    return _between(x, (x <= 0.05) & (t["n_lines"] > 1), x > 0.4)


def few_repeated_words(t: Table) -> np.ndarray:
    x = _share(t["n_repeat_words"], t["n_words"])
    return _between(x, x <= 0.1, x > 0.5)


def mostly_lower_case(t: Table) -> np.ndarray:
    x = _share(t["n_upper"], t["n_letters"])
    return _between(x, (x <= 0.15) & (t["n_letters"] > 0), x > 0.5)


def few_marks(t: Table) -> np.ndarray:
    x = _share(t["n_marks"], t["n_words"])
    return _between(x, x <= 0.1, x > 0.5)


def mostly_letters(t: Table) -> np.ndarray:
    x = _share(t["n_letters"], t["word_chars"])
    return _between(x, x >= 0.93, x < 0.8)


def many_words(t: Table) -> np.ndarray:
    """Distinct words fall with length, so long texts get a lower bar."""
    x, n = _share(t["n_distinct"], t["n_words"]), np.maximum(t["n_words"], 1)
    return _between(x, x >= np.minimum(0.5, 6 / np.sqrt(n)), x < np.minimum(0.1, 1.2 / np.sqrt(n)))


RULES: tuple[Callable[[Table], np.ndarray], ...] = (
    few_symbols,
    word_length,
    few_repeated_lines,
    few_repeated_words,
    mostly_lower_case,
    few_marks,
    mostly_letters,
    many_words,
)


def measured(texts: list[str | None]) -> Table:
    rows = np.array([features(t) for t in texts], np.int64).reshape(-1, len(FEATURES))
    return dict(zip(FEATURES, rows.T, strict=True))


def pattern(table: Table) -> np.ndarray:
    """The votes of each document as one number, in base 3."""
    return sum(rule(table).astype(np.int64) * 3**i for i, rule in enumerate(RULES))


def base_failed(table: Table) -> np.ndarray:
    return (table["n_words"] < LEAST_WORDS) | (100 * table["n_repeat_words"] > 50 * table["n_words"])


#: A document is of a rule's kind of bad only if that rule calls it bad: so surely at least.
ANCHOR = 0.995
#: A kind of bad stands only if another rule calls at least this share of its documents bad, beyond what it does among good ones.
SUPPORT = 0.15


@dataclass(frozen=True)
class LabelModel:
    """What expectation-maximisation has found.

    Bad documents are of several kinds, whose votes have little in common (symbols, repetition, capitals), so
    the model has one class of good documents, first, and for each rule one class of bad ones that this
    rule finds, if other rules bear it out. A rule that stands alone with its bad votes has none: they count as its
    errors on good documents, and other rules overrule them. ``weight[class]`` are the shares of the classes (0: has
    none) and ``bad[class, rule]`` the probabilities that a rule which votes calls a document of the class bad.
    """

    weight: np.ndarray
    bad: np.ndarray

    def classes(self, patterns: np.ndarray) -> np.ndarray:
        """Posterior of each class for each vote pattern; a rule that abstains says nothing, but on its own kind of bad."""
        votes = _votes(patterns, self.bad.shape[1])
        with np.errstate(divide="ignore"):
            weight = np.log(self.weight)
        odds = weight + (votes == BAD) @ np.log(self.bad).T + (votes == GOOD) @ np.log(1 - self.bad).T
        # The rule that defines a kind of bad must call the document bad; an abstention counts against it.
        odds[:, 1:] += (votes == ABSTAIN) * np.log(1 - ANCHOR)
        odds = np.exp(odds - odds.max(axis=1, keepdims=True, initial=-np.inf))
        return odds / odds.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of being good."""
        return self.classes(patterns)[:, 0]

    def accuracies(self, patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per rule, the share of its (bad, good) votes that the posterior agrees with; nan without such votes."""
        votes, good = _votes(patterns, self.bad.shape[1]), self.posterior(patterns)
        with np.errstate(invalid="ignore"):
            pairs = [((votes == v).T @ (counts * right), (votes == v).T @ counts) for v, right in ((BAD, 1 - good), (GOOD, good))]
            return np.stack([right / cast for right, cast in pairs], axis=1)


def _votes(patterns: np.ndarray, n_rules: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(n_rules) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, n_rules: int = len(RULES)) -> LabelModel:
    """Expectation-maximisation on the counts of vote patterns, from the start again whenever a kind of bad is given up.

    It starts from rules being right: they rarely call good documents bad. One vote of each kind, weighted by
    that start, smooths each probability, so nothing is ever certain; without documents the start is left.
    Kinds that no other rule bears out are given up one by one, the one with the least support first.
    """
    kinds = np.ones(n_rules, bool)
    model = _maximised(patterns, counts, rounds, kinds)
    while len(patterns):
        support = model.bad[1:] - model.bad[0]
        support[np.arange(n_rules), np.arange(n_rules)] = 0
        support = np.where(kinds, support.max(axis=1, initial=0), np.inf)
        if support.min() >= SUPPORT:
            break
        kinds[support.argmin()] = False
        model = _maximised(patterns, counts, rounds, kinds)
    return model


def _maximised(patterns: np.ndarray, counts: np.ndarray, rounds: int, kinds: np.ndarray) -> LabelModel:
    n_rules = len(kinds)
    start = np.full((n_rules + 1, n_rules), 0.1)
    start[0] = 0.002
    anchors = (np.arange(1, n_rules + 1), np.arange(n_rules))
    start[anchors] = ANCHOR
    share = kinds / max(n_rules, 1)
    model = LabelModel(np.array([0.9, *(0.1 * share)]), start)
    if not len(patterns):
        return model
    votes, last = _votes(patterns, n_rules), None
    for _ in range(rounds):
        found = model.classes(patterns)
        if last is not None and np.abs(found - last).max() < 1e-9:
            break
        last, held = found, found.T * counts
        bad, good = held @ (votes == BAD), held @ (votes == GOOD)
        rates = (bad + start) / (bad + good + 1)
        rates[anchors] = np.maximum(rates[anchors], ANCHOR)
        weight = held.sum(axis=1) + np.array([1, *share])
        model = LabelModel(weight / weight.sum(), np.clip(rates, 1e-6, 1 - 1e-6))
    return model


def fit(pattern_rows: DataFrame) -> LabelModel:
    """The label model of a table with a ``pattern`` column; at most ``3 ** rules`` counts reach the driver."""
    rows = pattern_rows.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    return estimate(np.array([r.pattern for r in rows], np.int64), np.array([r.n for r in rows], np.int64))


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, the features, base_failed, pattern) of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        table = measured(batch.column(1).to_pylist())
        return {"doc_id": batch.column(0), **table, "base_failed": base_failed(table), "pattern": pattern(table)}

    columns = ", ".join(["doc_id long", *(f"{f} long" for f in FEATURES), "base_failed boolean", "pattern long"])
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, columns)


def judge(docs: DataFrame, least: float = LEAST_POSTERIOR) -> DataFrame:
    """(doc_id, the features, base_failed, quality, kept) of every row.

    ``quality`` is the posterior. Null and empty texts have no words and fail; repeated rows are judged one
    by one and count as often as they occur; other columns are not read. An empty table gives no rows.
    """
    found = stored(measure(docs), "quality-features")
    shared = docs.sparkSession.sparkContext.broadcast(fit(found))
    names = ["doc_id", *FEATURES, "base_failed"]

    def run(batch: pa.RecordBatch) -> dict:
        quality = shared.value.posterior(batch.column("pattern").to_numpy(zero_copy_only=False))
        failed = batch.column("base_failed").to_numpy(zero_copy_only=False)
        held = {n: batch.column(n) for n in names}
        return {**held, "quality": quality, "kept": (quality >= least) & ~failed.astype(bool)}

    columns = ", ".join(["doc_id long", *(f"{f} long" for f in FEATURES), "base_failed boolean, quality double, kept boolean"])
    return map_batches(found, run, columns)


def drop_low_quality(docs: DataFrame, least: float = LEAST_POSTERIOR) -> DataFrame:
    """The rows that ``judge`` keeps, with their columns as they are: one pass to fit, one to filter."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(measure(docs).select("pattern")))

    def accept(texts: list) -> np.ndarray:
        table = measured(texts)
        return (shared.value.posterior(pattern(table)) >= least) & ~base_failed(table)

    return keep_rows(docs, "text", accept)
