"""Plain versions of the operators, one document or pair at a time, and the awkward documents they are tested on."""

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: (doc_id, text, lang, source, n_chars) with nulls, empty and blank texts, ties, copies, repeated rows, long texts.
AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, "one", "en", "a", 3),
    (5, "one two three", "en", "a", 13),
    (6, "The cat sat on the mat and looked at the dog. " * 12, "en", "a", 552),
    (7, "The cat sat on the mat and looked at the dog. " * 12, "en", "a", 552),
    (7, "The cat sat on the mat and looked at the dog. " * 12, "en", "a", 552),
    (None, "The cat sat on the mat and looked at the dog. " * 12, "en", "a", 552),
    (8, "Ünïcödé straße ÉTÉ İstanbul ΟΔΟΣ 日本語 🙂 é   x\x1cy <|endoftext|> 12٣", "de", None, 60),
    (9, " ".join(f"word{i % 977}" for i in range(20_000)), "en", "b", None),
    (10, "x" * 30_000, None, "b", 30_000),
    (11, "!!! ### $$$ 123", "", "b", 15),
    (12, "a b c a b c\n\na b c\na b c\n", "en", "b", 24),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """The awkward documents, with columns whose names the operators use themselves."""
    schema = COLUMNS + ", fp long, kept boolean, unit string, __kept long, component_id string, hash int"
    return spark.createDataFrame([(*row, 1, None, "u", 2, "c", 3) for row in AWKWARD], schema)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def base_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered, seen, repeated_lines = set(), set(), 0
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated_lines, len(covered))


def simhash(text):
    words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(linked, ids):
    """Smallest id that each node reaches."""
    labels = np.array(ids)
    while True:
        found = np.minimum(labels, np.where(linked, labels[None, :], 1 << 60).min(axis=1))
        if (found == labels).all():
            return labels.tolist()
        labels = found


def linked_prints(texts):
    values = np.array([simhash(t) for t in texts], np.uint64)
    return np.bitwise_count(values[:, None] ^ values[None, :]) <= 4


SECRETS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def secrets(text):
    """kind:start:end of the base kinds, by start and then kind."""
    found = [
        (m.start(), order, kind, m.end())
        for order, (kind, expression, group, least) in enumerate(SECRETS)
        for m in expression.finditer(text or "")
        if len(m[group]) >= least
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def five_words(text):
    words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
