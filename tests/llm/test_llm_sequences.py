"""Periodic runs, suffix tree and prefix trie against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import AWKWARD, WORD, awkward, empty
from conftest import SMALL

from reviewlens.llm import period_runs, prefix_trie, queries, suffix_tree

# ---------------------------------------------------------------- periodic runs


def runs_by_brute_force(words):
    found = []
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(6, 4 * q):
                part = words[start : start + length]
                if all(any(part[x] != part[x + p] for x in range(length - p)) for p in range(1, q)):
                    found.append((start, length, q))
            i = max(i, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed_by_brute_force(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_text(rng):
    words = []
    while len(words) < rng.randint(0, 90):
        if rng.random() < 0.6:
            root = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 9))]
            words += (root * 9)[: rng.randint(1, 5 * len(root) + 3)]
        else:
            words += [rng.choice([b"a", b"b"]) for _ in range(rng.randint(1, 9))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [periodic_text(rng) for _ in range(rng.randint(1, 5))]
    found = period_runs.text_runs(texts)
    assert found == [runs_by_brute_force(words) for words in texts]
    for words, own in zip(texts, found, strict=True):
        assert period_runs.kept_words(words, own) == collapsed_by_brute_force(words, own)


def test_wavelet_matrix_equals_sorting():
    rng = np.random.default_rng(1)
    values = rng.permutation(200)
    matrix = period_runs.WaveletMatrix(values, 8)
    left = rng.integers(0, 200, 300)
    right = np.array([rng.integers(s + 1, 201) for s in left])
    than = rng.integers(0, 256, 300)
    counts = matrix.smaller(left, right, than)
    rank = np.array([rng.integers(0, e - s) for s, e in zip(left, right, strict=True)])
    chosen = matrix.ranked(left, right, rank)
    for s, e, t, c, k, v in zip(left, right, than, counts, rank, chosen, strict=True):
        assert c == (values[s:e] < t).sum() and v == sorted(values[s:e])[k]


def test_long_and_hostile_texts():
    one = [b"a"] * 200_000
    assert period_runs.text_runs([one]) == [[(0, 200_000, 1)]]
    many = ([b"a"] * 6 + [b"b"]) * 5000
    found = period_runs.text_runs([many])[0]
    assert len(found) == 5001 and (0, 35_000, 7) in found
    assert period_runs.text_runs([[], [b"x"], []]) == [[], [], []]


def op11_by_brute_force(doc_id, text):
    words = WORD.findall(text or "")
    words = [w.decode() for w in queries.with_period(doc_id, [w.encode() for w in words])]
    found = runs_by_brute_force(words)
    best = max(found, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(collapsed_by_brute_force(words, found)).encode()).hexdigest(),
    )


COLUMNS_11 = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op11_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS_11) == op11_by_brute_force(r.doc_id, texts[r.doc_id])


def test_periods_are_planted_as_described():
    changed = 0
    for doc_id in range(200):
        words = [str(i).encode() for i in range(40)]
        h = zlib.crc32(str(doc_id).encode())
        g, found = h // 10, queries.with_period(doc_id, words)
        a = g % 40
        p = 1 + (40 - a) // (3 + g % 8)
        expected = words if h % 10 else [words[i] if i < a else words[a + (i - a) % p] for i in range(40)]
        assert found == expected
        changed += found != words
    assert changed and queries.with_period(None, [b"a"]) == [b"a"] and queries.with_period(3, []) == []


def test_runs_of_awkward_documents(spark):
    rows = period_runs.digests(period_runs.period_runs(awkward(spark))).collect()
    assert len(rows) == len(AWKWARD) and sorted(str(r.doc_id) for r in rows) == sorted(str(a[0]) for a in AWKWARD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].start is None and by_id[1].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert (by_id[6].start, by_id[6].length, by_id[6].period, by_id[6].exponent_milli) == (0, 132, 11, 12000)
    assert period_runs.digests(period_runs.period_runs(empty(spark))).collect() == []


# ---------------------------------------------------------------- suffix tree


def tree_by_brute_force(texts, learned):
    """The same model with dictionaries of tuples, one token at a time."""
    words = [(t or "").encode().lower().split() for t in texts]
    tokens = [w + [""] for w in words]
    count = Counter(t for some, learn in zip(tokens, learned, strict=True) if learn for t in some)
    n, v = sum(count.values()), len(count)
    all_ = n + v + 1
    rare = lambda t: t != "" and count[t] < suffix_tree.LEAST_WORD
    rare_tokens, rare_types = sum(c for t, c in count.items() if rare(t)), sum(rare(t) for t in count)
    share = (rare_tokens + rare_types + 1) / all_
    lines = [["<", *["?" if rare(t) else t for t in some]] for some in tokens]
    grams = Counter()
    for line, learn in zip(lines, learned, strict=True):
        if learn:
            for i in range(1, len(line)):
                for k in range(suffix_tree.DEPTH + 1):
                    if i - k >= 0:
                        grams[tuple(line[i - k : i + 1])] += 1
    follow = Counter()
    for gram, c in grams.items():
        follow[gram[:-1]] += c
    symbol = lambda s: share if s == "?" else (count[s] + 1) / all_

    def probability(context, s):
        if not context:
            return symbol(s)
        return (grams[(*context, s)] + suffix_tree.PRIOR * probability(context[1:], s)) / (follow[context] + suffix_tree.PRIOR)

    gain = defaultdict(float)
    for gram, c in grams.items():
        context, s = gram[:-1], gram[-1]
        if context and follow[context] >= suffix_tree.LEAST_CONTEXT:
            shorter = probability(context[1:], s)
            gain[context] += c * math.log((c - 1 + suffix_tree.PRIOR * shorter) / (follow[context] - 1 + suffix_tree.PRIOR) / shorter)
    result = []
    for some, line in zip(tokens, lines, strict=True):
        base = sum(math.log10((count[t] + 1) / all_) for t in some)
        score = 0.0
        for i, t in enumerate(some, 1):
            state = ()
            for k in range(1, min(i, suffix_tree.DEPTH) + 1):
                context = tuple(line[i - k : i])
                if gain.get(context, -1) <= suffix_tree.LEAST_GAIN:
                    break
                state = context
            score += math.log10(probability(state, line[i]))
            if line[i] == "?":
                score += math.log10((count[t] + 1) / all_ / share)
        result.append((len(some), sum(count[t] > 0 for t in some), n, base, score))
    symbols = ["?", *[t for t in count if not rare(t)]]
    for context in [(), *list(gain)[:5]]:
        assert math.isclose(sum(probability(context, s) for s in symbols), 1, rel_tol=1e-9)
    return result


def check_scores(rows, expected):
    assert len(rows) == len(expected)
    for r, (n_tokens, n_known, n, base, score) in zip(rows, expected, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)


def test_op12_equals_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    learned = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in docs]
    rows = sorted(queries.op12_lm_scores(spark, SMALL).collect(), key=lambda r: r.doc_id)
    assert [r.held_out for r in rows] == [not learn for learn in learned]
    check_scores(rows, tree_by_brute_force([r.text for r in docs], learned))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_many_blocks_and_buckets_score_the_same(spark, monkeypatch):
    """What blocks ask is put together from many buckets, and what they are told is in the order asked."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", "c", f"w{rng.randint(0, 30)}"]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    learned = [rng.random() < 0.8 for _ in texts]
    answers, totals = [{} for _ in range(6)], None
    blocks = [suffix_tree.Block.of([t.encode().split() for t in texts[i::6]], learned[i::6]) for i in range(6)]
    for _ in range(suffix_tree.DEPTH + 3):
        found = [b.walk(totals, a) for b, a in zip(blocks, answers, strict=True)]
        for tag in {tag for asked, _ in found for tag in asked}:
            total = Counter()
            for asked, _ in found:
                keys, counts = asked.get(tag, ((), ()))
                assert list(keys) == sorted(set(keys))
                for k, c in zip(keys, counts, strict=True):
                    total[int(k)] += c
            rows = {}
            for b, (asked, _) in enumerate(found):
                table = suffix_tree._questions(b, {tag: asked[tag]}, 7) if tag in asked else None
                for row in table.to_pylist() if table is not None else []:
                    rows.setdefault(row["bucket"], []).append(row)
            import pyarrow as pa

            schema = suffix_tree._questions(0, {}, 1).schema
            told = [suffix_tree._add_up(pa.Table.from_pylist(some, schema)) for some in rows.values()]
            told = pa.concat_tables(told)
            for b in range(6):
                own = told.filter(pa.compute.equal(told.column("block"), b))
                answers[b][tag] = suffix_tree._answers(own, [tag])[tag]
                if tag in found[b][0]:
                    expected = [total[int(k)] for k in found[b][0][tag][0]]
                    if tag[0] == "g":
                        expected = [t * suffix_tree.GAIN_UNIT > suffix_tree.LEAST_GAIN for t in expected]
                    assert answers[b][tag].tolist() == expected
            if tag == "w":
                least = [c for k, c in total.items() if 0 < c < suffix_tree.LEAST_WORD and k != int(suffix_tree.END)]
                known = [c for c in total.values() if c > 0]
                totals = suffix_tree.Totals(int(sum(known)), len(known), sum(learned), int(sum(least)), len(least))
    found = [b.walk(totals, a)[1] for b, a in zip(blocks, answers, strict=True)]
    expected = tree_by_brute_force(texts, learned)
    for i, own in enumerate(found):
        for j, (n_tokens, _, _, base, score) in enumerate(expected[i::6]):
            assert own["n_tokens"][j] == n_tokens
            assert math.isclose(own["base_score"][j], base, rel_tol=1e-9) and math.isclose(own["score"][j], score, rel_tol=1e-9)


def test_scores_of_awkward_documents(spark):
    from pyspark.sql import functions as F

    docs = awkward(spark)
    rows = suffix_tree.score(docs, ~suffix_tree.held_out()).collect()
    expected = tree_by_brute_force([a[1] for a in AWKWARD], [a[0] is None or zlib.crc32(str(a[0]).encode()) % 7 != 2 for a in AWKWARD])
    key = lambda r: (r.doc_id is None, r.doc_id)
    order = sorted(range(len(AWKWARD)), key=lambda i: (AWKWARD[i][0] is None, AWKWARD[i][0] or 0))
    check_scores(sorted(rows, key=key), [expected[i] for i in order])
    assert suffix_tree.score(empty(spark), F.lit(True)).collect() == []
    unlearned = suffix_tree.score(docs, F.lit(None).cast("boolean")).collect()
    assert all(r.score == r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in unlearned)


# ---------------------------------------------------------------- prefix trie


def rebuilt_by_brute_force(rows, graft=True):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(some)] for c, some in turns.items()}
    taken = {c: zlib.crc32(str(c).encode()) % 4 if graft else 0 for c in own}
    return {c: own.get(c - c % 20, [])[: taken[c]] + own[c][taken[c] :] for c in own}


def trie_by_brute_force(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, some in members.items():
        words = len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(some) - 1) * words
    return sorted(
        (
            min(some), len(node), min(members[node[:-1]]) if node else -1, len(some), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, some in members.items()
    )


def trie_rows(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == names
    return sorted(tuple(-1 if x is None else x for x in row) for row in frame.collect())


CONVERSATIONS = "conv_id long, turn long, role string, text string, key string, depth int, n_convs string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "k", 1, "n") for row in rows], CONVERSATIONS)


def test_op13_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert trie_rows(queries.op13_conversation_trie(spark, SMALL)) == trie_by_brute_force(rebuilt_by_brute_force(rows))


def awkward_conversations():
    rng = random.Random(1)
    rows = []
    for conv in [*range(60), 200, 1001, -3]:
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 30])):
            text = rng.choice(["x y", "x", "z z z", None, ""])
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["u", "a", None]), text))
    rows += [(None, 1, "u", "x")] * 3 + rows[:20]
    # Nested conversations, and one that is much longer than the others.
    rows += [(300 + d, t, "u", f"turn {t}") for d in range(7) for t in range(d + 1)]
    return rows + [(400, t, "u", "again and again") for t in range(150)] + [(410, t, "u", "again and again") for t in range(12)]


def test_trie_of_awkward_conversations(spark):
    rows = awkward_conversations()
    frame = conversations(spark, rows)
    assert trie_rows(prefix_trie.prefix_trie(frame)) == trie_by_brute_force(rebuilt_by_brute_force(rows, graft=False))


def test_a_conversation_spans_tasks(spark, monkeypatch):
    """Keys put together from many tasks equal those of one; blocks of ids are hashed in order."""
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        from pyspark.sql import functions as F

        rows = awkward_conversations() + [(500 + c, 1, "u", "same") for c in range(25)]
        rows = [r for r in rows if r[0] is None or r[0] >= 0]
        conv = F.col("conv_id")
        graft = conv - F.pmod(conv, F.lit(20)), F.crc32(conv.cast("string")) % 4
        found = trie_rows(prefix_trie.prefix_trie(conversations(spark, rows), graft))
        assert found == trie_by_brute_force(rebuilt_by_brute_force(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(conversations(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(conversations(spark, [(None, 1, "u", "x")])).collect() == []
