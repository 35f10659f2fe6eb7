"""BPE, token counts and packing against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import AWKWARD, awkward, empty
from conftest import SMALL
from tokenizers import Tokenizer
from tokenizers.models import Unigram as LibraryUnigram

from reviewlens.llm import bpe, bpe_batch, packing, queries, unigram


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(queries.BPE_FILE)
    found.no_padding()
    found.no_truncation()
    return found


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def digest(values):
    return hashlib.sha256(np.array(values, "<u4").tobytes()).hexdigest()


def test_encoder_equals_library_on_random_text(library):
    codec, rng = bpe.codec(queries.BPE_FILE), random.Random(5)
    letters = "abcéÈΣſßİ!'’#$\x1c\x85　́ \n\t12٣x<|>eofndt日本語🙂the in er s t re"
    tokens = sorted(library.get_vocab())
    for k in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        if k % 2:
            text = "".join(rng.choice(tokens).replace("</w>", rng.choice(["", " "])) for _ in range(4))
        if k % 7 == 0:
            text += rng.choice(["<|endoftext|>", "<|startoftext|>x", "<|ENDOFTEXT|>"])
        assert codec.encode(text) == ids_of(library, text), text
        assert codec.decode(codec.encode(text)) == library.decode(codec.encode(text), skip_special_tokens=False)


@pytest.mark.parametrize("size", (50, 2 << 20))
def test_batches_of_texts_are_encoded_as_the_library_does(library, monkeypatch, size):
    monkeypatch.setattr(bpe_batch, "BYTES", size)
    rng = random.Random(6)
    parts = [*"abcéÈΣſßİ!'’#$\x1c\x85　́ \n\t12٣x<|>日語🙂", "'s", "'ll ", "''re", " the", "in", "z" * 70, "<|endoftext|>"]
    texts = [None, "", " ", "\n", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000))]
    for text, ids in zip(texts, bpe_batch.encode_texts(queries.BPE_FILE, texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text), text
    assert list(bpe_batch.encode_texts(queries.BPE_FILE, [])) == []


def test_packing_encodes_the_words_of_a_batch_together(library, monkeypatch):
    """A search per word took most of the 505 CPU seconds a GB that op2 once needed."""
    seen = []
    monkeypatch.setattr(bpe.Codec, "encode_word", lambda own, word: seen.append(word))
    text = "oninganing. ershnted, ofthbleingin"
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe_batch.encode_texts(queries.BPE_FILE, [text] * 3)] == [ids_of(library, text)] * 3
    assert not seen and packing.encode_texts is bpe_batch.encode_texts


def test_the_parts_of_a_merge_are_not_compatible():
    codec = bpe.codec(queries.BPE_FILE)
    assert all(not codec.compatible(*pair) for pair in list(codec.merged)[:5000])


def test_memory_of_the_encoder_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    codec = bpe.Codec(queries.BPE_FILE)
    texts = [f"word{i} other{i % 3}" for i in range(100)]
    assert [codec.encode(t) for t in texts] == [bpe.codec(queries.BPE_FILE).encode(t) for t in texts]
    assert len(codec.encoded) <= 10
    codec.encode("y" * 5000)
    assert "y" * 5000 not in codec.encoded


def test_op8_equals_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op8_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(library, texts[r.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(ids))
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_of_awkward_documents(spark, library):
    rows = bpe.encode(awkward(spark), queries.BPE_FILE).collect()
    expected = sorted((d or -1, ids_of(library, t)) for d, t, *_ in AWKWARD)
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == expected
    assert all(r.decoded == library.decode(list(r.ids), skip_special_tokens=False) for r in rows)
    assert bpe.encode_digests(empty(spark), queries.BPE_FILE).collect() == []


@pytest.fixture(scope="module")
def library_unigram():
    scores = unigram.zipf_scores(queries.UNIGRAM_FILE)
    pieces = [("<unk>", 0.0), *scores.items(), *[(f"<0x{b:02X}>", -100.0) for b in range(256)]]
    return Tokenizer(LibraryUnigram(pieces, unk_id=0, byte_fallback=True))


def test_op5_equals_library(spark, library_unigram):
    texts = {r.doc_id: r.text.split() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.op5_token_counts(spark, SMALL).collect():
        words = texts[r.doc_id]
        assert r.n_pretokens == len(words)
        assert r.n_tokens == sum(len(library_unigram.encode("▁" + w, add_special_tokens=False).ids) for w in words)


def test_token_counts_of_awkward_documents(spark):
    counts = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in unigram.token_counts(awkward(spark), queries.UNIGRAM_FILE).collect()}
    assert counts[1] == counts[2] == counts[3] == (0, 0)
    assert counts[6] == counts[7] == counts[None]
    assert counts[9][0] == 20_000 and counts[10][0] == 1
    assert unigram.token_counts(empty(spark), queries.UNIGRAM_FILE).collect() == []


def test_shared_prefixes_give_the_same_counts_as_single_words():
    scores = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -3.2, "ba": -5.0, "bab": -6.1}
    words = {"".join(w) for w in np.random.default_rng(1).choice(list("abc"), (200, 6))}
    together = unigram.Unigram(scores)
    together.add(words)
    for word in words:
        alone = unigram.Unigram(scores)
        alone.add({word})
        assert alone.counts == {word: together.counts[word]}


def test_memory_of_the_counter_is_bounded(monkeypatch):
    scores = unigram.zipf_scores(queries.UNIGRAM_FILE)
    roomy, texts = unigram.Unigram(scores), [[f"word{i} other{i % 3} word{i - 7}"] for i in range(100)]
    expected = [roomy.count(t) for t in texts]
    monkeypatch.setattr(unigram, "REMEMBERED", 10)
    tight = unigram.Unigram(scores)
    assert [tight.count(t) for t in texts] == expected
    assert len(tight.counts) + len(tight.old) <= 2 * (10 + 3)
    tight.count(["y" * 5000])
    assert "y" * 5000 not in tight.counts


# ---------------------------------------------------------------- packing


def check_packing(rows, ids_by_doc, window):
    """Each token in one piece, gapless sequences, no padding but in none: full windows or powers of two."""
    sequences, tokens = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        tokens.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sorted(sequences) == list(range(len(sequences)))
    assert sorted(tokens) == sorted(ids_by_doc)
    for doc, own in tokens.items():
        ids = ids_by_doc[doc]
        spans = sorted((r.start, r.length) for r in own)
        assert sum(n for _, n in spans) == len(ids)
        assert all(s + n == t for (s, n), (t, _) in zip(spans, spans[1:], strict=False)) and spans[0][0] == 0
        for r in own:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_op2_places_every_token(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    check_packing(queries.op2_packing(spark, SMALL).collect(), {d: [*ids_of(library, t), 2] for d, t in texts.items()}, 4096)


def test_packing_of_awkward_documents(spark, library):
    docs = awkward(spark)
    rows = packing.digests(packing.pack(docs, queries.BPE_FILE, 1024)).collect()
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    per_doc = {}
    for d, t, *_ in AWKWARD:
        per_doc.setdefault(d, []).append(len(ids_of(library, t)) + 1)
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {d: sum(n) for d, n in per_doc.items()}
    assert packing.pack(empty(spark), queries.BPE_FILE).collect() == []


def test_sequences_hold_their_pieces(spark):
    packed = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"), queries.BPE_FILE)
    pieces = {}
    for r in packed.collect():
        pieces.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    for r in packing.sequences(packed).collect():
        assert bytes(r.ids) == b"".join(ids for _, ids in sorted(pieces[r.sequence_id]))


def best_sum(counts, capacity):
    reachable = {0}
    for n, c in counts.items():
        for _ in range(min(c, capacity // n)):
            reachable |= {s + n for s in reachable if s + n <= capacity}
    return max(reachable)


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_the_closest_sum(seed):
    rng = random.Random(seed)
    counts = {rng.randint(3, 90): rng.randint(1, 5) for _ in range(rng.randint(1, 6))}
    capacity = rng.randint(1, 128)
    chosen = packing.fullest(counts, capacity)
    assert all(0 < c <= counts[n] for n, c in chosen.items())
    assert sum(n * c for n, c in chosen.items()) == best_sum(counts, capacity)


@pytest.mark.parametrize("counts", [{}, {64: 5}, {1: 1}, {63: 10**6}, {33: 7, 5: 3}, {10: 10**9, 64: 3, 7: 1}, {1: 10**7, 64: 10**7}])
def test_plan_places_every_token_once(counts):
    runs = packing.plan(counts, 64)
    assert len(runs) < 5000
    total = sum(n * c for n, c in counts.items())
    assert sum(r[2] * r[4] for r in runs) == total
    last = max((r[5] + (r[7] + r[2] - 1) // r[6] for r in runs), default=-1)
    assert last + 1 == total // 64 + (total % 64).bit_count()


def test_places_agree_with_the_plan_piece_by_piece():
    counts = {10: 57, 64: 3, 7: 41, 33: 12, 63: 5, 1: 9}
    places = packing.Places(packing.plan(counts, 64))
    used = {}
    for whole, count in counts.items():
        found = places.find(np.full(count, whole), np.arange(count))
        covered = np.zeros((count, whole), int)
        for p, s, n, q, o in zip(*(found[k] for k in ("piece", "start", "length", "sequence_id", "offset")), strict=True):
            covered[p, s : s + n] += 1
            used.setdefault(int(q), []).append((int(o), int(n)))
        assert (covered == 1).all()
    for own in used.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at == 64 or at & (at - 1) == 0


def test_public_files_are_parameters():
    assert queries.BPE_FILE == public_tokenizers.path("word_bpe_49k.json")
