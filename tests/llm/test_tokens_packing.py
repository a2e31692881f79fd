import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm import packing, tokens
from tests.llm.conftest import EDGE, ordered, rows_of, texts_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole_counts(rows, limit):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return ordered((i, len((t or "").encode()), n, n > limit) for i, t in rows for n in [len(model.encode(t or ""))])


@pytest.mark.parametrize("chars", [7, 8192])
def test_counts_equal_whole_text_encoding(documents, edge, chars):
    for df, rows in ((documents, texts_of(documents)), (edge, EDGE)):
        got = tokens.token_counts(df, PIECES, limit=100, piece_chars=chars, batch_bytes=5000)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert ordered(rows_of(got)) == whole_counts(rows, 100)


def test_no_rows_no_counts(nothing):
    assert tokens.token_counts(nothing, PIECES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,\n\té中<s>▁'", max_size=60))
def test_safe_pieces_add_up(text):
    model = tokens.load_model(PIECES)
    assert tokens.safe_vocabulary(model)
    assert sum(len(model.encode(p)) for p in tokens.split_safely(text, 3) if p) == len(model.encode(text))


def ids_of(text):
    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing_holds_every_piece_once(documents, edge, capacity):
    for df, rows in ((documents, texts_of(documents)), (edge, EDGE)):
        library, expected = Tokenizer.from_file(WORDS), []
        for doc, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids + [1]
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at:at + capacity]
                expected.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
        out = packing.pack_documents(df, WORDS, capacity=capacity)
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        got = rows_of(out)
        assert ordered(r[:5] for r in got) == ordered(expected)
        sequences = defaultdict(list)
        for r in got:
            sequences[r[5]].append((r[6], r[3]))
        for places in sequences.values():
            places.sort()
            assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
            assert sum(n for _, n in places) <= capacity
        lower = -(-sum(e[3] for e in expected) // capacity)
        assert len(sequences) <= lower * 1.02 + 1


def test_no_rows_no_sequences(nothing):
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_kept_ids_are_the_ids(documents):
    doc, text = max(texts_of(documents), key=lambda r: len(r[1] or ""))
    rows = packing.pack_documents(documents.where(f"doc_id = {doc}"), WORDS, capacity=100, keep_ids=True).collect()
    joined = b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["piece"]))
    assert np.frombuffer(joined, "<u4").tolist() == ids_of(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBé ²ſİΣσ'.,!1\n\x1c é<|endoftext|>", max_size=80))
def test_word_encoder_equals_the_library(text):
    encoder = test_word_encoder_equals_the_library.__dict__.setdefault("encoder", packing.WordEncoder(WORDS))
    got = np.frombuffer(b"".join(encoder.chunks(text, size=9)), "<u4").tolist()
    assert got == encoder.library.encode(text, add_special_tokens=False).ids


@cache
def shared_encoder():
    return packing.WordEncoder(WORDS)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abßé÷×ÿzN#$&(.-'0 \u0301<|", max_size=60))
def test_words_of_plain_letters_have_the_librarys_ids(text):
    encoder = shared_encoder()
    got = np.frombuffer(b"".join(encoder.chunks(text)), "<u4").tolist()
    assert got == encoder.library.encode(text, add_special_tokens=False).ids


def test_letters_skip_the_full_tokenizer(monkeypatch):
    encoder, seen = packing.WordEncoder(WORDS), []
    monkeypatch.setattr(encoder, "_ids", lambda texts, ids=encoder._ids: seen.extend(texts) or ids(texts))
    text = "Straße### (élan) word&&& word, x1"
    got = np.frombuffer(b"".join(encoder.chunks(text)), "<u4").tolist()
    assert got == encoder.library.encode(text, add_special_tokens=False).ids
    assert sorted(seen) == sorted(["&&&", "(", "###", ")", ",", "x1"])
    other = Tokenizer.from_file(WORDS)
    other.normalizer = None
    assert packing.letters_library(other) is None


def best_fill(items, room):
    sums = {0}
    for length, n in items:
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fullest_combination(counts, room):
    items = sorted(counts.items(), reverse=True)
    chosen = packing.fullest(items, room)
    assert all(n <= counts[x] for x, n in chosen.items())
    assert sum(x * n for x, n in chosen.items()) == best_fill(items, room)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_patterns_use_the_histogram_up(counts):
    used = defaultdict(int)
    for p in packing.minimum_bin_slack(counts, 64):
        assert sum(x * n for x, n in p.items) <= 64 and p.bins > 0
        for x, n in p.items:
            used[x] += n * p.bins
    assert dict(used) == counts


def test_a_length_over_the_capacity_is_refused():
    with pytest.raises(ValueError, match="exceeds"):
        packing.minimum_bin_slack({70: 1}, 64)
