import re
import tempfile
import zlib
from collections import Counter
from math import log10

import numpy as np
import pandas as pd
import pytest

from shelfwise.llm import language_model as lm
from shelfwise.llm.ngram_trie import EliasFano, Quantiser, Trie
from shelfwise.llm.common import bound_batches
from tests.llm.conftest import EDGE, rows_of, texts_of


def brute(rows, order=3, masses=lm.MASSES):
    docs = []
    for doc, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        held = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2
        docs.append((doc, held, [*re.findall(r"[^\x20\x09-\x0D]+", low), 0]))
    count = Counter(w for _, held, words in docs if not held for w in words)
    grams = Counter(g for _, held, words in docs if not held
                    for n in (2, 3) for g in zip(*[[1, *words][k:] for k in range(n)], strict=False))
    contexts = Counter()
    for g, n in grams.items():
        contexts[g[:-1]] += n
    total, types = sum(count.values()), len(count)
    out = []
    for doc, held, words in docs:
        base = model = 0.0
        line = [1, *words]
        for k, w in enumerate(words, 1):
            p = (count[w] + 1) / (total + types + 1)
            base += log10(p)
            for n in range(1, min(order, k + 1)):
                h = tuple(line[k - n:k])
                if contexts[h]:
                    p = (grams[*h, w] + masses[n - 1] * p) / (contexts[h] + masses[n - 1])
            model += log10(p)
        out.append((doc, held, len(words), sum(count[w] > 0 for w in words), total, base, model))
    return out


def same(got, want):
    key = lambda r: (repr(r[:5]), round(r[5], 3))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert a[6] == pytest.approx(b[6], rel=1e-9, abs=3e-4 * b[2] + 1e-6)


@pytest.mark.parametrize(("order", "block", "shard"), [(3, 4_000_000, 6_000_000), (3, 3000, 2000), (2, 3000, 2000)])
def test_scores_equal_the_written_out_model(documents, edge, order, block, shard):
    for df, rows in ((documents, texts_of(documents)), (edge, EDGE)):
        out = lm.score_documents(df, order=order, block_tokens=block, shard_tokens=shard)
        assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        same(rows_of(out), brute(rows, order))


def test_hot_words_and_pairs_are_cut(spark):
    """One word and one pair hold most tokens; shards are far smaller than either."""
    bound_batches(spark)
    rows = [(k, " ".join(f"of the w{k * 7 % 60} of x{j % 9}" for j in range(30))) for k in range(60)]
    out = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_tokens=500, shard_tokens=300)
    same(rows_of(out), brute(rows))


def test_no_rows_and_no_training_rows(spark, nothing):
    assert lm.score_documents(nothing).count() == 0
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    rows = [(held, "a b a"), (held, None)]
    same(rows_of(lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))), brute(rows))
    with pytest.raises(ValueError):
        lm.score_documents(nothing, order=4)


def test_longer_contexts_tell_more_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = [[r for r in lm.score_documents(docs, order=n).collect() if r["held_out"]] for n in (2, 3)]
    base, pairs, trigrams = sum(r["base_score"] for r in found[0]), *(sum(r["score"] for r in f) for f in found)
    assert base < pairs < trigrams


def test_rows_grow_with_the_ngrams_not_with_blocks_times_shards(documents):
    from shelfwise.llm.common import stage
    blocks = stage(lm.read_blocks(documents.select("doc_id", "text"), 50), "blocks")
    pairs = sum(len(set(zip(["<s>", *w], w, strict=False))) for _, t in texts_of(documents) for w in [[*(t or "").split(), 1]])
    n = blocks.count()
    assert lm._ask_pairs(blocks, lm.Layout(50_000, 50, {})).count() <= min(pairs + n, n * 50_000)


def test_blocks_are_not_shuffled_again(spark, documents):
    blocks = lm._bucketed(lm.read_blocks(documents.select("doc_id", "text"), 2000))
    assert not any(t.name.startswith("lm_blocks") for t in spark.catalog.listTables())
    answers = blocks.selectExpr("1 as shard", "block", "words as here", "words as base", "words as counts", "words as ranks")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lm._ask_trigrams(blocks, answers.repartition(3), lm.Layout(4, 100, {}), {}, lm.MASSES, 3)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    join = text[text.index("SortMergeJoin"):]
    assert join.count("Exchange hashpartitioning(block") <= 1 and "Bucketed: true" in text


@pytest.mark.parametrize("top", [1, 200, 2**17, 2**63])
def test_packing_round_trip(top):
    values = np.random.default_rng(top % 1000).integers(0, top, 1000, dtype=np.uint64)
    assert (lm.unpack(lm.pack(values)) == values).all() and len(lm.unpack(lm.pack(values[:0]))) == 0


@pytest.mark.parametrize(("n", "top"), [(1, 5), (5, 3), (1000, 2**64 - 1), (70_000, 2**40), (5000, 6000)])
def test_elias_fano_search(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    with tempfile.TemporaryDirectory() as folder:
        levels = EliasFano(values, folder, "x")
        assert (levels[np.arange(n)] == values).all()
        queries = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64), values + np.uint64(1)])
        at = np.searchsorted(values, queries)
        assert (levels.successor(queries) == at).all()
        there = (at < n) & (values[np.minimum(at, n - 1)] == queries)
        assert (levels.find(queries) == np.where(there, at, -1)).all()


def test_ascending_values_are_found_by_one_pass_not_one_by_one(monkeypatch):
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 2**44, 200_000, dtype=np.uint64))
    queries = np.sort(np.concatenate([values, rng.integers(0, 2**45, 100_000, dtype=np.uint64)]))
    selected, select0 = [], EliasFano._select0
    monkeypatch.setattr(EliasFano, "_select0", lambda self, k: selected.append(len(k)) or select0(self, k))
    with tempfile.TemporaryDirectory() as folder:
        levels = EliasFano(values, folder, "x")
        found = levels.find(queries)
        assert sum(selected) < 100                      # was three for each value
        at = np.searchsorted(values, queries)
        assert (found == np.where(np.isin(queries, values), at, -1)).all()
        mixed = rng.permutation(queries)
        assert (values[levels.find(mixed)[np.isin(mixed, values)]] == mixed[np.isin(mixed, values)]).all()
        few = np.array([values[3], values[3] + np.uint64(1), values[-7], 2**63], np.uint64)     # far apart: probed
        assert levels.find(few).tolist() == [3, 4 if values[4] == few[1] else -1, len(values) - 7, -1]


def test_a_vocabulary_is_searched_once_for_each_word(monkeypatch):
    asked, find = [], EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda self, v: asked.append(len(v)) or find(self, v))
    owner, word = np.divmod(np.arange(3000), 30)
    words = np.arange(30, dtype=np.uint64) * np.uint64(7) + np.uint64(5)
    row = (0, 1, lm.pack(np.arange(100) + 1), lm.pack(np.full(100, 30)), lm.pack(words[word]), lm.pack(np.full(3000, 2)))
    seen = {}

    class Requests:
        groupBy = lambda self, _: self
        applyInPandas = lambda self, run, _: seen.update(run=run)

    lm._answer_pairs(Requests())
    out = seen["run"](pd.DataFrame([row], columns=["shard", "block", "contexts", "degrees", "successors", "tally"]))
    assert lm.unpack(out["counts"][0]).tolist() == [3] * 3000 and lm.unpack(out["ranks"][0]).tolist() == word.tolist()
    assert sorted(asked) == [30, 3000]                  # was 3000 twice


def test_words_are_hashed_together_and_told_apart():
    long = "x" * 64
    texts = ["The the THE  \t\x0b\x0cthE\r\n", "", "  \n", "a a\x00 a\x00\x00 \x00 \x00\x00", "É é", "\u00a0 \x85 \x1c",
             "12345678 123456789 1234567890123456 12345678901234567", f"{long} {long}x {long}xy {long[:-1]}", "the"]
    hashes, counts = lm.hashed_words([t.encode() for t in texts])
    words = [[w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", t)] for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    names = {}
    for h, w in zip(hashes.tolist(), [w for ws in words for w in ws], strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    for k in range(len(texts)):                         # the same wherever a word stands
        alone, _ = lm.hashed_words([texts[k].encode()])
        assert alone.tolist() == hashes[sum(counts[:k]):sum(counts[:k + 1])].tolist()
    assert [len(x) for x in lm.hashed_words([])] == [0, 0]
    many = lm.hashed_words([" ".join(f"word{k}" for k in range(300_000)).encode()])[0]
    assert len(np.unique(many)) == 300_000


def test_documents_of_a_batch_are_cut_into_blocks_by_tokens(spark):
    bound_batches(spark)
    docs = spark.createDataFrame([(k, "w " * (k % 5) if k % 7 else None) for k in range(200)], "doc_id long, text string").coalesce(1)
    rows = [r.asDict() for r in lm.read_blocks(docs, 20).collect()]
    assert [d for r in rows for d in r["docs"]] == list(range(200))
    assert [n for r in rows for n in r["sizes"]] == [(k % 5 if k % 7 else 0) + 1 for k in range(200)]
    assert all(sum(r["sizes"]) >= 20 > sum(r["sizes"][:-1]) for r in rows[:-1])
    for r in rows:
        block = lm.Block(r)
        ends = np.cumsum(r["sizes"]) - 1
        assert (np.flatnonzero(block.words[block.codes] == lm.END) == ends).all() and lm.START in block.words


def test_empty_sequence_and_quantiser():
    with tempfile.TemporaryDirectory() as folder:
        assert EliasFano(np.empty(0, np.uint64), folder, "x").find(np.array([3], np.uint64)).tolist() == [-1]
        trie = Trie(np.array([5, 9], np.uint64), np.array([0, 2]), np.array([0, 2, 1]), np.array([11, 12, 13], np.uint16),
                    folder, np.array([1, 4, 7], np.uint64))
        assert trie.children(np.array([0, 1])).tolist() == [2, 1]
        found = trie.search(np.array([0, 0, 0, 1, 1, -1]), np.array([1, 4, 7, 4, 7, 4], np.uint64))
        assert found.tolist() == [0, -1, 1, 2, -1, -1] and trie.values[found[found >= 0]].tolist() == [11, 12, 13]
    with tempfile.TemporaryDirectory() as folder:       # successors that are numbers already
        trie = Trie(np.array([5, 9], np.uint64), np.array([0, 2]), np.array([0, 3, 1]), np.array([1, 2, 3]), folder)
        assert trie.search(np.array([0, 0, 1, 1, 1]), np.array([0, 3, 1, 3, 9])).tolist() == [0, 1, 2, -1, -1]
    logs = np.linspace(-15, 0, 99)
    assert np.abs(Quantiser().decode(Quantiser().encode(logs)) - logs).max() < 2e-4
