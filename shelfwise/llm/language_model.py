"""Scores from a distributed trigram model in Elias-Fano tries.

Documents are read into blocks of tokens.  A block asks the shards of the first
level for its distinct (context, successor) word pairs; a shard merges what all
blocks ask into one trie level in memory-mapped files and answers with counts
and with each pair's place among its context's successors.  For the second level
the context is a pair, named by its place in the first one, and the successor is
coded by its place among the successors of the shorter context (the middle word),
a small number.  A shard of that level holds quantised smoothed probabilities,
finds each trigram by search inside its context's range, and adds the log
probabilities up per document, so the tokens never come back.

Contexts are spread over shards by hash; a context with more tokens than a shard
should hold is cut by successor as well.  A pair of block and shard that share
nothing makes no row, so rows grow with the n-grams, not with blocks x shards.
Both sides hold a bounded number of tokens.

Smoothing is Dirichlet's at both levels: p(w | h) = (c(hw) + m p(w | shorter h)) /
(c(h) + m), which needs counts only, and all of those at the place where they are
used.  A trigram of which one of its two pairs occurs a single time in all
documents is not sent: its count is 1 by that.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import LOWER, n_partitions, stage
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.llm.ngram_trie import Quantiser, Trie

START = np.uint64(xxhash.xxh3_64_intdigest(b"\n<start>"))       # no word holds a line break
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n<end>"))
QUANTISER = Quantiser()
MASSES = (8.0, 4.0)             # pseudo-counts of the shorter context, for pairs and trigrams


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Unsigned integers in as few bytes as the largest needs, byte by byte of equal rank, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=level).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :data[0]] = planes.T
    return out.view(np.uint64)[:, 0]


def _gaps(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers from any."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def learnt(folds: int = 7, held: int = 2):
    """Whether a document teaches: crc32 of its id as text, modulo ``folds``, is not ``held``."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) != held,
                      F.lit(True))


# ------------------------------------------------------------------ blocks

_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG_WORD = 64                  # bytes


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the A-Z lower-cased words of all texts, one after another, and
    the number of words of each.  A word's length and then its bytes, eight by eight,
    are mixed for all words at once; long words are hashed one by one."""
    data = b"".join([b"\n", b"\n".join(texts), b"\n" * 9]).translate(LOWER)
    inside = _IN_WORD[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = mix(mix(size) ^ (eights[starts] & _FIRST_BYTES[np.minimum(size, 8)]))
    at = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    for done in range(8, LONG_WORD, 8):
        out[at] = mix(out[at] ^ (eights[starts[at] + done] & _FIRST_BYTES[np.minimum(size[at] - done, 8)]))
        at = at[size[at] > done + 8]
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]])
    borders = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return out, np.diff(np.searchsorted(starts, borders), prepend=0)


_BLOCK_TYPES = {"block": pa.int64(), "docs": pa.list_(pa.int64()), "train": pa.list_(pa.bool_()),
                "sizes": pa.list_(pa.int64()), "words": pa.binary(), "codes": pa.binary()}
_BLOCK = "block long, docs array<long>, train array<boolean>, sizes array<long>, words binary, codes binary"


def read_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """(block, docs, train, sizes, words, codes): blocks of about ``block_tokens``
    tokens (one document more at most).  words: the gaps of the distinct word
    hashes, START's included, ascending; codes: the tokens of all documents as
    places among them."""

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        ids, train, sizes, tokens, held = [], [], [], [np.array([START])], 0

        def out():
            words, codes = np.unique(np.concatenate(tokens), return_inverse=True)
            values = [(part << 32) | nth, ids, train, sizes, pack(_gaps(words)), pack(codes.ravel()[1:], 3)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _BLOCK_TYPES.values(), strict=True)],
                                              names=list(_BLOCK_TYPES))

        for batch in batches:
            hashes, counts = hashed_words([t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()])
            row_ids, row_train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            line = np.full(len(hashes) + len(counts), END)
            line[np.arange(len(hashes)) + np.repeat(np.arange(len(counts)), counts)] = hashes
            till, a = np.append(0, np.cumsum(counts + 1)), 0
            while a < len(counts):
                b = min(int(np.searchsorted(till, till[a] + block_tokens - held)), len(counts))
                ids += row_ids[a:b]
                train += row_train[a:b]
                sizes += (counts[a:b] + 1).tolist()
                tokens.append(line[till[a]:till[b]])
                held, a = held + int(till[b] - till[a]), b
                if held >= block_tokens:
                    yield out()
                    ids, train, sizes, tokens, held, nth = [], [], [], [np.array([START])], 0, nth + 1
        if ids:
            yield out()

    return docs.select("doc_id", learnt().alias("train"), "text").mapInArrow(run, _BLOCK)


class Block:
    """One block's tokens and its distinct word pairs, in order of (context, word)."""

    def __init__(self, row: dict):
        self.number, self.docs = row["block"], row["docs"]
        self.train, self.sizes = np.array(row["train"], bool), np.array(row["sizes"], np.int64)
        self.words = np.cumsum(unpack(row["words"]), dtype=np.uint64)
        self.codes = unpack(row["codes"]).astype(np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes        # first tokens of the documents
        self.taught = np.repeat(self.train, self.sizes)

    def pair_up(self) -> None:
        """context, word, and of_token: the pair that each token ends."""
        previous = np.empty_like(self.codes)
        previous[1:] = self.codes[:-1]
        previous[self.firsts] = np.searchsorted(self.words, START)
        pairs, of_token = np.unique(previous * len(self.words) + self.codes, return_inverse=True)
        self.of_token = of_token.ravel()
        self.context, self.word = np.divmod(pairs, len(self.words))


def tally(of_token: np.ndarray, taught: np.ndarray, n: int) -> np.ndarray:
    """Per n-gram 2 * its training count, plus 1 if it stands in a held-out text."""
    count = np.bincount(of_token[taught], minlength=n)
    return 2 * count + (np.bincount(of_token[~taught], minlength=n) > 0)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, n): training counts of every word hash of the corpus, END's too."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                count = np.bincount(block.codes[block.taught], minlength=len(block.words))
                known = count > 0
                yield pa.RecordBatch.from_arrays([pa.array(block.words[known].view(np.int64)), pa.array(count[known])],
                                                 names=["word", "n"])

    return blocks.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Layout:
    """Which shard holds an n-gram: by context, for contexts of more than half a
    shard's tokens by successor as well.  There are fewer such words than twice
    the shards; their counts are all that tasks get to know of the corpus."""

    def __init__(self, shards: int, shard_tokens: int, hot: dict[int, int]):
        self.shards, self.part_tokens = shards, max(1, shard_tokens // 2)
        self.hot = np.array(sorted(hot), np.uint64)
        self.totals = np.array([hot[int(h)] for h in self.hot], np.int64)

    def parts_of(self, counts: np.ndarray) -> np.ndarray:
        return np.clip(-(-counts // self.part_tokens), 1, self.shards)

    def hot_counts(self, words: np.ndarray) -> np.ndarray:
        """Counts of the hot words among ``words``, 0 for the others."""
        if not len(self.hot):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return np.where(self.hot[at] == words, self.totals[at], 0)

    def pairs(self, words, context, word) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, part, parts) of pairs of places in ``words``."""
        parts = self.parts_of(self.hot_counts(words))[context]
        first = (mix(words) % np.uint64(self.shards)).astype(np.int64)[context]
        part = (mix(words + np.uint64(1))[word] % parts.astype(np.uint64)).astype(np.int64)
        return (first + part) % self.shards, part, parts

    def trigrams(self, ident, count, successor) -> np.ndarray:
        """Shard of (context, successor) of the second level; ``count``: the context's."""
        part = mix(successor.astype(np.uint64) + np.uint64(1)) % self.parts_of(count).astype(np.uint64)
        return ((mix(ident) % np.uint64(self.shards) + part) % np.uint64(self.shards)).astype(np.int64)


def _runs(shard: np.ndarray, context: np.ndarray):
    """Of items in order of (shard, context): for every shard that occurs (shard,
    first item, end, first entry, end), and the entries' first items."""
    if not len(shard):
        return [], np.empty(0, np.int64)
    new = np.concatenate([[True], (shard[1:] != shard[:-1]) | (context[1:] != context[:-1])])
    entries = np.flatnonzero(new)
    shards, at = np.unique(shard, return_index=True)
    items = np.append(at, len(shard))
    rows = np.searchsorted(entries, items)
    return list(zip(shards.tolist(), items[:-1].tolist(), items[1:].tolist(), rows[:-1].tolist(), rows[1:].tolist(),
                    strict=True)), entries


# -------------------------------------------------------------- first level

_ASK = "shard int, block long, contexts binary, degrees binary, successors binary, tally binary"
_ANSWER = "shard int, block long, here binary, base binary, counts binary, ranks binary"


def _binaries(rows: list[tuple], ints: dict[str, pa.DataType], names: list[str]) -> pa.RecordBatch:
    kinds = [*ints.values(), *[pa.binary()] * len(names)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[*ints, *names])


_KEYS = {"shard": pa.int32(), "block": pa.int64()}


def _ask_pairs(blocks: DataFrame, layout: Layout) -> DataFrame:
    """One row for each block and shard that have a pair in common."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                block.pair_up()
                told = tally(block.of_token, block.taught, len(block.context))
                shard, _, _ = layout.pairs(block.words, block.context, block.word)
                order = np.argsort(shard, kind="stable")
                context = block.context[order]
                runs, entries = _runs(shard[order], context)
                degrees = np.diff(np.append(entries, len(order)))
                asked, successors, told = block.words[context[entries]], block.words[block.word[order]], told[order]
                rows = [(s, block.number, pack(_gaps(asked[c:d])), pack(degrees[c:d]), pack(successors[a:b]), pack(told[a:b]))
                        for s, a, b, c, d in runs]
                yield _binaries(rows, _KEYS, ["contexts", "degrees", "successors", "tally"])

    return blocks.mapInArrow(run, _ASK)


def _merged(parts):
    """Requests of all blocks together: distinct contexts, the owner of each
    request, the distinct (owner, successor) and each request's place among them,
    training counts, and whether a pair occurs a single time in all."""
    contexts, entry = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    owner = np.repeat(entry, np.concatenate([p[1] for p in parts]))
    successors = np.concatenate([p[2] for p in parts])
    told = np.concatenate([p[3] for p in parts])
    vocabulary, word = np.unique(successors, return_inverse=True)
    width = max(1, len(vocabulary))
    pairs, at = np.unique(owner * width + word, return_inverse=True)
    count = np.bincount(at, told >> 1, len(pairs)).astype(np.int64)
    held = np.bincount(at, told & 1, len(pairs)) > 0
    owner, word = np.divmod(pairs, width)
    return contexts, entry, owner, vocabulary, word, at, count, (count == 1) & ~held


def _answer_pairs(requests: DataFrame) -> DataFrame:
    """Per request row, for its contexts: training count here and place of their
    first successor; for its pairs: 2 * count (+ 1 if it occurs once in all) and
    place among the context's learnt successors."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard, blocks = int(frame["shard"].iloc[0]), frame["block"].tolist()
        parts = [(np.cumsum(unpack(c)), unpack(d).astype(np.int64), unpack(s), unpack(t).astype(np.int64)) for c, d, s, t in
                 frame[["contexts", "degrees", "successors", "tally"]].itertuples(index=False)]
        entries, sizes = [len(p[0]) for p in parts], [len(p[2]) for p in parts]
        contexts, entry, owner, vocabulary, word, at, count, alone = _merged(parts)
        del parts, frame
        known = count > 0
        pointers = np.searchsorted(owner[known], np.arange(len(contexts)))
        here = np.bincount(owner, count, len(contexts)).astype(np.int64)
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(contexts, pointers, word[known], count[known], folder, vocabulary)
            place = trie.search_ranks(owner, trie.ranks(vocabulary)[word])
            counts = np.where(place >= 0, trie.values[np.maximum(place, 0)] if known.any() else 0, 0)
            ranks = np.where(place >= 0, place - pointers[owner], 0)
            del trie
        told = 2 * counts + alone
        out, a, c = [], 0, 0
        for block, n, m in zip(blocks, sizes, entries, strict=True):
            mine, asked = at[a:a + n], entry[c:c + m]
            out.append((shard, block, pack(here[asked]), pack(pointers[asked]), pack(told[mine]), pack(ranks[mine])))
            a, c = a + n, c + m
        return pd.DataFrame(out, columns=["shard", "block", "here", "base", "counts", "ranks"])

    return requests.groupBy("shard").applyInPandas(run, _ANSWER)


# ------------------------------------------------------------- second level

_MORE = {"docs": pa.list_(pa.int64()), "train": pa.list_(pa.bool_()), "n_tokens": pa.list_(pa.int64()),
         "n_known": pa.list_(pa.int64()), "base": pa.list_(pa.float64()), "score": pa.list_(pa.float64())}
_ASKED = ["contexts", "whole", "degrees", "successors", "tally", "lower", "repeats", "slots"]
_TRIGRAMS = ("shard int, block long, " + ", ".join(f"{n} binary" for n in _ASKED) + ", docs array<long>, "
             "train array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, score array<double>")
_SUMS = ("block long, shard int, slots binary, sums binary, docs array<long>, train array<boolean>, "
         "n_tokens array<long>, n_known array<long>, base array<double>, score array<double>")


def _seen(count: np.ndarray, whole: np.ndarray, mass: float) -> np.ndarray:
    """Quantised c(hw) / (c(h) + m), 0 where nothing was seen."""
    code = QUANTISER.encode(np.log10(np.maximum(count, 1) / (np.maximum(whole, 1) + mass)))
    return np.where(count > 0, 10.0 ** QUANTISER.decode(code), 0.0)


def _score_block(block: Block, answers: list[dict], layout: Layout, corpus: dict, masses, order: int):
    """The partial row of a block (its documents with what it can tell of their
    scores itself) and its requests of trigrams."""
    block.pair_up()
    context, word, of_token = block.context, block.word, block.of_token
    shard, part, parts = layout.pairs(block.words, context, word)
    by = np.argsort(shard, kind="stable")
    runs, entries = _runs(shard[by], context[by])
    told, rank, first = (np.empty(len(by), np.int64) for _ in range(3))
    count, given = np.zeros(len(block.words), np.int64), {a["shard"]: a for a in answers}
    for s, a, b, c, d in runs:
        answer, mine = given[s], by[a:b]
        told[mine], rank[mine] = unpack(answer["counts"]).astype(np.int64), unpack(answer["ranks"]).astype(np.int64)
        count[context[by[entries[c:d]]]] = unpack(answer["here"]).astype(np.int64)
        first[mine] = np.repeat(unpack(answer["base"]).astype(np.int64), np.diff(np.append(entries[c:d], b)))
    del answers, given
    hot = layout.hot_counts(block.words)
    count = np.where(hot > 0, hot, count)
    as_word = np.where(block.words == START, 0, np.where(block.words == END, corpus["documents"], count))
    base = (as_word + 1) / (corpus["tokens"] + corpus["types"] + 1)
    pair_count, alone, whole = told >> 1, (told & 1) > 0, count[context]
    second = _seen(pair_count, whole, masses[0]) + np.where(
        whole > 0, masses[0] / (np.maximum(whole, 1) + masses[0]), 1.0) * base[word]

    tokens = len(block.codes)
    lower, asked = second[of_token], np.zeros(tokens, bool)
    own = lower
    if order > 2:
        before = np.empty(tokens, np.int64)
        before[1:] = of_token[:-1]
        inside = np.ones(tokens, bool)
        inside[block.firsts] = False
        before[~inside] = 0
        whole = np.where(inside, pair_count[before], 0)
        lower = np.where(whole > 0, masses[1] / (np.maximum(whole, 1) + masses[1]), 1.0) * lower
        there = (whole > 0) & (pair_count[of_token] > 0)
        implied = there & (alone[of_token] | alone[before])         # a pair that occurs once, here: so does the trigram
        asked = there & ~implied
        own = lower + _seen(implied.astype(np.int64), whole, masses[1])
    doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
    n = len(block.sizes)
    sums = [np.bincount(doc, w, n) for w in ((as_word > 0)[block.codes], np.log10(base)[block.codes],
                                             np.where(asked, 0.0, np.log10(own)))]
    partial = (block.docs, block.train.tolist(), block.sizes.tolist(), sums[0].astype(np.int64).tolist(),
               sums[1].tolist(), sums[2].tolist())
    if not asked.any():
        return partial, []
    at = np.flatnonzero(asked)
    del second, own, asked
    trigrams, of_asked = np.unique(before[at] * len(context) + of_token[at], return_inverse=True)
    of_asked = of_asked.ravel()
    pair, last = np.divmod(trigrams, len(context))
    ident = ((first + rank) * layout.shards + shard).astype(np.uint64)[pair]
    successor, count = (rank * parts + part)[last], pair_count[pair]
    level = np.zeros(len(trigrams))
    level[of_asked] = lower[at]
    told, repeats = tally(of_asked, block.taught[at], len(trigrams)), np.bincount(of_asked, minlength=len(trigrams))
    to = layout.trigrams(ident, count, successor)
    by = np.argsort(to, kind="stable")
    runs, entries = _runs(to[by], pair[by])
    degrees = np.diff(np.append(entries, len(by)))
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    slots = doc[at][np.argsort(place[of_asked], kind="stable")]
    ends = np.cumsum(repeats[by])
    ident, count, level = ident[by[entries]], count[by[entries]], QUANTISER.encode(np.log10(level[by]))
    rows = [(s, block.number, pack(ident[c:d]), pack(count[c:d]), pack(degrees[c:d]), pack(successor[by[a:b]]),
             pack(told[by[a:b]]), pack(level[a:b]), pack(repeats[by[a:b]]), pack(slots[ends[a - 1] if a else 0:ends[b - 1]]))
            for s, a, b, c, d in runs]
    return partial, rows


def _ask_trigrams(blocks: DataFrame, answers: DataFrame, layout: Layout, corpus: dict, masses, order: int) -> DataFrame:
    """Requests of trigrams, and one partial row a block under a negative shard."""
    types = {**_KEYS, **dict.fromkeys(_ASKED, pa.binary()), **_MORE}

    def rows_of(row, given):
        block = Block(row)
        partial, asked = _score_block(block, given, layout, corpus, masses, order)
        rows = [(*r, *[None] * len(_MORE)) for r in asked]
        rows.append((-1 - block.number % layout.shards, block.number, *[None] * len(_ASKED), *partial))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(),
                                                                         strict=True)], names=list(types))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield rows_of(row, row.pop("answers"))

    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "here", "base", "counts", "ranks")).alias("answers"))
    return blocks.join(gathered, "block").mapInArrow(run, _TRIGRAMS)


def _answer_trigrams(requests: DataFrame, mass: float) -> DataFrame:
    """Sums of log10 probabilities per block and document; partial rows pass."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        if shard < 0:
            return frame.assign(slots=None, sums=None)[names]
        parts, rest = [], []
        for row in frame[["block", *_ASKED]].itertuples(index=False):
            ident, whole, degrees, successors, told, level, repeats, slots = map(unpack, row[1:])
            parts.append((ident, degrees.astype(np.int64), successors, told.astype(np.int64)))
            rest.append((row[0], whole.astype(np.int64), level, repeats.astype(np.int64), slots.astype(np.int64)))
        del frame
        contexts, entry, owner, vocabulary, word, at, count, _ = _merged(parts)
        whole = np.empty(len(contexts), np.int64)
        whole[entry] = np.concatenate([r[1] for r in rest])
        known, sizes = count > 0, [len(p[2]) for p in parts]
        del parts
        pointers = np.searchsorted(owner[known], np.arange(len(contexts)))
        codes = QUANTISER.encode(np.log10(count[known] / (whole[owner[known]] + mass)))
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(contexts, pointers, vocabulary[word[known]], codes, folder)
            place = trie.search_ranks(owner, trie.ranks(vocabulary)[word])
            code = np.where(place >= 0, trie.values[np.maximum(place, 0)] if known.any() else 0, 0)
            del trie
        seen, out, a = np.where(code > 0, 10.0 ** QUANTISER.decode(code), 0.0), [], 0
        for (block, _, level, repeats, slots), n in zip(rest, sizes, strict=True):
            logs = np.log10(seen[at[a:a + n]] + 10.0 ** QUANTISER.decode(level))
            sums = np.bincount(slots, np.repeat(logs, repeats))
            touched = np.unique(slots)
            out.append((block, shard, pack(_gaps(touched)), sums[touched].astype("<f4").tobytes(), *[None] * len(_MORE)))
            a += n
        return pd.DataFrame(out, columns=names)

    names = ["block", "shard", "slots", "sums", *_MORE]
    return requests.groupBy("shard").applyInPandas(run, _SUMS)


def _add_up(sums: DataFrame) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, base_score, score): a block's parts in order of the shards."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        own = frame[frame["shard"] < 0].iloc[0]
        score = np.array(own["score"], np.float64)
        for slots, part in frame[frame["shard"] >= 0][["slots", "sums"]].itertuples(index=False):
            score[np.cumsum(unpack(slots)).astype(np.int64)] += np.frombuffer(part, "<f4")
        return pd.DataFrame({"doc_id": pd.array(list(own["docs"]), "Int64"), "train": list(own["train"]),
                             "n_tokens": own["n_tokens"], "n_known": own["n_known"], "base_score": own["base"],
                             "score": score})

    return sums.groupBy("block").applyInPandas(
        run, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def _bucketed(blocks: DataFrame) -> DataFrame:
    """The blocks written to the shared folder in buckets of their number: the
    answers come to them, they are not shuffled again.  The table's name is only
    needed to write it."""
    spark = blocks.sparkSession
    name = f"lm_blocks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    (blocks.write.format("parquet").bucketBy(n_partitions(spark), "block").option("path", path).saveAsTable(name))
    table = spark.table(name)
    table.schema                # resolved from here on
    spark.sql(f"DROP TABLE {name}")
    return table


def _release(spark: SparkSession) -> None:
    """Shuffle files of finished steps go once nothing refers to them, which a
    garbage collection has to find out; Spark's own comes every half an hour.  The
    second one is for what the listeners still held during the first."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def score_documents(docs: DataFrame, order: int = 3, masses: tuple[float, float] = MASSES, block_tokens: int = 1_200_000,
                    shard_tokens: int = 1_500_000) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the A-Z lower-cased words between ASCII blanks and one end.  The
    model has ``order`` 3 (trigrams) or 2, Dirichlet smoothing with ``masses`` for
    pairs and trigrams, and add-one unigrams (the base score) below; it is learnt
    from the documents outside the held-out fold.  Null and empty texts have the
    end only; null ids teach; repeated rows count and are scored each; other
    columns are ignored; without training documents every token is unknown; an
    empty table gives no rows.  Words and pairs are told apart by 64-bit hashes.
    The tries' files lie in a task's own temporary folder while it runs; a task
    that is run again makes them again.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    blocks = _bucketed(read_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), block_tokens))
    sums = blocks.select(F.aggregate(F.arrays_zip("sizes", "train"), F.lit(0).cast("long"), lambda a, x: a + F.when(
        x["train"], x["sizes"]).otherwise(0)).alias("tokens"),
        F.size(F.filter("train", lambda x: x)).alias("documents"),
        F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("all")).agg(
        F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"), F.sum("all").alias("all")).first()
    tokens, documents = sums["tokens"] or 0, sums["documents"] or 0
    shards = max(4, -(-(sums["all"] or 0) // shard_tokens))
    # words of more than half a shard's tokens: fewer than twice the shards
    words = word_counts(blocks).agg(F.count("*").alias("types"), F.collect_list(
        F.when(F.col("n") > shard_tokens // 2, F.struct("word", "n"))).alias("hot")).first()
    hot = {r["word"] & (1 << 64) - 1: r["n"] for r in words["hot"]}
    if documents > shard_tokens // 2:
        hot[int(START)] = documents
    corpus = {"tokens": tokens, "documents": documents, "types": words["types"]}
    _release(spark)
    layout = Layout(shards, shard_tokens, hot)
    answers = stage(_answer_pairs(_ask_pairs(blocks, layout)), "lm-answers")
    _release(spark)
    scored = _add_up(_answer_trigrams(_ask_trigrams(blocks, answers, layout, corpus, masses, order), masses[1]))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
