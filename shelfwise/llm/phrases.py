"""Benchmark decontamination by a distributed positional inverted index.

The training texts are indexed in segments of bounded size, each built where
its documents are read and stored as one row: for every term its sorted token
positions.  A query phrase goes, by one shuffle, to the segments that hold its
rarest term.  There the positions of that term, less its offset in the phrase, are
intersected with the lists of the other terms, less theirs, rarest first.  Exact
phrases and proximity matches (every term within ``slop`` of its place) come
from the same intersection.  Segments are searched independently and hold a
bounded number of phrases at a time, so neither the texts nor the test set has a
bound; the matches of a document are put together at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import n_partitions, stage

# A-Z become lower case; the other characters up to \x7F but letters and digits part words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def _fold(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text (null: none)."""
    return [] if text is None else _fold(text).split()


INDEX_SCHEMA = ("docs array<long>, n_words array<long>, terms array<binary>, ends array<int>, positions binary, "
                "segment long")


def gap_of(slop: int) -> int:
    """Unused positions after each document, so that no match spans two."""
    return 2 * slop + 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: set[bytes] | None = None,
                segment_words: int = 1_000_000, slop: int = 0) -> DataFrame:
    """Index segments of about ``segment_words`` words (one document more at most).

    ``vocabulary`` restricts the stored terms to those that queries use; the
    positions still count every word.  A segment: the ids and word counts of
    its documents, its terms, the end of each term's list and all lists
    (uint32, in term order), its number.  Position p belongs to the document whose
    words start at or before p; unused positions follow each document, enough for
    proximity matches of ``slop``.
    """

    names = ["docs", "n_words", "terms", "ends", "positions", "segment"]
    types = [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary(), pa.int64()]

    def segment(ids, counts, known, codes, positions, nth):
        code, position = np.concatenate(codes), np.concatenate(positions)
        order = np.argsort(code, kind="stable")
        present, firsts = np.unique(code[order], return_index=True)
        ends = [*firsts[1:].tolist(), len(order)][:len(present)]
        values = (ids, counts, [known[c] for c in present.tolist()], ends, position[order].astype("<u4").tobytes(),
                  (TaskContext.get().partitionId() << 32) | nth)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def run(batches):
        fixed = None if vocabulary is None else sorted(vocabulary)
        known, number = list(fixed or ()), {w: i for i, w in enumerate(fixed or ())}
        ids, counts, codes, positions, base, nth = [], [], [], [], 0, 0
        for batch in batches:
            for row in range(batch.num_rows):
                words = words_of(batch.column(1)[row].as_py())
                if fixed is None:
                    for w in set(words).difference(number):
                        number[w] = len(known)
                        known.append(w)
                code = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
                at = np.flatnonzero(code >= 0)
                codes.append(code[at])
                positions.append(at + base)
                ids.append(batch.column(0)[row].as_py())
                counts.append(len(words))
                base += len(words) + gap_of(slop)
                if base >= segment_words:
                    yield segment(ids, counts, known, codes, positions, nth)
                    ids, counts, codes, positions, base, nth = [], [], [], [], 0, nth + 1
                    if fixed is None:
                        known, number = [], {}
        if ids:
            yield segment(ids, counts, known, codes, positions, nth)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, INDEX_SCHEMA)


class Segment:
    """One segment, searched for many phrases at once."""

    def __init__(self, terms, ends, positions: bytes, n_words, slop: int = 0):
        self.number = {bytes(t): i for i, t in enumerate(terms)}
        self.flat = np.frombuffer(positions, dtype="<u4").astype(np.int64)
        self.edges = np.array([0, *ends], np.int64)
        self.slop, counts = slop, np.array(n_words, np.int64)
        self.starts = np.cumsum(counts + gap_of(slop)) - counts - gap_of(slop)

    def search(self, phrases: list[tuple[bytes, ...]], held: int = 1 << 20):
        """(phrase, document, first word, exact) of every match, as arrays; about
        ``held`` positions at a time.

        A phrase's candidates are its rarest term's positions less the term's
        offset; the lists of its other terms, less their offsets and rarest first,
        thin them out.  All lists stand in one ascending array, each term's in a
        range of its own, so that one search looks into many lists.  With slop a
        candidate stays while each term stands at most that far from its place; it
        is exact if each stands in it."""
        slop, number = self.slop, self.number
        wanted = [(q, codes) for q, p in enumerate(phrases) if p and -1 not in (codes := [number.get(t, -1) for t in p])]
        empty = np.empty(0, np.int64)
        if not wanted:
            return empty, empty, empty, empty.astype(bool)
        query = np.array([q for q, _ in wanted], np.int64)
        sizes = np.array([len(c) for _, c in wanted], np.int64)
        codes = np.concatenate([c for _, c in wanted]).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        lengths = np.diff(self.edges)
        ranked = np.lexsort((lengths[codes], owner))           # each phrase's terms, rarest first
        margin = int(sizes.max()) + slop
        stride = int(self.flat.max()) + 2 * margin + 1
        lists = np.repeat(np.arange(len(lengths)), lengths) * stride + self.flat + margin
        lead = ranked[firsts]
        reach = np.cumsum(lengths[codes[lead]] * (2 * slop + 1))
        cuts = np.unique(np.searchsorted(reach, np.arange(held, int(reach[-1]), held), side="right"))
        found = []
        for part in np.split(np.arange(len(sizes)), cuts):
            n = lengths[codes[lead[part]]]
            phrase = np.repeat(part, n)
            nth = np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
            at = self.flat[self.edges[codes[lead[phrase]]] + nth]
            row = np.searchsorted(self.starts, at, side="right") - 1
            start = at - (lead[phrase] - firsts[phrase])
            shift = np.arange(-slop, slop + 1)
            exact = np.tile(shift == 0, len(start))
            start = (start[:, None] + shift).ravel()
            phrase, row = np.repeat(phrase, len(shift)), np.repeat(row, len(shift))
            for step in range(1, int(sizes.max())):
                if not len(start):
                    break
                term = ranked[firsts[phrase] + step % sizes[phrase]]
                place = codes[term] * stride + start + (term - firsts[phrase]) + margin
                near = np.searchsorted(lists, place - slop)
                ok = near < len(lists)
                ok[ok] = lists[near[ok]] <= place[ok] + slop
                if slop:
                    hit = np.searchsorted(lists, place)
                    there = exact & (hit < len(lists))
                    there[there] = lists[hit[there]] == place[there]
                    exact = there
                phrase, row, start, exact = phrase[ok], row[ok], start[ok], exact[ok]
            found.append((query[phrase], row, start - self.starts[row], exact))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


MATCH_SCHEMA = "doc_id long, n_words long, matches array<struct<query:int,start:int,size:int>>"


def search_index(index: DataFrame, phrases: list[tuple[bytes, ...]], slop: int = 0) -> DataFrame:
    """One row per indexed document: its word count and every match (query
    number, first word, number of words), proximity matches included; the index
    must have been built for ``slop``.  The phrases travel with the tasks: a short
    list; ``decontaminate`` searches any number."""

    def run(batches):
        names = ["doc_id", "n_words", "matches"]
        kind = pa.list_(pa.struct([("query", pa.int32()), ("start", pa.int32()), ("size", pa.int32())]))
        for batch in batches:
            for k in range(batch.num_rows):
                ids, counts, terms, ends, positions, _ = (c[k].as_py() for c in batch.columns)
                query, row, start, _ = Segment(terms, ends, positions, counts, slop).search(phrases)
                matches = [set() for _ in ids]
                for q, d, s in zip(query.tolist(), row.tolist(), start.tolist(), strict=True):
                    matches[d].add((q, s, len(phrases[q])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(counts),
                     pa.array([[{"query": q, "start": s, "size": n} for q, s, n in sorted(m)] for m in matches], kind)],
                    names)

    return index.mapInArrow(run, MATCH_SCHEMA)


def windows_of(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    """Consecutive windows of ``size`` words; fewer words, but not none, are one."""
    if not words:
        return []
    return [tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]


HIT_SCHEMA = ("segment long, row int, spans array<struct<start:int,size:int>>, items array<string>, "
              "near array<long>")


def _search_segments(index: DataFrame, pairs: DataFrame, slop: int, held_windows: int = 8192) -> DataFrame:
    """Per document with matches: its segment, place there, the spans and items of
    exact matches, and the hashes of windows that stand near only.

    ``pairs``: (segment, window, items).  A segment's row comes first in its
    partition, its windows follow as a stream, ``held_windows`` at a time."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    types = [pa.int64(), pa.int32(), span, pa.list_(pa.string()), pa.list_(pa.int64())]

    def answers(segment, part: Segment, windows) -> Iterator[pa.RecordBatch]:
        phrases = [tuple(bytes(w).split(b" ")) for w, _, _ in windows]
        query, row, start, exact = part.search(phrases)
        by = np.argsort(row, kind="stable")
        rows, firsts = np.unique(row[by], return_index=True)
        out = []
        for r, hits in zip(rows.tolist(), np.split(by, firsts[1:]), strict=True) if len(rows) else ():
            same = hits[exact[hits]]
            whole = np.unique(query[same])
            near = np.setdiff1d(query[hits], whole)
            spans = {(s, len(phrases[q])) for s, q in zip(start[same].tolist(), query[same].tolist(), strict=True)}
            out.append((segment, r, [{"start": a, "size": n} for a, n in sorted(spans)],
                        sorted({o for q in whole.tolist() for o in windows[q][1]}),
                        sorted({windows[q][2] for q in near.tolist()})))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                             ["segment", "row", "spans", "items", "near"])

    def run(batches):
        segment, part, windows = None, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["terms"] is not None:
                    if windows:
                        yield from answers(segment, part, windows)
                    segment, windows = r["segment"], []
                    part = Segment(r["terms"], r["ends"], r["positions"], r["n_words"], slop)
                else:
                    windows.append((r["window"], r["items"], r["hash"]))
                    if len(windows) >= held_windows:
                        yield from answers(segment, part, windows)
                        windows = []
        if windows:
            yield from answers(segment, part, windows)

    rows = index.select("segment", F.lit(0).alias("tag"), "n_words", "terms", "ends", "positions").unionByName(
        pairs.select("segment", F.lit(1).alias("tag"), "window", "items", F.xxhash64("window").alias("hash")),
        allowMissingColumns=True)
    return (rows.repartition(n_partitions(index.sparkSession), "segment").sortWithinPartitions("segment", "tag")
            .mapInArrow(run, HIT_SCHEMA))


def _to_segments(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(segment, window, items): each window with the segments that hold its rarest
    term; windows with a term that no segment holds are nowhere."""
    lists = (index.select("segment", F.arrays_zip("terms", "ends").alias("x"), F.expr("transform(ends, (e, i) -> "
                          "e - if(i = 0, 0, ends[i - 1]))").alias("n"))
             .select("segment", F.posexplode("x").alias("i", "x"), "n")
             .select("segment", F.col("x.terms").cast("string").alias("term"), F.get("n", F.col("i")).alias("n")))
    lists = stage(lists, "phrase-lists")
    total = lists.groupBy("term").agg(F.sum("n").alias("total"))
    each = windows.select("window", F.explode(F.array_distinct(F.split(F.col("window").cast("string"), " "))).alias("term"))
    distinct = each.distinct()          # a window of many items has several rows
    rarest = (distinct.join(total, "term", "left").groupBy("window").agg(
        F.min(F.struct("total", "term")).alias("rarest"), F.count_if(F.col("total").isNull()).alias("missing"))
        .where("missing = 0").select("window", F.col("rarest.term").alias("term")))
    return (windows.join(rarest, "window").join(lists.select("segment", "term"), "term")
            .select("segment", "window", "items"))


def window_table(benchmark: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text",
                 slice_items: int = 10_000) -> DataFrame:
    """(window, items): every distinct window of all items, its words between
    blanks, with the ids (as strings) of its items; a window of very many items
    has a row for every ``slice_items`` of them."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                words, item = words_of(batch.column(1)[r].as_py()), batch.column(0)[r].as_py() or ""
                for at in range(0, max(1, len(words) - size + 1) if words else 0, 10_000):
                    part = {b" ".join(w) for w in windows_of(words[at:at + 9_999 + size], size)}
                    yield pa.RecordBatch.from_arrays([pa.array(sorted(part), pa.binary()),
                                                      pa.array([item] * len(part), pa.string())], ["window", "item"])

    each = benchmark.select(F.col(id_col).cast("string"), text_col).mapInArrow(run, "window binary, item string")
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        "window", F.explode(F.transform(F.sequence(F.lit(1), F.size("items"), F.lit(slice_items)),
                                        lambda k: F.slice("items", k, slice_items))).alias("items"))


def _vocabulary(windows: DataFrame, held: int) -> set[bytes] | None:
    """The windows' terms, or None (index all terms) where they take over ``held`` bytes."""

    def run(batches):
        for batch in batches:
            terms = {t for w in batch.column(0).to_pylist() for t in w.split(b" ")}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(terms), pa.binary())], ["term"])

    terms = stage(windows.select("window").mapInArrow(run, "term binary").distinct(), "phrase-terms")
    if (terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0) > held:
        return None
    return {bytes(r["term"]) for r in terms.collect()}


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, slop: int = 2,
                  vocabulary_bytes: int = 32 << 20, segment_words: int = 1_000_000) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    n_near.

    A window is ``size`` consecutive words of a test item (a shorter item is
    one window).  A document word inside any occurrence of a window is hit;
    contaminated when n_hit > 0 and share * n_hit >= n_words.  n_near counts the
    windows that stand nowhere in the text exactly, but somewhere with every word
    at most ``slop`` places off.  Neither side has a bound; the index leaves out
    terms that no window has while those of all windows take up to
    ``vocabulary_bytes``, and stores every term beyond.  Null texts have no words,
    repeated rows repeat, null item ids count as an empty id, other columns are
    ignored, empty tables give no rows or no hits.
    """
    windows = stage(window_table(benchmark, size), "phrase-windows")
    index = stage(build_index(docs, vocabulary=_vocabulary(windows, vocabulary_bytes), slop=slop,
                              segment_words=segment_words), "phrase-index")
    every = index.select("segment", F.posexplode(F.arrays_zip("docs", "n_words")).alias("row", "x")).select(
        "segment", "row", "x.docs", "x.n_words")
    every = every.unionByName(_search_segments(index, _to_segments(index, windows), slop), allowMissingColumns=True)
    covered = F.expr("""aggregate(array_sort(spans), named_struct('edge', 0L, 'hit', 0L), (a, m) -> named_struct(
        'edge', greatest(a.edge, cast(m.start + m.size as long)),
        'hit', a.hit + greatest(0L, m.start + m.size - greatest(a.edge, cast(m.start as long)))), a -> a.hit)""")
    return (every.groupBy("segment", "row").agg(
        F.max("docs").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.size(F.array_distinct(F.flatten(F.collect_list("near")))).cast("long").alias("n_near"))
        .select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "n_near")
        .withColumn("contaminated", is_contaminated(share))
        .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"))


def is_contaminated(share: int) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
