"""Best-fit packing by minimum bin slack.

Only lengths matter for packing, and there are at most ``capacity`` of them, so
the corpus reduces to a histogram of fixed size.  Each bin takes the largest
length left and the fullest feasible combination of the others, found by a
bitset subset-sum; that combination is removed, as many times as the counts
allow.  The resulting patterns are dealt out to the pieces by their rank within
their length, which is counted per partition, so no length class is ever
gathered in one task.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfwise.llm.common import LOWER, stage

# ------------------------------------------------------------------ token ids
# A chunk of letters with at most one mark after it; checked by its number of word ends below.
_SIMPLE = re.compile(r"[^\W\d_]+([.,;:!?]?)")
# Small letters that normalisation leaves alone, with ASCII marks around them (no
# apostrophe, which may begin a pre-token with letters in it).
_LETTERS = re.compile(r"([!-&(-/:-@\[-`{-~]*)([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# on UTF-8 bytes, where values below 128 are ASCII characters and nothing else
_BLANKS = bytes.maketrans(b"\n\t\r\f\v", b"     ")
_PLAIN = LOWER.translate(_BLANKS)


def letters_library(library: Tokenizer) -> Tokenizer | None:
    """The library's tokenizer without the steps that change nothing in words of
    plain small letters (normalising, splitting by a regex): they only go apart at
    blanks.  None if its settings are not those this is known of."""
    settings = json.loads(library.to_str())
    normal, before = settings["normalizer"] or {}, (settings["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normal.get("normalizers") != _NORMAL or [x["type"] for x in before] != ["Split", "ByteLevel"] or (
            before[0]["pattern"], before[0]["behavior"], before[0]["invert"]) != ({"Regex": _SPLIT}, "Removed", True) or (
            before[1]["add_prefix_space"] or before[1]["use_regex"]):
        return None
    settings["normalizer"], before[0] = None, {"type": "WhitespaceSplit"}
    return Tokenizer.from_str(json.dumps(settings))


class WordEncoder:
    """Token ids of whole texts for a tokenizer that drops white space between words.

    White-space chunks are encoded independently of each other by such a
    tokenizer (no merge, normalisation or pre-token crosses a blank), so each
    distinct chunk goes through the library once and is remembered, up to
    ``limit`` chunks; then the memory starts afresh.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        self.library = Tokenizer.from_file(path)
        self.limit, self.known = limit, {"": b""}
        self.letters = letters_library(self.library)
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Runs of marks and of letters are pre-tokens of their own: a word of plain
        letters with marks around them has the ids of its runs one after the other."""
        if self.letters is None:
            return self._learn_other(words)
        known, letters, marked, cores, other = self.known, _LETTERS.fullmatch, [], [], []
        for word in words:
            found = letters(word)
            if not found:
                other.append(word)
            elif word.isalpha():
                cores.append(word)
            else:
                marked.append((word, *found.groups()))
        cores = list({*cores, *[core for _, _, core, _ in marked if core not in known]})
        if cores:
            ids = np.array(self.letters.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(cores) and stops[-1] == len(ids):
                data, at = ids.tobytes(), [0, *(4 * stops).tolist()]
                known.update(zip(cores, [data[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
            else:                                       # some core is not what it seems
                other += cores
        other += [mark for _, before, _, after in marked for mark in (before, after) if mark not in known]
        if other:
            self._learn_other(list(dict.fromkeys(other)))
        for word, before, core, after in marked:
            known[word] = known[before] + known[core] + known[after]

    def _learn_other(self, words: list[str]) -> None:
        """A mark after letters (still letters when normalised) is a pre-token of its
        own: it is put after the ids of its letters.  Simple chunks are encoded joined by blanks and told apart by
        their word ends."""
        marked = {w: w[:-1] for w in words if len(w) > 1 and w[-1] in ".,;:!?"
                  and _SIMPLE.fullmatch(unicodedata.normalize("NFC", w).lower())}
        if marked:
            words = list(dict.fromkeys([w for w in words if w not in marked] + [
                x for w, core in marked.items() for x in (core, w[-1]) if x not in self.known]))
        self._encode(words)
        for word, core in marked.items():
            self.known[word] = self.known[core] + self.known[word[-1]]

    def _encode(self, words: list[str]) -> None:
        other = []
        for at in range(0, len(words), 512):
            simple, parts = [], []
            for word in words[at:at + 512]:
                found = _SIMPLE.fullmatch(word)
                if found:
                    simple.append(word)
                    parts.append(1 + bool(found[1]))
                else:
                    other.append(word)
            if not simple:
                continue
            ids = self._ids([" ".join(simple)])[0]
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != sum(parts) or len(ids) != stops[-1]:
                other += simple                     # some chunk is not what it seems
                continue
            at_end = stops[np.cumsum(parts) - 1]
            for word, a, b in zip(simple, [0, *at_end[:-1].tolist()], at_end.tolist(), strict=True):
                self.known[word] = ids[a:b].tobytes()
        for word, ids in zip(other, self._ids(other), strict=True) if other else ():
            self.known[word] = ids.tobytes()

    def chunks(self, text: str, size: int = 1 << 18):
        """Little-endian ids of consecutive parts of the text, cut at blanks."""
        start = 0
        while start < len(text):
            end = len(text) if len(text) - start <= size else text.find(" ", start + size)
            end = len(text) if end < 0 else end
            part = text[start:end]
            # small letters come first anyway, but for the special strings
            words = part.encode().translate(_BLANKS if "<|" in part else _PLAIN).decode().split(" ")
            if len(self.known) > self.limit:
                self.known = {"": b""}
            missing = set(words).difference(self.known)
            if missing:
                self._learn(list(missing))
            yield b"".join(map(self.known.__getitem__, words))
            start = end


def worker_encoder(path: str) -> WordEncoder:
    """One encoder per worker process: what one task has learnt serves the next.
    It only saves time; a new worker starts with an empty memory."""
    state = sys.modules.setdefault("_shelfwise_worker", types.ModuleType("_shelfwise_worker"))
    encoders = state.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = WordEncoder(path)
    return encoders[path]


def encode_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 [, ids], plus the
    source partition ``part`` and the piece's rank ``nth`` among the pieces of
    its length in that partition."""
    fields = [f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}",
              "piece int, start long, length long, ids_crc32 long, part long, nth long"]
    if keep_ids:
        fields.append("ids binary")

    def run(batches):
        encoder, part, seen = worker_encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        for batch in batches:
            out = [[] for _ in range(8)]

            def emit(doc, piece, start, ids):
                length = len(ids) // 4
                nth = seen[length] = seen.get(length, -1) + 1
                for column, value in zip(out, (doc, piece, start, length, zlib.crc32(ids), part, nth, ids),
                                         strict=True):
                    column.append(value)

            for row in range(batch.num_rows):
                doc, text = batch.column(0)[row].as_py(), batch.column(1)[row].as_py() or ""
                held, piece = b"", 0
                for more in encoder.chunks(text):
                    held += more
                    while len(held) > 4 * capacity:       # a full piece only once something follows it
                        emit(doc, piece, piece * capacity, held[:4 * capacity])
                        held, piece = held[4 * capacity:], piece + 1
                held += np.uint32(end_id).astype("<u4").tobytes()
                while held:
                    emit(doc, piece, piece * capacity, held[:4 * capacity])
                    held, piece = held[4 * capacity:], piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in out[2:7]], *([pa.array(out[7], pa.binary())] if keep_ids else [])],
                names=[id_col, "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if keep_ids else [])])

    return docs.select(id_col, text_col).mapInArrow(run, ", ".join(fields))


# ------------------------------------------------------------------ minimum bin slack
@dataclass
class Pattern:
    items: list[tuple[int, int]]     # (length, how often in one bin), in placing order
    bins: int


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """The combination of (length, count) pairs, lengths descending, with the
    largest sum up to ``room``.  Bit s of ``reach`` says that sum s is possible."""
    mask, reach, stages = (1 << (room + 1)) - 1, 1, []
    for length, count in available:
        if length > room:
            continue
        stages.append((length, reach))
        left, step = min(count, room // length), 1
        while left:                                  # multiples by doubling
            take = min(step, left)
            reach |= (reach << (length * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(stages):
        n = 0
        while not before >> total & 1:
            total, n = total - length, n + 1
        if n:
            chosen[length] = n
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Bin patterns that use every length of the histogram exactly as often as it occurs."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    if counts and max(counts) > capacity:
        raise ValueError("a length exceeds the capacity")
    order, patterns = sorted(counts, reverse=True), []
    while order:
        seed = order[0]
        counts[seed] -= 1
        chosen = fullest([(x, counts[x]) for x in order if counts[x]], capacity - seed)
        counts[seed] += 1
        chosen[seed] = chosen.get(seed, 0) + 1
        bins = min(counts[x] // n for x, n in chosen.items())
        for length, n in chosen.items():
            counts[length] -= n * bins
        patterns.append(Pattern(sorted(chosen.items(), reverse=True), bins))
        if any(not counts[x] for x in chosen):
            order = [x for x in order if counts[x]]
    return patterns


def placement_table(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, bins, first sequence, offset) sorted by rank."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for p in patterns:
        offset = 0
        for length, n in p.items:
            first = used.get(length, 0)
            rows.setdefault(length, []).append((first, p.bins, sequence, offset))
            used[length] = first + n * p.bins
            offset += n * length
        sequence += p.bins
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (columns length, part, nth).

    The driver holds the length histogram (at most ``capacity`` counts) and the
    patterns made from it; neither grows with the corpus.  Equal lengths are
    interchangeable and are dealt out in the order of their ranks.
    """
    spark = pieces.sparkSession
    if any(not 1 <= r["length"] <= capacity for r in pieces.select("length").where(
            ~F.col("length").between(1, capacity)).limit(1).collect()):
        raise ValueError("piece lengths must be between 1 and the capacity")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(placement_table(minimum_bin_slack(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before")).select(
        *pieces.columns)

    def place(batches):
        table = places.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("nth")).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, firsts = np.unique(length[order], return_index=True)
            for value, at in zip(values.tolist(), np.split(order, firsts[1:]), strict=True):
                rows = table[value]
                pick = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                copy, which = np.divmod(rank[at] - pick[:, 0], pick[:, 1])
                sequence[at], offset[at] = pick[:, 2] + which, pick[:, 3] + copy * value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long").drop("part", "nth")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 4096, end_id: int = 1, keep_ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` and pack all pieces into sequences of at most ``capacity`` ids.

    Per piece: the id column, piece (from 0), start, length, ids_crc32,
    [ids,] sequence_id, offset (gapless from 0 in its sequence).  A document is
    its ids and then ``end_id``; only longer ones are cut.  Null and empty
    texts are one piece of one id.  Repeated rows are packed again, other
    columns are ignored, an empty table gives no rows.
    """
    pieces = stage(encode_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, keep_ids), "pack-pieces")
    return pack(pieces, capacity)
