"""Vector code compression: part codebooks searched through value dictionaries.

Vectors become integers and are cut into blocks.  A block keeps, for each
dimension, the distinct integers that occur in it and one small code per
vector.  To assign a block's parts, the squared differences of every distinct
integer to all codebook entries are tabulated once per dimension; the distance
of a part is then a gather by code and an add per dimension.  The same codes
give the sums for new entries: how often each value met each entry, times the
value.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import stage


def _narrow(values: np.ndarray, terms: int) -> np.ndarray:
    """``values`` in the smallest integers in which ``terms`` squared differences
    of two such values add up exactly; Python's integers beyond 64 bits."""
    largest = max((abs(int(values.max())), abs(int(values.min())))) if values.size else 0
    worst = terms * (2 * largest) ** 2
    return values.astype(np.int32 if worst < 1 << 31 else np.int64 if worst < 1 << 63 else object)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite float64 values, exact at every size (scale a power of two)."""
    big = np.abs(x) >= 2.0 ** 40
    if not big.any():
        return np.floor(x * scale).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 2.0 ** 53 else math.floor(int(v) * scale + (v - int(v)) * scale)
                     for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def part_bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts, equal where ``parts`` divides ``dim``."""
    return [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]


@dataclass
class Codebooks:
    """``entries[p][e]``: the integers of entry e of part p."""
    dim: int
    scale: int
    entries: list[list[list[int]]]

    @property
    def sha256(self) -> str:
        every = (str(v) for part in self.entries for entry in part for v in entry)
        return hashlib.sha256(",".join(every).encode()).hexdigest()

    def decode(self, codes) -> list[float]:
        """The vector that the codes of one row stand for."""
        return [v / self.scale for part, c in zip(self.entries, codes, strict=True) for v in part[c]]


@dataclass
class _Block:
    values: list[np.ndarray]        # per dimension: its distinct integers
    codes: np.ndarray               # vectors x dimensions: positions in them

    @classmethod
    def read(cls, dictionary: str, codes: bytes, rows: int) -> _Block:
        # Python integers here; assign() narrows them
        values = [np.array(v, dtype=object) for v in json.loads(dictionary)]
        return cls(values, np.frombuffer(codes, np.uint16).reshape(rows, len(values)))

    def assign(self, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries (vectors x parts; ties to the lower index) and squared distances over all parts."""
        bounds = part_bounds(books.dim, len(books.entries))
        every = np.concatenate([*self.values, *[np.array(sum(p, []), dtype=object) for p in books.entries]])
        kind = _narrow(every, max(1, books.dim)).dtype
        rows = len(self.codes)
        chosen, error = np.zeros((rows, len(bounds)), np.int64), np.zeros(rows, kind)
        for p, (lo, hi) in enumerate(bounds):
            if lo == hi:
                continue
            book = np.array(books.entries[p], dtype=object).astype(kind)
            total = 0
            for d in range(lo, hi):
                table = (self.values[d].astype(kind)[:, None] - book[:, d - lo][None, :]) ** 2
                total = total + table[self.codes[:, d]]
            chosen[:, p] = total.argmin(axis=1)
            error = error + np.take_along_axis(total, chosen[:, p:p + 1], axis=1)[:, 0]
        return chosen, error

    def sums(self, chosen: np.ndarray, books: Codebooks) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per part: members of each entry, and the exact sums of their components."""
        out = []
        for p, (lo, hi) in enumerate(part_bounds(books.dim, len(books.entries))):
            size = len(books.entries[p])
            members = np.bincount(chosen[:, p], minlength=size).astype(object)
            sums = np.zeros((size, hi - lo), dtype=object)
            for d in range(lo, hi):
                n = len(self.values[d])
                met = np.bincount(chosen[:, p] * n + self.codes[:, d], minlength=size * n).reshape(size, n)
                sums[:, d - lo] = met.astype(object) @ self.values[d]
            out.append((members, sums))
        return out


_BLOCK = "ids {ids}, labels {labels}, dictionary string, codes binary"


def _cut(dim: int, scale: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                piece = batch.slice(at, block_rows)
                ids, labels, vec = (piece.column(i) for i in range(3))
                x = integers(vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                             .reshape(piece.num_rows, dim), scale)
                found = [np.unique(x[:, d], return_inverse=True) for d in range(x.shape[1])]
                dictionary = json.dumps([[int(v) for v in values] for values, _ in found])
                codes = np.stack([inverse.ravel() for _, inverse in found], axis=1).astype(np.uint16) if found \
                    else np.zeros((piece.num_rows, 0), np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), a) for a in (ids, labels)]
                    + [pa.array([dictionary]), pa.array([codes.tobytes()], pa.binary())],
                    names=["ids", "labels", "dictionary", "codes"])
    return run


def _read(batch: pa.RecordBatch) -> Iterator[tuple[list, list, _Block]]:
    for row in batch.to_pylist():
        yield row["ids"], row["labels"], _Block.read(row["dictionary"], row["codes"], len(row["ids"]))


def _partial(books: Codebooks):
    """One row per part and entry of a task: members and the sums of their components."""
    def run(batches):
        total = None
        for batch in batches:
            for _, _, block in _read(batch):
                own = block.sums(block.assign(books)[0], books)
                total = own if total is None else [(n + m, s + t) for (n, s), (m, t) in zip(total, own, strict=True)]
        rows = [(p, e, int(members[e]), [str(v) for v in sums[e]]) for p, (members, sums) in enumerate(total or [])
                for e in range(len(members)) if members[e]]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True),
                                                (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())),
                                                strict=True)], names=["part", "entry", "n", "sums"])
    return run


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """New entry of one (part, entry): floor(sum / count), in integers of any length."""
    count = int(rows["n"].sum())
    sums = [sum(map(int, column)) for column in zip(*rows["sums"], strict=True)]
    return pd.DataFrame({"part": rows["part"][:1], "entry": rows["entry"][:1], "means": [[str(s // count) for s in sums]]})


def _encode(books: Codebooks):
    def run(batches):
        for batch in batches:
            for ids, labels, block in _read(batch):
                chosen, error = block.assign(books)
                fits = [int(e) if e < 1 << 63 else None for e in error.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field("ids").type.value_type),
                     pa.array(labels, batch.schema.field("labels").type.value_type),
                     pa.array(chosen.tolist(), pa.list_(pa.int32())), pa.array(fits, pa.int64())],
                    names=["vec_id", "label", "codes", "error"])
    return run


def compress(vectors: DataFrame, vec_col: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2,
             scale: int = 256, block_rows: int = 2048) -> tuple[DataFrame, Codebooks | None]:
    """(codes, codebooks) of ``vectors`` (vec_id, label and an array of numbers).

    codes: vec_id, label, codes (one entry number per part) and error, the exact
    squared distance to the decoded integers.  Rows whose vector is null, holds
    null or non-finite components, or is of another length than the one with the
    smallest vec_id are left out.  The codebooks start as the parts of the
    ``entries`` smallest vec_ids (nulls last; rows that share an id by their
    components), fewer where there are fewer rows, and are refined ``rounds``
    times over all rows.  Distances and sums are exact at every size; an error
    beyond 64 bits is null.  Repeated rows are rows of their own, other columns
    are ignored, an empty table gives no rows and no codebooks.  The driver holds
    the codebooks only (parts x entries x part length integers).
    """
    kept = vectors.select("vec_id", "label", F.col(vec_col).cast("array<double>").alias("vec")).where(
        F.col("vec").isNotNull() & F.coalesce(F.forall("vec", lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False)))
    order = [F.col("vec_id").asc_nulls_last(), "vec"]
    first = kept.orderBy(*order).limit(entries).collect()
    if not first:
        return kept.select("vec_id", "label", F.lit(None).cast("array<int>").alias("codes"),
                           F.lit(0).cast("long").alias("error")), None
    dim = len(first[0]["vec"])
    same = kept.where(F.size("vec") == dim)
    if any(len(r["vec"]) != dim for r in first):
        first = same.orderBy(*order).limit(entries).collect()
    start = integers(np.array([r["vec"] for r in first], dtype=np.float64).reshape(len(first), dim), scale)
    books = Codebooks(dim, scale, [[[int(v) for v in row[lo:hi]] for row in start] for lo, hi in part_bounds(dim, parts)])

    types = [T.ArrayType(kept.schema[c].dataType).simpleString() for c in ("vec_id", "label")]
    blocks = stage(same.mapInArrow(_cut(dim, scale, block_rows),
                                   _BLOCK.format(ids=types[0], labels=types[1])), "vector-blocks")
    for _ in range(rounds):
        means = (blocks.mapInArrow(_partial(books), "part int, entry int, n long, sums array<string>")
                 .groupBy("part", "entry").applyInPandas(_mean, "part int, entry int, means array<string>").collect())
        fresh = [[list(entry) for entry in part] for part in books.entries]
        for r in means:
            fresh[r["part"]][r["entry"]] = [int(v) for v in r["means"]]
        books = Codebooks(dim, scale, fresh)
    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"],
                           T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    return blocks.mapInArrow(_encode(books), schema), books


def compressed_codes(vectors: DataFrame, vec_col: str = "embedding", **options) -> DataFrame:
    """Digest of ``compress``: vec_id, code (two hex digits a part), error,
    label_error (errors summed over equal labels, nulls together; null beyond 64
    bits or if one of them is) and codebooks_sha256."""
    codes, books = compress(vectors, vec_col, **options)
    coded = stage(codes, "vector-codes")
    total = F.sum(F.col("error").cast("decimal(20,0)")).try_cast("long")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(F.count("error") == F.count("*"), total).alias("label_error"))
    code = F.concat_ws("", F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", code.alias("code"), "error", "label_error",
                    F.lit(books.sha256 if books else None).cast("string").alias("codebooks_sha256")))
