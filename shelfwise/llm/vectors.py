"""Embedding near-dedup by iterative quantisation.

Rotations are learnt that turn centred vectors into balanced binary codes;
the codes are cut into substrings, one hash table each (multi-index Hamming
tables); vectors that share a substring are compared by their exact cosine.
Equal vectors are one vector with a weight.  A large bucket is cut into blocks
that are compared two at a time, and a block pair reports counts and a spanning
set of links, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import n_partitions, stage
from shelfwise.llm.graph import components

BLOCK = 1024


def learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 40) -> np.ndarray:
    """Projection onto principal directions, rotated so that signs lose least."""
    _, axes = np.linalg.eigh(x.T @ x)
    z = x @ axes
    r, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(z @ r >= 0, 1.0, -1.0).T @ z)
        r = (u @ vt).T
    return axes @ r


def plan_tables(largest: int, cosine: float, recall: float) -> tuple[int, int]:
    """(bits of a substring, tables): substrings about as long as log2 of the
    vectors that are compared, and as many as a pair at the threshold needs to
    agree on one with the wanted probability."""
    bits = min(24, max(8, math.ceil(math.log2(max(2, largest)))))
    flip = 1.15 * math.acos(cosine) / math.pi        # centring widens angles somewhat
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - (1 - flip) ** bits))


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max()
    return scaled / np.sqrt((scaled * scaled).sum())


def _usable(values) -> np.ndarray | None:
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.array(values, dtype=np.float64)
    return x if np.isfinite(x).all() and np.abs(x).max() > 0 else None


def identified(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, gid, vec): gid names the label and the vector, null where
    the row links with nothing; vec holds the float64 components."""

    def run(batches):
        for batch in batches:
            gids, vecs = [], []
            for r in range(batch.num_rows):
                label, x = batch.column(1)[r].as_py(), _usable(batch.column(2)[r].as_py())
                ok = label is not None and x is not None
                vecs.append((x + 0.0).tobytes() if ok else None)      # no negative zeros
                gids.append(xxhash.xxh3_128_hexdigest(f"{label}:".encode() + vecs[-1]) if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gids, pa.string()),
                                              pa.array(vecs, pa.binary())], ["vec_id", "label", "gid", "vec"])

    data = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          "embedding")
    return data.mapInArrow(run, "vec_id long, label string, gid string, vec binary")


def _coder(sample: list[bytes], bits: int, tables: int, seed: int):
    """Function from vectors of one length to their substrings (rows x tables)."""
    by_size: dict[int, list[np.ndarray]] = {}
    for raw in sample:
        x = _unit(np.frombuffer(raw))
        by_size.setdefault(len(x), []).append(x)
    fitted = {}
    for size, rows in by_size.items():
        x, rng = np.array(rows), np.random.default_rng(seed)
        mean = x.mean(0)
        fitted[size] = mean, np.hstack([learn_rotation(x - mean, rng) for _ in range(-(-bits * tables // size))])

    def codes(x: np.ndarray) -> np.ndarray:
        size = x.shape[1]
        if size not in fitted:                       # a length that the sample lacks: random rotations
            rng = np.random.default_rng([seed, size])
            fitted[size] = np.zeros(size), np.hstack(
                [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-bits * tables // size))])
        mean, axes = fitted[size]
        ones = ((x - mean) @ axes >= 0)[:, :bits * tables].reshape(len(x), tables, bits)
        return (ones * (1 << np.arange(bits))).sum(2).astype(np.int32)
    return codes


def _entries(groups: DataFrame, codes) -> DataFrame:
    """One row per vector and table: (label, size, tab, key, node, w, subs, vec)."""

    def run(batches):
        for batch in batches:
            raw = batch.column(2).to_pylist()
            rows = [_unit(np.frombuffer(v)) for v in raw]
            subs = [None] * len(rows)
            for size in {len(x) for x in rows}:
                at = [k for k, x in enumerate(rows) if len(x) == size]
                for k, s in zip(at, codes(np.array([rows[k] for k in at])), strict=True):
                    subs[k] = s
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(x) for x in rows], pa.int32()),
                     pa.array([s.tolist() for s in subs], pa.list_(pa.int32())), batch.column(2), batch.column(3)],
                    ["node", "label", "size", "subs", "vec", "w"])

    coded = groups.select("node", "label", "vec", "w").mapInArrow(
        run, "node long, label string, size int, subs array<int>, vec binary, w long")
    return coded.select("*", F.posexplode("subs").alias("tab", "key"))


def _pairs(same: np.ndarray, sizes: np.ndarray):
    """Index pairs inside runs of equal ``same``: chunks of (left, right)."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for start, size in zip(starts[sizes > 32].tolist(), sizes[sizes > 32].tolist(), strict=True):
        for low in range(0, size, 256):              # a large run by strips
            left, right = np.nonzero(np.arange(low, min(size, low + 256))[:, None] < np.arange(size))
            yield start + low + left, start + right
    small = np.repeat(sizes <= 32, sizes)
    for step in range(1, 32):
        left = np.flatnonzero((same[:-step] == same[step:]) & small[:-step]) if len(same) > step else np.empty(0, int)
        if not len(left):
            break
        yield left, left + step


def _links(cosine: float):
    """Sorted entries -> (node, other, n): weights of direct links found first in
    this table (other null), and links that span what was found (n null)."""

    def compare(run, tab, own, cross, node, w, subs, vecs):
        x = np.array([_unit(np.frombuffer(v)) for v in vecs])
        sizes = np.diff(np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]])))
        counts, seen = np.zeros(len(node), np.int64), []
        for left, right in _pairs(run, sizes):
            ok = ~cross[left] | (own[left] != own[right])
            left, right = left[ok], right[ok]
            for at in range(0, len(left), 1 << 16):
                a, b = left[at:at + (1 << 16)], right[at:at + (1 << 16)]
                hit = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                a, b = a[hit], b[hit]
                earlier = np.arange(subs.shape[1]) < tab[a][:, None]
                first = ~((subs[a] == subs[b]) & earlier).any(1)
                a, b = a[first], b[first]
                np.add.at(counts, a, w[b])
                np.add.at(counts, b, w[a])
                seen.append((a, b))
        root = np.arange(len(node))
        if seen:
            a, b = (np.concatenate(c) for c in zip(*seen, strict=True))
            while True:                              # smallest index over the links, until it stays
                low = np.minimum(root[a], root[b])
                if (root[a] == low).all() and (root[b] == low).all():
                    break
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
        return counts, root

    def run(batches):
        held = None
        names = ["node", "other", "n"]

        def out(t: pa.Table):
            if not t.num_rows:
                return
            size = t["size"].to_numpy()
            for value in np.unique(size):
                part = t.filter(pa.array(size == value))
                number = {n: part[n].to_numpy() for n in ("run", "tab", "own", "node", "w")}
                subs = np.array(part["subs"].to_pylist(), np.int32)
                counts, root = compare(number["run"], number["tab"], number["own"],
                                       part["cross"].to_numpy(zero_copy_only=False).astype(bool), number["node"],
                                       number["w"], subs, part["vec"].to_pylist())
                some, moved = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(root)))
                node = np.concatenate([number["node"][some], number["node"][moved]])
                other = np.concatenate([np.full(len(some), -1), number["node"][root[moved]]])
                n = np.concatenate([counts[some], np.zeros(len(moved), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(n)], names)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            runs = t["run"].to_numpy()
            last = int(np.searchsorted(runs == runs[-1], True)) if len(runs) else 0
            held = t.slice(last)                     # the last run may go on in the next batch
            yield from out(t.slice(0, last))
        if held is not None:
            yield from out(held)
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.98, recall: float = 0.97, sample_rows: int = 20_000,
                 seed: int = 7) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id, kept.

    Rows are compared when their labels are equal and not null, and link when
    their cosine (float64) is at least ``cosine``; null or zero vectors and those
    with null or non-finite components link with nothing, vectors of different
    lengths never link.  The rotations are fitted on at most ``sample_rows``
    vectors (those with the smallest hash); every vector is indexed.  Links found
    are exact; the tables are planned to find at least ``recall`` of those at the
    threshold itself and more of the closer ones.  Repeated rows are rows of
    their own; a component whose ids are all null has a null id; other columns
    are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stage(identified(vectors), "vectors")
    groups = stage(rows.where("gid is not null").groupBy("gid")
                   .agg(F.min("vec_id").alias("first"), F.count("*").alias("w"), F.min("label").alias("label"),
                        F.min("vec").alias("vec")).withColumn("node", F.monotonically_increasing_id()), "vector-groups")
    largest = groups.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = plan_tables(largest, cosine, recall)
    sample = [r["vec"] for r in groups.select("vec", F.xxhash64("gid").alias("o")).orderBy("o").limit(
        sample_rows).select("vec").collect()]
    entries = _entries(groups, _coder(sample, bits, tables, seed))
    bucket = ["label", "size", "tab", "key"]
    # sizes from the codes alone; buckets of one vector need no vectors at all
    sizes = stage(entries.groupBy(*bucket).agg(F.count("*").alias("c")).where("c > 1")
                  .select(*bucket, F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks"),
                          F.monotonically_increasing_id().alias("bucket")), "buckets")
    cut = (entries.join(sizes, bucket).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumn("lo", F.least("own", "j")).withColumn("hi", F.greatest("own", "j"))
           .withColumn("cross", F.col("lo") < F.col("hi"))
           .withColumn("run", F.xxhash64("bucket", "lo", "hi")))
    found = stage(cut.select("run", "size", "tab", "own", "cross", "node", "w", "subs", "vec")
                  .repartition(n_partitions(spark), "run").sortWithinPartitions("run")
                  .mapInArrow(_links(cosine), "node long, other long, n long"), "vector-links")
    direct = found.where("other < 0").groupBy("node").agg(F.sum("n").alias("near"))
    roots = components(found.where("other >= 0").select(F.col("node").alias("u"), F.col("other").alias("v")))
    named = stage(groups.select("gid", "first", "w", "node").join(direct, "node", "left").join(roots, "node", "left")
                  .withColumn("root", F.coalesce("root", "node")), "vector-roots")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    by_group = named.join(least, "root").select("gid", "component",
                                                (F.col("w") - 1 + F.coalesce("near", F.lit(0))).alias("links"))
    component = F.when(F.col("gid").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return (rows.select("vec_id", "gid").join(by_group, "gid", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
