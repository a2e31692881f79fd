"""N-gram Jaccard join by set-relation skipping.

Documents become sets of word n-gram hashes; equal sets are one set.  In a
global order of the hashes similar sets must share one in their prefixes.  The
order starts with a class of hashes about twice as large as the prefixes, rare
ones first; only that class is counted over the corpus.  The sets that share a
prefix hash go through the same once more with all their hashes counted.  Two relations between sets save work on the index lists:

* positions: a list is stored in blocks of equal position (and component); a
  pair of blocks is skipped when the hashes left behind that position cannot
  make up the overlap that the sizes need;
* answers: sets that share their commonest or rarest listed hash are compared
  first, each with a leader; a leader's members are answered from its overlap and their few
  differences from it.  Sets that this links already are never compared again:
  the lists only look for links between different components, and take a pair that
  has met in a list before as answered.

No pair inside a component is formed, so a large group of near copies costs
about its size.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import HashCache, ascii_words, bounded_broadcast, stage
from shelfwise.llm.graph import components

_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SEGMENT = 2048                  # sets compared in one task group
RECENT = 16                     # listed hashes before its own that a posting carries
DELEGATES = 32                  # sets of a component that go on to the next round of segments


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes (int64, ascending) of all runs of ``size`` words; of the
    whole sequence when it is shorter; none without words."""
    if not len(words):
        return np.empty(0, np.int64)
    width = min(size, len(words))
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        mixed = mixed * _K1 + words[k:len(words) - width + 1 + k]
    return np.unique(_finish(mixed + np.uint64(width)).view(np.int64))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _sets(size: int, percent: int, whole: bool):
    """Arrow rows (doc_id, text) -> (doc_id, n, fp, low, spill) or (fp, hashes)."""

    def run(batches):
        cache = HashCache()
        for batch in batches:
            ns, fps, first, second = [], [], [], []
            for r in range(batch.num_rows):
                s = shingle_set(cache.of(ascii_words(batch.column(1)[r].as_py())), size)
                ns.append(len(s))
                fps.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                if whole:
                    first.append(s)
                    continue
                chosen = (s.view(np.uint64) >> np.uint64(32)) % np.uint64(100) < np.uint64(2 * (100 - percent))
                low = s[chosen]
                first.append(low)
                second.append(s[~chosen][:max(0, prefix_size(len(s), percent) - len(low))])
            kind = pa.list_(pa.int64())
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.string()), pa.array(first, kind)], ["fp", "hashes"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ns, pa.int64()), pa.array(fps, pa.string()), pa.array(first, kind),
                     pa.array(second, kind)], ["doc_id", "n", "fp", "low", "spill"])
    return run


def _linked(i: int, n: int, m: int, percent: int) -> bool:
    return 100 * i >= percent * (n + m - i)


def link_segment(sids, sets, percent: int) -> list[tuple[int, int]]:
    """Links that span the components of one segment.

    A set is compared with the leaders of components that it has not joined yet;
    from its overlap with a leader its overlap with each member follows by the
    member's differences from that leader.
    """
    edges, leaders, root = [], [], []

    def top(g: int) -> int:
        while root[g] != g:
            g = root[g]
        return g

    for k in np.argsort([len(s) for s in sets], kind="stable").tolist():
        x, n, sid, home, joined = sets[k], len(sets[k]), int(sids[k]), None, set()
        for g in range(len(leaders) - 1, -1, -1):
            leader, head, members = leaders[g]
            if top(g) in joined or 100 * min(n, len(head)) < (2 * percent - 100) * max(n, len(head)):
                continue
            common = int(np.isin(x, head, assume_unique=True).sum())
            if _linked(common, n, len(head), percent):
                edges.append((sid, leader))
                joined.add(top(g))
                if home is None:
                    home = g
                    members.append((sid, n, np.setdiff1d(head, x, True), np.setdiff1d(x, head, True)))
                continue
            for other, m, minus, plus in members:
                if not _linked(min(n, m, common + len(plus)), n, m, percent):
                    continue
                both = common - int(np.isin(minus, x, True).sum()) + int(np.isin(plus, x, True).sum())
                if _linked(both, n, m, percent):
                    edges.append((sid, other))
                    joined.add(top(g))
                    break
        if home is None:
            home = len(leaders)
            leaders.append((sid, x, []))
            root.append(home)
        for g in joined:
            root[g] = top(home)
    return edges


def _postings(rows: DataFrame, percent: int) -> DataFrame:
    """(h, sid, n, pos): the prefix hashes that at least two rows (sid, n, low,
    spill) hold.  Hashes order by (class, frequency, hash); the frequencies are
    those among ``rows``, and hashes of one row only come first."""
    tokens = rows.select("sid", F.posexplode(F.concat("low", "spill")).alias("k", "h"), F.size("low").alias("c0"))
    tokens = tokens.select("sid", "h", (F.col("k") >= F.col("c0")).alias("late"))
    df = tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(df, "h").groupBy("sid").agg(
        F.sort_array(F.collect_list(F.when(~F.col("late"), F.struct("df", "h")))).alias("early"),
        F.collect_list(F.when(F.col("late"), F.col("h"))).alias("late"))
    prefix = F.expr(f"n - ((n * {percent} + 99) div 100) + 1")
    single = F.col("c0") - F.size("early")
    keep = F.greatest(F.lit(0), F.least(F.size("early"), prefix - single)).cast("int")
    listed = (shared.join(rows.select("sid", "n", F.size("low").alias("c0")), "sid")
              .withColumn("single", single).withColumn("keep", keep)
              .withColumn("list", F.concat(
                  F.expr("transform(slice(early, 1, keep), (x, i) -> struct(x.h as h, cast(single + i as long) as pos))"),
                  F.expr("transform(late, x -> struct(x as h, cast(c0 as long) as pos))"))))
    return listed.select("sid", "n", F.explode("list").alias("x")).select("x.h", "sid", "n", "x.pos")


def _in_lists(postings: DataFrame) -> DataFrame:
    """Postings of lists with at least two sets."""
    postings = stage(postings, "postings")
    lists = postings.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    return stage(postings.join(lists.select("h"), "h", "left_semi"), "postings")


def _segment_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside segments of (sid, h1, seg) groups."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(link_segment(frame["sid"].to_numpy(), frame["hashes"].tolist(), percent),
                            columns=["u", "v"], dtype="int64")

    return members.join(sets, "sid").groupBy("h1", "seg").applyInPandas(run, "u long, v long")


def _first_links(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets that share the commonest, then the rarest of their listed
    hashes.  Larger groups are cut into segments; some sets of each component go
    on until a group is one segment or too little joins."""
    found: list[DataFrame] = []
    for pick in (F.max, F.min):
        first = postings.groupBy("sid").agg(pick(F.struct("pos", "h")).alias("x")).select("sid", F.col("x.h").alias("h1"))
        members = first if not found else _delegates(first, reduce(DataFrame.union, found))
        while members is not None:
            members = stage(members, "first")
            sizes = members.groupBy("h1").agg(F.count("*").alias("c")).where("c > 1")
            cut = members.join(sizes, "h1").withColumn(
                "seg", F.pmod(F.xxhash64("sid", F.lit(len(found))), F.ceil(F.col("c") / SEGMENT)))
            found.append(stage(_segment_links(cut.select("sid", "h1", "seg"), sets, percent), "segment-links"))
            large = stage(members.join(sizes.where(F.col("c") > SEGMENT).select("h1"), "h1", "left_semi"), "large")
            before = large.count()
            members = None
            if before:
                merged = stage(_delegates(large, reduce(DataFrame.union, found)), "merged")
                # no family when few join: the lists look at the rest
                members = merged if merged.count() <= before // 4 else None
    return reduce(DataFrame.union, found)


def _delegates(members: DataFrame, links: DataFrame) -> DataFrame:
    """A few sets of each component from every (sid, h1) group."""
    order = Window.partitionBy("h1", "c", "part").orderBy("sid")
    named = (members.join(components(links).withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("c", F.coalesce("root", "sid")).withColumn("part", F.pmod(F.xxhash64("sid"), F.lit(DELEGATES))))
    return named.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("sid", "h1")


def _list_pairs(postings: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets of different components that the index lists cannot rule out.

    Similar sets meet in most of their lists.  Each posting carries the RECENT
    listed hashes before it; a pair that shares one of them has met there already
    and is passed over.  Its first common hash has none before it, so every pair is
    put together there, unless the positions at that very hash rule it out.
    """
    named = (postings.join(roots.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("root", F.coalesce("root", "sid")))
    lists = (named.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("c"))
             .where("r0 < r1").select("h", F.ceil(F.col("c") / 2048).alias("salts")))
    recent = (named.join(lists, "h").groupBy("sid", "root", "n")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "h", "salts"))).alias("l"))
              .select("sid", "root", "n", F.expr(
                  f"explode(transform(l, (x, i) -> struct(x.h as h, x.pos as pos, x.salts as salts, "
                  f"slice(l.h, greatest(1, i - {RECENT - 1}), least(i, {RECENT})) as before)))").alias("x"))
              .select("sid", "root", "n", "x.*"))
    blocks = (recent.groupBy("h", "root", "pos", F.pmod(F.xxhash64("sid"), "salts").alias("salt"))
              .agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                   F.collect_list(F.struct("n", "sid", "before")).alias("sets")))
    a, b = blocks.alias("a"), blocks.alias("b")
    sizes_meet = f"100 * a.hi >= {percent} * b.lo and 100 * b.hi >= {percent} * a.lo"
    enough_left = f"{100 + percent} * least(a.hi - a.pos, b.hi - b.pos) >= {percent} * (a.lo + b.lo)"
    fits = (f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {100 + percent} * "
            f"least(x.n - a.pos, y.n - b.pos) >= {percent} * (x.n + y.n) and not arrays_overlap(x.before, y.before)")
    met = a.join(b, F.expr(f"a.h = b.h and a.root < b.root and {sizes_meet} and {enough_left} and "
                           f"exists(a.sets, x -> exists(b.sets, y -> {fits}))"))
    near = F.expr(f"explode(flatten(transform(a.sets, x -> transform(filter(b.sets, y -> {fits}), "
                  "y -> struct(x.sid as a, y.sid as b)))))")
    return met.select(near.alias("p")).select("p.*").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x"))
    y = sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(x, "a").join(y, "b").withColumn("i", F.size(F.array_intersect("x", "y")))
    return both.where(f"100 * i >= {percent} * (size(x) + size(y) - i)").select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of
    their sets of ``size``-word shingles (A-Z lower-cased words between ASCII
    blanks).  component_id is the smallest doc_id reachable by links.  Without
    words a set is empty and links with nothing; equal sets always link.
    Repeated rows and ids are documents of their own, a component whose ids are
    all null has a null id, other columns are ignored, an empty table gives no
    rows.  Shingles are compared by 64-bit hashes.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stage(texts.mapInArrow(_sets(size, percent, False),
                                  "doc_id long, n long, fp string, low array<long>, spill array<long>")
                 .withColumn("sid", F.monotonically_increasing_id()), "sets")
    reps = rows.where("n > 0").groupBy("fp").agg(F.min("sid").alias("sid"))
    postings = _in_lists(_postings(rows, percent).join(reps, "sid", "left_semi"))

    wanted = stage(postings.select("sid").distinct().join(rows.select("sid", "doc_id", "fp"), "sid"), "wanted")
    ids = bounded_broadcast(wanted, wanted.select(F.col("doc_id").alias("id")).distinct())
    near = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = stage(near.mapInArrow(_sets(size, percent, True), "fp string, hashes array<long>")
                 .join(bounded_broadcast(wanted, wanted.select("fp", "sid")), "fp").dropDuplicates(["sid"])
                 .select("sid", "hashes"), "near-sets")

    # the sets that are left, in the order of all their hashes: far fewer share a prefix
    left = sets.select("sid", F.size("hashes").cast("long").alias("n"), F.col("hashes").alias("low"),
                       F.array().cast("array<long>").alias("spill"))
    postings = _in_lists(_postings(left, percent))

    links = _first_links(postings, sets, percent)
    roots = stage(components(links), "roots")
    pairs = stage(_list_pairs(postings, roots, percent), "pairs")
    more = stage(_verified(pairs, sets, percent), "links")
    # from the stars found so far, which are already short, and the links between them
    roots = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))

    reps = rows.where("n > 0").groupBy("fp").agg(F.min("sid").alias("node"), F.min("doc_id").alias("first"))
    named = stage(reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_set = named.join(least, "root").select("fp", "component_id")
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), "fp").join(by_set, "fp", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
                    .alias("component_id")))
