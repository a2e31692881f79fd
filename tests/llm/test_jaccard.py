import random
import re

import numpy as np
import pytest

from shelfwise.llm import graph, jaccard
from tests.llm.conftest import EDGE, ordered, rows_of, texts_of


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return ordered((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in
                   enumerate(zip(rows, sets, strict=True)))


def near_copies(seed, families=6, size=12, words=120):
    """Families of edited copies at all similarities around the threshold, and short texts."""
    rng = random.Random(seed)
    rows, shared = [], [f"s{k}" for k in range(25)]
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, words))]
        if rng.random() < 0.5:
            base[3:3] = shared
        for _ in range(size):
            copy = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.06]) else f"x{rng.randrange(9999)}" for w in base]
            rows.append((len(rows) * 3 % 101 + 1000 * (len(rows) % 2), " ".join(copy)))
    rows += [(5000 + k, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 6)))) for k in range(30)]
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 90), (2, 5, 80), (3, 1, 60), (4, 3, 100)])
def test_same_components_as_brute_force(spark, seed, size, percent):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(rows_of(jaccard.jaccard_components(df, size, percent))) == brute(rows, size, percent)


def test_segments_smaller_than_the_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SEGMENT", 3)
    rows = near_copies(9, families=3, size=25, words=60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(rows_of(jaccard.jaccard_components(df, 3, 90))) == brute(rows, 3, 90)


@pytest.mark.parametrize("recent", [1, 16])
def test_lists_alone_find_every_pair(spark, monkeypatch, recent):
    """Without the first links every link has to come from the lists, each pair of sets
    put together in its first common list."""
    monkeypatch.setattr(jaccard, "RECENT", recent)
    monkeypatch.setattr(jaccard, "_first_links", lambda postings, sets, percent: postings.select(
        "sid", "sid").toDF("u", "v").limit(0))
    rows = near_copies(11, families=4, size=14, words=90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ordered(rows_of(jaccard.jaccard_components(df, 5, 80))) == brute(rows, 5, 80)


def test_whole_documents(spark, documents):
    assert ordered(rows_of(jaccard.jaccard_components(documents, 3, 90))) == brute(texts_of(documents), 3, 90)


def test_edge_rows(edge, nothing):
    assert ordered(rows_of(jaccard.jaccard_components(edge, 3, 90))) == brute(EDGE, 3, 90)
    out = jaccard.jaccard_components(nothing)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_link_segment_is_sound_and_joins_a_family():
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 10**9, 200))
    sets = [base] + [np.unique(np.concatenate([np.delete(base, rng.integers(0, 190, 5)), rng.integers(0, 10**9, 5)]))
                     for _ in range(20)]
    edges = jaccard.link_segment(list(range(21)), sets, 90)
    for a, b in edges:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both)
    assert len(edges) == 20


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(1, 2), (2, 3), (3, 1)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(500, 500)]
    rng.shuffle(edges)
    root = {}
    for u, v in edges:
        root.setdefault(u, u), root.setdefault(v, v)
    changed = True
    while changed:
        changed = False
        for u, v in edges:
            low = min(root[u], root[v])
            changed |= root[u] != low or root[v] != low
            root[u] = root[v] = low
    root.pop(500)
    for node in [n for n in root if root[n] == n and list(root.values()).count(n) == 1]:
        root.pop(node)
    got = rows_of(graph.components(spark.createDataFrame(edges, "u long, v long")))
    assert sorted(got) == sorted(root.items())
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0
