import hashlib
import random
import re

import pytest

from shelfwise.llm import phrases
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE, ordered, rows_of, texts_of


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(rows, items, size):
    windows = {}
    for item, text in items:
        words = split(text)
        for k in range(max(1, len(words) - size + 1)) if words else ():
            windows.setdefault(tuple(words[k:k + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words, hit, found = split(text), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k:k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return ordered(out)


def contract(df):
    return ordered(r[:6] for r in rows_of(df))


def near_windows(text, items, size, slop):
    """Windows that occur with every word at most ``slop`` off, but not exactly; word by word."""
    words, out = split(text), set()
    places = {}
    for k, w in enumerate(words):
        places.setdefault(w, []).append(k)
    for _, item in items:
        of = split(item)
        for k in range(max(1, len(of) - size + 1)) if of else ():
            window = tuple(of[k:k + size])
            tries = {p - i + d for i, w in enumerate(window) for p in places.get(w, ()) for d in range(-slop, slop + 1)}
            fits = [s for s in tries if all(any(abs(p - s - i) <= slop for p in places.get(w, ()))
                                            for i, w in enumerate(window))]
            exact = any(words[s:s + len(window)] == list(window) for s in fits if s >= 0)
            if fits and not exact:
                out.add(window)
    return len(out)


ITEMS = [(1, "Gamma, delta! EPSILON"), (22, "gamma delta epsilon"), (3, None), (4, "..."), (5, "one"), (6, "中文 x1c ʼn"),
         (7, "word1 line1 word2 line2 word3 line3"), (8, "kappa alpha"), (9, "text text"), (10, "äö É 中文")]


@pytest.mark.parametrize("size", [2, 3, 13])
def test_hits_of_edge_rows(spark, edge, size):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = phrases.decontaminate(edge, items, size=size)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"]
    assert contract(got) == brute(EDGE, ITEMS, size)


def test_hits_of_whole_documents(spark, documents):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = contract(phrases.decontaminate(documents, items))
    assert rows == brute(texts_of(documents), rows_of(items.select("item_id", "text")), 13)
    assert any(r[-1] for r in rows)


def test_small_segments_change_nothing(spark, edge):
    queries = [(b"gamma", b"delta", b"epsilon"), (b"one",), (b"kappa", b"alpha"), (b"word1", b"line1", b"word2"),
               (b"absent", b"one"), ()]
    for vocabulary, slop in ((None, 0), ({t for w in queries for t in w}, 0), (None, 3)):
        big, small = (phrases.search_index(phrases.build_index(edge, vocabulary=vocabulary, segment_words=n, slop=slop),
                                           queries, slop) for n in (10**6, 5))
        key = lambda rows: ordered((r[0], r[1], sorted(map(tuple, r[2]))) for r in rows)
        assert key(rows_of(big)) == key(rows_of(small))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c"), (2, "a y y y b c"), (3, "c b a")], "doc_id long, text string")
    index = phrases.build_index(docs, slop=1)
    found = {r[0]: len(r[2]) for r in rows_of(phrases.search_index(index, [(b"a", b"b", b"c")], slop=1))}
    assert found[1] > 0 and found[2] == 0
    index = phrases.build_index(docs)
    assert {r[0]: len(r[2]) for r in rows_of(phrases.search_index(index, [(b"a", b"b")]))} == {1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("slop, segment", [(1, 10**6), (2, 40), (3, 10**6)])
def test_near_windows_equal_a_plain_search(spark, slop, segment):
    rng = random.Random(slop)
    word = lambda: "abcdefgh"[int(rng.random() ** 2 * 8)]
    items = [(k, " ".join(word() for _ in range(rng.randint(1, 9)))) for k in range(12)]
    docs = [(k, " ".join(word() for _ in range(rng.randint(0, 60)))) for k in range(40)]
    for k, (_, text) in enumerate(items):       # an item with a word too many or one that is lost
        parts = text.split()
        docs += [(100 + k, " ".join([*parts[:2], "new", *parts[2:]])), (200 + k, " ".join(parts[:1] + parts[2:]))]
    got = phrases.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), size=5, slop=slop,
                                segment_words=segment)
    assert contract(got) == brute(docs, items, 5)
    near = {r["doc_id"]: r["n_near"] for r in got.collect()}
    assert near == {i: near_windows(t, items, 5, slop) for i, t in docs} and any(near.values())


def test_a_word_put_in_or_lost_is_near(spark):
    item = " ".join(f"term{k}" for k in range(13))
    words = item.split()
    docs = [(1, item), (2, " ".join([*words[:6], "so", *words[6:]])), (3, " ".join(words[:6] + words[7:] + ["on"])),
            (4, " ".join(reversed(words)))]
    got = phrases.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {r["doc_id"]: (r["n_hit"], r["n_near"]) for r in got.collect()} == {1: (13, 0), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


def test_empty_tables(spark, edge, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert all(r[2:] == (0, 0, hashlib.sha256(b"").hexdigest(), False, 0)
               for r in rows_of(phrases.decontaminate(edge, items)))
    many = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert phrases.decontaminate(nothing, many).count() == 0


def test_any_number_of_items(spark, edge):
    """Many items, few windows held at a time, and an index of all terms."""
    fill = [(1000 + k, f"filler{k} text{k}") for k in range(50_001)]
    many = spark.createDataFrame(ITEMS + fill, "item_id long, text string")
    assert contract(phrases.decontaminate(edge, many, size=3)) == brute(EDGE, ITEMS + fill, 3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for size in (2, 13):
        got = phrases.decontaminate(edge, items, size=size, vocabulary_bytes=150, segment_words=50)
        assert contract(got) == brute(EDGE, ITEMS, size)


def test_the_index_is_read_once_for_any_test_set(spark, edge):
    """The search is one shuffle of segments and windows, no loop over blocks."""
    got = phrases.decontaminate(edge, spark.createDataFrame(ITEMS, "item_id long, text string"), size=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_windows_of_a_long_item_and_of_many_items(spark):
    long = " ".join(f"w{k}" for k in range(20_100))
    items = spark.createDataFrame([(1, long), *((k, "a b c") for k in range(2, 30))], "item_id long, text string")
    rows = rows_of(phrases.window_table(items, 13, slice_items=10))
    assert len({bytes(w) for w, _ in rows}) == 20_089 and len(rows) == 20_088 + 3
    assert {i for w, o in rows if bytes(w) == b"a b c" for i in o} == {str(k) for k in range(2, 30)}
