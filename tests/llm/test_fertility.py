import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import fertility, queries
from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGE, ordered, rows_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BLANKS = " \t\n\x0b\x0c\r"


def plain_words(text):
    out, word = [], ""
    for c in text + " ":
        if c in BLANKS:
            out += [word] * bool(word)
            word = ""
        else:
            word += c
    return out


def plain_counts(text):
    text = text or ""
    words = plain_words(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if plain_words(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def plain_measures(text, model):
    ids = model.encode(text or "")
    if not ids:
        return 0, 0.0, 0.0, 0.0
    k = min(64, len(ids))
    starts = [*range(0, len(ids) - k, k), len(ids) - k]
    bits = [-sum(c / k * math.log2(c / k) for c in Counter(ids[s:s + k]).values()) for s in starts]
    return (len(ids), sum(map(len, plain_words(text))) / len(ids), sum(map(model.is_byte, ids)) / len(ids),
            sum(bits) / len(bits))


def plain_rules(rows, width=4.0):
    """(doc_id, base counts, failed, kept) with NumPy's quartiles over distinct measures."""
    model, measured = sentencepiece.SentencePieceProcessor(model_file=PIECES), []
    for i, text, lang in rows:
        base, found = plain_counts(text), plain_measures(text, model)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        measured.append((i, base, failed, lang or "script " + fertility.script_of(text or ""), found[0],
                         tuple(float(f"{m:.3f}") for m in found[1:])))
    limits = {}
    for band in {m[3] for m in measured}:
        own = {(m[1][0], m[4], m[5]) for m in measured if m[3] == band and not m[2]}
        for k, name in enumerate(fertility.MEASURES):
            if own:
                low, high = np.percentile([m[2][k] for m in own], [25, 75])
                reach = max(width * (high - low), fertility.LEAST_WIDTH[name])
                limits[band, k] = (low - reach - 1e-9, high + reach + 1e-9)
    return [(i, *base, failed, not failed and all(limits[band, k][0] <= found[k] <= limits[band, k][1] for k in range(3)))
            for i, base, failed, band, _, found in measured]


def test_query_equals_plain_counting(spark):
    rows = rows_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang"))
    got = queries.op13_tokeniser_fertility(spark, SF_SMALL)
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert got.columns[:8] == first
    expected = plain_rules(rows)
    assert ordered(rows_of(got.select(*first))) == ordered(expected)
    assert any(not r[6] and not r[7] for r in expected) and any(r[7] for r in expected)


@pytest.mark.parametrize("chars", [50, 8192])
def test_edges(edge, chars):
    got = fertility.apply_rules(edge, PIECES, piece_chars=chars)
    expected = plain_rules([(i, t, None) for i, t in EDGE])
    assert ordered(tuple(r)[:8] for r in got.collect()) == ordered(expected)
    assert {r["band"] for r in got.collect()} == {"script Latin", "script other"}


def test_nothing(nothing):
    assert fertility.apply_rules(nothing, PIECES).count() == 0


def test_copies_do_not_narrow_a_band(spark):
    docs = [(i, " ".join(f"word{(i * 31 + k * 7) % 400} and some{k % 50}" for k in range(60)), "xx") for i in range(40)]
    docs += [(100 + i, docs[0][1], "xx") for i in range(400)]
    got = fertility.apply_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), PIECES)
    assert got.where("not kept").count() == 0
    noise = [(900, "qz " * 20 + " ".join("xkcd"[i % 4] * 9 for i in range(60)), "xx")]
    got = fertility.apply_rules(spark.createDataFrame(docs + noise, "doc_id long, text string, lang string"), PIECES)
    assert [r["doc_id"] for r in got.where("not kept").collect()] == [900]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t#|é中", max_size=80))
def test_base_counts(text):
    assert fertility.base_counts(text) == plain_counts(text)
