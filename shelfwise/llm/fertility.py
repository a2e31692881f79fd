"""Quality rules by tokeniser fertility.

A public vocabulary measures every whole text: characters per token, the share
of tokens that fall back to single bytes, and the entropy of its tokens.  What
is usual differs from language to language, so the bands outside which a text
is rejected are taken from all texts of its language (or, where no language is
given, its script).  Plain counts of words, symbols and repetition come first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import bounded_broadcast, stage
from shelfwise.llm.tokens import load_model, safe_vocabulary, split_safely

_SYMBOLS, _BLANKS = b"#*$%&|<>", b" \t\n\x0b\x0c\r"

# Code point ranges of common scripts.
SCRIPTS = {"Latin": (0x41, 0x24F), "Greek": (0x370, 0x3FF), "Cyrillic": (0x400, 0x52F), "Hebrew": (0x590, 0x5FF),
           "Arabic": (0x600, 0x6FF), "Devanagari": (0x900, 0x97F), "Thai": (0xE00, 0xE7F), "Kana": (0x3040, 0x30FF),
           "Han": (0x4E00, 0x9FFF), "Hangul": (0xAC00, 0xD7A3)}

MEASURES = ("chars_per_token", "byte_share", "token_entropy")
# Least distance of a band's edge from the quartile beside it, so that a language
# whose texts are all alike does not reject the next one for a trifle.
LEAST_WIDTH = {"chars_per_token": 0.2, "byte_share": 0.02, "token_entropy": 0.2}


def script_of(text: str) -> str:
    """The script of most letters (ties: the first listed), "other" without any."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = {name: int(((points >= lo) & (points <= hi)).sum()) for name, (lo, hi) in SCRIPTS.items()}
    best = max(counts, key=counts.__getitem__)
    return best if counts[best] else "other"


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    window, bound = ids[:n], len(number)
    for k in range(1, size):
        if bound * len(number) >= 1 << 62:
            window, bound = np.unique(window, return_inverse=True)[1], n
        window = window * len(number) + ids[k:n + k]
        bound *= len(number)
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    return int((np.cumsum(cover) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return 0, 0, len(data) - len(data.translate(None, _SYMBOLS)), 0, 0
    letters = np.frombuffer(data.translate(None, _BLANKS), np.uint8)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (len(words), int(((letters & 0xC0) != 0x80).sum()), len(data) - len(data.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def block_entropy(ids: np.ndarray, size: int = 64) -> float:
    """Mean bits of entropy over consecutive blocks of ``size`` tokens; the last
    block ends with the text, a shorter text is one block."""
    if not len(ids):
        return 0.0
    size = min(size, len(ids))
    starts = np.arange(0, len(ids) - size + 1, size)
    if starts[-1] != len(ids) - size:
        starts = np.append(starts, len(ids) - size)
    total = 0.0
    for at in range(0, len(starts), 4096):
        blocks = np.sort(ids[starts[at:at + 4096, None] + np.arange(size)], axis=1)
        first = np.ones(blocks.shape, bool)
        first[:, 1:] = blocks[:, 1:] != blocks[:, :-1]
        runs = np.diff(np.append(np.flatnonzero(first.ravel()), blocks.size))
        # sum over distinct tokens of c/size * log2(size/c)
        total += float((runs / size * np.log2(size / runs)).sum())
    return total / len(starts)


def _measure(path: str, piece_chars: int):
    def run(batches):
        model = load_model(path)
        safe = safe_vocabulary(model)
        is_byte = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        for batch in batches:
            text_at, lang_at = (batch.schema.get_field_index(c) for c in ("__text", "__lang"))
            rows = []
            for text, lang in zip(batch.column(text_at), batch.column(lang_at), strict=True):
                text, lang = text.as_py() or "", lang.as_py()
                base = base_counts(text)
                pieces = model.encode(split_safely(text, piece_chars) if safe else [text], num_threads=1) if text else []
                ids = np.concatenate([np.array(p, np.int32) for p in pieces]) if pieces else np.zeros(0, np.int32)
                n = len(ids)
                rows.append((*base, n, base[1] / n if n else 0.0, float(is_byte[ids].mean()) if n else 0.0,
                             block_entropy(ids), lang if lang else "script " + script_of(text)))
            rest = [batch.column(i) for i in range(batch.num_columns) if i not in (text_at, lang_at)]
            made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[
                *(n for i, n in enumerate(batch.schema.names) if i not in (text_at, lang_at)), *_COLUMNS])
    return run


_COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
            "n_repeat_words": "long", "n_tokens": "long", **dict.fromkeys(MEASURES, "double"), "band": "string"}
_SPARK = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
_ARROW = [{"long": pa.int64(), "double": pa.float64(), "string": pa.string()}[t] for t in _COLUMNS.values()]


def base_failed(least_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def measure(docs: DataFrame, model_path: str, text_col: str = "text", lang_col: str | None = "lang",
            keep=("doc_id",), piece_chars: int = 8192) -> DataFrame:
    """Per row: the ``keep`` columns, the base counts, n_tokens, the three
    measures and the band's name (the language; the script where it is null,
    empty or no column).  Null and empty texts have counts and measures of 0."""
    lang = F.col(lang_col).cast("string") if lang_col and lang_col in docs.columns else F.lit(None).cast("string")
    data = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"), lang.alias("__lang"))
    schema = T.StructType([*[data.schema[c] for c in keep],
                           *[T.StructField(c, _SPARK[t]) for c, t in _COLUMNS.items()]])
    return data.mapInArrow(_measure(model_path, piece_chars), schema)


def bands(measured: DataFrame, width: float = 4.0) -> DataFrame:
    """(band, lowest and highest value of each measure): quartiles of all texts
    that pass the base rules, each set of equal measures counted once so that
    copies do not narrow a band, and ``width`` times their distance beyond
    (LEAST_WIDTH at least).  Measures count in thousandths, so the quartiles are
    exact and their state is bounded."""
    texts = measured.where(~base_failed()).select("band", "n_words", "n_tokens", *[
        F.round(m, 3).alias(m) for m in MEASURES]).distinct()
    quartiles = texts.groupBy("band").agg(*[F.percentile(m, F.array(F.lit(0.25), F.lit(0.75))).alias(m) for m in MEASURES])
    edges = []
    for m in MEASURES:
        low, high = F.col(m)[0], F.col(m)[1]
        reach = F.greatest(width * (high - low), F.lit(LEAST_WIDTH[m]))
        edges += [(low - reach).alias(f"{m}_low"), (high + reach).alias(f"{m}_high")]
    return quartiles.select("band", *edges)


def apply_rules(docs: DataFrame, model_path: str, width: float = 4.0, keep=("doc_id",), **options) -> DataFrame:
    """Per row: the ``keep`` columns, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, then n_tokens, the measures,
    the band and the first measure outside it (``rejected_by``, else null).

    A text that fails the base rules is not kept, whatever its measures; null,
    empty and blank texts have no words and fail.  Ties and repeated rows get
    equal results; a lone text of its language lies inside its own band; other
    columns are ignored; an empty table gives no rows.  Texts are encoded whole
    (long ones in pieces whose tokens add up); a text without a safe blank is one
    piece.  The bands depend on all rows.
    """
    measured = stage(measure(docs, model_path, keep=keep, **options), "fertility")
    limits = stage(bands(measured, width), "fertility-bands")
    out = F.lit(None).cast("string")
    for m in reversed(MEASURES):
        inside = F.round(m, 3).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
        out = F.when(~inside, F.lit(m)).otherwise(out)
    failed = base_failed()
    return (measured.join(bounded_broadcast(limits), "band", "left")
            .withColumn("base_failed", failed)
            .withColumn("rejected_by", F.when(failed, F.lit("base")).otherwise(out))
            .select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    F.col("rejected_by").isNull().alias("kept"), "n_tokens", *MEASURES, "band", "rejected_by"))
