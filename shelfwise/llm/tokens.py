"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries into pieces of at most a few kilobytes and
encoded in batches that hold about the same number of bytes, so that one very
long text costs no more memory than many short ones.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One blank between two visible ASCII characters: no piece of the vocabulary
# holds a word start after another character (checked by ``safe_vocabulary``),
# so no merge crosses it, and the blank equals the prefix put before each text.
_SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")


def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def safe_vocabulary(model: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece joins a character to a following word start, and a text gets
    exactly one word start in front, its own blanks kept."""
    mark = "▁"
    crossing = any(mark in model.id_to_piece(i).lstrip(mark) for i in range(model.get_piece_size()))
    return not crossing and model.encode("a b", out_type=str) == model.encode("a", out_type=str) + model.encode(
        "b", out_type=str) and len(model.encode("a  b")) > len(model.encode("a b"))


def split_safely(text: str, size: int) -> list[str]:
    """Pieces of about ``size`` characters whose token counts add up to the text's."""
    pieces, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        pieces.append(text[start:cut.start()])
        start = cut.end()
    pieces.append(text[start:])
    return pieces


def _counter(path: str, batch_bytes: int, piece_chars: int):
    def run(batches):
        model = load_model(path)
        safe = safe_vocabulary(model)
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            sizes = np.zeros(batch.num_rows, dtype=np.int64)
            pending, owners, held = [], [], 0

            def flush():
                encoded = model.encode(pending, num_threads=1)
                np.add.at(counts, owners, [len(ids) for ids in encoded])
                pending.clear()
                owners.clear()

            column = batch.column(batch.schema.get_field_index("__text"))
            for row in range(batch.num_rows):
                text = column[row].as_py()
                if not text:
                    continue
                sizes[row] = len(text.encode("utf-8", "surrogatepass"))
                for piece in split_safely(text, piece_chars) if safe else [text]:
                    pending.append(piece)
                    owners.append(row)
                    held += len(piece)
                    if held >= batch_bytes:
                        flush()
                        held = 0
            if pending:
                flush()
            rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "__text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes), pa.array(counts)],
                                             names=[*(n for n in batch.schema.names if n != "__text"),
                                                    "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", keep=("doc_id",), limit: int = 4096,
                 batch_bytes: int = 1 << 20, piece_chars: int = 8192) -> DataFrame:
    """Per row: the ``keep`` columns, n_bytes (UTF-8), n_tokens and over_limit.

    ``model_path`` is a sentencepiece file that every executor can open.  Null
    and empty texts have 0 bytes and 0 tokens.  Every input row gives one row;
    repeated rows repeat, other columns are ignored, an empty table gives none.
    """
    data = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    schema = T.StructType([*[data.schema[c] for c in keep],
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return (data.mapInArrow(_counter(model_path, batch_bytes, piece_chars), schema)
            .withColumn("over_limit", F.col("n_tokens") > limit))
