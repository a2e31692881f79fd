"""Helpers shared by the document operators: shared-folder staging, words, hashing, Arrow batches."""

from __future__ import annotations

import uuid
import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

# Arrow batches handed to Python are bounded by rows and bytes, so that a worker
# never holds more than a few of the longest texts at once.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session (see ARROW_CONF)."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: whatever was drawn, numbered or fitted is fixed from
    here on, even if executors are lost later.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows up to which a list of ids or fingerprints is broadcast (at most 64 bytes each: 32 MB).
BROADCAST_ROWS = 500_000


def bounded_broadcast(staged: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """``chosen`` (made row by row from ``staged``, a written table) marked for
    broadcast if ``staged`` is short enough; else Spark decides, and shuffles."""
    chosen = staged if chosen is None else chosen
    return F.broadcast(chosen) if staged.count() <= BROADCAST_ROWS else chosen


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes (null: none)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


class HashCache(dict):
    """word -> unsigned 64-bit hash, remembered per worker and emptied when it
    holds ``limit`` words (only costs time)."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
