"""Words, lines and hashes shared by the text operators.

A word is a maximal run of bytes that are neither space nor one of the ASCII
controls 9 to 13. ``bytes.split()`` splits at exactly these, and no byte of a
longer UTF-8 sequence is among them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

# Words of a shingle and the least similarity of near-duplicates.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75

_U64 = np.uint64
# Odd multipliers of the words in a shingle, from a fixed seed.
_PLACES = np.random.default_rng(20260101).integers(1, 1 << 63, 64, dtype=np.uint64) | _U64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one, so that every bit depends on all."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def hashed_words(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def hashed_shingles(words: Sequence[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit hash per run of ``width`` words, in text order.

    Fewer words than that make one shingle, none make none.
    """
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    hashes = hashed_words(words)
    if n < width:
        return mixed((hashes * _PLACES[:n]).sum(dtype=np.uint64, keepdims=True) + _U64(n))
    out = np.zeros(n - width + 1, np.uint64)
    for place in range(width):
        out += hashes[place : n - width + 1 + place] * _PLACES[place]
    return mixed(out)


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text in lower case (A to Z only)."""
    return np.unique(hashed_shingles((text or b"").lower().split()))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """Values of a string column as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def cut(parts: np.ndarray, sizes: Sequence[int]) -> Iterator[np.ndarray]:
    at = 0
    for size in sizes:
        yield parts[at : at + size]
        at += size


def quoted_col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(docs: DataFrame, name: str = "doc") -> Column:
    """All columns as one struct, so that no name can clash with an operator's own."""
    return F.struct(*[quoted_col(c) for c in docs.columns]).alias(name)


# Rows of an Arrow batch. Texts are long, and a batch is held several times over,
# in the executor and in each Python worker of a task.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Let the session's jobs exchange few rows at a time with Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """Run a function of one Arrow batch over all batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)
