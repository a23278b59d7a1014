"""Tokenise each distinct word of a corpus once, wherever it occurs.

Documents are read in blocks of bounded size. A block numbers its distinct
words and keeps its texts as sequences of these numbers, which are the words'
positions. Only the distinct words of each block are shuffled by word: there
equal words of all blocks meet, are tokenised once, and the answers go back to
the blocks that asked. So a word that every document uses arrives once per
block and not once per use, and no exploded position is ever shuffled. What one
Python call gets of a bucket is bounded: blocks are dealt to spans, and each span
has its words tokenised apart, so a word that all blocks ask for is no single
task's work.

A word here is a run of white space and the run of other characters after it,
or white space at the end of a text. White space is what Unicode calls so. The
pre-tokeniser patterns served here never match across the border between such
a run and the white space after it, so each word holds whole pre-tokens and
tokenising the words one by one gives what the whole text gives.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.text import quoted_col

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

# Words after which a block ends; a longer text is a block of its own.
BLOCK_WORDS = 500_000

# Partitions, and blocks of each, that make a span: within one, equal words meet.
SPAN_PARTITIONS = 64
SPAN_BLOCKS = 8


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + count]`` one after another."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1])]


def pack_bytes(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack_bytes(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return pa.decompress(packed[8:], decompressed_size=size, codec="zstd", asbytes=True)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, first all lowest bytes, then all next ones, compressed."""
    return pack_bytes(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack_bytes(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: Sequence[bytes]) -> tuple[bytes, bytes]:
    """The words' bytes one after another, and how many each has."""
    return pack_bytes(b"".join(words)), pack_numbers(np.fromiter(map(len, words), np.int64, len(words)))


def unpack_words(body: bytes, sizes: bytes) -> list[bytes]:
    text, ends = unpack_bytes(body), np.cumsum(unpack_numbers(sizes), dtype=np.int64).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@dataclass
class Block:
    """Some documents as numbers of their distinct words."""

    ids: list = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    numbers: dict[str, int] = field(default_factory=dict)
    size: int = 0

    def add(self, doc_id, text: str | None) -> None:
        words = UNIT.findall(text or "")
        numbers = self.numbers
        self.ids.append(doc_id)
        self.lengths.append(len((text or "").encode()))
        self.texts.append(
            np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint32, len(words))
        )
        self.size += len(words)

    def dealt(self, buckets: int) -> tuple[list[bytes], np.ndarray]:
        """Distinct words in order of their numbers, and the bucket of each."""
        words = [w.encode() for w in self.numbers]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        return words, (hashes % np.uint64(buckets)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                block.add(doc_id, text)
                if block.size >= most:
                    yield block
                    block = Block()
    if block.ids:
        yield block


def tokenised_once(
    docs: DataFrame,
    text: str,
    doc_id: str,
    tokenise: Callable[[], Callable[[list[str]], list[Sequence[int]]]],
    answer: Callable[[Block, np.ndarray, np.ndarray, np.ndarray], list[pa.Array]],
    answer_schema: str,
    by_frequency: bool = False,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per input row: id and the columns of ``answer_schema``.

    ``tokenise()`` is called in a task and returns a function from distinct
    words to the numbers wanted for each. ``answer`` gets a block's numbers of
    all words as one array with the start and count of each word, and returns
    the columns of its documents. The block has each document as one row of
    word numbers in text order or, with ``by_frequency``, as two rows: distinct
    word numbers and how often each occurs.

    Both sides of the final join read the documents, in the same way; a block
    is named by its place and a hash of its content, and a block that does not
    find all its words fails the job instead of giving a wrong answer.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    id_type = _arrow_type(rows, "id")
    names = ["id", *[part.split()[0] for part in answer_schema.split(", ")]]
    block_schema = pa.schema(
        [
            ("block", pa.string()),
            ("ids", pa.list_(id_type)),
            ("lengths", pa.binary()),
            ("buckets", pa.binary()),
            ("sizes", pa.binary()),
            ("numbers", pa.binary()),
            ("repeats", pa.binary()),
        ]
    )

    def read(batches):
        place = TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches, block_words)):
            words, bucket = block.dealt(buckets)
            content = xxhash.xxh3_128()
            for w in words:
                content.update(w)
            content.update(np.array([len(words), block.size, *block.lengths], np.int64).tobytes())
            yield f"{place}-{number}-{content.hexdigest()}", block, words, bucket

    def span_of(name):
        place, number, _ = name.split("-")
        return f"{int(place) // SPAN_PARTITIONS}-{int(number) // SPAN_BLOCKS}"

    def asked(batches):
        for name, _, words, bucket in read(batches):
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
            parts = [
                pack_words([words[i] for i in order[a:b]])
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(parts), pa.string()),
                    pa.array([span_of(name)] * len(parts), pa.string()),
                    pa.array(bucket[order][edges[:-1]], pa.int32()),
                    pa.array([body for body, _ in parts], pa.binary()),
                    pa.array([sizes for _, sizes in parts], pa.binary()),
                ],
                ["block", "span", "bucket", "body", "sizes"],
            )

    def sequences(batches):
        for name, block, _, bucket in read(batches):
            texts, repeats = block.texts, None
            if by_frequency:
                counted = [np.unique(t, return_counts=True) for t in texts]
                texts = [u for u, _ in counted]
                repeats = pack_numbers(np.concatenate([n for _, n in counted]))
            row = {
                "block": name,
                "ids": block.ids,
                "lengths": pack_numbers(np.array(block.lengths)),
                "buckets": pack_numbers(bucket),
                "sizes": pack_numbers(np.fromiter(map(len, texts), np.int64, len(texts))),
                "numbers": pack_numbers(np.concatenate(texts)),
                "repeats": repeats,
            }
            yield pa.RecordBatch.from_pylist([row], schema=block_schema)

    function = None

    def answered(table: pa.Table) -> pa.Table:
        nonlocal function
        function = function or tokenise()
        parts = [unpack_words(*row) for row in zip(table["body"].to_pylist(), table["sizes"].to_pylist(), strict=True)]
        distinct = {}
        codes = [
            np.fromiter((distinct.setdefault(w, len(distinct)) for w in part), np.int64, len(part))
            for part in parts
        ]
        del parts
        found = function([w.decode() for w in distinct])
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((n for f in found for n in f), np.int64, counts.sum())
        starts = np.cumsum(counts) - counts
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "counts": pa.array([pack_numbers(counts[c]) for c in codes], pa.binary()),
                "numbers": pa.array(
                    [pack_numbers(gather(flat, starts[c], counts[c])) for c in codes], pa.binary()
                ),
            }
        )

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {row["bucket"]: row for row in right.to_pylist()}
        columns = [[] for _ in names]
        for row in left.to_pylist():
            bucket = unpack_numbers(row["buckets"])
            order = np.argsort(bucket, kind="stable")
            parts = [found[b] for b in np.unique(bucket).tolist()]
            counts = _joined([unpack_numbers(p["counts"]) for p in parts])
            if len(counts) != len(bucket):
                raise ValueError(f"block {row['block']} asked for {len(bucket)} words, got {len(counts)}")
            flat = _joined([unpack_numbers(p["numbers"]) for p in parts])
            # From the order of the buckets back to the numbers of the words.
            starts, own = np.empty_like(counts), np.empty_like(counts)
            starts[order], own[order] = np.cumsum(counts) - counts, counts
            block = Block(ids=row["ids"], lengths=unpack_numbers(row["lengths"]).tolist())
            numbers = unpack_numbers(row["numbers"])[None]
            if by_frequency:
                numbers = np.concatenate([numbers, unpack_numbers(row["repeats"])[None]])
            edges = np.concatenate([[0], np.cumsum(unpack_numbers(row["sizes"]), dtype=np.int64)])
            block.texts = [numbers[:, a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            answers = [pa.array(block.ids, id_type), *answer(block, flat, starts, own)]
            for column, values in zip(columns, answers, strict=True):
                column.append(values)
        return pa.table([pa.chunked_array(c) for c in columns], names)

    words = rows.mapInArrow(asked, "block string, span string, bucket int, body binary, sizes binary")
    coded = words.groupBy("bucket", "span").applyInArrow(
        answered, "block string, bucket int, counts binary, numbers binary"
    )
    texts = rows.mapInArrow(
        sequences,
        f"block string, ids array<{kind}>, lengths binary, buckets binary, "
        "sizes binary, numbers binary, repeats binary",
    )
    return texts.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        put_together, f"id {kind}, {answer_schema}"
    )


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
