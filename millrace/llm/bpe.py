"""Byte-level BPE: encode by a global shuffle of distinct words, decode by a table."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.text import map_batches
from millrace.llm.words_once import Block, gather, tokenised_once


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ids from a rank file; its size bounds what tasks are sent."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    decoded: bool = False,
) -> DataFrame:
    """One row per input row: id, n_tokens, and ids as little-endian 32-bit numbers.

    With ``decoded`` the ids are decoded where they are put together, which takes
    no further Python step: the columns are id, n_tokens, ``token_ids``, an array,
    and ``decoded``, the bytes that they stand for.

    Each match of the pattern is encoded separately, without special tokens.
    The pattern must never match across the border between a non-space and a
    white space after it. NULL and empty texts have no tokens. Ids may be NULL
    and may repeat: every row is encoded. Whole texts of any length are.
    """

    def tokenise():
        encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        return lambda words: [encoding.encode_ordinary(word) for word in words]

    table = _bytes_by_id(ranks) if decoded else None

    def answer(block: Block, flat, starts, counts):
        tokens, packed = [], []
        if decoded:
            arrays, texts = [], []
            for (numbers,) in block.texts:
                ids = gather(flat, starts[numbers], counts[numbers])
                arrays.append(ids.astype(np.int32))
                texts.append(b"".join([table[i] for i in ids.tolist()]))
            sizes = pa.array([len(ids) for ids in arrays], pa.int64())
            return [sizes, pa.array(arrays, pa.list_(pa.int32())), pa.array(texts, pa.binary())]
        for (numbers,) in block.texts:
            ids = gather(flat, starts[numbers], counts[numbers])
            tokens.append(len(ids))
            packed.append(ids.astype("<u4").tobytes())
        return [pa.array(tokens, pa.int64()), pa.array(packed, pa.binary())]

    columns = "token_ids array<int>, decoded binary" if decoded else "ids binary"
    return tokenised_once(docs, text, doc_id, tokenise, answer, f"n_tokens bigint, {columns}")


def _bytes_by_id(ranks: dict[bytes, int]) -> list[bytes | None]:
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode(encoded: DataFrame, ranks: dict[bytes, int], arrays: bool = False) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ids stand for; NULL ids give NULL.

    The ids are looked up in the table of token bytes, which is as large as
    the rank file and is sent to the tasks. An id that it lacks fails the job.
    With ``arrays`` the ids are added as ``token_ids``, an array column, too.
    """
    table = _bytes_by_id(ranks)
    kept = encoded.drop("decoded", "token_ids")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())])
    if arrays:
        schema = schema.add("token_ids", T.ArrayType(T.IntegerType()))
    at = kept.columns.index("ids")

    def decoded(batch):
        ids = [None if x is None else np.frombuffer(x, "<u4") for x in batch.column(at).to_pylist()]
        texts = [None if x is None else b"".join([table[i] for i in x.tolist()]) for x in ids]
        batch = batch.append_column("decoded", pa.array(texts, pa.binary()))
        if arrays:
            batch = batch.append_column("token_ids", pa.array(ids, pa.list_(pa.int32())))
        yield batch

    return map_batches(kept, decoded, schema)
