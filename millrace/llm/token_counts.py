"""Token counts without token ids: each distinct word is counted once."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.words_once import Block, tokenised_once


def read_tokenizer(path: str) -> str:
    """The content of a byte-level tokenizer file; its size bounds what tasks are sent."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens.

    ``tokenizer`` is the content of a file for byte-level BPE. Its added
    tokens are found inside texts, as the library does by default; they must
    not hold white space. None is added at the ends, and nothing is cut off.

    The pieces of each distinct word are counted once for the whole table. A
    document is the frequency of each of its words, and its count the sum of
    frequency times pieces. NULL and empty texts count 0; ids may be NULL and
    may repeat, every row is counted.
    """

    def tokenise():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(tokenizer)
        model.no_truncation()
        model.no_padding()

        def pieces(words):
            for start in range(0, len(words), 4096):
                part = words[start : start + 4096]
                for found in model.encode_batch_fast(part, add_special_tokens=False):
                    yield (len(found),)

        return lambda words: list(pieces(words))

    def answer(block: Block, flat, starts, counts):
        sums = [int((flat[starts[numbers]] * times).sum()) for numbers, times in block.texts]
        return [pa.array(block.lengths, pa.int64()), pa.array(np.array(sums, np.int64))]

    return tokenised_once(
        docs,
        text,
        doc_id,
        tokenise,
        answer,
        "n_bytes bigint, n_tokens bigint",
        by_frequency=True,
    )
