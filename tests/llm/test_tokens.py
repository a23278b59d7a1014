from __future__ import annotations

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from support import awkward, awkward_rows, nothing, prose
from tokenizers import Tokenizer

from millrace.llm import bpe, token_counts
from millrace.llm.queries import COUNTING_TOKENIZER, ENCODING_RANKS
from millrace.llm.words_once import UNIT, gather, pack_numbers, tokenised_once, unpack_numbers

RANKS = bpe.read_ranks(P.path(ENCODING_RANKS))
ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TOKENIZER = Tokenizer.from_file(P.path(COUNTING_TOKENIZER))

SPACES = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aB1'\xe9!#\u0633t" + SPACES, max_size=30))
def test_words_hold_whole_tokens(text):
    words = UNIT.findall(text)
    assert "".join(words) == text
    one_by_one = [i for w in words for i in ENCODING.encode_ordinary(w)]
    assert one_by_one == ENCODING.encode_ordinary(text)
    lengths = [len(TOKENIZER.encode(w, add_special_tokens=False).ids) for w in words]
    assert sum(lengths) == len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def encoded(df):
    return bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS)


def test_encoding_equals_the_library_and_decodes_to_the_text(spark):
    got = sorted(
        [(r.id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded).decode())
         for r in encoded(awkward(spark)).collect()],
        key=repr,
    )
    want = []
    for row in awkward_rows():
        ids = ENCODING.encode_ordinary(row[1] or "")
        want.append((row[0], len(ids), ids, row[1] or ""))
    assert got == sorted(want, key=repr)


def test_ids_as_an_array(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id int, text string")
    got = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, arrays=True).collect()
    assert {r.id: r.token_ids for r in got} == {1: ENCODING.encode_ordinary("a b"), 2: []}


def test_unknown_id_fails(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "id int, ids binary")
    with pytest.raises(Exception, match="IndexError|out of range"):
        bpe.decode(df, RANKS).collect()


def test_counts_equal_the_library(spark):
    special = "a<|endoftext|> b  <|endoftext|>\n<|endoftext|"
    df = awkward(spark).unionByName(
        spark.createDataFrame([(99, special)], "doc_id bigint, text string"), allowMissingColumns=True
    )
    got = sorted(
        [(r.id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(
            df, token_counts.read_tokenizer(P.path(COUNTING_TOKENIZER))).collect()],
        key=repr,
    )
    want = [
        (i, len((t or "").encode()), len(TOKENIZER.encode(t or "", add_special_tokens=False).ids))
        for i, t in [*[r[:2] for r in awkward_rows()], (99, special)]
    ]
    assert got == sorted(want, key=repr)


def test_each_word_is_tokenised_once_over_many_blocks(spark):
    rows = [(i, prose(i % 5, 40)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    asked = spark.sparkContext.accumulator(0)

    def tokenise():
        def lengths(words):
            asked.add(len(words))
            return [(len(w),) for w in words]

        return lengths

    def answer(block, flat, starts, counts):
        import pyarrow as pa

        return [pa.array([int(flat[starts[n]].sum()) for (n,) in block.texts], pa.int64())]

    got = tokenised_once(df, "text", "doc_id", tokenise, answer, "n bigint", block_words=100).collect()
    assert {r.id: r.n for r in got} == {i: len(t) for i, t in rows}
    assert asked.value == len({w for _, t in rows for w in UNIT.findall(t)})


def test_empty_table(spark):
    assert encoded(nothing(spark)).count() == 0
    counts = token_counts.count_tokens(nothing(spark), TOKENIZER.to_str())
    assert counts.count() == 0


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_packed_numbers(numbers):
    assert unpack_numbers(pack_numbers(np.array(numbers, np.uint32))).tolist() == numbers


def test_gather():
    flat = np.arange(10)
    assert gather(flat, np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]
    assert gather(flat, np.array([], int), np.array([], int)).tolist() == []
