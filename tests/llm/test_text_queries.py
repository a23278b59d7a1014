"""The registered text queries against their SQL and against the libraries, and the pipeline."""

from __future__ import annotations

import hashlib
import math
import re

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from millrace.llm import bpe, mixing, quality_rules
from millrace.llm.queries import ENCODING_RANKS, ORACLES, QUERIES
from millrace.workspace import fresh_path


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def tidy(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    found = sorted((tuple(tidy(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert found == sorted((tuple(map(tidy, r)) for r in result.fetchall()), key=repr)


def test_encoded_digests_equal_the_library(spark, sf_dir):
    ranks = bpe.read_ranks(P.path(ENCODING_RANKS))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_byte_bpe"](spark, sf_dir).collect()}
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode_ordinary(row.text)
        digests = (hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), row.text.encode()))
        assert got[row.doc_id] == (len(ids), *digests)


@pytest.mark.parametrize("name", ["op2_quality_classifier", "op7_toxicity"])
def test_scores_cover_all_documents_and_beat_chance(name, spark, sf_dir):
    rows = QUERIES[name](spark, sf_dir).collect()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    label = {"op2_quality_classifier": "quality", "op7_toxicity": "toxic"}[name]
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert held and right >= 0.8 * len(held)


def five_words(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_pipeline_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    mask = quality_rules.mask_of(quality_rules.POLICIES["v2"])
    names = {m: i for i, m in enumerate(quality_rules.MEASURES)}
    kept = []
    for row in rows:
        values = dict(zip(names, quality_rules.measure(row.text.encode()), strict=True))
        failed = sum(
            1 << place
            for place, rule in enumerate(quality_rules.RULES)
            if eval(rule.fails.replace("OR", "or"), {}, values)  # noqa: S307
        )
        if not failed & mask:
            kept.append(row)
    first = {}
    for row in sorted(kept, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", row.text), row)
    kept = sorted(first.values(), key=lambda r: r.doc_id)
    sets, group = [five_words(r.text) for r in kept], list(range(len(kept)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    kept = [kept[g] for g in sorted(set(group))]
    stream = mixing.training_stream(spark.createDataFrame(kept, spark.read.parquet(f"{sf_dir}/documents.parquet").schema))
    want = sorted((r.doc_id, r.text) for r in stream.collect())
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in got) == want
    ranks = bpe.read_ranks(P.path(ENCODING_RANKS))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.token_ids == library.encode_ordinary(r.text) for r in got)


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    numbers = [6, 4, 8, 3, 5]
    assert len(corpus_pipeline.STAGES) == len(numbers)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns


def test_contract_lists_the_text_queries():
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_awkward_rows_and_empty_tables_pass_all_stages(spark):
    """Rows without words fail the rules; of copies the smallest id stays; NULL ids are kept apart."""
    from tests.llm.support import awkward, nothing, prose

    more = [(100 + i, prose(50 + i, 120), None, None, None, None, None, None) for i in range(4)]
    docs = awkward(spark).unionByName(spark.createDataFrame(more, awkward(spark).schema))
    for frame in (docs, nothing(spark)):
        rows = frame
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = fresh_path(spark, f"awkward-{name}")
            stage(spark, rows, "").write.parquet(path)
            rows = spark.read.parquet(path)
            if number < 4:
                assert rows.columns == frame.columns
            if number == 2 and frame is docs:
                # What the mix takes of them is its own business.
                assert {100, 101, 102, 103} <= {r.doc_id for r in rows.collect()}
        got = rows.collect()
        assert rows.columns == ["doc_id", "n_tokens", "token_ids", "text"]
        if frame is docs:
            ids = {r.doc_id for r in got}
            assert ids & {100, 101, 102, 103} and not ids & {3, 4, 5, 6, 7}
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.text == texts[r.doc_id] for r in got if r.doc_id not in (None, 2))
        else:
            assert got == []


def test_token_counts_equal_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op10_token_counts"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert got[r.doc_id] == (len(r.text.encode()), n)
