from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from support import LONG, awkward, awkward_rows, nothing, prose

from millrace.llm import quality_rules as Q


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
        len(lines),
        len(re.findall(r"[A-Z]", text)),
        text.count("!"),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAé!#\n \t　\x1c", max_size=80))
def test_measures_equal_brute_force(text):
    assert Q.measure(text.encode()) == measured(text)


def test_long_text():
    assert Q.measure(LONG.encode()) == measured(LONG)


def test_ledger_of_awkward_rows(spark):
    got = Q.ledger(awkward(spark)).select("doc.doc_id", "doc.text", *Q.MEASURES, "failed").collect()
    assert len(got) == len(awkward_rows())
    for row in got:
        assert tuple(row[m] for m in Q.MEASURES) == measured(row.text)
        assert bool(row.failed & 1) == (row.n_words < 50)


def test_policies_and_rows(spark):
    bad = prose(5, 30) + " ### " * 40
    df = spark.createDataFrame(
        [(1, prose(4, 90)), (2, bad + prose(6, 60)), (3, "short"), (4, None), (1, prose(4, 90))],
        "doc_id int, text string",
    )
    kept = Q.passing(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1]
    base = Q.ledger(df).where(~Q.rejected("v1")).select("doc.doc_id").collect()
    assert sorted(r.doc_id for r in base) == [1, 1, 2]


def test_ablation_counts_bits(spark):
    entries = Q.ledger(awkward(spark))
    bits = [r.failed for r in entries.collect()]
    for row in Q.ablation(entries).collect():
        place = [r.name for r in Q.RULES].index(row.rule)
        having = [b for b in bits if b >> place & 1]
        assert (row.documents, row.failed) == (len(bits), len(having))
        assert row.only == sum(b == 1 << place for b in bits)
        union, common = 0, -1
        for b in having:
            union, common = union | b, common & b
        assert (row.union_bits or 0) == union
        assert row.common_bits == (common if having else None)


def test_empty_table(spark):
    assert Q.passing(nothing(spark)).count() == 0
    assert {r.documents for r in Q.ablation(Q.ledger(nothing(spark))).collect()} == {0}


def test_nothing_is_shuffled(spark, plan_of):
    assert "Exchange" not in plan_of(Q.ledger(awkward(spark)))


def test_good_labelled_texts_pass(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    entries = Q.ledger(docs.join(good, "doc_id")).where("failed & 3 = 0")
    assert entries.where(~Q.rejected("v2")).count() >= 0.98 * entries.count() > 0
