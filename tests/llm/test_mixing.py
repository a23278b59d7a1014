from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from support import SCHEMA, awkward, awkward_rows, nothing, prose

from millrace.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def targets_of(sizes):
    """Sources one round at a time: share, stop at three times the size, share what is over."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_ones, over = set(names), float(sum(sizes.values()))
    while over > 1e-9 and open_ones:
        total = sum(weight[s] for s in open_ones)
        for s in list(open_ones):
            target[s] += over * weight[s] / total
        over = 0.0
        for s in list(open_ones):
            if target[s] >= 3 * sizes[s]:
                over += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_ones.discard(s)
    return target


def check(rows, got):
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += size_of(row[1])
    targets, taken = targets_of(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for row in got:
        assert row["size"] == size_of(row.text)
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source])
        assert 0 <= row.taken <= 3 * row["size"]
        assert (row.position is None) == (row.taken == 0)
        assert row.position is None or 0 <= row.position <= 1
        taken[row.source] += row.taken
    for source, target in targets.items():
        assert taken[source] == math.floor(target + 1e-6)


def mixed(df):
    return mixing.mix(df).select("doc.*", "size", "source_size", "target", "taken", "position").collect()


def test_awkward_rows(spark):
    check(awkward_rows(), mixed(awkward(spark)))


def test_hot_source_and_reruns(spark):
    rows = [
        (i, prose(i, 20 + i % 50), "en", "hot" if i % 3 == 0 else f"s{i % 7}", None, None, None, None)
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    first = mixed(df)
    check(rows, first)
    again = mixed(df.repartition(13).orderBy(F.rand()))
    assert sorted(first, key=str) == sorted(again, key=str)


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(1, prose(1, 10), "", "a"), (2, prose(2, 1000), "", "b"), (3, prose(3, 1000), "", "c")]
    rows = [(*r, None, None, None, None) for r in rows]
    got = {r.source: r for r in mixed(spark.createDataFrame(rows, SCHEMA))}
    assert got["a"].target == 30.0 and got["a"].taken == 30
    check(rows, list(got.values()))


def test_time_at_which_words_are_due_inverts_the_integral(spark):
    cases = [(f / 10, a, b) for f in range(11) for a, b in ((5.0, 5.0), (6.0, 4.0), (0.5, 1.5))]
    df = spark.createDataFrame(cases, "f double, a double, b double")
    for row in df.withColumn("t", mixing.due(F.col("f"), F.col("a"), F.col("b"))).collect():
        used = row.a * row.t + (row.b - row.a) * row.t**2 / 2
        assert used / ((row.a + row.b) / 2) == pytest.approx(row.f)


def test_stream_holds_whole_copies_in_order(spark):
    rows = [(i, prose(i, 50), "en", f"s{i % 4}", None, None, None, None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    copies = {r.doc.doc_id: r.copies for r in mixing.mix(df).collect()}
    got = mixing.training_stream(df)
    assert got.columns == df.columns
    listed = [r.doc_id for r in got.collect()]
    assert {i: listed.count(i) for i in copies} == copies
    # The second source's weight grows during training, so its words come late.
    late = [n for n, i in enumerate(listed) if i % 4 == 2]
    assert sum(late) / len(late) > len(listed) / 2


def test_empty_table(spark):
    assert mixing.mix(nothing(spark)).count() == 0
    assert mixing.training_stream(nothing(spark)).count() == 0


def test_no_python_in_the_plan(spark, plan_of):
    plan = plan_of(mixing.training_stream(awkward(spark)))
    assert "Python" not in plan and "Arrow" not in plan
