from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F
from support import awkward, awkward_rows, nothing

from millrace.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[norm(row[1])].append(row[0])
    out = []
    for row in rows:
        ids = groups[norm(row[1])]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(norm(row[1]).encode()).hexdigest()
        out.append((row[0], keep, len(ids), keep is None or row[0] == keep, digest))
    return sorted(out, key=repr)


def marked(df):
    got = exact_dedup.mark_duplicates(df)
    return got.select("doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_marks_equal_brute_force(spark, rows):
    assert rows(marked(awkward(spark))) == expected(awkward_rows())


def test_texts_that_share_a_hash_stay_apart(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "md5", lambda column: F.substring(F.hex(column), 1, 2))
    assert rows(marked(awkward(spark))) == expected(awkward_rows())


def test_one_row_stays_per_text(spark):
    kept = exact_dedup.drop_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    texts = [norm(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in awkward_rows()})
    by_text = {norm(r.text): r.doc_id for r in kept.collect()}
    assert by_text[norm(awkward_rows()[0][1])] == 1
    assert by_text[""] == 3


def test_empty_table(spark):
    assert marked(nothing(spark)).count() == 0
    assert exact_dedup.drop_duplicates(nothing(spark)).count() == 0


def test_no_python_in_the_plan(spark, plan_of):
    for df in (marked(awkward(spark)), exact_dedup.drop_duplicates(awkward(spark))):
        assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)


def test_copies_collapse_before_the_shuffle(spark, plan_of):
    plan = plan_of(exact_dedup.equal_texts(awkward(spark)))
    assert plan.index("Exchange") < plan.index("partial_min")
