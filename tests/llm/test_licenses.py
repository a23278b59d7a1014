from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from support import awkward, awkward_rows, nothing, prose

from millrace.llm import licenses as L

LINE = L.TEMPLATES["apache-2.0-line"]


def common_words(a, b):
    """Longest common subsequence, the plain way."""
    above = [0] * (len(b) + 1)
    for x in a:
        here = [0]
        for j, y in enumerate(b):
            here.append(above[j] + 1 if x == y else max(above[j + 1], here[j]))
        above = here
    return above[-1]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=8),
    st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=8),
)
def test_a_wide_band_aligns_as_well_as_no_band(template, text):
    matched, start, end = L.aligned(template, [b""] * 12 + text, band=12)
    assert matched == common_words(template, text)
    assert matched == 0 or common_words(template, ([b""] * 12 + text)[start:end]) == matched


def scanned(df, **more):
    return [tuple(r) for r in L.scan(df, **more).collect()]


def test_spans_and_coverage(spark):
    before, after = prose(1, 30), prose(2, 30)
    text = f"{before} É\n{LINE}\n{after}"
    df = spark.createDataFrame([(7, text)], "doc_id int, text string")
    [(doc, name, coverage, matched, start, end, first, past)] = scanned(df)
    assert (doc, name, coverage, matched) == (7, "apache-2.0-line", 1.0, 7)
    assert text.split()[start:end] == LINE.split()
    assert text.encode()[first:past].decode() == LINE


def test_edited_templates_are_found_and_others_not(spark):
    words = L.TEMPLATES["mit-grant"].split()
    edited = " ".join(words[:20] + ["really"] + words[20:50] + words[53:]).upper()
    halved = " ".join(words[: len(words) // 2])
    twice = f"{LINE} {prose(3, 5)} {LINE}"
    rows = [(1, edited), (2, halved), (3, twice), (4, "licensed under the moon and the stars"), (5, prose(4, 500))]
    got = scanned(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted((r[0], r[1]) for r in got) == [(1, "mit-grant"), (3, "apache-2.0-line"), (3, "apache-2.0-line")]
    assert 0.9 < next(r[2] for r in got if r[0] == 1) < 1


def test_candidates_lose_no_match_against_a_full_alignment(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text ILIKE '%license%'")
    found = {(r[0], r[1]) for r in scanned(docs)}
    want = set()
    for row in docs.collect():
        words = L.plain([w.lower() for w in re.findall(rb"[^\x20\x09-\x0d]+", row.text.encode())])
        for name, template in L.TEMPLATES.items():
            parts = L.plain(template.lower().encode().split())
            size = len(parts) + L.BAND
            best = max(common_words(parts, words[i : i + size]) for i in range(len(words)))
            if 100 * best >= L.COVERAGE_PERCENT * len(parts):
                want.add((row.doc_id, name))
    assert found == want and want


def test_awkward_rows(spark):
    df = awkward(spark).unionByName(
        spark.createDataFrame([(None, LINE), (5, LINE), (5, LINE)], "doc_id bigint, text string"),
        allowMissingColumns=True,
    )
    assert sorted(str(r[0]) for r in scanned(df)) == ["5", "5", "None"]
    assert len(awkward_rows()) == awkward(spark).count()
    assert scanned(nothing(spark)) == []
    assert scanned(df, templates={}) == []


def test_short_notices_back_to_back_are_all_found():
    for line in ("Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "One two three four"):
        index = L.Index.of({"line": line})
        size = len(line.split())
        for copies in (2, 3, 5):
            got = [m[2:4] for m in L.matches(index, " ".join([line] * copies).encode())]
            assert got == [(n * size, n * size + size) for n in range(copies)]
