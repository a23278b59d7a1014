from __future__ import annotations

import random
import re

import numpy as np
from support import SCHEMA, awkward, awkward_rows, nothing, prose

from millrace.llm import near_dedup as N
from millrace.llm.components import smallest_reachable


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def components(rows):
    """Smallest reachable id of each row, comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    out = []
    for i, row in enumerate(rows):
        ids = [r[0] for r, g in zip(rows, group, strict=True) if g == group[i] and r[0] is not None]
        out.append((row[0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def edited(text, seed, share):
    picker = random.Random(seed)
    words = text.split()
    for _ in range(int(len(words) * share)):
        words[picker.randrange(len(words))] = f"edit{picker.random()}"
    return " ".join(words)


def corpus():
    rows = []
    for base in range(6):
        text = prose(base, 150)
        rows += [(base * 20 + k, edited(text, k, share)) for k, share in enumerate(
            [0, 0, 0.01, 0.02, 0.03, 0.04, 0.06, 0.1])]
    shared = prose(99, 40)  # a passage that makes texts alike, but not enough
    rows += [(500 + k, prose(200 + k, 60) + " " + shared) for k in range(12)]
    return [(*r, None, None, None, None, None, None) for r in rows]


def found(df):
    return N.near_duplicates(df).select("id", "n_shingles", "component_id")


def test_components_equal_brute_force(spark, rows):
    made = corpus()
    assert rows(found(spark.createDataFrame(made, SCHEMA))) == components(made)


def test_awkward_rows(spark, rows):
    assert rows(found(awkward(spark))) == components(awkward_rows())


def test_one_row_of_each_component_stays(spark):
    made = [(i + 1000, *rest) for i, *rest in corpus()] + awkward_rows()
    df = spark.createDataFrame(made, SCHEMA)
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    worded = [r for r in kept.collect() if shingles(r.text)]
    want = {c for _, n, c in components(made) if n}
    assert sorted(r.doc_id for r in worded) == sorted(want)
    assert kept.count() - len(worded) == sum(not shingles(r[1]) for r in made)


def test_signatures_within_the_distance_share_a_key():
    random_ = np.random.default_rng(0)
    choices = N.chunk_choices()
    for _ in range(300):
        first = random_.integers(0, 1 << N.SYMBOL_BITS, N.SYMBOLS)
        second = first.copy()
        second[random_.permutation(N.SYMBOLS)[: N.MOST_DIFFERENCES]] += 1
        assert any(all(first[p] == second[p] for p in kept) for kept in choices)


def test_hot_group_makes_no_pairs_of_all(spark):
    text = prose(7, 120)
    rows = [(k, edited(text, k, 0.01), *[None] * 6) for k in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.component_id for r in found(df).collect()} == {0}


def test_all_pairs_of_other_components_in_a_bucket_are_compared(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 7)
    members = "struct<node:bigint,bits0:bigint,bits1:bigint>"
    buckets = [(5, (n, 0, 0)) for n in range(60)] + [(6, (n, 0, 0)) for n in (1, 2, 3, 59)]
    shared = spark.createDataFrame(buckets, f"key bigint, member {members}")
    # 40 to 49 are one component, 2 and 3 another.
    label = {n: n for n in range(60)} | {n: 40 for n in range(40, 50)} | {3: 2}
    labels = spark.createDataFrame(
        [(n, l) for n, l in label.items() if n in (2, 3) or 40 <= n < 50], "node bigint, label bigint"
    )
    # All signatures are equal, but that of 59 is far from the others.
    signature = lambda n: np.full(N.SYMBOLS, n == 59, np.uint16).tobytes()
    nodes = spark.createDataFrame([(n, signature(n)) for n in range(60)], "node bigint, signature binary")
    got = [tuple(r) for r in N._all_others(N._mixed(shared, labels), nodes).collect()]
    want = {(a, b) for b in range(59) for a in range(b) if label[a] != label[b]}
    assert len(got) == len(want) and set(got) == want


def test_large_group_of_differently_edited_copies(spark):
    words = prose(31, 100).split()
    rows = []
    for k in range(500):
        picker, copy = random.Random(k), list(words)
        for place in picker.sample(range(100), 3):
            copy[place] = f"edit{k}x{place}"
        rows.append((k, " ".join(copy), *[None] * 6))
    got = found(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == sorted(components(rows))


def test_pairs_listed_for_a_large_group_of_far_copies_do_not_grow_with_its_square(spark, monkeypatch):
    """No two of them are linked, but those nearest to one another, and all are near."""
    words, n = prose(41, 100).split(), 200
    rows = []
    for k in range(n):
        picker, copy = random.Random(k // 2), list(words)
        for place in picker.sample(range(100), 3):
            copy[place] = f"edit{k // 2}x{place}"
        rows.append((k, " ".join(copy + [f"end{k}"] * (k % 2)), *[None] * 6))
    listed, stage = [], N.stage

    def counted(df, label, *more):
        staged = stage(df, label, *more)
        if label in ("pairs", "links"):
            listed.append(staged.rows)
        return staged

    monkeypatch.setattr(N, "stage", counted)
    got = found(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in got) == sorted(components(rows))
    assert sum(listed) < 30 * n


def test_links_of_large_buckets_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(N, "LARGE_BUCKET", 2)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(N, "LARGE_BLOCK_ROWS", 5)
    made = corpus()
    assert rows(found(spark.createDataFrame(made, SCHEMA))) == components(made)


def test_common_counts_are_those_of_the_sets(monkeypatch):
    random_ = np.random.default_rng(5)
    for most, products in ((40, 7), (400, 4096)):
        monkeypatch.setattr(N, "PRODUCT_SHINGLES", products)
        ours, theirs = (
            [np.unique(random_.integers(0, most, random_.integers(1, 60)).astype(np.uint64)) for _ in range(n)]
            for n in (30, 45)
        )
        want = [[len(set(x.tolist()) & set(y.tolist())) for y in theirs] for x in ours]
        assert N.common_counts(ours, theirs).tolist() == want


def test_joining_links_join_what_all_links_join():
    random_ = np.random.default_rng(6)
    for _ in range(50):
        linked = random_.random((12, 15)) < 0.06
        ours, theirs = random_.integers(0, 9, 12), random_.integers(0, 9, 15)

        def joined(places, ours=ours, theirs=theirs):
            group = {n: n for n in range(9)}
            for i, j in places:
                old, new = group[ours[i]], group[theirs[j]]
                group = {n: new if g == old else g for n, g in group.items()}
            return {frozenset(n for n in group if group[n] == g) for g in group.values()}

        links = N.joining_links(linked, ours, theirs)
        assert all(linked[i, j] for i, j in links) and len(links) < 9
        assert joined(links) == joined(np.argwhere(linked).tolist())


def test_only_wanted_texts_are_hashed(spark, plan_of):
    docs = spark.createDataFrame([(i, prose(i, 20), *[None] * 6) for i in range(8)], SCHEMA)
    nodes = spark.createDataFrame([(i, bytes([i]), i) for i in range(8)], "node bigint, set_id binary, least bigint")
    pairs = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    plan = plan_of(N._bodies(docs, nodes, pairs, "text", "doc_id"))
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    # Parents stand before their children.
    assert plan.index("MapInArrow") < plan.index("LeftSemi")


def test_empty_table(spark):
    assert found(nothing(spark)).count() == 0
    assert N.keep_one(nothing(spark)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 260)]
    loop = [(300, 300)]
    links = spark.createDataFrame(path + star + loop + path, "a bigint, b bigint")
    got = {r.node: r.label for r in smallest_reachable(links).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 200 for i in range(200, 260)}}
