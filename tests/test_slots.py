"""Keyed tables in hash slots."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.sinks import read_keys, reslot, slots_for, upsert_slotted_table

DDL = "a int, b string, v int"


def make(spark, ids, v):
    return spark.createDataFrame([(i, f"k{i % 3}", v) for i in ids], DDL)


def folders(path):
    return {str(p) for p in path.rglob("part-*")}


def test_a_batch_rewrites_its_slots_only(spark, tmp_path, rows):
    place = ("slotted", str(tmp_path / "t"), 16, ["a", "b"], ["v"], [])
    upsert_slotted_table(make(spark, range(200), 1), *place)
    before = folders(tmp_path / "t")
    upsert_slotted_table(make(spark, [5, 500], 2), *place)
    new = folders(tmp_path / "t") - before
    assert 1 <= len({p.split("_slot=")[1].split("/")[0] for p in new}) <= 2
    stored = spark.table("slotted").drop("_slot")
    want = [(i, f"k{i % 3}", 2 if i in (5, 500) else 1) for i in [*range(200), 500]]
    assert rows(stored) == sorted(want, key=repr)


def test_reading_keys_reads_their_slots(spark, tmp_path, rows):
    upsert_slotted_table(make(spark, range(100), 1), "slotted_read", str(tmp_path / "t"), 16, ["a", "b"], ["v"], [])
    wanted = spark.createDataFrame([(7, "k1"), (8, "k0"), (999, "k0")], "a int, b string")
    found = read_keys(spark, "slotted_read", wanted)
    assert rows(found) == [(7, "k1", 1)]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_slot" in scan
    empty = read_keys(spark, "slotted_read", wanted.limit(0), broadcast_bytes=0)
    assert rows(empty) == []


def test_slots_and_keys_stay_with_the_table(spark, tmp_path):
    upsert_slotted_table(make(spark, range(9), 1), "slotted_kept", str(tmp_path / "t"), 4, ["a", "b"], ["v"], [])
    for slots, keys in ((5, ["a", "b"]), (4, ["a"])):
        with pytest.raises(ValueError, match="slots"):
            upsert_slotted_table(make(spark, [1], 2), "slotted_kept", str(tmp_path / "t"), slots, keys, ["v"], [])
    spark.range(1).write.mode("overwrite").saveAsTable("no_slots")
    with pytest.raises(ValueError, match="not kept in slots"):
        reslot(spark, "no_slots", "other", str(tmp_path / "u"), 2)


def test_reslot(spark, tmp_path, rows):
    upsert_slotted_table(make(spark, range(50), 1), "slotted_old", str(tmp_path / "t"), 2, ["a", "b"], ["v"], [])
    reslot(spark, "slotted_old", "slotted_new", str(tmp_path / "u"), 8)
    assert rows(spark.table("slotted_new").drop("_slot")) == rows(spark.table("slotted_old").drop("_slot"))
    assert spark.table("slotted_new").agg(F.max("_slot")).first()[0] > 1


def test_slots_for():
    assert (slots_for(0), slots_for(128 * 1024 * 1024), slots_for(10**12)) == (1, 1, 7451)
