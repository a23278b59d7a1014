from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import (
    MissingMetadataError,
    cast_to_schema,
    catalog_to_struct,
    catalog_type,
    rewrite_path_scheme,
    rewrite_uri_scheme,
)
from millrace.sinks import upsert_partitioned_table
from millrace.sources import catalog_scan, table_metadata


def metadata(*columns, location=None, partition_keys=()):
    descriptor = {"Columns": list(columns)}
    if location is not None:
        descriptor["Location"] = location
    return {"Table": {"StorageDescriptor": descriptor, "PartitionKeys": list(partition_keys)}}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("string", T.StringType()),
        ("int", T.IntegerType()),
        ("bigint", T.LongType()),
        ("double", T.DoubleType()),
        ("float", T.FloatType()),
        ("boolean", T.BooleanType()),
        ("timestamp", T.TimestampType()),
        ("date", T.DateType()),
        ("binary", T.BinaryType()),
        ("decimal", T.DecimalType(10, 0)),
        ("array", T.ArrayType(T.StringType())),
        ("map", T.MapType(T.StringType(), T.StringType())),
        ("struct", T.StructType()),
        ("decimal(12,2)", T.DecimalType(12, 2)),
        ("array<int>", T.ArrayType(T.IntegerType())),
        ("map<string,array<double>>", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
        ("struct<a:int,b:string>", T.StructType().add("a", "integer").add("b", "string")),
        ("smallint", T.ShortType()),
        ("tinyint", T.ByteType()),
        ("BIGINT", T.LongType()),
        ("char(3)", T.StringType()),
        ("varchar(10)", T.StringType()),
        ("array<varchar(3)>", T.ArrayType(T.StringType())),
        ("struct<a:char(2),b:map<string,varchar(4)>>", T.StructType().add("a", "string").add(
            "b", T.MapType(T.StringType(), T.StringType()))),
        ("uniontype<int,string>", T.StringType()),
        ("a int, b int", T.StringType()),
        ("", T.StringType()),
        (None, T.StringType()),
    ],
)
def test_catalog_type(spark, text, expected):
    assert catalog_type(text) == expected


def test_missing_type_and_partition_columns(spark):
    described = metadata({"Name": "a"}, partition_keys=[{"Name": "day", "Type": "date"}])
    assert catalog_to_struct(described) == T.StructType().add("a", "string").add("day", "date")


@pytest.mark.parametrize(
    "document", [None, {}, {"Table": {}}, {"Table": {"StorageDescriptor": {}}}, metadata()]
)
def test_missing_metadata_raises(spark, document):
    with pytest.raises(MissingMetadataError):
        catalog_to_struct(document)


def test_missing_location_raises(spark):
    with pytest.raises(MissingMetadataError, match="Location"):
        catalog_scan(spark, metadata({"Name": "a"}))


def test_unknown_table_raises(spark):
    with pytest.raises(MissingMetadataError, match="no_such_table"):
        table_metadata(spark, "no_such_table")


def test_partitioned_table_by_metadata(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, part string")
    df.write.partitionBy("part").option("path", str(tmp_path / "t")).saveAsTable("by_part")
    described = table_metadata(spark, "by_part")
    assert described["Table"]["PartitionKeys"] == [{"Name": "part", "Type": "string"}]
    assert rows(catalog_scan(spark, described)) == [(1, "x"), (2, "y")]


def test_partitions_that_an_upsert_moved_are_scanned_where_they_lie(spark, rows, tmp_path):
    ddl = "a int, part string, v int"
    place = ("moved_parts", str(tmp_path / "t"), ["part"], ["part", "a"], ["v"], [])
    upsert_partitioned_table(spark.createDataFrame([(1, "x", 1), (2, "y", 1)], ddl), *place)
    upsert_partitioned_table(spark.createDataFrame([(1, "x", 2), (3, "z", 2)], ddl), *place)
    described = table_metadata(spark, "moved_parts")
    got = catalog_scan(spark, described)
    assert got.columns == ["a", "v", "part"]
    assert rows(got) == [(1, 2, "x"), (2, 1, "y"), (3, 2, "z")]


def test_partitions_of_a_document_may_lie_anywhere(spark, rows, tmp_path):
    keys = [{"Name": "day", "Type": "date"}, {"Name": "n", "Type": "int"}]
    document = metadata({"Name": "a", "Type": "int"}, partition_keys=keys)
    places = ["new/day=2024-01-01/n=1", "old/day=2024-01-02/n=2", "elsewhere", "new/day=2024-01-01/n=9"]
    values = [["2024-01-01", "1"], ["2024-01-02", "2"], ["2024-01-03", "3"]]
    for i, place in enumerate(places):
        spark.createDataFrame([(i,)], "a int").write.parquet(str(tmp_path / place))
    document["Partitions"] = [
        {"Values": v, "StorageDescriptor": {"Location": str(tmp_path / p)}}
        for v, p in zip(values, places, strict=False)
    ]
    got = rows(catalog_scan(spark, document))
    assert [(a, str(day), n) for a, day, n in got] == [
        (0, "2024-01-01", 1), (1, "2024-01-02", 2), (2, "2024-01-03", 3)]
    document["Partitions"] = []
    assert rows(catalog_scan(spark, document)) == []
    document["Partitions"] = [{"Values": ["2024-01-01", "1"], "StorageDescriptor": {}}]
    with pytest.raises(MissingMetadataError, match="Location"):
        catalog_scan(spark, document)


def test_cast_to_schema(spark, rows):
    df = spark.createDataFrame(
        [("1", "2.50", "[1,2]", "x"), ("abc", None, "no", "y")],
        "a string, b string, c string, other string",
    )
    schema = T.StructType.fromDDL("b decimal(10,2), a int, c array<int>, missing date")
    result = cast_to_schema(df, schema)
    assert [f.dataType for f in result.schema] == [f.dataType for f in schema]
    assert [tuple(r) for r in result.select("a", "c", "missing").collect()] == [
        (1, [1, 2], None),
        (None, None, None),
    ]


@pytest.mark.parametrize(
    ("uri", "expected"),
    [
        ("s3://b/k", "s3a://b/k"),
        ("s3://b/s3://k", "s3a://b/s3://k"),
        ("s3a://b/k", "s3a://b/k"),
        ("hdfs://b/s3://k", "hdfs://b/s3://k"),
        ("S3://b", "S3://b"),
        ("", ""),
    ],
)
def test_uri_scheme(spark, uri, expected):
    assert rewrite_path_scheme(uri) == expected
    df = spark.createDataFrame([(uri,)], "u string")
    assert df.select(rewrite_uri_scheme(F.col("u"))).first()[0] == expected


def test_uri_scheme_of_null(spark):
    df = spark.createDataFrame([(None,)], "u string")
    assert df.select(rewrite_uri_scheme(F.col("u"))).first()[0] is None
