"""Scans with contracts, CSV with broken lines, partitions by folder, manifests of files."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlark.sources import tables


def test_contract(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3)], "a int, b float, c string, d long")
    got = tables.contract(df, "c string, b double, a long")
    assert got.dtypes == [("c", "string"), ("b", "double"), ("a", "bigint")] and tuple(got.first()) == ("x", 2.0, 1)
    with pytest.raises(ValueError, match="missing columns: e"):
        tables.contract(df, "a int, e int")
    with pytest.raises(ValueError, match="d is bigint, not int; c is string, not date"):
        tables.contract(df, "d int, c date, a int")


def test_csv_with_broken_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v,w\n1,2.5,x\n2,zz,y\n3\n4,1.0,"a, b"\n5,1.0,q,more\n,,\n')
    lines = tables.scan_csv(spark, str(tmp_path), "k int, v double, w string")
    good, bad = tables.csv_rows(lines)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2.5, "x"), (4, 1.0, "a, b"), (None, None, None)]
    assert sorted(r[0] for r in bad.collect()) == ["2,zz,y", "3", "5,1.0,q,more"] and bad.count() == 3 and good.count() == 3 and sorted(r[0] for r in good.select("k").where("k > 0").collect()) == [1, 4]
    assert tables.csv_quality(lines).first().asDict() == {"n_lines": 6, "n_bad": 3, "k_nulls": 1, "v_nulls": 1, "w_nulls": 1}


def test_partitions_by_folder_become_known(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40).select(F.col("id").alias("v"), (F.col("id") % 3).cast("string").alias("p"), F.format_string("%02d", F.col("id") % 2).alias("q"))
    tables.overwrite_partitions(rows, path, ["p", "q"])
    spark.sql(f"CREATE TABLE part_t (v BIGINT, p STRING, q STRING) USING parquet PARTITIONED BY (p, q) LOCATION '{path}'")
    try:
        assert spark.table("part_t").count() == 0
        assert tables.add_partitions(spark, "part_t", path, ["p", "q"], at_once=4) == 6 and spark.table("part_t").count() == 40
        assert tables.add_partitions(spark, "part_t", path, ["p", "q"]) == 0
        tables.overwrite_partitions(rows.withColumn("p", F.lit("9")), path, ["p", "q"])
        assert tables.add_partitions(spark, "part_t", path, ["p", "q"]) == 2 and tables.scan(spark, "part_t", ["v"]).count() == 80
    finally:
        spark.sql("DROP TABLE part_t")


def test_manifest_equals_the_file_system(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "m")
    tables.overwrite_partitions(spark.range(1000).select(F.col("id").alias("v"), F.col("id").cast("string").alias("text"), (F.col("id") % 3).alias("p")), path, ["p"])
    files = spark.read.parquet(path)
    tables.write_manifest(files, out, ["p"])
    got = [json.loads(line) for f in Path(out).glob("part-*") for line in f.read_text().splitlines()]
    there = {str(f): os.stat(f).st_size for f in Path(path).rglob("*.parquet")}
    assert {m["path"].removeprefix("file:").replace("///", "/"): m["bytes"] for m in got} == there and sum(m["n_rows"] for m in got) == 1000 and {m["p"] for m in got} == {0, 1, 2} and all(m["modified"] for m in got)
    plan = tables.file_manifest(files, ["p"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_work_folder_is_in_the_shared_one(spark):
    assert tables.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
