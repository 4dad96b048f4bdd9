"""Reading and writing tables: scans, sinks, replacement by key, trackers, partitions, manifests.

Parquet tables know no MERGE or DELETE. A replacement is written next to the old files and made current by one numbered commit
file, which appears whole or not at all, so readers see either the old table or the new one.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import require_columns


def contract(df: DataFrame, schema: str) -> DataFrame:
    """The columns of `schema` (DDL), in its order and with its types. A column that is missing, or whose values the wanted type may
    not hold, is an error that names all such; numbers may only widen."""
    wanted, have = StructType.fromDDL(schema), {f.name: f.dataType.simpleString() for f in df.schema}
    require_columns(df, wanted.names)
    wider = {("tinyint", x) for x in ("smallint", "int", "bigint", "float", "double")} | {("smallint", x) for x in ("int", "bigint", "float", "double")} | {("int", "bigint"), ("int", "double"), ("float", "double"), ("date", "timestamp")}
    wrong = [f"{f.name} is {have[f.name]}, not {f.dataType.simpleString()}" for f in wanted if have[f.name] != f.dataType.simpleString() and (have[f.name], f.dataType.simpleString()) not in wider]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*(F.col(f.name).cast(f.dataType) for f in wanted))


def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None, schema: str | None = None) -> DataFrame:
    """A catalog table, or a Parquet folder if the name has a slash, whose partition folders are columns. columns: only these;
    schema: what they must be."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if schema:
        return contract(df, schema)
    return require_columns(df, columns).select(*columns) if columns else df


#: Column of the whole line where a CSV line doesn't fit the schema.
BAD_LINE = "bad_line"


def scan_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV files by a schema, and bad_line: the line as it stands where it has too few or too many fields or one that isn't of its
    type, else null. No line is dropped; csv_rows() tells good from bad. Every field is parsed, whatever columns are asked for: a line
    is bad or not by all of them."""
    df = spark.read.schema(f"{schema}, {BAD_LINE} string").option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    # the parser converts only fields that are asked for, and a null test on the bad line would reach it before there is one: so the
    # column depends on every field, and on no null
    every = F.length(F.concat_ws("", *(F.col(c).cast("string") for c in df.columns if c != BAD_LINE))) >= 0
    return df.withColumn(BAD_LINE, F.nullif(F.when(every, F.coalesce(BAD_LINE, F.lit(""))), F.lit("")))


def csv_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of scan_csv()."""
    return lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE), lines.where(F.col(BAD_LINE).isNotNull()).select(BAD_LINE)


def csv_quality(lines: DataFrame) -> DataFrame:
    """One row about scan_csv(): n_lines, n_bad, and by field {field}_nulls among the good lines."""
    good = F.col(BAD_LINE).isNull()
    nulls = [F.count_if(good & F.col(c).isNull()).alias(f"{c}_nulls") for c in lines.columns if c != BAD_LINE]
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(~good).alias("n_bad"), *nulls)


def local_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def append(df: DataFrame, table: str) -> None:
    """Appends by column name; creates the table on the first write."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        columns = spark.table(table).columns
        require_columns(df, columns).select(*columns).write.mode("append").insertInto(table)
    else:
        df.write.saveAsTable(table)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replaces the partitions df has rows for and leaves all others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def overwrite_table_partitions(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same for a catalog table, by column name; creates it on the first write. Columns the table doesn't have are an error,
    so is a table that isn't partitioned by `keys`; an empty df replaces nothing."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.partitionBy(*keys).saveAsTable(table)
        return
    own = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if sorted(own) != sorted(keys):
        raise ValueError(f"{table} is partitioned by {', '.join(own) or 'nothing'}, not by {', '.join(keys)}")
    columns = spark.table(table).columns
    if extra := sorted(set(df.columns) - set(columns)):
        raise ValueError(f"{table} has no columns {', '.join(extra)}")
    rows = require_columns(df, columns).select(*columns)
    mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto reads the session's, not the writer's, and static would empty the table
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)


def union_with_missing(*frames: DataFrame) -> DataFrame:
    """All rows of the frames by column name; a column that a frame doesn't have is null in its rows. No frame is an error."""
    if not frames:
        raise ValueError("no frames")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def drop_partition(spark: SparkSession, table: str, **values: str) -> bool:
    """Drops a partition; False if there is no such table."""
    if not spark.catalog.tableExists(table):
        return False
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    return True


def create_table(spark: SparkSession, name: str, schema, partitions: Sequence[str]) -> None:
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.partitionBy(*partitions).saveAsTable(name)


def partitions_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partitions that a folder's names tell; of the files no column is read."""
    return df.select(*keys).distinct()


def add_partitions(spark: SparkSession, table: str, path: str, keys: Sequence[str], at_once: int = 200) -> int:
    """Makes partition folders under `path`, key=value by key, known to a catalog table that doesn't have them yet; how many there
    were. Only values of keys reach the driver; the catalog has one entry for each anyway."""
    folders = partitions_of(spark.read.schema(", ".join(f"{k} string" for k in keys)).parquet(path), keys)
    have = spark.sql(f"SHOW PARTITIONS {table}").select(*(F.regexp_extract("partition", rf"(?:^|/){k}=([^/]*)", 1).alias(k) for k in keys))
    new = folders.join(have, list(keys), "left_anti").collect()
    for k in range(0, len(new), at_once):
        specs = [", ".join(f"{c} = '{r[c]}'" for c in keys) for r in new[k : k + at_once]]
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({x}) LOCATION '{path}/{'/'.join(f'{c}={r[c]}' for c in keys)}'" for x, r in zip(specs, new[k : k + at_once])))
    return len(new)


def replaced(old: DataFrame, new: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """old without the rows of `keys`, and new: delete and append in one frame. A key without new rows is gone afterwards."""
    return old.join(keys.select(*on).distinct(), list(on), "left_anti").unionByName(new)


class Conflict(RuntimeError):
    """Another writer committed first."""


class VersionedTable:
    """A Parquet table under one folder: data folders that are written once, and commits 1, 2, ... that name the data folders of
    every bucket. The highest commit is current; a write is based on the commit it read, and fails if that isn't the last
    any more. With `by`, rows lie in buckets by a hash of these columns, and an upsert on them rewrites the touched buckets only.
    """

    def __init__(self, spark: SparkSession, path: str, schema, by: Sequence[str] = (), buckets: int = 64):
        self.spark, self.path, self.schema, self.by, self.buckets = spark, path.rstrip("/"), schema, list(by), buckets if by else 1
        jvm = spark._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._at(self.path).getFileSystem(self._conf)

    def _commits(self) -> list[int]:
        folder = self._at(f"{self.path}/commits")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """Number of the current commit, 0 for a table that was never written. Data without a commit beside it is an error: the
        first write failed if there is nothing else, but an empty answer would make the next write lose what is there."""
        numbers = self._commits()
        if not numbers and self._fs.exists(self._at(f"{self.path}/commits")):
            raise RuntimeError(f"{self.path}: commits are missing")
        return numbers[-1] if numbers else 0

    def _folders(self, version: int) -> dict[str, list[str]]:
        if not version:
            return {}
        return json.loads(self.spark.read.text(f"{self.path}/commits/{version:012d}.json", wholetext=True).first()[0])

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self, version: int | None = None) -> DataFrame:
        held = self._folders(self.version() if version is None else version)
        return self._rows(sorted(f for fs in held.values() for f in fs))

    def fitted(self, df: DataFrame) -> DataFrame:
        """df with the table's columns and types."""
        fields = self.spark.createDataFrame([], self.schema).schema.fields
        return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int") if self.by else F.lit(0)

    def _put(self, df: DataFrame) -> dict[str, list[str]]:
        """Writes rows as new data folders, by bucket."""
        name = f"data/{uuid.uuid4().hex}"
        rows = self.fitted(df).withColumn("__bucket", self._bucket())
        (rows.repartition("__bucket") if self.by else rows).write.partitionBy("__bucket").parquet(f"{self.path}/{name}")
        found = [f.getPath().getName() for f in self._fs.listStatus(self._at(f"{self.path}/{name}"))]
        return {f.split("=")[1]: [f"{name}/{f}"] for f in found if f.startswith("__bucket=")}

    def _commit(self, number: int, folders: dict[str, list[str]]) -> None:
        """The commit file is written aside and renamed, which fails if there is one of that number."""
        self._fs.mkdirs(self._at(f"{self.path}/commits"))
        aside, final = self._at(f"{self.path}/commits/.{uuid.uuid4().hex}"), self._at(f"{self.path}/commits/{number:012d}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(final), self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{self.path}: commit {number} is there already") from e
            raise

    def write(self, df: DataFrame, base: int | None = None) -> None:
        """Replaces the whole table; base: the version df was made from, the current one if it is left out."""
        base = self.version() if base is None else base
        self._commit(base + 1, self._put(df))

    def upsert(self, new: DataFrame, keys: DataFrame, on: Sequence[str]) -> None:
        """Replaces all rows of `keys` by new. On the columns of `by` only the buckets of keys and new rows are rewritten."""
        base = self.version()
        held = self._folders(base)
        if not self.by or list(on) != self.by:
            self.write(replaced(self.read(base), self.fitted(new), keys, on), base)
            return
        types = {f.name: f.dataType for f in self.spark.createDataFrame([], self.schema).schema.fields}
        keys = keys.select(*(F.col(c).cast(types[c]).alias(c) for c in on))
        touched = keys.select(self._bucket().alias("b")).unionByName(self.fitted(new).select(self._bucket().alias("b"))).distinct().collect()
        touched = {str(r["b"]) for r in touched}  # at most as many as there are buckets
        old = self._rows(sorted(f for b, fs in held.items() if b in touched for f in fs))
        self._commit(base + 1, {b: fs for b, fs in held.items() if b not in touched} | self._put(replaced(old, self.fitted(new), keys, on)))


def append_run_audit(spark: SparkSession, table: str, merchants: Sequence[str], start: datetime, end: datetime) -> None:
    """One SUCCESS row a merchant of a run with its times in seconds; no merchants, no rows and no table."""
    if merchants:
        took = round((end - start).total_seconds(), 2)
        append(spark.createDataFrame([(m, start, end, took, "SUCCESS") for m in merchants], "merchant_id string, start_dt timestamp, end_dt timestamp, time_taken double, status string"), table)


def merged(tracker: DataFrame, change: DataFrame, key: str, updated: Sequence[str]) -> DataFrame:
    """A tracker after a change: rows whose trimmed key the change has get its values in `updated`, new keys are added whole."""
    c = change.select(F.trim(key).alias("__key"), *(F.col(u).alias(f"__{u}") for u in updated))
    kept = tracker.join(c, F.trim(tracker[key]) == c["__key"], "left")
    kept = kept.select(*(F.when(F.col("__key").isNotNull(), F.col(f"__{x}")).otherwise(F.col(x)).alias(x) if x in updated else F.col(x) for x in tracker.columns))
    fresh = change.join(tracker.select(F.trim(key).alias("__known")).distinct(), F.trim(change[key]) == F.col("__known"), "left_anti")
    return kept.unionByName(fresh.select(*tracker.columns))


def already_processed(tracker: DataFrame, file_id: str) -> bool:
    """Whether a file has a state other than FAILED; one left in progress counts, a null state doesn't."""
    return not tracker.where((F.col("file_id") == file_id) & (F.col("status") != "FAILED")).isEmpty()


def manifest(rows: DataFrame, table: str, root: str) -> DataFrame:
    """One row a written (region, day): where it is and how many rows it has."""
    return rows.groupBy("dw_merch_region_cd", "process_date").agg(F.count("*").alias("n_rows")).select(
        F.concat_ws("_", F.lit(table), "process_date").alias("name"), F.format_string(f"{root}/{table}/dw_merch_region_cd=%s/process_date=%s", "dw_merch_region_cd", "process_date").alias("path"), "n_rows")


def file_manifest(files: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row a file of a scanned Parquet folder: its partition, path, size in bytes, time of change, and rows. No column but
    partition values is read; Spark counts rows by the files' footers."""
    m = F.col("_metadata")
    rows = files.select(*keys, m["file_path"].alias("path"), m["file_size"].alias("bytes"), m["file_modification_time"].alias("modified"))
    return rows.groupBy(*keys, "path", "bytes", "modified").agg(F.count("*").alias("n_rows"))


def write_manifest(files: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """file_manifest() as JSON lines in a folder of its own."""
    file_manifest(files, keys).coalesce(1).write.mode("overwrite").json(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that spark.checkpoint.dir names, which all executors share; where it is unset, one of this machine,
    but only with a local master. It is deleted when the session ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset; on a cluster it has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlark-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path
