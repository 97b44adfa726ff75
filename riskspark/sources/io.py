"""Sources and sinks (S1-S8): plain DataFrameReader / DataFrameWriter."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a scale-factor folder."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Pass a schema on large inputs; inference reads
    the data twice."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet table, optionally partitioned (S4 uses
    ``split``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header (risk table, fitted medians)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Long-format report as JSON lines."""
    df.write.mode("overwrite").json(path)


def save_state(state: DataFrame, path: str) -> None:
    """Fitted statistics (feature, stat, value) as Parquet."""
    state.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    """The Hadoop path and its file system; works for local, HDFS and object stores."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _fs(spark, path)
    return bool(fs.exists(jpath))


def file_marks(spark: SparkSession, path: str) -> list[list]:
    """Name, size and time of change of each data file below a folder (or of one file): two
    listings are equal if the table was not written in between."""
    jpath, fs = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    out, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
    return sorted(out)


#: Names the version of a table that counts, and what it was made from.
MANIFEST = "_manifest.json"


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    jpath, fs = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all: written beside, then renamed."""
    target, fs = _fs(spark, path)
    beside = _fs(spark, f"{path}-{uuid.uuid4().hex}")[0]
    stream = fs.create(beside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    whole = [p.makeQualified(fs.getUri(), fs.getWorkingDirectory()) for p in (beside, target)]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole[0].toUri(), conf).rename(*whole, how)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    name = f"{path.rstrip('/')}/{MANIFEST}"
    return json.loads(read_text(spark, name)) if path_exists(spark, name) else None


def commit_table(df: DataFrame, path: str, inputs: list[str] | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """S3 / S8 as a transaction: the table is written beside earlier versions, in a folder of
    its own, and counts from the moment the manifest that names it replaces the old one.
    A write that breaks off leaves the earlier version as it was; readers of that
    version keep its files.  The manifest holds the marks of ``inputs`` from before
    the write, and of the files written."""
    spark, root = df.sparkSession, path.rstrip("/")
    marks = {i: file_marks(spark, i) for i in inputs or []}
    version = f"version-{uuid.uuid4().hex}"
    write_parquet(df, f"{root}/{version}", partition_by)
    manifest = {"version": version, "inputs": marks, "files": file_marks(spark, f"{root}/{version}")}
    write_text(spark, f"{root}/{MANIFEST}", json.dumps(manifest))
    return spark.read.parquet(f"{root}/{version}")


def committed(spark: SparkSession, path: str, inputs: list[str] | None = None) -> DataFrame | None:
    """The table that counts at a folder; None if none was committed, if its files are not
    those that were written, or if ``inputs`` are not those that it was made from."""
    root, manifest = path.rstrip("/"), read_manifest(spark, path)
    if manifest is None or file_marks(spark, f"{root}/{manifest['version']}") != manifest["files"]:
        return None
    if {i: file_marks(spark, i) for i in inputs or []} != manifest["inputs"]:
        return None
    return spark.read.parquet(f"{root}/{manifest['version']}")


def materialize(spark: SparkSession, build: Callable[[], DataFrame], path: str, rebuild: bool = False,
                partition_by: list[str] | None = None, inputs: list[str] | None = None) -> DataFrame:
    """Reuse a committed intermediate table unless ``rebuild``, or unless the files of
    ``inputs`` (folders or files that ``build`` reads) have changed since.

    The table is written once and read back, which also cuts the lineage of
    the expensive plan that produced it.
    """
    found = None if rebuild else committed(spark, path, inputs)
    return commit_table(build(), path, inputs, partition_by) if found is None else found
