"""Written intermediate tables in the folder the cluster shares.

A staged table is read back by several later steps: its plan runs once, and a lost executor
costs a re-read instead of a re-run.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the checkpoint folder set on the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return folder


#: Of stored and staged tables: smaller files than by Spark's default, for little more work.
COMPRESSION = "zstd"

#: Lists that note what is being staged.
_noting: list[list[str]] = []


def _new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/staged-{name}-{uuid4().hex}"
    for noted in _noting:
        noted.append(path)
    return path


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of what is staged meanwhile, for ``discard`` once everything that reads them is written."""
    paths: list[str] = []
    _noting.append(paths)
    try:
        yield paths
    finally:
        _noting[:] = [other for other in _noting if other is not paths]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables. No table that still reads them may be in use."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(settings).delete(place, True)


def stage(table: DataFrame, name: str) -> DataFrame:
    """Write the table under a new name in the shared folder, and read it from there."""
    path = _new_path(table.sparkSession, name)
    table.write.parquet(path, compression=COMPRESSION)
    return table.sparkSession.read.parquet(path)


def stage_buckets(table: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same, in so many buckets by a hash of the key: a join by it does not shuffle the table again.

    Rows are written from where they are. Unless few have a task each, they should be dealt out by the key before, so that
    a bucket is one file and not one of each task.
    """
    spark = table.sparkSession
    entry, path = f"{name.replace('-', '_')}_{uuid4().hex}", _new_path(spark, name)
    table.write.format("parquet").option("compression", COMPRESSION).bucketBy(buckets, key).option("path", path).saveAsTable(entry)
    stored = spark.table(entry)
    spark.sql(f"drop table {entry}")  # the files of an external table stay
    return stored
