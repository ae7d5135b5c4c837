"""Raw order files and parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.operators.quality import content_digest
from lateline.schema import RAW_ENCODING
from lateline.sources.staging import COMPRESSION


@dataclass(frozen=True)
class RawFile:
    path: str
    size_bytes: int


def _files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Paths and sizes of files; their content is not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"nothing at {path}") from error
        raise


def find_csv(spark: SparkSession, folder: str) -> RawFile:
    """The one CSV file of a folder; an error if there is none or more than one."""
    found = _files(spark, folder, "*.csv").limit(2).collect()  # two are enough to refuse
    if not found:
        raise FileNotFoundError(f"no CSV file in {folder}")
    if len(found) > 1:
        names = ", ".join(row["path"] for row in found)
        raise ValueError(f"more than one CSV file in {folder}; name one explicitly: {names}")
    return RawFile(found[0]["path"], found[0]["length"])


def named_file(spark: SparkSession, path: str) -> RawFile:
    """An explicitly named file, of any name, or a folder or pattern of part files."""
    size = _files(spark, path).agg(F.sum("length")).first()[0]
    if size is None:
        raise FileNotFoundError(f"nothing at {path}")
    return RawFile(path, size)


def detect_encoding(spark: SparkSession, path: str) -> str:
    """``utf-8`` when every line of the file is valid UTF-8, else ``ISO-8859-1``."""
    lines = spark.read.text(path)
    broken = lines.where(~F.is_valid_utf8("value")).limit(1)
    return "utf-8" if broken.isEmpty() else RAW_ENCODING


def read_order_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer_schema: bool = False,
    encoding: str = RAW_ENCODING,
    multi_line: bool = False,
) -> DataFrame:
    """A raw order file with a header.

    Without a schema all columns are text, which the cleaning accepts; inferring types costs one
    more pass over the file. ``multi_line`` allows quoted line breaks, but such a file is read
    by a single task.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", multi_line)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer_schema).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(table: DataFrame, path: str, files: int | None = None) -> str:
    """Overwrite a parquet table; ``files`` fixes the file count of a small one."""
    (table if files is None else table.coalesce(files)).write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return path


def write_bucketed(table: DataFrame, name: str, buckets: int, key: str = "order_id") -> str:
    """Overwrite a catalog table bucketed by order, from which roll-ups need no large shuffle.

    Rows are shuffled by the key first, so that a bucket is one file and not one of each task.
    All lines of one order meet in one bucket: for tables in which no order id, and no absent
    id, holds a large share of the lines. Otherwise use ``write_table``.
    """
    writer = table.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return name


def write_counted(table: DataFrame, path: str) -> int:
    """Overwrite a parquet table and return the rows of its source, counted before.

    Not observed on the way: an observation stays with the session, which models of Spark ML then cannot be sent to tasks with.
    """
    rows = table.count()
    write_table(table, path)
    return rows


def land(raw: DataFrame, path: str, by_content: bool = False) -> int:
    """Store a raw table as it is; an error unless all rows read are in the stored files.

    With ``by_content`` their values are compared too: a digest of the raw table against one of the stored
    files; both are read once more for it. Otherwise only rows are counted.
    """
    if by_content:
        return _land_by_content(raw, path)
    expected, stored = write_counted(raw, path), read_table(raw.sparkSession, path).count()
    if expected != stored:
        raise RuntimeError(f"{stored} rows stored in {path}, {expected} expected")
    return stored


def _land_by_content(raw: DataFrame, path: str) -> int:
    taken = content_digest(raw).first()
    write_table(raw, path)
    return check_content(read_table(raw.sparkSession, path), taken["row_count"], taken["content"])


def check_content(table: DataFrame, rows: int, content: str | None) -> int:
    """The rows of a stored table; an error unless they and their values are the expected ones."""
    stored = content_digest(table).first()
    if (stored["row_count"], stored["content"]) != (rows, content):
        raise RuntimeError(f"stored content {tuple(stored)}, {(rows, content)} expected")
    return stored["row_count"]
