"""Readers and writers: line-delimited JSON, CSV, text, and tables as Parquet folders."""

from __future__ import annotations

import ast
import json
import time
import uuid

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from bibweave.scratch import Scratch

#: Rows in a file of the batched JSON writer.
BATCH_ROWS = 1_000_000
#: Tables up to this size are dealt anew to give every core work.
SMALL_BYTES = 64 << 20
#: Files whose row counts may be broadcast: some 20 MB.
MOST_FILES = 100_000


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def spread(table: DataFrame, small: int = SMALL_BYTES) -> DataFrame:
    """A table of at most ``small`` bytes in fewer files than there are cores, with its rows dealt to all of these; others as they are.

    For costly work on each row: a small file of one row group is one task,
    however many cores there are. Never more than ``small`` bytes are shuffled.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    held = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return table.repartition(cores) if held <= small and len(table.inputFiles()) < cores else table


def numbered_rows(df: DataFrame, out: str, scratch: Scratch | None = None) -> DataFrame:
    """Adds ``out``: 0, 1, ... in the order in which files list the rows of ``df``.

    A row keeps its number whenever it is read again. Files follow each other in
    the order of the partitions that wrote them, so what a sorted table was
    sorted by is the order of these numbers. What is no plain read of files is
    written first. An input column of that name is replaced.
    """
    names = [c for c in df.columns if c != out]
    own = uuid.uuid4().hex  # names that no input column has
    here, row, path = f"h{own}", f"r{own}", f"p{own}"
    try:
        at = df.select(*(F.col(f"`{c}`") for c in names), F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    except AnalysisException:
        return numbered_rows((scratch or Scratch(df.sparkSession)).save(df), out)
    name = F.substring_index(path, "/", -1)
    part = lambda pattern: F.when(name.rlike(pattern), F.regexp_extract(name, pattern, 1).cast("long"))
    every = Window.partitionBy(F.lit(0)).orderBy(part("^part-([0-9]+)"), part("-c([0-9]+)[.]"), path)
    # one row for each file; rows of a file are numbered by the reader
    files = at.groupBy(path).agg(F.count(F.lit(1)).alias("n"))
    files = files.select(path, F.coalesce(F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(here))
    few = files.limit(MOST_FILES + 1).count() <= MOST_FILES
    return at.join(F.broadcast(files) if few else files, path).select(*(F.col(f"`{c}`") for c in names), (F.col(here) + F.col(row)).alias(out))


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object per line, whatever the files of the folder are called; the schema is given, never inferred."""
    return spark.read.schema(schema).json(path)


@F.pandas_udf(StringType())
def _as_json(lines: pd.Series) -> pd.Series:
    def one(line: str | None) -> str | None:
        try:
            return json.dumps(ast.literal_eval(line)) if line is not None else None
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return lines.map(one)


def read_literals(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One dictionary per line, written as a Python literal (single quotes, None, True); a line that is none gives nulls."""
    return spark.read.text(path).select(F.from_json(_as_json("value"), schema).alias("r")).select("r.*")


def write_json(df: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> None:
    """Line-delimited JSON, replaced as a whole, with a bounded number of rows in each file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", batch_rows).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def read_manual_groups(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the header manual_id, orig_id -> its distinct pairs."""
    return spark.read.option("header", True).schema("manual_id string, orig_id string").csv(path).distinct()


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file that says that what it stands for is done."""
    at, fs = _fs(spark, path)
    fs.mkdirs(at.getParent())
    fs.create(at, True).close()


def unmark(spark: SparkSession, path: str) -> None:
    remove(spark, path)


def wait_for(spark: SparkSession, path: str, timeout: float, every: float = 1.0) -> None:
    """Returns once the mark is there; TimeoutError if it isn't after ``timeout`` seconds."""
    until = time.monotonic() + timeout
    while not exists(spark, path):
        if time.monotonic() >= until:
            raise TimeoutError(path)
        time.sleep(every)


def overwrite_table(df: DataFrame, path: str, description: str | None = None, comments: dict[str, str] | None = None) -> DataFrame:
    """Replaces the table at ``path``, also one that ``df`` reads: the new one is written beside it, then takes its name.

    ``comments`` (by column) and ``description`` are kept in the columns' metadata.
    """
    spark = df.sparkSession
    notes = {c: {"comment": t} for c, t in (comments or {}).items() if c in df.columns}
    if description and df.columns:
        notes[df.columns[0]] = notes.get(df.columns[0], {}) | {"table_comment": description}
    for c, note in notes.items():
        df = df.withMetadata(c, note)
    fresh, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.parquet(fresh)
    target, fs = _fs(spark, path)
    held = fs.exists(target)
    fs.mkdirs(target.getParent())
    if held and not fs.rename(target, _fs(spark, old)[0]):
        raise OSError(f"{path} can't be moved")
    if not fs.rename(_fs(spark, fresh)[0], target):
        raise OSError(f"{fresh} can't take the name {path}")
    if held:
        remove(spark, old)
    return spark.read.parquet(path)


def copy_table(spark: SparkSession, source: str, target: str, **notes) -> DataFrame:
    return overwrite_table(spark.read.parquet(source), target, **notes)


def snapshot(spark: SparkSession, source: str, backups: str, date: str) -> DataFrame:
    """Copies a table to ``{backups}/{its name}_{date as YYYYMMDD}``."""
    name = source.rstrip("/").rsplit("/", 1)[-1]
    return copy_table(spark, source, f"{backups}/{name}_{date.replace('-', '')}")


def append_unlink(spark: SparkSession, path: str, more: DataFrame) -> DataFrame:
    """Adds rows (id1, id2) to the table of unlinked pairs; repeats stay."""
    rows = more.select("id1", "id2")
    return overwrite_table(spark.read.parquet(path).select("id1", "id2").unionByName(rows) if exists(spark, path) else rows, path)


def multimap(df: DataFrame, value: str, id_: str = "id") -> DataFrame:
    """Each value with the sorted distinct ids that have it."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.array_sort(F.collect_set(id_)).alias("ids"))
