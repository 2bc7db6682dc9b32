"""Tables written between the steps of an iterative plan.

A step that is read more than once, or that would otherwise drag a growing
lineage behind it, is written as Parquet below the folder named by
``spark.checkpoint.dir`` (shared by the driver and all executors), and read
back.  Losing an executor therefore never loses a finished step.  What is not
dropped before is removed when the driver ends, or by ``Scratch.close``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where a local session names no checkpoint folder, as in unit tests.
LOCAL_DEFAULT = "file:///tmp/bibweave-checkpoints"

#: Rows that Python functions get at a time where rows hold whole texts.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20
_BATCH, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows and BATCH_BYTES bytes, unless they are smaller.

    A batch is held by the executor and by its Python worker at once; with the
    default of 10,000 rows, long texts would take up hundreds of MB in both.
    """
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if not spark.conf.get(_BYTES).rstrip("b").isdigit() or int(spark.conf.get(_BYTES).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BYTES, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a session whose executors are threads of the driver may go without one;
    elsewhere a folder of one machine would be missed by the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = LOCAL_DEFAULT
    return found.rstrip("/")


class Scratch:
    """Writes tables below one private folder; ``drop`` removes those no longer read, ``close`` all."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/bibweave-{uuid.uuid4().hex}"
        self.count = 0
        at, files = self._files(self.root)
        files.mkdirs(at)
        files.deleteOnExit(at)

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count}"

    def save(self, df: DataFrame) -> DataFrame:
        path, schema = self.path(), df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._scratch_path = path
        return out

    def save_by(self, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """The same, dealt to so many buckets by ``key``: a join or grouping by it later does not shuffle the table again.

        The catalogue is needed to read buckets as such; once the table is read, its entry goes, and its files stay.
        """
        path = self.path()
        name = f"bibweave_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
        out = self.spark.table(name)
        out.schema  # noqa: B018 - resolves the table
        self.spark.sql(f"DROP TABLE {name}")
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            path = getattr(df, "_scratch_path", None)
            if path:
                at, files = self._files(path)
                files.delete(at, True)

    def close(self) -> None:
        at, files = self._files(self.root)
        files.delete(at, True)
