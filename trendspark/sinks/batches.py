"""Which batches of a target count (T8, K14): ids of run and batch, one commit for all that a batch writes.

A micro-batch is named by its run (the streaming query's id, which lives in its
checkpoint: a new checkpoint is a new run) and its batch id. What it writes goes
to places of that name; the batch is committed when its mark is written, which
is done once and last. Readers take what is committed: of each run, the batches
up to its highest mark, as a run commits its batches in order. So the tables of
a batch become visible together, a batch that was cut off leaves nothing
visible, and a batch that comes again after its commit is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def running_query(spark: SparkSession) -> str:
    """Id of the streaming query whose batch is being written; ``none`` outside of one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as its object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder, also if it goes meanwhile."""
    fs, p = file_system(spark, path)
    try:
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
    except Exception as e:  # noqa: BLE001  (a py4j wrapper of any Java exception)
        if "FileNotFoundException" in str(e):
            return []
        raise


class FileMarks:
    """Marks as empty files ``<root>/_batches/<run>/<batch>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_batches"

    def last(self, run: str) -> int | None:
        """The highest committed batch of a run."""
        return max((int(n) for n in list_folder(self.spark, f"{self.folder}/{run}") if n.isdigit()), default=None)

    def committed(self) -> dict[str, int]:
        found = {run: self.last(run) for run in list_folder(self.spark, self.folder)}
        return {run: last for run, last in found.items() if last is not None}

    def commit(self, run: str, batch_id: int) -> None:
        fs, p = file_system(self.spark, f"{self.folder}/{run}/{int(batch_id)}")
        fs.create(p, True).close()
        for name in list_folder(self.spark, f"{self.folder}/{run}"):
            if name.isdigit() and int(name) < batch_id:     # the highest tells all
                fs.delete(file_system(self.spark, f"{self.folder}/{run}/{name}")[1], False)


class TableMarks:
    """Marks as rows ``(run, batch_id, attempt)`` of a connector's table, which needs only appends.

    Rows of a batch carry the random name of the attempt that wrote them, and a
    mark names the attempt that counts: what a failed attempt has appended
    stays in its tables, seen by none that reads through the marks.
    """

    def __init__(self, spark: SparkSession, fmt: str, options: dict):
        self.spark, self.fmt, self.options = spark, fmt, options

    def rows(self) -> DataFrame:
        """The marks; of a batch marked by two writers at once, one counts."""
        marks = self.spark.read.format(self.fmt).options(**self.options).load()
        return marks.groupBy("run", "batch_id").agg(F.min("attempt").alias("attempt"))

    def has(self, run: str, batch_id: int) -> bool:
        return not self.rows().where((F.col("run") == run) & (F.col("batch_id") == int(batch_id))).isEmpty()

    def commit(self, run: str, batch_id: int, attempt: str) -> None:
        mark = self.spark.createDataFrame([(run, int(batch_id), attempt)], "run string, batch_id long, attempt string")
        mark.write.format(self.fmt).options(**self.options).mode("append").save()


def up_to(committed: dict[str, int], run: str = "run", batch: str = "batch_id") -> Column:
    """Condition on the partition columns: rows of committed batches."""
    found = F.lit(False)
    for name, last in committed.items():
        found = found | ((F.col(run) == name) & (F.col(batch) <= last))
    return found
