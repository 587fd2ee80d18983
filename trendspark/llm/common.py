"""Helpers of the operators: tables, intermediate results in the shared folder, column selection."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local master without that setting gets a temporary folder of its own; a
    cluster without it is an error, as no machine-local folder would do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(sc, "_llm_scratch", None):
        sc._llm_scratch = tempfile.mkdtemp(prefix="llm-")
    return sc._llm_scratch


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage: lost executors cost only the tasks that ran on them, and
    several consumers read the same committed rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what ``saved`` wrote for these tables, once nothing that is still to run reads them."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._llm_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def aliased(docs: DataFrame, *named: str) -> tuple[DataFrame, ...]:
    """``docs`` with its columns named c0, c1, ... by place, so that an operator's own names clash with none, and the new names of ``named``."""
    columns = docs.columns
    return docs.toDF(*(f"c{i}" for i in range(len(columns)))), *(f"c{columns.index(c)}" for c in named)


def spread(df: DataFrame) -> int:
    """Partitions for a shuffle of ``df``: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._llm_shipped = True


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def likely_in(rows: DataFrame, ids: DataFrame, column: str, bits: int = 1 << 23) -> DataFrame:
    """The rows whose ``column`` is in the single column of ``ids``, and a few more.

    A bitmap of fixed size (a megabyte) holds the ids' hashes, so rows that
    aren't wanted need not be shuffled for the exact join that must follow.
    The more ids, the more rows pass; none that is wanted is lost.
    """
    bit = F.xxhash64(F.col(ids.columns[0])).bitwiseAND(F.lit(bits - 1))
    words = ids.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))
    columns = rows.columns

    def keep(batches):
        for batch in batches:
            at = np.asarray(batch.column(0)) & (bits - 1)
            hit = (shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield pa.RecordBatch.from_arrays(batch.columns[1:], columns).filter(pa.array(hit.astype(bool)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return mapped(rows.select(F.xxhash64(column).alias("_hash"), *columns), keep, schema)
