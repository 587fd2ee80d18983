"""Warehouse table writes.

A target is a folder (parquet by default, or another file format) or any
DataFrameWriter connector with options, e.g. JDBC. A batch is named by its run
and batch id (``sinks.batches``), and its tables become visible together, by
one mark that is written last; a batch that comes again after its commit is
skipped, and one that was cut off is written anew.

In a folder, a batch's rows of a table are ``run=<run>/batch_id=<id>``, so a
batch that is written anew replaces what its cut-off attempt left. A connector
target gets appends with the columns ``run``, ``batch_id`` and ``attempt``, and
marks in a table of their own. ``WarehouseSink.read`` gives the committed rows.
"""

from __future__ import annotations

import logging
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import observed_count
from ..operators.dims import new_dimension_rows
from ..operators.ranking import one_row_per_key
from .batches import FileMarks, TableMarks, file_system, list_folder, running_query, up_to

log = logging.getLogger(__name__)


def append_table(df: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> int:
    """K1 + K2 + A9: append; the row count is observed during the write
    itself (one evaluation, not count-then-count-then-write)."""
    out, obs = observed_count(df, f"rows:{target}")
    (out.write.format(fmt).options(**(options or {})).mode("append").save(target))
    n = obs.get.get("n", 0)
    log.info("wrote %s rows to %s", n, target)
    return n


def create_if_absent(df: DataFrame, target: str | None, fmt: str = "parquet", options: dict | None = None) -> None:
    """K3: write only when the target does not exist yet (``mode("ignore")``)."""
    writer = df.write.format(fmt).options(**(options or {})).mode("ignore")
    writer.save(target) if target else writer.save()


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 4) -> int:
    """Replace a snapshot by this batch's result, without touching what readers hold.

    Each write is a folder ``snapshot=<number>`` of its own; its mark, written
    last, switches readers over. Of the older ones the newest ``keep - 1`` stay,
    for readers that have opened them. Returns the number.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    taken = [int(n.split("=")[1]) for n in list_folder(spark, path) if n.startswith("snapshot=")]
    number = max(taken, default=-1) + 1
    df.write.format(fmt).save(f"{path}/snapshot={number}")
    fs, mark = file_system(spark, f"{path}/_current/{number}")
    fs.create(mark, True).close()
    marked = sorted(int(n) for n in list_folder(spark, f"{path}/_current") if n.isdigit())
    for old in marked[:-keep]:
        fs.delete(file_system(spark, f"{path}/_current/{old}")[1], False)
    for old in taken:
        if old < marked[-keep:][0]:
            fs.delete(file_system(spark, f"{path}/snapshot={old}")[1], True)
    return number


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The rows of the snapshot that was marked last; None before the first."""
    marked = [int(n) for n in list_folder(spark, f"{path.rstrip('/')}/_current") if n.isdigit()]
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/snapshot={max(marked)}") if marked else None


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The target's rows, or None only if there is no such path; a broken target is an error."""
    return spark.read.format(fmt).load(path) if path_exists(spark, path) else None


def write_batch_partition(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", options: dict | None = None,
                          run: str | None = None) -> int:
    """Idempotent batch write: replace folder ``run=<run>/batch_id=<id>`` only.

    ``run`` is the running streaming query by default, so batches of another
    checkpoint, whose ids begin again, stay. The batch is written straight into
    its own folder: no per-task sort by a partition column, no
    partition-rename commit. Readers of ``path`` see ``run`` and ``batch_id``
    as partition columns.
    """
    run = run or running_query(df.sparkSession)
    out, obs = observed_count(df, f"rows:{path}:{batch_id}")
    out.write.format(fmt).options(**(options or {})).mode("overwrite").save(f"{path.rstrip('/')}/run={run}/batch_id={int(batch_id)}")
    return obs.get.get("n", 0)


def write_rejects(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch's rejected records, if it has any."""
    if not df.isEmpty():
        write_batch_partition(df, path, batch_id)


FILE_FORMATS = ("parquet", "orc", "json", "csv")


#: Columns that name a row's batch, and its attempt in a connector's table.
BATCH = ("run", "batch_id", "attempt")


class WarehouseSink:
    """Fan one transformed batch out to its dimension and fact tables.

    ``tables`` comes from a ``plans.warehouse`` star; ``keys`` names each
    dimension's key column. The transformed batch is persisted by the star
    (``prepare``) so the writes share one computation; it is released when
    the batch is done. New dimension rows are those whose key no committed
    batch has written, which makes keys unique across batches. Of
    ``changing`` dimensions, a row that is larger by the given columns than
    what the target has of its key goes to the table ``<name>_changes``, and
    ``read`` takes each key's largest row.

    ``sources`` (a frame with the column ``file``) names the files that a
    batch was read from. They are committed with the batch, and ``unseen``
    leaves out rows of files that another run has committed, so a load that
    starts with a new checkpoint neither loses nor doubles a fact, however it
    cuts its batches.

    With a connector format, ``root`` is a prefix of the table names, which
    go into the option ``table_option``.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", options: dict | None = None,
                 changing: dict | None = None, table_option: str = "dbtable", run: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt, self.options, self.table_option = fmt, dict(options or {}), table_option
        self.changing = dict(changing or {})
        self.run = run
        self.files = fmt in FILE_FORMATS
        self.marks = FileMarks(spark, self.root) if self.files else TableMarks(spark, fmt, self._connector("load_batches"))
        self._held: list[DataFrame] = []

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def prepare(self, df: DataFrame) -> DataFrame:
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(held)
        return held

    def release(self) -> None:
        for df in self._held:
            df.unpersist()
        self._held.clear()

    def _run(self) -> str:
        return self.run or running_query(self.spark)

    def _connector(self, table: str) -> dict:
        return {**self.options, self.table_option: f"{self.root}{table}"}

    def create_tables(self, schemas: dict) -> None:
        """Connector targets: the tables (``name -> schema``) and the marks, empty, where they are absent (K3)."""
        marks = "run string, batch_id long, attempt string"
        for table, schema in {**schemas, "load_batches": marks}.items():
            none = self.spark.createDataFrame([], schema)
            none = none if table == "load_batches" else self._named(none, "none", 0, "none")
            create_if_absent(none, None, self.fmt, self._connector(table))

    def _existing(self, table: str) -> DataFrame | None:
        """A table's committed rows with their batch columns; None if nothing has been written."""
        if self.files:
            rows = read_if_exists(self.spark, self.path(table), self.fmt) if list_folder(self.spark, self.path(table)) else None
            return None if rows is None else rows.where(up_to(self.marks.committed()))
        rows = self.spark.read.format(self.fmt).options(**self._connector(table)).load()
        return rows.join(self.marks.rows(), list(BATCH), "left_semi")

    def _named(self, df: DataFrame, run: str, batch_id: int, attempt: str) -> DataFrame:
        return df.withColumns({"run": F.lit(run), "batch_id": F.lit(int(batch_id)).cast("long"), "attempt": F.lit(attempt)})

    def _put(self, df: DataFrame, table: str, batch_id: int, attempt: str) -> int:
        if self.files:
            return write_batch_partition(df, self.path(table), batch_id, self.fmt, self.options, self._run())
        out, obs = observed_count(self._named(df, self._run(), batch_id, attempt), f"rows:{table}:{batch_id}")
        out.write.format(self.fmt).options(**self._connector(table)).mode("append").save()
        return obs.get.get("n", 0)

    def done(self, batch_id: int) -> bool:
        """Whether this run has committed the batch."""
        if self.files:
            last = self.marks.last(self._run())
            return last is not None and int(batch_id) <= last
        return self.marks.has(self._run(), batch_id)

    def unseen(self, df: DataFrame, file_column: str, topic: str) -> DataFrame:
        """``df`` without rows of files that another run has committed. In a folder that one run has loaded the topic into, nothing is read here."""
        if self.files:
            wrote = set(list_folder(self.spark, self.path(f"load_files_{topic}")))
            if not any(f"run={r}" in wrote for r in self.marks.committed() if r != self._run()):
                return df
        loaded = self._existing(f"load_files_{topic}")
        if loaded is None:
            return df
        loaded = loaded.where(F.col("run") != self._run()).select("file").distinct()
        return df.join(loaded, df[file_column] == loaded["file"], "left_anti")

    def committed_keys(self, sk: str) -> DataFrame | None:
        """The registered ``(natural, key)`` rows of a key column (``operators.dims.KeyRegistry``)."""
        rows = self._existing(f"Keys_{sk}")
        return None if rows is None else rows.select("natural", "key")

    def write(self, tables: dict, keys: dict, batch_id: int, sources: DataFrame | None = None, topic: str = "") -> dict:
        """Rows written to each table, all committed together; empty if the batch had been committed."""
        counts = {}
        try:
            if self.done(batch_id):
                return counts
            attempt = uuid.uuid4().hex
            for name, df in tables.items():
                if name in keys:
                    existing = self._existing(name)
                    if name in self.changing and existing is not None:
                        df, changed = self._new_and_changed(df, existing, name, keys[name])
                        counts[f"{name}_changes"] = self._put(changed, f"{name}_changes", batch_id, attempt)
                        existing = None
                    # only the key column is read (column pruning)
                    df = new_dimension_rows(df, None if existing is None else existing.select(keys[name]), keys[name])
                counts[name] = self._put(df, name, batch_id, attempt)
            if sources is not None:
                self._put(sources.select("file").distinct(), f"load_files_{topic}", batch_id, attempt)
            self.marks.commit(self._run(), batch_id, *([] if self.files else [attempt]))
        finally:
            self.release()
        return counts

    def _new_and_changed(self, df: DataFrame, existing: DataFrame, table: str, key: str) -> tuple[DataFrame, DataFrame]:
        """Rows of ``df`` whose key is not known, and those whose key is known with smaller values of the ordering columns.

        The batch's dimension is made once and joined once to what is known; both writes read what is held of it.
        """
        order = F.struct(*self.changing[table])
        known = existing.select(key, order.alias("_known"))
        earlier = self._existing(f"{table}_changes")
        if earlier is not None:
            known = known.union(earlier.select(key, order.alias("_known")))
        # dealt by the key first: a key has a row for each of its changes, so there is little to combine before that,
        # and the rows are sorted once for the aggregate and the join
        known = known.repartition(key).groupBy(key).agg(F.max("_known").alias("_known"))
        rows = df.where(F.col(key).isNotNull()).join(known, key, "left")
        rows = self.prepare(rows.where(F.col("_known").isNull() | (order > F.col("_known"))))
        return rows.where(F.col("_known").isNull()).select(*df.columns), rows.where(F.col("_known").isNotNull()).select(*df.columns)

    def read(self, table: str, keys: dict | None = None) -> DataFrame:
        """A table as a consumer sees it: committed rows; of a changing dimension, each key's largest row."""
        df = self._existing(table).drop(*BATCH)
        if table in self.changing:
            changes = self._existing(f"{table}_changes")
            if changes is not None:
                df = df.unionByName(changes.drop(*BATCH))
            df = one_row_per_key(df, (keys or {}).get(table) or df.columns[0], order=self.changing[table]).drop("_seen")
        return df
