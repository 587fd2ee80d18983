"""Serving views as versioned tables.

A view is a keyed table ``(member, score, json_value)``: a ranked view
uses ``score``, a detail view ``json_value``. Every batch is one *flush*: a
folder of its own under the root, numbered by the store, with one
``view=<name>`` folder for each view the batch has rows of. A flush holds the
batch's rows only, so what a batch writes depends on the batch and not on the
view; readers put the flushes of a view together:

* upsert (K4, K5): one row per member; the newest poll (if rows carry one) and
  then the newest flush wins (``max(struct(...))``, combined map-side);
* replace (K6): the newest flush alone;
* by poll (K6 over polls): only rows of the newest poll, however many
  micro-batches it came in;
* expiry (K7): a TTL view lives ``ttl`` after its last non-empty batch. What
  lies before a gap of that length had expired when the next batch came and
  is not read any more, and after the last batch's time plus ``ttl`` the view
  is empty;
* one flush (K8): a flush counts once Spark has marked its job as done, so
  all views of a batch appear together, and no folder that a reader may hold
  is ever written again.

A flush's name has the streaming query and batch id it came from. A replay of
the batch that a query wrote last is a no-op (T8); ids that start again after
a checkpoint was reset come from another query and are new flushes. After
``compact_every`` flushes a view's rows are folded into one snapshot flush;
``vacuum`` drops what no view needs.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.hot import TTL_SECONDS, VIEWS
from .batches import list_folder, running_query

VIEW_COLS = ["member", "score", "json_value", "poll"]
FLUSH_SCHEMA = "member string, score double, json_value string, poll string, batch_id long, version long"


def _wall_clock(t: dt.datetime):
    """A naive datetime as a TIMESTAMP_NTZ literal, independent of the
    process and session time zones."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def _with_poll(df: DataFrame) -> DataFrame:
    return df if "poll" in df.columns else df.withColumn("poll", F.lit(None).cast("string"))


# ---- folds (batch and streaming share them) -------------------------------

def upsert_all(rows: DataFrame) -> DataFrame:
    """Fold of many batches at once: ``rows`` has ``view, batch_id`` + view columns."""
    return (rows.groupBy("view", "member")
                .agg(F.max(F.struct("batch_id", "score", "json_value")).alias("r"))
                .select("view", "member", "r.score", "r.json_value", "r.batch_id"))


def replace_all(rows: DataFrame) -> DataFrame:
    """Fold of many batches of a replace view: the last batch of each view."""
    last = rows.groupBy("view").agg(F.max("batch_id").alias("last_batch"))   # one row per view
    return (rows.join(last, "view")
                .where(F.col("batch_id") == F.col("last_batch")).drop("last_batch"))


def ttl_all(rows: DataFrame, now, ttl_seconds: int) -> DataFrame:
    """K7 fold of many batches: ``rows`` has ``view, member, batch_time, score``.

    A view keeps what came since its last gap of ``ttl_seconds`` or more, the
    newest row of each member (then the larger score), and is visible while
    ``now < last batch time + ttl``. ``now`` is a Column, a datetime, or a
    one-row DataFrame. Gaps are found over each view's batch times alone.
    """
    if isinstance(now, DataFrame):
        now = now.scalar()
    elif isinstance(now, dt.datetime):
        now = _wall_clock(now)
    ttl = F.make_dt_interval(secs=F.lit(ttl_seconds))
    times = rows.select("view", "batch_time").distinct()
    before = F.lag("batch_time").over(Window.partitionBy("view").orderBy("batch_time"))
    fresh = before.isNull() | (F.col("batch_time") >= before + ttl)
    spans = (times.withColumn("begin", F.when(fresh, F.col("batch_time")))
                  .groupBy("view").agg(F.max("begin").alias("begin"), F.max("batch_time").alias("last"))
                  .where(now < F.col("last") + ttl))
    newest = rows.join(spans, "view").where(F.col("batch_time") >= F.col("begin"))
    return (newest.groupBy("view", "member").agg(F.max(F.struct("batch_time", "score")).alias("r"))
                  .select("view", "member", "r.score"))


def fold(rows: DataFrame, policy: str) -> DataFrame:
    """A view's rows from its flushes (``FLUSH_SCHEMA``), by its write policy."""
    if policy == "replace":
        return rows
    if policy in ("replace_poll", "sum_poll", "best_poll"):
        of = ["member"] if policy != "replace_poll" else []
        newest = (rows.agg(F.max("poll")).scalar() if not of else None)
        if newest is not None:
            rows = rows.where(F.col("poll") == newest)
        else:
            rows = rows.join(rows.groupBy("member").agg(F.max("poll").alias("_poll")), "member").where(
                F.col("poll") == F.col("_poll")).drop("_poll")
    if policy == "sum_poll":
        return rows.groupBy("member").agg(F.sum("score").alias("score"), F.max("json_value").alias("json_value"),
                                          F.max("poll").alias("poll"), F.max("batch_id").alias("batch_id"), F.max("version").alias("version"))
    order = ["score", "json_value", "version"] if policy == "best_poll" else ["poll", "version", "score", "json_value"]
    rest = [c for c in ("score", "json_value", "poll", "batch_id", "version") if c not in order]
    return (rows.groupBy("member").agg(F.max(F.struct(*order, *rest)).alias("r"))
                .select("member", *[f"r.{c}" for c in ("score", "json_value", "poll", "batch_id", "version")]))


# ---- the store -----------------------------------------------------------

POLICIES = ("upsert", "replace", "replace_poll", "sum_poll", "best_poll")


class Flush(NamedTuple):
    """A committed flush; ``at`` is its batch's time in epoch milliseconds (UTC)."""
    number: int
    run: str
    batch: int
    at: int
    snapshot: bool
    path: str
    views: frozenset


def _epoch_ms(t: dt.datetime) -> int:
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class ServingStore:
    def __init__(self, spark: SparkSession, root: str, policies: dict | None = None,
                 ttl: dict | None = None, keep_versions: int | None = 3, compact_every: int = 32):
        self.spark = spark
        self.root = root.rstrip("/")
        self.policies = dict(VIEWS if policies is None else policies)
        self.ttl = dict(TTL_SECONDS if ttl is None else ttl)
        self.keep_versions = keep_versions
        self.compact_every = compact_every
        if unknown := set(self.policies.values()) - set(POLICIES):
            raise ValueError(f"unknown policies: {sorted(unknown)}")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _flushes(self) -> list[Flush]:
        """Committed flushes in order, from the folder listing (metadata only)."""
        fs, root = self._fs(self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if not name.startswith("flush="):
                continue
            inside = list_folder(self.spark, st.getPath().toString())     # nothing, if another query's vacuum has it meanwhile
            if "_SUCCESS" not in inside:
                continue          # being written, or its writer was lost
            number, run, batch, at, kind, _ = name.removeprefix("flush=").split(",")
            views = frozenset(x.removeprefix("view=") for x in inside if x.startswith("view="))
            out.append(Flush(int(number), run, int(batch), int(at), kind == "snapshot", st.getPath().toString(), views))
        return sorted(out)

    def _chain(self, view: str, flushes: list[Flush] | None = None) -> list[Flush]:
        """The flushes that make up ``view``, newest first."""
        ttl = self.ttl.get(view)
        chain: list[Flush] = []
        for f in reversed(self._flushes() if flushes is None else flushes):
            if view not in f.views:
                continue
            if chain and ttl and chain[-1].at >= f.at + ttl * 1000:
                break             # it had expired before the next batch came
            chain.append(f)
            if f.snapshot or self.policies[view] == "replace":
                break
        return chain

    def versions(self, view: str) -> int | None:
        """Number of the latest committed flush of ``view``."""
        chain = self._chain(view)
        return chain[0].number if chain else None

    def _rows(self, view: str, chain: list[Flush]) -> DataFrame:
        paths = [f"{f.path}/view={view}" for f in chain]
        return fold(self.spark.read.schema(FLUSH_SCHEMA).parquet(*paths), self.policies[view])

    def _write(self, rows: DataFrame, number: int, run: str, batch: int, at: int, kind: str) -> None:
        name = f"flush={number:012d},{run},{batch},{at},{kind},{uuid.uuid4().hex[:8]}"
        rows.write.partitionBy("view").parquet(f"{self.root}/{name}")

    def _query(self) -> str:
        """Id of the streaming query whose batch is being written (a new checkpoint has a new one)."""
        return running_query(self.spark)

    def write_batch(self, rows: DataFrame, batch_id: int, views, batch_time: dt.datetime | None = None,
                    run: str | None = None) -> None:
        """Write one batch's rows (``view, member, score, json_value[, poll]``) of ``views`` as a flush.

        ``run`` tells apart writers whose batch ids count for themselves; the
        default is the running streaming query. The batch that a run wrote last
        is not written again.
        """
        views = list(views)
        for view in views:
            self.policies[view]   # an unknown view is an error
        run = run or self._query()
        flushes = self._flushes()
        own = [f for f in flushes if f.run == run and not f.snapshot]
        if own and own[-1].batch == int(batch_id):
            return
        number = flushes[-1].number + 1 if flushes else 0
        part = _with_poll(rows).where(F.col("view").isin(views)).select(
            "view", "member", F.col("score").cast("double").alias("score"), "json_value", "poll",
            F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit(number).cast("long").alias("version"))
        self._write(part, number, run, int(batch_id), _epoch_ms(batch_time or _now()), "delta")
        flushes = self._flushes()
        for view in views:
            if len(self._chain(view, flushes)) > self.compact_every:
                self.compact(view)
        if self.keep_versions is not None:
            self.vacuum(self.keep_versions)

    def compact(self, view: str) -> None:
        """Fold the flushes of ``view`` into one snapshot. Its time is the last batch's, so expiry stays as it is."""
        flushes = self._flushes()
        chain = self._chain(view, flushes)
        if len(chain) > 1:
            rows = self._rows(view, chain).withColumn("view", F.lit(view))
            self._write(rows, flushes[-1].number + 1, "compact", -1, chain[0].at, "snapshot")

    def read(self, view: str, now: dt.datetime | None = None) -> DataFrame:
        """Current rows of ``view``; a TTL view is empty once expired at ``now`` (default: the current time)."""
        chain = self._chain(view)
        ttl = self.ttl.get(view)
        if not chain or (ttl and _epoch_ms(now or _now()) >= chain[0].at + ttl * 1000):
            return self.spark.createDataFrame([], "member string, score double, json_value string, poll string")
        return self._rows(view, chain).select(*VIEW_COLS)

    def ranked(self, view: str, n: int | None = None, ascending: bool = False,
               now: dt.datetime | None = None) -> DataFrame:
        """Members by score (ties by member), top ``n``."""
        from ..operators.ranking import ranked_read
        return ranked_read(self.read(view, now), n=n, ascending=ascending)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete flushes that no view is made of, but for the newest ``keep`` of them: in-flight readers may hold those."""
        flushes = self._flushes()
        needed = {f.path for view in self.policies for f in self._chain(view, flushes)}
        # each run's newest flush tells replays
        newest = {f.run: f.path for f in flushes if not f.snapshot}
        old = [f for f in flushes if f.path not in needed and f.path not in newest.values()]
        removed = []
        for f in old[:-keep] if keep else old:
            fs, path = self._fs(f.path)
            fs.delete(path, True)
            removed.append(f.path)
        return removed
