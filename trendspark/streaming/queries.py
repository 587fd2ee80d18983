"""Handles of streaming queries that were started together."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


class StartedQueries(list):
    """Several queries that make up one job step: awaited and stopped as one."""

    def awaitTermination(self) -> None:
        """Wait for all; a failure of any is raised."""
        for q in self:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self:
            q.stop()

    def exception(self):
        """The first failure, or None."""
        return next((e for e in (q.exception() for q in self) if e), None)

    @property
    def main(self) -> StreamingQuery:
        return self[0]


def start_rejects(bad, path: str, checkpoint: str, name: str, trigger: dict | None = None) -> StreamingQuery:
    """The query that keeps rejected records as JSON lines."""
    w = bad.writeStream.format("json").option("checkpointLocation", checkpoint.rstrip("/") + "_rejects")
    if trigger:
        w = w.trigger(**trigger)
    return w.queryName(name).start(path)


def rejects_path(checkpoint: str, given: str | None) -> str:
    """Where rejected records go: next to the checkpoint unless a folder is given."""
    return given or checkpoint.rstrip("/") + "_quarantine"
