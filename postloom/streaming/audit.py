"""Audit rows from the metrics that streams observe while they run."""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from postloom.operators.quality import POST_DROP_RULES, POST_WARN_RULES
from postloom.streaming.ingest import RULE_METRICS

COUNTS = ["rows_in", "rows_out", *POST_DROP_RULES, *POST_WARN_RULES]
AUDIT_SCHEMA = ", ".join(["batch bigint", "query string", "started string", *[f"{c} bigint" for c in COUNTS]])


class AuditListener(StreamingQueryListener):
    """One audit row per micro-batch of streams that observe :data:`RULE_METRICS`.

    The stream stays on its own exactly-once file sink; nothing is read or computed a second time.
    A batch's row is a small JSON file named by query and batch, so a batch that runs again
    replaces its row. Rows appear shortly after their batch; a batch whose driver dies between the
    batch's commit and its progress event has none.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str] = tuple(COUNTS)) -> None:
        self.spark, self.path, self.columns = spark, path.rstrip("/"), list(columns)
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        counts = progress.observedMetrics.get(RULE_METRICS)
        if counts is None or progress.numInputRows == 0:
            return
        row = {"batch": progress.batchId, "query": str(progress.id), "started": progress.timestamp}
        row |= {c: counts[c] for c in self.columns}
        rows = self.spark.createDataFrame([(json.dumps(row),)], "value string")
        rows.coalesce(1).write.mode("overwrite").text(f"{self.path}/stream={progress.id}/number={progress.batchId}")

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def wait_for(self, query: StreamingQuery, seconds: float = 120) -> bool:
        """Wait until a query that has ended has all its rows written; events come in order, its end last."""
        return self._end(str(query.runId)).wait(seconds)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit rows of all streams."""
    rows = spark.read.schema(f"{AUDIT_SCHEMA}, stream string, number bigint").json(path)
    return rows.drop("stream", "number")
