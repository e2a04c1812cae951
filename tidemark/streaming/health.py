"""The health of running streams as metric samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "ts timestamp, name string, labels map<string,string>, value double"


class ProgressSamples(StreamingQueryListener):
    """Collects a few numbers per micro-batch until ``flush`` appends them to a table.

    Register with ``spark.streams.addListener``; the alert rules then read the
    table like any other samples. What is held is one small row set per batch.
    """

    def __init__(self):
        self._rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows.extend(progress_rows(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def samples(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self._rows), SCHEMA)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append what has been collected and forget it."""
        rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def progress_rows(progress) -> list[tuple]:
    """Samples of one micro-batch: rows in, rate, duration, rows too late."""
    ts = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    labels = {"query": progress.name or str(progress.id)}
    late = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
    values = {
        "stream_input_rows": progress.numInputRows,
        "stream_processed_rows_per_second": progress.processedRowsPerSecond,
        "stream_batch_duration_ms": progress.batchDuration,
        "stream_rows_too_late": late,
    }
    return [(ts, name, labels, float(value or 0.0)) for name, value in values.items()]
