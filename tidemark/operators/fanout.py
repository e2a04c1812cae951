"""One batch to several sinks, each on its own fate."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.operators import dlq

Sink = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Delivery:
    """What happened to one sink."""

    sink: str
    attempts: int
    error: Exception | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


def deliver(batch: DataFrame, name: str, sink: Sink, max_retries: int, base_seconds: float, sleep=time.sleep) -> Delivery:
    """Write to one sink; after a failure wait ``base * 2^attempt`` seconds and try again."""
    error: Exception | None = None
    for attempt in range(max_retries):
        try:
            sink(batch)
            return Delivery(name, attempt + 1)
        except Exception as caught:  # noqa: BLE001 - any sink failure is retried, then reported
            error = caught
            if attempt < max_retries - 1:
                sleep(base_seconds * 2**attempt)
    return Delivery(name, max_retries, error)


def route(
    batch: DataFrame,
    sinks: Mapping[str, Sink],
    dead_letters: Sink | None = None,
    max_retries: int = 3,
    base_seconds: float = 1.0,
    consumer_id: str = "",
    sleep=time.sleep,
) -> list[Delivery]:
    """Send the batch to every sink; one failing sink does not stop the others.

    The rows of a sink that keeps failing go to ``dead_letters``. The batch counts
    as processed only when every delivery is ok. Sinks should be idempotent, as a
    retry writes the whole batch again.
    """
    held = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        done = [deliver(held, name, sink, max_retries, base_seconds, sleep) for name, sink in sinks.items()]
        for failed in (d for d in done if not d.ok):
            if dead_letters is not None:
                dead_letters(sink_failures(held, failed, consumer_id))
        return done
    finally:
        held.unpersist()


def sink_failures(batch: DataFrame, failed: Delivery, consumer_id: str = "") -> DataFrame:
    """The batch as dead letters of one sink."""
    envelope = [
        c for c in ("event_id", "event_timestamp", "source", "operation", "before", "after", "schema_version", "metadata")
        if c in batch.columns
    ]
    return dlq.dlq_entries(
        batch,
        F.to_json(F.struct(*envelope)),
        F.lit("sink_failure"),
        F.lit(f"{failed.sink} write failed: {failed.error}"),
        details={
            "sink": F.lit(failed.sink),
            "error_type": F.lit(type(failed.error).__name__),
            "error_str": F.lit(str(failed.error)),
        },
        failed_sink=F.lit(failed.sink),
        retry_count=F.lit(failed.attempts),
        consumer_id=consumer_id,
    )
