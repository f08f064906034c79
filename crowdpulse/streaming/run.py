"""Starting, fanning out and waiting for append streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from crowdpulse.schemas import REFRESH_DEFAULT, REFRESH_MAX, REFRESH_MIN
from crowdpulse.streaming.sinks import Sink

DRAIN = {"availableNow": True}


def every(seconds: int = REFRESH_DEFAULT) -> dict[str, str]:
    """The trigger of a periodic refresh."""
    if not REFRESH_MIN <= seconds <= REFRESH_MAX:
        raise ValueError(f"refresh must be {REFRESH_MIN}..{REFRESH_MAX} s, got {seconds}")
    return {"processingTime": f"{seconds} seconds"}


def stream_writer(df: DataFrame, mode: str, checkpoint: str, trigger: dict | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def start_sink(
    df: DataFrame, sink: Sink, checkpoints: str, trigger: dict | None = None
) -> StreamingQuery:
    """One append query with a checkpoint of its own; no trigger means as soon as possible."""
    writer = stream_writer(sink.prepare(df), "append", f"{checkpoints}/{sink.name}", trigger)
    writer = writer.queryName(f"{sink.name}-{uuid.uuid4().hex[:8]}")  # active names must differ
    if sink.stream_format:
        return writer.format(sink.stream_format).options(**sink.options).start()
    return writer.foreachBatch(sink.write).start()


def start_fan_out(
    df: DataFrame, sinks: Sequence[Sink], checkpoints: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Independent queries: a slow or failed sink holds up no other, at one parse per sink."""
    queries: list[StreamingQuery] = []
    try:
        for sink in sinks:
            queries.append(start_sink(df, sink, checkpoints, trigger))
    except Exception:
        _stop(queries)
        raise
    return queries


def start_shared_fan_out(
    df: DataFrame, sinks: Sequence[Sink], checkpoints: str, trigger: dict | None = None
) -> StreamingQuery:
    """One query for all sinks: read and parsed once, but they advance and fail together."""

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink.write(sink.prepare(batch), batch_id)
        finally:
            batch.unpersist()

    return stream_writer(df, "append", f"{checkpoints}/shared", trigger).foreachBatch(write_all).start()


def _stop(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def failures(queries: Iterable[StreamingQuery]) -> dict[str, str]:
    """Which queries have failed, by the name of their sink, and the failures' first lines."""
    failed = {query.name or str(query.id): query.exception() for query in queries}
    return {name: str(error).splitlines()[0] for name, error in failed.items() if error is not None}


def await_any(queries: Sequence[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Waits until one query ends, stops the others, and raises if it failed."""
    try:
        while not any(query.awaitTermination(poll_seconds) for query in queries):
            pass
    finally:
        _stop(queries)


def await_all(queries: Sequence[StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Waits for draining queries; the first failure stops the rest and is raised."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(poll_seconds)]
    finally:
        _stop(queries)


def drain(df: DataFrame, sinks: Sequence[Sink], checkpoints: str) -> None:
    """Takes in everything available now, sink by sink, and returns."""
    await_all(start_fan_out(df, sinks, checkpoints, DRAIN))
