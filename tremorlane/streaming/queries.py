"""Streaming sinks and run control. All sinks are Spark's own."""

from __future__ import annotations

import logging
import time
from threading import Thread

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tremorlane.schemas import MONITOR_COLUMNS

log = logging.getLogger(__name__)

TRIGGER_SECONDS = 5
DRAIN_SECONDS = 60
LOOK_SECONDS = 0.2  # between two looks at the queries of a run


def triggered(
    writer: DataStreamWriter, checkpoint: str, every_seconds: float | None
) -> DataStreamWriter:
    """Without an interval the query drains what is there and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{every_seconds} seconds")


def _appending(
    df: DataFrame, checkpoint: str, every_seconds: float | None
) -> DataStreamWriter:
    return triggered(df.writeStream.outputMode("append"), checkpoint, every_seconds)


def start_parquet(
    stream: DataFrame, path: str, checkpoint: str, every_seconds: float | None = None
) -> StreamingQuery:
    return _appending(stream, checkpoint, every_seconds).format("parquet").start(path)


def start_monitor(
    stream: DataFrame,
    checkpoint: str,
    every_seconds: float | None = None,
    *,
    path: str | None = None,
    rows: int = 10,
) -> StreamingQuery:
    """A second query on the same source that shows each batch.

    It prints the first rows of a batch, untruncated, or appends the same
    columns to Parquet if `path` is given.
    """
    writer = _appending(stream.select(*MONITOR_COLUMNS), checkpoint, every_seconds)
    if path is not None:
        return writer.format("parquet").start(path)
    return writer.format("console").option("truncate", False).option("numRows", rows).start()


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for queries that drain their source; the others stop where one fails."""
    _watch(queries, None, all_of_them=True)
    _finish(queries)


def run_for(
    *queries: StreamingQuery, seconds: float | None = None, drain_seconds: float = DRAIN_SECONDS
) -> None:
    """Run until a query ends or fails, or the time is up, then stop all of them.

    The failure of any query is raised, after the others were stopped. Where
    the time is up, what has arrived until then is still taken, by one query
    after the other in the order given (so name a query before those that read
    its table), for at most `drain_seconds` in all.
    """
    try:
        if _watch(queries, seconds, all_of_them=False):
            _drain(queries, drain_seconds)
    finally:
        _finish(queries)


def _watch(queries: tuple[StreamingQuery, ...], seconds: float | None, all_of_them: bool) -> bool:
    """Look at all queries until one (or all) ended, one failed, or the time is up: then true."""
    until = None if seconds is None else time.monotonic() + seconds
    while True:
        active = [query.isActive for query in queries]
        if any(not on and query.exception() for on, query in zip(active, queries, strict=True)):
            return False
        if not any(active) or (not all_of_them and not all(active)):
            return False
        if until is not None and time.monotonic() >= until:
            return True
        time.sleep(LOOK_SECONDS)


def _drain(queries: tuple[StreamingQuery, ...], seconds: float) -> None:
    """Let each query in turn take what its source has, unless the time runs out or it fails."""
    until = time.monotonic() + seconds
    for query in queries:
        taking = Thread(target=_take_all, args=(query,), daemon=True)
        taking.start()
        taking.join(max(0.0, until - time.monotonic()))


def _take_all(query: StreamingQuery) -> None:
    try:
        query.processAllAvailable()
    except Exception:  # the query's own failure is raised where the run ends
        log.debug("query %s ended while it was drained", query.id)


def _finish(queries: tuple[StreamingQuery, ...]) -> None:
    """Stop what still runs, then raise the first failure, with the others named in its notes."""
    for query in queries:
        try:
            query.stop()
        except Exception:  # a query that cannot stop must not keep the others running
            log.exception("could not stop query %s", query.id)
    failures = [error for query in queries if (error := query.exception()) is not None]
    if failures:
        for other in failures[1:]:
            failures[0].add_note(f"another query failed as well: {other}")
        raise failures[0]
