"""The end-to-end job: landed pages to clustered events and summaries."""

from __future__ import annotations

import argparse
import logging
import sys
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tremorlane.operators import (
    clean_events,
    cluster_events,
    cluster_sizes,
    enrich,
    first_seen,
    flatten_events,
    gate_open,
    magnitude_histogram,
    map_points,
    require_id,
    severity_counts,
)
from tremorlane.operators.clustering import CLUSTERS, SEED
from tremorlane.schemas import CLUSTERED, FLAT, FLAT_COLUMNS
from tremorlane.sinks import write_csv, write_parquet
from tremorlane.sources import explode_pages, read_enriched, read_pages
from tremorlane.staging import ensure_dir
from tremorlane.streaming import (
    dedup_stream,
    read_event_stream,
    read_landed_stream,
    run_for,
    run_to_end,
    settled_gate,
    split_malformed,
    start_first_seen,
    start_monitor,
    start_parquet,
)
from tremorlane.streaming.queries import DRAIN_SECONDS, TRIGGER_SECONDS

log = logging.getLogger(__name__)

PLACE = ("poll", "feed", "page", "file", "line", "pos")


def arrival_order() -> list[Column]:
    """Poll by poll, within a poll the live feed before the archive, then page by page.

    Pages without a number come in the order in which their files came to be,
    and within a file as they stand in it.
    """
    feed_rank = F.when(F.col("feed") == "live", F.lit(0)).otherwise(F.lit(1))
    return [F.col("poll"), feed_rank, *map(F.col, ("page", "file", "line", "pos"))]


def arriving_events(raw: DataFrame, *, default_provider: str) -> DataFrame:
    """Flat events that have an id, with their place in the arrival order.

    Flattened before the shuffle that follows, as flat rows are the narrower.
    """
    return flatten_events(raw, default_provider=default_provider, carry=PLACE).transform(
        require_id
    )


_LIVE = "feed = 'live'"
_FIRST_POLL = "poll = 0"
_FIRST_ARCHIVE = "feed = 'archive' and poll = 0"


def admitted_events(
    raw: DataFrame, threshold: int, watched: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """Live events of all polls, and the first poll's archive if that poll had few live ones.

    Each branch reads its own folders, and the gate as many of the first
    poll's live events as it needs. `watched` is applied to what the archive adds.
    """
    live = raw.where(_LIVE)
    opened = gate_open(live.where(_FIRST_POLL), threshold)
    return live.unionByName(watched(raw.where(_FIRST_ARCHIVE).where(opened)))


def first_poll_gate(spark: SparkSession, pages: str, threshold: int) -> bool | None:
    """Whether the first poll has fewer than `threshold` live events; None before it has landed."""
    first = explode_pages(read_pages(spark, pages)).where(_FIRST_POLL)
    if first.isEmpty():
        return None
    return first.where(_LIVE).limit(threshold).count() < threshold


@dataclass(frozen=True)
class JobResult:
    """Where a run put its tables, and how many events it clustered."""

    rows: int
    landing: str
    enriched: str
    clustered: str
    clustered_csv: str
    reports: dict[str, str]


def run_job(
    spark: SparkSession,
    pages: str,
    out: str,
    *,
    default_provider: str,
    monitor: bool = False,
    one_document_per_file: bool = False,
    k: int = CLUSTERS,
    seed: int = SEED,
    fit_partitions: int | None = None,
    backfill_threshold: int | None = None,
) -> JobResult:
    """Run all stages on the pages under `pages`, each a table under `out`.

    All landed pages are taken. With a `backfill_threshold`, those of the
    archive are only if they are of the first poll and it had fewer live
    events than that; how many events this takes is logged.

    Every run has its own folder, so its stream starts without old checkpoints
    and nothing of the user's is deleted. With no usable event the clustered
    table is empty, `rows` is 0 and no report is written.
    """
    run = f"{out.rstrip('/')}/run-{uuid.uuid4().hex}"
    landing, enriched, clustered = f"{run}/landing", f"{run}/enriched", f"{run}/clustered"
    clustered_csv = f"{run}/clustered_csv"

    raw = explode_pages(read_pages(spark, pages, one_document_per_file=one_document_per_file))
    from_archive = Observation()
    taken = raw
    if backfill_threshold is not None:
        taken = admitted_events(
            raw, backfill_threshold, lambda df: df.observe(from_archive, F.count(F.lit(1)).alias("n"))
        )
    fresh = first_seen(
        arriving_events(taken, default_provider=default_provider), "earthquake_id", arrival_order()
    ).drop(*PLACE)
    write_parquet(fresh, landing)
    if backfill_threshold is not None:  # counted on the way, not by another pass
        n = from_archive.get["n"]
        log.warning("backfill gate of %d: %d archive events taken", backfill_threshold, n)

    # The landing table has one row per id already, so the stream keeps no state.
    stream = enrich(read_landed_stream(spark, landing))
    queries = [start_parquet(stream, enriched, f"{run}/checkpoint/parquet")]
    if monitor:
        queries.append(start_monitor(stream, f"{run}/checkpoint/monitor"))
    run_to_end(*queries)

    clean = clean_events(read_enriched(spark, enriched))
    write_parquet(cluster_events(clean, k, seed, fit_partitions), clustered)
    labelled = read_enriched(spark, clustered, CLUSTERED)
    write_csv(labelled, clustered_csv)

    rows = labelled.count()  # answered from the Parquet footers
    reports: dict[str, str] = {}
    if rows == 0:
        log.error("no event left to cluster under %s", run)
    else:
        for name, report in {
            "severity_counts": severity_counts,
            "magnitude_hist": magnitude_histogram,
            "cluster_sizes": cluster_sizes,
            "map_points": map_points,
        }.items():
            reports[name] = f"{run}/reports/{name}"
            write_parquet(report(labelled), reports[name])
    return JobResult(rows, landing, enriched, clustered, clustered_csv, reports)


def run_pages(
    spark: SparkSession,
    pages: str,
    out: str,
    *,
    default_provider: str,
    seconds: float | None = None,
    every_seconds: float | None = TRIGGER_SECONDS,
    monitor: bool = True,
    backfill_threshold: int | None = None,
    drain_seconds: float = DRAIN_SECONDS,
) -> str:
    """Ingest response pages as they arrive under `pages`; gives the enriched table's folder.

    Pages are flattened and the first row of every id landed, and the landed
    rows labelled, by queries that run side by side for `seconds` or until
    stopped; pages that had arrived by then are still taken, for at most
    `drain_seconds`, and a query that fails stops the others and is raised.
    Without `every_seconds` they take what is there, one after the other, and
    end. A later run with the same `out` goes on where this one ended; pages
    count as arrived in the order of their polls within a batch.

    With a `backfill_threshold`, pages of the archive count only if they are
    of the first poll and that had fewer live events. This is decided on what
    has landed of the first poll when the run begins (a run with
    `every_seconds` waits for it) and kept beside the checkpoints, so that
    later runs go by it whatever has landed since.
    """
    out = out.rstrip("/")
    landing, enriched, checkpoint = f"{out}/landing", f"{out}/enriched", f"{out}/checkpoint"
    until = None if seconds is None else time.monotonic() + seconds
    raw = explode_pages(read_pages(spark, pages, streaming=True))
    if backfill_threshold is not None:

        def gate() -> bool | None:
            return settled_gate(
                spark,
                f"{checkpoint}/gate",
                lambda: first_poll_gate(spark, pages, backfill_threshold),
            )

        while (admits := gate()) is None and every_seconds is not None:
            if until is not None and time.monotonic() >= until:
                return enriched  # nothing of the first poll has come
            time.sleep(every_seconds)
        log.warning("backfill gate of %d is %s", backfill_threshold, "shut" if admits is False else "open")
        raw = raw.where(_LIVE if admits is False else f"{_LIVE} or ({_FIRST_ARCHIVE})")
    ensure_dir(spark, landing)  # the stream below watches it from the start
    first = start_first_seen(
        arriving_events(raw, default_provider=default_provider),
        landing,
        f"{checkpoint}/landing",
        key="earthquake_id",
        arrival=arrival_order(),
        columns=list(FLAT_COLUMNS),
        every_seconds=every_seconds,
    )
    if every_seconds is None:
        run_to_end(first)
    stream = enrich(read_landed_stream(spark, landing))
    queries = [start_parquet(stream, enriched, f"{checkpoint}/enriched", every_seconds)]
    if monitor:
        queries.append(start_monitor(stream, f"{checkpoint}/monitor", every_seconds))
    if every_seconds is None:
        run_to_end(*queries)
    else:
        left = None if until is None else max(0.0, until - time.monotonic())
        run_for(first, *queries, seconds=left, drain_seconds=drain_seconds)
    return enriched


def run_live(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    *,
    seconds: float | None = None,
    every_seconds: float = TRIGGER_SECONDS,
    files_per_batch: int | None = 1,
    dedup: bool = False,
    malformed: str | None = None,
    drain_seconds: float = DRAIN_SECONDS,
) -> None:
    """Ingest the JSON-lines files that arrive under `landing`, showing each batch.

    Runs for `seconds`, or until stopped; a later run with the same
    `checkpoint` goes on where this one ended. Lines that do not parse become
    rows of NULLs, or, where a folder `malformed` is given, go there and not
    among the events.
    """
    events = read_event_stream(
        spark, landing, files_per_batch=files_per_batch, keep_malformed=malformed is not None
    )
    queries = []
    if malformed is not None:
        events, lines = split_malformed(events)
        queries = [start_parquet(lines, malformed, f"{checkpoint}/malformed", every_seconds)]
    stream = enrich(dedup_stream(require_id(events)) if dedup else events)
    run_for(
        start_parquet(stream, out, f"{checkpoint}/parquet", every_seconds),
        start_monitor(stream, f"{checkpoint}/monitor", every_seconds),
        *queries,
        seconds=seconds,
        drain_seconds=drain_seconds,
    )


def main(arguments: list[str] | None = None) -> int:
    """Entry point for spark-submit; non-zero where nothing could be clustered."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("pages", help="folder of landed response pages")
    parser.add_argument("out", help="folder for the tables of the run")
    parser.add_argument("--provider", required=True, help="provider of events that name none")
    parser.add_argument("--monitor", action="store_true", help="print rows of each batch")
    parser.add_argument(
        "--backfill-threshold", type=int, help="live events from which on the archive stays out"
    )
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tremorlane").getOrCreate()
    result = run_job(
        spark,
        options.pages,
        options.out,
        default_provider=options.provider,
        monitor=options.monitor,
        backfill_threshold=options.backfill_threshold,
    )
    return 0 if result.rows else 1


if __name__ == "__main__":
    sys.exit(main())
