"""The registered queries: one per operator, each over the whole table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorlane.operators import (
    ClusterModel,
    archive_window,
    backfill_union,
    clean_events,
    cluster_events,
    cluster_quality,
    cluster_sizes,
    enrich,
    first_seen,
    fit_clusters,
    flatten_events,
    live_window,
    magnitude_histogram,
    map_points,
    require_id,
    row_count,
    severity_counts,
    standardize,
    with_nearest,
)
from tremorlane.operators.arrivals import BACKFILL_THRESHOLD
from tremorlane.operators.clean import KEY_COLUMNS
from tremorlane.plans.job import PLACE, arrival_order, arriving_events, run_job, run_pages
from tremorlane.plans.testdata import (
    DEFAULT_PROVIDER,
    LIVE_AND_ARCHIVE_POLLS,
    QUIET_FIRST_POLL,
    flat_events,
    land_broken_lines,
    land_pages,
    landed_events,
)
from tremorlane.schemas import CLUSTERED, CLUSTERED_COLUMNS, FLAT, FLAT_COLUMNS, MONITOR_COLUMNS, ddl
from tremorlane.sinks import write_csv, write_json_lines, write_parquet, write_single_csv
from tremorlane.sources import (
    explode_pages,
    pack_pages,
    read_csv,
    read_enriched,
    read_events,
    read_packed_pages,
    read_pages,
)
from tremorlane.sources.files import read_table
from tremorlane.staging import fresh_dir
from tremorlane.streaming import (
    dedup_stream,
    read_event_stream,
    read_summary,
    run_to_end,
    split_malformed,
    start_first_seen,
    start_monitor,
    start_parquet,
    start_summary,
)

Query = Callable[[SparkSession, str], DataFrame]

REQUEST_ROWS = 500
AS_OF = datetime(2024, 1, 31)  # the day after the last event
QUIET_AS_OF = datetime(2024, 2, 2)  # no event in the day before, some in the week


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(flat_events(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(_enriched(spark, sf_dir))


def _landed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = fresh_dir(spark, "landing")
    write_json_lines(flat_events(spark, sf_dir), landing)
    return enrich(read_event_stream(spark, landing))


def explode_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event")
    return landed_events(spark, sf_dir, LIVE_AND_ARCHIVE_POLLS).select(
        "poll",
        "feed",
        event["earthquake_id"].alias("earthquake_id"),
        event["provider"].alias("provider"),
        event["title"].alias("title"),
        event["mag"].try_cast("double").alias("mag"),
        event["depth"].try_cast("double").alias("depth"),
        F.coalesce(F.size(event["geojson"]["coordinates"]), F.lit(-1)).alias("n_coordinates"),
        event["location_properties"]["epiCenter"]["name"].alias("epicentre"),
        event["location_properties"]["closestCity"]["name"].alias("city"),
        event["date_time"].alias("date_time"),
        event["date"].alias("date"),
    )


def flatten_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed_events(spark, sf_dir, LIVE_AND_ARCHIVE_POLLS)
    return flatten_events(raw, default_provider=DEFAULT_PROVIDER)


def dedup_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = landed_events(spark, sf_dir, LIVE_AND_ARCHIVE_POLLS)
    events = arriving_events(raw, default_provider=DEFAULT_PROVIDER)
    return first_seen(events, "earthquake_id", arrival_order()).drop(*PLACE)


def packed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen rows from landed pages that were packed into large files."""
    pages, packed = fresh_dir(spark, "pages"), fresh_dir(spark, "packed")
    land_pages(spark, sf_dir, LIVE_AND_ARCHIVE_POLLS, pages)
    pack_pages(spark, pages, packed)
    raw = explode_pages(read_packed_pages(spark, packed))
    events = arriving_events(raw, default_provider=DEFAULT_PROVIDER)
    return first_seen(events, "earthquake_id", arrival_order()).drop(*PLACE)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen rows over two runs on one checkpoint: the second finds the first's ids again."""
    pages, out = fresh_dir(spark, "pages"), fresh_dir(spark, "distinct")
    checkpoint = fresh_dir(spark, "checkpoint")
    for poll in (0, 1):
        polls = tuple(part for part in LIVE_AND_ARCHIVE_POLLS if part[0] == poll)
        land_pages(spark, sf_dir, polls, pages)
        raw = explode_pages(read_pages(spark, pages, streaming=True))
        run_to_end(
            start_first_seen(
                arriving_events(raw, default_provider=DEFAULT_PROVIDER),
                out,
                checkpoint,
                key="earthquake_id",
                arrival=arrival_order(),
                columns=list(FLAT_COLUMNS),
            )
        )
    return read_table(spark, out, FLAT)


def state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that Spark's own state keeps over two runs; which of their rows stay is not fixed."""
    raw = landed_events(spark, sf_dir, LIVE_AND_ARCHIVE_POLLS)
    events = arriving_events(raw, default_provider=DEFAULT_PROVIDER)
    landing, out = fresh_dir(spark, "landing"), fresh_dir(spark, "distinct")
    checkpoint = fresh_dir(spark, "checkpoint")
    for poll in (0, 1):
        write_json_lines(events.where(F.col("poll") == poll).drop(*PLACE), landing)
        stream = dedup_stream(require_id(read_event_stream(spark, landing)))
        run_to_end(start_parquet(enrich(stream), out, checkpoint))
    return read_enriched(spark, out).select("earthquake_id")


def continuous_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table after pages arrived poll by poll, with an ingest run after each."""
    pages, out = fresh_dir(spark, "pages"), fresh_dir(spark, "ingest")
    for poll in (0, 1):
        polls = tuple(part for part in LIVE_AND_ARCHIVE_POLLS if part[0] == poll)
        land_pages(spark, sf_dir, polls, pages)
        enriched = run_pages(
            spark,
            pages,
            out,
            default_provider=DEFAULT_PROVIDER,
            every_seconds=None,
            monitor=False,
        )
    return read_enriched(spark, enriched)


def gated_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that arrive poll by poll after a quiet and after a busy first poll.

    The gate is decided in the first run of each and holds in the second.
    """
    days = []
    for day, polls in (("quiet", QUIET_FIRST_POLL), ("busy", LIVE_AND_ARCHIVE_POLLS)):
        pages, out = fresh_dir(spark, "pages"), fresh_dir(spark, "ingest")
        for poll in (0, 1):
            land_pages(spark, sf_dir, tuple(part for part in polls if part[0] == poll), pages)
            enriched = run_pages(
                spark,
                pages,
                out,
                default_provider=DEFAULT_PROVIDER,
                every_seconds=None,
                monitor=False,
                backfill_threshold=BACKFILL_THRESHOLD,
            )
        days.append(read_enriched(spark, enriched).withColumn("day", F.lit(day)))
    return days[0].unionByName(days[1])


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables from one stream: its events, and the lines that did not parse (in full)."""
    landing, enriched = fresh_dir(spark, "landing"), fresh_dir(spark, "enriched")
    rejected = fresh_dir(spark, "rejected")
    land_broken_lines(spark, sf_dir, landing)
    stream = read_event_stream(spark, landing, keep_malformed=True, files="*.txt")
    events, lines = split_malformed(stream)
    run_to_end(
        start_parquet(enrich(events), enriched, fresh_dir(spark, "checkpoint")),
        start_parquet(lines, rejected, fresh_dir(spark, "checkpoint")),
    )
    no = F.lit(None)
    rows = read_enriched(spark, enriched).select(
        F.lit("event").alias("kind"),
        "earthquake_id",
        "magnitude",
        "severity",
        no.cast("string").alias("line"),
    )
    lines = spark.read.parquet(rejected).select(
        F.when(F.col("salvaged"), "salvaged line").otherwise("lost line").alias("kind"),
        no.cast("string").alias("earthquake_id"),
        no.cast("double").alias("magnitude"),
        no.cast("string").alias("severity"),
        "line",
    )
    return rows.unionByName(lines)


def live_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_window(_enriched(spark, sf_dir), AS_OF)


def newest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one request for the live feed gives: at most 500 events, the newest."""
    return live_window(_enriched(spark, sf_dir), AS_OF, limit=REQUEST_ROWS)


def archive_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_window(_enriched(spark, sf_dir), AS_OF)


def backfill_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quiet day, which the archive fills, and a busy one, where it stays out."""
    events = _enriched(spark, sf_dir)
    quiet, busy = (
        backfill_union(
            live_window(events, as_of).withColumn("feed", F.lit("live")),
            archive_window(events, as_of).withColumn("feed", F.lit("archive")),
        ).withColumn("day", F.lit(day))
        for as_of, day in ((QUIET_AS_OF, "quiet"), (AS_OF, "busy"))
    )
    return quiet.unionByName(busy).select("day", "feed", "earthquake_id", "event_ts")


def severity_label_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("earthquake_id", "magnitude", "severity")


def parse_event_time_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select("earthquake_id", "event_time", "event_ts")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "enriched")
    stream = _landed_stream(spark, sf_dir)
    run_to_end(start_parquet(stream, out, fresh_dir(spark, "checkpoint")))
    return read_enriched(spark, out)


def stream_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitor's columns, from a query that runs beside the ingest query."""
    shown = fresh_dir(spark, "monitor")
    stream = _landed_stream(spark, sf_dir)
    run_to_end(
        start_parquet(stream, fresh_dir(spark, "enriched"), fresh_dir(spark, "checkpoint")),
        start_monitor(stream, fresh_dir(spark, "checkpoint"), path=shown),
    )
    return spark.read.parquet(shown).select(*MONITOR_COLUMNS)


def clean_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the enriched table at rest; its scan takes the null tests."""
    path = fresh_dir(spark, "enriched")
    write_parquet(_enriched(spark, sf_dir), path)
    return clean_events(read_enriched(spark, path))


def clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_clean(spark, sf_dir))


def map_points_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_points(_clean(spark, sf_dir))


def severity_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity_counts(_clean(spark, sf_dir))


def magnitude_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return magnitude_histogram(_clean(spark, sf_dir))


def running_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports from the summary that a stream keeps, after several batches and two runs."""
    landing, kept = fresh_dir(spark, "landing"), fresh_dir(spark, "summary")
    checkpoint = fresh_dir(spark, "checkpoint")
    for half in ("cast(earthquake_id as bigint) % 2 = 0", "cast(earthquake_id as bigint) % 2 = 1"):
        write_json_lines(flat_events(spark, sf_dir).where(half), landing)
        events = read_event_stream(spark, landing, files_per_batch=4)
        run_to_end(start_summary(clean_events(enrich(events)), kept, checkpoint))
    summary = read_summary(spark, kept)
    bins = magnitude_histogram(summary, weight="n")
    no_edge = F.lit(None).cast("double")
    return (
        row_count(summary, weight="n")
        .select(F.lit("rows").alias("report"), F.lit("all").alias("item"), no_edge.alias("lo"), "n")
        .unionByName(
            severity_counts(summary, weight="n").select(
                F.lit("severity").alias("report"), F.col("severity").alias("item"), no_edge.alias("lo"), "n"
            )
        )
        .unionByName(
            bins.select(F.lit("magnitude").alias("report"), F.col("bin").cast("string").alias("item"), "lo", "n")
        )
    )


def standardize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = standardize(_clean(spark, sf_dir).select("earthquake_id", *KEY_COLUMNS))
    return scaled.select(
        "earthquake_id", *(F.round(f"{name}_std", 6).alias(f"{name}_std") for name in KEY_COLUMNS)
    )


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "jsonl")
    write_json_lines(flat_events(spark, sf_dir), path)
    return read_events(spark, path)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the clustered table but the cluster number."""
    columns = {name: kind for name, kind in CLUSTERED_COLUMNS.items() if name != "cluster"}
    path = fresh_dir(spark, "csv")
    write_csv(_enriched(spark, sf_dir).select(*columns), path)
    return read_csv(spark, path, ddl(columns))


def csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns through one file."""
    columns = {name: kind for name, kind in CLUSTERED_COLUMNS.items() if name != "cluster"}
    path = f"{fresh_dir(spark, 'csv')}/events.csv"
    write_single_csv(_enriched(spark, sf_dir).select(*columns), path)
    return read_csv(spark, path, ddl(columns))


def stream_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that a saved model gives a stream, held against those of the table it was fitted on."""
    events, path, out = _clean(spark, sf_dir), fresh_dir(spark, "model"), fresh_dir(spark, "labelled")
    fitted = fit_clusters(events)
    fitted.save(spark, path)
    loaded = ClusterModel.load(spark, path)
    stream = loaded.label(clean_events(_landed_stream(spark, sf_dir)))
    run_to_end(start_parquet(stream, out, fresh_dir(spark, "checkpoint")))
    batch = fitted.label(events).select("earthquake_id", F.col("cluster").alias("own"))
    labelled = read_enriched(spark, out, CLUSTERED)
    return labelled.join(batch, "earthquake_id").select(
        *(name for name in CLUSTERED_COLUMNS if name != "cluster"),
        (F.col("cluster") == F.col("own")).alias("same"),
    )


def cluster_events_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustered table, and of each row whether its label names the nearest centre."""
    events = _clean(spark, sf_dir)
    model = fit_clusters(events)
    labelled = model.label(events).select(*CLUSTERED_COLUMNS)
    return with_nearest(labelled, model).drop("cluster", "distance")


def cluster_sizes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes, held against a count of the rows whose own centre is the nearest."""
    events = _clean(spark, sf_dir)
    model = fit_clusters(events)
    labelled = model.label(events)
    sizes = cluster_sizes(labelled)
    recount = with_nearest(labelled, model).where("nearest").groupBy("cluster").count()
    return sizes.join(recount, "cluster", "left").agg(
        F.count("*").alias("n_clusters"),
        F.sum("n").alias("n_rows"),
        F.count_if(F.col("n").eqNullSafe(F.col("count"))).alias("n_recounted"),
    )


# Limits that a sound fit of scaled features keeps: a centre lies within the
# first of the mean of its rows, and the loss is below the second.
CENTRE_SHIFT = 0.05
LOSS_SHARE = 0.45


def cluster_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any sound clustering, from distances computed without MLlib."""
    events = _clean(spark, sf_dir)
    return cluster_verdict(cluster_quality(events, fit_clusters(events)))


def cluster_verdict(quality: DataFrame) -> DataFrame:
    return quality.select(
        "n_rows",
        "n_clusters",
        "n_misplaced",
        (F.col("centre_shift") < CENTRE_SHIFT).alias("centres_are_means"),
        (F.col("loss_share") < LOSS_SHARE).alias("loss_is_low"),
    )


def event_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end job on landed pages; what its reports say, in one table."""
    pages = fresh_dir(spark, "pages")
    land_pages(spark, sf_dir, QUIET_FIRST_POLL, pages)
    result = run_job(
        spark,
        pages,
        fresh_dir(spark, "job"),
        default_provider=DEFAULT_PROVIDER,
        backfill_threshold=BACKFILL_THRESHOLD,
    )

    def report(name: str) -> DataFrame:
        return spark.read.parquet(result.reports[name])

    def line(name: str, item: str, n: str) -> list:
        return [F.lit(name).alias("report"), F.expr(item).alias("item"), F.expr(n).alias("n")]

    lines = [
        report("severity_counts").select(*line("severity_counts", "severity", "n")),
        report("magnitude_hist").select(*line("magnitude_hist", "cast(bin as string)", "n")),
        report("cluster_sizes").select(*line("cluster_sizes", "'all clusters'", "sum(n)")),
        report("map_points").select(*line("map_points", "'points shown'", "count(*)")),
        read_csv(spark, result.clustered_csv).select(*line("csv", "'rows'", "count(*)")),
        read_enriched(spark, result.enriched).select(
            *line("enriched", "'times parsed'", "count(event_ts)")
        ),
    ]
    return reduce(DataFrame.unionByName, lines)


def job_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the job into one folder: the second starts afresh, the first's tables stay."""
    pages, out = fresh_dir(spark, "pages"), fresh_dir(spark, "job")
    land_pages(spark, sf_dir, QUIET_FIRST_POLL, pages)
    results = [run_job(spark, pages, out, default_provider=DEFAULT_PROVIDER) for _ in range(2)]
    counts = [
        spark.read.parquet(result.clustered).select(
            F.lit(number).alias("run"), F.count("*").alias("n")
        )
        for number, result in enumerate(results, 1)
    ]
    return reduce(DataFrame.unionByName, counts)


def nothing_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports hold where cleaning removes every event: no row, and zero counts."""
    nowhere = {"latitude": F.lit(0.0), "longitude": F.lit(0.0)}
    events = clean_events(_enriched(spark, sf_dir).withColumns(nowhere))
    tables = {
        "clustered": cluster_events(events),
        "magnitude_hist": magnitude_histogram(events),
        "severity_counts": severity_counts(events).where("n > 0"),
        "map_points": map_points(events),
    }
    counts = [
        table.select(F.lit(name).alias("report"), F.count("*").alias("n"))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES: dict[str, Query] = {
    "explode_pages": explode_pages_query,
    "flatten_events": flatten_events_query,
    "dedup_first_seen": dedup_first_seen,
    "packed_pages": packed_pages,
    "stream_dedup": stream_dedup,
    "state_dedup": state_dedup,
    "continuous_ingest": continuous_ingest,
    "gated_ingest": gated_ingest,
    "malformed_lines": malformed_lines,
    "backfill_union": backfill_union_query,
    "newest_page": newest_page,
    "live_window": live_window_query,
    "archive_window": archive_window_query,
    "severity_label": severity_label_query,
    "parse_event_time": parse_event_time_query,
    "enrich": _enriched,
    "stream_ingest": stream_ingest,
    "stream_monitor": stream_monitor,
    "clean_events": clean_events_query,
    "clean_count": clean_count,
    "map_points": map_points_query,
    "severity_counts": severity_counts_query,
    "magnitude_hist": magnitude_hist,
    "running_reports": running_reports,
    "standardize": standardize_query,
    "jsonl_roundtrip": jsonl_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "csv_single_file": csv_single_file,
    "stream_labels": stream_labels,
    "cluster_events": cluster_events_query,
    "cluster_sizes": cluster_sizes_query,
    "cluster_check": cluster_check,
    "event_report": event_report,
    "job_rerun": job_rerun,
    "nothing_left": nothing_left,
}
