from __future__ import annotations

import json
import time
from pathlib import Path
from threading import Thread

import pytest
from pyspark.sql import functions as F

from tests.test_pages import event
from tremorlane.plans import job
from tremorlane.schemas import CLUSTERED_COLUMNS
from tremorlane.sources import explode_pages, read_csv, read_pages


def land(root: Path, poll: int, feed: str, events: list) -> None:
    folder = root / f"poll={poll}" / f"feed={feed}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "page.json").write_text(json.dumps({"result": events}) + "\n")


def numbered(first: int, last: int, **fields) -> list:
    return [
        event(f"e{i}", mag=i % 6, geojson={"coordinates": [26 + i % 15, 36 + i % 6]}, **fields)
        for i in range(first, last)
    ]


def test_job(spark, tmp_path):
    pages = tmp_path / "pages"
    land(pages, 0, "live", numbered(0, 5, title="live 0"))
    land(pages, 0, "archive", numbered(3, 40, title="archive 0"))
    land(pages, 1, "live", [*numbered(30, 60, title="live 1"), event(""), event("x", mag="bad")])
    land(pages, 1, "archive", numbered(60, 70, title="archive 1"))  # not the first poll
    result = job.run_job(
        spark,
        str(pages),
        str(tmp_path / "out"),
        default_provider="net",
        monitor=True,
        backfill_threshold=10,
    )
    assert result.rows == 60
    table = read_csv(spark, result.clustered_csv)
    assert table.columns == list(CLUSTERED_COLUMNS)
    titles = {row.earthquake_id: row.title for row in table.collect()}
    expected = {f"e{i}": "live 0" if i < 5 else "archive 0" if i < 40 else "live 1" for i in range(60)}
    assert titles == expected
    severity = spark.read.parquet(result.reports["severity_counts"]).collect()
    assert {row.severity: row.n for row in severity} == {
        "MINOR": 20, "LIGHT": 10, "MODERATE": 10, "STRONG": 10, "MAJOR": 10,
    }
    for name in ("magnitude_hist", "cluster_sizes"):
        rows = spark.read.parquet(result.reports[name]).collect()
        assert sum(row.n for row in rows) == 60
    points = spark.read.parquet(result.reports["map_points"])
    assert points.columns == ["longitude", "latitude", "cluster", "marker_size"]
    assert spark.read.parquet(result.enriched).count() == 61  # with the bad magnitude


def test_all_landed_pages_are_taken_by_default(spark, tmp_path, caplog):
    pages = tmp_path / "pages"
    land(pages, 0, "live", numbered(0, 20))
    land(pages, 0, "archive", numbered(10, 30))
    land(pages, 1, "archive", numbered(60, 70))
    whole = job.run_job(spark, str(pages), str(tmp_path / "out"), default_provider="net")
    ids = {row.earthquake_id for row in spark.read.parquet(whole.clustered).collect()}
    assert ids == {f"e{i}" for i in (*range(30), *range(60, 70))}
    assert not caplog.records
    gated = job.run_job(
        spark, str(pages), str(tmp_path / "out"), default_provider="net", backfill_threshold=10
    )
    assert gated.rows == 20
    assert "gate of 10: 0 archive events taken" in caplog.text


def test_pages_one_by_one_end_as_the_batch_job_does(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "ingest")
    steps = [
        (0, "live", numbered(0, 5, title="live 0")),
        (0, "archive", numbered(3, 40, title="archive 0")),
        (1, "live", [*numbered(30, 60, title="live 1"), event("")]),
    ]
    for poll, feed, events in steps:
        land(pages, poll, feed, events)
        enriched = job.run_pages(
            spark, str(pages), out, default_provider="net", every_seconds=None, monitor=False
        )
    batch = job.run_job(spark, str(pages), str(tmp_path / "out"), default_provider="net")
    table = spark.read.parquet(enriched)
    assert table.count() == 60
    assert sorted(table.collect()) == sorted(spark.read.parquet(batch.enriched).collect())


@pytest.mark.parametrize("live", [5, 20])
def test_gated_pages_end_as_the_gated_batch_job_does(spark, tmp_path, live, caplog):
    """The gate is decided on the first poll; what lands of it later changes nothing."""
    pages, out = tmp_path / "pages", str(tmp_path / "ingest")
    steps = [
        [(0, "live", numbered(0, live, title="live 0"))],
        [(0, "archive", numbered(3, 40, title="archive 0")), (1, "live", numbered(30, 60))],
        [(1, "archive", numbered(50, 90)), (2, "live", numbered(55, 65))],
    ]
    for step in steps:
        for poll, feed, events in step:
            land(pages, poll, feed, events)
        enriched = job.run_pages(
            spark,
            str(pages),
            out,
            default_provider="net",
            every_seconds=None,
            monitor=False,
            backfill_threshold=10,
        )
    batch = job.run_job(
        spark, str(pages), str(tmp_path / "out"), default_provider="net", backfill_threshold=10
    )
    table = spark.read.parquet(enriched)
    assert sorted(table.collect()) == sorted(spark.read.parquet(batch.enriched).collect())
    assert table.count() == (65 if live == 5 else 20 + 35)
    assert f"gate of 10 is {'open' if live == 5 else 'shut'}" in caplog.text
    (pages / "poll=0" / "feed=live" / "late.json").write_text(
        json.dumps({"result": numbered(100, 130)}) + "\n"
    )
    land(pages, 0, "archive", numbered(200, 210))
    later = job.run_pages(
        spark,
        str(pages),
        out,
        default_provider="net",
        every_seconds=None,
        monitor=False,
        backfill_threshold=10,
    )
    ids = {row.earthquake_id for row in spark.read.parquet(later).collect()}
    assert {f"e{i}" for i in range(100, 130)} <= ids


def test_a_live_run_waits_for_the_first_poll(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    (pages / "poll=0").mkdir(parents=True)

    def arrive():
        time.sleep(3)
        land(pages, 0, "archive", numbered(3, 40))

    arriving = Thread(target=arrive)
    arriving.start()
    enriched = job.run_pages(
        spark,
        str(pages),
        out,
        default_provider="net",
        seconds=12,
        every_seconds=0.5,
        monitor=False,
        backfill_threshold=10,
    )
    arriving.join()
    assert spark.read.parquet(enriched).count() == 37


def test_a_failure_of_the_labelling_query_ends_the_run(spark, tmp_path, monkeypatch):
    pages = tmp_path / "pages"
    land(pages, 0, "live", numbered(0, 5))
    failing = F.raise_error(F.lit("labels are gone")).cast("string")
    monkeypatch.setattr(job, "enrich", lambda df: df.withColumn("severity", failing))
    start = time.time()
    with pytest.raises(Exception, match="labels are gone"):
        job.run_pages(
            spark,
            str(pages),
            str(tmp_path / "out"),
            default_provider="net",
            seconds=300,
            every_seconds=0.5,
            monitor=False,
        )
    assert time.time() - start < 100


def test_live_pages(spark, tmp_path):
    pages = tmp_path / "pages"
    land(pages, 0, "live", numbered(0, 5))
    for last in (5, 9):
        land(pages, last, "live", numbered(3, last))
        enriched = job.run_pages(
            spark,
            str(pages),
            str(tmp_path / "out"),
            default_provider="net",
            seconds=15,
            every_seconds=0.5,
        )
    ids = sorted(row.earthquake_id for row in spark.read.parquet(enriched).collect())
    assert ids == sorted(f"e{i}" for i in range(9))


def test_selections_read_their_own_folders_only(spark, tmp_path):
    land(tmp_path, 0, "live", numbered(0, 20))
    land(tmp_path, 0, "archive", numbered(0, 20))
    land(tmp_path, 1, "live", numbered(0, 20))
    raw = explode_pages(read_pages(spark, str(tmp_path)))
    admitted = job.admitted_events(raw, 10)  # twenty live events close the gate
    assert {row.feed for row in admitted.collect()} == {"live"}
    plan = admitted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(coalesce(feed" in plan


def test_a_second_run_starts_afresh(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    land(pages, 0, "live", numbered(0, 20))
    first = job.run_job(spark, str(pages), out, default_provider="net")
    second = job.run_job(spark, str(pages), out, default_provider="net")
    assert first.rows == second.rows == 20
    assert first.clustered != second.clustered
    assert spark.read.parquet(first.clustered).count() == 20


def test_nothing_to_cluster(spark, tmp_path):
    land(tmp_path / "pages", 0, "live", [event(""), event("a", mag="bad"), event("b", geojson=None)])
    result = job.run_job(
        spark, str(tmp_path / "pages"), str(tmp_path / "out"), default_provider="net"
    )
    assert result.rows == 0 and result.reports == {}
    assert spark.read.parquet(result.clustered).columns == list(CLUSTERED_COLUMNS)


def test_exit_code(spark, tmp_path):
    land(tmp_path / "pages", 0, "live", [event("")])
    arguments = [str(tmp_path / "pages"), str(tmp_path / "out"), "--provider", "net"]
    assert job.main(arguments) == 1
    land(tmp_path / "pages", 1, "live", [event("a")])
    assert job.main(arguments) == 0
