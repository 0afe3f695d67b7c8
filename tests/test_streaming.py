from __future__ import annotations

import json
import random
import subprocess
import sys
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tremorlane.operators import (
    clean_events,
    enrich,
    magnitude_histogram,
    require_id,
    row_count,
    severity_counts,
)
from tremorlane.plans.job import run_live
from tremorlane.plans.testdata import flat_events
from tremorlane.schemas import FLAT, MONITOR_COLUMNS
from tremorlane.sources import read_events
from tremorlane.streaming import (
    dedup,
    dedup_stream,
    read_event_stream,
    read_landed_stream,
    read_summary,
    run_for,
    run_to_end,
    start_first_seen,
    start_monitor,
    start_parquet,
    start_summary,
)
from tremorlane.streaming.summary import KEPT

SF = "/root/testdata/sf0.001"


def flat(name: str, **fields) -> dict:
    whole = {
        "earthquake_id": name,
        "provider": "p",
        "title": "t",
        "magnitude": 3.4,
        "depth": 7.0,
        "latitude": 40.0,
        "longitude": 30.0,
        "region": "r",
        "event_time": "2026-06-02 00:34:05",
    }
    return whole | fields


def drain(spark, folder: str, out: Path, check: Path, *, dedup: bool = False, **options):
    stream = read_event_stream(spark, folder, **options)
    if dedup:
        stream = dedup_stream(require_id(stream))
    query = start_parquet(enrich(stream), str(out), str(check))
    run_to_end(query)
    return query


@pytest.mark.parametrize("files", [1, 3, 10])
def test_stream_equals_batch(spark, tmp_path, files):
    landing = str(tmp_path / "in")
    flat_events(spark, SF).repartition(files).write.json(landing)
    query = drain(spark, landing, tmp_path / "out", tmp_path / "check", files_per_batch=1)
    assert query.lastProgress.batchId == files - 1
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = enrich(read_events(spark, landing))
    assert streamed.count() == batch.count() == 1000
    assert streamed.exceptAll(batch).isEmpty()


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    landing = str(tmp_path / "in")
    flat_events(spark, SF).repartition(6).write.json(landing)
    size = max(file.stat().st_size for file in (tmp_path / "in").glob("*.json"))
    query = drain(
        spark, landing, tmp_path / "out", tmp_path / "check", bytes_per_batch=2 * size + 100
    )
    assert query.lastProgress.batchId >= 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_restart_reads_only_new_files(spark, lines, tmp_path):
    folder = lines([flat("a"), flat("b")], name="1.json")
    drain(spark, folder, tmp_path / "out", tmp_path / "check")
    lines([flat("c")], name="2.json")
    drain(spark, folder, tmp_path / "out", tmp_path / "check")
    drain(spark, folder, tmp_path / "out", tmp_path / "check")
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(row.earthquake_id for row in written.collect()) == ["a", "b", "c"]


def test_malformed_lines(spark, lines, tmp_path):
    folder = lines(
        [
            flat("whole", magnitude=3),
            flat("text", magnitude="strong"),
            flat("extra", unknown=1),
            "not json",
            "",
        ]
    )
    lines([flat("unfinished")], name="b.json.tmp")
    drain(spark, folder, tmp_path / "out", tmp_path / "check")
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    by_id = {row.earthquake_id: row for row in rows}
    assert set(by_id) == {"whole", "text", "extra", None}
    assert by_id["whole"].magnitude == 3.0
    assert by_id["text"].magnitude is None and by_id["text"].severity == "MAJOR"
    assert by_id[None].severity == "MAJOR" and by_id[None].event_ts is None
    drain(spark, folder, tmp_path / "out2", tmp_path / "check2", malformed="DROPMALFORMED")
    kept = spark.read.parquet(str(tmp_path / "out2")).collect()
    assert {row.earthquake_id for row in kept} == {"whole", "extra"}
    batch = read_events(spark, folder, malformed="DROPMALFORMED").collect()
    assert {row.earthquake_id for row in batch} == {"whole", "extra"}


def test_state_has_one_entry_per_key(spark, tmp_path):
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    for _ in range(3):  # the same hundred ids again and again, in several files
        ids = spark.range(600).select((F.col("id") % 100).cast("string").alias("earthquake_id"))
        ids.repartition(6).write.mode("append").json(landing)
        query = start_parquet(dedup_stream(read_event_stream(spark, landing)), out, check)
        run_to_end(query)
        states = [p.stateOperators for p in query.recentProgress if p.stateOperators]
        assert [[state.numRowsTotal for state in states[-1]]] == [[100]]


def numbered_rows(spark, rows, landing: str, files: int) -> None:
    df = spark.createDataFrame(rows, "earthquake_id STRING, title STRING, seq LONG")
    df.repartitionByRange(files, "seq").sortWithinPartitions("seq").write.mode("append").json(landing)


def land_numbered(spark, landing: str, out: str, check: str, **options) -> None:
    stream = (
        spark.readStream.schema("earthquake_id STRING, title STRING, seq LONG")
        .options(**options)
        .json(landing)
        .withColumn("line", F.lit(None).cast("bigint"))
    )
    columns = ["earthquake_id", "title"]
    run_to_end(
        start_first_seen(
            stream, out, check, key="earthquake_id", arrival=["seq", "line"], columns=columns
        )
    )


def test_first_seen_rows_over_batches_and_restarts(spark, tmp_path):
    """One id has a third of all rows; the row that stays is the very first of each id."""
    rng = random.Random(3)
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    rows = [
        (rng.choice(["hot", f"e{rng.randrange(60)}", f"f{i}"]), f"title {i}", i) for i in range(900)
    ]
    for part in range(3):
        numbered_rows(spark, rows[part * 300 : (part + 1) * 300], landing, 4)
        land_numbered(spark, landing, out, check)
        land_numbered(spark, landing, out, check)  # nothing new
    first = {}
    for name, title, _ in rows:
        first.setdefault(name, title)
    written = spark.read.parquet(out).collect()
    assert sorted((row.earthquake_id, row.title) for row in written) == sorted(first.items())


def test_repeated_ids_leave_one_row_each(spark, tmp_path):
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    for part in range(4):
        numbered_rows(spark, [(f"e{i % 50}", f"{part}", i) for i in range(200)], landing, 3)
        land_numbered(spark, landing, out, check)
    written = spark.read.parquet(out).collect()
    assert len(written) == 50 and {row.title for row in written} == {"0"}


def test_a_batch_costs_what_it_holds(spark, tmp_path):
    """Later batches read and touch no more than the first ones; the state has one entry per id."""
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    batches = 25
    for i in range(batches):  # ten new ids, ten that the file before had, and one in every file
        ids = [*range(10 * i, 10 * i + 20), -1]
        rows = [(f"e{n}", f"{i}", 100 * i + at) for at, n in enumerate(ids)]
        numbered_rows(spark, rows, f"{landing}/{i:02d}", 1)
    stream = (
        spark.readStream.schema("earthquake_id STRING, title STRING, seq LONG")
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .json(landing)
    )
    columns = ["earthquake_id", "title"]
    query = start_first_seen(
        stream, out, check, key="earthquake_id", arrival=["seq"], columns=columns
    )
    run_to_end(query)
    progress = [p for p in query.recentProgress if p.numInputRows]
    assert [p.numInputRows for p in progress] == [21] * batches
    totals = [p.stateOperators[0].numRowsTotal for p in progress]
    assert totals == [21 + 10 * i for i in range(batches)]
    assert [p.stateOperators[0].numRowsUpdated for p in progress] == [21] + [10] * (batches - 1)
    written = spark.read.parquet(out)
    assert written.count() == written.distinct().count() == totals[-1]


def test_a_key_with_most_rows_comes_to_the_shuffle_as_few(spark):
    """What a task hands on: the first of each key among the rows at hand."""
    schema = pa.schema([("__key", pa.string()), ("__place0", pa.int64()), (dedup._LINE, pa.int64())])

    def batch(keys, places):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(places, pa.int64()), pa.nulls(len(keys), pa.int64())],
            schema=schema,
        )

    size, count = 5_000, 60
    batches = [batch([None if i % 3 else f"k{i % 7}" for i in range(size)], range(n * size, (n + 1) * size)) for n in range(count)]
    order = ["__place0", dedup._LINE]
    handed = pa.Table.from_batches(dedup._leading("__key", order, True)(iter(batches)))
    assert handed.num_rows <= 8 * -(-size * count // dedup._HELD) + 8
    whole = pa.Table.from_batches(dedup._leading("__key", order, False)(iter(handed.to_batches())))
    found = dict(zip(whole["__key"].to_pylist(), whole["__place0"].to_pylist(), strict=True))
    assert found == {None: 1} | {f"k{k}": next(i for i in range(0, size, 3) if i % 7 == k) for k in range(7)}


def test_rows_of_one_place_stay_in_the_order_of_their_file(spark, tmp_path):
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    rows = [("a", f"{i}", 0) for i in range(300)]
    spark.createDataFrame(rows, "earthquake_id STRING, title STRING, seq LONG").coalesce(1).write.json(landing)
    land_numbered(spark, landing, out, check)
    assert [row.title for row in spark.read.parquet(out).collect()] == ["0"]


def test_a_crash_between_files_and_commit_leaves_each_id_once(spark, tmp_path):
    """A batch ended after its files and before its entries in the logs; it runs again."""
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    shown, seen = str(tmp_path / "shown"), str(tmp_path / "shown_check")

    def follow():
        stream = spark.readStream.schema("earthquake_id STRING, title STRING").parquet(out)
        run_to_end(start_parquet(stream, shown, seen))
        return sorted((row.earthquake_id, row.title) for row in spark.read.parquet(shown).collect())

    numbered_rows(spark, [("a", "1", 1), ("b", "1", 2)], landing, 1)
    land_numbered(spark, landing, out, check)
    assert follow() == [("a", "1"), ("b", "1")]
    numbered_rows(spark, [("b", "again", 3), ("c", "new", 4), ("c", "newer", 5)], landing, 1)
    land_numbered(spark, landing, out, check)
    for entry in ("out/_spark_metadata/1", "check/commits/1"):
        (tmp_path / entry).unlink()
        (tmp_path / entry).with_name(".1.crc").unlink(missing_ok=True)
    lost = len(list((tmp_path / "out").glob("*.parquet")))
    assert follow() == [("a", "1"), ("b", "1")]  # files without an entry are not seen
    land_numbered(spark, landing, out, check)
    assert len(list((tmp_path / "out").glob("*.parquet"))) > lost
    whole = [("a", "1"), ("b", "1"), ("c", "new")]
    assert follow() == whole
    assert sorted((r.earthquake_id, r.title) for r in spark.read.parquet(out).collect()) == whole


def test_a_later_query_that_fails_is_raised_soon(spark, lines, tmp_path):
    folder = lines([flat("a")])
    stream = read_event_stream(spark, folder)
    good = start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c1"), every_seconds=0.2)
    bad = stream.withColumn("bad", F.raise_error(F.lit("the second one")).cast("string"))
    failing = start_parquet(bad, str(tmp_path / "out2"), str(tmp_path / "c2"), every_seconds=0.2)
    start = time.time()
    with pytest.raises(Exception, match="the second one"):
        run_for(good, failing, seconds=300)
    assert time.time() - start < 60
    assert not good.isActive and not failing.isActive


def test_what_has_arrived_is_taken_before_the_stop(spark, lines, tmp_path):
    """Two queries in a row, one file per batch: the time is up long before the files are read."""
    for i in range(12):
        folder = lines([flat(f"e{i}")], name=f"{i}.json")
    middle = str(tmp_path / "middle")
    Path(middle).mkdir()
    first = start_parquet(
        read_event_stream(spark, folder, files_per_batch=1), middle, str(tmp_path / "c1"), 0.1
    )
    second = start_parquet(
        read_landed_stream(spark, middle), str(tmp_path / "out"), str(tmp_path / "c2"), 0.1
    )
    run_for(first, second, seconds=0.1, drain_seconds=120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12


def test_draining_ends_in_time(spark, lines, tmp_path):
    for i in range(40):
        folder = lines([flat(f"e{i}")], name=f"{i}.json")
    stream = read_event_stream(spark, folder, files_per_batch=1)
    query = start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c1"), 0.1)
    start = time.time()
    run_for(query, seconds=0.1, drain_seconds=1)
    assert time.time() - start < 20 and not query.isActive


def test_malformed_lines_go_to_a_table_of_their_own(spark, lines, tmp_path):
    folder = lines(
        [flat("whole"), flat("text", magnitude="strong"), "not json", '{"earthquake_id": "cut', "", "[1]"]
    )
    run_live(
        spark,
        folder,
        str(tmp_path / "out"),
        str(tmp_path / "check"),
        seconds=3,
        every_seconds=0.5,
        malformed=str(tmp_path / "bad"),
    )
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((row.earthquake_id, row.magnitude) for row in rows) == [("text", None), ("whole", 3.4)]
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert all(row.file.endswith("a.json") for row in bad)
    found = {row.line: row.salvaged for row in bad}
    assert {line for line, kept in found.items() if not kept} == {"not json", '{"earthquake_id": "cut', "[1]"}
    assert [json.loads(line)["earthquake_id"] for line, kept in found.items() if kept] == ["text"]


def test_a_summary_follows_the_stream(spark, lines, tmp_path):
    """After every run the reports equal those of a scan; few values make a small state."""
    kept, check = str(tmp_path / "kept"), str(tmp_path / "check")
    assert read_summary(spark, kept).count() == 0
    rng = random.Random(4)
    for run in range(4):
        for i in range(3):
            mags = [rng.choice([0.5, 1.9, 2.0, 3.4, 5.1, run * 1.5, None]) for _ in range(40)]
            folder = lines([flat(f"e{n}", magnitude=m) for n, m in enumerate(mags)], name=f"{run}{i}.json")
        stream = clean_events(enrich(read_event_stream(spark, folder, files_per_batch=1)))
        query = start_summary(stream, kept, check)
        run_to_end(query)
        scan = clean_events(enrich(read_events(spark, folder)))
        summary = read_summary(spark, kept)
        for report in (severity_counts, magnitude_histogram, row_count):
            assert report(summary, weight="n").collect() == report(scan).collect()
    values = scan.select("severity", "magnitude").distinct().count()
    assert query.lastProgress.stateOperators[0].numRowsTotal == values == summary.count()
    assert len(list((tmp_path / "kept").iterdir())) <= KEPT


def test_a_summary_half_written_is_not_read(spark, lines, tmp_path):
    kept, check = tmp_path / "kept", str(tmp_path / "check")
    for i in range(2):
        folder = lines([flat("a"), flat("b", magnitude=float(i))], name=f"{i}.json")
        stream = clean_events(enrich(read_event_stream(spark, folder, files_per_batch=1)))
        run_to_end(start_summary(stream, str(kept), check))
    whole = sorted(read_summary(spark, str(kept)).collect())
    newest = sorted(kept.iterdir())[-1]
    (newest / "_SUCCESS").unlink()
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    assert row_count(read_summary(spark, str(kept)), weight="n").first().n == 2
    run_to_end(start_summary(stream, str(kept), check))  # the batch is repeated
    assert sorted(read_summary(spark, str(kept)).collect()) == whole


CONSOLE = """
import sys
from pyspark.sql import SparkSession
from tremorlane.operators import enrich
from tremorlane.streaming import read_event_stream, run_to_end, start_monitor
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
run_to_end(start_monitor(enrich(read_event_stream(spark, sys.argv[1])), sys.argv[2]))
"""


def test_console_shows_ten_whole_rows(lines, tmp_path):
    long = "a region whose name is longer than twenty characters"
    folder = lines([flat(f"e{i}", region=f"{long} {i}") for i in range(25)])
    shown = subprocess.run(
        [sys.executable, "-c", CONSOLE, folder, str(tmp_path / "check")],
        capture_output=True,
        text=True,
        timeout=120,
        cwd=Path(__file__).parent.parent,
        check=True,
    ).stdout
    rows = [line for line in shown.splitlines() if long in line]
    assert len(rows) == 10
    assert "only showing top 10 rows" in shown
    header = next(line for line in shown.splitlines() if "event_time" in line)
    assert [name.strip() for name in header.strip("|").split("|")] == list(MONITOR_COLUMNS)


def test_dedup_over_batches_and_restarts(spark, tmp_path):
    """One id has a third of all rows, over several files, batches and runs."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", f"e{rng.randrange(60)}", f"f{i}"]), f"title {i}") for i in range(900)
    ]
    out, check, landing = (str(tmp_path / name) for name in ("out", "check", "in"))
    seen: dict[str, set[str]] = {}
    for part in range(3):
        chunk = rows[part * 300 : (part + 1) * 300]
        df = spark.createDataFrame(chunk, "earthquake_id STRING, title STRING").repartition(4)
        df.write.mode("append").json(landing)
        for name, title in chunk:
            seen.setdefault(name, {title}) if part else seen.setdefault(name, set()).add(title)
        stream = dedup_stream(read_event_stream(spark, landing, files_per_batch=4))
        run_to_end(start_parquet(stream, out, check))
    written = spark.read.parquet(out).collect()
    assert len(written) == len({row.earthquake_id for row in written}) == len(seen)
    # an id of the first run keeps a row of that run
    first = {name for name, _ in rows[:300]}
    for row in written:
        if row.earthquake_id in first:
            assert row.title in seen[row.earthquake_id]


def test_rows_without_id_are_removed_before_dedup(spark, lines, tmp_path):
    folder = lines([flat("a"), flat("a"), flat(""), "not json", flat("b")])
    drain(spark, folder, tmp_path / "out", tmp_path / "check", dedup=True)
    written = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(row.earthquake_id for row in written) == ["a", "b"]


def test_watermark_variant(spark, lines, tmp_path):
    folder = lines([flat("a"), flat("a"), flat("b")])
    stream = read_event_stream(spark, folder).withColumn(
        "seen_at", F.to_timestamp("event_time", "yyyy-MM-dd HH:mm:ss")
    )
    stream = dedup_stream(stream, watermark=("seen_at", "1 hour"))
    run_to_end(start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "check")))
    written = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(row.earthquake_id for row in written) == ["a", "b"]


def test_two_queries_on_one_source(spark, lines, tmp_path):
    folder = lines([flat("a", region="somewhere"), flat("b")])
    stream = enrich(read_event_stream(spark, folder))
    console = start_monitor(stream, str(tmp_path / "c2"))
    run_to_end(
        start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c1")),
        console,
        start_monitor(stream, str(tmp_path / "c3"), path=str(tmp_path / "shown")),
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    shown = spark.read.parquet(str(tmp_path / "shown"))
    assert shown.columns == list(MONITOR_COLUMNS) and shown.count() == 2
    assert "ConsoleTable" in console.lastProgress.sink.description
    assert console.lastProgress.numInputRows == 2


def test_run_for_a_time(spark, lines, tmp_path):
    folder = lines([flat("a")])
    stream = enrich(read_event_stream(spark, folder, files_per_batch=1))
    queries = (
        start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c1"), every_seconds=0.2),
        start_monitor(
            stream, str(tmp_path / "c2"), every_seconds=0.2, path=str(tmp_path / "shown")
        ),
    )
    start = time.time()
    run_for(*queries, seconds=5)
    assert 4 < time.time() - start < 30
    assert not any(query.isActive for query in queries)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


@pytest.mark.parametrize("dedup", [False, True])
def test_live_run_goes_on_where_it_ended(spark, lines, tmp_path, dedup):
    folder = lines([flat("a"), flat("b")], name="1.json")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for second_file in (False, True):
        if second_file:
            lines([flat("b"), flat("c")], name="2.json")
        run_live(spark, folder, out, check, seconds=12, every_seconds=0.5, dedup=dedup)
    written = sorted(row.earthquake_id for row in spark.read.parquet(out).collect())
    assert written == (["a", "b", "c"] if dedup else ["a", "b", "b", "c"])


def test_a_failing_query_is_reported(spark, lines, tmp_path):
    folder = lines([flat("a")])
    stream = read_event_stream(spark, folder).withColumn("bad", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        run_to_end(start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "check")))
