from __future__ import annotations

import json
import os
import time

import pytest

from tremorlane.operators import clean_events, first_seen, flatten_events, require_id
from tremorlane.plans.job import arrival_order, arriving_events
from tremorlane.sources import explode_pages, pack_pages, read_packed_pages, read_pages
from tremorlane.streaming import run_to_end, start_parquet


def event(name: str | None = "e1", **fields) -> dict:
    whole = {
        "earthquake_id": name,
        "provider": "p",
        "title": "t",
        "mag": 3.4,
        "depth": 7,
        "geojson": {"coordinates": [29.1, 40.2]},
        "location_properties": {"epiCenter": {"name": "Epi"}, "closestCity": {"name": "City"}},
        "date_time": "2026-06-02 00:34:05",
        "date": "2026.06.02 00:34:05",
    } | fields
    return {key: value for key, value in whole.items() if value != "absent"}


def flat(spark, folder: str) -> dict:
    events = flatten_events(explode_pages(read_pages(spark, folder)), default_provider="net")
    return {row.earthquake_id: row for row in events.collect()}


def test_bad_pages_give_no_rows(spark, lines):
    folder = lines(
        [
            {"result": [event("a"), event("b")]},
            {"result": []},
            {"result": event("c")},
            {"result": "text"},
            {"other": 1},
            "not json",
            "[]",
            "",
        ]
    )
    assert set(flat(spark, folder)) == {"a", "b"}


def test_sound_events_survive_a_bad_element(spark, lines):
    folder = lines([{"page": 7, "result": [event("a"), None, "junk", 5, [event("x")], event("b")]}])
    rows = explode_pages(read_pages(spark, folder)).collect()
    assert [(row.page, row.event.earthquake_id) for row in sorted(rows)] == [(7, "a"), (7, "b")]
    assert flat(spark, folder)["b"].latitude == 40.2


def test_an_odd_field_costs_only_itself(spark, lines):
    odd = [
        event("geojson", geojson="x"),
        event("place", location_properties=[1]),
        event("mag", mag={"value": 1}),
        event("coordinates", geojson={"coordinates": "x"}),
        event("date", date_time=5),
    ]
    rows = flat(spark, lines([{"result": [event("a"), *odd, event("b")]}]))
    assert set(rows) == {"a", "b", "geojson", "place", "mag", "coordinates", "date"}
    for name in ("geojson", "coordinates"):
        assert (rows[name].latitude, rows[name].magnitude) == (0.0, 3.4)
    assert (rows["place"].region, rows["place"].latitude) == ("", 40.2)
    assert (rows["mag"].magnitude, rows["mag"].region) == (None, "Epi")
    assert rows["b"].title == "t"


def test_one_document_per_file(spark, tmp_path):
    for poll, feed, name in ((0, "live", "a"), (0, "archive", "b"), (1, "live", "c")):
        folder = tmp_path / f"poll={poll}" / f"feed={feed}"
        folder.mkdir(parents=True)
        page = json.dumps({"result": [event(name), event(name + "2")]}, indent=2)
        (folder / "response.json").write_text(page)
        (folder / "response.json.tmp").write_text(page)
    pages = read_pages(spark, str(tmp_path), one_document_per_file=True)
    rows = explode_pages(pages).select("poll", "feed", "pos", "event.earthquake_id").collect()
    assert sorted(tuple(row) for row in rows) == [
        (0, "archive", 0, "b"),
        (0, "archive", 1, "b2"),
        (0, "live", 0, "a"),
        (0, "live", 1, "a2"),
        (1, "live", 0, "c"),
        (1, "live", 1, "c2"),
    ]


def test_flatten_defaults(spark, lines):
    rows = flat(
        spark,
        lines(
            [
                {
                    "result": [
                        event("whole"),
                        event("text-mag", mag="3.4"),
                        event("no-mag", mag="absent", depth=None),
                        event("empty-mag", mag="", depth=""),
                        event("zero-mag", mag=0),
                        event("bad-mag", mag="abc"),
                        event("one-coordinate", geojson={"coordinates": [29.1]}),
                        event("no-coordinates", geojson={"coordinates": []}),
                        event("null-geojson", geojson=None),
                        event("no-geojson", geojson="absent"),
                        event("no-epicentre", location_properties={
                            "epiCenter": {"name": ""}, "closestCity": {"name": "Izmir"}}),
                        event("no-place", location_properties=None),
                        event("no-date-time", date_time=""),
                        event("no-dates", date_time="absent", date="absent"),
                        event("no-provider", provider=None, title="absent"),
                        event(12),
                    ]
                }
            ]
        ),
    )
    assert tuple(rows["whole"]) == (
        "whole", "p", "t", 3.4, 7.0, 40.2, 29.1, "Epi", "2026-06-02 00:34:05",
    )
    assert rows["text-mag"].magnitude == 3.4
    assert (rows["no-mag"].magnitude, rows["no-mag"].depth) == (0.0, 0.0)
    assert (rows["empty-mag"].magnitude, rows["empty-mag"].depth) == (0.0, 0.0)
    assert rows["zero-mag"].magnitude == 0.0
    assert rows["bad-mag"].magnitude is None
    assert (rows["one-coordinate"].latitude, rows["one-coordinate"].longitude) == (0.0, 29.1)
    for name in ("no-coordinates", "null-geojson", "no-geojson"):
        assert (rows[name].latitude, rows[name].longitude) == (0.0, 0.0)
    assert rows["no-epicentre"].region == "Izmir"
    assert rows["no-place"].region == ""
    assert rows["no-date-time"].event_time == "2026.06.02 00:34:05"
    assert rows["no-dates"].event_time == ""
    assert (rows["no-provider"].provider, rows["no-provider"].title) == ("net", "")
    assert "12" in rows


def test_what_cleaning_leaves_of_them(spark, lines):
    folder = lines(
        [
            {
                "result": [
                    event("ok"),
                    event("bad-mag", mag="abc"),
                    event("no-mag", mag=None),
                    event("one-coordinate", geojson={"coordinates": [29.1]}),
                    event("null-island", geojson=None),
                    event(""),
                    event(None),
                ]
            }
        ]
    )
    raw = explode_pages(read_pages(spark, folder))
    events = clean_events(require_id(flatten_events(raw, default_provider="net")))
    assert {row.earthquake_id for row in events.collect()} == {"ok", "no-mag", "one-coordinate"}


def test_pages_as_a_stream(spark, lines, tmp_path):
    folder = lines([{"result": [event("a"), event("b")]}], name="1.json")
    lines([{"result": [event("c")]}, "not json"], name="2.json")
    stream = flatten_events(
        explode_pages(read_pages(spark, folder, streaming=True)), default_provider="net"
    )
    run_to_end(start_parquet(stream, str(tmp_path / "out"), str(tmp_path / "check")))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(row.earthquake_id for row in written.collect()) == ["a", "b", "c"]


def test_pages_without_a_number_count_in_the_order_of_their_files(spark, tmp_path):
    """The second file is the larger one, which Spark would read first."""
    folder = tmp_path / "in"
    folder.mkdir()
    pad = [event(f"pad{i}", title="x" * 500) for i in range(200)]
    (folder / "z-first.json").write_text(
        json.dumps({"result": [event("e", title="first")]}) + "\n"
        + json.dumps({"result": [event("e", title="next line"), event("f", title="first")]}) + "\n"
    )
    time.sleep(0.05)
    (folder / "a-second.json").write_text(
        "".join(json.dumps({"result": [event("e", title="second"), event("f", title="second"), part]}) + "\n" for part in pad)
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1k", "20k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            events = arriving_events(explode_pages(read_pages(spark, str(folder))), default_provider="p")
            kept = first_seen(events, "earthquake_id", arrival_order())
            titles = {row.earthquake_id: row.title for row in kept.collect()}
            assert (titles["e"], titles["f"]) == ("first", "first")
            assert len(titles) == 202
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("one_per_file", [False, True])
def test_packed_pages_are_read_as_the_files_they_came_in(spark, tmp_path, one_per_file):
    """Many small files, some of them broken, as a few large ones; the order of arrival holds."""
    pages, packed = tmp_path / "pages", str(tmp_path / "packed")
    for i in range(40):
        folder = pages / f"poll={i % 2}" / f"feed={'archive' if i % 5 == 0 else 'live'}"
        folder.mkdir(parents=True, exist_ok=True)
        page = {"result": [event(f"e{i % 13}", title=f"{i}-{n}") for n in range(3)] + [None] * (i % 3 == 0)}
        text = "not json" if i == 7 else json.dumps(page, indent=1 if one_per_file else None)
        (folder / f"{100 - i}.json").write_text(text + "\n")
        os.utime(folder / f"{100 - i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    pack_pages(spark, str(pages), packed, one_document_per_file=one_per_file, bytes_per_file=12_000)
    files = list((tmp_path / "packed").rglob("*.parquet"))
    assert 1 <= len(files) <= 10

    def rows(read):
        raw = explode_pages(read)
        flat = arriving_events(raw, default_provider="net")
        first = first_seen(flat, "earthquake_id", arrival_order())
        return raw.count(), sorted((row.earthquake_id, row.title) for row in first.collect())

    plain = read_pages(spark, str(pages), one_document_per_file=one_per_file)
    assert rows(read_packed_pages(spark, packed)) == rows(plain)
