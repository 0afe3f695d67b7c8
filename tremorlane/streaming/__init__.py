"""Structured Streaming: source, de-duplication, sinks, run control."""

from tremorlane.streaming.dedup import dedup_stream, first_seen_stream, start_first_seen
from tremorlane.streaming.gate import settled_gate
from tremorlane.streaming.queries import run_for, run_to_end, start_monitor, start_parquet
from tremorlane.streaming.source import read_event_stream, read_landed_stream, split_malformed
from tremorlane.streaming.summary import read_summary, start_summary

__all__ = [
    "dedup_stream",
    "first_seen_stream",
    "read_event_stream",
    "read_landed_stream",
    "read_summary",
    "run_for",
    "run_to_end",
    "settled_gate",
    "split_malformed",
    "start_first_seen",
    "start_monitor",
    "start_parquet",
    "start_summary",
]
