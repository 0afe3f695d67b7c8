"""Batch readers."""

from tremorlane.sources.files import read_csv, read_enriched, read_events
from tremorlane.sources.pages import explode_pages, pack_pages, read_packed_pages, read_pages

__all__ = [
    "explode_pages",
    "pack_pages",
    "read_csv",
    "read_enriched",
    "read_events",
    "read_packed_pages",
    "read_pages",
]
