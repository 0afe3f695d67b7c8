"""Severity and event timestamp, for batch and streaming tables alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.functions import parse_event_time, severity_label
from tremorlane.functions.labels import SEVERITY_BANDS, TOP_SEVERITY


def enrich(
    df: DataFrame,
    bands: Sequence[tuple[str, float]] = SEVERITY_BANDS,
    top: str = TOP_SEVERITY,
    null_label: str | None = None,
) -> DataFrame:
    return df.withColumns(
        {
            "severity": severity_label(F.col("magnitude"), bands, top, null_label),
            "event_ts": parse_event_time(F.col("event_time")),
        }
    )
