"""Column expressions; all of them stay inside Spark's generated code."""

from tremorlane.functions.fields import coordinate, first_filled, number, number_or_zero
from tremorlane.functions.labels import SEVERITY_LABELS, severity_label
from tremorlane.functions.times import parse_event_time

__all__ = [
    "SEVERITY_LABELS",
    "coordinate",
    "first_filled",
    "number",
    "number_or_zero",
    "parse_event_time",
    "severity_label",
]
