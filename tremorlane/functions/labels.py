"""Severity bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label and exclusive upper edge of each band, then the open one.
SEVERITY_BANDS = (("MINOR", 2.0), ("LIGHT", 3.0), ("MODERATE", 4.0), ("STRONG", 5.0))
TOP_SEVERITY = "MAJOR"
SEVERITY_LABELS = tuple(label for label, _ in SEVERITY_BANDS) + (TOP_SEVERITY,)


def severity_label(
    magnitude: Column,
    bands: Sequence[tuple[str, float]] = SEVERITY_BANDS,
    top: str = TOP_SEVERITY,
    null_label: str | None = None,
) -> Column:
    """Label of the left-closed band a magnitude falls in.

    NULL and NaN are below no edge and get the top label, unless `null_label`
    names another one for them.
    """
    branches: list[tuple[Column, str]] = []
    if null_label is not None:
        branches.append((magnitude.isNull() | F.isnan(magnitude), null_label))
    branches += [(magnitude < F.lit(edge), label) for label, edge in bands]

    condition, label = branches[0]
    expression = F.when(condition, F.lit(label))
    for condition, label in branches[1:]:
        expression = expression.when(condition, F.lit(label))
    return expression.otherwise(F.lit(top))
